"""Layers, marts, reports and the pipeline, composed from the operators."""

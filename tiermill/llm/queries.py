"""Queries over whole tables, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm.bpe import bpe_encode, count_tokens
from tiermill.llm.chat import format_chat, read_back
from tiermill.llm.codes import ENTRIES, PARTS, ROUNDS, vector_codes
from tiermill.llm.common import table
from tiermill.llm.cover import remove_repeated_bytes
from tiermill.llm.decontaminate import find_leaks
from tiermill.llm.hilbert import hilbert_shards
from tiermill.llm.lines import RUN_WORDS, dedup_lines
from tiermill.llm.negatives import hard_negatives
from tiermill.llm.quality import quality_rules
from tiermill.llm.recompression import remove_repeats
from tiermill.llm.simhash import near_duplicates
from tiermill.llm.toxicity import toxicity

# Runs of three lines, or of fewer with 50 words, by content; lines are numbered among those with a word.
LINES_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL
), full_lines AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
           len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), threes AS (
    SELECT *, lead(line, 1) OVER p AS b, lead(line, 2) OVER p AS c, lead(words, 1) OVER p AS b_words
    FROM full_lines WINDOW p AS (PARTITION BY doc_id ORDER BY k)
), windows AS (
    SELECT doc_id, k, [line, b, c] AS content FROM threes WHERE c IS NOT NULL
    UNION ALL SELECT doc_id, k, [line, b] FROM threes WHERE b IS NOT NULL AND words + b_words >= 50
    UNION ALL SELECT doc_id, k, [line] FROM threes WHERE words >= 50
), named AS (
    SELECT doc_id, k, len(content) AS size, count(*) OVER (PARTITION BY content) AS n,
           row_number() OVER (PARTITION BY content ORDER BY doc_id, k) AS nth
    FROM windows
), covered AS (
    SELECT doc_id, k + step AS k, max(CASE WHEN nth = 1 THEN 1 ELSE 0 END) AS kept
    FROM named, (SELECT unnest([0, 1, 2]) AS step) WHERE n > 1 AND step < size GROUP BY ALL
), cut AS (
    SELECT f.doc_id, f.i FROM full_lines f JOIN covered c USING (doc_id, k) WHERE c.kept = 0
), left_over AS (
    SELECT doc_id, count(*) AS n_lines, count(c.i) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.i IS NULL), '') AS kept
    FROM lines LEFT JOIN cut c USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(kept) AS kept_sha256
FROM documents d LEFT JOIN left_over USING (doc_id)
"""

# Bytes as hex digits; strings of 200 bytes by their MD5.
COVER_SQL = """
WITH coded AS (
    SELECT row_number() OVER () AS n, doc_id, hex(encode(coalesce(text, ''))) AS bytes FROM documents
), starts AS MATERIALIZED (
    SELECT n, p, md5_number(substr(bytes, 2 * p + 1, 400)) AS name
    FROM coded, LATERAL (SELECT unnest(range(len(bytes) // 2 - 199)) AS p)
), again AS (
    SELECT name FROM starts GROUP BY name HAVING count(*) > 1
), edges AS (
    SELECT n, p, coalesce(lag(p) OVER w + 200 < p, true) AS opens,
           coalesce(lead(p) OVER w > p + 200, true) AS closes
    FROM starts SEMI JOIN again USING (name) WINDOW w AS (PARTITION BY n ORDER BY p)
), spans AS (
    SELECT n, p AS first, lead(p) OVER (PARTITION BY n ORDER BY p, closes) AS last
    FROM (SELECT n, p, false AS closes FROM edges WHERE opens
          UNION ALL SELECT n, p + 200, true FROM edges WHERE closes)
    QUALIFY NOT closes
), gaps AS (
    SELECT n, last AS begin, lead(first) OVER (PARTITION BY n ORDER BY first) AS stop FROM spans
    UNION ALL SELECT n, 0, min(first) FROM spans GROUP BY n
), cut AS (
    SELECT n, string_agg(substr(bytes, 2 * begin + 1, 2 * (coalesce(stop, len(bytes) // 2) - begin)), ''
                         ORDER BY begin) AS kept
    FROM gaps JOIN coded USING (n) GROUP BY n
), counted AS (SELECT n, sum(last - first) AS removed, count(*) AS spans FROM spans GROUP BY n)
SELECT doc_id, (len(bytes) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
       coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, bytes))) AS kept_sha256
FROM coded LEFT JOIN counted USING (n) LEFT JOIN cut USING (n)
"""

# Vectors without a null or a component that is no finite number.
SOUND_SQL = """embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)"""

NEGATIVES_SQL = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
    FROM embeddings WHERE label IS NOT NULL AND {SOUND_SQL}
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_dot_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


def _codes_sql() -> str:
    """The rounds one after another; squares and sums are whole numbers throughout."""
    steps = [
        f"""WITH v AS MATERIALIZED (
    SELECT vec_id, label, [floor(4096 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e
    FROM embeddings WHERE {SOUND_SQL}
), places AS MATERIALIZED (
    SELECT vec_id, (i - 1) // (len(e) // {PARTS}) AS part, (i - 1) % (len(e) // {PARTS}) AS place, e[i] AS x
    FROM v, LATERAL (SELECT unnest(range(1, len(e) + 1)) AS i)
), book0 AS MATERIALIZED (
    SELECT part, place, entry, x FROM places
    JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v
          QUALIFY entry < {ENTRIES}) USING (vec_id)
)"""
    ]
    for turn in range(ROUNDS + 1):
        steps.append(
            f"""near{turn} AS MATERIALIZED (
    SELECT vec_id, part, entry, sum((p.x - b.x) * (p.x - b.x))::BIGINT AS square
    FROM places p JOIN book{turn} b USING (part, place) GROUP BY vec_id, part, entry
    QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY square, entry) = 1
)"""
        )
        if turn < ROUNDS:
            steps.append(
                f"""book{turn + 1} AS MATERIALIZED (
    SELECT part, place, entry, coalesce(y, x) AS x FROM book{turn} LEFT JOIN (
        SELECT part, place, entry,
               (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS y
        FROM places JOIN near{turn} USING (vec_id, part) GROUP BY part, place, entry
    ) USING (part, place, entry)
)"""
            )
    return (
        ",\n".join(steps)
        + f""", coded AS (
    SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(square)::BIGINT AS error
    FROM near{ROUNDS} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{ROUNDS})
           AS codebooks_sha256
FROM coded JOIN v USING (vec_id)"""
    )


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return bpe_encode(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distances to the language references and verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    return count_tokens(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, as a copy or a paraphrase."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows of 35 words that start anywhere else too."""
    return remove_repeats(table(spark, sf_dir, "documents"), window=35)


def op6_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards along the curve; row counts differ by one at most."""
    return hilbert_shards(table(spark, sf_dir, "documents"), shards=24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("place").alias("curve_place"),
    )


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts are control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], turns.schema
    )
    return read_back(format_chat(turns.unionByName(control)))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its later copies of runs of three lines, or of fewer with 50 words."""
    return dedup_lines(table(spark, sf_dir, "documents"), words=RUN_WORDS).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt outside the held-out fold."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that start anywhere else too."""
    return remove_repeated_bytes(table(spark, sf_dir, "documents"), length=200)


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors: eight parts, sixteen entries, six rounds."""
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, some labels being flipped first."""
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), flipped)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One callable per operator, and the pipeline."""
    return {
        "op1_bpe": op1_bpe,
        "op2_quality": op2_quality,
        "op3_token_counts": op3_token_counts,
        "op4_decontamination": op4_decontamination,
        "op5_repeats": op5_repeats,
        "op6_hilbert": op6_hilbert,
        "op7_chat": op7_chat,
        "op8_lines": op8_lines,
        "op9_toxicity": op9_toxicity,
        "op10_simhash": op10_simhash,
        "op11_cover": op11_cover,
        "op12_codes": op12_codes,
        "op13_negatives": op13_negatives,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    """SQL over the same tables for the queries that SQL can express."""
    return {
        "op8_lines": LINES_SQL,
        "op11_cover": COVER_SQL,
        "op12_codes": _codes_sql(),
        "op13_negatives": NEGATIVES_SQL,
    }

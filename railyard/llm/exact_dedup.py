"""Exact duplicates by two-pass Bloom filtering (operator 8, DataFrame functions only).

Pass one hashes every text and builds a Bloom filter of the hashes that at least two rows may share. Pass two probes
every row: rows outside the filter are unique for certain and pass straight through; only the rest are shuffled and
compared by SHA-256. A saturated filter costs shuffles, never results.

Defined cases: a null text counts as empty, and all empty texts are equal. Of equal texts the row with the most code
points stays, then the smallest doc_id (null last). A doc_id that occurs in several rows of a group is kept once; its
other rows are dropped. An empty table gives an empty result. Other columns never take part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import bloom
from railyard.llm.common import SPACES, documents, stored


def text_digest(text: Column) -> Column:
    """SHA-256 (binary) of the text without white space."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "").cast("binary"), 256))


def _order() -> Column:
    return F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests = stored(docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("n"),
                                 text_digest(F.col(text_col)).alias("sha")), "digests")
    hashed = digests.withColumn("h", F.xxhash64("sha"))
    n_words = bloom.words_for(digests.count())
    repeated = bloom.filter_table(hashed, "h", n_words, at_least=2)
    flagged = bloom.probe(hashed, "h", repeated, n_words, "maybe")
    unique = flagged.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    # rows with one id and text are counted, not carried; the hot group is summed before its shuffle
    rows = stored(flagged.where("maybe").groupBy("sha", "doc_id", "n").agg(F.count(F.lit(1)).alias("copies")), "copies")
    # both sides are tables, so that the skewed partition of a hot group is split in the join
    groups = stored(rows.groupBy("sha").agg(F.min(_order()).alias("best"), F.sum("copies").alias("group_size")), "groups")
    joined = rows.join(groups, "sha").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", "sha",
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("n") == -F.col("best.n"))).alias("stays"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    repeats = joined.select("doc_id", "keep_id", "group_size",
                            (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "sha")
    return unique.unionByName(repeats).select("doc_id", "keep_id", "group_size", "kept",
                                              F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact copies, all columns kept. Only possibly repeated rows are shuffled.

    Among fully tied rows any one of the identical rows stays."""
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    keyed = row.withColumn("sha", text_digest(F.col(f"row.`{text_col}`")))
    hashed = keyed.withColumn("h", F.xxhash64("sha"))
    small = stored(hashed.select("h"), "text-hashes")
    n_words = bloom.words_for(small.count())
    repeated = stored(bloom.filter_table(small, "h", n_words, at_least=2), "repeated-bits")
    flagged = bloom.probe(hashed, "h", repeated, n_words, "maybe")
    doc_id, text = F.col(f"row.`{id_col}`"), F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    order = F.struct(-F.length(text), doc_id.isNull(), doc_id)
    best = flagged.where("maybe").groupBy("sha").agg(F.min_by("row", order).alias("row")).select("row")
    return flagged.where(~F.col("maybe")).select("row").unionByName(best).select("row.*")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
       text_sha256
FROM d
"""

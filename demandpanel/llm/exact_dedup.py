"""Exact deduplication of whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.common import cut, hot_join, quoted, read, whole


def text_groups(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per text whose digest is in ``repeated`` (``digest``, ``n``): ``digest``, ``keep_id`` (the largest id) and ``group_size``.

    Three combining steps, each of which compares whole texts: rows are combined within each input partition (the
    map side of the first aggregation), the partitions' winners within a salt, and the salts' winners globally. After
    the first step a text has one row per partition however often it occurs, and after the second one per salt. Two
    different texts with one SHA-256 would stop the job, never merge.
    """
    text = whole(quoted(text_col))
    rows = docs.select(quoted(id_col).alias("id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = hot_join(rows, repeated.select(F.col("digest").alias("same"), "n"), "digest", "same", "n").filter(F.col("n").isNotNull())
    salted = rows.groupBy("digest", "text", F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt")).agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    merged = salted.repartition("digest").groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    single = merged.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count("*").alias("texts"))
    safe = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share a SHA-256")).cast("long"))
    return single.select("digest", "keep_id", safe.alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Marks, of all rows with the same text, those with the largest id as kept.

    Returns one row per input row: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``. Digests are counted
    first; only texts whose digest occurs twice can be equal to another, and only these move and are compared (see
    :func:`text_groups`). Rows of very large groups take no part in the shuffles of the joins, whatever their ids.

    A null text counts as empty, and texts of any length are compared whole. A null id never wins against another; where
    all ids of a group are null its rows are kept. Of tied rows (same id, same text) each gets the same verdict. An empty
    table gives an empty result; other columns are not looked at, whatever their names.
    """
    rows = cut(docs.select(quoted(id_col).alias("id"), F.unhex(F.sha2(whole(quoted(text_col)), 256)).alias("digest")))
    repeated = cut(rows.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1"))
    groups = cut(text_groups(docs, repeated, id_col, text_col).withColumnRenamed("digest", "same"))
    found = hot_join(rows, groups, "digest", "same", "group_size", row_bytes=128)
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


OP3_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

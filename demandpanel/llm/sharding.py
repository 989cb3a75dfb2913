"""Sharding by a keyed permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.llm.common import apart, free, quoted, read, whole

#: A shard's share of a document besides its text, in bytes.
ROW_OVERHEAD = 16


def permuted(number: Column, n: int, seed: int = 17, rounds: int = 6) -> Column:
    """The place of row ``number`` (0 to n-1) under a pseudo-random permutation of 0 to n-1.

    An alternating Feistel network works on pairs (left, right) of Z_a x Z_b with a = ceil(sqrt(n)) and
    b = ceil(n / a). The a * b - n < a pairs beyond n are walked through: a result outside 0 to n-1 is permuted again
    until it falls inside. A walk has a * b - n + 1 steps at most, and all of them are tried where they are 64 or fewer,
    so always below n = 4096. Beyond that a step stays outside with a probability under 1 / b, so 64 of them with one
    under b**-64 (2**-384), and then the job stops with an error rather than give a wrong place.
    """
    n = max(n, 1)
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)

    def step(pair: Column, k: Column) -> Column:
        left, right = pair["l"], pair["r"]
        return F.when(k % 2 == 0, F.struct(F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), k, right), F.lit(a)), F.lit(a)).alias("l"), right.alias("r"))).otherwise(F.struct(left.alias("l"), F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), k, left), F.lit(b)), F.lit(b)).alias("r")))

    def once(x: Column) -> Column:
        pair = F.struct(F.call_function("div", x, F.lit(b).cast("long")).alias("l"), (x % b).cast("long").alias("r"))
        return F.aggregate(F.array(*[F.lit(k) for k in range(rounds)]), pair, step, lambda p: p["l"] * F.lit(b) + p["r"])

    walk = F.sequence(F.lit(1), F.lit(min(a * b - n + 1, 64)))
    place = F.aggregate(walk, once(number), lambda x, _: F.when(x < n, x).otherwise(once(x)))
    return F.when(place < n, place).otherwise(F.raise_error(F.lit("the walk left the permutation's domain")).cast("long"))


def numbered(rows: DataFrame, to: str) -> tuple[DataFrame, int]:
    """Adds global row numbers from 0 in column ``to``; returns the row count too.

    Rows fall into about sqrt(n) buckets by a hash of all their columns, are numbered within each, and start at the
    count of the buckets before. No two rows may be equal (see :func:`~demandpanel.llm.common.apart`), so neither a bucket
    nor the table of bucket sizes has more than about sqrt(n) rows, and no task sorts the whole table. ``rows`` is read
    three times: pass a table, not a long plan.
    """
    by = rows.columns
    bucket, k, n_here, start = free([*by, to], "bucket", "k", "n_here", "start")
    n = rows.count()
    buckets = math.isqrt(max(n, 1)) + 1
    rows = rows.withColumn(bucket, F.pmod(F.xxhash64(*by), F.lit(buckets)))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(bucket).agg(F.count("*").alias(n_here)).select(bucket, F.coalesce(F.sum(n_here).over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(bucket).orderBy(*by)
    # sqrt(n) + 1 rows of two numbers: 5 MB at 10**11 rows
    placed = rows.withColumn(k, F.row_number().over(inside)).join(F.broadcast(starts), bucket)
    return placed.withColumn(to, F.col(start) + F.col(k) - 1).select(*by, to), n


def shard(docs: DataFrame, shards: int = 40, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deals all rows to ``shards`` shards in a reproducible random order.

    Returns the id, ``size`` (UTF-8 bytes of the text plus 16), ``text_crc32``, ``shard`` and ``slot``. A row of place
    p goes to shard p mod shards, slot p div shards, so shard sizes in rows differ by one at most and slots have no
    gaps; place and row number can be computed from each other. The same rows get the same places, however the table is
    partitioned. A null text has no bytes and the checksum of an empty one. Null and tied ids are ids like any other;
    repeated rows (same id and text) are told apart by a number and get places of their own, and however many there
    are, no task holds them all. Texts of any length are only measured and hashed. An empty table gives an empty result.
    Other columns are not looked at, whatever their names.
    """
    text = quoted(text_col)
    rows = docs.select(
        F.xxhash64(quoted(id_col), text).alias("hash"),
        quoted(id_col).alias("id"),
        F.crc32(whole(text)).alias("text_crc32"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
    )
    rows, n = numbered(apart(rows, "copy"), "row")
    place = rows.withColumn("place", permuted(F.col("row"), n, seed))
    return place.select(F.col("id").alias(id_col), "size", "text_crc32", (F.col("place") % shards).cast("int").alias("shard"), F.expr(f"place div {int(shards)}").alias("slot"))


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Keys of more than 1/HEAVY of all rows are hot; tables of this size at most are broadcast.
HEAVY, BROADCAST_BYTES = 1000, 8_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table, read by Spark alone so that any store Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a local one only where Spark itself is local."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="demandpanel-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def cut(df: DataFrame, by: str | None = None) -> DataFrame:
    """Writes ``df`` as a table in the shared folder, one folder for each value of ``by`` if given, and reads it back.

    Later jobs restart from the table, so a lost executor costs no recomputation of what came before. The table is
    deleted when the session ends.
    """
    path = passing_path(df.sparkSession)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def passing_path(spark: SparkSession) -> str:
    """A new path in the shared folder that is deleted when the session ends."""
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


@contextmanager
def bounded_batches(spark: SparkSession, rows: int = 1000):
    """While it is entered, at most ``rows`` rows pass to Python at once: texts are large, and two copies of a batch exist
    on either side. The session's own setting comes back at the end, so what runs inside has to be written (see :func:`cut`)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free(taken: list[str], *names: str) -> list[str]:
    """Names like ``names`` that no column of ``taken`` has, in any case of letters."""
    used, out = {x.lower() for x in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` mentions it, also within lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def zero_of(column: Column) -> Column:
    """0 for every row, in a form that the optimizer does not fold into a constant."""
    return F.pmod(F.xxhash64(column), F.lit(1)).cast("long")


def hot_join(rows: DataFrame, keyed: DataFrame, key: str, to: str, weight: str, row_bytes: int = 64, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` left-joined to ``keyed``, a table with one row per ``to``, where ``key`` equals ``to``.

    ``weight`` tells how many rows a key has, about. A ``keyed`` of ``most_bytes`` bytes at most is broadcast. Otherwise
    keys with more than 1/HEAVY of all weight, fewer than HEAVY by their number, are broadcast alone, and their rows are
    spread evenly over the shuffle that joins the rest. The two tables share no column name.
    """
    n, total = keyed.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    if n * row_bytes <= most_bytes:
        return rows.join(F.broadcast(keyed), F.col(key) == F.col(to), "left")
    heavy = F.col(weight) * HEAVY > total
    names = dict(zip(keyed.columns, free([*rows.columns, *keyed.columns], *(f"hot_{c}" for c in keyed.columns)), strict=True))
    hot = keyed.filter(heavy).withColumnsRenamed(names)
    zero, salt = free([*rows.columns, *keyed.columns, *names.values()], "zero", "salt")
    out = rows.join(F.broadcast(hot), F.col(key) == F.col(names[to]), "left")
    out = out.withColumn(salt, F.when(F.col(names[to]).isNull(), F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id() + 1))
    cold = keyed.filter(~heavy).withColumn(zero, zero_of(F.col(to)))
    out = out.join(cold, (F.col(key) == F.col(to)) & (F.col(salt) == F.col(zero)), "left")
    return out.select(*rows.columns, *(F.coalesce(names[c], c).alias(c) for c in keyed.columns))


def apart(rows: DataFrame, to: str, most: int = 1_000_000) -> DataFrame:
    """Tells equal rows apart: ``to`` numbers them from 0. The result is the same however the rows are partitioned.

    Equal rows are counted, combined before they shuffle, and dealt out again, a task making ``most`` of one kind at
    most. ``rows`` needs columns of types that can be grouped.
    """
    names = rows.columns
    n, first = free([*names, to], "n", "first")
    counted = cut(rows.groupBy(*names).agg(F.count("*").alias(n)))
    few = counted.filter(F.col(n) <= most).withColumn(first, F.lit(0).cast("long"))
    many = counted.filter(F.col(n) > most).withColumn(first, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(most).cast("long")))).repartition(first)
    return few.unionByName(many).withColumn(to, F.explode(F.sequence(F.col(first), F.least(F.col(first) + most, F.col(n)) - 1))).select(*names, to)


def scanned(rows: DataFrame, order: list[str], sums: dict[str, Column], within: tuple[str, ...] = ()) -> DataFrame:
    """Adds running sums over the rows before each row: ``sums`` tells the new columns and what they add up.

    Rows are ordered by ``order``, which no two may share, and sums start anew in each group of ``within``. Rows fall into
    ranges of that order, are summed up within each and start at the sum of the ranges before, so neither a hot group nor
    the whole table passes through one task. Sums of integers and decimals are exact, however the rows fall.
    """
    piece, *parts = free([*rows.columns, *sums], "piece", *(f"at_{x}" for x in sums))
    key = free([*rows.columns, *sums, piece, *parts], *(f"of_{x}" for x in (*within, piece)))
    ranged = cut(rows.select("*", *(c.alias(x) for c, x in zip(sums.values(), parts, strict=True))).repartitionByRange(*within, *order).withColumn(piece, F.spark_partition_id()))
    before = Window.partitionBy(*within).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*within, piece).agg(*(F.sum(x).alias(x) for x in parts))
    starts = starts.select(*(F.col(c).alias(k) for c, k in zip((*within, piece), key, strict=True)), *(F.sum(x).over(before).alias(to) for x, to in zip(parts, sums, strict=True)))
    inside = Window.partitionBy(*within, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = ranged.select(*rows.columns, piece, *(F.sum(x).over(inside).alias(x) for x in parts))
    same = F.lit(True)
    for c, k in zip((*within, piece), key, strict=True):
        same &= F.col(c).eqNullSafe(F.col(k)) if c != piece else F.col(c) == F.col(k)
    zero = F.lit(0)
    return here.join(starts, same, "left").select(*rows.columns, *((F.coalesce(x, zero) + F.coalesce(to, zero)).alias(to) for x, to in zip(parts, sums, strict=True)))


def by_value(module: str) -> None:
    """Sends the Python functions of a module to the executors whole, which then need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def whole(text: Column) -> Column:
    """Null texts count as empty."""
    return F.coalesce(text, F.lit(""))


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def kept(name: str, make: Callable):
    """What ``make`` returns, once per Python worker: a worker runs one task after the other and keeps its caches."""
    store = vars(sys.modules.setdefault("_demandpanel_kept", types.ModuleType("_demandpanel_kept")))
    if name not in store:
        store[name] = make()
    return store[name]


by_value(__name__)

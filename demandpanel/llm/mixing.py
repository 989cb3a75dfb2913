"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.common import apart, cut, free, hot_join, quoted, read, scanned, whole

#: Sources in order of their names weigh so, over and over.
WEIGHTS = (3, 1, 2)
#: The mix has SHARE times all words; of no source more than MOST times its own.
SHARE, MOST = 1.5, 2
#: Expected copies are whole numbers of this unit, so that sums of them are exact.
UNIT = 1 << 40


def words(text: Column) -> Column:
    """Runs of anything but spaces and ASCII control gaps."""
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]++")).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Each source's target: ``sources`` (``no_source``, ``source``, ``source_size``) plus ``weight`` and ``target``.

    Sources in order of their names (null last) take the weights in turn. ``share`` of all sizes is dealt out by weight;
    targets stop at ``most`` times their source's size and what lies above is dealt out again among the others, until none
    is above. So there is one level that all others share: target = min(most * size, level * weight). Sources are ordered by
    the level at which they are full, and the first one that is not, given that all before it are, tells it. Both
    orders are :func:`~demandpanel.llm.common.scanned`, so sources may be as many as documents.
    """
    ranked = scanned(sources, ["no_source", "source"], {"rank": F.lit(1).cast("long")})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights)).cast("int") + 1).cast("long")
    rows = ranked.withColumn("weight", weight).withColumn("full", F.col("source_size") / F.col("weight"))
    rows = cut(scanned(rows, ["full", "rank"], {"sizes": F.col("source_size"), "weights": F.col("weight")}))
    size, weight = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast("long"), F.coalesce(F.sum("weight"), F.lit(0)).cast("long")).first()
    level = (F.lit(float(share)) * size - F.lit(float(most)) * F.col("sizes")) / (F.lit(weight) - F.col("weights"))
    open_ = F.lit(float(most)) * F.col("source_size") >= level * F.col("weight")
    found = rows.filter(open_).agg(F.min_by(level, F.struct("full", "rank"))).first()[0]
    cap = F.lit(float(most)) * F.col("source_size")
    return rows.select("no_source", "source", "source_size", "weight", (cap if found is None else F.least(cap, F.lit(found) * F.col("weight"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = "", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """How often each document is in a mix of its sources: the id, ``source``, ``text_key``, ``size``, ``source_size``, ``target``, ``copies``.

    A document's size is its number of words; :func:`targets` says how many words of each source the mix has. Every document
    of a source expects target / size-of-source copies. Within its source, documents stand in order of size, so that
    neighbours are alike and the words taken stay near the target: expected copies are added up along that order, one
    random offset (from ``seed`` and the source's name) is added, and a document is emitted once for each whole number that the
    sum crosses at it. So it has the next lower or the next higher whole number of its expected copies, and no more than ``most``; a source's copies
    differ from their expectation by less than one, its words by less than its longest document.

    Sums are exact whole numbers (see ``UNIT``) over a :func:`~demandpanel.llm.common.scanned` order, so a hot source is spread over many tasks and
    the same rows give the same mix however they are partitioned. Texts are measured and hashed where they are read and move no
    further. A null text has no words, a null source is a source of its own, null and tied ids are ids like any other; repeated
    rows are told apart by a number and drawn one by one. A source without words has target 0. An empty table gives an empty
    result; other columns are not looked at, whatever their names.
    """
    text, source = whole(quoted(text_col)), quoted(source_col).cast("string")
    # rows that are equal here are drawn alike, so they need not be told apart by their other columns
    rows = docs.select(source.isNull().alias("no_source"), F.coalesce(source, F.lit("")).alias("source"), quoted(id_col).alias("id"), words(text).alias("size"), F.xxhash64(text).alias("text_key"))
    rows = apart(rows, "copy")
    sources = cut(rows.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    goal = cut(targets(sources.drop("n"), weights, share, most))
    # 40 bits of a digest that other engines have too
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("no_source").cast("string"), F.lit(":"), F.col("source"))), 1, 10), 16, 10).cast("long")
    each = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size") * F.lit(float(UNIT)))).cast("long")
    known = goal.join(sources.withColumnsRenamed({"no_source": "none", "source": "named", "source_size": "size_"}), (F.col("no_source") == F.col("none")) & (F.col("source") == F.col("named")))
    known = cut(known.select(F.struct("no_source", "source").alias("to"), "n", "source_size", "target", each.alias("each"), offset.alias("offset")))
    at = hot_join(rows.withColumn("at", F.struct("no_source", "source")), known, "at", "to", "n", row_bytes=128)
    at = scanned(at.drop("at", "to", "n"), ["size", "id", "text_key", "copy"], {"before": F.col("each").cast("decimal(38,0)")}, within=("no_source", "source"))
    crossed = lambda x: F.call_function("div", x, F.lit(UNIT))
    start = F.col("before") + F.col("offset")
    return at.select(F.col("id").alias(id_col), F.when(~F.col("no_source"), F.col("source")).alias("source"), "text_key", "size", "source_size", "target", (crossed(start + F.col("each")) - crossed(start)).cast("int").alias("copies"))


def emit(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: the rows of ``docs``, with all their columns, as often as ``mixed`` (of :func:`mix`) says.

    Rows of the same id, source and text are one document that is stored several times: one of them is emitted as often as
    all of them are drawn. Texts move in one join on their keys, which hot documents stay out of.
    """
    row, key, same, n, total, turn = free([], "row", "key", "same", "n", "total", "turn")
    drawn = mixed.groupBy(F.struct(quoted(id_col).alias("id"), F.col("source"), F.col("text_key")).alias(same)).agg(F.count("*").alias(n), F.sum("copies").alias(total))
    rows = docs.select(F.struct(*(quoted(c) for c in docs.columns)).alias(row), F.struct(quoted(id_col).alias("id"), quoted(source_col).cast("string").alias("source"), F.xxhash64(whole(quoted(text_col))).alias("text_key")).alias(key))
    rows = hot_join(rows, cut(drawn), key, same, n).filter(F.col(total) > 0)
    once = rows.filter(F.col(n) > 1).groupBy(key).agg(F.first(row).alias(row), F.first(total).alias(total))
    out = rows.filter(F.col(n) == 1).select(row, total).unionByName(once.select(row, total))
    out = out.select(row, F.explode(F.sequence(F.lit(1).cast("long"), F.col(total))).alias(turn))
    return out.select(*(F.col(row).getField(c).alias(c) for c in docs.columns))


def op11_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP11_SQL = f"""
WITH d AS (
    SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS rank
    FROM d GROUP BY source
), p AS (
    SELECT *, ({SHARE}::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE - {MOST}::DOUBLE * coalesce(sum(source_size) OVER before, 0)::DOUBLE) / ((SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
    FROM s WINDOW before AS (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
    SELECT level FROM p WHERE {MOST}::DOUBLE * source_size >= level * weight ORDER BY source_size::DOUBLE / weight, rank LIMIT 1
), g AS (
    SELECT source, source_size, least({MOST}::DOUBLE * source_size, coalesce((SELECT level FROM l), 'inf'::DOUBLE) * weight) AS target,
           CAST('0x' || substr(md5((source IS NULL)::VARCHAR || ':' || coalesce(source, '')), 1, 10) AS BIGINT) AS start
    FROM s
), e AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size * {UNIT}::DOUBLE) AS BIGINT) END AS each FROM g
), b AS (
    SELECT doc_id, size, source_size, target, each, start + coalesce(sum(each) OVER (PARTITION BY d.source ORDER BY size, doc_id, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target, CAST(size * ((before + each) // {UNIT} - before // {UNIT}) AS BIGINT) AS taken FROM b
"""

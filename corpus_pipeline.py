"""From raw documents to packed sequences in five stages, each a table.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandpanel.llm import common, decontaminate, line_dedup, near_dedup, packing, toxicity


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one more column, of a name that none of its columns has: a string that names a row by its id and text."""
    (name,) = common.free(docs.columns, "name")
    return docs.withColumn(name, _name(common.quoted("doc_id"), F.xxhash64(common.quoted("text")))), name


def _name(doc_id: Column, check: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), doc_id.isNull().cast("int"), check)


def _without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``found`` (``doc_id``, ``check``) doesn't name. Few enough names are broadcast, so that no text is
    shuffled; otherwise they are joined, and the rows of a name that very many have are spread."""
    rows, name = _named(docs)
    drop, n = common.free(rows.columns, "drop", "n")
    names = common.cut(found.groupBy(_name(F.col("doc_id"), F.col("check")).alias(drop)).agg(F.count("*").alias(n)))
    return common.hot_join(rows, names, name, drop, n).filter(F.col(drop).isNull()).select(*(common.quoted(c) for c in docs.columns))


def _once(docs: DataFrame) -> DataFrame:
    """One row, the least, of all with the same ``doc_id`` and text; ids may be null. Only repeated rows move, and a hot key's rows
    are reduced within each partition before they do."""
    rows, name = _named(docs)
    again, n = common.free(rows.columns, "again", "n")
    names = common.cut(rows.groupBy(F.col(name).alias(again)).agg(F.count("*").alias(n)).filter(F.col(n) > 1))
    if not names.limit(1).count():
        return docs
    marked = common.hot_join(rows, names, name, again, n)
    columns = [common.quoted(c) for c in docs.columns]
    repeated = marked.filter(F.col(again).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.min(F.struct(*columns)).alias("row"))
    return marked.filter(F.col(again).isNull()).select(*columns).unionByName(repeated.select(*(F.col("row").getField(c).alias(c) for c in docs.columns)))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of 0.5 or more, by a model fitted on all labels."""
    model = toxicity.fit(docs, common.read(spark, sf_dir, "labels"))
    return _without(docs, toxicity.score(docs, model).filter("score >= 0.5"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops each source's boilerplate lines; every document stays. Pages of the same text count once, since copies are still
    there at this stage and their own text is no boilerplate."""
    columns = [common.quoted(c) for c in docs.columns]
    (row,) = common.free(docs.columns, "row")
    clean = line_dedup.line_dedup(docs.select(F.struct(*columns).alias(row), "doc_id", "source", "text"), mirrors=True)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.select(*(new.get(c, F.col(row).getField(c)).alias(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates, the one with the least id, once."""
    return _once(_without(docs, near_dedup.near_dedup(docs).filter(~F.col("kept"))))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return _without(docs, decontaminate.decontaminate(docs, common.read(spark, sf_dir, "benchmark")).filter("n_hit > 0"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_near_copies), ("decontamination", drop_benchmark), ("packing", pack)]

#: Scores, similarity search and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

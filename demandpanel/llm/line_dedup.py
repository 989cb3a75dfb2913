"""Boilerplate lines of a site, by the share of its pages that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.common import cut, free, hot_join, let, quoted, read, whole

#: Most bytes of line keys that are sent to every executor; beyond it the join shuffles.
BROADCAST_BYTES = 16_000_000
#: Boilerplate is a line whose share of its host's pages exceeds MAX_RATIO at the lower end of a one-sided 95 % interval (Z95). Measured
#: on the largest table: boilerplate has 11 to 13 % of each source's pages, any other line 3.9 % at most.
MAX_RATIO, Z95 = 0.045, 1.645
#: In that shuffle a host with more than 1/HEAVY of all documents is hot, and split into pieces of about that size.
HEAVY = 1000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """128 bits of a line, in two numbers."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))


def exceeds(pages: Column, host_pages: Column, max_ratio: float) -> Column:
    """Whether the lower end of the share's interval lies above ``max_ratio``: one law for hosts of every size.

    This is Wilson's interval, stated as the test that it inverts: more pages than ``max_ratio`` of the host's, by Z95 standard
    deviations of what a line of just that share would have.
    """
    return pages > F.lit(max_ratio) * host_pages + F.lit(Z95) * F.sqrt(F.lit(max_ratio * (1 - max_ratio)) * host_pages)


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO, mirrors: bool = False) -> DataFrame:
    """Lines that surely more than ``max_ratio`` of a host's pages hold: ``host``, ``no_host``, ``line_key``, ``pages``, ``host_pages``.

    The pages of a host that hold a line, each counted once, are divided by all pages of that host (see :func:`exceeds`). A
    line on one page alone repeats nowhere and is never boilerplate, nor is the empty line. With ``mirrors`` pages of a
    host with the same whole text count as one page, so that a page that is copied many times does not turn its own body
    into boilerplate. A null host is a host of its own.
    """
    text, host = whole(quoted(text_col)), quoted(host_col)
    pages = docs.select(F.coalesce(host.cast("string"), F.lit("")).alias("host"), host.isNull().alias("no_host"), *([F.xxhash64(text, F.lit(3)).alias("page")] if mirrors else []), text.alias("text"))
    # the host's own row has the empty key's place: one pass counts lines and pages
    keys = F.concat(F.array(F.lit(None).cast("struct<a:bigint,b:bigint>")), F.transform(F.filter(F.array_distinct(_lines(F.col("text"))), lambda x: x != ""), _key))
    by = ["host", "no_host", "line_key"]
    seen = pages.select("host", "no_host", *(["page"] if mirrors else []), F.explode(keys).alias("line_key"))
    if mirrors:
        seen = seen.groupBy(*by, "page").agg(F.lit(1).alias("one"))
    counts = cut(seen.groupBy(*by).agg(F.count("*").alias("pages")).filter((F.col("pages") > 1) | F.col("line_key").isNull()))
    at = F.struct("host", "no_host")
    total = counts.filter(F.col("line_key").isNull()).select(at.alias("of"), F.col("pages").alias("host_pages"))
    # a host of very many pages has very many lines
    lines = hot_join(counts.filter(F.col("line_key").isNotNull()).withColumn("at", at), total, "at", "of", "host_pages")
    return lines.filter(exceeds(F.col("pages"), F.col("host_pages"), max_ratio)).select("host", "no_host", "line_key", "pages", "host_pages")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO, mirrors: bool = False, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Drops each host's boilerplate lines (see :func:`boilerplate`) from its documents.

    Returns every input column, unchanged but for the text, plus ``n_lines`` and ``n_dropped`` (which replace columns of
    those names). A null text has no lines and stays null; a document may end up empty and stays. Texts of any length are
    read whole. A host has at most (lines a page) / max_ratio boilerplate lines, so its list fits one row. Ties and
    repeated rows need no rule, since each row is cleaned by itself. An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    row, host, none, salt, spread = free([], "row", "row_host", "row_none", "row_salt", "row_spread")
    per_host = cut(boilerplate(docs, host_col, text_col, max_ratio, mirrors).groupBy("host", "no_host").agg(F.collect_list("line_key").alias("drop")))
    size = per_host.agg(F.coalesce(F.sum(F.size("drop") * 24 + 64), F.lit(0))).first()[0]
    # the user's columns stand in one struct, where none of them can be taken for one of these
    rows = docs.select(F.struct(*(quoted(c) for c in kept)).alias(row), quoted(text_col).alias("text"), F.coalesce(quoted(host_col).cast("string"), F.lit("")).alias(host), quoted(host_col).isNull().alias(none), F.xxhash64(quoted(id_col), quoted(text_col)).alias(spread))
    same = (F.col(host) == F.col("host")) & (F.col(none) == F.col("no_host"))
    if size <= broadcast_bytes:
        joined = rows.join(F.broadcast(per_host), same, "left")
    else:
        # the names of hot hosts, fewer than HEAVY, tell how many pieces their documents fall into; other hosts have one
        sizes = rows.groupBy(F.col(host).alias("big_host"), F.col(none).alias("big_none")).count()
        total = sizes.agg(F.sum("count")).scalar()
        big = cut(sizes.select("big_host", "big_none", F.ceil(F.col("count") * HEAVY / total).cast("int").alias("pieces")).filter("pieces > 1"))
        pieces = F.coalesce("pieces", F.lit(1))
        is_big = lambda h, n: (F.col(h) == F.col("big_host")) & (F.col(n) == F.col("big_none"))
        salted = per_host.join(F.broadcast(big), is_big("host", "no_host"), "left").select("host", "no_host", "drop", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("salt"))
        dealt = rows.join(F.broadcast(big), is_big(host, none), "left").withColumn(salt, F.pmod(F.col(spread), pieces).cast("int")).drop("big_host", "big_none", "pieces")
        joined = dealt.join(salted, same & (F.col(salt) == F.col("salt")), "left")
    lines = _lines(F.col("text"))
    # of the host's list only what this text may hold is compared line by line
    held = F.array_intersect(F.transform(lines, lambda x: F.xxhash64(x)), F.transform("drop", lambda k: k["a"]))
    few = F.filter("drop", lambda k: F.array_contains(F.col("held"), k["a"]))
    joined = joined.withColumn("held", F.when(F.col("drop").isNotNull(), held))
    clean = F.when(F.size(F.coalesce("held", F.array().cast("array<bigint>"))) == 0, lines).otherwise(let(few, lambda some: F.filter(lines, lambda x: ~F.array_contains(some, _key(x)))))
    out = joined.select(row, "text", F.size(lines).alias("n"), clean.alias("clean"))
    field = lambda c: F.col(row).getField(c).alias(c)
    null = F.col("text").isNull()
    return out.select(
        *(F.array_join("clean", "\n").alias(c) if c == text_col else field(c) for c in kept),
        F.when(null, 0).otherwise(F.col("n")).cast("long").alias("n_lines"),
        F.when(null, 0).otherwise(F.col("n") - F.size("clean")).cast("long").alias("n_dropped"),
    )


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "n_lines", "n_dropped", "text")


def op7_line_dedup_by_rate(spark, sf_dir: str) -> DataFrame:
    """With mirrored pages counted once."""
    return line_dedup(read(spark, sf_dir, "documents").select("doc_id", "source", "text"), mirrors=True).select("doc_id", "n_lines", "n_dropped", "text")


#: {docs} stands for the table that is cleaned, {pages} for what is counted.
LINE_SQL = f"""
SELECT d.*, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines,
       coalesce(len(string_split(d.text, chr(10))) - len(list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(coalesce(b.bad, []), x))), 0) AS n_dropped,
       array_to_string(list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(coalesce(b.bad, []), x)), chr(10)) AS clean
FROM {{docs}} d LEFT JOIN (
    SELECT source, list(line) AS bad
    FROM (SELECT source, line, count(*) AS pages
          FROM (SELECT source, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM {{pages}})
          WHERE line <> '' GROUP BY ALL)
    JOIN (SELECT source AS host, count(*) AS total FROM {{pages}} GROUP BY ALL) ON source IS NOT DISTINCT FROM host
    WHERE pages >= 2 AND pages > CAST({MAX_RATIO} AS DOUBLE) * total + CAST({Z95} AS DOUBLE) * sqrt(CAST({MAX_RATIO * (1 - MAX_RATIO)} AS DOUBLE) * total)
    GROUP BY ALL) b ON d.source IS NOT DISTINCT FROM b.source
"""

OP7_SQL = f"SELECT doc_id, n_lines, n_dropped, clean AS text FROM ({LINE_SQL.format(docs='documents', pages='documents')})"
DISTINCT_PAGES = "(SELECT DISTINCT source, coalesce(text, '') AS text FROM documents)"
OP7_BY_RATE_SQL = f"SELECT doc_id, n_lines, n_dropped, clean AS text FROM ({LINE_SQL.format(docs='documents', pages=DISTINCT_PAGES)})"

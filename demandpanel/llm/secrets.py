"""Secrets in text: patterns, and how many owners hold each found value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.common import cut, hot_join, let, quoted, read, whole

# The base patterns, least lengths and order of kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "live")

#: Further credential shapes, looked up among the owners only: any run of 20 or more token characters.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
#: A value in so many repositories of so many owners, copies of one text counted once, is a widely copied example.
WIDELY = (10, 3)
#: Matches that one fold takes. A fold copies what it has found at each step, so a long text's matches are folded in blocks.
FOLD = 256
SPANS = "array<struct<m:string,s:bigint,e:bigint>>"
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|0123456|123456789|abcdef0|0{8}|1{8}|a{8}"


def spans(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as array of (match, start, end); positions count code points from 0.

    The pieces between the matches come from a split by the same pattern, so the running length of pieces and matches
    gives the positions: within blocks of FOLD matches first, then over the blocks. Each pattern runs three times over the
    text, however many matches it has, and
    one search passes over texts without any.
    """
    none = F.array().cast(SPANS)

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + F.length(x["p"])
        end = at + F.length(x["m"])
        return F.struct(end.cast("bigint").alias("at"), F.concat(acc["out"], F.array(F.struct(x["m"].alias("m"), at.cast("bigint").alias("s"), end.cast("bigint").alias("e")))).alias("out"))

    def block(all_of: Column, k: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))
        return F.aggregate(F.slice(all_of, k * FOLD + 1, F.lit(FOLD)), start, step)

    def shifted(blocks: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
        starts = F.aggregate(blocks, start, lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, starts, lambda x, at: F.transform(x["out"], lambda y: F.struct(y["m"].alias("m"), (y["s"] + at).alias("s"), (y["e"] + at).alias("e")))))

    def every(matches: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.call_function("div", F.size(matches) - 1, F.lit(FOLD)).cast("int"))
        return F.when(F.size(matches) > 0, let(F.transform(numbers, lambda k: block(matches, k)), shifted)).otherwise(none)

    # the last piece has no match after it
    zipped = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    found = let(let(zipped, lambda z: F.slice(z, F.lit(1), F.size(z) - 1)), every)
    return F.when(text.rlike(pattern), found).otherwise(none)


def _named(spans_col: Column, kind: str) -> Column:
    return F.transform(spans_col, lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e")))


def _joined(array: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(array), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the spans of :func:`spans`; those of ``assign`` carry their value (group 2) as the match."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    with_value = F.zip_with(spans(text, ASSIGN), values, lambda x, v: F.struct(v.alias("m"), x["s"].alias("s"), x["e"].alias("e")))
    return {
        "assign": F.when(text.rlike(ASSIGN), F.filter(with_value, lambda x: F.length(x["m"]) >= ASSIGN_LEAST)).otherwise(F.array().cast(SPANS)),
        "access": spans(text, ACCESS),
        "hex": spans(text, HEX),
    }


def ownership(candidates: DataFrame) -> DataFrame:
    """Of rows (``value``, ``text_hash``, ``repo``, ``owner``): ``digest``, the distinct holders of each value (``n_repos``,
    ``n_owners``) and ``n_held``, the number of rows.

    All copies of one text count as its first holder alone, the least owner and then repository. Counted in four
    aggregations, each combined before it shuffles: (value, text), (value, owner, repository), (value, owner), value. A
    value that a third of all rows hold is spread by its texts, repositories and owners first.
    """
    first = F.min(F.struct("owner", "repo")).alias("h")
    texts = candidates.groupBy(F.unhex(F.sha2("value", 256)).alias("digest"), "text_hash").agg(first, F.count("*").alias("n_held"))
    held = F.sum("n_held").alias("n_held")
    repos = texts.groupBy("digest", F.col("h.owner").alias("owner"), F.col("h.repo").alias("repo")).agg(held)
    owners = repos.groupBy("digest", "owner").agg(F.count("*").alias("n"), held)
    return owners.groupBy("digest").agg(F.sum("n").alias("n_repos"), F.count("*").alias("n_owners"), held)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None, widely: tuple[int, int] = WIDELY) -> DataFrame:
    """Finds secrets and judges them by their spread over the corpus.

    The base patterns give the kinds assign, access and hex. The candidates are their values and all further runs of
    token characters that mix letters and digits. Each candidate's hash is counted over distinct repositories
    (``repo_col``, the document where there is none) and owners of the whole corpus, where all copies of one text count
    as one holder. Values that reach both counts of ``widely`` (repositories, owners) are copied examples, and only
    counted. Others that don't look like placeholders are live: they get a span of kind ``live`` besides their base span.

    Returns the id, ``n_assign``, ``n_access``, ``n_hex``, ``base_spans``, ``spans`` (strings kind:start:end by start,
    then kind), ``n_live``, ``n_example``, ``n_repos`` and ``n_owners`` (the greatest among the row's candidates, 0 without
    any) and ``spread`` (strings start:end:n_repos:n_owners of all candidates by start, then end).

    A null text counts as empty and a null owner or repository as one of its own, with empty name. Texts of any length
    are searched whole, in time that grows with their length. Rows with the same id and text get the same result, once
    each; ties have no effect, since counts alone decide. An empty table gives an empty result. Other columns are not looked
    at, whatever their names.
    """
    text = whole(quoted(text_col))
    owner = F.coalesce(quoted(owner_col).cast("string"), F.lit("")) if owner_col in docs.columns else F.lit("")
    repo = F.coalesce(quoted(repo_col or id_col).cast("string"), F.lit(""))
    rows = docs.select(quoted(id_col).alias("id"), text.alias("text"), owner.alias("owner"), repo.alias("repo"))
    rows = rows.withColumns({**base_spans(F.col("text")), "token": spans(F.col("text"), TOKEN)})
    token = F.filter("token", lambda x: x["m"].rlike("[0-9]") & x["m"].rlike("[A-Za-z]"))
    assigned = F.transform("assign", lambda x: F.struct(x["m"].alias("m"), (x["e"] - F.length(x["m"])).cast("bigint").alias("s"), x["e"].alias("e")))
    rows = rows.select(
        "id",
        "owner",
        "repo",
        F.xxhash64("text").alias("text_hash"),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.concat(*(_named(F.col(k), k) for k in KINDS[:3])).alias("base"),
        F.concat(assigned, F.col("access"), F.col("hex"), token).alias("values"),
    )
    # within this table a row has a number of its own, so what is found joins back without a hot key
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    some = rows.filter(F.size("values") > 0)
    held = some.select("row", "text_hash", "owner", "repo", F.explode("values").alias("v")).select("row", "text_hash", "owner", "repo", F.col("v.m").alias("value"), F.col("v.s").alias("s"), F.col("v.e").alias("e"))
    spread = cut(ownership(held))
    judged = hot_join(held.withColumn("of", F.unhex(F.sha2("value", 256))), spread, "of", "digest", "n_held")
    example = (F.col("n_repos") >= widely[0]) & (F.col("n_owners") >= widely[1])
    live = ~example & ~F.col("value").rlike(PLACEHOLDER)
    span = F.struct(F.col("s"), F.lit(KINDS.index("live")).alias("k"), F.col("e"))
    per_row = judged.groupBy(F.col("row").alias("found")).agg(
        F.collect_set(F.when(live, span)).alias("live"),
        F.count_distinct(F.when(example, F.col("of"))).alias("n_example"),
        F.max("n_repos").alias("n_repos"),
        F.max("n_owners").alias("n_owners"),
        F.collect_set(F.struct("s", "e", "n_repos", "n_owners")).alias("spread"),
    )
    # rows without a candidate take no part in the join
    joined = some.join(per_row, F.col("row") == F.col("found"))
    texts = F.transform(F.array_sort("spread"), lambda x: F.concat_ws(":", x["s"], x["e"], x["n_repos"], x["n_owners"]))
    result = ["id", *(f"n_{k}" for k in KINDS[:3]), "base"]
    out = joined.select(*result, "live", "n_example", "n_repos", "n_owners", F.array_join(texts, ",").alias("spread"))
    zero = F.lit(0).cast("long")
    none = rows.filter(F.size("values") == 0).select(*result, F.filter("base", lambda x: F.lit(False)).alias("live"), zero.alias("n_example"), zero.alias("n_repos"), zero.alias("n_owners"), F.lit("").alias("spread"))
    return out.unionByName(none).select(
        F.col("id").alias(id_col),
        *(f"n_{k}" for k in KINDS[:3]),
        _joined(F.col("base")).alias("base_spans"),
        _joined(F.concat("base", "live")).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        "n_example",
        "n_repos",
        "n_owners",
        "spread",
    )


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    return secrets(read(spark, sf_dir, "documents")).withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans", "spread")


def op5_secret_scan_by_spread(spark, sf_dir: str) -> DataFrame:
    """With the spread of each candidate."""
    return secrets(read(spark, sf_dir, "documents")).withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


def _sql(with_spread: bool = False) -> str:
    q = lambda r: "'" + r.replace("'", "''") + "'"
    found = " UNION ALL ".join(
        f"SELECT rid, o, r, t, '{kind}' AS kind, {k} AS ord, m, v, p FROM (SELECT rid, o, r, t, regexp_extract_all(t, {q(p)}) AS m, regexp_extract_all(t, {q(p)}, {g}) AS v, string_split_regex(t, {q(p)}) AS p FROM d)"
        for k, (kind, p, g) in enumerate((("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("token", TOKEN, 0)))
    )
    total = lambda x: f"coalesce(list_sum(list_transform({x}, lambda c: length(c))), 0)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS o, coalesce(CAST(doc_id AS VARCHAR), '') AS r, coalesce(text, '') AS t FROM documents),
f AS ({found}),
w AS (SELECT rid, o, r, t, kind, ord, unnest(range(1, len(m) + 1)) AS i, m, v, p FROM f WHERE len(m) > 0),
s AS (SELECT * FROM (SELECT rid, o, r, t, kind, ord, v[i] AS value, {total('p[1:i]')} + {total('m[1:i-1]')} AS a, {total('p[1:i]')} + {total('m[1:i]')} AS e FROM w)
  WHERE CASE kind WHEN 'assign' THEN length(value) >= {ASSIGN_LEAST} WHEN 'token' THEN regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') ELSE true END),
c AS (SELECT DISTINCT rid, o, r, t, value, CASE kind WHEN 'assign' THEN e - length(value) ELSE a END AS a, e FROM s),
h AS (SELECT value, t, min((o, r)) AS holder FROM c GROUP BY ALL),
n AS (SELECT value, count(DISTINCT holder) AS repos, count(DISTINCT holder[1]) AS owners FROM h GROUP BY ALL),
j AS (SELECT c.*, repos, owners, repos >= {WIDELY[0]} AND owners >= {WIDELY[1]} AS example FROM c JOIN n USING (value)),
l AS (SELECT *, NOT example AND NOT regexp_matches(value, {q(PLACEHOLDER)}) AS live FROM j),
x AS (SELECT rid, count(DISTINCT CASE WHEN live THEN (a, e) END) AS n_live, count(DISTINCT CASE WHEN example THEN value END) AS n_example, max(repos) AS n_repos, max(owners) AS n_owners FROM l GROUP BY ALL),
b AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, ord) AS base FROM s WHERE kind <> 'token' GROUP BY ALL),
g AS (SELECT rid, string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, ord, e) AS spans FROM (SELECT rid, kind, ord, a, e FROM s WHERE kind <> 'token' UNION ALL SELECT DISTINCT rid, 'live', 3, a, e FROM l WHERE live) GROUP BY ALL),
y AS (SELECT rid, string_agg(concat_ws(':', a, e, repos, owners), ',' ORDER BY a, e, repos, owners) AS spread FROM (SELECT DISTINCT rid, a, e, repos, owners FROM l) GROUP BY ALL)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(n_repos, 0) AS n_repos, coalesce(n_owners, 0) AS n_owners{", coalesce(spread, '') AS spread" if with_spread else ""}
FROM d LEFT JOIN b USING (rid) LEFT JOIN g USING (rid) LEFT JOIN x USING (rid) LEFT JOIN y USING (rid)"""


OP5_SQL, OP5_BY_SPREAD_SQL = _sql(), _sql(with_spread=True)

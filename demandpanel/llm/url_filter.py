"""URL filtering by stated rules and by association rules mined from labels."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.common import BROADCAST_BYTES, HEAVY, cut, hot_join, quoted, read

# The stated rules as (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

#: A combination of tokens is mined if so many labelled URLs, and this share of them, have it. A rule blocks if this share of its
#: URLs is labelled so, by this multiple more than of all, and more often than not also at the lower end of a 95 % interval.
MIN_COUNT, MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT, LEAST_SURE, Z95 = 5, 0.002, 0.6, 1.2, 0.5, 1.96
#: FP-growth mines baskets of so many frequent tokens at most, which have 2^MOST_TOKENS combinations. Where one has more, combinations are grown token
#: by token instead, which leaves out those that no rule can come of.
MOST_TOKENS = 12


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty where there is none."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def stated(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits. A rule fits its host and all subdomains."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule = F.when(fits, F.lit(at + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """The set of a URL's tokens: host labels and their suffixes, path steps, file endings, query keys and values; digits as #."""
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    steps = F.filter(F.split(path, "[/]"), lambda x: x != "")
    query = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: x != "")
    plain = lambda x: F.regexp_replace(x, "[0-9]+", "#")
    kinds = [
        F.transform(labels, lambda x: F.concat(F.lit("h:"), plain(x))),
        F.when(host != "", F.array(F.concat(F.lit("d:"), F.substring_index(host, ".", -2)), F.concat(F.lit("s:"), host))).otherwise(F.array().cast("array<string>")),
        F.transform(steps, lambda x: F.concat(F.lit("p:"), plain(x))),
        F.transform(query, lambda x: F.concat(F.lit("q:"), plain(x))),
        F.when(F.contains(url, F.lit("#")), F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>")),
        F.when(url.startswith("http:"), F.array(F.lit("c:http"))).otherwise(F.array().cast("array<string>")),
    ]
    return F.coalesce(F.array_distinct(F.concat(*kinds)), F.array().cast("array<string>"))


def alike(baskets: DataFrame) -> DataFrame:
    """The tokens of rows (``basket``, ``items``) that stand in the very same baskets as another, each beside the one that
    stands for them (``token``, ``stands``), the first by name. All of them together would multiply the combinations."""
    each = baskets.select("basket", F.explode("items").alias("token"))
    sums = [F.sum(F.xxhash64("basket", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)]
    seen = each.groupBy("token").agg(F.count("*").alias("n"), *sums)
    first = seen.groupBy("n", "s1", "s2").agg(F.min("token").alias("stands"), F.count("*").alias("many")).filter("many > 1")
    return seen.join(first, ["n", "s1", "s2"]).filter("token <> stands").select("token", "stands")


def _lower(p: Column, m: Column) -> Column:
    """Lower end of the 95 % interval (Wilson) of a share of m."""
    return (p + Z95**2 / (2 * m) - Z95 * F.sqrt(p * (1 - p) / m + Z95**2 / (4 * m * m))) / (1 + Z95**2 / m)


def grown(baskets: DataFrame, least: float, least_sure: float) -> DataFrame:
    """Combinations of tokens (``asked``, sorted) that at least ``least`` blocked rows (``basket``, ``items``, ``block``) hold, all that a rule can come of.

    Level by level: a combination grows by each token of its rows behind its last one. What holds in the same rows as a part of it says no
    more than that part, nor does anything wider; nor does what is wider than a combination of blocked rows alone, or than one of too few
    rows to be sure even if all were blocked. Only these end a branch, so nothing that could be a rule is left out, however long the URLs.
    """
    each = baskets.select("basket", "block", F.explode("items").alias("token"))
    held, before, behind, levels = each.select("basket", "block", F.array("token").alias("asked")), None, None, []
    while True:
        seen = held.groupBy("asked").agg(F.count("*").alias("n"), F.count_if("block").alias("n_block")).filter(F.col("n_block") >= least - 1e-6)
        if before is not None:
            # every part that lacks one token must have been open, and in more rows
            part = F.transform(F.sequence(F.lit(1), F.size("asked")), lambda i: F.concat(F.slice("asked", F.lit(1), i - 1), F.slice("asked", i + 1, F.size("asked"))))
            parts = seen.select("asked", "n", F.explode(part).alias("part")).join(before.select(F.col("asked").alias("part"), F.col("n").alias("wide")), "part")
            whole = parts.groupBy("asked").agg(F.count("*").alias("parts"), F.min(F.col("wide") - F.col("n")).alias("fewer")).filter((F.col("parts") == F.size("asked")) & (F.col("fewer") > 0))
            seen = seen.join(whole.select("asked"), "asked", "left_semi")
        seen = cut(seen)
        levels.append(seen.select("asked"))
        sure = _lower(F.lit(1.0), F.col("n_block").cast("double")) >= least_sure
        before = cut(seen.filter((F.col("n") > F.col("n_block")) & sure))
        if before.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        held = held.join(before.select("asked"), "asked", "left_semi")
        if behind is None:
            behind = each.join(before.select(F.get("asked", F.lit(0)).alias("token")), "token", "left_semi").select("basket", "token")
        held = cut(held.join(behind, "basket").filter(F.col("token") > F.element_at("asked", -1)).select("basket", "block", F.concat("asked", F.array("token")).alias("asked")))


def holding(rows: DataFrame, anchored: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """Rows (``items``) beside each combination (``asked``) that they hold whole, looked up under its ``anchor``.

    Combinations of BROADCAST_BYTES at most are broadcast. Beyond that both sides shuffle by anchor, where tokens of more than
    1/HEAVY of the ``n`` rows, as ``counts`` (``anchor``, ``freq``) tells, are split into pieces of about that size.
    """
    each, whole = rows.withColumn("token", F.explode("items")), F.size(F.array_except("asked", "items")) == 0
    size = anchored.agg(F.coalesce(F.sum(F.length(F.array_join("asked", " ")) + 64), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        return each.join(F.broadcast(anchored), (F.col("token") == F.col("anchor")) & whole)
    hot = F.broadcast(counts.filter(F.col("freq") * HEAVY > n).select(F.col("anchor").alias("hot"), F.ceil(F.col("freq") * HEAVY / n).cast("int").alias("pieces")))
    pieces = F.coalesce("pieces", F.lit(1))
    each = each.join(hot, F.col("token") == F.col("hot"), "left").withColumn("salt", F.pmod(F.xxhash64("basket"), pieces).cast("int")).drop("hot", "pieces")
    asked = anchored.join(hot, F.col("anchor") == F.col("hot"), "left").withColumn("salt_", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("hot", "pieces")
    return each.join(asked.hint("merge"), (F.col("token") == F.col("anchor")) & (F.col("salt") == F.col("salt_")) & whole)


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, min_count: int = MIN_COUNT, least_sure: float = LEAST_SURE, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """Association rules tokens -> block from rows (``items``, ``block`` boolean): ``rule``, ``confidence``, ``support``, ``n`` and ``anchor``.

    Tokens that always stand together count as one; tokens of blocked URLs alone are proposed by themselves, as nothing wider is surer. Of the others
    Spark's FP-growth proposes the combinations that are frequent among blocked URLs, or :func:`grown` where a URL has more than
    ``most_tokens`` of them. Each proposal is then counted over all tokens of all URLs.

    A rule stays if the number of URLs with its tokens (``n``), the share of URLs that have them and are blocked
    (``support``), its confidence and lift reach their floors, if the lower end of its confidence's 95 % interval (Wilson)
    reaches ``least_sure``, and if no rule of a part of its tokens is as sure. ``anchor`` is the rarest token of the rule,
    under which the inverted index holds it.
    """
    said = cut(labelled.select(F.monotonically_increasing_id().alias("basket"), "items", "block"))
    n, blocked = said.agg(F.count("*"), F.count_if("block")).first()
    least = max(min_support * n, min_count)
    twins = cut(alike(said))
    kept = said.select("basket", "block", F.explode("items").alias("token")).join(twins.select("token"), "token", "left_anti")
    kept = cut(kept.groupBy("basket", "block").agg(F.collect_list("token").alias("items")))
    each = kept.select("basket", "block", F.explode("items").alias("token"))
    often = cut(each.groupBy("token").agg(F.count("*").alias("n"), F.count_if("block").alias("n_block")).filter(F.col("n_block") >= least - 1e-6))
    alone = often.filter("n = n_block").select(F.array("token").alias("asked"))
    # tokens repeat within few URLs or many: what moves to a hot token's row is a number
    mixed = hot_join(each, often.filter("n > n_block").select(F.col("token").alias("known"), "n"), "token", "known", "n").filter("known IS NOT NULL")
    baskets = cut(mixed.groupBy("basket", "block").agg(F.sort_array(F.collect_list("token")).alias("items")))
    if (baskets.agg(F.max(F.size("items"))).first()[0] or 0) <= most_tokens:
        # a rule's blocked URLs reach the support, so its tokens are frequent among the blocked; a hair less keeps rounding from raising it
        share = min(max((least - 1e-6) / max(blocked, 1), 1e-9), 1.0)
        # URLs without such tokens count for the share: it is one of all blocked URLs
        shown = baskets.filter("block").select("items")
        share = min(share * max(blocked, 1) / max(shown.count(), 1), 1.0)
        model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=1.0).fit(shown)
        proposed = model.freqItemsets.select(F.array_sort("items").alias("asked"))
    else:
        proposed = grown(baskets, least, least_sure)
    proposed = cut(proposed.unionByName(alone))
    # tokens of proposals are frequent, so there are few
    counts = cut(kept.select(F.explode("items").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("freq")).filter(F.col("freq") >= least - 1e-6))
    anchored = cut(proposed.withColumn("token", F.explode("asked")).join(counts, F.col("token") == F.col("anchor")).groupBy("asked").agg(F.min_by("anchor", F.struct("freq", "anchor")).alias("anchor")))
    held = holding(kept, anchored, counts, n)
    counted = held.groupBy(F.col("asked").alias("rule"), "anchor").agg(F.count("*").alias("n"), F.count_if("block").alias("n_block"))
    rules = counted.withColumns({"confidence": F.col("n_block") / F.col("n"), "support": F.col("n_block") / F.lit(max(n, 1))})
    p, m = F.col("confidence"), F.col("n").cast("double")
    lower = _lower(p, m)
    sure = (F.col("n_block") >= least - 1e-6) & (p >= min_confidence) & (p >= F.lit(min_lift * blocked / max(n, 1))) & (F.col("n") >= min_count) & (lower >= least_sure)
    rules = cut(rules.filter(sure).select("rule", "confidence", "support", "n", "anchor"))
    part = rules.select(F.col("rule").alias("part"), F.col("confidence").alias("sure"), F.get("rule", F.lit(0)).alias("first"))
    # a part of a rule has its first token in the rule: matched by token, not by all pairs
    wider = rules.withColumn("token", F.explode("rule")).join(part, (F.col("token") == F.col("first")) & (F.size("part") < F.size("rule")) & (F.col("sure") >= F.col("confidence")) & (F.size(F.array_except("part", "rule")) == 0))
    return rules.join(wider.select("rule").distinct(), "rule", "left_anti")


def url_filter(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, **mining) -> DataFrame:
    """Judges every URL by the longest stated rule that fits, else by the surest mined rule, else allows it.

    ``labels`` holds (``url``, ``block`` boolean). Each different URL without a stated rule is matched once: its tokens
    look up the mined rules anchored at them, and a rule matches if the URL has all its tokens. Returns the id,
    ``host``, ``path``, ``rule`` (of a stated rule), ``verdict``, ``mined`` (the tokens of the mined rule that blocks,
    else null) and ``confidence``.

    A null or empty URL has neither host nor path and is allowed. URLs of any length are read whole. Without labels, or
    with none that blocks, nothing is mined; labels of one URL that disagree all count. Of equally sure rules the one of
    larger support wins, then the last by its tokens. Repeated rows are judged alike. An empty table gives an empty
    result; other columns are not looked at, whatever their names.
    """
    url = quoted(url_col)
    host, path = host_of(url), path_of(url)
    rule, verdict = stated(host, path, rules)
    rows = pages.select(quoted(id_col).alias("id"), url.alias("url"), host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("stated"))
    labelled = labels.filter(F.col("url").isNotNull() & F.col("block").isNotNull()).select(tokens(F.col("url")).alias("items"), "block")
    mined = mine(labelled, **mining).withColumnsRenamed({"rule": "asked"})
    open_urls = rows.filter(F.col("stated").isNull() & F.col("url").isNotNull()).select("url").distinct()
    looked = open_urls.withColumn("items", tokens(F.col("url"))).withColumn("token", F.explode("items"))
    hits = looked.join(mined, (F.col("token") == F.col("anchor")) & (F.size(F.array_except("asked", "items")) == 0))
    best = hits.groupBy(F.col("url").alias("hit")).agg(F.max(F.struct("confidence", "support", F.array_join("asked", " ").alias("tokens"))).alias("best"))
    joined = rows.join(best, F.col("stated").isNull() & (F.col("url") == F.col("hit")), "left")
    return joined.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("stated", F.when(F.col("best").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.col("best.tokens").alias("mined"),
        F.col("best.confidence").alias("confidence"),
    )


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """A page shows the document whose id ends its path; poor or toxic documents mark their URL as one to block."""
    at = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.\w+)?/?$", 1)
    shown = pages.select("url", F.when(at != "", at).cast("long").alias("_doc"))
    return shown.join(labels.select(F.col("doc_id").alias("_labelled"), "quality", "toxic"), F.col("_doc") == F.col("_labelled")).select("url", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, page_labels(pages, read(spark, sf_dir, "labels")))

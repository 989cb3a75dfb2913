"""Prefix trie of conversations, as double arrays within shards and a merge of what shards share."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.llm.common import apart, by_value, cut, hot_join, quoted, read, scanned, whole

#: A conversation's turns go in bands of so many; a shard has so many turns at most, or one sequence.
BAND, SHARD = 4096, 10_000
#: Ids of so many numbers stand in one row when a node's list of ids is hashed.
ID_BLOCK = 65_536

NODE = "depth long, conv_id long, parent_conv_id long, node string, parent string, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, chars long, upper boolean, shard string"
_ROW = [x.split() for x in NODE.split(", ")]


def turn_keys(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Each turn's conversation, place (``pos``, from 0), ``key`` (128 bits of SHA-256 of role and text) and ``chars`` (code points of the text).

    Turns are ordered by number, null first, and tied ones by key. Null roles and texts count as empty; rows without a conversation
    are left out. Repeated rows are turns of their own. Texts of any length are hashed where they are read and move no further. Places are
    :func:`~demandpanel.llm.common.scanned`, so a conversation may have any number of turns.
    """
    role, text = whole(quoted(role_col)), whole(quoted(text_col))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    rows = conversations.select(quoted(id_col).cast("long").alias("conv_id"), quoted(turn_col).alias("turn"), key.alias("key"), F.length(text).cast("long").alias("chars")).filter(F.col("conv_id").isNotNull())
    placed = scanned(apart(rows, "copy"), ["turn", "key", "copy"], {"pos": F.lit(1).cast("long")}, within=("conv_id",))
    return cut(placed.select("conv_id", "pos", "key", "chars"))


def rebuilt(keys: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that share their beginnings: each takes the first h turns of the first conversation of its ``block`` of ids in
    place of its own first h, h = crc32(id) % ``most``. Returns the turns (as :func:`turn_keys`) and all ids (``conv_id``)."""
    h = F.crc32(F.col("conv_id").cast("string")) % most
    convs = keys.groupBy("conv_id").agg(F.count("*").alias("turns"))
    heads = keys.filter((F.col("conv_id") % block == 0) & (F.col("pos") < most - 1)).groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "key", "chars"))).alias("head"))
    whose = convs.withColumn("of", F.col("conv_id") - F.col("conv_id") % block)
    # a block has `block` conversations at most, so no base is hot
    taken = whose.join(heads, F.col("of") == F.col("base"), "left").select("conv_id", "turns", F.when(F.col("head").isNull(), F.array().cast(heads.schema["head"].dataType)).otherwise(F.slice("head", F.lit(1), h.cast("int"))).alias("head"))
    taken = cut(taken)
    front = taken.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.key", "t.chars")
    short = taken.select(F.col("conv_id").alias("whose"), "turns", (h - F.size("head")).alias("short")).filter("short > 0")
    own = hot_join(keys.filter(F.col("pos") >= h), cut(short), "conv_id", "whose", "turns")
    own = own.select("conv_id", (F.col("pos") - F.coalesce("short", F.lit(0))).alias("pos"), "key", "chars")
    return front.unionByName(own), taken.select("conv_id")


def double_array(sequences: list[tuple[int, ...]]) -> tuple[list[int], list[int], list[int]]:
    """BASE and CHECK of the trie of ``sequences`` (of ids from 1, sorted, distinct), and its slots, parents first.

    The child of slot s by id i is slot BASE[s] + i, where CHECK is s. The root is slot 0, a free slot has CHECK -1. A node's children
    go to the first place where all of them find free slots, those of a node with very many to the end.
    """
    base, check, order, free = [0], [-2], [0], 1
    at = [(0, 0, len(sequences), 0)]
    for s, lo, hi, depth in at:
        if lo < hi and len(sequences[lo]) == depth:
            lo += 1  # the one that ends here comes first
        if lo == hi:
            continue
        kids, starts = [], []
        for i in range(lo, hi):
            if not kids or sequences[i][depth] != kids[-1]:
                kids.append(sequences[i][depth])
                starts.append(i)
        while free < len(check) and check[free] != -1:
            free += 1
        b = max(free - kids[0], 0) if len(kids) <= 64 else len(check)
        while any(b + c < len(check) and check[b + c] != -1 for c in kids):
            b += 1
        grow = b + kids[-1] + 1 - len(check)
        if grow > 0:
            base += [0] * grow
            check += [-1] * grow
        base[s] = b
        for c, i, j in zip(kids, starts, [*starts[1:], hi], strict=True):
            check[b + c] = s
            order.append(b + c)
            at.append((b + c, i, j, depth + 1))
    return base, check, order


def shard_nodes(shard: str, k: int, start: str, rows: list[dict]) -> list[tuple]:
    """All nodes of a shard, whose sequences agree in their first ``k`` turns. Nodes above depth k may be in other shards too: they
    come with their path's digest, with what lies below them in this shard only, and ``upper`` set."""
    ids = {key: i for i, key in enumerate(sorted({key for r in rows for key in r["keys"]}), 1)}
    found = sorted(((tuple(ids[key] for key in r["keys"]), r) for r in rows), key=lambda x: x[0])
    base, check, order = double_array([seq for seq, _ in found])
    size = len(check)
    n, low, chars, depth, kids, leaves, saved, ends, more = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size, [0] * size, [0] * size, [None] * size, [(0, 0, 0)] * size
    for seq, r in found:
        s = 0
        n[0] += r["n"]
        low[0] = r["low"] if low[0] is None else min(low[0], r["low"])
        for d, i in enumerate(seq):
            parent, s = s, base[s] + i
            assert check[s] == parent
            n[s] += r["n"]
            low[s] = r["low"] if low[s] is None else min(low[s], r["low"])
            chars[s], depth[s] = r["chars"][d], d + 1
        ends[s], more[s] = r["ends"], (r["more_children"] or 0, r["more_leaves"] or 0, r["more_saved"] or 0)
    if rows[0]["root_low"] is not None:
        low[0] = min(low[0], rows[0]["root_low"])
    names = {}
    path = hashlib.md5(start.encode())
    for d, key in enumerate(rows[0]["keys"][:k]):
        names[d + 1] = (path.update(key.encode()), path.hexdigest())[1]
    names[0] = start
    for s in order:
        kids[s], leaves[s], saved[s] = more[s]
    for s in reversed(order):
        if depth[s] >= k:
            leaves[s] += kids[s] == 0
            saved[s] += (n[s] - 1) * chars[s]
        # an upper node passes nothing on: who owns it is not known here
        if s and depth[s] >= k:
            p = check[s]
            kids[p], leaves[p], saved[p] = kids[p] + 1, leaves[p] + leaves[s], saved[p] + saved[s]
    out = []
    for s in order:
        d, upper = depth[s], depth[s] < k
        named = names[d] if d <= k else None
        over = names[d - 1] if 0 < d <= k else None
        out.append((d, low[s], low[check[s]] if d > k else None, named, over, n[s], kids[s], leaves[s], saved[s], ends[s], chars[s], upper, shard))
    return out


def _shards(batches):
    """For ``mapInArrow``: rows come sorted by shard, and each shard is worked off when the next begins."""
    types = [pa.bool_() if t == "boolean" else pa.string() if t == "string" else pa.int64() for _, t in _ROW]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x for x, _ in _ROW])

    rows, out = [], []
    for batch in batches:
        for r in batch.to_pylist():
            if rows and r["shard"] != rows[0]["shard"]:
                out += shard_nodes(rows[0]["shard"], rows[0]["k"], rows[0]["start"], rows)
                rows = []
            rows.append(r)
            if len(out) >= 10_000:
                yield table(out)
                out = []
    if rows:
        out += shard_nodes(rows[0]["shard"], rows[0]["k"], rows[0]["start"], rows)
    if out:
        yield table(out)


def _digests(batches):
    """For ``mapInArrow``: one SHA-256 of the ids of each sequence, whose blocks come sorted."""
    last, h = None, None
    out: list[tuple[str, str]] = []
    for batch in batches:
        for seq, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if seq != last:
                if h:
                    out.append((last, h.hexdigest()))
                last, h = seq, hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], names=["seq", "ends"])
            out = []
    if h:
        yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([h.hexdigest()])], names=["seq", "ends"])


def _sharded(seqs: DataFrame, most: int) -> DataFrame:
    """Adds ``shard`` and ``k``: sequences of a shard agree in their first ``k`` turns, and no other shard has sequences that do.
    Sequences whose first k turns too many share go on to 2 k."""
    weight = (F.size("keys") + 1).cast("long")
    done, left, k = None, seqs, 0
    while left is not None:
        prefix = F.md5(F.concat_ws("", "start", F.lit("/"), F.array_join(F.slice("keys", 1, k), "") if k else F.lit("")))
        named = left.withColumn("shard", prefix).withColumn("k", F.lit(k))
        heavy = cut(named.groupBy(F.col("shard").alias("heavy")).agg(F.sum(weight).alias("weight"), F.count("*").alias("many")).filter((F.col("weight") > most) & (F.col("many") > 1)).drop("many"))
        some = heavy.limit(1).count() > 0
        known = hot_join(named, heavy, "shard", "heavy", "weight") if some else named.withColumn("heavy", F.lit(None))
        settled = known.filter(F.col("heavy").isNull()).drop("heavy", "weight")
        done = settled if done is None else done.unionByName(settled)
        left = known.filter(F.col("heavy").isNotNull()).drop("heavy", "weight", "shard", "k") if some else None
        k = 2 * k or 1
    return done


def trie(turns: DataFrame, members: DataFrame, band: int = BAND, shard_turns: int = SHARD) -> DataFrame:
    """All nodes of the prefix trie of conversations: ``turns`` (see :func:`turn_keys`), ``members`` with all ids, also those without turns.

    Returns ``conv_id`` (the smallest member, which with the depth names a node), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256`` (see :func:`op12_prefix_trie`). No members, no nodes.

    Conversations with the same turns are one sequence with a count, combined before they shuffle. Sequences go to shards by
    prefix: all that share their first k turns, k as small as keeps a shard under ``shard_turns`` turns. In a shard, turns have dense
    ids and the trie is packed into BASE and CHECK arrays; walking its sequences through them gives the nodes, and going back along CHECK their
    sums. Nodes above depth k may be in several shards. They are merged by the digest of their path: each belongs to one of
    its shards, which alone adds the node's own share, and sums along each shard's path of upper nodes, added up over
    shards, are those of the whole subtree. Of a conversation of more than ``band`` turns each band is a sequence below the node where the band before
    ends; bands are worked off from the deepest, so no row holds more than a band.
    """
    placed = turns.withColumn("band", F.expr(f"pos div {int(band)}"))
    segs = placed.groupBy("conv_id", "band").agg(F.array_sort(F.collect_list(F.struct("pos", "key", "chars"))).alias("t"))
    segs = cut(segs.select("conv_id", "band", F.col("t.key").alias("keys"), F.col("t.chars").alias("chars")).withColumn("hash", F.md5(F.array_join("keys", ""))))
    chain = segs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("band", "hash"))).alias("b"))
    paths = chain.withColumn("path", F.aggregate("b", F.array(F.lit("")), lambda p, x: F.concat(p, F.array(F.md5(F.concat(F.element_at(p, -1), x["hash"]))))))
    at = F.transform("b", lambda x, i: F.struct(x["band"].alias("band"), F.get("path", i).alias("start"), F.get("path", i + 1).alias("end"), (i == F.size("b") - 1).alias("last")))
    paths = paths.select("conv_id", F.explode(at).alias("at")).select("conv_id", "at.*")
    none = members.join(chain.select("conv_id"), "conv_id", "left_anti").select("conv_id", F.lit(0).cast("long").alias("band"), F.lit("").alias("start"), F.lit("").alias("end"), F.lit(True).alias("last"))
    empty = none.select("*", F.array().cast("array<string>").alias("keys"), F.array().cast("array<bigint>").alias("chars"))
    rows = cut(paths.join(segs.drop("hash"), ["conv_id", "band"]).unionByName(empty))
    seqs = rows.groupBy("band", "start", F.col("end").alias("seq")).agg(F.count("*").alias("n"), F.min("conv_id").alias("low"), F.first("keys").alias("keys"), F.first("chars").alias("chars"))
    ids = rows.filter("last").groupBy(F.col("end").alias("seq"), F.expr(f"conv_id div {ID_BLOCK}").alias("block")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ends = ids.repartition("seq").sortWithinPartitions("seq", "block").select("seq", "ids").mapInArrow(_digests, "seq string, ends string")
    seqs = cut(seqs.join(ends, "seq", "left"))
    deepest = seqs.agg(F.max("band")).first()[0]
    more, tables = None, []
    for b in range(-1 if deepest is None else deepest, -1, -1):
        here = seqs.filter(F.col("band") == b).withColumn("root_low", F.lit(None).cast("long"))
        if b:
            # conversations that end where the band begins belong to its root too
            roots = seqs.filter(F.col("band") == b - 1).select(F.col("seq").alias("of"), F.col("low").alias("root_low"), F.col("n").alias("of_n"))
            here = hot_join(here.drop("root_low"), roots, "start", "of", "of_n", row_bytes=128).drop("of", "of_n")
        if more is None:
            here = here.select("*", *(F.lit(None).cast("long").alias(c) for c in ("more_children", "more_leaves", "more_saved")))
        else:
            here = here.join(more.select(F.col("node").alias("seq"), F.col("n_children").alias("more_children"), F.col("n_leaves").alias("more_leaves"), F.col("saved_tokens").alias("more_saved")), "seq", "left")
        sharded = _sharded(here, shard_turns).repartition("shard").sortWithinPartitions("shard")
        nodes = _merged(cut(sharded.mapInArrow(_shards, NODE)))
        more = nodes.filter("depth = 0") if b else None
        # a band's root is the last node of the band before
        tables.append((nodes.filter("depth > 0") if b else nodes).withColumn("depth", F.col("depth") + b * band))
    if not tables:
        tables.append(turns.sparkSession.createDataFrame([], NODE))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def _merged(nodes: DataFrame) -> DataFrame:
    """Nodes of one band: those that shards share become one each, and all know their parent."""
    shared = nodes.filter("upper")
    one = shared.groupBy("node").agg(*(F.max(c).alias(c) for c in ("depth", "parent", "ends", "chars")), F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children")), F.min("shard").alias("owner"), F.count("*").alias("shards"))
    below = one.filter("depth > 0").groupBy(F.col("parent").alias("over")).agg(F.count("*").alias("kids"))
    one = one.join(below, F.col("node") == F.col("over"), "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("over", "kids")
    one = cut(one)
    own = one.select(F.col("node").alias("same"), "owner", "shards", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saving"))
    at = hot_join(shared.select("shard", "depth", "node", "n_leaves", "saved_tokens"), own, "node", "same", "shards", row_bytes=128)
    mine = F.when(F.col("owner") == F.col("shard"), 1).otherwise(0)
    # a shard's upper nodes are one path of less than a band
    path = Window.partitionBy("shard").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    at = at.select("node", F.sum(F.col("n_leaves") + mine * F.col("leaf")).over(path).alias("n_leaves"), F.sum(F.col("saved_tokens") + mine * F.col("saving")).over(path).alias("saved_tokens"))
    sums = at.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    names = ["depth", "conv_id", "node", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    tops = one.join(sums, "node").select(*names).unionByName(nodes.filter("NOT upper AND parent IS NOT NULL").select(*names))
    over = one.select(F.col("node").alias("over"), F.col("conv_id").alias("parent_conv_id"), "n_children").withColumnRenamed("n_children", "weight")
    tops = hot_join(tops, over, "parent", "over", "weight").drop("over", "weight")
    return cut(tops.unionByName(nodes.filter("NOT upper AND parent IS NULL").select(*names, "parent_conv_id")))


def prefix_trie(conversations: DataFrame, band: int = BAND, shard_turns: int = SHARD, **columns: str) -> DataFrame:
    """:func:`trie` of conversations as they stand (columns of :func:`turn_keys`); other columns are not looked at, whatever their names."""
    keys = turn_keys(conversations, **columns)
    return trie(keys, keys.select("conv_id").distinct(), band, shard_turns)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns, members = rebuilt(turn_keys(read(spark, sf_dir, "conversations")))
    return trie(turns, members)


#: CRC-32 by its table; a node's sums go by way of the smallest member of each node below it.
OP12_SQL = """
WITH crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
), t AS (
    SELECT conv_id, turn, length(coalesce(text, '')) AS chars, substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS key
    FROM conversations WHERE conv_id IS NOT NULL
), p AS MATERIALIZED (
    SELECT conv_id, key, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS p FROM t
), c AS MATERIALIZED (
    SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM t), crc
), r AS MATERIALIZED (
    SELECT conv_id, key, chars, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS d FROM (
        SELECT c.conv_id, key, chars, p, 0 AS own FROM c JOIN p ON p.conv_id = c.conv_id - c.conv_id % 100 WHERE p < h
        UNION ALL SELECT c.conv_id, key, chars, p, 1 FROM c JOIN p USING (conv_id) WHERE p >= h)
    UNION ALL SELECT conv_id, '', 0, 0 FROM c
), n AS MATERIALIZED (
    SELECT conv_id, d, chars, node, lag(node) OVER (PARTITION BY conv_id ORDER BY d) AS parent, lead(node) OVER (PARTITION BY conv_id ORDER BY d) IS NULL AS last
    FROM (SELECT conv_id, d, chars, md5(string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY d)) AS node FROM r)
), g AS MATERIALIZED (
    SELECT node, any_value(d) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
    FROM n GROUP BY node
), k AS (
    SELECT parent, count(*) AS n FROM g GROUP BY parent
), s AS (
    SELECT n.node, CAST(sum((k.n IS NULL)::INT) AS BIGINT) AS n_leaves, CAST(sum((g.n_convs - 1) * g.chars) AS BIGINT) AS saved_tokens
    FROM g LEFT JOIN k ON k.parent = g.node JOIN n ON n.conv_id = g.conv_id AND n.d <= g.depth GROUP BY n.node
)
SELECT g.conv_id, g.depth, o.conv_id AS parent_conv_id, g.n_convs, coalesce(k.n, 0) AS n_children, n_leaves, saved_tokens, g.ends_sha256
FROM g JOIN s USING (node) LEFT JOIN k ON k.parent = g.node LEFT JOIN g o ON o.node = g.parent
"""

by_value(__name__)

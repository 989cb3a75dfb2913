"""Near-duplicate documents by weighted MinHash signatures of word shingles."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.common import bounded_batches, by_value, cut, hot_join, kept, quoted, read
from demandpanel.llm.decontaminate import Terms, words

by_value(__name__)

#: Words in a shingle and least weighted Jaccard similarity of a link.
SHINGLE, SIMILARITY = 5, 0.8
#: Bands and coordinates in each: two texts of similarity 0.8 share one with probability 0.997, of 0.9 with 1 - 10**-8.
BANDS, ROWS = 32, 8
#: Texts that one side of a comparison holds, and shingles of texts whose darts are thrown together.
BLOCK, TOGETHER = 250, 20_000
#: Darts of a region of area 1 are Poisson distributed: the chances of so many at most. None has more than 20 within 10**-19.
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])

M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x + M1
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from the upper 53 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Shingler:
    """64-bit hashes of a text's word shingles and their counts, its weighted set.

    A text of fewer words than a shingle has one, of all its words; a text without words has none.
    """

    def __init__(self, size: int = SHINGLE):
        self.size, self.terms = size, kept("terms", Terms)

    def __call__(self, ws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles in rising order, and their counts."""
        h = self.terms.of(ws).view(np.uint64)
        if not len(h):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        n = max(len(h) - self.size + 1, 1)
        out = np.zeros(n, np.uint64)
        for k in range(min(self.size, len(h))):
            out = mix(out ^ h[k : k + n])
        return np.unique(out, return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int = BANDS * ROWS) -> np.ndarray:
    """A DartMinHash signature of ``k`` coordinates for each weighted set (elements, positive weights), none of them empty.

    Over each element lies a plane of weight and rank. Its weight axis falls into the stripes [2**v - 1, 2**(v+1) - 1), and
    a stripe along the rank axis into regions of area 1. A hash of element, stripe and region throws Poisson(1) darts
    into the region, at places that more hashes give, so the same element has the same darts in every set. A dart counts
    for a set if it lies below the element's weight there, and below a rank that gives the set k (ln k + 2) such darts on
    average, whatever its total weight. One more hash sends each dart to a coordinate, and the earliest dart of a
    coordinate, the one of least rank, is kept. Where a coordinate stays empty, the rank limit of that set is doubled.
    """
    sizes = np.array([len(e) for e, _ in sets])
    element, weight = np.concatenate([e for e, _ in sets]), np.concatenate([w for _, w in sets]).astype(np.float64)
    of = np.repeat(np.arange(len(sets)), sizes)
    limit = k * (math.log(k) + 2) / np.bincount(of, weight, len(sets))
    stripes = np.floor(np.log2(weight + 1 - 1e-12)).astype(np.int64) + 1
    kept = np.zeros(len(sets) * k, np.uint64)
    live = np.arange(len(element))
    while len(live):
        # stripes of the elements, regions of the stripes, darts of the regions
        item = np.repeat(live, stripes[live])
        v = np.arange(len(item)) - np.repeat(np.cumsum(stripes[live]) - stripes[live], stripes[live])
        wide = np.exp2(v)
        regions = np.ceil(limit[of[item]] * wide).astype(np.int64)
        stripe = mix(element[item] ^ mix(v.astype(np.uint64)))
        base, number = np.repeat(np.arange(len(item)), regions), np.arange(regions.sum())
        number -= np.repeat(np.cumsum(regions) - regions, regions)
        region = mix(stripe[base] + number.astype(np.uint64))
        darts = np.searchsorted(POISSON, uniform(region))
        at = np.repeat(np.arange(len(region)), darts)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(region[at] ^ mix((nth + 1).astype(np.uint64)))
        base, number = base[at], number[at]
        rank = (number + uniform(dart)) / wide[base]
        inside = rank < limit[of[item[base]]]
        # the whole of the first stripe lies below a weight of 1 or more
        check = (v[base] > 0) | (weight[item[base]] < 1)
        if check.any():
            place = wide[base[check]] * (1 + uniform(mix(dart[check] ^ M2))) - 1
            inside[check] &= place < weight[item[base[check]]]
        dart, rank, owner = dart[inside], rank[inside], of[item[base[inside]]]
        name = mix(dart ^ M3)
        cell = owner * k + (name % np.uint64(k)).astype(np.int64)
        # the earliest of each cell comes last when written in falling order of rank
        late = np.argsort(-rank, kind="stable")
        touched = np.zeros(len(kept), bool)
        touched[cell] = True
        kept[cell[late]] = name[late]
        again = ~touched.reshape(len(sets), k).all(1)
        mine = np.zeros(len(sets), bool)
        mine[of[live]] = True
        again &= mine
        # again with twice the limit, from the start: the darts are the same
        limit = np.where(again, 2 * limit, limit)
        live = np.flatnonzero(again[of])
    return kept.reshape(len(sets), k)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band and text; the band's number is part of it."""
    cells = signature.reshape(len(signature), bands, -1)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), cells.shape[:2])
    for c in range(cells.shape[2]):
        out = mix(out ^ cells[:, :, c])
    return out


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its ``id``, ``check`` (a hash of the text), ``key`` (128 bits of its words) and ``bands``, empty without words."""

    def sign(batches):
        shingler = kept("shingler", Shingler)
        for batch in batches:
            keys, bands, sets, at, n = [], [[]] * len(batch), [], [], 0
            for i, text in enumerate(batch.column(2).to_pylist()):
                ws = words(text)
                named = b" ".join(ws) if ws else b"\0" + (text or "").encode("utf-8", "surrogatepass")
                keys.append(hashlib.blake2b(named, digest_size=16).digest())
                if ws:
                    at.append(i)
                    sets.append(shingler(ws))
                    n += len(sets[-1][0])
                if sets and (n >= TOGETHER or i == len(batch) - 1):
                    for j, x in zip(at, band_keys(signatures(sets)).view(np.int64).tolist(), strict=True):
                        bands[j] = x
                    sets, at, n = [], [], 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "check", "key", "bands"])

    rows = docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("check"), quoted(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    with bounded_batches(docs.sparkSession):
        return cut(rows.mapInArrow(sign, f"id {kind}, check bigint, key binary, bands array<bigint>"))


def shingle_sets(docs: DataFrame, nodes: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The weighted set of each node in ``members``, as a table: ``node``, its ``shingles`` and their ``counts``, as
    little-endian 64-bit and 32-bit numbers, from the whole text of the node's least row."""

    def shingle(batches):
        shingler = kept("shingler", Shingler)
        for batch in batches:
            sets = [shingler(words(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([e.astype("<u8").tobytes() for e, _ in sets], pa.binary()), pa.array([c.astype("<u4").tobytes() for _, c in sets], pa.binary())], names=["node", "shingles", "counts"])

    name = lambda i, check: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("-")), i.isNull().cast("int"), check)
    wanted = nodes.join(members.select(F.col("node").alias("of")).distinct(), F.col("node") == F.col("of"))
    wanted = cut(wanted.select(name(F.col("rep.id"), F.col("rep.check")).alias("row"), "node", "n"))
    texts = docs.select(name(quoted(id_col), F.xxhash64(quoted(text_col))).alias("name"), quoted(text_col).alias("text"))
    texts = hot_join(texts, wanted, "name", "row", "n").filter(F.col("node").isNotNull())
    with bounded_batches(docs.sparkSession):
        sets = cut(texts.select("node", "text").mapInArrow(shingle, "node bigint, shingles binary, counts binary"))
    # repeated rows name one node
    return sets.groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("counts").alias("counts")) if sets.count() > wanted.count() else sets


def components(edges: DataFrame) -> DataFrame:
    """The least node (``root``) of each node's connected component, for all nodes of ``edges`` (``a``, ``b``), as a table.

    Large-star and small-star steps in turn hang every node on the least neighbour of its neighbourhood, until each
    component is a star; that takes about log n rounds. Every round is a table in the shared folder. The hub of a large
    star has very many rows; they are spread over the tasks (see :func:`~demandpanel.llm.common.hot_join`).
    """

    def hung(rows: DataFrame, least: DataFrame) -> DataFrame:
        return hot_join(rows, cut(least), "a", "hub", "n", row_bytes=24)

    state, edges = None, cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("hub")).agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n"))
        edges = cut(hung(both, least).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = edges.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = hung(edges, least)
        edges = cut(small.select("a", F.col("m").alias("b")).unionByName(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return cut(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


def linked(sets: list[tuple[np.ndarray, np.ndarray]], left: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs of weighted sets of this similarity at least that connect all that such pairs connect; ``left`` tells the sides.

    With both sides present only pairs across count, since other tasks compare each side with itself.
    """
    across = left.any() and not left.all()
    m = len(sets)
    size = np.array([int(c.sum()) for _, c in sets])
    value, column, many = np.unique(np.concatenate([e for e, _ in sets]), return_inverse=True, return_counts=True)
    weight = np.concatenate([c for _, c in sets]).astype(np.int64)
    rows = np.repeat(np.arange(m), [len(e) for e, _ in sets])
    keep = many[column] > 1
    rows, column, weight = rows[keep], column[keep], weight[keep]
    # a count of c is c units of weight, and the least of two counts is the number of units in both
    most = np.zeros(len(value), np.int64)
    np.maximum.at(most, column, weight)
    first = np.cumsum(most) - most
    rows, column = np.repeat(rows, weight), np.repeat(first[column], weight) + np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    inter = np.zeros((m, m), np.float32)
    width = max(1, 10_000_000 // m)
    order = np.argsort(column, kind="stable")
    rows, column, total = rows[order], column[order], int(most.sum())
    for k in range(0, total, width):
        a, z = np.searchsorted(column, [k, k + width])
        part = np.zeros((m, min(width, total - k)), np.float32)
        part[rows[a:z], column[a:z] - k] = 1
        inter += part @ part.T
    near = inter >= similarity * (size[:, None] + size - inter) - 1e-6
    if across:
        near &= left[:, None] != left
    root, out = list(range(m)), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in np.argwhere(np.triu(near, 1)).tolist():
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def buckets(nodes: DataFrame) -> DataFrame:
    """Rows (``bucket``, ``node``, ``m``) of all nodes that share a band with another; ``m`` is the bucket's number of nodes.

    A bucket is left out where another holds all its nodes: of buckets with the same nodes one stays, and one whose nodes
    all have the same larger bucket goes. So texts that share many bands meet once or a few times, not once a band.
    """
    band = nodes.select("node", F.explode("bands").alias("band"))
    sums = [F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)]
    every = band.groupBy(F.col("band").alias("of")).agg(F.count("*").alias("m"), *sums).filter("m > 1")
    named = cut(every.groupBy("m", "s1", "s2").agg(F.min("of").alias("of")).select("of", "m"))
    members = cut(hot_join(band, named, "band", "of", "m", row_bytes=24).filter(F.col("of").isNotNull()).select(F.col("band").alias("bucket"), "node", "m"))
    largest = members.groupBy("node").agg(F.max(F.struct("m", "bucket")).alias("top"))
    tops = members.join(largest.withColumnRenamed("node", "the"), F.col("node") == F.col("the"))
    needed = tops.groupBy(F.col("bucket").alias("of")).agg(F.min("top.bucket").alias("lo"), F.max("top.bucket").alias("hi"), F.first("m").alias("weight")).filter("lo <> hi OR lo = of").select("of", "weight")
    return cut(hot_join(members, cut(needed), "bucket", "of", "weight", row_bytes=24).filter(F.col("of").isNotNull()).select("bucket", "node", "m"))


def _compare(dealt: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (``a``, ``b``), as a table, of rows (``cell``, ``task``, ``node``, ``left``): the nodes of a cell are compared, those
    with ``left`` against those without, or all with each other where there is one side only."""
    rows = dealt.join(sets.withColumnRenamed("node", "set_of"), F.col("node") == F.col("set_of")).select("cell", "task", "node", "left", "shingles", "counts")

    def compare(table: pa.Table) -> pa.Table:
        node, cell, left = table["node"].to_numpy(), np.array(table["cell"].to_pylist()), table["left"].to_numpy(zero_copy_only=False)
        order = np.lexsort((node, cell))
        out = []
        for at in np.split(order, np.flatnonzero(cell[order][1:] != cell[order][:-1]) + 1):
            some = [(np.frombuffer(table["shingles"][int(k)].as_py(), "<u8"), np.frombuffer(table["counts"][int(k)].as_py(), "<u4")) for k in at]
            out += [(int(node[at[x]]), int(node[at[y]])) for x, y in linked(some, left[at], similarity)]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return cut(rows.groupBy("task").applyInArrow(compare, "a bigint, b bigint"))


def links(members: DataFrame, sets: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """Links (``a``, ``b``) that connect all nodes that pairs of a common bucket with this similarity connect.

    A bucket of ``block`` nodes at most is one cell, where all its pairs are compared. A larger one falls into blocks, each
    compared with itself and with the first. That joins most of a group of copies, and pairs within the largest
    component of a bucket need no comparison any more. What is left, the nodes outside it, is compared with all nodes
    of the bucket, block by block. So a bucket of m nodes that nearly all belong together costs about m rows, and no
    pair that could add a link is left out.
    """
    blocks = F.ceil(F.col("m") / block).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    n = members.count()
    small = F.pmod(F.xxhash64("bucket"), F.lit(n // block + 1))
    cell = lambda *x: F.concat_ws(" ", "bucket", *x)
    alone = members.filter(F.col("m") <= block).select(cell().alias("cell"), small.alias("task"), "node", F.lit(True).alias("left"))
    # block 0 is the left side of its comparisons with the others
    large = members.filter(F.col("m") > block).withColumns({"blocks": blocks, "mine": mine})
    self_ = large.select(cell("mine").alias("cell"), "node", F.lit(True).alias("left"))
    first = large.filter("mine = 0").select(F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)).alias("j"), "bucket", "node").select(cell(F.lit("0"), "j").alias("cell"), "node", F.lit(True).alias("left"))
    rest = large.filter("mine > 0").select(cell(F.lit("0"), "mine").alias("cell"), "node", F.lit(False).alias("left"))
    parts = self_.unionByName(first).unionByName(rest).select("cell", F.xxhash64("cell").alias("task"), "node", "left")
    found = _compare(alone.unionByName(parts), sets, similarity)
    if not large.limit(1).count():
        return found
    roots = components(found).withColumnRenamed("node", "of")
    placed = cut(large.join(roots, F.col("node") == F.col("of"), "left").select("bucket", "node", "blocks", "mine", F.coalesce("root", "node").alias("root")))
    main = placed.groupBy("bucket", "root").agg(F.count("*").alias("n")).groupBy(F.col("bucket").alias("b")).agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("m"))
    placed = cut(hot_join(placed, cut(main.select("b", F.col("main.root").alias("main"), F.col("main.n").alias("n_main"), "m")), "bucket", "b", "m"))
    lone = F.col("root") != F.col("main")
    left_blocks = F.ceil((F.col("m") - F.col("n_main")) / block).cast("int")
    open_ = placed.filter(F.col("m") > F.col("n_main")).withColumn("left_blocks", left_blocks)
    grid = lambda i, j: cell(F.lit("lone"), i, j)
    lonely = open_.filter(lone).withColumn("i", F.pmod(F.xxhash64("node", F.lit(1)), F.col("left_blocks")).cast("int")).select("bucket", "node", "i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j")).select(grid("i", "j").alias("cell"), "node", F.lit(True).alias("left"))
    others = open_.select("bucket", "node", "mine", F.explode(F.sequence(F.lit(0), F.col("left_blocks") - 1)).alias("i")).select(grid("i", "mine").alias("cell"), "node", F.lit(False).alias("left"))
    more = lonely.unionByName(others).select("cell", F.xxhash64("cell").alias("task"), "node", "left")
    return found.unionByName(_compare(more, sets, similarity))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """One row per input row: the id, ``check`` (a hash of the text), ``class_id``, ``class_size`` and ``kept``.

    Texts of the same words are one node. Nodes that share a band of their DartMinHash signatures are candidates, and the
    weighted Jaccard similarity of candidates' word shingles is computed exactly (see :func:`links`). Links are the pairs
    of ``similarity`` or more, classes the connected components of links; ``class_id`` is the class's least id, and the
    row with it is kept.

    A null text counts as empty. Texts without words are alike only if equal. Texts of any length are read whole. Null
    ids come before all others, and the rows of a very large class are spread evenly, whatever their ids; tied rows (same
    id and text) share their verdict. An empty table gives an empty result; other columns are not looked at, whatever
    their names.
    """
    rows = signed(docs, id_col, text_col)
    nodes = cut(rows.groupBy("key").agg(F.min(F.struct("id", "check")).alias("rep"), F.count("*").alias("n"), F.first("bands").alias("bands")).withColumn("node", F.monotonically_increasing_id()))
    members = buckets(nodes)
    sets = shingle_sets(docs, nodes, members, id_col, text_col)
    roots = components(links(members, sets, similarity, block)).withColumnRenamed("node", "of")
    known = cut(nodes.select("key", "node", "n", "rep").join(roots, F.col("node") == F.col("of"), "left").select("key", "n", "rep", F.coalesce("root", "node").alias("root")))
    named = cut(known.groupBy(F.col("root").alias("class")).agg(F.min("rep").alias("first"), F.sum("n").alias("class_size"), F.count("*").alias("n_keys")))
    named = hot_join(known, named, "root", "class", "n_keys", row_bytes=96).select(F.col("key").alias("of"), "n", "first", "class_size")
    out = hot_join(rows.select("id", "check", "key"), cut(named), "key", "of", "n", row_bytes=128)
    least = F.col("id").eqNullSafe(F.col("first.id")) & F.col("check").eqNullSafe(F.col("first.check"))
    return out.select(F.col("id").alias(id_col), "check", F.col("first.id").alias("class_id"), "class_size", least.alias("kept"))


def op4_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents")).drop("check")

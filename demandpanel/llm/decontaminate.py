"""Benchmark decontamination through a distributed positional inverted index."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.common import BROADCAST_BYTES, bounded_batches, by_value, cut, hot_join, kept, quoted, read

by_value(__name__)

#: Words in a window, and how far apart the words of a proximity match are.
WINDOW, SLOP = 10, 20
#: Words of a segment of the index, and windows that are looked up in it at once: together they bound a task's memory.
SEGMENT_WORDS, BLOCK_WINDOWS = 1_000_000, 100_000
#: Candidates that are held against the index together, words whose hash a task remembers, and pieces of a frequent window's items.
TOGETHER, REMEMBERED, SALTS = 200_000, 100_000, 16

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    """Runs of digits, letters a-z and all beyond ASCII, after A-Z are lower-cased. In UTF-8 no other byte is part of one."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class Terms(dict):
    """64-bit hashes of words, the terms of the index."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out

    def of(self, ws: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws)).view(np.int64)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The positional inverted index of all words of all texts, as a table.

    Documents are dealt to segments of about ``segment_words`` words (a longer one is a segment alone) and stand in it
    one after another, 2 * SLOP places apart. A row is the posting list of a ``term`` in a ``segment``: its ``n`` places in
    rising order, as little-endian 32-bit numbers (``at``). A row without a term is a document: its ``id``, ``check`` (a
    hash of the text), first place (``start``) and number of words (``n``). Any benchmark can be looked up in it.
    """
    names = ["segment", "term", "n", "start", "at", "id", "check"]
    id_type = docs.select(quoted(id_col).alias("id")).schema["id"]
    arrow_id = docs.select(quoted(id_col).alias("id")).limit(0).toArrow().schema.field("id").type

    def flush(number: int, ids: list, checks: list, hashes: list[np.ndarray]):
        sizes = np.array([len(h) for h in hashes], np.int64)
        starts = np.cumsum(sizes + 2 * SLOP) - (sizes + 2 * SLOP)
        n, none = len(ids), lambda kind, k: pa.nulls(k, kind)
        segment = lambda k: pa.array(np.full(k, number, np.int64))
        yield pa.RecordBatch.from_arrays([segment(n), none(pa.int64(), n), pa.array(sizes), pa.array(starts), none(pa.binary(), n), pa.array(ids, arrow_id), pa.array(checks, pa.int64())], names=names)
        terms = np.concatenate(hashes)
        if len(terms):
            places = (np.arange(len(terms)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)).astype("<i4")
            order = np.argsort(terms, kind="stable")
            terms, places = terms[order], places[order]
            first = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]])
            ends = np.r_[first, len(terms)]
            at = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((4 * ends).astype(np.int32).tobytes()), pa.py_buffer(places.tobytes())])
            k = len(first)
            yield pa.RecordBatch.from_arrays([segment(k), pa.array(terms[first]), pa.array(np.diff(ends).astype(np.int64)), none(pa.int64(), k), at, none(arrow_id, k), none(pa.int64(), k)], names=names)

    def index(batches):
        known = kept("terms", Terms)
        number = TaskContext.get().partitionId() << 32
        ids, checks, hashes, n = [], [], [], 0
        for batch in batches:
            for i, check, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(i)
                checks.append(check)
                hashes.append(known.of(words(text)))
                n += len(hashes[-1])
                if n >= segment_words:
                    yield from flush(number, ids, checks, hashes)
                    number, ids, checks, hashes, n = number + 1, [], [], [], 0
        if ids:
            yield from flush(number, ids, checks, hashes)

    rows = docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("check"), quoted(text_col).alias("text"))
    with bounded_batches(docs.sparkSession):
        return cut(rows.mapInArrow(index, f"segment bigint, term bigint, n bigint, start bigint, at binary, id {id_type.dataType.simpleString()}, check bigint"))


def item_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The different windows of a benchmark (``w``, ``terms``) and the items that hold each (``w``, ``item``), as tables."""

    def slide(batches):
        known = kept("terms", Terms)
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = known.of(words(text))
                width = min(window, len(h))
                grams = np.lib.stride_tricks.sliding_window_view(h, width) if width else np.zeros((0, 1), np.int64)
                for k in range(0, len(grams), 10_000):
                    part = grams[k : k + 10_000]
                    offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * width)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.string()), pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(part).ravel()))], names=["item", "terms"])

    with bounded_batches(benchmark.sparkSession):
        every = cut(benchmark.select(quoted(item_col).cast("string").alias("item"), quoted(text_col).alias("text")).mapInArrow(slide, "item string, terms array<bigint>"))
    grams = cut(every.groupBy(F.col("terms").alias("gram")).agg(F.count("*").alias("n_items")).withColumn("w", F.monotonically_increasing_id()))
    items = cut(hot_join(every, grams, "terms", "gram", "n_items", row_bytes=8 * window + 32).select("w", "item").distinct())
    return grams.select("w", F.col("gram").alias("terms")), items


def _wanted(index: DataFrame, grams: DataFrame, block_windows: int) -> tuple[DataFrame, int]:
    """Per term of a window that can occur: ``of``, ``n_segments`` and, for each block of windows that needs it, the block and
    the windows filed under the term, which is their rarest. Returns the number of blocks too.

    A window comes with its terms and their offsets in it, the rarest in the corpus first. Of tied terms the first in the
    window counts as rarer. A window with a term that no text has can't occur and is left out.
    """
    blocks = max(-(-grams.count() // block_windows), 1)
    terms = grams.select("w", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    asked = terms.groupBy(F.col("term").alias("of")).agg(F.count("*").alias("asked"))
    there = index.filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n").alias("n"), F.count("*").alias("n_segments"))
    counts = cut(asked.join(there, F.col("of") == F.col("term")).select("of", "asked", "n", "n_segments"))
    ranked = hot_join(terms, counts, "term", "of", "asked").filter(F.col("of").isNotNull())
    ranked = ranked.groupBy("w", "size").agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("by")).filter(F.size("by") == F.col("size"))
    placed = cut(ranked.select("w", F.pmod(F.xxhash64("w"), F.lit(blocks)).cast("int").alias("block"), F.transform("by", lambda x: x["term"]).alias("terms"), F.transform("by", lambda x: x["offset"]).alias("offsets")))
    filed = placed.groupBy("block", F.get("terms", F.lit(0)).alias("term")).agg(F.collect_list(F.struct("w", "terms", "offsets")).alias("windows"))
    needed = placed.select("block", F.explode("terms").alias("term")).distinct()
    both = needed.join(filed, ["block", "term"], "left").groupBy("term").agg(F.collect_list(F.struct("block", "windows")).alias("blocks"))
    return cut(both.join(counts.select("of", "n_segments"), F.col("term") == F.col("of")).select("of", "n_segments", "blocks")), blocks


def search(index: DataFrame, grams: DataFrame, slop: int = SLOP, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """All matches of the windows in the index: ``segment``, ``start`` (of the document), ``w``, and the first and last word
    (``s``, ``e``, end exclusive) of an exact match, or null for a proximity match: the window's three rarest terms stand
    within ``slop`` words of the rarest.

    The windows' terms are joined to the index, and the lists of one segment meet in one task for each block of windows.
    There a window's candidate starts are the places of its rarest term less that term's offset. They are intersected
    with the lists of its next rarest terms, each less its own offset, until all terms agree or no start is left.
    """
    wanted, blocks = _wanted(index, grams, block_windows)
    n_windows = F.aggregate("blocks", F.lit(0).cast("long"), lambda a, b: a + F.coalesce(F.size(b["windows"]), F.lit(0)))
    n, size = wanted.agg(F.count("*"), F.coalesce(F.sum(n_windows), F.lit(0))).first()
    lists = index.filter(F.col("term").isNotNull()).select("segment", "term", "at")
    lists = hot_join(lists, wanted, "term", "of", "n_segments", row_bytes=64 + (12 * window + 64) * size // max(n, 1)).filter(F.col("of").isNotNull())
    none = F.lit(None).cast("bigint")
    lists = lists.select("segment", "term", "at", F.explode("blocks").alias("b")).select("segment", "b.block", "term", "at", "b.windows", none.alias("start"), none.alias("n"))
    docs = index.filter(F.col("term").isNull()).select("segment", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "term", "at", F.lit(None).cast(lists.schema["windows"].dataType).alias("windows"), "start", "n")

    def intersect(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("segment", "start", "w", "s", "e")})
        is_doc = table["term"].is_null().to_numpy()
        mine = table.filter(pa.array(~is_doc))
        starts = np.sort(table.filter(pa.array(is_doc))["start"].to_numpy().astype(np.int64))
        ends = np.sort(table.filter(pa.array(is_doc))["n"].to_numpy().astype(np.int64) + table.filter(pa.array(is_doc))["start"].to_numpy().astype(np.int64))
        windows = mine["windows"].combine_chunks() if len(mine) else None
        if windows is None or windows.null_count == len(windows):
            return empty
        term = mine["term"].to_numpy().astype(np.int64)
        blobs = mine["at"].to_pylist()
        many = np.array([len(x) // 4 for x in blobs])
        places, first = np.frombuffer(b"".join(blobs), "<i4").astype(np.int64), np.cumsum(many) - many
        by = np.argsort(term)
        # the terms by place, numbered from 1, with room on both sides
        room = slop + window
        line = np.zeros(int(ends.max()) + 2 * room, np.int32)
        line[places + room] = np.repeat(np.arange(1, len(term) + 1, dtype=np.int32), many)
        # windows as rows of term numbers and offsets, the rarest first; -1 pads short ones, -2 is a term that the segment lacks
        filed = np.repeat(np.arange(len(term)), windows.value_lengths().fill_null(0).to_numpy())
        flat = windows.flatten()
        sizes = flat.field("terms").value_lengths().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        value = flat.field("terms").flatten().to_numpy()
        at = np.minimum(np.searchsorted(term[by], value), len(term) - 1)
        number, offset = np.full((len(sizes), window), -1, np.int32), np.zeros((len(sizes), window), np.int64)
        number[row, column] = np.where(term[by][at] == value, by[at] + 1, -2)
        offset[row, column] = flat.field("offsets").flatten().to_numpy()
        names = flat.field("w").to_numpy()
        out = {"start": [], "w": [], "s": [], "e": []}

        def found(where, which, exact):
            doc = np.searchsorted(starts, where, "right") - 1
            start = starts[doc]
            both = np.stack([start, names[which], where - start, where - start + sizes[which]]) if exact else np.unique(np.stack([start, names[which]]), axis=1)
            for name, x in zip(out, both, strict=False):
                out[name].append(x)
            for name in ("s", "e")[: 0 if exact else 2]:
                out[name].append(np.full(both.shape[1], -1))

        hopeful = np.flatnonzero((number[:, : min(3, window)] != -2).all(1))
        load = np.cumsum(many[filed[hopeful]])
        for part in np.split(hopeful, np.searchsorted(load, np.arange(TOGETHER, load[-1] if len(load) else 0, TOGETHER), "right")):
            if not len(part):
                continue
            each = many[filed[part]]
            which = np.repeat(part, each)
            place = places[first[filed[which]] + np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each)] + room
            near, some = place, which
            for k in range(1, min(3, window)):
                hit = np.zeros(len(some), bool)
                for x in range(-slop, slop + 1):
                    hit |= line[near + x] == number[some, k]
                hit |= number[some, k] == -1
                near, some = near[hit], some[hit]
            found(near - room, some, False)
            begin = place - offset[which, 0]
            for k in range(1, window):
                wanted_term = number[which, k]
                agree = (line[begin + offset[which, k]] == wanted_term) | (wanted_term == -1)
                begin, which = begin[agree], which[agree]
            found(begin - room, which, True)
        flat_out = {k: np.concatenate(v) for k, v in out.items()} if out["w"] else {k: np.zeros(0, np.int64) for k in out}
        exact = flat_out["s"] >= 0
        count = len(exact)
        segment = np.full(count, table["segment"][0].as_py(), np.int64)
        return pa.table({"segment": segment, "start": flat_out["start"], "w": flat_out["w"], "s": pa.array(flat_out["s"], pa.int64(), mask=~exact), "e": pa.array(flat_out["e"], pa.int64(), mask=~exact)})

    return cut(lists.unionByName(docs).groupBy("segment", "block").applyInArrow(intersect, "segment bigint, start bigint, w bigint, s bigint, e bigint"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, segment_words: int = SEGMENT_WORDS, block_windows: int = BLOCK_WINDOWS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Finds the benchmark's windows in all rows, through an index of these (see :func:`build_index` and :func:`search`).

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. Returns one
    row per input row: the id, ``check`` (a hash of the text), ``n_words``, ``ranges`` (word positions of exact matches,
    end exclusive), ``n_hit`` (words inside them), ``items`` and ``near`` (items with exact and with proximity matches,
    as sorted strings; one without an id has an empty name and is an item of its own).

    Neither texts nor the benchmark pass through the driver, and both may be of any size, single texts and items too. A null
    text has no words; an empty benchmark or table gives no match; repeated rows (same id and text) get the same result,
    once each; ties of terms as frequent as one another go by their place in the window. Other columns are not looked
    at, whatever their names.
    """
    if window > SLOP:
        raise ValueError(f"windows have {SLOP} words at most")
    index = build_index(docs, id_col, text_col, segment_words)
    grams, items = item_windows(benchmark, item_col, item_text_col, window)
    found = search(index, grams, SLOP, window, block_windows)
    exact = F.col("s").isNotNull()
    hits = found.filter(exact).groupBy("segment", "start").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("ranges"))
    pairs = found.select("segment", "start", "w", exact.alias("exact")).distinct()
    named = items.select(F.col("w").alias("of"), F.struct(F.coalesce("item", F.lit("")).alias("name"), F.col("item").isNull().alias("no_name")).alias("item"))
    if named.count() * 64 <= broadcast_bytes:
        pairs = pairs.join(F.broadcast(named), F.col("w") == F.col("of"))
    else:
        # a window that very many documents and items share is dealt to SALTS tasks
        salted = named.withColumn("salt_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("segment", "start"), F.lit(SALTS)).cast("int")).join(salted, (F.col("w") == F.col("of")) & (F.col("salt") == F.col("salt_of")))
    names = lambda some: F.transform(F.sort_array(F.collect_set(F.when(some, F.col("item")))), lambda x: x["name"])
    per_doc = pairs.groupBy("segment", "start").agg(names(F.col("exact")).alias("items"), names(~F.col("exact")).alias("near"))
    per_doc = per_doc.join(hits, ["segment", "start"], "left").withColumnsRenamed({"segment": "in_segment", "start": "at_start"})
    out = index.filter(F.col("term").isNull()).select("segment", "start", "id", "check", F.col("n").alias("n_words"))
    out = out.join(per_doc, (F.col("segment") == F.col("in_segment")) & (F.col("start") == F.col("at_start")), "left")
    none = F.array().cast("array<string>")
    ranges = F.coalesce("ranges", F.array().cast("array<struct<s:bigint,e:bigint>>"))
    start = F.struct(F.lit(0).cast("bigint").alias("to"), F.lit(0).cast("bigint").alias("n"))
    n_hit = F.aggregate(ranges, start, lambda a, x: F.struct(F.greatest(a["to"], x["e"]).alias("to"), (a["n"] + F.greatest(x["e"] - F.greatest(a["to"], x["s"]), F.lit(0))).cast("bigint").alias("n")), lambda a: a["n"])
    return out.select(F.col("id").alias(id_col), "check", "n_words", ranges.alias("ranges"), n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near", none).alias("near"))


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.size("near").cast("long").alias("n_near"))


def _sql() -> str:
    """The same from words and their places alone; z, r and c are a window's size, a term's rank and the terms that texts have."""
    found = lambda text: f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    near = lambda of, r: f"SELECT DISTINCT {of}.w, {of}.z, {of}.rid, {of}.p FROM {of} JOIN o ON o.w = {of}.w AND o.r = {r} JOIN t ON t.rid = {of}.rid AND t.term = o.term AND t.p BETWEEN {of}.p - {SLOP} AND {of}.p + {SLOP} UNION SELECT w, z, rid, p FROM {of} WHERE z < {r}"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {found('text')} AS ws FROM documents),
t AS (SELECT rid, unnest(ws) AS term, unnest(range(1, len(ws) + 1)) AS p FROM d),
f AS (SELECT term, count(*) AS n FROM t GROUP BY ALL),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, item_id IS NULL AS no_name, {found('text')} AS ws FROM benchmark),
g AS (SELECT DISTINCT item, no_name, CASE WHEN len(ws) < {WINDOW} THEN ws ELSE ws[k:k + {WINDOW} - 1] END AS gram FROM (SELECT *, unnest(range(1, greatest(len(ws) - {WINDOW} + 1, 1) + 1)) AS k FROM b WHERE len(ws) > 0)),
u AS (SELECT row_number() OVER () AS w, len(gram) AS z, gram FROM (SELECT DISTINCT gram FROM g)),
x AS (SELECT rid, z, p, ws[p:p + z - 1] AS gram FROM (SELECT rid, ws, z, unnest(range(1, len(ws) - z + 2)) AS p FROM d, (SELECT DISTINCT z FROM u) WHERE len(ws) >= z)),
h AS (SELECT rid, p, z, w FROM x JOIN u USING (gram, z)),
hit AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + z)) AS q FROM h) GROUP BY ALL),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item, no_name FROM h JOIN u USING (w) JOIN g USING (gram)) GROUP BY ALL),
o AS (SELECT w, z, term, row_number() OVER (PARTITION BY w ORDER BY n, k) AS r, count(*) OVER (PARTITION BY w) AS c FROM (SELECT w, z, unnest(gram) AS term, unnest(range(1, z + 1)) AS k FROM u) JOIN f USING (term)),
n1 AS (SELECT w, z, rid, p FROM o JOIN t USING (term) WHERE r = 1 AND c = z),
n2 AS ({near('n1', 2)}),
n3 AS ({near('n2', 3)}),
nr AS (SELECT rid, count(*) AS n_near FROM (SELECT DISTINCT rid, item, no_name FROM n3 JOIN u USING (w) JOIN g USING (gram)) GROUP BY ALL)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid) LEFT JOIN nr USING (rid)"""


OP6_SQL = _sql()

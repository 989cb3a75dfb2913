"""Collocated phrases, counted in cyclic scans of the corpus' shards."""

from __future__ import annotations

import uuid
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.llm.common import bounded_batches, by_value, cut, hot_join, passing_path, quoted, read, whole

#: What ends a piece, what parts words.
ENDS, GAPS = ".,;:!?\n\x0b\x0c\r", " \t"
#: Bits of the table that tells which phrases have reached the threshold: 4 MB, however large the corpus.
FILTER_BITS = 1 << 25
#: Bytes of text that a task counts at once.
CHUNK_BYTES = 8_000_000
#: Bytes of text for each bucket of hashes, and for each task of the last scan: its phrases combine within a task before they move.
BUCKET_BYTES, NAMING_BYTES = 4_000_000, 64_000_000
#: Bits of a key: 40 of a hash and 3 of the phrase's size.
KEY_BITS = 43
NAMED = "lang string, size int, phrase string, n long"
BLOCK = "bucket long, many int, gaps binary, n binary"

#: A-Z in lower case, one sign for all ends of pieces, one for all gaps.
_TABLE = bytes(0x2E if chr(c) in ENDS else 0x20 if chr(c) in GAPS else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in that order."""
    x = (a * np.uint64(0x9E3779B97F4A7C15) + b) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bits of these keys are set."""
    at = keys >> 3
    return (bits[(at >> 6) & (len(bits) - 1)] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def _levels(lang: str, data: bytes, most_words: int):
    """For each size: the key of the phrase at each word (40 bits of a hash, and its size), whether it lies inside a piece, the
    words as numbers and their names."""
    words = pc.ascii_split_whitespace(pa.array([data.decode()], pa.large_string())).flatten()
    coded = words.filter(pc.not_equal(words, "")).dictionary_encode()
    at, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    seed = xxhash.xxh64_intdigest(lang.encode())
    hashes = first = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in names.to_pylist()), np.uint64, len(names))[at]
    inside = at != pc.index(names, pa.scalar(".", names.type)).as_py()
    for size in range(1, most_words + 1):
        if size > 1:
            if len(at) < size:
                return
            # the hash of a phrase is that of all words but the last, and the last word's
            hashes, inside = _mixed(hashes[:-1], first[size - 1 :]), inside[:-1] & inside[1:]
        yield size, ((hashes >> np.uint64(24)).astype(np.int64) << 3) | size, inside, at, names


def _blocks(keys: np.ndarray, n: np.ndarray, shift: int) -> pa.RecordBatch:
    """Sorted keys and their counts as a row per bucket, the keys' upper bits: gaps between keys byte by byte, lowest bytes first, and
    counts as bytes, those of 255 and more once again in full behind. Three to four bytes a key once Spark has packed them."""
    at = keys >> shift
    edges = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1, [len(keys)]))
    gaps = np.diff(keys, prepend=0)
    gaps[edges[:-1]] = keys[edges[:-1]] - (at[edges[:-1]] << shift)
    low, parts = np.minimum(n, 255).astype(np.uint8), gaps.astype("<i8").view(np.uint8).reshape(-1, 8)
    packed, counts = [], []
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        width = max((int(gaps[i:j].max()).bit_length() + 7) // 8, 1)
        packed.append(parts[i:j, :width].T.tobytes())
        counts.append(low[i:j].tobytes() + n[i:j][n[i:j] >= 255].astype("<i8").tobytes())
    return pa.RecordBatch.from_arrays([pa.array(at[edges[:-1]]), pa.array(np.diff(edges).astype(np.int32)), pa.array(packed, pa.binary()), pa.array(counts, pa.binary())], names=["bucket", "many", "gaps", "n"])


def _unpacked(blocks: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The keys of blocks of one bucket without their upper bits, and their counts, as the blocks hold them."""
    keys, counts = [], []
    for many, gaps, n in zip(blocks["many"].to_pylist(), blocks["gaps"], blocks["n"], strict=True):
        gaps, n = np.frombuffer(gaps.as_buffer(), np.uint8), np.frombuffer(n.as_buffer(), np.uint8)
        wide = np.zeros((many, 8), np.uint8)
        wide[:, : len(gaps) // many] = gaps.reshape(-1, many).T
        keys.append(np.cumsum(wide.view("<i8").ravel()))
        count = n[:many].astype(np.int64)
        count[count == 255] = np.frombuffer(n[many:].tobytes(), "<i8")
        counts.append(count)
    return np.concatenate(keys), np.concatenate(counts)


def _added(blocks: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The different keys of blocks of one bucket, sorted, and the sums of their counts."""
    keys, n = _unpacked(blocks)
    room = 63 - int(keys.max()).bit_length()
    if int(n.max()).bit_length() <= room:  # both fit into a number, which sorts faster
        both = np.sort((keys << room) | n)
        keys, n = both >> room, both & ((1 << room) - 1)
    else:
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(n, first)


def _merged(shift: int, blocks: pa.Table) -> pa.Table:
    """Blocks of one bucket as one."""
    keys, n = _added(blocks)
    return pa.Table.from_batches([_blocks(keys + (blocks["bucket"][0].as_py() << shift), n, shift)])


def _frequent(shift: int, slots: int, threshold: int, most_words: int, blocks: pa.Table) -> pa.Table:
    """The bits of a bucket's keys, of phrases up to ``most_words`` words, that occur ``threshold`` times."""
    keys, n = _added(blocks)
    keys = keys[(n >= threshold) & (keys % 8 <= most_words)] + (blocks["bucket"][0].as_py() << shift)
    slot, bit = (keys >> 9) & (slots - 1), np.uint64(1) << ((keys >> 3) & 63).astype(np.uint64)
    order = np.argsort(slot, kind="stable")
    slot, first = np.unique(slot[order], return_index=True)
    bits = np.bitwise_or.reduceat(bit[order], first) if len(first) else np.zeros(0, np.uint64)
    return pa.table({"slot": slot.astype(np.int64), "bits": bits.view(np.int64)})


def _keys(shift: int, lang: str, data: bytes, most_words: int, now: np.ndarray, before: np.ndarray | None):
    """How often the keys occur of all phrases that are active now and were not at this shard's scan before, as blocks."""
    parts = None
    for size, keys, inside, _, _ in _levels(lang, data, most_words):
        if size == 1:
            take = inside if before is None else np.zeros(len(inside), bool)
        else:
            is_set = _has(now, parts)
            take = inside & is_set[:-1] & is_set[1:]
            if before is not None:
                was_set = _has(before, parts)
                take &= ~(was_set[:-1] & was_set[1:])
        parts = keys
        found, n = np.unique(keys[take], return_counts=True)
        if len(found):
            yield _blocks(found, n.astype(np.int64), shift)


def _phrases(lang: str, data: bytes, most_words: int, often: np.ndarray, _):
    """Name and count of all phrases whose key is frequent, and the number of all words with no name."""
    for size, keys, inside, at, names in _levels(lang, data, most_words):
        if size == 1:
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int32()), pa.array([None], pa.string()), pa.array([int(inside.sum())])], names=["lang", "size", "phrase", "n"])
        places = np.flatnonzero(inside & _has(often, keys))
        code = at[places]
        for k in range(1, size):
            code = (np.unique(code, return_inverse=True)[1] if k > 1 else code) * len(names) + at[places + k]
        _, one, n = np.unique(code, return_index=True, return_counts=True)
        words = [names.take(pa.array(at[places[one] + k])).cast(pa.string()) for k in range(size)]
        phrase = pc.binary_join_element_wise(*words, " ") if size > 1 else words[0]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(one), pa.string()), pa.array(np.full(len(one), size, np.int32)), phrase, pa.array(n.astype(np.int64))], names=["lang", "size", "phrase", "n"])


def _scan(count, most_words: int, chunk_bytes: int, now, before=None):
    """A function for ``mapInArrow`` that passes chunks of (lang, text) to ``count``."""

    def run(batches):
        waiting: dict[str, list[bytes]] = {}
        size = 0

        def flush():
            for lang, texts in waiting.items():
                data, start = b". ".join(texts), 0
                while start < len(data):
                    # a chunk ends where a piece does
                    stop = data.find(b".", start + chunk_bytes) if start + chunk_bytes < len(data) else -1
                    stop = len(data) if stop < 0 else stop
                    yield from count(lang, data[start:stop].replace(b".", b" . ") + b" .", most_words, now.value, before and before.value)
                    start = stop
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_py().encode().translate(_TABLE)
                waiting.setdefault(lang.as_py(), []).append(data)
                size += len(data)
                if size >= chunk_bytes:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def _reached(counts: DataFrame, threshold: int, slots: int, shift: int, most_words: int) -> np.ndarray:
    """The bits of all keys of up to ``most_words`` words that occur ``threshold`` times, by Spark; a table of fixed size comes back."""
    often = counts.groupBy("bucket").applyInArrow(lambda blocks: _frequent(shift, slots, threshold, most_words, blocks), "slot long, bits long")
    table = often.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(slots, np.uint64)
    bits[table["slot"].to_numpy()] = table["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return bits


def phrase_counts(docs: DataFrame, most_words: int = 3, threshold: int = 10, shards: int = 3, lang_col: str = "lang", text_col: str = "text", filter_bits: int = FILTER_BITS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """All phrases of up to ``most_words`` (at most 7) words that occur ``threshold`` times: ``lang``, ``size``, ``phrase``, ``n``; and for each
    language the number of all words, with size 0 and no phrase.

    Dynamic itemset counting. The corpus is written as ``shards`` parts, which are scanned one after the other, over and
    over, all lengths in the same scan. Words are counted from the first scan on. A longer phrase becomes active as soon as
    both phrases of one word less in it have ``threshold`` occurrences so far, and is counted for one full cycle: from the
    next scan until its shards have all been seen. The scans end when no shard is left that lacks an active phrase. So a
    phrase is counted in the first scan of each shard at which it is active, which tasks tell from two tables, that of this
    scan and that of the shard's scan before.

    These tables have ``filter_bits`` bits whatever the corpus, and only they pass through the driver. Scans count 40-bit hashes of phrases,
    which move in sorted blocks, as gaps of some three bytes; what they add up to so far stands in one table bucketed by hash, to which
    each scan appends, so that looking up what has reached the threshold shuffles nothing. A bucket's blocks are added up
    together; there is one for each ``BUCKET_BYTES`` of text, so none grows with the corpus. A hash or a bit that phrases share makes them active or frequent
    without need, never late: an exact check follows, a last scan that names the phrases whose hash is frequent and counts them by name.

    Tasks count ``chunk_bytes`` of text at once (a longer piece whole); Spark combines their counts before and after the shuffle,
    so a frequent phrase moves once a task; a task of the last scan has ``NAMING_BYTES`` of text where that leaves no core idle.
    """
    spark, slots = docs.sparkSession, filter_bits // 64
    shard = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")
    corpus = cut(docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit("und")).alias("lang"), whole(quoted(text_col)).alias("text"), shard.alias("shard")), by="shard")
    now, seen, table, path = np.zeros(slots, np.uint64), [], f"phrases_{uuid.uuid4().hex}", passing_path(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = corpus.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    shift = KEY_BITS - min((size // BUCKET_BYTES).bit_length(), 20)
    tasks = max(spark.sparkContext.defaultParallelism, size // NAMING_BYTES + 1)
    sent = []
    try:
        with bounded_batches(spark):
            while len(seen) < shards or not all(np.array_equal(now, x) for x in seen[-shards:]):
                step, before = len(seen), seen[-shards] if len(seen) >= shards else None
                seen.append(now)
                if step >= shards:
                    seen[step - shards] = None  # no longer needed
                if before is not None and np.array_equal(now, before):
                    continue
                tables = [spark.sparkContext.broadcast(x) for x in (now, before) if x is not None]
                sent += tables
                found = corpus.filter(F.col("shard") == step % shards).select("lang", "text").mapInArrow(_scan(partial(_keys, shift), most_words, chunk_bytes, *tables), BLOCK)
                found.groupBy("bucket").applyInArrow(lambda blocks: _merged(shift, blocks), BLOCK).write.bucketBy(buckets, "bucket").saveAsTable(table, format="parquet", mode="append", path=path)
                while sent:
                    sent.pop().destroy()  # else their files stay in all executors
                now = _reached(spark.table(table), threshold, slots, shift, most_words - 1)
            often = spark.sparkContext.broadcast(_reached(spark.table(table), threshold, slots, shift, most_words))
            sent.append(often)
            named = corpus.select("lang", "text").coalesce(tasks).mapInArrow(_scan(_phrases, most_words, chunk_bytes, often), NAMED)
            return cut(named.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).filter((F.col("n") >= threshold) | (F.col("size") == 0)))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        for x in sent:
            x.destroy()


def collocations(docs: DataFrame, most_words: int = 3, least: int = 10, percent: int = 50, top: int = 2000, lang_col: str = "lang", text_col: str = "text", shards: int = 3, salts: int = 64, **how) -> DataFrame:
    """The ``top`` phrases of each language whose words attract one another: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are split at ``ENDS`` into pieces and these at ``GAPS`` into words, with A-Z in lower case. A phrase of 2 to ``most_words`` words that
    occurs ``a`` >= ``least`` times (see :func:`phrase_counts`) is a candidate. Cut in two, its parts occur ``l`` and ``r`` times; its score
    is floor(1000000 * a * a / (l * r)) at the cut that makes it lowest, the first such cut. A candidate that stands inside a longer one
    with at least ``percent`` per cent of its occurrences is dropped. The rest is ranked by score, occurrences and phrase (as bytes); ``n`` counts all
    words of the language. All numbers are exact: products are decimals of 38 digits, enough for 10**15 occurrences.

    A null text counts as empty, a null language as ``und``; texts of any length are read whole. Ties are settled by the phrase,
    repeated rows count each time. An empty table gives an empty result; other columns are not looked at, whatever their names. Frequent parts are in
    very many phrases: their counts are joined by :func:`~demandpanel.llm.common.hot_join`. A language may hold a third of all
    phrases: its best are found within ``salts`` parts first.
    """
    counted = phrase_counts(docs, most_words, least, shards, lang_col, text_col, **how)
    totals, often = counted.filter("size = 0").select("lang", "n"), counted.filter("size > 0")
    words = F.split("phrase", " ", -1)
    cuts = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(k.alias("k"), F.array_join(F.slice("words", F.lit(1), k), " ").alias("first"), F.array_join(F.slice("words", k + 1, F.col("size") - k), " ").alias("rest")))
    long = often.filter("size > 1").withColumn("words", words)
    at = long.select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(cuts).alias("cut")).select("lang", "phrase", "size", "a", "cut.k", F.struct("lang", "cut.first").alias("first"), F.struct("lang", "cut.rest").alias("rest"))
    part = lambda key, n: often.select(F.struct("lang", "phrase").alias(key), F.col("n").alias(n))
    at = hot_join(at, part("is_first", "l"), "first", "is_first", "l", row_bytes=128)
    at = hot_join(at, part("is_rest", "r"), "rest", "is_rest", "r", row_bytes=128)
    big = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", big("a") * big("a") * F.lit(1_000_000).cast("decimal(7,0)"), big("l") * big("r"))
    best = at.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    inside = long.filter("size > 2").select("lang", "n", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(percent) * F.col("a")))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    kept = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score", F.pmod(F.xxhash64("phrase"), F.lit(salts)).alias("salt"))
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"), most_words=3, least=10, percent=50, top=2000)


#: All lengths are counted plainly.
OP13_SQL = """
WITH pieces AS (
    SELECT lang, piece, row_number() OVER () AS id FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
), words AS MATERIALIZED (
    SELECT lang, id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT lang, id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces)
), three AS MATERIALIZED (
    SELECT lang, w AS x, lead(w, 1) OVER piece AS y, lead(w, 2) OVER piece AS z FROM words WINDOW piece AS (PARTITION BY id ORDER BY i)
), f AS MATERIALIZED (
    SELECT lang, 1 AS size, x AS g, NULL AS x, NULL AS y, NULL AS z, count(*) AS c FROM three GROUP BY ALL
    UNION ALL SELECT lang, 2, x || ' ' || y, x, y, NULL, count(*) FROM three WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
    UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z, x, y, z, count(*) FROM three WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
    SELECT lang, g, size, c AS a, 1 AS k, x AS one, substr(g, length(x) + 2) AS two FROM f WHERE size > 1
    UNION ALL SELECT lang, g, size, c, 2, x || ' ' || y, z FROM f WHERE size = 3
), best AS (
    SELECT p.lang, p.g, size, a, k, x.c AS l, y.c AS r, 1000000::HUGEINT * a * a // (x.c::HUGEINT * y.c) AS score
    FROM cuts p JOIN (SELECT lang || '|' || g AS at, c FROM f) x ON x.at = p.lang || '|' || one JOIN (SELECT lang || '|' || g AS at, c FROM f) y ON y.at = p.lang || '|' || two
    QUALIFY row_number() OVER (PARTITION BY p.lang, p.g ORDER BY score, k) = 1
), inside AS (
    SELECT lang, g, max(c) AS longer FROM (SELECT lang, c, unnest([x || ' ' || y, y || ' ' || z]) AS g FROM f WHERE size = 3) GROUP BY ALL
), ranked AS (
    SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.g) AS rank
    FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.g = b.g WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, g AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang) USING (lang)
WHERE rank <= 2000
"""

by_value(__name__)

"""Packing of tokenized documents into sequences of one length."""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from bisect import bisect_right, insort

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.common import apart, bounded_batches, by_value, cut, kept, quoted, read

by_value(__name__)

CAPACITY = 2048
#: Pieces that one task packs, on average. A group wastes part of its last sequence only.
GROUP = 16384
#: Chunks between spaces whose ids a task remembers, and the longest that it does.
CACHE, LONGEST = 500_000, 64
#: Signs that close a word; each run of them is tokenized apart from the letters before it.
SIGNS = ".,;:!?*#$%&|)"


#: The normalizers and the splitting pattern of a tokenizer whose ids can be looked up by word.
BY_WORDS = (["NFC", "Replace", "Lowercase"], r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _by_words(tokenizer) -> bool:
    """Whether the tokenizer's own description is that of ``BY_WORDS``."""
    said = json.loads(tokenizer.to_str())
    steps = [x["type"] for x in (said["normalizer"] or {}).get("normalizers", [])]
    splits = (said["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return steps == BY_WORDS[0] and splits[0].get("pattern", {}).get("Regex") == BY_WORDS[1] and said["model"].get("end_of_word_suffix") == "</w>"


def _letters(word: str) -> bool:
    """Whether the tokenizer sees letters alone: some letters are none any more once they are composed and lowered."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit numbers, with id 0 at its end.

    A tokenizer that composes and lowers letters, drops white space, and joins neither what stands on both sides of a space nor letters
    and signs (its file says so, see ``BY_WORDS``) is asked for new words only; any other is given whole texts. In the first case ids are looked up by chunk between spaces or line ends, and a chunk of letters and closing signs by its two
    parts; only what is new is tokenized, all new words of a text at once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {"": b""}
        self.by_words = _by_words(self.tokenizer)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, chunks: list[str]) -> None:
        cores = {c: c.rstrip(SIGNS) for c in chunks}
        letters = {w: _letters(w) for w in set(cores.values())}
        plain = [w for w, yes in letters.items() if yes and w not in self.known]
        if plain:
            # a run of letters is one word, and a word's last token says so
            ids = self.encode([" ".join(plain)])[0]
            ends = np.flatnonzero(self.ends[ids]) + 1
            parts = np.split(ids, ends[:-1]) if len(ends) == len(plain) else self.encode(plain)
            self.known.update((w, x.tobytes()) for w, x in zip(plain, parts, strict=True))
        signs = list({c[len(w) :] for c, w in cores.items() if letters[w] and c[len(w) :] not in self.known})
        others = [c for c, w in cores.items() if not letters[w] and c not in self.known]
        for new in (signs, others):
            self.known.update((c, x.tobytes()) for c, x in zip(new, self.encode(new), strict=True))
        for c, w in cores.items():
            if c not in self.known:
                self.known[c] = self.known[w] + self.known[c[len(w) :]]

    def __call__(self, text: str) -> bytes:
        if not self.by_words:
            return self.encode([text])[0].tobytes() + b"\0\0\0\0"
        # the one letter that Python lowers by what surrounds it; and lowering must not come before composing
        if "\u03a3" not in text and unicodedata.is_normalized("NFC", text):
            text = text.lower()
        chunks = text.replace("\n", " ").split(" ")
        if len(self.known) > CACHE:
            self.known = {"": b""}
        new = [c for c in set(chunks) if c not in self.known]
        if new:
            self.learn(new)
        ids = b"".join(map(self.known.__getitem__, chunks))
        for c in new:
            if len(c) > LONGEST:
                self.known.pop(c, None)
        return ids + b"\0\0\0\0"


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each row's tokens: id, ``piece``, ``start``, ``length`` and ``ids_crc32``.

    A document's tokens end with id 0. Only documents of more than ``capacity`` tokens are cut. A null text is empty:
    its one piece is the id 0 alone. The result is a table.
    """

    def cut_up(batches):
        encode = kept(f"encoder {tokenizer}", lambda: Encoder(tokenizer))
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(texts):
                data = encode(text or "")
                n = len(data) // 4
                for k in range(0, n, capacity):
                    part = data[4 * k : 4 * (k + capacity)]
                    row.append(i)
                    piece.append(k // capacity)
                    start.append(k)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=["id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    with bounded_batches(docs.sparkSession):
        return cut(rows.mapInArrow(cut_up, f"id {rows.schema['id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"))


def best_two_fit(lengths, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item.

    A bin takes the largest item that fits again and again. Then its smallest item makes way for the two unpacked
    items that fill the gap it leaves most tightly, if they fill more than it did.
    """
    lengths = np.asarray(lengths)
    held: dict[int, list[int]] = {}
    for i in np.argsort(lengths, kind="stable")[::-1]:
        held.setdefault(int(lengths[i]), []).append(int(i))
    free = sorted(held)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)

    def take(length: int) -> int:
        item = held[length].pop()
        if not held[length]:
            free.pop(bisect_right(free, length) - 1)
        return item

    number = 0
    while free:
        gap, inside = capacity, []
        while free and (k := bisect_right(free, gap)):
            gap -= free[k - 1]
            inside.append((free[k - 1], take(free[k - 1])))
        if gap and free:
            smallest = inside[-1][0]
            room, sizes = gap + smallest, np.array(free)
            large = sizes[(sizes < room) & (2 * sizes >= smallest)]
            if len(large):
                at = np.searchsorted(sizes, np.minimum(room - large, large), "right") - 1
                # an item can't be its own partner
                at -= (at >= 0) & (sizes[at] == large) & (np.array([len(held[int(x)]) for x in large]) < 2)
                both = np.where(at >= 0, large + sizes[at], 0)
                best = int(np.argmax(both))
                if both[best] > smallest:
                    _, out = inside.pop()
                    pair = int(large[best]), int(sizes[at[best]])
                    inside += [(x, take(x)) for x in pair]
                    if not held[smallest]:
                        insort(free, smallest)
                    held[smallest].append(out)
        at = 0
        for length, item in inside:
            bins[item], offsets[item] = number, at
            at += length
        number += 1
    return bins, offsets


def pack(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Packs all rows into sequences of at most ``capacity`` tokens by best-two-fit.

    Returns the pieces (see :func:`pieces`) with ``sequence_id`` and ``offset``, gapless from 0 in each sequence. Pieces
    are dealt by a hash to groups of about ``group``, each packed by one task, so a task's memory is bounded. The same
    rows are packed alike, however the table is partitioned. Repeated rows, and pieces of null ids, are told apart by a
    number and packed each, in different groups; pieces of equal length go by id, piece and that number. A null or empty
    text is one token; texts of any length are tokenized whole. An empty table gives an empty result; other columns are
    not looked at, whatever their names.
    """
    cuts = apart(pieces(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"), id_col, text_col, capacity), "copy")
    groups = -(-max(cuts.count(), 1) // group)
    dealt = cuts.withColumn("group", F.pmod(F.xxhash64(*cuts.columns), F.lit(groups)))
    names = [c for c in cuts.columns if c != "copy"]

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in (*names, "copy")])
        bins, offsets = best_two_fit(table["length"].to_numpy(), capacity)
        number = table["group"].to_numpy() * (1 << 24) + bins
        return table.select(names).append_column("sequence_id", pa.array(number, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    kind = cuts.schema["id"].dataType.simpleString()
    return dealt.groupBy("group").applyInArrow(fill, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint").withColumnRenamed("id", id_col)


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))

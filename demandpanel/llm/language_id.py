"""Language identification with hyperdimensional letter n-gram profiles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.common import bounded_batches, by_value, cut, held_out, quoted, read

by_value(__name__)

DIM = 1024
SEED = 20240
#: Texts whose vectors are made together, and trigram vectors that a task remembers.
TOGETHER, REMEMBERED = 64, 40_000
#: Languages whose prototypes go to every task at once: 4 MB. More are taken in blocks of so many.
BLOCK_LANGUAGES = 1024


class Profiles:
    """Text vectors: the sum over a text's letter trigrams of the product of its letters' random +-1 vectors,
    the first rotated by two places and the second by one. Letters are lower-cased; anything else is a word's edge."""

    def __init__(self, dim: int):
        self.dim = dim
        self.letter = np.full(0x110000, -1, np.int32)  # number of each code point, 0 for what is no letter
        self.vectors = [np.random.default_rng([SEED, 0]).choice(np.array([-1, 1], np.int8), dim)]
        self.forget()

    def forget(self):
        self.place: dict[int, int] = {}
        self.rows = np.empty((4096, self.dim), np.int8)

    def numbers(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        ids = self.letter[codes]
        if (ids < 0).any():
            for c in np.unique(codes[ids < 0]).tolist():
                self.letter[c] = len(self.vectors) if chr(c).isalpha() else 0
                if self.letter[c]:
                    self.vectors.append(np.random.default_rng([SEED, c]).choice(np.array([-1, 1], np.int8), self.dim))
            ids = self.letter[codes]
        ids = np.concatenate([[0], ids, [0]])
        return ids[(ids != 0) | np.concatenate([[True], ids[:-1] != 0])]

    def vector(self, key: int, base: int) -> np.ndarray:
        a, b, c = key // base**2, key // base % base, key % base
        return np.roll(self.vectors[a], 2) * np.roll(self.vectors[b], 1) * self.vectors[c]

    def counted(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text its trigrams' shares, and the trigrams' vectors."""
        each = [self.numbers(t) for t in texts]
        base = 64 if len(self.vectors) <= 64 else 1 << 20
        keys, of = [], []
        for i, x in enumerate(each):
            x = x.astype(np.int64)
            k = (x[:-2] * base + x[1:-1]) * base + x[2:]
            k = k[x[1:-1] != 0]
            keys.append(k)
            of.append(np.full(len(k), i))
        keys, of = np.concatenate(keys), np.concatenate(of)
        if base == 64:
            there = np.flatnonzero(np.bincount(keys, minlength=1))
            small = np.zeros(base**3, np.int32)
            small[there] = np.arange(len(there))
            inverse = small[keys]
        else:
            there, inverse = np.unique(keys, return_inverse=True)
        n = np.maximum(np.bincount(of, minlength=len(texts)), 1)
        shares = np.bincount(of * len(there) + inverse, minlength=len(texts) * len(there)).reshape(len(texts), -1) / n[:, None]
        # a trigram's letters name it whatever the base
        names = [(k // base**2 << 40) + (k // base % base << 20) + k % base for k in there.tolist()]
        new = [x for x in names if x not in self.place]
        if len(self.place) + len(new) > REMEMBERED:
            self.forget()
            new = names
        while len(self.place) + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        for x in new:
            self.rows[len(self.place)] = self.vector(x, 1 << 20)
            self.place[x] = len(self.place)
        return shares.astype(np.float32), self.rows[[self.place[x] for x in names]].astype(np.float32)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> DataFrame:
    """Prototype of each language, as a table (``lang``, ``vector``): the bundled vectors of all its texts, each of weight 1.

    Each task sums its own texts, so what moves is one vector per task and language.
    """

    def sums(batches):
        profiles, total = Profiles(dim), {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(0, len(texts), TOGETHER):
                shares, rows = profiles.counted(texts[k : k + TOGETHER])
                names = langs[k : k + TOGETHER]
                for lang in set(names):
                    total[lang] = total.get(lang, 0) + shares[[x == lang for x in names]].sum(0, dtype=np.float64) @ rows
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["lang", "vector"])

    rows = labelled.select(quoted(text_col).alias("text"), quoted(lang_col).cast("string").alias("lang")).dropna()
    parts = rows.mapInArrow(sums, "lang string, vector array<double>").select("lang", F.posexplode("vector").alias("i", "x"))
    summed = parts.groupBy("lang", "i").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("vector"))
    with bounded_batches(labelled.sparkSession):
        return cut(summed)


def identify(docs: DataFrame, prototypes: DataFrame, id_col: str = "doc_id", text_col: str = "text", dim: int = DIM, block: int = BLOCK_LANGUAGES) -> DataFrame:
    """Each row's id, ``lang_pred`` and ``score``, as a table: the language whose prototype has the largest cosine with the
    text's vector, and that cosine, 0 at least.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. Of tied languages the first by
    name wins. Prototypes are held against the texts in blocks of ``block`` about, one block after the other, so the
    driver and a task never hold more. Texts of any length are read whole; repeated rows get one answer; an empty table
    gives an empty result. Other columns are not looked at, whatever their names.
    """
    blocks = max(-(-prototypes.count() // block), 1)

    def against(names: list[str], vectors: list[list[float]], keep: list[int]):
        """Keeps the columns ``keep`` of id, text, language and score: the text only where another block follows."""
        matrix = np.array([np.array(v) / max(np.linalg.norm(v), 1e-12) for v in vectors], np.float32).reshape(len(names), dim)

        def guess(batches):
            profiles = Profiles(dim)
            for batch in batches:
                texts, lang, score = (batch.column(k).to_pylist() for k in (1, 2, 3))
                for k in range(0, len(texts), TOGETHER):
                    some = texts[k : k + TOGETHER]
                    shares, rows = profiles.counted([x or "" for x in some])
                    if not names or not rows.size:
                        continue
                    vectors = shares @ rows
                    cosine = vectors @ matrix.T / np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
                    best, lettered = cosine.argmax(1), shares.sum(1) > 0
                    for i in np.flatnonzero(lettered).tolist():
                        new = (float(np.clip(cosine[i, best[i]], 0, 1)), names[best[i]])
                        if lang[k + i] is None or (-new[0], new[1]) < (-score[k + i], lang[k + i]):
                            score[k + i], lang[k + i] = new
                columns = [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays([columns[c] for c in keep], names=[("id", "text", "lang", "score")[c] for c in keep])

        return guess

    out = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("score"))
    kind = out.schema["id"].dataType.simpleString()
    for number in range(blocks):
        found = sorted((r["lang"], r["vector"]) for r in prototypes.filter(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == number).collect())
        last = number == blocks - 1
        out = out.mapInArrow(against([x for x, _ in found], [v for _, v in found], [0, 2, 3] if last else [0, 1, 2, 3]), f"id {kind}, {'' if last else 'text string, '}lang string, score double")
    with bounded_batches(docs.sparkSession):
        return cut(out.select(F.col("id").alias(id_col), F.coalesce("lang", F.lit("und")).alias("lang_pred"), "score"))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    hidden = held_out(F.col("doc_id"), 4, 2)
    prototypes = learn(docs.filter(~hidden).select("text", "lang"))
    return identify(docs, prototypes).select("doc_id", hidden.alias("held_out"), "lang_pred", "score")

"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.common import bounded_batches, by_value, cut, held_out, kept, quoted, read, whole

by_value(__name__)

#: Bound of what is fitted: labelled rows.
MOST_LABELS = 60_000
#: A lexicon term occurs in so many toxic texts, and this share of them, at least; PRECISION of its texts are toxic. So a lexicon has
#: at most (different words of a toxic text, on average) / LEAST_SHARE terms.
LEAST_TEXTS, LEAST_SHARE, PRECISION = 3, 0.02, 0.95
#: Letters of a stem, and folds that the lexicon is made without for the trees.
STEM, FOLDS = 4, 3
#: Words between a term and a second person pronoun that count as near, and runs of signs that a task remembers.
NEARBY, REMEMBERED = 5, 40_000

# Pronouns of the second person in English, German, French and Spanish, and look-alikes of letters.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine deiner deinen euch euer ihr ihnen tu toi te ton ta tes vous votre vos usted ustedes ti tú tus vosotros vuestro".split()
LOOK_ALIKES = str.maketrans("013457@$!|", "oieastasil")

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
SPELT = re.compile(r"(?<![^\W_])[^\W_](?:[.\-_* ][^\W_]){3,}(?![^\W_])")
REPEATED = re.compile(r"(\w)\1{2,}")
FEATURES = ("log_words", "word_density", "stem_density", "log_hits", "log_stem_hits", "disguised_density", "log_disguised", "pronoun_density", "near_pronoun_density", "near_pronoun_share", "capitals", "exclamations", "punctuation", "symbols", "digits_in_words", "repeats")


def terms_of(text: str) -> set[str]:
    """The different words of a text, which are looked up in the lexicon; the same words count in :class:`Reader`."""
    return set(WORD.findall(text.lower()))


def stems_of(words: set[str]) -> set[str]:
    return {w[:STEM] for w in words if len(w) > STEM}


class Numbers(dict):
    """Numbers of runs of signs, in the order in which a reader has met them."""

    def __init__(self, meet):
        self.meet = meet

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.meet(chunk)
        return number


class Reader:
    """Dense features of texts by one lexicon. What a run of signs between spaces adds is remembered."""

    def __init__(self, terms: frozenset[str], stems: frozenset[str], pronouns: frozenset[str]):
        self.terms, self.stems, self.pronouns = terms, stems, pronouns
        self.upper = kept("upper", lambda: np.fromiter((chr(c).isupper() for c in range(0x110000)), bool, 0x110000))
        self.forget()

    def forget(self) -> None:
        self.number = Numbers(self.meet)
        self.kinds: list[bytes] = []
        # counts of runs that are new wait for their place in the table, which doubles when it is full
        self.counts: list[tuple[int, int, int, int]] = []
        self.table = np.zeros((0, 4), np.int64)

    def kind(self, w: str) -> int:
        """1 for a term, 2 for a stem, 4 for a pronoun."""
        return (w in self.terms) | (len(w) > STEM and w[:STEM] in self.stems) << 1 | (w in self.pronouns) << 2

    def meet(self, chunk: str) -> None:
        """Files a byte for each word, and the disguised words, loose signs, digits among letters and repeats."""
        repeats = sum(1 for _ in REPEATED.finditer(chunk)) if REPEATED.search(chunk) else 0
        if not repeats and chunk.isalpha():
            self.kinds.append(bytes((self.kind(chunk),)))
            self.counts.append((0, 0, 0, 0))
            return
        found = WORD.findall(chunk)
        core = chunk.strip(".,;:!?\"'()[]{}…»«-*#%&$+=~")
        disguised = signs = digits = 0
        if not core or core.isalpha():
            signs = int(core != chunk and len(chunk) - len(core) >= 3)
        else:
            digits = int(any(c.isdigit() for c in core) and any(c.isalpha() for c in core))
            plain = "".join(c for c in core.translate(LOOK_ALIKES) if c.isalpha())
            disguised = int(plain in self.terms and core not in self.terms)
        if repeats:
            disguised += sum(REPEATED.sub(r"\1", w) in self.terms for w in found if REPEATED.search(w))
        self.kinds.append(bytes(map(self.kind, found)))
        self.counts.append((disguised, signs, digits, repeats))

    def __call__(self, text: str) -> list[float]:
        """In the order of :data:`FEATURES`; densities are shares of the words.

        Disguised hits are lexicon words that show only after look-alikes are turned into letters, repeats are cut to one
        letter or spelt-out words are joined.
        """
        low = text.lower()
        chunks = low.split()
        if len(self.number) > REMEMBERED:
            self.forget()
        numbers = list(map(self.number.__getitem__, chunks))
        if self.counts:
            size = len(self.kinds)
            if size > len(self.table):
                self.table = np.concatenate([self.table[: size - len(self.counts)], np.zeros((size, 4), np.int64)])
            self.table[size - len(self.counts) : size] = self.counts
            self.counts = []
        kinds = np.frombuffer(b"".join(map(self.kinds.__getitem__, numbers)), np.uint8)
        disguised, signs, digits, repeats = self.table[numbers].sum(0).tolist() if numbers else (0, 0, 0, 0)
        disguised += sum("".join(c for c in m.group() if c.isalnum()).translate(LOOK_ALIKES) in self.terms for m in SPELT.finditer(low))
        hits, persons = np.flatnonzero(kinds & 1), np.flatnonzero(kinds & 4)
        stem_hits, near = int(np.count_nonzero(kinds & 2)), 0
        if len(persons) and len(hits):
            k = np.searchsorted(persons, hits)
            before, after = persons[np.maximum(k - 1, 0)], persons[np.minimum(k, len(persons) - 1)]
            near = int((np.minimum(abs(hits - before), abs(hits - after)) <= NEARBY).sum())
        n, chars = max(len(kinds), 1), max(len(text), 1)
        capitals = int(self.upper[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")].sum())
        return [
            float(np.log1p(len(kinds))),
            len(hits) / n,
            stem_hits / n,
            float(np.log1p(len(hits))),
            float(np.log1p(stem_hits)),
            disguised / n,
            float(np.log1p(disguised)),
            len(persons) / n,
            near / n,
            near / max(len(hits), 1),
            capitals / chars,
            text.count("!") / chars,
            sum(text.count(c) for c in ".,;:?-") / chars,
            signs / n,
            digits / n,
            repeats / n,
        ]


@dataclass
class Model:
    terms: frozenset[str]
    stems: frozenset[str]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float


def _features(rows: DataFrame, lexicons: list[tuple[frozenset[str], frozenset[str]]]) -> DataFrame:
    """Of rows whose last two columns are the number of a lexicon and the text, the other columns and ``x``, the features."""
    shared = rows.sparkSession.sparkContext.broadcast((lexicons, frozenset(SECOND_PERSON)))
    keep = rows.columns[:-2]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, pronouns = shared.value
        readers = [Reader(*x, pronouns) for x in sets]
        for batch in batches:
            numbers, texts = (c.to_pylist() for c in batch.columns[-2:])
            x = [readers[k](t) for k, t in zip(numbers, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(x, pa.list_(pa.float64()))], names=[*keep, "x"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(count, f"{kinds}, x array<double>").withColumn("x", array_to_vector("x"))


def _lexicons(texts: DataFrame, column: str, least: int) -> list[frozenset[str]]:
    """The terms of a column that mark toxic texts, counted once a text: FOLDS sets that each leave one fold out, and one of all texts."""
    fold = [F.col("fold") == k for k in range(FOLDS)]
    sums = [F.sum("y").alias("bad"), F.count("*").alias("n"), *(F.sum(F.when(f, F.col("y")).otherwise(0.0)).alias(f"bad{k}") for k, f in enumerate(fold)), *(F.count_if(f).alias(f"n{k}") for k, f in enumerate(fold))]
    seen = texts.select("y", "fold", F.explode(column).alias("term")).groupBy("term").agg(*sums)
    bad = [*(F.col("bad") - F.col(f"bad{k}") for k in range(FOLDS)), F.col("bad")]
    n = [*(F.col("n") - F.col(f"n{k}") for k in range(FOLDS)), F.col("n")]
    sure = F.array(*((b >= least) & (b >= PRECISION * m) for b, m in zip(bad, n, strict=True)))
    # few rows: a term has to be in LEAST_SHARE of the toxic texts
    found = seen.filter(F.exists(sure, lambda x: x)).select("term", sure.alias("sure")).collect()
    return [frozenset(r["term"] for r in found if r["sure"][k]) for k in range(FOLDS + 1)]


def _terms(rows: DataFrame) -> DataFrame:
    """The columns ``y``, ``fold`` and the different ``terms`` and ``stems`` of each text."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [terms_of(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([sorted(w) for w in words], pa.list_(pa.string())), pa.array([sorted(stems_of(w)) for w in words], pa.list_(pa.string()))], names=["y", "fold", "terms", "stems"])

    return cut(rows.select("y", "fold", "text").mapInArrow(split, "y double, fold int, terms array<string>, stems array<string>"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_labels: int = MOST_LABELS) -> Model:
    """Fits on a random sample of ``labels`` (id, label) of about ``most_labels`` rows at most. Equal texts count once, as
    toxic if any of their labels says so, and so do an id's labels.

    The lexicon (words, and stems of four letters, that occur almost only in toxic texts) is made from the whole sample for
    later scoring, and once without each of three folds for the features of that fold, so the trees see how the lexicon does on
    texts it has not seen. A fifth of the sample is kept from the trees and calibrates their probabilities; rows of one
    probability count as one of their number's weight. Only the sample is broadcast. Without a toxic and a clean text to
    grow trees on, the score is the share of toxic labels.
    """
    given = labels.select(quoted(id_col).alias("of"), quoted(label_col).cast("double").alias("y"))
    given = given.filter(F.col("y").isNotNull() & F.col("of").isNotNull()).groupBy("of").agg(F.max("y").alias("y"))
    rate = min(1.0, most_labels / max(given.count(), 1))
    sample = given.filter(F.pmod(F.xxhash64("of", F.lit(5)), F.lit(1 << 30)) < int(rate * (1 << 30)))
    texts = docs.select(quoted(id_col).alias("id"), whole(quoted(text_col)).alias("text")).join(F.broadcast(sample), F.col("id") == F.col("of"))
    rows = texts.groupBy("text").agg(F.max("y").alias("y")).withColumn("check", F.xxhash64("text"))
    with bounded_batches(docs.sparkSession):
        rows = cut(rows.select("y", F.pmod("check", F.lit(FOLDS)).cast("int").alias("fold"), (F.pmod(F.xxhash64("check"), F.lit(5)) == 0).alias("aside"), "text"))
        sums = {r["aside"]: r for r in rows.groupBy("aside").agg(F.sum("y").alias("bad"), F.count("*").alias("n")).collect()}
        n, bad = sum(r["n"] for r in sums.values()), sum(r["bad"] for r in sums.values())
        least = max(LEAST_TEXTS, round(LEAST_SHARE * bad))
        found = _terms(rows)
        lexicons = list(zip(_lexicons(found, "terms", least), _lexicons(found, "stems", least), strict=True))
        prior = (bad + 1) / (n + 2)
        if False not in sums or not 0 < sums[False]["bad"] < sums[False]["n"]:
            return Model(*lexicons[-1], None, None, prior)
        seen = cut(_features(rows.select("y", "aside", "fold", "text"), lexicons))
    grow = seen.filter("NOT aside")
    trees = GBTClassifier(featuresCol="x", labelCol="y", maxIter=15, maxDepth=3, stepSize=0.3, seed=7, minInstancesPerNode=3).fit(grow)
    isotonic = None
    if True in sums and 0 < sums[True]["bad"] < sums[True]["n"]:
        raw = trees.transform(seen.filter("aside")).select("y", vector_to_array("probability")[1].alias("raw"))
        raw = raw.groupBy("raw").agg(F.avg("y").alias("y"), F.count("*").cast("double").alias("weight"))
        isotonic = IsotonicRegression(featuresCol="raw", labelCol="y", weightCol="weight", predictionCol="calibrated").fit(raw)
    return Model(*lexicons[-1], trees, isotonic, prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``check`` (a hash of the text) and ``score`` (0 to 1) of every row, from its whole text, as a table.

    The calibrated probability is a step function; a hundredth of the trees' own probability orders texts within a step.
    Null and empty texts have all counts 0 and get the score of such a text; texts of any length are read whole. Repeated
    and tied rows get the same score; an empty table gives an empty result. Other columns are not looked at, whatever
    their names.
    """
    rows = docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("check"), F.lit(0).alias("which"), whole(quoted(text_col)).alias("text"))
    rows = _features(rows, [(model.terms, model.stems)])
    if model.trees is None:
        out = rows.select("id", "check", F.lit(model.prior).alias("score"))
    else:
        out = model.trees.transform(rows).select("id", "check", vector_to_array("probability")[1].alias("raw"))
        mixed = F.col("raw")
        if model.calibration is not None:
            out = model.calibration.transform(out)
            mixed = F.lit(0.99) * F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)) + F.lit(0.01) * F.col("raw")
        out = out.select("id", "check", mixed.alias("score"))
    with bounded_batches(docs.sparkSession):
        return cut(out).withColumnRenamed("id", id_col)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    hidden = held_out(F.col("doc_id"), 5, 0)
    model = fit(docs, labels.filter(~hidden).select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", hidden.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

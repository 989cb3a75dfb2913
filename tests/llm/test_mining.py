"""Mixing, the conversation trie and phrase mining against plain versions, with nulls, ties, repeated rows and hot groups."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from demandpanel.llm import mixing, phrases, trie

DOCS = "doc_id long, text string, lang string, source string"
CLASH = """id size source_size target copies taken no_source text_key copy rank weight full sizes weights each offset before at to n piece row key same total turn_ n_
word words phrase hash lang_ shard k start end seq band low keys chars depth node parent owner shards leaf saving over heavy count""".split()


def clash(df):
    return df.select("*", *(F.lit(f"mine {c}").alias(c) for c in CLASH if c not in df.columns))


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


# 11 mixing


def plain_targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] > most * sizes[s] * total}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        out |= {s: Fraction(most * sizes[s]) for s in over}
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


@pytest.fixture(scope="module")
def sourced(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(["w"] * draw.choice([0, 1, 3, 8, 40])), "en", draw.choice(["a", "a", "a", "b", "B", "é", "\U0001f600", "", "z", None])) for i in range(600)]
    rows += [(7, "the same row", "en", "z")] * 90 + [(None, None, None, None), (None, "x y", None, None), (700, "a\x0bb\x85c \t d", "en", "b")]
    return spark.createDataFrame(rows, DOCS)


def test_mix(spark, sourced):
    got = mixing.mix(clash(sourced)).collect()
    assert len(got) == sourced.count()
    sizes, longest, want = defaultdict(int), defaultdict(int), Counter()
    for r in sourced.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
        want[r.doc_id, r.source, n] += 1
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == want
    target, taken, count = plain_targets(sizes), Counter(), Counter(r.source for r in got)
    copies = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - float(target[r.source])) < 1e-6 * (1 + r.target)
        expected = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert 0 <= r.copies <= 2 and abs(r.copies - expected) < 1
        taken[r.source] += r.copies * r["size"]
        copies[r.source] += r.copies
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s]
        assert abs(copies[s] - count[s] * (target[s] / sizes[s] if sizes[s] else 0)) < 1
    assert rows_of(mixing.mix(sourced.repartition(7))) == rows_of(mixing.mix(sourced.coalesce(1)))


def test_mix_emits_documents(sourced):
    docs = clash(sourced)
    mixed = mixing.mix(docs)
    out = mixing.emit(docs, mixed)
    assert out.columns == docs.columns
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in out.collect()) == +want


@pytest.mark.parametrize("weights,share,most", [((1,), 1.0, 1), ((5, 1), 2.0, 2), ((3, 1, 2), 0.25, 2)])
def test_targets(spark, weights, share, most):
    sizes = {"a": 10, "b": 1000, "c": 0, "d": 20, None: 5, "": 70}
    rows = spark.createDataFrame([(s is None, s or "", n) for s, n in sizes.items()], "no_source boolean, source string, source_size long")
    got = {None if r.no_source else r.source: r.target for r in mixing.targets(rows, weights, share, most).collect()}
    want = plain_targets(sizes, weights, Fraction(share), most)
    assert got == pytest.approx({s: float(x) for s, x in want.items()})


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    only = spark.createDataFrame([(1, "", "en", "a"), (2, None, "en", None)], DOCS)
    assert [(r.target, r["size"] * r.copies) for r in mixing.mix(only).collect()] == [(0.0, 0), (0.0, 0)]


# 12 trie


def plain_trie(sequences):
    """sequences: id -> list of (role, text)."""
    at = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            at[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for p in at:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(at, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in kids[p]) or 1
        saved[p] = sum(saved[x] for x in kids[p]) + (len(at[p]) - 1) * (len(p[-1][1]) if p else 0)
    ends = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(at[p]) if len(sequences[c]) == len(p)).encode()).hexdigest()
    return sorted((min(at[p]), len(p), min(at[p[:-1]]) if p else None, len(at[p]), len(kids[p]), leaves[p], saved[p], ends(p)) for p in at)


def nodes_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_double_array():
    draw = random.Random(3)
    seqs = sorted({tuple(draw.randint(1, 90) for _ in range(draw.randint(0, 6))) for _ in range(2000)})
    base, check, order = trie.double_array(seqs)
    assert sorted(order) == [i for i, c in enumerate(check) if c != -1]
    known = {s[:d] for s in seqs for d in range(len(s) + 1)}
    assert len(order) == len(known)

    def walk(seq):
        s = 0
        for i in seq:
            t = base[s] + i
            if t >= len(check) or check[t] != s:
                return None
            s = t
        return s

    assert len({walk(s) for s in known}) == len(known) and None not in {walk(s) for s in known}
    wrong = [s + (i,) for s in list(known)[:300] for i in (1, 50, 91) if s + (i,) not in known]
    assert all(walk(s) is None for s in wrong)


@pytest.mark.parametrize("band,shard", [(4096, 10_000), (4096, 25), (3, 7), (1, 2)])
def test_trie(spark, band, shard):
    draw = random.Random(8)
    said = ["a", "bb", "", "été", "a"]
    seqs = {c: [(draw.choice("ua"), draw.choice(said)) for _ in range(draw.choice([1, 2, 2, 5, 9]))] for c in range(-40, 160)}
    for c in range(300, 380):  # a hot beginning, and copies
        seqs[c] = [("s", "be kind"), ("u", "hi")] + seqs[c % 50][: c % 4]
    seqs[999] = [("u", str(i)) for i in range(40)]
    seqs[998] = seqs[999][:17] + [("u", "other")]
    rows = [(c, d if d else None, r if r != "u" else None, t if t else None) for c, turns in seqs.items() for d, (r, t) in enumerate(turns)]
    rows += [(None, 1, "u", "lost")]
    draw.shuffle(rows)
    df = clash(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    plain = {c: [("" if r == "u" else r, t) for r, t in turns] for c, turns in seqs.items()}
    assert nodes_of(trie.prefix_trie(df, band, shard)) == plain_trie(plain)


def test_trie_with_turnless_tied_and_repeated(spark):
    rows = [(1, 1, "u", "x"), (1, 1, "u", "x"), (2, 5, "u", "x"), (2, 5, "u", "y")]
    keys = trie.turn_keys(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    members = spark.createDataFrame([(1,), (2,), (0,), (8,)], "conv_id long")
    got = nodes_of(trie.trie(keys, members))
    by_key = sorted([("u", "x"), ("u", "y")], key=lambda t: hashlib.sha256(f"1:{t[0]}{t[1]}".encode()).hexdigest()[:32])
    assert got == plain_trie({0: [], 8: [], 1: [("u", "x"), ("u", "x")], 2: by_key})
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert trie.prefix_trie(empty).count() == 0


def test_ids_over_many_blocks(spark):
    rows = spark.range(-3, 200_000, 1).selectExpr("id AS conv_id", "0 AS turn", "'u' AS role", "'same' AS text")
    got = nodes_of(trie.prefix_trie(rows))
    digest = hashlib.sha256(",".join(map(str, range(-3, 200_000))).encode()).hexdigest()
    assert [(r[1], r[3], r[-1]) for r in got] == [(0, 200_003, hashlib.sha256(b"").hexdigest()), (1, 200_003, digest)]


# 13 phrases


def plain_counts(rows, most):
    f = defaultdict(Counter)
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, most + 1):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f


def plain_phrases(rows, most, least, percent, top):
    out = []
    for lang, f in plain_counts(rows, most).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        long = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in long.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in long.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, n, -s))
    return sorted(out)


@pytest.fixture(scope="module")
def spoken(spark):
    draw = random.Random(2)
    word = ["new", "York", "city", "of", "the", "É", "é", "a b", "in"]
    rows = []
    for i in range(400):
        text = " ".join(draw.choices(word, k=draw.randint(0, 30)))
        rows.append((i, draw.choice(["New York City, of the", "of\tthe new\nYork. in", "IN the  City!of"]) + " " + text, draw.choice(["en", "en", "en", "fr", None]), "s"))
    rows += [(1, "bond james bond", "en", "s")] * 40 + [(None, None, "en", None), (5, "", None, None), (6, " . ,\x0b;", "de", None), (7, "x", "de", None)]
    # frequent in one shard only at the end of the scans
    rows += [(i, "late comer arrives", "fr", "s") for i in range(900, 912)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("most,shards,bits,chunk", [(3, 3, 1 << 26, 1 << 20), (3, 1, 1 << 16, 50), (4, 5, 64, 200), (2, 7, 1 << 12, 1000)])
def test_phrases(spoken, most, shards, bits, chunk):
    rows = [(r.lang, r.text) for r in spoken.collect()]
    for percent, top in ((50, 2000), (10, 7)):
        got = phrases.collocations(clash(spoken), most, 10, percent, top, shards=shards, filter_bits=bits, chunk_bytes=chunk)
        assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, most, 10, percent, top)


def test_phrase_counts_are_whole(spoken):
    f = plain_counts([(r.lang, r.text) for r in spoken.collect()], 3)
    got = phrases.phrase_counts(spoken, 3, 10, 3).collect()
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in got if r["size"]} == {(lang, p): n for lang, c in f.items() for p, n in c.items() if n >= 10}
    assert {r.lang: r.n for r in got if not r["size"]} == {lang: sum(n for p, n in c.items() if len(p) == 1) for lang, c in f.items() if c} | {lang: 0 for lang, c in f.items() if not c}


def test_phrases_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, None)], DOCS)).count() == 0


def test_counts_move_in_blocks_of_few_bytes():
    """A scan's keys and counts come back whole from blocks, take less than half of two numbers, and add up beyond 255 and 2**40."""
    shift = phrases.KEY_BITS - 6
    rng = np.random.default_rng(7)
    keys = np.unique(rng.integers(0, 1 << phrases.KEY_BITS, 50_000))
    n = np.where(np.arange(len(keys)) % 9 == 0, rng.integers(255, 1 << 41, len(keys)), 1)
    one = pa.Table.from_batches([phrases._blocks(keys, n, shift)])
    few = pa.Table.from_batches([phrases._blocks(keys[::3], n[::3], shift)])
    assert one.num_rows == 64
    plain = pa.Table.from_batches([phrases._blocks(keys, np.ones_like(keys), shift)])
    assert sum(len(x) for c in ("gaps", "n") for x in plain[c].to_pylist()) < 8 * len(keys)
    want = dict(zip(keys.tolist(), n.tolist(), strict=True))
    for k, v in zip(keys[::3].tolist(), n[::3].tolist(), strict=True):
        want[k] += v
    got = {}
    for b in range(64):
        blocks = pa.concat_tables([t.filter(pc.equal(t["bucket"], b)) for t in (one, few)])
        found, sums = phrases._unpacked(phrases._merged(shift, blocks))
        assert (np.diff(found) > 0).all()
        got |= dict(zip((found + (b << shift)).tolist(), sums.tolist(), strict=True))
    assert got == want

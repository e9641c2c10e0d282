"""Context-tree weighting against its definition; the base score against plain counts."""

import functools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.llm import lm


def symbols(t, depth):
    """Nothing before the text, its bytes, its end: the end and what is before are no byte."""
    return [0] * depth + [256 + x for x in t] + [0]


def by_definition(train, texts, depth):
    """log10 probabilities by the recursive definition, decision by decision."""
    grams = Counter()
    for t in train:
        x = symbols(t, depth)
        grams.update(tuple(x[i - depth : i + 1]) for i in range(depth, len(x)))

    def path(s):
        """(node, bit) of a symbol's decisions: byte or end, then the bits of a byte."""
        at = 1
        for k in range(8, -1, -1):
            bit = s >> k & 1
            yield at, bit
            if not s:
                return
            at = 2 * at + bit

    @functools.lru_cache(None)
    def tallies(context):
        out = {}
        for g, n in grams.items():
            if g[depth - len(context) : depth] == context:
                for node, bit in path(g[depth]):
                    out.setdefault(node, [0, 0])[bit] += n
        return out

    @functools.lru_cache(None)
    def kids(context):
        return {g[depth - len(context) - 1 : depth] for g in grams if g[depth - len(context) : depth] == context}

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @functools.lru_cache(None)
    def log_weighted(context, node):
        own = log_kt(*tallies(context).get(node, (0, 0)))
        if len(context) == depth:
            return own
        low, high = sorted((own, sum(log_weighted(k, node) for k in kids(context))))
        return math.log(0.5) + high + math.log1p(math.exp(low - high))

    out = []
    for t in texts:
        x, total = symbols(t, depth), 0.0
        for i in range(depth, len(x)):
            for node, bit in path(x[i]):
                one, left = 0.0, 1.0
                for d in range(depth + 1):
                    c = tuple(x[i - d : i])
                    a, b = tallies(c).get(node, (0, 0))
                    stop = math.exp(math.log(0.5) + log_kt(a, b) - log_weighted(c, node)) if d < depth else 1.0
                    one += left * stop * (b + 0.5) / (a + b + 1)
                    left *= 1 - stop
                total += math.log10(one if bit else 1 - one)
        out.append(total)
    return out


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


@pytest.mark.parametrize("depth, top", [(1, 2), (3, 2), (4, 0)])
def test_scores_are_context_tree_weighting(spark, monkeypatch, depth, top):
    """Against the definition: rare and common contexts, a NUL in a text, unseen bytes; in one part and block and in many."""
    rows = [(i, f"common words come again {i % 4} ") for i in range(9)] + [(20 + i, f"rare {chr(97 + i)}q{i}") for i in range(5)] + [(30, "abra\0cadabra"), (31, "abra"), (32, ""), (33, None), (None, "Ünseen"), (7, "common words")]
    want = by_definition([(t or "").encode().lower() for i, t in rows if not held(i)], [(t or "").encode().lower() for _, t in rows], depth)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for part, block, batch in ((1 << 20, 1 << 20, 1 << 20), (16, 3, 40)):
        monkeypatch.setattr(lm, "BATCH", batch)
        got = sorted((repr(r.doc_id), round(r.score, 4)) for r in lm.score(df, depth=depth, top=top, part_bytes=part, block=block).collect())
        expected = sorted((repr(i), w) for (i, _), w in zip(rows, want))
        assert [a for a, _ in got] == [a for a, _ in expected] and all(abs(a[1] - b[1]) < 1e-3 for a, b in zip(got, expected))


def test_probabilities_sum_to_one():
    """Over the 257 symbols after any context, seen or not."""
    k, _ = lm.gram_keys([b"some text to learn from", b"other\0text"], 2)
    k, c = lm.tallied(k, 1)
    levels = lm.descend(lm.climb(k, c, 2, 0, 2)[0])
    for context in sorted({int(x) >> 9 for x in k}) + [(256 + 200) << 9 | 1]:
        every = np.array([context << 9 | s for s in [0, *range(256, 512)]])
        assert abs((10.0 ** lm.predicted(every, levels, 2)).sum() - 1) < 1e-9


def test_grams():
    """Long and empty texts end to end: the context's latest symbol is the highest, the end is no NUL."""
    texts = [b"ab\0", b"", b"x" * 50]
    got, begin = lm.gram_keys(texts, 3)
    want = []
    for t in texts:
        x = symbols(t, 3)
        want += [x[i - 1] << 27 | x[i - 2] << 18 | x[i - 3] << 9 | x[i] for i in range(3, len(x))]
    assert got.tolist() == want and begin.tolist() == [0, 4, 5]
    a = np.array([3, 9, 1 << 60])
    assert lm.unpack(lm.pack(a, True), 3, True).tolist() == a.tolist() and lm.unpack(lm.pack(-a), 3).tolist() == (-a).tolist()


def test_scores(spark):
    words = "alpha beta gamma delta the of and".split()
    rows = [(i, " ".join(words[(i * k) % 7] for k in range(1, 40))) for i in range(60)] + [(900, None), (901, ""), (902, "UNSEEN wörds Alpha"), (None, "the null"), (5, "of"), (903, "x" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("s")).withColumn("key", F.lit(0)).repartition(3)
    for heavy in (lm.HEAVY, 4):  # with few words looked up in tasks, the others are joined
        got = lm.score(df, heavy=heavy).collect()
        assert len(got) == len(rows)
        out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
        tok = lambda t: (t or "").encode().lower().split() + [b""]
        c = Counter(w for i, t in rows if not out(i) for w in tok(t))
        n, v = sum(c.values()), len(c)
        want = sorted((repr(i), out(i), len(tok(t)), sum(w in c for w in tok(t)), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tok(t)), 6)) for i, t in rows)
        assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
        assert {r.train_tokens for r in got} == {n}
    new = [r for r in got if r.held_out and r.n_bytes > 50 and r.doc_id < 60]
    assert new and sum(r.bits_per_byte for r in new) / len(new) < 2.5  # eight bits without a model
    assert lm.score(df.limit(0)).count() == 0


def test_six_bytes_of_context(spark):
    """The registered depth: scores equal those of the definition over contexts of six bytes, and differ from five."""
    rows = [(i, f"abcdef{i % 3} xbcdef{(i + 1) % 3} " * 6) for i in range(14)]
    train, texts = [t.encode() for i, t in rows if not held(i)], [t.encode() for _, t in rows]
    want = {depth: by_definition(train, texts, depth) for depth in (5, 6)}
    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(abs(got[i] - want[6][i]) < 1e-3 < abs(want[5][i] - want[6][i]) for i in got)

"""The stages, each on what the one before kept, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import brute_components, brute_repeats, brute_simhash, prose

import corpus_pipeline
from dialoom.llm import pieces, simhash
from dialoom.llm.queries import MODEL


def test_stages(spark, tmp_path):
    rng = random.Random(6)
    base = [prose(rng, 80) for _ in range(14)]
    passage = prose(rng, 40)
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(base)]
    rows += [(30, base[0], "en", "s0", 0), (31, base[1] + "\nHome | News | About", "en", "s1", 0), (32, None, "en", "s1", 0), (33, "too short.", "en", "s1", 0), (None, prose(rng, 70), "de", None, 0)]
    rows += [(40 + k, prose(rng, 60) + "\n" + passage, "en", "s2", 0) for k in range(3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
        assert k == 4 or docs.columns == columns
        seen.append(docs.collect())
    clean, near, cut, mixed, ids = seen
    assert Counter(r.doc_id for r in clean) == Counter(r[0] for r in rows if r[0] not in (32, 33))
    text = {r.doc_id: r.text for r in clean}
    assert text[31] == base[1] and text[0] == base[0] and all(r.n_chars == len(r.text) for r in clean)
    named = sorted(i for i in text if i is not None)
    roots = brute_components([brute_simhash(text[i]) for i in named])
    least = {}
    for i, r in zip(named, roots):
        least.setdefault(r, i)
    assert sorted(r.doc_id for r in near if r.doc_id is not None) == sorted(least.values()) and 30 not in least.values() and any(r.doc_id is None for r in near)
    order = sorted(near, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    want = brute_repeats([(r.doc_id, r.text) for r in order])
    left = {r.doc_id: r.text for r in cut}
    assert all(len(left[i].encode()) == n - gone for i, (n, gone, *_) in want.items() if n > gone)
    assert passage in left[40] and passage[5:-5] not in left[41] and passage[5:-5] not in left[42]
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= set(left) and max(copies.values()) <= 3
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert sum(words(r.text) for r in mixed) > 0.7 * sum(words(t) for t in left.values())
    assert Counter(r.doc_id for r in ids) == copies
    m = pieces.load(MODEL)
    assert all(m.decode(r.ids) == left[r.doc_id] and r.round_trip for r in ids)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(ids)
    assert docs.where(F.col("n_tokens") != F.size("ids")).isEmpty()


def test_edited_near_copies_leave(spark):
    """Copies with an edited word go, at five words and similarity 0.8; those below stay. All pairs are compared by brute force."""
    rng = random.Random(8)
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    texts = []
    for _ in range(12):
        base = prose(rng, 120).split()
        texts.append(base)
        for edits in (1, 2, 2, 3, 8):
            copy = list(base)
            for at in rng.sample(range(120), edits):
                copy[at] = f"edit{rng.randrange(1000)}"
            texts.append(copy)
    texts = [" ".join(t) for t in texts]
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(i):
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    want = sorted(set(root))
    assert 12 < len(want) < len(texts)
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == want
    assert corpus_pipeline.near_dedup(spark, df.limit(0), "").count() == 0


def test_unlinked_texts_of_one_id_stay(spark):
    """A repeated id loses repeated rows and near copies only."""
    rng = random.Random(4)
    a, b = prose(rng, 80), prose(rng, 80)
    rows = [(1, a, "en", "s", 0), (1, b, "en", "s", 0), (1, a, "de", "s", 0), (2, b, "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(tuple(r) for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == sorted([(1, a, "de", "s", 0), (1, b, "en", "s", 0)])


def pairs_checked(monkeypatch):
    """The pairs that each call of the exact check is given, from now on."""
    calls, check = [], simhash.verified

    def counted(pairs, *rest):
        calls.append({(r.a, r.b) for r in pairs.collect()})
        return check(pairs, *rest)

    monkeypatch.setattr(simhash, "verified", counted)
    return calls


def nodes_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return df, [r.node for r in df.select("doc_id", simhash.text_node(F.col("text")).alias("node")).orderBy("doc_id").collect()]


def test_unlike_texts_of_a_group_are_not_shipped(spark, monkeypatch):
    """Texts that share passages but are less than 0.8 alike cost no exact check each (F1)."""
    rng = random.Random(12)
    base = prose(rng, 200).split()
    texts = []
    for k in range(120):
        copy = list(base)
        for at in rng.sample(range(200), 24):
            copy[at] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    calls = pairs_checked(monkeypatch)
    df, _ = nodes_of(spark, texts)
    assert simhash.similar_texts(df, 5, 0.8).count() == 0
    assert sum(map(len, calls)) < 5 * len(texts) < 120 * 119 / 2 / 10


@pytest.mark.parametrize("bits", [None, 0])
def test_simhash_proposes_near_copies(spark, monkeypatch, bits):
    """The Gray-ordered indexes propose near copies (F2); whatever they miss is found as well."""
    rng = random.Random(13)
    if bits is not None:
        monkeypatch.setattr(simhash, "NEAR_BITS", bits)
        monkeypatch.setattr(simhash, "WIDE_BITS", bits)
    texts = [prose(rng, 150) for _ in range(20)]
    for t in texts[:20]:
        for edits in (1, 3):
            copy = t.split()
            for at in rng.sample(range(150), edits):
                copy[at] = f"edit{rng.randrange(1000)}"
            texts.append(" ".join(copy))
    sets = [simhash.shingle_set(t, 5) for t in texts]
    alike = [(i, j) for j in range(len(texts)) for i in range(j) if (k := len(np.intersect1d(sets[i], sets[j]))) >= 0.8 * (len(sets[i]) + len(sets[j]) - k)]
    assert len(alike) >= 40
    asked, calls = [], pairs_checked(monkeypatch)
    found = simhash.links

    def counted(*args, **kw):
        out = found(*args, **kw)
        asked.append({(r.a, r.b) for r in out.collect()})
        return out

    monkeypatch.setattr(simhash, "links", counted)
    df, node = nodes_of(spark, texts)
    got = {r.node: r.component for r in simhash.similar_texts(df, 5, 0.8).collect()}
    label = list(range(len(texts)))
    for _ in label:
        for i, j in alike:
            label[i] = label[j] = min(label[i], label[j])
    groups = {frozenset(n for n, x in zip(node, label) if x == g) for g in set(label)}
    parts = {c: frozenset(n for n in got if got[n] == c) for c in set(got.values())}
    assert set(parts.values()) == {g for g in groups if len(g) > 1}
    fp = [simhash.signed(simhash.majority(h.view(np.uint64))) for h in sets]
    apart = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    assert len(asked) == 1 and all(apart(a, b) <= simhash.NEAR_BITS for a, b in asked[0])
    if bits is None:
        assert {frozenset((fp[i], fp[j])) for i, j in alike} & {frozenset(x) for x in asked[0]}
        assert len({n for pair in calls[0] for n in pair} & set(got)) == len(got)


@pytest.mark.parametrize("most", [8, 4096])
def test_nearest_of_many_bits(spark, most):
    """Links of up to five bits: pairs that are that near, one at least for each word that has such a pair (F2)."""
    rng = random.Random(14)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in fps[:30]:
        for bits in (1, 4, 5, 6):
            fps.append(f ^ sum(1 << b for b in rng.sample(range(64), bits)))
    apart = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    got = [(r.a, r.b) for r in simhash.links(df, 5, most, nearest=True).collect()]
    assert got and all(0 < apart(a, b) <= 5 for a, b in got)
    met = {x & (2**64 - 1) for pair in got for x in pair}
    assert met == {f for f in fps if any(0 < apart(f, g) <= 5 for g in fps)}


def test_sketches_never_exceed_the_difference():
    """Sketches of any two sizes differ in no more bits than the sets in keys (F1)."""
    rng = np.random.default_rng(15)
    for m, n, both in ((1, 1, 0), (1, 1, 1), (300, 280, 250), (5000, 90, 60), (3000, 2900, 2800), (40_000, 300, 300)):
        keys = np.unique(rng.integers(-(2**63), 2**63 - 1, m + n - both))
        x, y = keys[:m], keys[m - both :]
        differ = len(np.setxor1d(x, y))
        s, t = simhash.sketch(x), simhash.sketch(y)
        for words in {min(len(s), len(t)), simhash.KEY_SKETCH // 64}:
            bits = int(np.bitwise_count(simhash.folded(s, words) ^ simhash.folded(t, words)).sum())
            assert bits <= differ and (both < len(x) or both < len(y) or bits == 0)


def test_pairs_come_from_the_first_key_they_share(spark, monkeypatch):
    """Texts just below 0.8 share many keys; each pair of them is given about once, not under every key."""
    rng = random.Random(16)
    base, texts, counts = prose(rng, 200).split(), [], []
    for at in range(4, 190, 11):
        texts.append(" ".join([*base[:at], *(f"edit{at}x{x}" for x in range(7)), *base[at + 7 :]]))
    real = type(spark.range(1)).mapInArrow

    def counted(self, run, schema, *args, **kw):
        out = real(self, run, schema, *args, **kw)
        if {"of", "small"} <= set(self.columns):
            counts.append((out.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", counted)
    df, _ = nodes_of(spark, texts)
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert simhash.similar_texts(df, 5, 0.8).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    (rows, pairs), = counts
    assert pairs >= 100 and rows <= 1.2 * pairs, (rows, pairs)


def test_workers_forget(spark, monkeypatch):
    """Idle workers stay beside the JVM: tasks of another kind drop the model and the units that encoding remembers."""
    docs, runs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema, *a, **k: runs.append(run) or self)
    simhash.fingerprints(docs)
    simhash.prints(docs, 5)
    pieces.encode(docs, MODEL)
    for run, left in zip(runs, (False, False, True), strict=True):
        pieces.load(MODEL).encode_batch(["some units to remember"])
        assert list(run(iter([]))) == [] and (pieces.load.cache_info().currsize > 0) == left


def test_common_units_outlive_rare_ones(monkeypatch):
    """Units of every batch are encoded once, and what is remembered stays bounded."""
    m, seen = pieces.Pieces(open(MODEL, "rb").read()), Counter()
    viterbi = m._viterbi
    monkeypatch.setattr(m, "_viterbi", lambda us: seen.update(us) or viterbi(us))
    monkeypatch.setattr(pieces, "REMEMBERED", 400)
    rng = random.Random(7)
    for _ in range(60):
        rare = " ".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(5))
        text = "common words " + rare
        assert m.encode_batch([text]) == [pieces.load(MODEL).encode_batch([text])[0]]
        assert sum(map(len, [*m.known, *m.before])) <= 400 + 2 * len(text) + 10
    assert seen["▁common"] == seen["▁words"] == 1

"""Each operator against brute force on small tables with nulls, ties, repeats and odd texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from dialoom.llm import digests, html, mixing, pieces, quality, simhash, suffixes, urls
from dialoom.llm.chat import escape, format_chats, read_back, read_parts, text_parts, under_mask, unescape

LONG = " ".join(f"w{k % 97}" for k in range(20_000)) + "."
WORDS = "the of and to in is was for on that with as by at from this are or an be".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice("abcdefghij") for _ in range(n)) + "."


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(20 + i, base[i].replace("the", "teh", 1), "en", "s0") for i in range(4)]  # near copies
    rows += [(40, base[0], "en", None), (41, None, None, None), (42, "", "en", "s1"), (43, " \t\n", "en", "s1"), (44, "ÀÉ Ünïcode\u0000 \ud7ff", "de", "s9"), (45, LONG, "en", "s0"), (None, "no id here", "en", "s2"), (46, "x" * 500, "en", "s2"), (47, "ab " * 200, "en", "s2")]
    rows += [(7, base[7], "en", "s1")]  # a repeated row
    return rows


@pytest.fixture(scope="module")
def frame(spark, docs):
    # Columns that clash with names used inside.
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    return df.withColumn("n", F.lit(1)).withColumn("size", F.lit("x")).withColumn("w", F.lit(None).cast("string")).withColumn("rate", F.lit(0)).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def brute_quality(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit), failed


def test_quality_counts(spark, docs, frame, empty):
    got = quality.quality(frame).collect()
    assert len(got) == len(docs)
    want = sorted((repr(i), brute_quality(t)) for i, t, *_ in docs)
    assert sorted((repr(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got) == want
    kept = {r.doc_id for r in got if r.kept}
    assert {0, 5, 11, 40} <= kept and not kept & {41, 42, 43, 46, 47, None}
    assert quality.quality(empty).count() == 0


def test_quality_lines(spark):
    rng = random.Random(1)
    good = "\n".join(prose(rng, 12) for _ in range(10))
    bad = {"menu": "Home | News | About", "licence": "Licensed under a licence of some kind.", "open": "a line without an end", "symbols": "a### b$$$ c%%% d&&& e***.", "shout": "ALL OF THIS IS SHOUTED OUT."}
    rows = [(1, good)] + [(10 + k, good + "\n" + b) for k, b in enumerate(bad.values())] + [(90, "\n".join([good, *["no end " + prose(rng, 12)[:-1] for _ in range(10)]]))]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].clean_text == good and got[1].lost_chars == 0
    for k in range(len(bad)):
        assert got[10 + k].clean_text == good and got[10 + k].kept
    assert not got[90].kept


def brute_simhash(t):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                parent[find(a)] = find(b)
    return [find(x) for x in range(len(fps))]


@pytest.mark.parametrize("most", [4096, 40])
def test_simhash_links(spark, most, monkeypatch):
    rng = random.Random(9)
    fps = {0, (1 << 64) - 1}
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(6):
            fps.add(x)
            x ^= 1 << rng.randrange(64) | (1 << rng.randrange(64))
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    comp = {r.node: r.component for r in simhash.components(simhash.links(df, 2, most)).collect()}
    roots = brute_components(fps)
    least = {}
    for f, r in zip(map(simhash.signed, fps), roots):
        least[r] = min(least.get(r, f), f)
    assert [comp.get(f, f) for f in map(simhash.signed, fps)] == [least[r] for r in roots]


def test_simhash_documents(spark, docs, frame, empty):
    got = simhash.near_duplicates(frame).collect()
    assert sorted((repr(r.doc_id), r.fingerprint) for r in got) == sorted((repr(i), f"{brute_simhash(t):016x}") for i, t, *_ in docs)
    fps = [brute_simhash(t) for _, t, *_ in docs]
    groups = defaultdict(list)
    for d, r in zip(docs, brute_components(fps)):
        groups[r].append(d[0])
    least = {i: min((x for x in g if x is not None), default=None) for g in groups.values() for i in g}
    assert all(r.component_id == least[r.doc_id] for r in got)
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_rows_without_ids(spark, monkeypatch):
    """They link, and join what meets only through them; a hot fingerprint among them too."""
    fp = {"a": 0, "b": 3, "c": 15, "d": 255 << 40, "e": 511 << 40}
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, width: docs.replace({k: str(v) for k, v in fp.items()}, subset="text").select("doc_id", F.col("text").cast("long").alias("fp")))
    rows = [(1, "a"), (None, "b"), (2, "c"), (None, "d"), (None, "e"), (None, "b"), *[(100 + k, "c") for k in range(50)]]
    got = sorted((repr(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted((repr(i), f"{fp[t]:016x}", 1 if t in "abc" else None) for i, t in rows)


def test_gray_index_finds_all():
    import numpy as np

    rng = np.random.default_rng(3)
    fp = np.unique(rng.integers(0, 1 << 12, 600, np.uint64) << np.uint64(20))
    i, j = simhash.GrayIndex(fp).pairs(2)
    want = {(a, b) for a in range(len(fp)) for b in range(a + 1, len(fp)) if int(fp[a] ^ fp[b]).bit_count() <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_fingerprints(spark, docs, frame, empty, monkeypatch):
    for rows in (500, 4):
        monkeypatch.setattr(digests, "RANGE_ROWS", rows)
        got = digests.fingerprint(frame).collect()
        ordered = sorted(docs, key=lambda r: ((1, -r[0]) if r[0] is not None else (2, 0), [-ord(c) for c in r[1] or ""]))
        want = []
        for k, (i, t, *_) in enumerate(ordered):
            t, nxt = t or "", ordered[(k + 1) % len(ordered)][1] or ""
            n = len(t) // 3
            e = t[: len(t) - n] + nxt[:n]
            want.append((repr(i), len(t), hashlib.sha256(e.encode()).hexdigest(), float(digests.canonical(t) == digests.canonical(e))))
        assert sorted((repr(r.doc_id), r.n_chars, r.edited_sha256, r.near_edited) for r in got) == sorted(want)
    by = defaultdict(set)
    for r in got:
        by[r.fingerprint].add(digests.canonical(dict((i, t) for i, t, *_ in docs)[r.doc_id]))
    assert all(len(x) == 1 for x in by.values())
    one = spark.createDataFrame([(3, "abc def")], "doc_id long, text string")
    assert digests.fingerprint(one).first().near_next == 1.0
    assert digests.fingerprint(empty).count() == 0
    assert digests.canonical("ＡＢ\u00a0 ß\n") == digests.canonical("ab SS")


def test_fingerprints_of_great_ids_and_clashes(spark, monkeypatch):
    """Ids beyond 2 ** 53 beside a null one keep their order; texts that share a digest are told apart, edited ones too."""
    big = (1 << 62) + 1
    rows = [(big + k, f"text number {k} of some length") for k in range(40)] + [(None, "without an id")]
    monkeypatch.setattr(digests, "RANGE_ROWS", 3)
    got = {r.doc_id: r for r in digests.fingerprint(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    ordered = [r for r in sorted(rows[:-1], reverse=True)] + rows[-1:]
    for (i, t), (_, nxt) in zip(ordered, ordered[1:] + ordered[:1]):
        n = len(t) // 3
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - n] + nxt[:n]).encode()).hexdigest()
    short = [(3, "aab"), (2, "aac"), (1, "aab"), (0, "b")]  # edited: aaa, aaa, aab, b
    monkeypatch.setattr(digests, "repeated", lambda found: b"\xff" * (digests.SLOTS // 8))
    monkeypatch.setattr(digests, "same_bytes", lambda t: t.select("digest").distinct())  # no texts with one digest are known
    got = {r.doc_id: r for r in digests.fingerprint(spark.createDataFrame(short, "doc_id long, text string")).collect()}
    assert got[3].fingerprint == got[1].fingerprint == got[1].edited_fingerprint != got[2].fingerprint and "-" in got[1].edited_fingerprint


def test_same_bytes_tells_collisions_apart(spark):
    t = spark.createDataFrame([("d1", bytearray(b"a")), ("d1", bytearray(b"a")), ("d2", bytearray(b"a")), ("d2", bytearray(b"b"))], "digest string, canon binary")
    assert [r.digest for r in digests.same_bytes(t).collect()] == ["d2"]


def brute_repeats(docs, n=100):
    seen, out = set(), {}
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if b[p : p + n] in seen:
                gone[p : p + n] = b"\1" * n
            seen.add(b[p : p + n])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("most", [2000, 3])
def test_suffix_repeats(spark, most, monkeypatch):
    rng = random.Random(4)
    base = prose(rng, 400).replace("a", "é")
    rows = []
    for i in range(30):
        t = list(base)
        for _ in range(rng.randint(0, 12)):
            t[rng.randrange(len(t))] = "X"
        at = rng.randrange(1500)
        rows.append((i, "".join(t)[at : at + rng.randint(60, 900)]))
    rows += [(50, None), (51, ""), (52, "a" * 700), (53, "ab" * 250), (54, "a" * 99), (55, "a" * 100), (56, rows[0][1]), (57, base + base)]
    plain = suffixes.spans
    monkeypatch.setattr(suffixes, "spans", lambda d, n: plain(d, n, most))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("d", F.lit(0)).withColumn("runs", F.lit("x")).repartition(3)
    got = {r.doc_id: r for r in suffixes.remove_repeats(df).collect()}
    want = brute_repeats(rows)
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == want
    assert all("\ufffd" not in r.kept_text for r in got.values())
    assert got[56].kept_text == ""


def test_suffix_edges(spark, empty):
    assert suffixes.remove_repeats(empty).count() == 0
    t = "abc " * 60
    rows = [(1, t), (1, t), (1, t + "more"), (None, t)]  # alike rows are one document; another text of the id comes later or before; null last
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 4
    assert [r.n_removed for r in got if r.doc_id is None] == [240]


def test_deep_shallow_order():
    import numpy as np

    rng = np.random.default_rng(2)
    for length in (100, 24, 9):
        for k in (1, 2, 4):
            data = np.tile(rng.integers(0, k, 150, np.uint8), 4)
            pos = np.arange(len(data) - length + 1)
            order, same = suffixes.deep_shallow(data, pos, length)
            text = [data[p : p + length].tobytes() for p in pos]
            want = sorted(pos.tolist(), key=lambda p: (text[p], p))
            assert order.tolist() == want
            assert same.tolist() == [False] + [text[a] == text[b] for a, b in zip(want, want[1:])]


def test_url_parts_and_rules(spark):
    cases = {
        "https://A.Example.NET/en/x?q=1#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "http://notexample.com/de/1": ("notexample.com", "/de/1", None, "allow"),
        "http://m.example.com/de/1": ("m.example.com", "/de/1", "example.com/de/", "block"),
        "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
        "http://x.net": ("x.net", "", None, "allow"),
        "x.net/de": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "ftp://É.Org?x://y": ("É.org", "", None, "allow"),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string").withColumn("host", F.lit("h")).withColumn("n", F.lit(0))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df).collect()}
    assert got == dict(enumerate(cases.values()))
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_url_templates(spark):
    rows = [(k, f"http://h.com/spam/{k}.html", True) for k in range(30)] + [(100 + k, f"http://h.com/news/{k}.html", False) for k in range(30)]
    rows += [(200, "http://h.com/spam/999.html", None), (201, "http://h.com/news/999.html", None), (202, "http://h.com/other/1", None)]
    rows += [(300 + k, f"http://wide.com/u/name{'x' * k}", k % 2 == 0) for k in range(30)]
    df = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[2] is not None], "page_id long, bad boolean")
    got = {r.page_id: r for r in urls.judge_urls(df, (), labels).collect()}
    assert [got[k].verdict for k in (200, 201, 202)] == ["block", "allow", "allow"]
    assert {got[k].template for k in range(300, 330)} == {"u/**"}


def brute_tree(rows, least=5, z=1.96, weight=4.0):
    """{(host, segments): (template, share of bad)} of rows (host, segments, bad), by plain recursion."""
    labelled = [bad for *_, bad in rows if bad is not None]
    prior = sum(labelled) / len(labelled) if labelled else 0.0
    out = {}

    def count(some):
        return len([1 for r in some if r[2] is not None]), len([1 for r in some if r[2]])

    def walk(some, k, name, near):
        n, b = count(some)
        near = (n, b) if n >= least else near
        kids = defaultdict(list)
        for r in some:
            if len(r[1]) == k:
                share = (near[1] + weight * prior) / (near[0] + weight) if near else prior
                out[r[0], r[1]] = (name, share, bool(near) and share >= 0.8)
            else:
                kids[r[1][k]].append(r)
        all_n, all_b = count([r for x in kids.values() for r in x])
        groups = defaultdict(list)
        for seg, x in kids.items():
            m, c = count(x)
            alone = len(kids) == 1
            if m >= least and not alone:
                alone = all_n - m < least
                if not alone:
                    p = all_b / all_n
                    alone = abs(c / m - (all_b - c) / (all_n - m)) > z * (p * (1 - p) * (1 / m + 1 / (all_n - m))) ** 0.5
            groups[seg if alone else "**"] += x
        for seg, x in groups.items():
            walk(x, k + 1, f"{name}/{seg}" if name else seg, near)

    for host in {r[0] for r in rows}:
        walk([r for r in rows if r[0] == host], 0, "", None)
    return out


def test_url_tree_against_recursion(spark):
    """All levels, hosts with one label, many siblings with one bad branch among them, tails of long paths, repeated rows."""
    rng = random.Random(17)
    rows = []
    for h in ("a.com", "b.com", "c.com"):
        for _ in range(250):
            segs = tuple(rng.choice(("x", "y", "news", "spam", f"n{chr(97 + rng.randrange(26))}")) for _ in range(rng.randint(0, 4)))
            bad = None if rng.random() < (0.2, 0.6, 0.97)["abc".index(h[0])] else rng.random() < (0.95 if "spam" in segs else 0.1)
            rows.append((h, segs, bad))
    rows += [("wide.com", (f"s{chr(97 + k // 26)}{chr(97 + k % 26)}", "p"), k == 7) for k in range(60) for _ in range(40)]  # one all bad among many
    rows += [("deep.com", tuple("abcdefghijkl"), True)] * 40 + [("deep.com", tuple("abcdefghijzz"), None)]
    df = spark.createDataFrame([(k, f"http://{h}/{'/'.join(s)}", b) for k, (h, s, b) in enumerate(rows)], "page_id long, url string, bad boolean")
    labels = df.where("bad IS NOT NULL").select("page_id", "bad")
    got = {r.page_id: r for r in urls.judge_urls(df.select("page_id", "url"), (), labels).collect()}
    cut = [(h, s if len(s) <= 8 else (*s[:7], "***"), b) for h, s, b in rows]
    want = brute_tree(cut)
    for k, (h, s, _) in enumerate(cut):
        template, share, reject = want[h, s]
        assert (got[k].template, got[k].verdict) == (template, "block" if reject else "allow") and abs(got[k].template_purity - share) < 1e-9
    blocked = {cut[k][:2] for k in got if got[k].verdict == "block"}
    assert {s[0] for h, s in blocked if h == "wide.com"} == {"sah"} and got[len(rows) - 1].verdict == "block"
    twice = df.unionByName(df).select("page_id", "url")
    assert urls.judge_urls(twice, (), labels).count() == 2 * len(rows)
    long = spark.createDataFrame([(1, "http://l.com/" + "a/" * 100_000), (2, None)], "page_id long, url string")
    assert {(r.page_id, r.verdict) for r in urls.judge_urls(long).collect()} == {(1, "allow"), (2, "allow")}


def test_chat_round_trip(spark):
    nasty = [r"\### Assistant: </turn> ok", "<|end|>", "<\\|end|>", "\\", "a\\\\<|turn:user|>|\\>", "", None, "line\nline", "é🙂 <|"]
    rows = [(k, t, r, x) for k, x in enumerate(nasty) for t, r in ((0, "user"), (1, "assistant"))] + [(99, t, "assistant" if t % 2 else "user", f"t{t}") for t in (3, 1, 2, 0)] + [(100, 0, "assistant", "same"), (100, 0, "assistant", "same"), (101, 0, None, "no role")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit("p")).withColumn("k", F.lit(0))
    d = format_chats(text_parts(df)).withColumn("turns", read_back(F.col("formatted"))).withColumn("loss", under_mask(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in d.collect()}
    for k, x in enumerate(nasty):
        assert [(t.role, t.text) for t in got[k].turns] == [("user", x or ""), ("assistant", x or "")]
        assert got[k].loss == (x or "")
    assert [t.text for t in got[99].turns] == ["t0", "t1", "t2", "t3"] and got[99].loss == "t1t3"
    assert got[100].loss == "samesame" and got[101].turns[0].role == ""
    assert format_chats(text_parts(df.limit(0))).count() == 0
    s = spark.createDataFrame([(x,) for x in nasty if x is not None], "t string").select("t", unescape(escape(F.col("t"))).alias("u"), escape(F.col("t")).alias("e"))
    assert all(r.t == r.u and "<|" not in r.e and "|>" not in r.e for r in s.collect())


def test_chat_parts(spark):
    parts = [("text", "look ", None, 0), ("image", None, "a.png", 3), ("audio", None, "b.wav", 10), (None, "<|end|>", None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], "conv_id long, turn long, role string, parts array<struct<kind:string,text:string,ref:string,units:bigint>>")
    r = format_chats(df).first()
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [("image", "a.png", 768), ("audio", "b.wav", 250)]
    assert r.attachment_tokens == 1018 and r.formatted.count("<|image|>") == 1 and r.formatted.count("<|end|>") == 2
    nasty = [("text", "<|image|>", None, 0), ("image", None, "a", 1), ("document", None, "b", 2), ("text", "\\<|audio|>\\", None, 0), ("audio", None, "c", 1)]
    odd = [(2, 0, "user", nasty), (2, 1, "<|image|>", [("text", "", None, 0)]), (2, 2, "assistant", [("image", None, "d", 1)])]
    d = format_chats(spark.createDataFrame(odd, df.schema)).select(read_parts(F.col("formatted")).alias("t"), "attachments").first()
    assert [(t.role, [(p.kind, p.text) for p in t.parts]) for t in d.t] == [("user", [(k, x or "") for k, x, *_ in nasty]), ("<|image|>", []), ("assistant", [("image", "")])]
    assert [p.kind for t in d.t for p in t.parts if p.kind != "text"] == [a.kind for a in d.attachments]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><a href="/">Site</a></header><nav><ul><li><a>Home</a></li></ul></nav>
<div id="cookie-notice">We use cookies, say the long lines of this notice that nobody reads at all.</div>%s
<aside>Related things to read</aside><form><label>Mail</label><input></form><script>var a = "<p>no</p>";</script><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize(
    "body, want",
    [
        ("<article><h1>A &amp; B</h1><p>One\n  two <b>three</b><p>Four<br>five<div class='ad'>Buy</div><section id='comments'><p>First!</p></section></article>", "A & B One two three Four five"),
        ("<main><header><h1>Head</h1></header><p>Body text that is long enough to be read.</p></main>", "Head Body text that is long enough to be read."),
        ("<div class='content'><p>" + "Plain words run on in this paragraph without end. " * 6 + "</p><p>" + "And more words follow in the next one as well. " * 6 + "</p></div>", None),
    ],
)
def test_html(body, want):
    got = html.main_text(PAGE % body)
    if want is None:
        want = " ".join(("Plain words run on in this paragraph without end. " * 6 + "And more words follow in the next one as well. " * 6).split())
    assert got == want


def test_html_ratios_choose_within_the_container():
    text = "Plain words run on in this paragraph without end."
    links = "".join(f"<li><a href='/{k}'>Elsewhere {k}</a></li>" for k in range(8))
    got = html.main_text(PAGE % f"<article><h1>Head</h1><p>{text}</p><p>{text}</p><ul>{links}</ul></article>")
    assert got.startswith(f"Head {text} {text}") and "Elsewhere 4" not in got and "Elsewhere 7" not in got


def test_html_survives_any_markup():
    """Random pieces of broken markup, and the end cut off anywhere."""
    rng = random.Random(12)
    bits = ["<![foo[", "<![ x", "]]>", "<!--", "-->", "<!doctype", "<?php", "<a =/f>", "</", "<", ">", "<p", "<p class='", "&#", "&#x110000;", "&amp", "<b><i>", "</i>", "<script>", "</script", "<div class=ad>", "</div></div>", "<article>", "words of text ", "\0", "<textarea>", "<!>", "<li/>"]
    for _ in range(1500):
        page = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        for part in (page, page[: rng.randint(0, len(page))]):
            assert isinstance(html.main_text(part), str)
    text = "Plain words run on in this paragraph without end."
    for bad in ("<![foo[b]]>", "<![ x>", "<!x y>", "<?x?>", "<a =/f></a>", "</ x>"):
        assert html.main_text(f"<article><p>{text}</p>{bad}<p>{text}</p></article>") == f"{text} {text}"


@pytest.mark.parametrize("piece", ["<b>x</i>", "<div><p>x", "<!-- x", "<a href='x", "</p", "<span class=ad>x", "<![x"])
def test_html_time_is_linear(piece):
    import time

    def took(n):
        began = time.process_time()
        html.main_text("<div>" + piece * n)
        return time.process_time() - began

    took(2000)
    assert took(40_000) < 60 * max(took(2000), 0.01)


def labelled_page(rng, named):
    """A page with what surrounds articles, and its text."""
    sentence = lambda n: " ".join(rng.choice(WORDS) + rng.choice("abcdefghij") for _ in range(n)).capitalize() + "."
    parts, want = [], []
    for k in range(rng.randint(2, 9)):
        t = sentence(rng.choice((3, 25, 40, 60)))
        parts.append(rng.choice((f"<p>{t}</p>", f"<p>{t}", f"<div>{t}</div>", f"<p><em>{t}</em></p>")))
        want.append(t)
        if rng.random() < 0.3:
            h = sentence(3)
            t = sentence(30)
            parts.append(f"<h2>{h}</h2><p>{t}</p>")
            want += [h, t]
    parts.append(f"<p>{(t := sentence(35))}</p>")
    want.append(t)
    inner = "".join(parts)
    title = sentence(5)
    menu = "".join(f"<li><a href='/{k}'>{sentence(1)}</a></li>" for k in range(rng.randint(3, 12)))
    ad = f"<div class='{rng.choice(('ad', 'promo-box', 'cookie-notice'))}'>{sentence(20)}</div>"
    body = f"<{named}><h1>{title}</h1>{inner}</{named.split()[0]}>" if named else f"<h1>{title}</h1>{inner}"
    side = f"<div class='sidebar'><p>{sentence(15)}</p></div>" if rng.random() < 0.5 else f"<aside>{sentence(12)}</aside>"
    reply = f"<div class='comments'><p>{sentence(20)}</p><p>{sentence(6)}</p></div>" if rng.random() < 0.5 else ""
    end = rng.choice(("<footer>{}</footer>", "<div class='site-footer'>{}</div>", "<ul><li><a href='/x'>{}</a></li></ul>")).format(sentence(6))
    page = f"<html><head><title>{title}</title></head><body><nav><ul>{menu}</ul></nav>{ad}{body}{side}{reply}<form><label>{sentence(2)}</label></form><script>var x = '<p>{sentence(9)}</p>';</script>{end}</body></html>"
    return page, " ".join([title, *want])


@pytest.mark.parametrize("named", ["article", "main", "div", "div class='legal-news'", ""])
def test_html_labelled_pages(named):
    """Precision and recall of words over 200 pages with and without named containers."""
    rng = random.Random(named)
    hit = found = there = 0
    for _ in range(200):
        page, want = labelled_page(rng, named)
        a, b = Counter(html.main_text(page).split()), Counter(want.split())
        hit, found, there = hit + sum((a & b).values()), found + sum(a.values()), there + sum(b.values())
    least = 0.97 if named else 0.9  # without any container, short paragraphs at either end are lost
    assert hit / found >= 0.97 and hit / there >= least, (hit / found, hit / there)
    print(named, hit / found, hit / there)


def test_html_clusters_decide():
    """The dense text picks the article, the container and its span; nothing else tells these pages' parts apart."""
    text = "Plain words run on in this paragraph without end, and more of them follow."
    thin = "".join(f"<p><a href='/{k}'>More {k}</a> <b>x</b></p>" for k in range(6))
    assert html.main_text(f"<article><p>{text}</p><p>{text}</p></article><article>{thin}</article>") == f"{text} {text}"
    assert html.main_text(f"<body><div>{thin}</div><div><h2>Head</h2><p>{text}</p><p>Short.</p><p>{text}</p></div><div>{thin}</div></body>") == f"Head {text} Short. {text}"
    swapped = html.main_text(f"<body><div>{text} {text} {text}</div><article><p>a</p></article></body>")
    assert swapped == f"{text} {text} {text}"
    assert html.main_text(f"<article><p>{text}<label>lab</label></p></article>") == text


def test_html_table(spark):
    df = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", "<<<>&bogus; <p"), (4, "u", PAGE % "<article><p>x</p></article>"), (4, "u", PAGE % "<article><p>x</p></article>"), (5, "u", "<article><p>" + "long text " * 200_000 + "</p></article>"), (None, "v", "<p>no id</p>")], "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract(df).collect()}
    assert got[1] == ("", 0) and got[2] == ("", 0) and got[4] == ("x", 1) and got[5][1] == 1_999_999 and got[None] == ("no id", 5) and html.extract(df).count() == 7
    assert html.extract(df.limit(0)).count() == 0


def test_mix(spark, docs, frame, empty):
    got = mixing.mix(frame).collect()
    assert len(got) == len(docs)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(int)
    for _, t, _, s in docs:
        by[s] += size(t)
    names = sorted((s for s in by if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, total, goal = set(names), sum(by.values()), {}
    while True:
        level = (total - sum(3 * by[s] for s in names if s not in left)) / max(1, sum(weight[s] for s in left))
        over = {s for s in left if weight[s] * level > 3 * by[s]}
        if not over:
            break
        left -= over
    goal = {s: weight[s] * level if s in left else 3 * by[s] for s in names}
    taken = defaultdict(int)
    for r in got:
        assert r.taken <= 3 * r.size and r.source_size == by[r.source] and abs(r.target - goal[r.source]) < 1e-6 * max(1, goal[r.source])
        taken[r.source] += r.taken
    for s in names:
        most = max(size(t) for _, t, _, x in docs if x == s)
        assert abs(taken[s] - goal[s]) <= most
    key = lambda rows: sorted((repr(r.doc_id), r.size, r.taken) for r in rows)
    assert key(mixing.mix(frame.repartition(5)).collect()) == key(got)
    assert mixing.mix(empty).count() == 0


def test_mix_repeated_rows(spark):
    """Rows alike in id and text, or without ids, are rounded one by one; the rates are those of the dual's solution."""
    import math

    rows = [(None, "a b c d", "x")] * 100 + [(k, f"w{k} " * (k % 7 + 1), "y") for k in range(150)] + [(5, "one text", "y"), (5, "another text here", "y")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for some in (df, df.repartition(7)):
        got = mixing.mix(some, most=3).collect()
        for source in "xy":
            mine = [r for r in got if r.source == source]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)
    # The dual by bisection: sum of size * min(3, exp(lam * size / mean)) = target.
    mine = [r for r in got if r.source == "y"]
    mean, low, high = sum(r.size for r in mine) / len(mine), -50.0, 50.0
    for _ in range(200):
        lam = (low + high) / 2
        low, high = (lam, high) if sum(r.size * min(3, math.exp(lam * r.size / mean)) for r in mine) < mine[0].target else (low, lam)
    assert all(abs(r.rate - min(3, math.exp(lam * r.size / mean))) < 1e-6 for r in mine)


def unigram(words):
    """A tiny unigram model file."""
    import struct

    def field(number, kind, data):
        return bytes([number << 3 | kind]) + (bytes([len(data)]) + data if kind == 2 else data)

    out = field(1, 2, field(1, 2, b"<unk>") + field(2, 5, struct.pack("<f", 0.0)) + field(3, 0, b"\x02"))
    for w, s in words.items():
        out += field(1, 2, field(1, 2, w.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, b"\x01"))
    return out + field(2, 2, field(3, 0, b"\x01")) + field(3, 2, field(3, 0, b"\x01") + field(4, 0, b"\x00"))


def test_viterbi_against_all_paths():
    rng = random.Random(8)
    vocab = {"▁": -3.0, **{c: -4.0 - k / 10 for k, c in enumerate("abc")}}
    for _ in range(40):
        vocab.setdefault(rng.choice(["", "▁"]) + "".join(rng.choice("abc") for _ in range(rng.randint(1, 4))), -rng.random() * 6 - 1)
    m = pieces.Pieces(unigram(vocab))

    def best(u):
        at = [(0.0, ())] + [(-1e9, ())] * len(u)
        for e in range(1, len(u) + 1):
            for s in range(e):
                w = u[s:e]
                score = float(m.score[m.id_of[w]]) if w in m.id_of else m.low if e - s == 1 else None
                if score is not None and at[s][0] + score > at[e][0]:
                    at[e] = (at[s][0] + score, at[s][1] + (m.id_of.get(w, m.unknown),))
        return at[-1]

    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))) for _ in range(50)] + ["abxcab", ""]
    for t, ids in zip(texts, m.encode_batch(texts)):
        total = sum(float(m.score[i]) if i != m.unknown else m.low for i in ids)
        want = sum(best(u)[0] for u in m.units.findall(m.normal(t)))
        assert abs(total - want) < 1e-9
        if "x" not in t:
            assert m.decode(ids) == t


def test_pieces_equal_the_library(spark, docs, frame, empty):
    import sentencepiece as sp
    from dialoom.llm.queries import MODEL

    p = sp.SentencePieceProcessor(model_file=MODEL)
    m = pieces.load(MODEL)
    texts = [t or "" for _, t, *_ in docs] + ["  two  spaces ", "日本語 🙂", "a" * 300, "▁", "<s>", "tab\tand\nline"]
    assert m.encode_batch(texts) == p.encode(texts)
    got = pieces.encode(frame, MODEL).collect()
    assert len(got) == len(docs) and all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
    assert pieces.encode(empty, MODEL).count() == 0
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(frame.where("doc_id < 45"), MODEL), MODEL).collect()}
    assert all(back[i] == re.sub(" +", " ", t or "").strip(" ") or not m.squeeze and back[i] == (t or "") for i, t, *_ in docs if i is not None and i < 45)
    assert pieces.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), MODEL).where("text = ''").count() == 2


def test_viterbi_gives_the_merges():
    """Made words, every pair of pieces and long units: the same ids as merging one by one, and as the library."""
    import sentencepiece as sp

    from dialoom.llm.queries import MODEL

    rng, m, p = random.Random(31), pieces.load(MODEL), sp.SentencePieceProcessor(model_file=MODEL)
    some = [t for t in m.id_of if "▁" not in t]
    units = ["".join(rng.choice("aabcdeéinorst▁日") for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    units += [rng.choice(some) + rng.choice(some) for _ in range(5000)] + ["aaaa" * 50, "".join(rng.choice(some) for _ in range(300)), "ä" * 99, "ab" * 500]
    by_length = defaultdict(list)
    for u in units:
        by_length[len(u)].append(u)
    for us in by_length.values():
        assert [memoryview(x).cast("i").tolist() for x in m._viterbi(us)] == [m._fallback(u, m._by_merges(u)[0]) for u in us]
    texts = [u.replace("▁", " ") for u in units]
    assert m.encode_batch(texts) == p.encode(texts)

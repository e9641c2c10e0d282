"""Language-model scores by context-tree weighting over bytes, beside a word-count base."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from dialoom.llm.common import discard, release, stored

#: Bytes of context. Every context that occurs is a node.
DEPTH = 6
#: Contexts of up to this many bytes are joined on the driver: the alphabet bounds them, not the corpus. Longer ones stay in tasks.
TOP = 2
#: A symbol: 0 is what stands before a text and after it, 256 + b the byte b. Seven of nine bits fit a long.
SYMBOL, BITS = 511, 9
#: Bytes of text that look up their grams together, positions that are worked on at once, and grams weighted at once.
BATCH, CHUNK, BLOCK = 12_000_000, 1_000_000, 100_000
#: Parts that the contexts are dealt to: one for so many bytes of text, and at most so many.
PART_BYTES, MOST_PARTS = 8_000_000, 4096
#: Words with at least this share of the training tokens (so at most this many) are looked up in each task.
HEAVY = 1 << 19
LOG_PI = float(np.log(np.pi))


def low(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit keys of words; the end token is the empty word. Among 10 million words a shared key has a chance of 3e-6."""
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)).view(np.int64)


def gram_keys(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of each byte and of each end, and the place of each text's first one.

    A gram has the context from its latest symbol on, then the coded symbol, the
    lowest, so shorter contexts are prefixes. The end is a symbol of its own, so that no text's
    code begins another's.
    """
    pad = b"\0" * depth
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t, b"\0")), np.uint8).astype(np.int64) + 256
    sizes = np.array([len(t) + 1 for t in texts])
    begin = np.cumsum(sizes) - sizes
    first = begin + (np.arange(len(texts)) + 1) * depth
    for k in range(-depth, 0):
        data[first + k] = 0
    data[first + sizes - 1] = 0
    n = len(data) - depth
    g = np.zeros(n, np.int64)
    for k in [*range(1, depth + 1), 0]:
        g <<= BITS
        g |= data[depth - k : depth - k + n]
    coded = np.ones(n, bool)
    for k in range(depth):  # places of the padding of all texts but the first
        coded[first[1:] - 2 * depth + k] = False
    return g[coded], begin


def chunks(texts: list[bytes], size: int = 0) -> Iterator[list[bytes]]:
    """Lists of texts of about ``CHUNK`` bytes, one text at least."""
    part, at = [], 0
    for t in texts:
        part.append(t)
        at += len(t) + 1
        if at >= (size or CHUNK):
            yield part
            part, at = [], 0
    if part:
        yield part


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    by = np.argsort(k, kind="stable")
    k = k[by]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    return k[first], np.add.reduceat(c[by], first)


def tallied(g: np.ndarray, weight: int) -> tuple[np.ndarray, np.ndarray]:
    g = np.sort(g)
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    return g[first], np.diff(np.r_[first, len(g)]) * weight


def part_of(keys: np.ndarray, parts: int, shift: int) -> np.ndarray:
    """The part of each gram, by the latest symbols of its context, those above ``shift`` bits: whole subtrees."""
    root = (keys >> shift).astype(np.uint64)
    return ((root * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def pack(a: np.ndarray, sort: bool = False) -> bytes:
    """Longs as compressed bytes, by place of the byte; sorted ones by their steps."""
    a = np.diff(a, prepend=0) if sort else a
    return pa.compress(np.ascontiguousarray(a.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpack(b: bytes, n: int, sort: bool = False) -> np.ndarray:
    a = np.frombuffer(pa.decompress(b, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    a = np.ascontiguousarray(a.T).reshape(-1).view(np.int64)
    return np.cumsum(a) if sort else a


def pack_logs(a: np.ndarray) -> bytes:
    """32-bit floats as compressed bytes, by place of the byte."""
    return pa.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def unpack_logs(b: bytes, n: int) -> np.ndarray:
    a = np.frombuffer(pa.decompress(b, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(a.T).reshape(-1).view(np.float32)


def batched(docs: DataFrame) -> DataFrame:
    """Rows with a number, a batch (neighbours of one task, about ``BATCH`` bytes together) and the lower-cased text, compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, size = None, 0
        for b in batches:
            ids, texts, sizes = [], [], []
            for row, t in zip(b.column(0).to_pylist(), b.column(3)):
                if batch is None or size > BATCH:
                    batch, size = row, 0  # the number of its first row
                x = low(t.as_py())
                ids.append(batch)
                texts.append(pa.compress(x, codec="zstd", asbytes=True))
                sizes.append(len(x))
                size += len(x) + 1
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(ids, pa.int64()), pa.array(texts, pa.binary()), pa.array(sizes, pa.int64())], names=["row", "doc_id", "held_out", "batch", "text", "n_bytes"])

    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(run, "row long, doc_id long, held_out boolean, batch long, text binary, n_bytes long")


def plain(text, n_bytes) -> bytes:
    return pa.decompress(text.as_buffer(), n_bytes.as_py(), codec="zstd", asbytes=True) if n_bytes.as_py() else b""


BLOBS = "part int, batch long, n int, keys binary, counts binary"


def blob_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "batch", "n", "keys", "counts"])


def tally(docs: DataFrame, depth: int, parts: int, shift: int) -> DataFrame:
    """The distinct grams of each batch with their training counts (0 for those of held-out texts alone), a row for each part.

    A batch is counted piece by piece; a row holds its grams of one part compressed, a byte or two each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, current = [], [], None

        def flush() -> Iterator[pa.RecordBatch]:
            if keys:
                k, c = merged(keys, counts)
                part = part_of(k, parts, shift)
                by = np.argsort(part, kind="stable")
                k, c, part = k[by], c[by], part[by]
                cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
                yield blob_rows([(int(part[s]), current, int(e - s), pack(k[s:e], True), pack(c[s:e])) for s, e in zip(cut[:-1], cut[1:])])
                keys.clear()
                counts.clear()

        def add(texts: list[bytes], weight: int) -> None:
            for some in chunks(texts):
                k, c = tallied(gram_keys(some, depth)[0], weight)
                keys.append(k)
                counts.append(c)
                if len(keys) >= 16:
                    keys[:], counts[:] = ([x] for x in merged(keys, counts))

        for b in batches:
            texts = [], []
            for t, n, out, batch in zip(b.column(0), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if batch != current:
                    add(texts[0], 1), add(texts[1], 0)
                    texts = ([], [])
                    yield from flush()
                    current = batch
                texts[out].append(plain(t, n))
                if len(texts[out][-1]) > CHUNK:  # a very long text isn't kept waiting
                    add(texts[out], 0 if out else 1)
                    texts[out].clear()
            add(texts[0], 1), add(texts[1], 0)
        yield from flush()

    return docs.select("text", "n_bytes", "held_out", "batch").mapInArrow(run, BLOBS)


def word_counts(docs: DataFrame) -> DataFrame:
    """(key, c) of the tokens of training texts, added up in each task before anything is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            if words:
                yield pa.RecordBatch.from_arrays([pa.array(word_hashes(list(words))), pa.array(list(words.values()), pa.int64())], names=["key", "c"])
                words.clear()

        for b in batches:
            for t, n in zip(b.column(0), b.column(1)):
                words.update(plain(t, n).split())
                if len(words) > 500_000:  # bounded memory, whatever the task reads
                    yield from flush()
            words[b""] += b.num_rows
        yield from flush()

    some = docs.where("NOT held_out").select("text", "n_bytes").mapInArrow(run, "key long, c long")
    return some.groupBy("key").agg(F.sum("c").alias("c"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by eight."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - LOG_PI


def decisions(keys: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zeros and ones at the binary decisions of sorted ``keys`` (context, symbol): keys are (context, node of the decomposition).

    First whether a byte follows or the end, then the byte's eight bits.
    """
    out = []
    for b in range(BITS):
        if b == 1:
            bytes_ = keys & SYMBOL != 0
            keys, c = keys[bytes_], c[bytes_]
            if not len(keys):
                break
        k = (keys >> BITS << BITS) | (1 << b) | ((keys & SYMBOL) >> (BITS - b))
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        out.append((k[first], np.add.reduceat(c, first), np.add.reduceat(c * (keys >> (BITS - 1 - b) & 1), first)))
    k, n, ones = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(k, kind="stable")
    return k[order], (n - ones)[order].astype(float), ones[order].astype(float)


def shorter(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys whose contexts lose their earliest symbol, and sums of their values."""
    return merged([(keys >> (2 * BITS) << BITS) | (keys & SYMBOL)], [values])


def climb(keys: np.ndarray, c: np.ndarray, deep: int, shallow: int, depth: int, below: np.ndarray | None = None):
    """Levels of decisions that occur, {d: (keys, weight of stopping, own estimate)}, and the counts and log weights left for the level above.

    Every node has a Krichevsky-Trofimov estimator for each binary decision. A node's
    weighted probability is half its own estimate and half the product of its children's;
    the share of its own in that is the posterior weight of stopping there. A decision
    without counts has probability one whatever its depth, so it is left out.
    """
    levels, half = {}, np.log(0.5)
    for d in range(deep, shallow - 1, -1):
        k, zeros, ones = decisions(keys, c)
        own = log_kt(zeros, ones)
        weighted = own if d == depth else np.logaddexp(half + own, half + below)
        levels[d] = k, np.ones(len(k)) if d == depth else np.exp(half + own - weighted), (ones + 0.5) / (zeros + ones + 1.0)
        (keys, c), (nodes, below) = shorter(keys, c), shorter(k, weighted)
    return levels, (keys, c), (nodes, below)


def descend(levels: dict, above: tuple | None = None) -> dict:
    """{d: (keys, mixture so far, weight left for deeper contexts)} from the shallowest level down."""
    out = {}
    for d in sorted(levels):
        k, stop, one = levels[d]
        mixed, left = np.zeros(len(k)), np.ones(len(k))
        if above is not None:
            at = np.searchsorted(above[0], (k >> (2 * BITS) << BITS) | (k & SYMBOL))
            mixed, left = above[1][at], above[2][at]
        above = out[d] = k, mixed + left * stop * one, left * (1 - stop)
    return out


def predicted(grams: np.ndarray, levels: dict, depth: int) -> np.ndarray:
    """log10 of the probability of each gram's symbol after its context: each decision by the deepest context that has met it."""
    out, these = np.zeros(len(grams)), np.arange(len(grams))
    for b in range(BITS):
        if b == 1:
            these = np.flatnonzero(grams & SYMBOL)  # an end has no further decisions
        some = grams[these]
        one, todo = np.full(len(some), 0.5), np.arange(len(some))
        for d in sorted(levels, reverse=True):
            g = some[todo]
            q = (g >> (BITS * (depth - d + 1)) << BITS) | (1 << b) | ((g & SYMBOL) >> (BITS - b))
            k, mixed, left = levels[d]
            at = np.minimum(np.searchsorted(k, q), len(k) - 1)
            hit = k[at] == q
            one[todo[hit]] = mixed[at[hit]] + left[at[hit]] * 0.5
            todo = todo[~hit]
        one = np.clip(one, 1e-12, 1 - 1e-12)
        out[these] += np.log10(np.where(some >> (BITS - 1 - b) & 1, one, 1 - one))
    return out


def subtrees(k: np.ndarray, c: np.ndarray, shift: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted grams in blocks of about ``block``, cut between subtrees."""
    at = 0
    while at < len(k):
        end = min(at + block, len(k))
        if end < len(k):
            cut = int(np.searchsorted(k, (k[end] >> shift) << shift))
            end = cut if cut > at else int(np.searchsorted(k, ((k[end] >> shift) + 1) << shift))
        yield k[at:end], c[at:end]
        at = end


def gram_scores(blobs: DataFrame, depth: int, top: int, block: int = BLOCK) -> DataFrame:
    """(batch, part, n, logs): log10 of the probabilities of the grams of ``blobs``, in their order, by the whole context tree.

    Subtrees below contexts of ``top`` + 1 symbols are weighted in tasks, each whole;
    the sums for the contexts above them meet on the driver.
    """
    shift = BITS * (depth - top)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a part meet: its grams as batch -1, and what its subtrees send up as parts -1 and -2."""
        part, keys, counts = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if part is None:
                return
            k, c = merged(keys, counts)
            up = ([], []), ([], [])
            for x, y in subtrees(k[c > 0], c[c > 0], shift, block):
                for (a, v), to in zip(climb(x, y, depth, top + 1, depth)[1:], up):
                    to[0].append(a)
                    to[1].append(np.asarray(v, float))
            rows = [(part, -1, len(k), pack(k, True), pack(c))]
            rows += [(-1 - i, -1, len(x), pack(x), pack(y.view(np.int64))) for i, to in enumerate(up) if to[0] for x, y in [merged(*to)]]
            yield blob_rows(rows)

        for b in batches:
            for r in zip(*(b.column(x).to_pylist() for x in range(5))):
                if r[0] != part:
                    yield from flush()
                    part, keys, counts = r[0], [], []
                keys.append(unpack(r[3], r[2], True))
                counts.append(unpack(r[4], r[2]))
                if sum(map(len, keys)) > 4 * max(len(keys[0]), 1_000_000):
                    keys, counts = ([x] for x in merged(keys, counts))
        yield from flush()

    whole = stored(blobs.repartition("part").sortWithinPartitions("part").mapInArrow(sums, BLOBS), "tree")
    rows = whole.where("part < 0").collect()  # contexts of at most ``top`` symbols: the alphabet bounds them, and the parts how often each comes
    of = lambda i: merged(*zip(*((unpack(r.keys, r.n), unpack(r.counts, r.n).view(float)) for r in rows if r.part == -1 - i)))
    upper = {}
    if rows:
        (keys, c), (_, below) = of(0), of(1)
        upper = descend(climb(keys, c.astype(np.int64), top, 0, depth, below)[0])
    shared = blobs.sparkSession.sparkContext.broadcast(upper)

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = logs = None
        for b in batches:
            out = []
            for part, batch, n, packed, counts in zip(*(b.column(x).to_pylist() for x in range(5))):
                if batch < 0:  # a part's own grams come before those of its batches
                    keys, c, found = unpack(packed, n, True), unpack(counts, n), []
                    for x, y in subtrees(keys, c, shift, block):
                        levels = dict(shared.value)
                        if y.any():
                            levels |= descend(climb(x[y > 0], y[y > 0], depth, top + 1, depth)[0], levels[top])
                        found.append(predicted(x, levels, depth))
                    logs = np.concatenate(found).astype(np.float32)
                else:
                    out.append((batch, part, n, pack_logs(logs[np.searchsorted(keys, unpack(packed, n, True))])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["batch", "part", "n", "logs"])

    both = whole.where("part >= 0").unionByName(blobs)
    return both.repartition("part").sortWithinPartitions("part", "batch").mapInArrow(down, "batch long, part int, n int, logs binary")


def score(docs: DataFrame, depth: int = DEPTH, heavy: int = HEAVY, top: int = TOP, part_bytes: int = PART_BYTES, block: int = BLOCK) -> DataFrame:
    """Scores of whole texts by models learnt from those that aren't held out.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    word counts), score (log10 probability of the text's lower-cased bytes and its end by
    context-tree weighting over all contexts of up to ``depth`` bytes, at most six), n_bytes and
    bits_per_byte. A null text is empty: one end token. A null id hashes as the empty text. Repeated
    rows are learnt from and scored one by one; an empty table gives an empty one; without training
    rows every estimate is uniform.
    """
    if not 1 <= depth <= 6:
        raise ValueError("contexts have one to six bytes")
    sc = docs.sparkSession.sparkContext
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    d = stored(batched(d), "docs")
    size = d.agg(F.sum("n_bytes")).first()[0] or 0
    parts, top = int(min(MOST_PARTS, 1 + size // part_bytes)), min(top, depth - 1)
    shift = BITS * (depth - top)
    blobs = stored(tally(d, depth, parts, shift), "grams")
    logs = gram_scores(blobs, depth, top, block)
    vocab = stored(word_counts(d), "vocab")
    n, v = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    over = float(n + v + 1)
    few = vocab.where(F.col("c") * heavy >= n).toPandas().sort_values("key")  # at most ``heavy`` rows
    known = sc.broadcast((few["key"].to_numpy(np.int64), few["c"].to_numpy(np.int64)))

    names = ["row", "doc_id", "held_out", "n_tokens", "n_bytes", "score", "base", "known", "rare", "times"]

    def run(b: pa.Table, found: pa.Table) -> pa.Table:
        keys, cs = known.value
        column, n_bytes = b.column("text"), b.column("n_bytes")

        def pieces() -> Iterator[tuple[int, list[bytes]]]:
            at = 0
            while at < b.num_rows:
                texts, size = [], 0
                while at + len(texts) < b.num_rows and size < CHUNK:  # bounded memory for long texts
                    texts.append(plain(column[at + len(texts)], n_bytes[at + len(texts)]))
                    size += len(texts[-1])
                yield at, texts
                at += len(texts)

        grams: list[np.ndarray] = []
        for _, texts in pieces():
            grams.append(tallied(gram_keys(texts, depth)[0], 1)[0])
            if len(grams) >= 16:
                grams = [tallied(np.concatenate(grams), 1)[0]]
        grams = tallied(np.concatenate(grams), 1)[0]
        logs = np.empty(len(grams), np.float32)
        by_part = sorted(zip(*(found.column(x).to_pylist() for x in ("part", "n", "logs"))))
        logs[np.argsort(part_of(grams, parts, shift), kind="stable")] = np.concatenate([unpack_logs(x, n) for _, n, x in by_part])
        done = []
        for first, texts in pieces():
            tokens, base, sure, rare, times = [], [], [], [], []
            for t in texts:
                c = Counter(t.split())
                c[b""] = 1
                h, m = word_hashes(list(c)), np.fromiter(c.values(), np.int64, len(c))
                k = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
                hit = keys[k] == h if len(keys) else np.zeros(len(h), bool)
                tokens.append(int(m.sum()))
                base.append(float((m[hit] * np.log10((cs[k[hit]] + 1.0) / over)).sum()))
                sure.append(int(m[hit].sum()))
                rare.append(h[~hit])
                times.append(m[~hit].astype(np.int32))
            g, begin = gram_keys(texts, depth)
            by = np.argsort(g)
            at = np.empty(len(g), np.float64)
            at[by] = logs[np.searchsorted(grams, g[by])]
            scores = np.add.reduceat(at, begin)
            lists = np.cumsum([0, *map(len, rare)]).astype(np.int32)
            given = [b.column(x).slice(first, len(texts)).combine_chunks() for x in ("row", "doc_id", "held_out")]
            done.append(pa.Table.from_arrays([
                *given, pa.array(tokens, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(scores),
                pa.array(base, pa.float64()), pa.array(sure, pa.int64()), pa.ListArray.from_arrays(lists, np.concatenate(rare)), pa.ListArray.from_arrays(lists, np.concatenate(times)),
            ], names=names))
        return pa.concat_tables(done)

    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_bytes long, score double, base double, known long, rare array<long>, times array<int>"
    rows = stored(d.groupBy("batch").cogroup(logs.groupBy("batch")).applyInArrow(run, schema), "scored")
    discard(d, blobs)
    # Words that aren't heavy meet their counts by a join; by their rarity no key is hot.
    zipped = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("z")).select("row", F.col("z.rare").alias("key"), F.col("z.times").alias("m"))
    found = zipped.join(vocab, "key", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = found.groupBy("row").agg(F.sum(F.col("m") * F.log10((F.col("c") + 1) / F.lit(over))).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0)).alias("seen"))
    out = rows.drop("rare", "times").join(sums, "row", "left")
    bits = -F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score", "n_bytes", bits.alias("bits_per_byte"))

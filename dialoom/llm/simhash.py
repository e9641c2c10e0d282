"""Near duplicates by SimHash and a Gray-ordered hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from dialoom.llm.common import components, discard, lean, release, salted, stored

BITS = np.arange(64, dtype=np.uint64)
#: Groups of candidate fingerprints above this many are refined by further shared bits.
MOST_IN_GROUP = 4096
LEAF = 8
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Shingles that are put last in the order of all, at most: they are broadcast, 8 bytes each.
MOST_OFTEN = 1 << 21
#: Texts whose SimHashes differ by so many bits at most are sought among all texts,
NEAR_BITS = 5
#: and by so many among those that share one of their first shingles.
WIDE_BITS = 20
#: Bits of the sketches that travel with keys.
KEY_SKETCH = 512
#: First keys of a text that travel too, to tell whether a pair has met before.
HEADS = 4
#: Slots of the map of wanted nodes: 8 MB.
SLOTS = 1 << 26


def fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < width else map(b" ".join, zip(*(w[i:] for i in range(width))))
    return majority(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The word of the bits that are set in over half of the 64-bit hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):  # bounded memory for very long texts
        part = np.ascontiguousarray(hashes[at : at + 4096]).view(np.uint8)
        counts += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((np.uint64(1) << BITS[counts * 2 > len(hashes)]).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), width) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "doc_id long, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each word in the order of the binary reflected Gray code."""
    r = fp.copy()
    for k in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(k)
    return r


class GrayIndex:
    """Fingerprints in Gray order under a tree of shared bit patterns.

    A node's mask marks the bits on which all fingerprints below it agree. The bits
    that a parent already shares are factored out of its children, so that going
    down only adds differences, and a node whose sum passes the limit is left out
    with all that is below it.
    """

    def __init__(self, fp: np.ndarray, fan: int = LEAF):
        self.order = np.argsort(gray_rank(fp), kind="stable")
        self.fp, self.fan = fp[self.order], fan
        same, pattern = np.full(len(fp), ~np.uint64(0)), self.fp
        levels = []
        while len(pattern) > 1:
            cut = np.arange(0, len(pattern), fan)
            both, any_ = np.bitwise_and.reduceat(pattern, cut), np.bitwise_or.reduceat(pattern, cut)
            mask = np.bitwise_and.reduceat(same, cut) & ~(both ^ any_)
            levels.append((same, pattern))
            same, pattern = mask, both & mask
        self.levels = [*levels, (same, pattern)][::-1]

    def pairs(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """All places (i < j in the given array) at ``most`` differing bits or fewer."""
        found = [self._search(np.arange(at, min(at + 512, len(self.fp))), most) for at in range(0, len(self.fp), 512)]
        i, j = (np.concatenate(x) for x in zip(*found))
        i, j = self.order[i], self.order[j]
        return np.minimum(i, j), np.maximum(i, j)

    def nearest(self, most: int, ok=None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places: each word with the one of the fewest differing bits, at most ``most``, among those that are ``ok``."""
        step = max(1, min(512, (1 << 20) // len(self.fp)))
        least, mate = np.full(len(self.fp), 65), np.full(len(self.fp), -1)
        for at in range(0, len(self.fp), step):
            i, j = self._search(np.arange(at, min(at + step, len(self.fp))), most)
            if ok is not None:
                fine = ok(self.order[i], self.order[j])
                i, j = i[fine], j[fine]
            if not len(i):
                continue
            apart = np.bitwise_count(self.fp[i] ^ self.fp[j]).astype(np.int64)
            for p, q in ((i, j), (j, i)):
                by = np.lexsort((apart, p))
                by = by[np.r_[True, p[by][1:] != p[by][:-1]]]
                by = by[apart[by] < least[p[by]]]
                least[p[by]], mate[p[by]] = apart[by], q[by]
        i = np.flatnonzero(mate >= 0)
        i, j = self.order[i], self.order[mate[i]]
        return tuple(np.unique(np.stack([np.minimum(i, j), np.maximum(i, j)]), axis=1))

    def _search(self, q: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        query, node = q, np.zeros(len(q), np.int64)
        diff, above = np.zeros(len(q), np.int64), np.zeros(len(q), np.uint64)
        for depth, (mask, pattern) in enumerate(self.levels):
            if depth:
                kids = node[:, None] * self.fan + np.arange(self.fan)
                ok = (kids < len(mask)) & ((depth < len(self.levels) - 1) | (kids > query[:, None]))
                row, col = np.nonzero(ok)
                query, node, diff, above = query[row], kids[row, col], diff[row], above[row]
            diff = diff + np.bitwise_count((self.fp[query] ^ pattern[node]) & mask[node] & ~above)
            near = diff <= most
            query, node, diff, above = query[near], node[near], diff[near], mask[node][near]
        far = node > query
        return query[far], node[far]


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places reaches over the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def part_masks(mask: int, most: int = 64, parts: int = 3) -> list[int]:
    """The mask with up to ``most`` bits of each of ``parts`` parts of the bits it leaves free added; equal ones once."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    cuts = [len(free) * k // parts for k in range(parts + 1)]
    return list(dict.fromkeys(mask | sum(1 << b for b in free[cuts[k] : cuts[k + 1]][:most]) for k in range(parts)))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, most_bits: int = 2, most_in_group: int = MOST_IN_GROUP, nearest: bool = False) -> DataFrame:
    """Edges between the distinct ``fps(fp)`` that join all within ``most_bits`` bits: ``(a, b)``.

    Two words that differ in at most two bits agree on one of any three parts of their
    bits, and so on for more bits. So each fingerprint goes to three Gray-ordered indexes, by leading bits of a part: as many as make
    groups of about half of ``most_in_group``, for which GrayIndex prunes over several levels. Groups that
    are too large go on to three groups by parts of the bits that are left, and so on. No pair is
    lost, and when few bits are free a group can't be large, as its fingerprints differ. Each group
    gives a star for each component found, never all pairs. With ``nearest`` it gives pairs that are within
    ``most_bits`` themselves: each word with its nearest in each group.
    """
    parts_of = partial(part_masks, parts=most_bits + 1)
    rows = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    lead = max(0, int(np.ceil(np.log2(max(1, 2 * rows.count() / most_in_group)))))
    masks, found, held = [0], None, []

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            rest = b if rest is None else pd.concat([rest, b], ignore_index=True)
            key, mask = rest["key"].to_numpy(), rest["mask"].to_numpy()
            last = len(rest) - 1
            start = int(np.argmax((key == key[last]) & (mask == mask[last])))  # the last group may go on
            yield from local(rest.iloc[:start])
            rest = rest.iloc[start:]
        if rest is not None:
            yield from local(rest)

    def local(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if len(g) < 2:
            return
        key, mask, words = g["key"].to_numpy(), g["mask"].to_numpy(), g["fp"].to_numpy()
        fp = words.view(np.uint64)
        cut = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (mask[1:] != mask[:-1]), True])
        a, b = [], []
        for s, e in zip(cut[:-1], cut[1:]):
            if e - s < 2:
                continue
            index = GrayIndex(fp[s:e])
            i, j = index.nearest(most_bits) if nearest else index.pairs(most_bits)
            if nearest:
                a.append(words[s:e][i])
                b.append(words[s:e][j])
            elif len(i):
                top = roots(e - s, i, j)
                kid = np.flatnonzero(top != np.arange(e - s))
                a.append(words[s:e][top[kid]])
                b.append(words[s:e][kid])
        if a:
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    while masks:
        # The parts of a mask: a literal of at most (most_bits + 1) ** depth short entries.
        parts = F.create_map(*[x for m in masks for x in (F.lit(signed(m)), F.array(*[F.lit(signed(p)) for p in parts_of(m, lead)]))])
        wide = rows.select(F.explode(F.element_at(parts, F.col("mask"))).alias("mask"), "fp").withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = wide.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        wide = stored(wide.join(sizes, ["mask", "key"]), "groups")
        held.append(wide)
        small = wide.where(F.col("n") <= most_in_group).select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key").mapInPandas(lean(search), "a long, b long")
        found = small if found is None else found.unionByName(small)
        rows = wide.where(F.col("n") > most_in_group).select("mask", "fp")
        masks = sorted({p for m in masks for p in parts_of(m, lead) if p != (1 << 64) - 1}) if not rows.isEmpty() else []
        lead = 64
    out = stored(found, "stars")
    discard(*held)
    return out


def near_duplicates(docs: DataFrame, width: int = 3, most_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reached over links.

    Null and blank texts have fingerprint zero and link like any other. Equal
    fingerprints are one node, whatever the number of copies and whether their rows have ids. Repeated
    rows come out repeated; a row with a null doc_id gets the smallest id of its component
    (null if no row of it has one); an empty table gives an empty one.
    """
    fps = stored(fingerprints(docs, width), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    star = links(nodes.select("fp"), most_bits)
    comp = components(star)
    discard(star)
    of = nodes.join(comp, nodes.fp == comp.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    of = stored(of, "of")
    first = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = salted(of, first, "component", "fp").select(F.col("fp").alias("f"), "component_id")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(of, fps.fp == F.col("f"), "left").select("doc_id", text.alias("fingerprint"), "component_id")


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct keys of a text's word shingles; a shorter text is one shingle.

    Words are hashed once each and their hashes mixed along the shingle.
    """
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    known = {x: xxhash.xxh64_intdigest(x, 42) for x in set(w)}
    h = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
    n = max(1, len(h) - width + 1)
    out = np.full(n, len(w) if len(w) < width else width, np.uint64)
    for k in range(min(width, len(h))):
        out = (out ^ h[k : k + n]) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out).view(np.int64)


def text_node(text: Column) -> Column:
    """64-bit key of a text; null is empty. Among 15 million texts a shared key has a chance of 6e-6."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def rare_first(h: np.ndarray, often: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` shingles in the common order: those in ``often`` (sorted) come last, else by key."""
    if len(often):
        at = np.minimum(np.searchsorted(often, h), len(often) - 1)
        h = h[np.argsort(often[at] == h, kind="stable")]
    return h[:n]


def sketch(h: np.ndarray) -> np.ndarray:
    """Bits of the slots (a power of two, two a key at least) that hold an odd number of the keys, as 64-bit words.

    Two sets differ in at least as many keys as their sketches differ in bits.
    """
    slots = max(KEY_SKETCH, 1 << (2 * len(h) - 1).bit_length())
    odd = np.bincount((h.view(np.uint64) & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(s: np.ndarray, words: int) -> np.ndarray:
    """The sketch of the same keys with fewer slots."""
    while len(s) > words:
        s = s[: len(s) // 2] ^ s[len(s) // 2 :]
    return s


def prints(nodes: DataFrame, width: int) -> DataFrame:
    """SimHash ``fp``, size ``n`` and ``sketch`` of the shingle sets of ``nodes(node, text)``; ``small`` is the sketch that travels with keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), width) for t in b.column(1)]
            fp = np.array([majority(h.view(np.uint64)) for h in sets], np.uint64).view(np.int64)
            full = [sketch(h) for h in sets]
            small = [folded(x, KEY_SKETCH // 64).tobytes() for x in full]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), pa.array([len(h) for h in sets], pa.int32()), pa.array([x.tobytes() for x in full], pa.binary()), pa.array(small, pa.binary())], names=["node", "fp", "n", "sketch", "small"])

    return nodes.mapInArrow(lean(run), "node long, fp long, n int, sketch binary, small binary")


def similar_texts(docs: DataFrame, width: int = 5, similarity: float = 0.8, least: int = 32, most_often: int = MOST_OFTEN) -> DataFrame:
    """(node, component) of all texts linked to another one: components over pairs of at least this Jaccard similarity of word shingles.

    SimHashes of the shingles propose pairs, from Gray-ordered indexes: each text with its nearest one within ``NEAR_BITS`` among
    all texts (``links``), and within ``WIDE_BITS`` among those that share a key, as such pairs differ by up to a quarter of the bits
    and no parts of the bits find that. Every proposed pair is checked exactly. What is farther apart is found too:
    two sets this similar share one of the first n - ceil(similarity * n) + 1 shingles of
    each, in whatever common order; so those are the keys, and no pair is lost. Shingles that many texts
    have among their first come last in the order: those of more than ``least`` texts, or the ``most_often`` most
    common ones. That bounds what is broadcast and changes no result. Of each pair, the shared key must come early
    enough in both sets for the rest to reach the similarity. Members of a key that the checked pairs don't join are compared
    by their sketches where they meet, which lose no pair, and only what these leave is checked. So a
    large group of near copies gives a few pairs a text, not all.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    nodes = stored(docs.select(text_node(F.col("text")).alias("node"), F.col("text").cast("string").alias("text")).dropDuplicates(["node"]), "texts", compression="zstd")
    of_text = stored(prints(nodes, width), "prints", compression="zstd")
    release(spark)

    same = stored(of_text.groupBy("fp").agg(F.min("node").alias("least")), "fingerprints")
    beside = links(same.select("fp"), NEAR_BITS, nearest=True)
    one = beside.join(same.select(F.col("fp").alias("a"), F.col("least").alias("x")), "a")
    both = one.join(same.select(F.col("fp").alias("b"), F.col("least").alias("y")), "b").select("x", "y")
    equal = of_text.select("fp", "node").join(same, "fp").where("node <> least").select(F.col("least").alias("x"), F.col("node").alias("y"))
    proposed = stored(both.unionByName(equal).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), "proposed")
    discard(beside, same)

    def first(common: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids, keys, sizes, places = [], [], [], []
                for node, t in zip(b.column(0).to_pylist(), b.column(1)):
                    h = shingle_set(t.as_py(), width)
                    k = rare_first(h, common.value, len(h) - int(np.ceil(similarity * len(h) - 1e-9)) + 1)
                    ids.append(np.full(len(k), node, np.int64))
                    keys.append(k)
                    sizes.append(np.full(len(k), len(h), np.int32))
                    places.append(np.arange(len(k), dtype=np.int32))
                if ids:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, keys, sizes, places)], names=["node", "key", "n", "place"])

        return nodes.mapInArrow(lean(run), "node long, key long, n int, place int")

    counts = stored(first(sc.broadcast(np.zeros(0, np.int64))).groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > least), "often")
    by_count = counts.groupBy("m").agg(F.count("*").alias("keys")).orderBy(F.col("m").desc()).collect()  # one row a count
    total, above = 0, least
    for r in by_count:
        total += r["keys"]
        if total > most_often:
            above = r.m
            break
    often = counts.where(F.col("m") > above).select("key").toPandas()["key"].to_numpy(np.int64)
    discard(counts)
    need = 2 * similarity / (1 + similarity)  # two sets of m and n share at least need * (m + n) / 2

    def early(n, place, a, b) -> np.ndarray:
        """Whether the sets at a and b can reach the similarity, by their sizes and the places of the key."""
        both = need * (n[a].astype(float) + n[b]) / 2 - 1e-9
        return (n[a] - place[a] >= both) & (n[b] - place[b] >= both) & (np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - 1e-9)

    def by_key(work):
        """A function over batches sorted by key that gives whole keys to ``work``, with binary columns as rows of words."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for b in batches:
                now = [np.frombuffer(b"".join(x.to_pylist()), np.uint64).reshape(-1, KEY_SKETCH // 64) if pa.types.is_binary(x.type) else x.to_numpy(zero_copy_only=False) for x in b.columns]
                held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
                cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last key may go on
                if cut > 100_000:
                    yield from work(*(x[:cut] for x in held))
                    held = [x[cut:] for x in held]
            if held is not None and len(held[0]):
                yield from work(*held)

        return run

    def whole(key) -> tuple[np.ndarray, np.ndarray]:
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        return start, np.diff(np.r_[start, len(key)])

    def shared(key, node, n, place) -> Iterator[pa.RecordBatch]:
        """Members of keys that several texts have."""
        _, size = whole(key)
        several = np.repeat(size > 1, size)
        if several.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[several]) for x in (key, node, n, place)], names=["key", "node", "n", "place"])

    def close(key, node, n, place, fp) -> Iterator[pa.RecordBatch]:
        """Pairs of neighbours within a key: of two members, of more the nearest of each in the index of their SimHashes."""
        start, size = whole(key)
        two = start[size == 2]
        two = two[early(n, place, two, two + 1)]
        a, b = [two], [two + 1]
        for s, m in zip(start[size > 2], size[size > 2]):
            i, j = GrayIndex(fp[s : s + m].view(np.uint64)).nearest(WIDE_BITS, lambda i, j: early(n, place, s + i, s + j))
            a.append(s + i)
            b.append(s + j)
        yield from distinct(node, [np.concatenate(a)], [np.concatenate(b)])

    def distinct(node, a, b) -> Iterator[pa.RecordBatch]:
        a, b = node[np.concatenate(a)], node[np.concatenate(b)]
        if len(a):
            x = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1])], names=["a", "b"])

    def far(key, node, n, place, of, small, *heads) -> Iterator[pa.RecordBatch]:
        """Pairs of a key's members in different components that their sketches allow.

        A pair whose first keys have another one in common before this key is left to that one: so most pairs come
        from the first key they share only, and none is lost, as that one has no other before it.
        """
        start, size = whole(key)
        before = [(place > k) & (h != key) for k, h in enumerate(heads)]
        rank = np.arange(len(key)) - np.repeat(start, size)
        a, b, held = [], [], 0
        for step in range(1, int(size.max())):
            j = np.flatnonzero(rank >= step)
            j = j[of[j - step] != of[j]]
            j = j[early(n, place, j - step, j)]
            for at in range(0, len(j), 65536):
                y = j[at : at + 65536]
                apart = np.bitwise_count(small[y - step] ^ small[y]).sum(1, dtype=np.int64)
                y = y[apart <= (1 - need) * (n[y - step].astype(float) + n[y]) + 1e-6]
                met = np.zeros(len(y), bool)
                for h, earlier in zip(heads, before):
                    for g, as_early in zip(heads, before):
                        met |= (h[y - step] == g[y]) & earlier[y - step] & as_early[y]
                y = y[~met]
                a.append(y - step)
                b.append(y)
                held += len(y)
            if held > 1_000_000:
                yield from distinct(node, a, b)
                a, b, held = [], [], 0
        if held:
            yield from distinct(node, a, b)

    keys = first(sc.broadcast(np.sort(often)))
    met = stored(keys.select("key", "node", "n", "place").repartition("key").sortWithinPartitions("key").mapInArrow(lean(by_key(shared)), "key long, node long, n int, place int"), "met")
    release(spark)
    under = met.join(of_text.select("node", "fp"), "node").select("key", "node", "n", "place", "fp").repartition("key").sortWithinPartitions("key", "node")
    beside = under.mapInArrow(lean(by_key(close)), "a long, b long")
    near = stored(verified(proposed.unionByName(beside).distinct(), nodes, of_text, width, similarity), "links")
    release(spark)
    of = components(near)
    left = met.join(of, "node", "left").select("key", "node", "n", "place", F.coalesce("component", "node").alias("of"))
    split = left.groupBy("key").agg(F.min("of").alias("p"), F.max("of").alias("q"), F.count("*").alias("m")).where("p <> q AND m > 2").select("key")
    heads = [f"h{k}" for k in range(HEADS)]
    head = met.where(F.col("place") < HEADS).groupBy("node").agg(*[F.max(F.when(F.col("place") == k, F.col("key"))).alias(h) for k, h in enumerate(heads)])
    left = left.join(split, "key", "left_semi").join(of_text.select("node", "small"), "node").join(head, "node", "left")
    left = left.select("key", "node", "n", "place", "of", "small", *[F.coalesce(h, "key").alias(h) for h in heads]).repartition("key").sortWithinPartitions("key", "node")
    more = stored(left.mapInArrow(lean(by_key(far)), "a long, b long").distinct(), "pairs")
    discard(met, proposed)
    if not more.isEmpty():
        near = near.unionByName(stored(verified(more, nodes, of_text, width, similarity), "links"))
    discard(more)
    out = components(near)
    discard(nodes, of_text)
    return out


def verified(pairs: DataFrame, nodes: DataFrame, of_text: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs of ``pairs(a, b)`` whose texts in ``nodes(node, text)`` are similar enough.

    Sketches rule out most others first; the texts of the rest meet, and are told apart by their shingles.
    """
    spark = nodes.sparkSession
    need = 2 * similarity / (1 + similarity)

    def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for m, s, n, t in zip(b.column(2).to_pylist(), b.column(3), b.column(4).to_pylist(), b.column(5)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (s, t))
                words = min(len(x), len(y))
                ok.append(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum(dtype=np.int64) <= (1 - need) * (m + n) + 1e-6)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = salted(pairs, of_text.select(F.col("node").alias("a"), F.col("n").alias("m"), F.col("sketch").alias("s")), "a", "b", 2)
    both = salted(one, of_text.select(F.col("node").alias("b"), "n", F.col("sketch").alias("t")), "b", "a", 2)
    likely = stored(both.select("a", "b", "m", "s", "n", "t").mapInArrow(lean(allowed), "a long, b long"), "likely")
    release(spark)
    slots = likely.select(F.explode(F.array("a", "b")).alias("node")).select(F.col("node").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")).distinct().toPandas()["slot"].to_numpy(np.int64)
    marks = np.zeros(SLOTS // 8, np.uint8)
    np.bitwise_or.at(marks, slots >> 3, (1 << (slots & 7)).astype(np.uint8))
    marks = spark.sparkContext.broadcast(marks)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = b.column(0).to_numpy() & (SLOTS - 1)
            yield b.filter(pa.array((marks.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = {}, 0
        for b in batches:
            ok = []
            for x, y, s, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                for node, text in ((x, s), (y, t)):
                    if node not in known:
                        if held > 4_000_000:
                            known, held = {k: known[k] for k in (x, y) if k in known}, 0
                        known[node] = shingle_set(text.as_py(), width)
                        held += len(known[node])
                both = len(np.intersect1d(known[x], known[y], assume_unique=True))
                ok.append(both >= similarity * (len(known[x]) + len(known[y]) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    texts = nodes.select("node", "text").mapInArrow(lean(wanted), "node long, text string")
    one = likely.join(texts.select(F.col("node").alias("a"), F.col("text").alias("s")), "a")
    both = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("t")), "b")
    return both.select("a", "b", "s", "t").mapInArrow(lean(run), "a long, b long")

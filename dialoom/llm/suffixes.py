"""Removing repeated byte strings with suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dialoom.llm.common import discard, lean, stored

#: Bytes of an anchor. A repeated string has at least one anchor at the same place in each copy.
GRAM = 32
#: Contexts of one anchor that are sorted in one group; more are dealt to several groups and merged afterwards.
MOST_IN_GROUP = 2000
#: Bytes that a task sorts at once.
SORT_BYTES = 2_000_000
#: Bytes of text whose windows are hashed at once.
PIECE = 1 << 20
SHALLOW = 16
U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240).integers(1, 1 << 63, 256, np.uint64) * U(2) + U(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_P, PIECE * 2), _powers(pow(_P, -1, 1 << 64), PIECE * 2)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def anchor_runs(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (gram hash, context hash, first window, windows, anchor's place in it).

    ``data`` holds texts end to end, ``ends`` where each ends. The anchor of a window of
    ``length`` bytes is the gram within it with the least hash, the leftmost of equals: it
    depends on the window's bytes alone, so equal windows have equal anchors.
    """
    n, span = len(data), length - GRAM + 1
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    total = np.zeros(n + 1, U)
    np.cumsum(_TABLE[data] * _UP[:n], out=total[1:])
    gram = _mixed((total[GRAM:] - total[:-GRAM]) * _DOWN[: n - GRAM + 1])
    low = ((gram >> U(28)) << U(28)) | np.arange(len(gram), dtype=U)
    w = 1
    while w * 2 <= span:
        low = np.minimum(low[:-w], low[w:])
        w *= 2
    if w < span:
        low = np.minimum(low[: len(low) - (span - w)], low[span - w :])
    at = (low & U((1 << 28) - 1)).astype(np.int64)
    valid = np.ones(len(at), bool)
    for e in ends[:-1]:  # windows over the end of a text
        valid[max(0, e - length + 1) : e] = False
    start = np.flatnonzero(valid)
    if not len(start):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    new = np.r_[True, (at[start[1:]] != at[start[:-1]]) | (np.diff(start) != 1)]
    first = np.flatnonzero(new)
    lo, count = start[first], np.diff(np.r_[first, len(start)])
    anchor = at[lo]
    context = (total[lo + count - 1 + length] - total[lo]) * _DOWN[lo]
    context = _mixed(context ^ ((anchor - lo).astype(U) << U(32)) ^ (count.astype(U) * U(0xA0761D6478BD642F)))
    return gram[anchor].view(np.int64), context.view(np.int64), lo, count, anchor - lo


def deep_shallow(data: np.ndarray, pos: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes at ``pos`` by their first ``length`` bytes.

    Returns the order (equal ones by place in ``pos``) and, for each in that order,
    whether it equals the one before. To a shallow depth a multikey quicksort parts
    the suffixes by one machine word of eight bytes after the other, each time only
    within groups that are still equal. Groups that share more go to blind tries: in
    each round every group compares its members with its first one; those equal to
    it are done, and the others branch off its path by where they leave it and the one
    byte they leave with, on either side. All groups of a depth advance together.
    ``data`` must hold ``length`` bytes after each position.
    """
    n = len(pos)
    padded = np.concatenate([data, np.zeros(length + 16, np.uint8)])
    words = np.zeros(len(padded) - 7, U)
    for k in range(8):
        words = (words << U(8)) | padded[k : len(padded) - 7 + k]

    def word(p: np.ndarray, depth: int) -> np.ndarray:
        w = words[p + depth]
        return w if depth + 8 <= length else w & ~U((1 << (8 * (depth + 8 - length))) - 1)

    order, same = np.arange(n), np.zeros(n, bool)
    slots, group = np.arange(n), np.zeros(n, np.int64)
    for depth in range(0, min(SHALLOW, length), 8):
        if not len(slots):
            break
        key = word(pos[order[slots]], depth)
        by = np.lexsort((key, group))
        order[slots], key, group = order[slots][by], key[by], group[by]
        new = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])]
        group = np.cumsum(new)
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots, group = slots[tied], group[tied]
    if length <= SHALLOW:
        same[slots] = np.r_[False, group[1:] == group[:-1]][: len(slots)]
        return order, same
    while len(slots):
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        ref = np.repeat(first, np.diff(np.r_[first, len(slots)]))
        p = pos[order[slots]]
        lcp, side, byte = np.full(len(slots), length), np.zeros(len(slots), np.int64), np.zeros(len(slots), np.int64)
        live = np.flatnonzero(np.arange(len(slots)) != ref)
        for depth in range(0, length, 8):
            a, b = word(p[live], depth), word(p[ref[live]], depth)
            out = a != b
            if out.any():
                gone, x = live[out], a[out] ^ b[out]
                lead = (63 - np.floor(np.log2(x.astype(np.float64))).astype(np.int64)) // 8
                lead = np.minimum(lead, 7)
                # Rounding to double may carry over a power of two.
                wrong = (x >> (U(56) - (lead * 8).astype(U))) & U(255) == 0
                lead += wrong
                lcp[gone] = depth + lead
                side[gone] = np.where(a[out] < b[out], -1, 1)
                byte[gone] = ((a[out] >> (U(56) - (lead * 8).astype(U))) & U(255)).astype(np.int64)
                live = live[~out]
            if not len(live):
                break
        # Smaller suffixes leave the path early first; greater ones leave it late first.
        place = np.where(side < 0, lcp, np.where(side == 0, length, 2 * length - lcp)) * 256 + byte
        by = np.lexsort((place, group))
        by_place, by_group = place[by], group[by]
        order[slots] = order[slots][by]
        new = np.r_[True, (by_place[1:] != by_place[:-1]) | (by_group[1:] != by_group[:-1])]
        done = side[by] == 0
        same[slots] |= done & ~new
        fresh = np.cumsum(new)
        tied = ~new
        tied[:-1] |= ~new[1:]
        go = tied & ~done
        slots, group = slots[go], fresh[go]
    return order, same


def runs_of(flag: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of maximal runs of set flags within one row."""
    on = np.flatnonzero(flag)
    if not len(on):
        return on, on
    cut = np.r_[True, (np.diff(on) != 1) | (row[on[1:]] != row[on[:-1]])]
    first = np.flatnonzero(cut)
    return on[first], on[np.r_[first[1:] - 1, len(on) - 1]]


def identity(docs: DataFrame) -> tuple[Column, Column]:
    """A document's place in the order: its id (null last), and a hash of its text where ids repeat."""
    repeated = not docs.groupBy("doc_id").count().where("count > 1").isEmpty()
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), F.hash("text") if repeated else F.lit(0)


def spans(docs: DataFrame, length: int = 100, most_in_group: int = MOST_IN_GROUP) -> DataFrame:
    """``(d, twin, runs)``: for each document with any, the byte ranges that repeat earlier text.

    1. Each window of ``length`` bytes is put under its anchor; runs of windows with
       one anchor are hashed with their whole context. Grams seen once are dropped.
    2. Of equal contexts of a gram all but the earliest repeat it, whole.
    3. The different contexts of a gram, each once, are cut from the texts and their
       suffixes sorted; of equal windows all but the earliest repeat it.
    4. A gram with more contexts than a group may hold is dealt to several groups; each
       sorts its own, and their earliest windows meet by digest.
    """
    d, twin = identity(docs)
    base = docs.select(d.alias("d"), twin.alias("twin"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, twins = b.column(0).to_numpy(), b.column(1).to_numpy()
            parts, at, owner, offset = [], 0, [], []

            def flush():
                nonlocal parts, at, owner, offset
                data = np.frombuffer(b"".join(parts), np.uint8)
                ends = np.cumsum([len(x) for x in parts])
                gram, context, lo, count, place = anchor_runs(data, ends, length)
                k = np.searchsorted(ends, lo, side="right")
                own = np.array(owner)[k]
                start = lo - np.r_[0, ends][k] + np.array(offset)[k]
                out = [ids[own], twins[own], gram, context, start, count.astype(np.int32)]
                parts, at, owner, offset = [], 0, [], []
                return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["d", "twin", "gram", "context", "lo", "n"])

            for i in range(b.num_rows):
                t = b.column(2)[i].as_py().encode("utf-8", "surrogatepass")
                for s in range(0, max(1, len(t) - length + 1), PIECE):  # very long texts in pieces that overlap
                    piece = t[s : s + PIECE + length - 1]
                    if len(piece) < length:
                        continue
                    if at and at + len(piece) > PIECE + length:
                        yield flush()
                    parts.append(piece)
                    owner.append(i)
                    offset.append(s)
                    at += len(piece)
            if parts:
                yield flush()

    runs = stored(base.mapInArrow(lean(scan), "d long, twin int, gram long, context long, lo long, n int"), "runs")
    often = runs.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    again = stored(runs.join(often, "gram", "left_semi"), "again")
    discard(runs)
    firsts = again.groupBy("gram", "context").agg(F.min(F.struct("d", "twin", "lo")).alias("f"), F.first("n").alias("n"))
    many = firsts.groupBy("gram").agg(F.count("*").alias("contexts"))
    firsts = stored(firsts.join(many, "gram").select("gram", "context", "f", "n", "contexts"), "firsts")
    here = F.struct("d", "twin", "lo")
    copies = again.join(firsts.select("gram", "context", "f"), ["gram", "context"]).where(here != F.col("f"))
    copies = stored(copies.select("d", "twin", F.col("lo").alias("start"), (F.col("lo") + F.col("n") + (length - 1)).alias("end")).groupBy("d", "twin").agg(F.collect_list(F.struct("start", "end")).alias("s")), "copies")
    discard(again)

    group = F.when(F.col("contexts") > most_in_group, F.pmod(F.col("context"), F.ceil(F.col("contexts") / most_in_group)).cast("int")).otherwise(F.lit(-1))
    need = firsts.where("contexts > 1").select("f.d", "f.twin", F.struct("gram", group.alias("grp"), F.col("f.lo").alias("lo"), "n").alias("x")).groupBy("d", "twin").agg(F.collect_list("x").alias("xs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                t = b.column(2)[i].as_py().encode("utf-8", "surrogatepass")
                xs = b.column(3).slice(i, 1).flatten()
                gram, grp, lo, n = (xs.field(k) for k in range(4))
                los, ns = lo.to_numpy(), n.to_numpy()
                texts = [t[s : s + c + length - 1] for s, c in zip(los.tolist(), ns.tolist())]
                yield pa.RecordBatch.from_arrays([gram, grp, pa.array(np.full(len(los), b.column(0)[i].as_py())), pa.array(np.full(len(los), b.column(1)[i].as_py(), np.int32)), lo, n, pa.array(texts, pa.binary())], names=["gram", "grp", "d", "twin", "lo", "n", "bytes"])

    contexts = base.join(need, ["d", "twin"]).select("d", "twin", "text", "xs").mapInArrow(lean(cut), "gram long, grp int, d long, twin int, lo long, n int, bytes binary")

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += int(b["bytes"].map(len).sum())
            if size > SORT_BYTES:
                both = pd.concat(held, ignore_index=True)
                g, k = both["gram"].to_numpy(), both["grp"].to_numpy()
                start = int(np.argmax((g == g[-1]) & (k == k[-1])))  # the last group may go on
                if start:
                    yield from solve(both.iloc[:start])
                held, size = [both.iloc[start:]], int(both["bytes"].iloc[start:].map(len).sum())
        if held:
            yield from solve(pd.concat(held, ignore_index=True))

    def solve(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        # Groups of about SORT_BYTES at a time, cut between grams.
        g, k = rows["gram"].to_numpy(), rows["grp"].to_numpy()
        sizes = np.cumsum(rows["bytes"].map(len).to_numpy())
        edge = np.flatnonzero(np.r_[(g[1:] != g[:-1]) | (k[1:] != k[:-1]), True]) + 1
        at = 0
        while at < len(rows):
            fit = edge[(edge > at) & (sizes[edge - 1] <= (sizes[at - 1] if at else 0) + SORT_BYTES)]
            end = int(fit[-1]) if len(fit) else int(edge[edge > at][0])
            yield from sort_groups(rows.iloc[at:end])
            at = end

    def sort_groups(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows = rows.sort_values(["d", "twin", "lo"], kind="stable").drop_duplicates(["d", "twin", "lo", "gram"])
        texts, n = rows["bytes"].tolist(), rows["n"].to_numpy().astype(np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        base_at = np.cumsum([0, *map(len, texts[:-1])])
        row = np.repeat(np.arange(len(rows)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        pos = base_at[row] + step
        order, same = deep_shallow(data, pos, length)
        repeat = np.zeros(len(pos), bool)
        repeat[order[same]] = True  # the order keeps equal windows by place, so the earliest comes first
        d, twin, lo, grp = (rows[c].to_numpy() for c in ("d", "twin", "lo", "grp"))
        a, z = runs_of(repeat, row)
        if len(a):
            yield pd.DataFrame({"d": d[row[a]], "twin": twin[row[a]], "start": lo[row[a]] + step[a], "end": lo[row[z]] + step[z] + length, "digest": None})
        meet = np.flatnonzero(~repeat & (grp[row] >= 0))
        for at in range(0, len(meet), 50_000):
            m = meet[at : at + 50_000]
            keys = [hashlib.blake2b(data[p : p + length].tobytes(), digest_size=16).digest() for p in pos[m]]
            yield pd.DataFrame({"d": d[row[m]], "twin": twin[row[m]], "start": lo[row[m]] + step[m], "end": lo[row[m]] + step[m] + length, "digest": keys})

    found = stored(contexts.repartition("gram", "grp").sortWithinPartitions("gram", "grp").mapInPandas(lean(sort), "d long, twin int, start long, end long, digest binary"), "found")
    open_ = found.where("digest IS NOT NULL")
    least = open_.groupBy("digest").agg(F.min(F.struct("d", "twin", "start")).alias("f"))
    late = open_.join(least, "digest").where(F.struct("d", "twin", "start") != F.col("f")).select("d", "twin", "start", "end")
    pairs = found.where("digest IS NULL").select("d", "twin", "start", "end").unionByName(late).groupBy("d", "twin").agg(F.collect_list(F.struct("start", "end")).alias("s"))
    return copies.unionByName(pairs).groupBy("d", "twin").agg(F.flatten(F.collect_list("s")).alias("runs"))


def remove_repeats(docs: DataFrame, length: int = 100, keep: tuple[str, ...] = ()) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts earlier.

    Earlier: in a document of smaller doc_id, or before in the same one. Columns: doc_id,
    those in ``keep``, n_bytes, n_removed, n_spans, kept_sha256 over the remaining bytes,
    and kept_text, where a character that is only removed in part stays whole.

    A null text is empty; null ids come last; rows of one id are ordered by a hash of
    their texts, and those alike in id and text count as one document (each comes out);
    an empty table gives an empty one.
    """
    d, twin = identity(docs)
    cols = ["doc_id", *keep]
    found = spans(docs, length)
    base = docs.select(*cols, d.alias("d"), twin.alias("twin"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    both = base.join(found, ["d", "twin"], "left").select(*cols, "text", "runs")
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*cols).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(cols)
        for b in batches:
            out = []
            for i in range(b.num_rows):
                t = b.column(k)[i].as_py().encode("utf-8", "surrogatepass")
                runs = b.column(k + 1)[i].as_py()
                merged = []
                for s, e in sorted((r["start"], r["end"]) for r in runs or []):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                kept, whole, at, at_whole = [], [], 0, 0
                for s, e in merged:
                    kept.append(t[at:s])
                    at = e
                    while s < e and t[s] & 0xC0 == 0x80:  # begins within a character
                        s += 1
                    while s < e < len(t) and t[e] & 0xC0 == 0x80:  # ends within one
                        e -= 1
                    if e > s:
                        whole.append(t[at_whole:s])
                        at_whole = e
                left = b"".join([*kept, t[at:]])
                text = b"".join([*whole, t[at_whole:]]).decode("utf-8", "replace")
                out.append((len(t), len(t) - len(left), len(merged), hashlib.sha256(left).hexdigest(), text))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            new = [pa.array(c, f) for c, f in zip(zip(*out), kinds)] if out else [pa.array([], f) for f in kinds]
            yield pa.RecordBatch.from_arrays([*b.columns[:k], *new], names=[*cols, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return both.mapInArrow(lean(run), head + ", n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")

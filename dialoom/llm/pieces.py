"""SentencePiece models: reading, encoding and decoding in numpy batches."""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from dialoom.llm.common import REMEMBERING, lean

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Characters of encoded units that a worker remembers: those since it last had half as many, and the half before. It bounds memory, not results.
REMEMBERED = 4_000_000
#: Bits of a key beside those that choose its place in a table of what may be a piece.
SLOT = np.uint64(44)
#: The rank of what is never merged.
NEVER = 1 << 40
#: What stands before the first piece of a path.
NONE = -2
PRIME = np.uint64(0x9E3779B97F4A7C15)


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """The fields of a protocol-buffer message: (number, value)."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            n = varint()
            yield key >> 3, data[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield key >> 3, data[at : at + n]
            at += n


class Pieces:
    """A SentencePiece model read from its file's bytes.

    Both unigram and BPE models are encoded by batched Viterbi: units of equal
    length advance together, substring hashes probe sorted piece keys, and row maxima store backpointers. A BPE
    score is the rank of a merge, not a log probability; there the steps score nothing and are open only between
    pieces that merging would leave apart, which gives the very pieces that the merges give.
    """

    def __init__(self, data: bytes):
        self.text, self.score, self.kind = [], [], []
        self.model_type, self.prefix, self.squeeze = UNIGRAM, True, True
        for number, value in _fields(data):
            if number == 1:
                p = dict(_fields(value))
                self.text.append(p.get(1, b"").decode("utf-8"))
                self.score.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                self.kind.append(p.get(3, NORMAL))
            elif number == 2:
                self.model_type = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                n = dict(_fields(value))
                if n.get(2):
                    raise ValueError("models with a character map are not read")
                self.prefix, self.squeeze = bool(n.get(3, 1)), bool(n.get(4, 1))
        if any(k == USER for k in self.kind):
            raise ValueError("models with user-defined pieces are not read")
        self.score = np.array(self.score)
        self.id_of = {t: i for i, (t, k) in enumerate(zip(self.text, self.kind)) if k == NORMAL}
        self.byte_of = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.text, self.kind)) if k == BYTE}
        self.unknown = self.kind.index(UNKNOWN)
        # Units can part before a space sign if no piece has one after another character.
        apart = not any(SPACE in t.lstrip(SPACE) for t in self.id_of)
        self.units = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if apart else "(?s).+", re.S)
        self.bytes = [bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else t.replace(SPACE, " ").encode("utf-8") for t, k in zip(self.text, self.kind)]
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.kept, self.odd = 0, set()
        if self.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are read")
        if self.model_type == BPE:
            self._read_merges()
        self.longest = max(map(len, self.id_of), default=1)
        self.powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(self.longest, PRIME)])
        keys = {int(self._hash(np.array([[ord(c) for c in t]], np.uint64))[0, -1]): i for t, i in self.id_of.items()}
        if len(keys) < len(self.id_of):
            raise ValueError("two pieces have one key")
        self.piece_key = np.array(sorted(keys), np.uint64)
        self.piece_id = np.array([keys[int(k)] for k in self.piece_key], np.int64)
        self.maybe = np.zeros(1 << (64 - int(SLOT)), bool)
        self.maybe[self.piece_key >> SLOT] = True
        self.low = float(self.score[list(self.id_of.values())].min()) - 10.0 if self.id_of else -10.0

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        """Hashes of all prefixes along the rows: h[:, k] covers the first k."""
        h = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        for k in range(codes.shape[1]):
            h[:, k + 1] = h[:, k] * PRIME + codes[:, k] + np.uint64(1)
        return h

    def _viterbi(self, units: list[str]) -> list[bytes]:
        """Best segmentations of units of one length, as 32-bit ids, which advance together by one end after the other.

        Unigram: the sum of the pieces' scores is greatest. BPE: a piece may follow another only if
        merging leaves both as they are; each prefix then has one path, the one that the merges give.
        """
        n, length = len(units), len(units[0])
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length)
        h = self._hash(codes.astype(np.uint64))
        found = []
        for w in range(1, min(self.longest, length) + 1):
            key = h[:, w:] - h[:, :-w] * self.powers[w]
            row, start = np.nonzero(self.maybe[key >> SLOT])  # most substrings are no piece
            key = key[row, start]
            at = np.minimum(np.searchsorted(self.piece_key, key), len(self.piece_key) - 1)
            hit = self.piece_key[at] == key
            piece = np.where(hit, self.piece_id[at], -1)
            if w == 1:  # a character without a piece is a step by itself
                one = np.full((n, length), -1, np.int64)
                one[row, start] = piece
                (row, start), piece, hit = np.divmod(np.arange(n * length), length), one.ravel(), slice(None)
            found.append(np.stack([row[hit], start[hit], piece[hit], np.full(len(row[hit]), w)]))
        row, start, piece, w = np.concatenate(found, 1)
        by = np.argsort(((start + w) * n + row) * length + start)
        row, start, piece, w = (x[by] for x in (row, start, piece, w))
        edge = np.searchsorted(start + w, np.arange(length + 2))
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0
        back, last = np.zeros((n, length + 1), np.int64), np.full((n, length + 1), -1, np.int64)
        for end in range(1, length + 1):
            s = slice(edge[end], edge[end + 1])
            r, c, p = row[s], start[s], piece[s]
            group = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            if self.model_type == BPE:  # all open steps are alike and one is open: the longest come first
                pick, todo = group.copy(), np.arange(len(group))
                while len(todo):
                    at = pick[todo]
                    todo = todo[~self._stay(last[r[at], c[at]], p[at])]
                    pick[todo] += 1
                best[r[pick], end] = 0.0
            else:
                total = best[r, c] + np.where(p >= 0, self.score[p], self.low)
                top = np.maximum.reduceat(total, group)
                pick = np.flatnonzero(total == np.repeat(top, np.diff(np.r_[group, len(r)])))[::-1]  # of equals the first is set last
                best[r[pick], end] = total[pick]
            back[r[pick], end], last[r[pick], end] = c[pick], p[pick]
        # All paths are walked back together, a piece each round.
        end, r, path = np.full(n, length), np.arange(n), []
        while end.any():
            path.append(np.where(end > 0, last[r, end], NONE))
            end = back[r, end]
        path = np.stack(path[::-1], 1).astype(np.int32)
        width, flat = path.shape[1] * 4, path.tobytes()
        first, odd = ((path == NONE).sum(1) * 4).tolist(), (path == -1).any(1).tolist()
        out = [flat[k * width + a : (k + 1) * width] for k, a in enumerate(first)]
        for k in np.flatnonzero(odd).tolist():
            out[k] = np.array(self._fallback(units[k], np.frombuffer(out[k], np.int32).tolist()), np.int32).tobytes()
        return out

    def _stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the texts of pieces a and b, end to end, gives a and b again (-1: nothing to merge with).

        Merges within either go on in the order of their ranks, and of these only
        those at the border matter: what ends a, and what begins b, grow step by step. The two
        symbols at the border would merge if that had the better rank (the leftmost of equals) than the next step of either.
        """
        ok = np.ones(len(a), bool)
        live = np.flatnonzero((a >= 0) & (b >= 0))
        i, j = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        while len(live):
            x, y = a[live], b[live]
            left, right = self.ending[x, i], self.beginning[y, j]
            key = left << 32 | right
            across = np.full(len(key), NEVER)
            maybe = np.flatnonzero(self.maybe_pair[key.view(np.uint64) * PRIME >> SLOT])  # most symbols don't merge
            some = key[maybe]
            at = np.minimum(np.searchsorted(self.pair_key, some), len(self.pair_key) - 1)
            across[maybe] = np.where(self.pair_key[at] == some, self.pair_rank[at], NEVER)
            grow_a, grow_b = self.ending_rank[x, i + 1], self.beginning_rank[y, j + 1]
            done = (grow_a == NEVER) & (grow_b == NEVER)
            merges = (across < grow_a) & (across <= grow_b) & (across < NEVER)
            ok[live[merges]] = False
            first = grow_a <= grow_b
            i, j = i + first, j + ~first
            go = ~(done | merges)
            live, i, j = live[go], i[go], j[go]
        return ok

    def _by_merges(self, u: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Symbols of a text after all merges, the best first and the leftmost of equals, and what each merge joined."""
        ids, n, joined = [self.id_of.get(c, -1) for c in u], len(u), []
        right, left = [*range(1, n), -1], [-1, *range(n - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            m = self.pairs.get(ids[i] << 32 | ids[j]) if ids[i] >= 0 and ids[j] >= 0 else None
            if m is not None:
                heapq.heappush(heap, (self.rank[m], i, ids[i], ids[j], m))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = [False] * n
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = right[i]
            if gone[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j] = m, True
            joined.append((a, b))
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
                offer(i, right[j])
            if left[i] >= 0:
                offer(left[i], i)
        return [x for x, g in zip(ids, gone) if not g], joined

    def _read_merges(self) -> None:
        """What each piece is made of: the pieces it ends and begins with, from a character up to itself, with their ranks."""
        order = sorted(set(self.score.tolist()), reverse=True)
        place = {x: k for k, x in enumerate(order)}
        self.rank = [place[x] for x in self.score.tolist()]
        self.pairs = {}
        for t, i in self.id_of.items():
            for k in range(1, len(t)):
                a, b = self.id_of.get(t[:k]), self.id_of.get(t[k:])
                if a is not None and b is not None:
                    self.pairs[a << 32 | b] = i
        self.pair_key = np.array(sorted(self.pairs), np.int64)
        self.pair_rank = np.array([self.rank[self.pairs[k]] for k in self.pair_key.tolist()], np.int64)
        self.maybe_pair = np.zeros(1 << (64 - int(SLOT)), bool)
        self.maybe_pair[self.pair_key.view(np.uint64) * PRIME >> SLOT] = True
        ends, begins = {}, {}
        for t, i in sorted(self.id_of.items(), key=lambda x: len(x[0])):
            if len(t) == 1:
                ends[i], begins[i] = [i], [i]
                continue
            found, joined = self._by_merges(t)
            if found != [i]:
                continue  # no text is ever merged into it
            a, b = joined[-1]
            if len(t) > 2 and max(self.rank[x] for x in (a, b) if len(self.text[x]) > 1) > self.rank[i]:
                raise ValueError("a piece is ranked before what it is made of")
            ends[i], begins[i] = [*ends[b], i], [*begins[a], i]
        self.id_of = {t: i for t, i in self.id_of.items() if i in ends}
        wide = max(map(len, [*ends.values(), *begins.values()]), default=1) + 1

        def table(spines: dict[int, list[int]]) -> tuple[np.ndarray, np.ndarray]:
            ids, ranks = np.full((len(self.text), wide), -1, np.int64), np.full((len(self.text), wide), NEVER, np.int64)
            for i, x in spines.items():
                ids[i, : len(x)], ranks[i, : len(x)] = x, [self.rank[k] for k in x]
            return ids, ranks

        (self.ending, self.ending_rank), (self.beginning, self.beginning_rank) = table(ends), table(begins)

    def _fallback(self, unit: str, ids: list[int]) -> list[int]:
        """Characters without a piece (-1) become their bytes, or unknown pieces where the model has no bytes."""
        if -1 not in ids:
            return ids
        out, at = [], 0
        for i in ids:
            if i >= 0:
                out.append(i)
                at += len(self.text[i])
            else:
                if self.byte_of:
                    out += [self.byte_of[b] for b in unit[at].encode("utf-8", "surrogatepass")]
                elif not out or out[-1] != self.unknown:  # a run of them is one unknown piece
                    out.append(self.unknown)
                at += 1
        return out

    def normal(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def encode_arrays(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of texts end to end, where each text's begin (and the last one's end), and whether decoding gives each back.

        Only different units are looked up, encoded and decoded; ids are then gathered by unit.
        """
        normal = [self.normal(t) for t in texts]
        units = [self.units.findall(t) for t in normal]
        per_text = np.fromiter(map(len, units), np.int64, len(units))
        code, distinct = pd.factorize(np.array([*chain.from_iterable(units)], object))
        if self.kept > REMEMBERED // 2:
            self.known, self.before, self.kept = {}, self.known, 0
            self.odd = {u for u in self.odd if u in self.before}
        known, before, by_length = self.known, self.before, {}
        for u in distinct:
            if u not in known:
                if u in before:
                    known[u] = before.pop(u)
                    self.kept += len(u)
                else:
                    by_length.setdefault(len(u), []).append(u)
        for length, us in by_length.items():
            step = max(1, 400_000 // length)
            for k in range(0, len(us), step):
                for u, ids in zip(us[k : k + step], self._viterbi(us[k : k + step])):
                    known[u] = ids
                    if b"".join([self.bytes[i] for i in memoryview(ids).cast("i")]) != u.replace(SPACE, " ").encode("utf-8", "surrogatepass"):
                        self.odd.add(u)
            self.kept += length * len(us)
        found = [known[u] for u in distinct]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        every = np.frombuffer(b"".join(found), np.int32)
        taken = size[code]
        ends = np.r_[0, np.cumsum(taken)]
        ids = every[np.repeat((np.cumsum(size) - size)[code] - ends[:-1], taken) + np.arange(ends[-1])]
        text_ends = np.r_[0, np.cumsum(per_text)]
        odd = np.r_[0, np.cumsum(np.fromiter((u in self.odd for u in distinct), np.int64, len(distinct))[code])] if self.odd else np.zeros(len(code) + 1, np.int64)
        whole = odd[text_ends[1:]] == odd[text_ends[:-1]]
        begin = ends[text_ends]
        for k, t in enumerate(texts):
            if SPACE in t or not whole[k]:
                whole[k] = self.decode(ids[begin[k] : begin[k + 1]]) == (re.sub(" +", " ", t).strip(" ") if self.squeeze else t)
        return ids, begin, whole

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        ids, begin, _ = self.encode_arrays(texts)
        return [ids[a:z].tolist() for a, z in zip(begin[:-1], begin[1:])]

    def decode(self, ids) -> str:
        t = b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")
        return t[1:] if self.prefix and t.startswith(" ") else t


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    with open(path, "rb") as f:
        return Pieces(f.read())


REMEMBERING.append(load.cache_clear)


def by_size(b: pa.RecordBatch, column: int, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes in a text column, a row at least: bounded memory for long texts."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, side="right")))
        yield b.slice(at, end - at)
        at = end


def encode(docs: DataFrame, model: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in ``keep``, n_tokens, ids and round_trip of whole texts.

    ``round_trip``: decoding gives the text back (spaces squeezed where the model
    squeezes them). A null text has no ids and round-trips to the empty text; repeated rows stay; an
    empty table gives an empty one. The model file is sent to every executor, and
    nothing is shuffled.
    """
    docs.sparkSession.sparkContext.addFile(model)
    name = model.rsplit("/", 1)[-1]
    cols = ["doc_id", *keep]
    fields = [f for f in docs.select(*cols).schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_tokens long, ids array<int>, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(SparkFiles.get(name))
        for b in batches:
            k = b.num_columns - 1
            for part in by_size(b, k):
                texts = [t or "" for t in part.column(k).to_pylist()]
                ids, begin, same = m.encode_arrays(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:k], pa.array(np.diff(begin)), pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids)), pa.array(same)],
                    names=[*cols, "n_tokens", "ids", "round_trip"],
                )

    return docs.select(*cols, F.col("text").cast("string").alias("text")).mapInArrow(lean(run, forget=False), schema)


def decode(tokens: DataFrame, model: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in ``keep`` and text of rows with token ``ids``.

    Null or empty ids give the empty text; an id that the model doesn't have raises. Bytes that aren't
    valid UTF-8 become replacement characters; repeated rows stay; an empty table gives an empty one.
    """
    tokens.sparkSession.sparkContext.addFile(model)
    name = model.rsplit("/", 1)[-1]
    cols = ["doc_id", *keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*cols).schema) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(SparkFiles.get(name))
        for b in batches:
            texts = [m.decode(x or []) for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], names=[*cols, "text"])

    return tokens.select(*cols, F.col("ids").cast("array<int>").alias("ids")).mapInArrow(lean(run, forget=False), schema)

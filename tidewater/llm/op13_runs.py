"""Periodic runs of words, by uniting suffix classes in order of falling common prefixes.

A run is a stretch of consecutive words with smallest period q and at least ``max(least, times * q)``
words that no neighbour extends.  ``runs`` finds every one of them:

1. Suffixes are sorted by prefix doubling; the ranks of each doubling give the longest common prefix
   (LCP) of neighbours.  A suffix whose prefix occurs once in its text drops out at once, so prose costs
   a few passes over its words.
2. Neighbours are united in order of falling LCP (Kruskal's order; the classes are ranges of the suffix
   order, so a class is found by its ends).  A class keeps its positions in order, and the smaller joins
   the larger.  When a union at LCP l makes positions i < j neighbours, words i.. and j.. agree for exactly
   l words: the stretch from i to j + l has period j - i, and it can't go on to the right.
3. Such a pair is the first of a run if it has enough words and the words before i and j differ (or i is
   the text's first word).  If the stretch holds its period twice, that period is its smallest: a smaller
   one would divide it (Fine and Wilf), and then a position between i and j would agree with i for longer,
   so it would stand between them already.  A run is found by exactly one pair, its first two periods.

Words are numbered inside each text, exactly, and texts are taken together in steps; no prefix spans two
texts.  Memory: some 60 bytes for each word of a step (of one text, if it is longer) and 4 for each
doubling; for words inside runs and other repeats up to 150 more.

``collapsed`` text is a text's words without those that any run holds after its first period.

Defined cases: a null or blank text has no words, no runs and an empty collapsed text; a null doc_id
stays null; repeated rows each have their result; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_of

LEAST = 6
TIMES = 4
#: Bytes of text that are read into words, and words that are sorted, at a time.
STEP_BYTES = 1 << 20
STEP_WORDS = 1 << 18
#: Positions in one piece of a long ordered set.
PIECE = 1024

Rewrite = Callable[[object, int], "np.ndarray | None"]


def numbered(text: str) -> tuple[np.ndarray, list[bytes]]:
    """The text's words (runs of anything but blanks 0x20 and 0x09-0x0D) as numbers, and each number's word."""
    data = text.encode("utf-8", "surrogatepass")
    ids: dict[bytes, int] = {}
    parts = []
    a = 0
    while a < len(data):
        z = min(len(data), a + STEP_BYTES)
        while z < len(data) and data[z] not in b" \t\n\v\f\r":
            z += 1
        # bytes.split without an argument cuts at exactly these six blanks
        parts.append(np.array([ids.setdefault(w, len(ids)) for w in data[a:z].split()], dtype=np.int32))
        a = z
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32), list(ids)


class Ordered:
    """A large set of positions in order, in pieces: to add one moves at most a piece."""

    def __init__(self, some: list[int]):
        self.pieces = [some[i : i + PIECE] for i in range(0, len(some), PIECE)]
        self.firsts = [p[0] for p in self.pieces]
        self.n = len(some)

    def __len__(self) -> int:
        return self.n

    def __iter__(self) -> Iterator[int]:
        return (x for p in self.pieces for x in p)

    def add(self, x: int) -> tuple[int, int]:
        """Adds ``x``; the positions beside it, -1 where there is none."""
        k = max(0, bisect_left(self.firsts, x) - 1)
        piece = self.pieces[k]
        beside = added(piece, x)
        if beside[1] < 0 and k + 1 < len(self.pieces):
            beside = beside[0], self.firsts[k + 1]
        self.firsts[k] = piece[0]
        self.n += 1
        if len(piece) > 2 * PIECE:
            self.pieces[k : k + 1] = [piece[:PIECE], piece[PIECE:]]
            self.firsts.insert(k + 1, piece[PIECE])
        return beside


def added(piece: list[int], x: int) -> tuple[int, int]:
    at = bisect_left(piece, x)
    beside = piece[at - 1] if at else -1, piece[at] if at < len(piece) else -1
    piece.insert(at, x)
    return beside


def prefix_ranks(words: np.ndarray, text_of: np.ndarray) -> list[np.ndarray]:
    """For prefixes of 1, 2, 4... words, the rank of each place's (0 for the place behind the last): equal
    ranks, equal prefixes of one text.  The last ranks are all different."""
    n = len(words)
    ends = np.append(np.flatnonzero(np.diff(text_of)) + 1, n)
    end_of = np.repeat(ends, np.diff(ends, prepend=0))
    _, symbol, counts = np.unique((text_of.astype(np.int64) << 32) | words, return_inverse=True, return_counts=True)
    rank = np.zeros(n + 1, dtype=np.int32)
    rank[:n] = (np.cumsum(counts) - counts + 1)[symbol]
    levels, place, size = [rank], np.arange(n), 1
    while True:
        # A prefix that stands once is in its final place; only the others need more words.
        place = place[np.bincount(rank[place], minlength=n + 2)[rank[place]] > 1]
        if not len(place):
            return levels
        ahead = place + size
        second = np.where(ahead < end_of[place], rank[np.minimum(ahead, n)], 0)
        key = (rank[place].astype(np.int64) << 32) | second
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        at = np.arange(len(place))
        class_start = np.maximum.accumulate(np.where(np.append(True, np.diff(key >> 32) != 0), at, 0))
        key_start = np.maximum.accumulate(np.where(np.append(True, np.diff(key) != 0), at, 0))
        rank = rank.copy()
        rank[place] += (key_start - class_start).astype(np.int32)
        levels.append(rank)
        size *= 2


def suffix_neighbours(words: np.ndarray, text_of: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(place in the suffix order, suffix before, suffix, their LCP) of neighbours in the suffix order
    that share at least ``least`` words."""
    levels = prefix_ranks(words, text_of)
    order = np.empty(len(words), dtype=np.int64)
    order[levels[-1][:-1] - 1] = np.arange(len(words))
    same = levels[min(len(levels) - 1, least.bit_length() - 1)][order]
    r = np.flatnonzero(same[1:] == same[:-1]) + 1
    i, j = order[r - 1], order[r]
    left, right, lcp = i.copy(), j.copy(), np.zeros(len(r), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # The place behind a text's end ranks with another text, or as 0: never the same as one inside.
        agree = levels[k][left] == levels[k][right]
        step = np.where(agree, 1 << k, 0)
        left, right, lcp = left + step, right + step, lcp + step
    far = lcp >= least
    return r[far], i[far], j[far], lcp[far]


def newly_beside(large: "list[int] | Ordered", small: "list[int] | Ordered") -> Iterator[tuple[int, int]]:
    """Adds ``small`` to ``large``; the pairs, one from each, that stand side by side in the end."""
    put = large.add if isinstance(large, Ordered) else lambda x: added(large, x)
    last, after = -1, -1
    for x in small:
        before, then = put(x)
        if before != last or last < 0:
            if after >= 0:
                yield last, after
            if before >= 0:
                yield before, x
        last, after = x, then
    if after >= 0:
        yield last, after


def runs(words: np.ndarray, text_of: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of every run in ``words``, those of each text apart, by start and period."""
    shared = -(-least * (times - 1) // times)
    if times < 2 or shared < 1:
        raise ValueError("a run holds its period twice at least")
    if not len(words):
        return np.empty((0, 3), dtype=np.int64)
    found = array("q")
    # A class of suffixes is a range of their order: its positions, by its first and by its last place.
    by_first: dict[int, tuple] = {}
    by_last: dict[int, tuple] = {}
    r, i, j, lcp = suffix_neighbours(words, text_of, shared)
    falling = np.argsort(-lcp, kind="stable")
    for at, a, b, l in zip(*(x[falling].tolist() for x in (r, i, j, lcp)), strict=True):
        first, left = by_last.pop(at - 1, None) or (at - 1, [a])
        last, right = by_first.pop(at, None) or (at, [b])
        large, small = (left, right) if len(left) >= len(right) else (right, left)
        for x, y in newly_beside(large, small):
            d = y - x
            if d + l >= least and l >= (times - 1) * d:
                found.extend((x, d + l, d))
        if len(large) > 4 * PIECE and not isinstance(large, Ordered):
            large = Ordered(large)
        by_first[first] = last, large
        by_last[last] = first, large
    out = np.array(found, dtype=np.int64).reshape(-1, 3)
    start, period = out[:, 0], out[:, 2]
    before = np.maximum(start - 1, 0)
    opens = (start == 0) | (text_of[before] != text_of[start]) | (words[before] != words[np.maximum(start - 1 + period, 0)])
    out = out[opens]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def kept(n: int, found: np.ndarray) -> np.ndarray:
    """Which of ``n`` words no run holds after its first period."""
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change)[:-1] == 0


def joined(ids: np.ndarray, names: list[bytes]) -> str:
    parts = (b" ".join([names[x] for x in ids[a : a + STEP_WORDS].tolist()]) for a in range(0, len(ids), STEP_WORDS))
    return b" ".join(parts).decode("utf-8", "surrogatepass")


RUNS = "doc_id {id}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def detected(docs: DataFrame, least: int = LEAST, times: int = TIMES, rewrite: Rewrite | None = None) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed of every text.

    ``rewrite`` gets a row's doc_id and number of words and may return, for each place, which of the
    words stands there instead."""
    docs = columns_of(docs, "doc_id", "text")

    def step(ids: list, texts: list[tuple[np.ndarray, list[bytes]]], kind: pa.DataType) -> pa.RecordBatch:
        sizes = np.array([len(w) for w, _ in texts])
        words = np.concatenate([w for w, _ in texts])
        firsts = np.cumsum(sizes) - sizes
        found = runs(words, np.repeat(np.arange(len(texts), dtype=np.int32), sizes), least, times)
        cuts = np.append(np.searchsorted(found[:, 0], firsts), len(found))
        collapsed = []
        for (w, names), first, a, z in zip(texts, firsts, cuts[:-1], cuts[1:], strict=True):
            found[a:z, 0] -= first
            collapsed.append(joined(w[kept(len(w), found[a:z])] if z > a else w, names))
        parts = pa.StructArray.from_arrays([pa.array(found[:, k].copy(), pa.int64()) for k in range(3)], names=["start", "length", "period"])
        columns = [
            pa.array(ids, kind),
            pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), parts),
            pa.array(collapsed, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, kind = [], [], 0, None
        for b in batches:
            kind = b.schema.field("doc_id").type
            for doc, text in zip(b.column("doc_id"), b.column("text"), strict=True):
                doc = doc.as_py()
                words, names = numbered(text.as_py() or "")
                places = rewrite(doc, len(words)) if rewrite and len(words) else None
                if ids and held + len(words) > STEP_WORDS:
                    yield step(ids, texts, kind)
                    ids, texts, held = [], [], 0
                ids.append(doc)
                texts.append((words if places is None else words[places], names))
                held += len(words) + 1
        if ids:
            yield step(ids, texts, kind)

    return docs.mapInArrow(run, RUNS.format(id=docs.schema["doc_id"].dataType.simpleString()))


def repeated_tails(doc_id: object, n: int) -> np.ndarray | None:
    """The query's own change of some texts: from a place on, the words that stand there go round."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def longest_for_its_period(found: Column) -> Column:
    """Of runs by start and period, the first with the greatest length / period; null if there is none."""
    more = lambda best, x: x["length"] * best["period"] > best["length"] * x["period"]
    return F.aggregate(found, F.get(found, F.lit(0)), lambda best, x: F.when(more(best, x), x).otherwise(best))


def written_out(found: Column) -> Column:
    line = lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n"))
    return F.array_join(F.transform(found, line), "")

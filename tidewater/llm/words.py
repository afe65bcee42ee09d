"""Words of whole texts as numpy arrays: spans and hashes, straight from Arrow's text buffers.

``Words`` works on a batch of texts at once, without a Python object for each word.  Batches are cut
to about ``STEP`` bytes of text (one longer text is a batch of its own).  Hashes are made in pieces of as
many bytes, whatever the length of a text or a word; beside them a word takes 16 bytes (its start, end and
hash) and a text's byte 3 for a moment.  Hashes have 64 bits; whoever needs certainty compares the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import once

STEP = 1 << 21
#: Words of [^\x20\x09-\x0D]+, and of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing, as bytes.
PLAIN = np.ones(256, dtype=bool)
PLAIN[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.ones(256, dtype=bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _symbols() -> np.ndarray:
    """A fixed random number for each byte, the same for A and a."""
    return once(("symbols",), lambda: np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER])


def _powers(base: int) -> np.ndarray:
    """``base`` to the power of 0, 1, ... up to a step."""

    def make() -> np.ndarray:
        out = np.full(STEP + 1, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return once(("powers", base), make)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """Of a batch of texts: ``data`` (bytes), ``starts`` and ``ends`` of each word, ``first`` (the number
    of each text's first word, and one more at the end)."""

    def __init__(self, texts: pa.Array, kind: np.ndarray):
        texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
        if texts.null_count:
            texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        low, high = int(offsets[0]), int(offsets[-1])
        self.n = len(texts)
        self.data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[low:high] if high > low else np.empty(0, dtype=np.uint8)
        self.offsets = offsets - low
        inside = kind[self.data]
        size = np.int32 if len(inside) < 1 << 31 else np.int64
        edges = self.offsets[:-1][np.diff(self.offsets) > 0]
        here = inside.copy()
        here[1:] &= ~inside[:-1]
        here[edges] = inside[edges]
        self.starts = np.flatnonzero(here).astype(size)
        here[:] = inside
        here[:-1] &= ~inside[1:]
        here[edges[1:] - 1] = inside[edges[1:] - 1]
        self.ends = np.flatnonzero(here).astype(size) + size(1)
        self.first = np.searchsorted(self.starts, self.offsets)

    def _sum(self, a: int, z: int) -> np.ndarray:
        """Running sums of the bytes a to z, at most a step of them, weighed by the powers from a on."""
        sums = np.zeros(z - a + 1, dtype=np.uint64)
        np.cumsum(_symbols()[self.data[a:z]] * _powers(_BASE)[: z - a], out=sums[1:])
        return sums

    def _long(self, a: int, z: int) -> int:
        """The sum of a word that is longer than a step."""
        total = 0
        for at in range(a, z, STEP):
            total += int(self._sum(at, min(z, at + STEP))[-1]) * pow(_BASE, at - a, 1 << 64)
        return total % (1 << 64)

    def hashes(self) -> np.ndarray:
        """A hash for each word, A-Z as a-z."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        back = _powers(_BASE_INVERSE)
        i = 0
        while i < len(out):
            a = int(self.starts[i])
            j = int(np.searchsorted(self.ends, a + STEP, side="right"))
            if j <= i:
                out[i] = self._long(a, int(self.ends[i]))
                i += 1
                continue
            sums = self._sum(a, int(self.ends[j - 1]))
            starts = self.starts[i:j] - a
            out[i:j] = (sums[self.ends[i:j] - a] - sums[starts]) * back[starts]
            i = j
        return mixed(out)

    def beginnings(self, some: np.ndarray, n: int) -> np.ndarray:
        """A hash of the first ``n`` bytes of ``some`` words (a mask), which must have as many."""
        s = self.starts[some]
        out = np.zeros(len(s), dtype=np.uint64)
        for k in range(n):
            out += _symbols()[self.data[s + k]] * _powers(_BASE)[k]
        return mixed(out + np.uint64(n))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n, dtype=np.int32), self.counts())


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` hashes, in order (len(h) - n + 1 of them)."""
    if len(h) < n:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for a in range(0, len(out), STEP):
        some = out[a : a + STEP]
        for k in range(n):
            some *= np.uint64(_BASE)
            some += h[a + k : a + k + len(some)]
        some[:] = mixed(some + np.uint64(n))
    return out


def steps(batch: pa.RecordBatch, column: str, step: int = STEP) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``step`` bytes of ``column``."""
    texts = batch.column(column)
    sizes = np.diff(np.frombuffer(texts.buffers()[1], dtype=np.int64 if texts.type == pa.large_string() else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64))
    a, held = 0, 0
    for z, size in enumerate(sizes):
        if held and held + size > step:
            yield batch.slice(a, z - a)
            a, held = z, 0
        held += int(size) + 16
    if batch.num_rows > a:
        yield batch.slice(a)

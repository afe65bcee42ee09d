"""Benchmark decontamination: a prefix-filtered join of item windows and documents.

A window is a run of ``WINDOW`` consecutive words of an item (the whole item, if it has fewer).  Its
shingles are its runs of ``SHINGLE`` words, ordered by rarity: by how often each stands in all the
documents.  A document that contains a window contains all its shingles, so the necessary prefix is the rarest one
alone.  Documents' shingles are joined with the windows' rarest ones, by a shuffle; where a document holds
one, at a known distance from a window's start, the window must lie inside the document (position and
length), and its words are compared.

Documents are read twice, as a stream: once to count the windows' shingles, once for the places of prefix
shingles.  A filter of a fixed size (``filter_of``) tells the tasks which shingles may be wanted; it only
spares rows, the joins decide.  So a place goes into the join with the few words around it, no text does, and
neither the windows nor what they hit pass through the driver, however large the benchmark is.  Shingles that
make up more than 1 in ``HOT`` of all that is counted (there are at most ``HOT`` of these) are salted.

Defined cases: null or empty texts have no words, are hit by nothing and hit nothing; items with equal
ids count once, and one without an id counts under an empty id; repeated documents each get their row;
an empty benchmark leaves all documents clean, an empty documents table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, written
from .words import ALNUM, LOWER, Words, runs, steps

WINDOW = 10
SHINGLE = 3
HOT = 1000
#: Slots of a filter's tables, as powers of two: about 32 for each key, within these bounds.
LEAST_SLOTS, MOST_SLOTS = 22, 26


def spoken(w: Words, a: int, z: int) -> str:
    """Words a to z of a batch, lower-cased, a blank between."""
    return " ".join(LOWER[w.data[s:e]].tobytes().decode("utf-8", "replace") for s, e in zip(w.starts[a:z], w.ends[a:z], strict=True))


def windows_of(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item, words, n, hashes, shingles) for each window of each item."""
    i = columns_of(items, "item_id", "text").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, "text", 1 << 16):
                w = Words(b.column("text"), ALNUM)
                h = w.hashes()
                rows = []
                for k, item in enumerate(b.column("item").to_pylist()):
                    a, z = w.first[k], w.first[k + 1]
                    n = min(window, z - a)
                    for s in range(a, z - n + 1) if n else ():
                        own = h[s : s + n]
                        rows.append((item, spoken(w, s, s + n), n, own.view(np.int64), runs(own, min(shingle, n)).view(np.int64)))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["item", "words", "n", "hashes", "shingles"])

    return i.mapInArrow(run, "item string, words string, n int, hashes array<long>, shingles array<long>")


class Filter:
    """Which hashes may be among some keys: two tables, by a hash's upper and by its lower bits."""

    def __init__(self, bits: int):
        self.bits = bits
        self.upper, self.lower = np.zeros(1 << bits, dtype=bool), np.zeros(1 << bits, dtype=bool)

    def _of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return h >> np.uint64(64 - self.bits), h & np.uint64((1 << self.bits) - 1)

    def add(self, h: np.ndarray) -> None:
        up, low = self._of(h)
        self.upper[up], self.lower[low] = True, True

    def places(self, h: np.ndarray) -> np.ndarray:
        """Where in ``h`` one stands that may be a key."""
        p = np.flatnonzero(self.upper[h >> np.uint64(64 - self.bits)])
        return p[self.lower[h[p] & np.uint64((1 << self.bits) - 1)]]


def filter_of(keys: DataFrame) -> Filter:
    """A filter of ``keys.shingle``: tasks fill tables of their own, the driver puts one upon the other."""
    n = keys.count()
    bits = min(MOST_SLOTS, max(LEAST_SLOTS, (32 * n).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filter(bits)
        for b in batches:
            own.add(b.column("shingle").to_numpy(zero_copy_only=False).view(np.uint64))
        told = [np.packbits(own.upper).tobytes(), np.packbits(own.lower).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in told], names=["upper", "lower"])

    out = Filter(bits)
    for r in keys.select("shingle").mapInArrow(run, "upper binary, lower binary").toLocalIterator():
        out.upper |= np.unpackbits(np.frombuffer(r["upper"], dtype=np.uint8)).view(bool)
        out.lower |= np.unpackbits(np.frombuffer(r["lower"], dtype=np.uint8)).view(bool)
    return out


def widths_of(windows: DataFrame) -> list[int]:
    """The widths of the windows' shingles: SHINGLE, and fewer for shorter items."""
    return sorted(r["width"] for r in windows.select(F.least(F.lit(SHINGLE), F.col("n")).alias("width")).distinct().collect())


def wanted_in(w: Words, h: np.ndarray, own: Filter, widths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, shingles) of a batch of texts that may be wanted, for each width."""
    of = w.doc_of_word()
    for width in widths:
        s = runs(h, width)
        p = own.places(s)
        p = p[of[p] == of[p + width - 1]]
        yield p, s[p]


def shingle_counts(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(shingle, seen): how often each shingle of the windows stands in all documents (0: no row)."""
    keys = written(windows.select(F.explode("shingles").alias("shingle")).distinct())
    widths = widths_of(windows)
    sent = docs.sparkSession.sparkContext.broadcast(filter_of(keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, "text"):
                w = Words(b.column("text"), ALNUM)
                found = [s for _, s in wanted_in(w, w.hashes(), sent.value, widths)]
                shingle, seen = np.unique(np.concatenate(found) if found else np.empty(0, dtype=np.uint64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(seen, pa.int64())], names=["shingle", "seen"])

    each = columns_of(docs, "text").mapInArrow(run, "shingle long, seen long")
    return each.groupBy("shingle").agg(F.sum("seen").alias("seen")).join(keys, "shingle", "left_semi")


def prefixed(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(words, n, items, shingle, at, seen): each window with its rarest shingle, that one's place, and how
    often it stands in the documents."""
    windows = written(windows_of(items))
    seen = shingle_counts(docs, windows)
    one = windows.groupBy("words").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"), F.array_sort(F.collect_set("item")).alias("items"))
    each = one.select("words", F.posexplode("shingles").alias("at", "shingle")).join(seen, "shingle", "left")
    rarest = each.groupBy("words").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "shingle", "at")).alias("first"))
    return written(one.join(rarest, "words").select("words", "n", "items", F.col("first.shingle").alias("shingle"), F.col("first.at").alias("at"), F.col("first.seen").alias("seen")))


PLACES = "doc_id {}, text_hash long, n_words long, shingle long, place long, lead int, around array<string>"


def places_of(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """A row for each document (its words' number), and one for each place of a shingle that may be a
    window's prefix: ``around`` are the words that a window there can hold, ``lead`` of them before it."""
    # A shingle that stands in no document is looked for in vain.
    sent = docs.sparkSession.sparkContext.broadcast(filter_of(windows.where("seen > 0").select("shingle").distinct()))
    widths = widths_of(windows)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, "text"):
                w = Words(b.column("text"), ALNUM)
                rows = [(d, None, None, None, None) for d in range(w.n)]
                for p, s in wanted_in(w, w.hashes(), sent.value, widths):
                    doc = np.searchsorted(w.first, p, side="right") - 1
                    first, last = w.first[doc], w.first[doc + 1]
                    a, z = np.maximum(first, p - WINDOW + 1), np.minimum(last, p + WINDOW)
                    for x in zip(doc.tolist(), s.view(np.int64).tolist(), (p - first).tolist(), (p - a).tolist(), zip(a.tolist(), z.tolist(), strict=True), strict=True):
                        rows.append((*x[:4], spoken(w, *x[4]).split(" ")))
                doc, shingle, place, lead, around = zip(*rows, strict=True) if rows else ((),) * 5
                at = pa.array(doc, pa.int64())
                columns = [b.column("doc_id").take(at), b.column("text_hash").take(at), pa.array(w.counts()[list(doc)], pa.int64())]
                columns += [pa.array(c, t) for c, t in ((shingle, pa.int64()), (place, pa.int64()), (lead, pa.int32()), (around, pa.list_(pa.string())))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_words", "shingle", "place", "lead", "around"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, PLACES.format(kind))


def hits_of(places: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, a, z, items): the windows' occurrences, as word numbers a to z, in ``places_of``."""
    total = windows.select("shingle", "seen").distinct().agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]
    share = max(1, -(-total // HOT))
    hot = windows.where(F.col("seen") > share).select("shingle", F.ceil(F.col("seen") / share).cast("int").alias("salts")).distinct()
    found = places.where("shingle is not null").join(F.broadcast(hot), "shingle", "left")
    found = found.withColumn("salt", F.pmod(F.xxhash64("text_hash", "place", "doc_id"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    salts = F.when(F.col("seen") > share, F.ceil(F.col("seen") / share)).otherwise(1).cast("int")
    given = windows.where("seen > 0").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    met = found.join(given, ["shingle", "salt"])
    inside = (F.col("at") <= F.col("lead")) & (F.col("lead") - F.col("at") + F.col("n") <= F.size("around"))
    said = F.array_join(F.slice("around", F.col("lead") - F.col("at") + 1, F.col("n")), " ")
    met = met.where(inside).where(said == F.col("words"))
    start = F.col("place") - F.col("at")
    return met.select("doc_id", "text_hash", start.alias("a"), (start + F.col("n")).alias("z"), "items")


def judged(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, spans, contaminated) for each document.

    ``spans``: the hit stretches as merged intervals of word numbers.
    """
    d = columns_of(docs, "doc_id", "text")
    windows = prefixed(d, items)
    places = written(places_of(d, windows))
    hits = hits_of(places, windows).groupBy("doc_id", "text_hash")
    hits = hits.agg(F.collect_set(F.struct("a", "z")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    f, m = places.where("shingle is null").alias("f"), hits.alias("m")
    both = f.join(m, F.col("f.doc_id").eqNullSafe(F.col("m.doc_id")) & F.col("f.text_hash").eqNullSafe(F.col("m.text_hash")), "left")
    span = "array<struct<a:bigint,z:bigint>>"
    found = both.select("f.doc_id", "f.n_words", F.coalesce("m.spans", F.array().cast(span)).alias("spans"), F.coalesce("m.items", F.array().cast("array<string>")).alias("items"))
    one = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("z"))

    def step(done, x):
        last = F.element_at(done, -1)
        more = F.struct(last["a"].alias("a"), F.greatest(last["z"], x["z"]).alias("z"))
        return F.when(x["a"] <= last["z"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(more))).otherwise(F.concat(done, F.array(x)))

    spans = F.when(F.size("spans") == 0, F.col("spans")).otherwise(
        F.aggregate(F.array_sort("spans"), F.slice(F.array_sort("spans"), 1, 1), step)
    )
    out = found.select("doc_id", "n_words", spans.alias("spans"), F.array_sort(F.array_distinct("items")).alias("items"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["z"] - x["a"])
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "spans", (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that no window of ``items`` hits."""
    d = columns_of(docs, "doc_id", "text")
    windows = prefixed(d, items)
    hit = written(hits_of(written(places_of(d, windows)), windows).select("doc_id", "text_hash").distinct())
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")  # so no name of the table's can clash
    given = docs.select(row, docs["doc_id"].alias("id"), F.xxhash64(docs["text"]).alias("own"))
    left = given.join(hit, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("text_hash")), "left_anti")
    return left.select("row.*")

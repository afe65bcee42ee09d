"""N-gram Jaccard join by a count-vector R-tree, and the components of its links.

A text's set is that of its runs of ``WORDS`` words.  Equal sets are one class, so copies cost nothing
further.  The words' runs are hashed into groups; a set's point is the vector of its group counts, and two
sets have at most the sum of coordinate minima in common.  An R-tree packs the points of a tile: a node
keeps the largest counts below it, which bound what a set may share with any of them; where the bound
falls short of the overlap that the threshold asks for, the node is left.  Surviving pairs are verified
on the sets themselves.

Tiles.  Counts of unlike texts of one size are much alike, so an R-tree over a whole corpus prunes next to
nothing near its root (see the README); its root is therefore a finer kind of groups.  Two sets of sizes a
and b that meet the threshold t differ in at most (a + b)(1 - t)/(1 + t) elements.  Hashed into more
groups than that, they have some non-empty group in common, element by element, and with still more groups
several.  The contents of the groups (``keys``), each with the group's number and the sizes it
serves, are compared by equality.  Since a set must share as many keys as needed with each set near to it, it
leaves out the most frequent ones, one fewer than that: the rarest key that two near sets share is left out by
neither (``telling``).  Sets that share one of what is left are joined into a family, and no link leads out of a
family.  That loses nothing, needs no sample, and texts that share a passage only seldom meet.

A family is one tile or, beyond ``TILE_SETS`` sets or ``TILE_SIZE`` elements, several.  The sets that share
most keys within the family (``HUBS``) are copied to each of its tiles, and join most of what belongs
together.  Sets that are then not in their family's largest component are compared with every tile
of it, so that every pair is joined or has been compared; those that are joined needn't be.  No task holds
more than a tile and a block of such sets.

Defined cases: null or empty texts have an empty set and link with nothing; a text of fewer than
``WORDS`` words is one run; rows that share a doc_id are one node; rows without doc_id get their set's
size, and no component; equal texts of any number are one class; an empty table gives an empty result;
further columns are ignored.  Texts are hashed to 64 bits, classes to 128.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import columns_of, discard, parts_for, written
from .components import components
from .sorted_groups import grouped
from .words import PLAIN, STEP, Words, mixed, runs, steps

WORDS = 3
PERCENT = 90
TILE_SETS = 2048
TILE_SIZE = 1 << 22
HUBS = 32
#: Groups of the count vectors; points of a node.
GROUPS = 64
FAN = 16
#: Times that a set with too many empty groups is dealt anew; by chance that is one in ten to fifty small sets each time.
TURNS = 8
_ODD = np.uint64(0x9E3779B97F4A7C15)


def sets_of(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct run hashes of each text after the other, their number for each text)."""
    w = Words(texts, PLAIN)
    h, n = w.hashes(), w.counts()
    r = runs(h, words)
    out, sizes = [], np.zeros(w.n, dtype=np.int64)
    for i, (a, k) in enumerate(zip(w.first[:-1].tolist(), n.tolist(), strict=True)):
        if k == 0:
            continue
        own = r[a : a + k - words + 1] if k >= words else runs(h[a : a + k], k)
        own.sort()  # no run of one text is part of another's
        if len(own) > 1:
            new = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            own = own[new]
        out.append(own)
        sizes[i] = len(own)
    if len(out) == 1:
        return out[0], sizes
    return (np.concatenate(out) if out else np.empty(0, dtype=np.uint64)), sizes


def sets_in_steps(texts: pa.ChunkedArray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``sets_of`` of any number of texts, some of them at a time."""
    found = [sets_of(b.column("text"), words) for whole in texts.chunks for b in steps(pa.RecordBatch.from_arrays([whole], names=["text"]), "text")]
    if not found:
        return np.empty(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate([h for h, _ in found]), np.concatenate([n for _, n in found])


def levels(most: int) -> np.ndarray:
    """Upper limits of the bands of set sizes, up to ``most``."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, out[-1] * 7 // 5))
    return np.array(out, dtype=np.int64)


def keys_of(h: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(contents of the sets' groups as hashes, their number for each set): see ``keys_and_needs``."""
    return keys_and_needs(h, sizes, percent)[:2]


def keys_and_needs(h: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contents of the sets' groups as hashes, their number for each set, how many of them, at least, each set
    shares with any set that is near to it).

    A set belongs to the band of its size, and to each larger band that holds partners for it.  A band
    up to n has d + 1 groups and three tenths more, where d is what two sets of it can differ in.  Two near sets
    agree in more groups than those spare ones, so each leaves out half as many of its lightest groups, by size and
    content, which say least: what either leaves out of those that they agree in are the lightest of them, that half
    or the empty ones at most, and the rest they share.  If that may be none, both have more empty groups than
    spare ones; sets that do are dealt into groups again, by another hash, up to ``TURNS`` times, so near ones that
    haven't met are both among them.  After the last time empty groups are given too.
    """
    up = levels(int(sizes.max(initial=1)) * 100 // percent + 2)
    home = np.searchsorted(up, sizes)
    starts = np.cumsum(sizes) - sizes
    doc, key = [], []
    need = np.full(len(sizes), np.iinfo(np.int64).max)
    for step in range(len(up)):
        level = home + step
        ok = (sizes > 0) & (level < len(up))
        if step:  # the smallest set of that band must still be near enough
            ok[ok] = sizes[ok] * 100 >= percent * (up[level[ok] - 1] + 1)
        if not ok.any():
            break
        own = np.flatnonzero(ok)
        for turn in range(TURNS):
            n = sizes[own]
            d = 2 * up[level[own]] * (100 - percent) // (100 + percent)
            spare = 3 * (d + 1) // 10
            left = (spare + 1) // 2
            groups = d + 1 + spare
            first = np.cumsum(groups) - groups
            total = np.zeros(groups.sum(), dtype=np.uint64)
            held = np.zeros(len(total), dtype=np.int64)
            ends = np.cumsum(n)
            for a in range(0, int(ends[-1]), STEP):
                z = min(a + STEP, int(ends[-1]))
                low, high = np.searchsorted(ends, [a, z - 1], side="right")
                inside = np.minimum(ends[low : high + 1], z) - np.maximum(ends[low : high + 1] - n[low : high + 1], a)
                of = np.repeat(np.arange(low, high + 1), inside)
                x = h[np.arange(a, z) + (starts[own] - ends + n)[of]]
                dealt = mixed(x ^ np.uint64(turn)) if turn else x
                place = first[of] + ((dealt >> np.uint64(11)) % groups[of].astype(np.uint64)).astype(np.int64)
                np.add.at(total, place, mixed(x ^ _ODD))
                held += np.bincount(place, minlength=len(held))
            of = np.repeat(np.arange(len(own)), groups)
            empty = np.bincount(of[held == 0], minlength=len(own))
            if not turn:
                need[own] = np.minimum(need[own], np.maximum(1 + spare - np.maximum(left, empty), 1))
            again = empty > spare
            light = np.empty(len(total), dtype=bool)
            light[np.lexsort((total, held, of))] = np.arange(len(total)) - np.repeat(first, groups) < left[of]
            keep = ~light & ((held > 0) | (turn == TURNS - 1))
            number = (np.arange(len(total)) - np.repeat(first, groups)).astype(np.uint64)
            name = mixed(number * _ODD + np.repeat(level[own], groups).astype(np.uint64) + np.uint64(turn << 32))
            key.append(mixed(total + name)[keep])
            doc.append(own[of[keep]])
            own = own[again]
            if not len(own):
                break
    if not doc:
        return np.empty(0, dtype=np.uint64), np.zeros(len(sizes), dtype=np.int64), need
    doc, key = np.concatenate(doc), np.concatenate(key)
    return key[np.argsort(doc, kind="stable")], np.bincount(doc, minlength=len(sizes)), need


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))


def described(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, one, two, need, keys) of (doc_id, text, text_hash): the set's size, its
    128-bit hash, its groups' contents and how many of those a near set shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, "text"):
                h, sizes = sets_of(b.column("text"), words)
                some = np.flatnonzero(sizes)
                at = (np.cumsum(sizes) - sizes)[some]
                one, two = np.zeros(len(sizes), dtype=np.uint64), np.zeros(len(sizes), dtype=np.uint64)
                if len(some):
                    one[some], two[some] = np.add.reduceat(mixed(h), at), np.add.reduceat(mixed(h ^ _ODD), at)
                keys, n, need = keys_and_needs(h, sizes, percent)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(sizes), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(need), lists(keys, n)], names=["doc_id", "text_hash", "n_shingles", "one", "two", "need", "keys"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, one long, two long, need long, keys array<long>")


class Tree:
    """An STR-packed R-tree over count vectors: by size, then by the coordinate that varies most."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        slab = max(1, FAN * int(np.sqrt(len(sizes) / FAN)))
        by_size = np.argsort(sizes, kind="stable")
        wide = int(np.argmax(counts.var(axis=0)))
        self.order = np.concatenate([s[np.argsort(counts[s, wide], kind="stable")] for s in (by_size[a : a + slab] for a in range(0, len(sizes), slab))])
        self.counts, self.sizes = counts, sizes
        #: From the leaves up: the largest counts, the smallest and the largest size of each node.
        self.nodes = [(counts[self.order], sizes[self.order], sizes[self.order])]
        while len(self.nodes[-1][0]) > FAN:
            high, low, top = self.nodes[-1]
            at = np.arange(0, len(high), FAN)
            self.nodes.append((np.maximum.reduceat(high, at), np.minimum.reduceat(low, at), np.maximum.reduceat(top, at)))

    def near(self, i: int, percent: int) -> np.ndarray:
        """The points whose overlap with point i may be enough."""
        own, n = self.counts[i], self.sizes[i]
        at = np.arange(len(self.nodes[-1][0]))
        for depth, (high, low, top) in enumerate(reversed(self.nodes)):
            bound = np.minimum(high[at], own).sum(axis=1)
            ok = ((100 + percent) * bound >= percent * (n + low[at])) & (top[at] * 100 >= n * percent) & (n * 100 >= low[at] * percent)
            at = at[ok]
            if depth + 1 < len(self.nodes):
                below = len(self.nodes[len(self.nodes) - 2 - depth][0])
                at = (at[:, None] * FAN + np.arange(FAN)).ravel()
                at = at[at < below]
        return self.order[at]


def links_in(h: np.ndarray, sizes: np.ndarray, turn: np.ndarray, labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links of a tile that join what isn't joined yet, as ``labels`` tells.  ``turn``: 1 for sets that are
    compared with all others first, 2 if only sets marked so are to be."""
    n = len(sizes)
    starts = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(n), sizes)
    counts = np.bincount(of * GROUPS + (h % np.uint64(GROUPS)).astype(np.int64), minlength=n * GROUPS).reshape(n, GROUPS)
    tree = Tree(counts, sizes)
    parent = np.unique(labels, return_inverse=True)[1]
    lead = parent.copy()  # the component of each set, by a number
    out: list[tuple[int, int]] = []
    shared = None
    asked = np.flatnonzero(turn == 2) if (turn == 2).any() else np.lexsort((-sizes, -turn))
    for i in asked.tolist():
        if (lead == lead[i]).all():
            break
        j = tree.near(i, percent)
        j = j[lead[j] != lead[i]]
        if not len(j):
            continue
        if shared is None:  # where each element stands
            _, number = np.unique(h, return_inverse=True)
            order = np.argsort(number, kind="stable")
            ends = np.cumsum(np.bincount(number))
            shared = number, of[order], ends
        number, holders, ends = shared
        mine = number[starts[i] : starts[i] + sizes[i]]
        a, z = np.where(mine > 0, ends[mine - 1], 0), ends[mine]
        size = z - a
        at = np.repeat(a - np.cumsum(size) + size, size) + np.arange(size.sum())
        common = np.bincount(holders[at], minlength=n)[j]
        for k in j[(100 + percent) * common >= percent * (sizes[i] + sizes[j])].tolist():
            if lead[k] != lead[i]:
                out.append((i, k))
                lead[lead == lead[k]] = lead[i]
    return out


def linked(tiled: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links found in ``tiled`` (family, tile, one, node, turn, label, text)."""
    n = parts_for(tiled.sparkSession, 0, 1)
    dealt = tiled.repartition(n, "family", "tile").sortWithinPartitions("family", "tile", "one")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in grouped(batches, ["family", "tile"]):
            h, sizes = sets_in_steps(t["text"], words)
            sets, node = t["one"].to_numpy(), t["node"].to_numpy()
            turn, label = t["turn"].to_numpy(), t["label"].to_numpy()
            _, one = np.unique(sets, return_index=True)  # a hub stands in its own tile twice
            if len(one) < 2:
                continue
            if len(one) < len(sets):
                marked = dict(sorted(zip(sets.tolist(), turn.tolist(), strict=True), key=lambda x: x[1]))
                starts = np.cumsum(sizes) - sizes
                h = np.concatenate([h[starts[i] : starts[i] + sizes[i]] for i in one])
                node, sizes, label = node[one], sizes[one], label[one]
                turn = np.array([marked[x] for x in sets[one].tolist()])
            found = links_in(h, sizes, turn, label, percent)
            if found:
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def telling(sets: DataFrame) -> DataFrame:
    """(doc_id, one, keys) of the sets that share as many keys as they need: the rarest of those that they share,
    so many that one of what a near set shares is among them.

    Keys are ordered by how many rows hold them (any order that all sets have in common would do), in windows
    over numbers, which spill."""
    held = sets.where("doc_id is not null").select(F.explode("keys").alias("key"), "one")
    by_key = W.partitionBy("key")
    met = held.select("key", "one", F.count("*").over(by_key).alias("held"), F.min("one").over(by_key).alias("low"), F.max("one").over(by_key).alias("high"))
    shared = met.where("low < high").groupBy("one").agg(F.array_sort(F.collect_set(F.struct("held", "key"))).alias("shared"))
    need = sets.where("doc_id is not null").groupBy("one").agg(F.min("doc_id").alias("doc_id"), F.min("need").alias("need"))
    enough = shared.join(need, "one").where(F.size("shared") >= F.col("need"))
    return enough.select("doc_id", "one", F.slice("shared", F.lit(1), (F.size("shared") - F.col("need") + 1).cast("int"))["key"].alias("keys"))


def meetings(sets: DataFrame) -> DataFrame:
    """(one, hub, weight): the sets that share keys with a smaller one, and with how many keys.

    The keys are shuffled once.  Sorted, a key's first set is the smallest of those that hold it, and the others
    are joined to it as they pass: nothing is held, however many they are; a set's copies count once."""
    held = sets.where("doc_id is not null").select(F.explode("keys").alias("key"), "one")
    dealt = held.repartition(parts_for(sets.sparkSession, 0, 1), "key").sortWithinPartitions("key", "one")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, set and hub of the row before, and whether its key has had one set so far
        for b in batches:
            if not b.num_rows:
                continue
            k, one = b.column("key").to_numpy(), b.column("one").to_numpy()
            same, again = np.zeros((2, len(k)), dtype=bool)  # as the row before: the key, the key and the set
            same[1:] = k[1:] == k[:-1]
            again[1:] = same[1:] & (one[1:] == one[:-1])
            if last is not None:
                same[0] = k[0] == last[0]
                again[0] = same[0] and one[0] == last[1]
            begun = np.maximum.accumulate(np.where(same, -1, np.arange(len(k))))
            hub = one[np.maximum(begun, 0)]
            if last is not None:
                hub[begun < 0] = last[2]
            met = one != hub
            before = np.concatenate([[last is not None and not last[3]], met[:-1]])
            first = met & ~before  # with a key's second set, the hub is known to share it
            other = met & ~again
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([one[other], hub[first]])), pa.array(np.concatenate([hub[other], hub[first]]))], names=["one", "hub"])
            last = k[-1], one[-1], hub[-1], not met[-1]

    return dealt.mapInArrow(run, "one long, hub long").groupBy("one", "hub").agg(F.count("*").alias("weight"))


def tiles_of(met: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, text_hash, one, family, tiles, tile, hub) of the classes that share a key with another."""
    family = components(met.select(F.col("one").alias("a"), F.col("hub").alias("b")))
    weight = met.groupBy("one").agg(F.sum("weight").alias("weight"))
    members = classes.join(family.select(F.col("node").alias("one"), F.col("component").alias("family")), "one").join(weight, "one", "left")
    size = members.groupBy("family").agg(F.count("*").alias("sets"), F.sum("n").alias("size")).where("sets > 1")
    tiles = F.greatest(F.ceil(F.col("sets") / TILE_SETS), F.ceil(F.col("size") / TILE_SIZE)).cast("int")
    members = members.join(size.select("family", tiles.alias("tiles")), "family")
    members = written(members.select("node", "text_hash", "one", "family", "tiles", F.pmod(F.xxhash64("one"), F.col("tiles")).cast("int").alias("tile"), "weight"))
    best = W.partitionBy("family").orderBy(F.col("weight").desc_nulls_last(), "one")
    hubs = members.where("tiles > 1").withColumn("place", F.row_number().over(best)).where(F.col("place") <= HUBS)
    return members.drop("weight").join(hubs.select("one", "family", F.lit(True).alias("hub")), ["one", "family"], "left")


def joined(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row: see the module's text."""
    d = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    with_keys = written(described(d, words, percent))
    sets = written(with_keys.drop("keys", "need"))
    some = written(telling(with_keys))
    discard(with_keys)  # by far the largest table, read for the last time
    met = written(meetings(some))
    discard(some)
    own = sets.where("n_shingles > 0 and doc_id is not null")
    classes = own.groupBy("one", "two").agg(F.min(F.struct("doc_id", "text_hash")).alias("at"), F.first("n_shingles").alias("n"))
    classes = written(classes.select("one", "two", "n", F.col("at.doc_id").alias("node"), F.col("at.text_hash").alias("text_hash")))

    members = tiles_of(met, classes)
    texts = d.withColumnRenamed("doc_id", "node").join(members.hint("shuffle_hash"), ["node", "text_hash"])
    texts = written(texts.select("family", "tiles", "tile", "one", "node", "hub", "text"))
    discard(met)
    alone = texts.select("family", "tile", "one", "node", F.lit(0).alias("turn"), F.col("node").alias("label"), "text")
    everywhere = texts.where("hub").select("family", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "one", "node", F.lit(1).alias("turn"), F.col("node").alias("label"), "text")
    links = written(linked(alone.unionByName(everywhere), words, percent))

    large = texts.where("tiles > 1")
    if large.limit(1).count():
        stars = components(links)
        links = written(stars.select(F.col("node").alias("a"), F.col("component").alias("b")))
        many = large.join(links.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
        by_label = many.groupBy("family", "label").count()
        largest = by_label.groupBy("family").agg(F.max_by("label", F.struct("count", "label")).alias("largest"))
        many = written(many.join(largest, "family").withColumn("loose", F.col("label") != F.col("largest")).drop("largest"))
        # loose sets in blocks, each compared with every tile of the family
        left = many.where("loose").groupBy("family").agg(F.count("*").alias("n"))
        left = left.select("family", F.ceil(F.col("n") / TILE_SETS).cast("int").alias("blocks"))
        pair = (F.col("tile") * F.col("blocks") + F.col("block")).alias("tile")
        row = lambda turn: ["family", pair, "one", "node", F.lit(turn).alias("turn"), "label", "text"]
        asking = many.where("loose").join(left, "family").withColumn("block", F.pmod(F.xxhash64("one", F.lit(1)), F.col("blocks")).cast("int"))
        asking = asking.drop("tile").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        there = many.join(left, "family").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        links = written(links.unionByName(linked(asking.select(*row(2)).unionByName(there.select(*row(0))), words, percent)))

    # an id with several texts joins their classes
    twice = own.groupBy("doc_id").agg(F.min("one").alias("low"), F.max("one").alias("high")).where("low < high").select("doc_id")
    same = own.join(twice, "doc_id", "left_semi").join(classes, ["one", "two"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    component = components(links.unionByName(same))
    of_class = classes.join(component, "node", "left").select("one", "two", F.coalesce("component", "node").alias("component_id"))
    s, c = sets.alias("s"), of_class.alias("c")
    out = s.join(c, (F.col("s.one") == F.col("c.one")) & (F.col("s.two") == F.col("c.two")) & (F.col("s.n_shingles") > 0), "left")
    return out.select("s.doc_id", "s.n_shingles", F.when(F.col("s.doc_id").isNotNull(), F.coalesce("c.component_id", "s.doc_id")).alias("component_id"))


def one_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all their columns, whose doc_id is their component's smallest; of rows that
    share a doc_id and a component, one.  Texts without runs, and rows without doc_id, all stay."""
    found = joined(docs, words, percent)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")  # so no name of the table's can clash
    d = docs.select(row, docs["doc_id"].cast("long").alias("id"))
    left = d.join(gone, F.col("id") == F.col("doc_id"), "left_anti")
    again = found.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if again.limit(1).count():
        again = written(again.select("doc_id"))
        several = left.join(again, F.col("id") == F.col("doc_id"), "left_semi")
        runs_in = F.coalesce(F.col("row.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        one = several.where(runs_in).groupBy("id").agg(F.min_by("row", F.xxhash64("row.text")).alias("row"))
        rest = left.join(again, F.col("id") == F.col("doc_id"), "left_anti").unionByName(several.where(~runs_in))
        left = rest.unionByName(one.select("row", "id"))
    return left.select("row.*")

"""What steps shuffle, read from their plans: columns and how often."""

import random
import re
import time

import numpy as np
from pyspark.sql import functions as F
from tests_llm_helpers import docs_of

from tidewater.llm import common, op4_jaccard, op6_lines


def exchanges(df):
    """The columns and the number of each shuffle of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"(?<!Reused)Exchange (?:hash|range)partitioning\(([^)]*)\)", plan)


def test_keys_are_shuffled_once_and_each_meets_its_smallest_set(spark):
    r = random.Random(3)
    rows = [(i if i % 17 else None, i % 40 + 1, sorted({r.randrange(60) for _ in range(r.randrange(6))})) for i in range(400)]
    rows += [(1000 + i, 100 + i, [-5]) for i in range(3000)] + [(5000 + i, 7000, [10**6, -9]) for i in range(50)]
    sets = spark.createDataFrame(rows, "doc_id long, one long, keys array<long>")
    assert sum("key" in x for x in exchanges(op4_jaccard.meetings(sets))) == 1
    held = {}
    for i, one, keys in rows:
        for k in keys if i is not None else []:
            held.setdefault(k, set()).add(one)
    want = {}
    for some in held.values():
        for one in some if len(some) > 1 else []:
            want[one, min(some)] = want.get((one, min(some)), 0) + 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert {(x.one, x.hub): x.weight for x in op4_jaccard.meetings(sets).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bands_are_shuffled_without_repeated_columns(spark):
    lines = op6_lines.lines_of(docs_of(spark, [(1, "a line that is long enough to take part", "s")]))
    pairs = op6_lines.pairs_of(op6_lines.buckets_of(op6_lines.classes_of(lines)))
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, x in enumerate(plan) if "Exchange hashpartitioning(bucket" in x)
    assert not [x for x in plan[at + 1 :] if " AS me" in x]


def test_pairs_text_is_fetched_once_the_bands_are_gone(spark):
    lines = op6_lines.lines_of(docs_of(spark, [(1, "a line that is long enough to take part", "s")]))
    assert not [x for x in exchanges(op6_lines.links_of(lines)) if x.startswith("bucket")]


def test_near_sets_share_a_key_and_small_unlike_ones_do_not():
    r = np.random.default_rng(4)
    sets = [r.integers(0, 2**63, n).astype(np.uint64) for n in r.integers(2, 60, 4000)]
    sets += [np.concatenate([s[len(s) // 10 :], r.integers(0, 2**63, len(s) // 10).astype(np.uint64)]) for s in sets]
    sets += [s[: -(-len(s) * 4 // 5)] for s in sets[:4000]]
    sizes = np.array([len(s) for s in sets])
    keys, n = op4_jaccard.keys_of(np.concatenate([np.sort(s) for s in sets]), sizes, 80)
    of = [set(x.tolist()) for x in np.split(keys, np.cumsum(n)[:-1])]
    near = 0
    for i in range(4000):
        for j in (i + 4000, i + 8000):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            if len(a & b) * 10 >= 8 * len(a | b):
                near += 1
                assert of[i] & of[j]
    assert near > 7000
    held = {}
    for i, some in enumerate(of):
        for k in some:
            held.setdefault(k, set()).add(i % 4000)
    assert sum(len(x) > 1 for x in held.values()) < 40
    assert max(len(x) for x in held.values()) < 10


def test_larger_near_sets_share_a_key():
    """At the threshold, where a tenth of the groups is left out as the lightest."""
    r = np.random.default_rng(5)
    new = lambda n: r.integers(0, 2**63, n).astype(np.uint64)
    sets = [new(n) for n in r.integers(60, 900, 600)]
    sets += [np.concatenate([s[len(s) // 9 :], new(len(s) // 9)]) for s in sets]  # 8/9 in common of either: 0.8
    keys, n = op4_jaccard.keys_of(np.concatenate([np.sort(s) for s in sets]), np.array([len(s) for s in sets]), 80)
    of = [set(x.tolist()) for x in np.split(keys, np.cumsum(n)[:-1])]
    near = [i for i in range(600) if len(np.intersect1d(sets[i], sets[i + 600])) * 9 >= 8 * len(sets[i])]
    assert len(near) > 500 and all(of[i] & of[i + 600] for i in near)


def test_texts_that_share_a_passage_do_not_meet_and_near_ones_do(spark):
    r = random.Random(8)
    new = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    passage = new(100)
    texts = [new(700) + passage + new(700) for _ in range(200)]
    texts += [[*t[:1380], *new(120)] for t in texts[:20]]  # of 1,496 runs 1,376 in common: 0.85
    docs = docs_of(spark, [(i, " ".join(t), "s") for i, t in enumerate(texts)])
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    with_keys = common.written(op4_jaccard.described(d, 5, 80))
    some = common.written(op4_jaccard.telling(with_keys))
    assert sum("key" in x for x in exchanges(op4_jaccard.telling(with_keys))) == 1
    near = {*range(20), *range(200, 220)}
    assert {x.doc_id for x in some.collect()} == near
    number = {x.one: x.doc_id for x in with_keys.collect()}
    met = {frozenset((number[x.one], number[x.hub])) for x in op4_jaccard.meetings(some).collect() if x.one != x.hub}
    assert met == {frozenset((i, 200 + i)) for i in range(20)}


def test_near_sets_share_as_many_keys_as_they_need():
    """Of any size, at the threshold; and a rarest shared key is among what both keep, whatever the order."""
    r = np.random.default_rng(6)
    new = lambda n: r.integers(0, 2**63, n).astype(np.uint64)
    sets = [new(n) for n in r.integers(5, 1500, 800)]
    sets += [np.concatenate([s[len(s) // 9 :], new(len(s) // 9)]) for s in sets]  # 8/9 in common of either: 0.8
    sets += [s[: -(-len(s) * 4 // 5)] for s in sets[:800]]  # four fifths of it: 0.8
    keys, n, need = op4_jaccard.keys_and_needs(np.concatenate([np.sort(s) for s in sets]), np.array([len(s) for s in sets]), 80)
    of = [set(x.tolist()) for x in np.split(keys, np.cumsum(n)[:-1])]
    near = [(i, j) for i in range(800) for j in (i + 800, i + 1600) if len(np.intersect1d(sets[i], sets[j])) * 10 >= 8 * len(np.union1d(sets[i], sets[j]))]
    assert len(near) > 1400
    for i, j in near:
        assert len(of[i] & of[j]) >= max(need[i], need[j]) >= 1
    assert np.median(need) > 10


def test_shuffle_files_of_the_step_before_are_let_go(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" ")))

    def step():
        d = spark.range(100_000).repartition(4, "id").groupBy((F.col("id") % 1000).alias("k")).count()
        return common.written(d).join(spark.range(5), F.col("k") == F.col("id"))

    for _ in range(3):
        before = files()
        common.once(("freed",), lambda: [0.0])[0] = time.monotonic()
        after = step()
        new = files() - before
        assert new and after.columns
        common.once(("freed",), lambda: [0.0])[0] = 0.0
        common.free_shuffles(spark)
        for _ in range(20):
            if not files() & new:
                break
            time.sleep(0.1)
        assert not files() & new


def test_a_family_of_near_lines_is_not_paired_by_its_square(spark):
    r = random.Random(5)
    line = "".join(r.choice("abcdefgh ") for _ in range(400))
    rows = [(i, line[: 10 * i + 5] + "#" + line[10 * i + 6 :], "s") for i in range(30)]
    pairs = op6_lines.pairs_of(op6_lines.buckets_of(op6_lines.classes_of(op6_lines.lines_of(docs_of(spark, rows)))))
    assert pairs.distinct().count() < 200  # of 435
    gone = {x.doc_id for x in op6_lines.judged(docs_of(spark, rows)).collect() if x.n_dropped}
    assert gone == set(range(1, 30))


def test_only_classes_that_agree_with_another_go_on(spark):
    s = 0o123456701234567012345
    rows = [(1, 1, 1, s), (1, 2, 2, s ^ 7), (1, 3, 3, s ^ 0o777777777777), (2, 4, 4, s), (3, 5, 5, s), (3, 6, 6, ~s & (1 << 63) - 1)]
    many = [(4, 100 + i, 100 + i, s if i % 2 else ~s & (1 << 63) - 1) for i in range(op6_lines.LARGE + 1)]
    met = op6_lines.met_of(spark.createDataFrame(rows + many, "bucket long, one long, two long, sketch long")).collect()
    assert {x.one for x in met} == {1, 2} | {x[1] for x in many}
    assert {x.held for x in met if x.bucket == 1} == {3}


def test_marks_leave_out_no_near_sets(spark):
    r = random.Random(6)
    sets = {}
    for i in range(0, 120, 2):
        own = [r.getrandbits(64) - 2**63 for _ in range(r.randrange(5, 600))]
        sets[i], sets[i + 1] = own, own[: len(own) - len(own) // (5 + i)]
    sets[200], sets[201] = ([r.getrandbits(64) - 2**63 for _ in range(300)] for _ in range(2))
    each = spark.createDataFrame([(i, len(x), h) for i, x in sets.items() for h in x], "number long, size int, h long")
    marks = op6_lines.marks_of(each)
    of = lambda name: marks.select(F.col("number").alias(name), F.col("size").alias(f"{name}_size"), F.col("marks").alias(f"{name}_marks"))
    pairs = of("a").join(of("b"), F.col("b") == F.col("a") + 1).where(op6_lines.may_be_near("a", "b", 0.8))
    found = {x.a for x in pairs.collect()}
    assert {i for i in range(0, 120, 2) if len(sets[i + 1]) >= 0.8 * len(sets[i])} <= found and 200 not in found


def test_crowded_classes_are_linked_whole_by_their_marks(spark):
    r = random.Random(8)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(60)]
    shared = " ".join(words[:12])
    lines = [f"{shared} {' '.join(r.choice(words) for _ in range(5))} {i}" for i in range(60)]
    lines += [f"{x[:-4]}{r.randrange(1000, 9999)}" for x in lines]
    text = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "number long, line string")
    crowded = spark.createDataFrame([(i, i // 2 * 2) for i in range(len(lines))], "number long, component long")
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in lines]
    want = {(i, j) for j in range(len(lines)) for i in range(j) if i // 2 != j // 2 and 18 * len(sets[i] & sets[j]) >= 8 * (len(sets[i]) + len(sets[j]))}
    found = {(min(int(x.a), int(x.b)), max(int(x.a), int(x.b))) for x in op6_lines.crowded_links(text, crowded).collect()}
    assert found == want and 40 < len(want) < 2000


def test_text_is_fetched_for_pairs_only_that_their_marks_leave(spark):
    r = random.Random(10)
    lines = ["".join(r.choice("abcdefgh ") for _ in range(n)) for n in (30, 60, 300, 900)]
    lines += [x[:-1] + "#" for x in lines]
    text = spark.createDataFrame(list(enumerate(lines)), "number long, line string")
    marks = op6_lines.marks_of(op6_lines.hashes_of(text, "number").withColumnRenamed("n", "size"))
    pairs = spark.createDataFrame([(a, b) for a in range(8) for b in range(a)], "a long, b long")
    assert {(x.a, x.b) for x in op6_lines.bounded(pairs, marks, 0.8).collect()} == {(i + 4, i) for i in range(4)}
    assert {(x.a, x.b) for x in op6_lines.verified(pairs, text, marks).collect()} == {(i + 4, i) for i in range(4)}


def test_texts_are_not_read_again_for_the_lines_that_go(spark, tmp_path):
    docs_of(spark, [(1, "a line that is long enough to take part", "s"), (2, "a line that is long enough to take part", "s")]).write.parquet(str(tmp_path / "d"))
    copies = op6_lines.copies(spark.read.parquet(str(tmp_path / "d")))
    assert [(x.doc_id, x.place) for x in copies.collect()] == [(2, 0)] and not [f for f in copies.inputFiles() if str(tmp_path / "d") in f]


def crowded_rows(spark, r):
    """Classes of two buckets: lines of few syllables, near copies of some, and the pairs that are similar."""
    syllables = [r.choice("bcdfgklmnprstv") + r.choice("aeiou") + r.choice("nrst ") for _ in range(14)]
    lines = ["".join(r.choice(syllables) for _ in range(r.randrange(30, 90))) for _ in range(90)]
    lines += [x[:at] + "#" + x[at + 1 :] for x in lines[:40] for at in (r.randrange(len(x) // 4, len(x)),)]
    text = spark.createDataFrame(list(enumerate(lines)), "number long, line string")
    marks = common.written(op6_lines.marks_of(op6_lines.hashes_of(text, "number").withColumnRenamed("n", "size")))
    met = spark.createDataFrame([(i % 2, i, 0 if i < 20 else i, 0) for i in range(len(lines))], "bucket long, number long, component long, sketch long")
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in lines]
    of = lambda some: {(j, i) for j in range(len(lines)) for i in range(j) if i % 2 == j % 2 and j >= 20 and some(sets[i], sets[j])}
    near = of(lambda a, b: 18 * len(a & b) >= 8 * (len(a) + len(b)))
    return text, common.written(op6_lines.crowded_of(met, marks)), near


def test_a_crowded_bucket_is_compared_whole_in_blocks(spark):
    text, crowded, near = crowded_rows(spark, random.Random(12))
    assert len(near) >= 40
    for size in (200, 7, 1):
        pairs = op6_lines.block_pairs(crowded, F.ceil(F.col("held") / size), True).collect()
        found = {(x.a, x.b) for x in pairs}
        assert near <= found and len(found) == len(pairs) < 2000  # of 130 * 64 / 2
        assert {x.bucket for x in pairs} == {0, 1}
    assert {(x.a, x.b) for x in op6_lines.compared(spark.createDataFrame(pairs).drop("bucket"), text).collect()} == near


def test_sets_of_a_dense_bucket_are_compared_whole(spark, monkeypatch):
    text, crowded, near = crowded_rows(spark, random.Random(13))
    for room in (op6_lines.ROOM, 500):
        monkeypatch.setattr(op6_lines, "ROOM", room)
        links = op6_lines.set_links(crowded, text).collect()
        assert {(x.a, x.b) for x in links} == near and len(links) == len(near)
    assert not op6_lines.dense_of(crowded).collect()
    monkeypatch.setattr(op6_lines, "MANY", 0)
    assert {x.bucket for x in op6_lines.dense_of(crowded).collect()} == {0, 1}
    one = crowded.where("bucket = 0").select("bucket", "number", F.lit(1).alias("component"), "sketch")
    assert not op6_lines.crowded_of(one, crowded.select("number", "size", "marks")).collect()


def test_classes_crowded_by_chance_are_not_compared_by_their_shingles(spark, monkeypatch):
    """Lines of one language with few syllables share shingles by the thousand, and their lists grow by the square."""
    r = random.Random(14)
    syllables = [r.choice("bcdfgklmnprstv") + r.choice("aeiou") for _ in range(9)]
    lines = ["".join(r.choice(syllables) for _ in range(r.randrange(100, 140))) for _ in range(400)]
    copies = {i: lines[i][: 3 * i % 80 + 20] + "#" + lines[i][3 * i % 80 + 21 :] for i in range(0, 400, 10)}
    rows = [(i, x, "s") for i, x in enumerate(lines)] + [(1000 + i, x, "s") for i, x in copies.items()]
    near = {1000 + i for i, x in copies.items() if op6_lines_near(lines[i], x)}
    for name in ("LARGE", "MANY"):
        monkeypatch.setattr(op6_lines, name, 4, raising=False)

    def never(*_):
        raise AssertionError("lists of shingles")

    monkeypatch.setattr(op6_lines, "crowded_links", never)
    met = op6_lines.meetings(op6_lines.lines_of(docs_of(spark, rows)))[2]
    assert met.where("held > 4").select("number").distinct().count() > 100
    gone = {x.doc_id for x in op6_lines.judged(docs_of(spark, rows)).collect() if x.n_dropped}
    assert gone == near and len(near) == 40


def op6_lines_near(a, b):
    a, b = ({x[i : i + 5] for i in range(len(x) - 4)} for x in (a, b))
    return 18 * len(a & b) >= 8 * (len(a) + len(b))

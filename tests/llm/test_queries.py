"""Every query that SQL expresses against its SQL, on the given tables and on awkward ones."""

import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import SF, awkward, docs_of, empty_docs, same

from tidewater.llm import op1_mix, op4_jaccard, op7_decontaminate, op8_topk, op9_licenses, op10_chat, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name])


def as_arrow(df, *columns):
    return df.select(*columns).toArrow()


def test_mixing_of_awkward_rows(spark):
    docs = awkward(spark)
    got = op1_mix.mixed(docs).select("doc_id", "size", "source_size", "target", "taken", "source")
    same(got, queries.ORACLE_SQL["op1_mix_sources"], views={"documents": as_arrow(docs, "doc_id", "text", "source")})


def test_mixing_reaches_its_targets(spark):


    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = op1_mix.mixed(docs).cache()
    largest = got.agg(F.max("size")).first()[0]
    for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("n")).collect():
        assert r.target <= 2 * r.n and abs(r.taken - r.target) <= largest
    assert got.where("taken > 2 * size").count() == 0
    total = got.agg(F.sum("size")).first()[0]
    assert abs(got.agg(F.sum("taken")).first()[0] - 1.5 * total) <= largest * 20
    assert sorted(got.collect()) == sorted(op1_mix.mixed(docs).collect())


def test_ordered_mix_holds_what_was_decided(spark):


    docs = awkward(spark)
    mix = op1_mix.ordered(docs)
    assert mix.columns == [*docs.columns, "mix_pass", "mix_finish"]
    taken = op1_mix.mixed(docs).agg(F.sum("taken")).first()[0]
    words = mix.agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(op1_mix.WORD)), F.lit(0)))).first()[0]
    assert words == taken
    finish = [r.mix_finish for r in mix.collect()]
    assert finish == sorted(finish)


@pytest.mark.parametrize("sizes", [[1, 1, 1], [100, 1, 1], [1, 100, 1], [0, 0, 5], [7, 3, 900, 20, 1, 1]])
def test_waterline_as_resharing_step_by_step(spark, sizes):
    """Targets by the contract's own words: share by weight, stop at twice the size, reshare the excess."""
    rows = [(i * 100 + k, "w", f"s{i}") for i, n in enumerate(sizes) for k in range(n)]
    names = [f"s{i}" for i, n in enumerate(sizes) if n]
    sizes = [n for n in sizes if n]
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    budget = 1.5 * sum(sizes)
    while open_:
        left = budget - sum(target[i] for i in range(len(sizes)) if i not in open_)
        for i in open_:
            target[i] = left * weights[i] / sum(weights[j] for j in open_)
        over = {i for i in open_ if target[i] > 2 * sizes[i]}
        for i in over:
            target[i] = 2.0 * sizes[i]
        if not over:
            break
        open_ -= over
    got = {r.source: r.target for r in op1_mix.mixed(docs_of(spark, rows)).select("source", "target").distinct().collect()}
    assert {n: pytest.approx(t) for n, t in zip(names, target, strict=True)} == got


def test_jaccard_of_awkward_rows(spark):
    docs = awkward(spark)
    got = {(r.doc_id, r.n_shingles): r.component_id for r in op4_jaccard.joined(docs).collect()}
    assert got[(1, 0)] == 1 and got[(2, 0)] == 2 and got[(3, 0)] == 3 and got[(None, 0)] is None
    assert got[(6, 2)] == 6 and got[(7, 2)] == 6 and got[(8, 1)] == 8 and got[(9, 1)] == 9
    assert got[(4, 5000)] == 4 and got[(5, 5001)] == 4
    assert op4_jaccard.joined(empty_docs(spark)).count() == 0
    left = op4_jaccard.one_each(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, [1, 2, 3, None, None, 4, 6, 8, 9, -3]))


def family(n: int, words: int = 60) -> list[str]:
    """Near copies of one text, each with a word or two changed, and unlike texts among them."""
    import random

    r = random.Random(n)
    base = [f"b{i}" for i in range(words)]
    out = []
    for i in range(n):
        t = list(base)
        for _ in range(r.choice([0, 1, 1, 2])):
            t[r.randrange(words)] = f"x{i}{r.random()}"
        out.append(" ".join(t) if i % 7 else " ".join(f"u{i}_{k}" for k in range(r.randrange(1, 40))))
    return out


def brute_components(texts: list[str], words: int, percent: int) -> list[tuple[int, int]]:
    import re

    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    lead = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if lead[i] != lead[j] and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = min(lead[i], lead[j]), max(lead[i], lead[j])
                lead = [a if x == b else x for x in lead]
    return [(len(s), x) for s, x in zip(sets, lead, strict=True)]


@pytest.mark.parametrize("words,percent,tile", [(3, 90, 2048), (3, 90, 16), (5, 80, 24), (2, 60, 2048)])
def test_jaccard_components_by_brute_force(spark, monkeypatch, words, percent, tile):
    """Also where a family takes several tiles, and where most of it is loose at first."""
    monkeypatch.setattr(op4_jaccard, "TILE_SETS", tile)
    monkeypatch.setattr(op4_jaccard, "HUBS", 2)
    texts = family(150)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op4_jaccard.joined(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)]), words, percent).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts, words, percent)


def test_tree_prunes_and_loses_nothing():
    import numpy as np

    r = np.random.default_rng(3)
    counts = r.poisson(3, (500, 64))
    counts[::5] = counts[0] + r.integers(0, 2, (100, 64))
    sizes = counts.sum(axis=1)
    tree = op4_jaccard.Tree(counts, sizes)
    seen = 0
    for i in range(0, 500, 25):
        bound = np.minimum(counts, counts[i]).sum(axis=1)
        ok = (190 * bound >= 90 * (sizes + sizes[i])) & (sizes * 100 >= sizes[i] * 90) & (sizes[i] * 100 >= sizes * 90)
        assert set(np.flatnonzero(ok)) <= set(tree.near(i, 90).tolist())
        seen += len(tree.near(i, 90))
    assert seen < 20 * 500 / 2


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, words string, n int")


def test_decontamination_of_awkward_rows(spark):
    ten = "one two three four five six seven eight nine ten"
    docs = awkward(spark).unionByName(docs_of(spark, [(20, f"zero {ten.upper()}, eleven", "a"), (21, "one two three four five six seven eight nine", "a"), (22, "WORD", None), (22, "WORD", None)]))
    items = items_of(spark, [(1, ten + " eleven", "w", 1), (1, ten, "w", 1), (10, "Word!", "w", 1), (2, None, "w", 1), (3, "", "w", 1), (None, "same short", "w", 1), (9, "·", "w", 1)])
    got = op7_decontaminate.judged(docs, items)


    got = got.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
    views = {"documents": as_arrow(docs, "doc_id", "text"), "benchmark": as_arrow(items, "item_id", "text")}
    same(got, queries.ORACLE_SQL["op7_benchmark_hits"], views=views)
    clean = op7_decontaminate.clean(docs, items)
    assert clean.columns == docs.columns
    assert clean.count() == got.where("not contaminated").count()
    nothing = items_of(spark, [])
    assert op7_decontaminate.judged(docs, nothing).where("contaminated").count() == 0
    assert op7_decontaminate.clean(docs, nothing).count() == docs.count()
    assert op7_decontaminate.judged(empty_docs(spark), items).count() == 0


@pytest.mark.parametrize("slots, hot", [(4, 3), (22, 2)])
def test_decontamination_with_a_full_filter_and_hot_shingles(spark, monkeypatch, slots, hot):
    """Neither a filter that lets everything through nor salted shingles change what is found."""
    monkeypatch.setattr(op7_decontaminate, "LEAST_SLOTS", slots)
    monkeypatch.setattr(op7_decontaminate, "MOST_SLOTS", max(slots, 6))
    monkeypatch.setattr(op7_decontaminate, "HOT", hot)
    given, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    passage = items.first().text
    copies = spark.range(400).selectExpr("id + 100000 as doc_id").withColumn("text", F.lit(passage))
    docs = given.select("doc_id", "text").unionByName(copies)
    same(
        op7_decontaminate.judged(docs, items).select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"),
        queries.ORACLE_SQL["op7_benchmark_hits"],
        views={"documents": as_arrow(docs, "doc_id", "text")},
    )
    dirty = op7_decontaminate.judged(docs, items).where("contaminated").count()
    assert 400 < dirty == docs.count() - op7_decontaminate.clean(docs, items).count()


def test_decontamination_collects_no_windows(spark, monkeypatch):
    """What reaches the driver: numbers, the widths of shingles, and the filters' tables."""
    seen = []
    real = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda self: seen.append(self.columns) or real(self))
    given, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = op7_decontaminate.judged(given, items)._jdf.queryExecution().executedPlan().toString()
    assert seen and {c for columns in seen for c in columns} == {"width", "coalesce(sum(seen), 0)"} and "Join" in plan


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank string, score string")


def test_topk_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(op8_topk, "BLOCK", 7)
    monkeypatch.setattr(op8_topk, "QUERIES", 2)
    rows = [(i, [((i * 7 + k * 3) % 11 - 5) / 8.0 for k in range(4)]) for i in range(60)]
    rows += [(100 + i, [0.5, -0.25, 0.0, 0.125]) for i in range(30)]  # ties
    rows += [(20, [1.0, 1.0, 1.0, 1.0]), (20, [1.0, 1.0, 1.0, 1.0])]  # repeated ids
    rows += [(200, None), (220, [1.0, None, 0.0, 0.0]), (240, [float("nan"), 0.0, 0.0, 0.0]), (260, [float("inf"), 0.0, 0.0, 0.0]), (None, [9.0, 9.0, 9.0, 9.0])]
    e = vectors(spark, [(i, v, 0, "r", "s") for i, v in rows])
    same(op8_topk.top_k(e), queries.ORACLE_SQL["op8_exact_topk"], views={"embeddings": as_arrow(e, "vec_id", "embedding")})
    assert op8_topk.top_k(vectors(spark, [])).count() == 0


def test_topk_beyond_floats_and_unlike_lengths(spark):
    big = 2.0**40
    e = vectors(spark, [(0, [big, 1.0], 0, "", ""), (1, [big, 2.0], 0, "", ""), (2, [1.0], 0, "", ""), (3, [], 0, "", "")])
    got = {r.vec_id: r.score for r in op8_topk.top_k(e).collect()}
    assert got == {1: 2**63 - 1, 2: 2**52, 3: 0}


def test_topk_needs_its_second_phase(spark, monkeypatch):
    """A vector that leads no list, only the sum, is found."""
    monkeypatch.setattr(op8_topk, "BLOCK", 1000)
    rows = [(0, [1.0, 1.0])] + [(i, [3.0 + i / 100, -9.0]) for i in range(1, 30)] + [(i, [-9.0, 3.0 + i / 100]) for i in range(31, 60)] + [(77, [2.0, 2.0])]
    got = op8_topk.top_k(vectors(spark, [(i, v, 0, "", "") for i, v in rows]), k=1).where("query_id = 0").collect()
    assert [(r.vec_id, r.score) for r in got] == [(77, 64 * 64 * 4)]


def test_a_source_of_repeated_rows_gets_its_share(spark):
    """Equal rows are taken one by one: a source of copies is as near its target as any other."""
    rows = [(1, "ten words " * 5, "a")] * 300 + [(k, "ten words " * 5, "b") for k in range(300)] + [(None, f"{k} nine words " * 3, "c") for k in range(300)]
    docs = docs_of(spark, rows)
    got = op1_mix.mixed(docs).cache()
    per = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert all(abs(r.taken - r.target) <= 10 and r.n == 300 for r in per) and len(per) == 3
    assert sum(r.taken for r in per) <= 1.5 * got.agg(F.sum("size")).first()[0]
    assert op1_mix.ordered(docs).groupBy("source").count().collect() != []
    words = op1_mix.ordered(docs).groupBy("source").agg(F.sum(op1_mix.size_of(F.col("text"))).alias("n"))
    assert {r.source: r.n for r in words.collect()} == {r.source: r.taken for r in per}


def test_licenses_of_awkward_rows(spark):
    more = [
        (30, "Released under the MIT License", "a"),
        (31, "mit\nlicense MIT-License, the Apache   license; GENERAL public LICENSE", "a"),
        (32, "license mit", "a"),
        (33, "permitlicense mit licenses", "a"),
        (34, "x\nLicensed under CC BY-NC 4.0.\ny", "a"),
        (35, "the under released license", "a"),
        (36, "K mit İ license", "a"),
    ]
    docs = awkward(spark).unionByName(docs_of(spark, more))
    same(op9_licenses.licenses(docs), queries.ORACLE_SQL["op9_license_scan"], views={"documents": as_arrow(docs, "doc_id", "text")})
    assert op9_licenses.licenses(empty_docs(spark)).count() == 0


def test_wrapped_notices_are_found(spark):
    import textwrap

    marks = ("", "# ", "// ", " * ")
    rows = []
    for i, (_, t) in enumerate(op9_licenses.TEMPLATES):
        rows += [(10 * i + k, f"{mark}x y z\n" + textwrap.fill(t, 72, initial_indent=mark, subsequent_indent=mark) + "\nint main", "a") for k, mark in enumerate(marks)]
    got = {r.doc_id: r for r in op9_licenses.licenses(docs_of(spark, rows)).collect()}
    for i, (label, _) in enumerate(op9_licenses.TEMPLATES):
        for k in range(len(marks)):
            assert label in got[10 * i + k].labels.split(",") and got[10 * i + k].score == 1, got[10 * i + k]
    assert {(r.labels, r.score) for r in op9_licenses.licenses(awkward(spark)).where("n_base = 0").collect()} == {("", 0.0)}
    assert op9_licenses.licenses(empty_docs(spark)).count() == 0


def test_a_long_text_with_notices_across_windows(spark):
    """A notice at every place of a long text is found, whatever window it falls into."""
    notice = op9_licenses.TEMPLATES[1][1]
    rows = [(k, "w " * k + notice + " w" * (300 - k), "a") for k in range(0, 300, 7)] + [(1000, ("w " * 200 + "Released under the BSD License ") * 400, "a")]
    docs = docs_of(spark, rows)
    got = {r.doc_id: (r.labels, r.score) for r in op9_licenses.licenses(docs).collect()}
    assert got == {k: ("apache", 1.0) if k < 1000 else ("bsd", 1.0) for k, *_ in rows}
    same(op9_licenses.licenses(docs), queries.ORACLE_SQL["op9_license_scan"], views={"documents": as_arrow(docs, "doc_id", "text")})


def test_each_notice_gets_its_own_label_alone(spark):
    nc = "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"
    mozilla = "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/2.0"
    lgpl = "This work is licensed under the GNU Lesser General Public License, version 3"
    loose = "The library was released long ago, under a tree, and the others have no license to read it"
    more = [("mit", "Released under the MIT License."), ("cc-by-nc", "Licensed under CC BY-NC 4.0."), ("", "Released long ago under a tree, and the others have no license")]
    # the base phrase "general public license" stands in lgpl: its label stays, though no template is met
    more += [("", "Released under the License"), ("", loose), ("", nc), ("", mozilla), ("gpl", lgpl), ("bsd,mit", "Released under the MIT License.\nReleased under the BSD License.")]
    given = [*op9_licenses.TEMPLATES, *more]
    for around in ("{}", "before it\n{}.\nafter it"):
        got = {r.doc_id: r.labels for r in op9_licenses.licenses(docs_of(spark, [(i, around.format(t), "a") for i, (_, t) in enumerate(given)])).collect()}
        assert [got[i] for i in range(len(given))] == [label for label, _ in given]


CONVERSATIONS = "conv_id long, turn long, role string, text string, has int, ids string, chunk long"


def test_chat_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(op10_chat, "CHUNK_TURNS", 3)
    texts = [None, "", "plain", op10_chat.PROBE, "\\", "\\\\n \\<s>", "<<s>", "[[INST]INST]", "</\\s>", "<|role|><|text|><|end|>", "é漢字🙂", " lead and trail \n", "<|endoftext|>", "x" * 50_000]
    rows = [(1, i, ("user", "assistant", "system", "tool", None, "[INST]", "a\\b")[i % 7], t) for i, t in enumerate(texts)]
    rows += [(2, 0, "user", "tie"), (2, 0, "assistant", "tie"), (2, 0, "user", "a tie"), (2, 0, "user", "tie"), (2, None, "assistant", "first"), (None, 1, "assistant", "no id"), (None, 0, "user", None)]
    rows += [(3, i, "assistant", t) for i, t in enumerate(texts)]
    c = spark.createDataFrame([(*r, 7, "i", 9) for r in rows], CONVERSATIONS)
    got = op10_chat.read_back(op10_chat.formatted(c))


    got = got.select(F.when(F.col("has") == 1, F.col("conv")).alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").where("conv_id is null or conv_id <> -7")
    sql = f"SELECT * FROM ({queries.ORACLE_SQL['op10_chat_format'].replace('ORDER BY turn, role, t', 'ORDER BY turn NULLS FIRST, role, t')}) WHERE conv_id IS NULL OR conv_id <> -7"
    same(got, sql, views={"conversations": as_arrow(c, "conv_id", "turn", "role", "text")})
    assert op10_chat.formatted(spark.createDataFrame([], CONVERSATIONS)).count() == 0


def test_chat_escapes_come_back():
    from hypothesis import given
    from hypothesis import strategies as st

    pieces = st.lists(st.sampled_from([*op10_chat.CONTROL, "\\", "<", "[", "s>", "/", "x", "INST]"]), max_size=12).map("".join)

    @given(pieces)
    def check(t):
        e = op10_chat.escaped(t)
        assert op10_chat.unescaped(e) == t
        assert not any(c in e for c in op10_chat.CONTROL)

    check()

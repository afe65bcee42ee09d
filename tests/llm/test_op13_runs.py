"""Runs against their definition, by trying every period at every place."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import op13_runs
from tidewater.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def runs_by_hand(words, least=6, times=4):
    n, found = len(words), []
    ends = {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            z = i + q
            if z - a >= max(least, times * q) and not any(x <= a and z <= y for p, x, y in ends.get(z, ()) if q % p == 0):
                found.append((a, z - a, q))
                ends.setdefault(z, []).append((q, a, z))
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts_of_runs(draw):
    for k in range(400):
        alphabet = "abcdefgh"[: draw.randint(1, 6)]
        text = []
        while len(text) < draw.randint(0, 90):
            if draw.random() < 0.4:
                text += draw.choices(alphabet, k=draw.randint(1, 7)) * draw.randint(2, 9)
            else:
                text += draw.choices(alphabet, k=draw.randint(1, 8))
        yield text
    a, b = ["a"], ["a", "b"]
    for _ in range(9):
        a, b = b, b + a
    yield b  # Fibonacci word
    t = [0]
    for _ in range(7):
        t = t + [1 - x for x in t]
    yield [str(x) for x in t]  # Thue-Morse word: no run at all


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (9, 3)])
def test_all_runs_of_small_texts(least, times):
    texts = list(texts_of_runs(random.Random(7)))
    for some in (texts, *[[t] for t in texts[:60]]):
        sizes = [len(t) for t in some]
        ids = {}
        words = np.array([ids.setdefault(w, len(ids)) for t in some for w in t], dtype=np.int32)
        found = op13_runs.runs(words, np.repeat(np.arange(len(some), dtype=np.int32), sizes), least, times)
        want, at = [], 0
        for t in some:
            want += [(at + s, n, q) for s, n, q in runs_by_hand(t, least, times)]
            at += len(t)
        assert [tuple(r) for r in found.tolist()] == want


@pytest.mark.parametrize("period", [1, 3, 7_000])
def test_long_runs_take_no_quadratic_time(period):
    words = np.append(np.arange(period, dtype=np.int32)[np.arange(300_000) % period], np.int32(-1))
    found = op13_runs.runs(words, np.zeros(len(words), dtype=np.int32))
    assert found.tolist() == [[0, 300_000, period]]


def by_hand(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs_by_hand(w)
    drop = {k for s, z, q in found for k in range(s + q, s + z)}
    best = None
    for s, z, q in found:
        if best is None or z * best[2] > best[1] * q:
            best = (s, z, q)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    written = "".join(f"{s},{z},{q}\n" for s, z, q in found)
    kept = " ".join(x for k, x in enumerate(w) if k not in drop)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(written), sha(kept))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_the_query_on_a_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.001")
    assert rows_of(got) == sorted((by_hand(i, t) for i, t in rows if len(t or "") < 1e9), key=str)
    assert sum(r[1] for r in rows_of(got)) > 5
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_awkward_rows(spark, tmp_path):
    draw = random.Random(2)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (None, "a b " * 9), (4, "A a " * 6), (5, "x" * 100_000), (6, "z " * 7), (6, "z " * 7)]
    rows += [(7, "ä ö ü " * 5 + "\x1c \x85"), (8, "no runs here at all")]
    rows += [(i, " ".join(draw.choices("ab", k=draw.randint(1, 60)))) for i in range(100, 200)]
    docs = spark.createDataFrame([(i, t, 9, "r") for i, t in rows], "doc_id long, text string, start int, runs string").repartition(2)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = rows_of(QUERIES["op13_periodic_runs"](spark, str(tmp_path)))
    assert got == sorted((by_hand(i, t) for i, t in rows), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == sorted(con.sql(ORACLE_SQL["op13_periodic_runs"]).fetchall(), key=str)
    assert op13_runs.detected(docs.where("false")).count() == 0
    told = {r.doc_id: r for r in op13_runs.detected(docs.where("doc_id in (2, 6, 8)")).collect()}
    assert [tuple(x) for x in told[6].runs] == [(0, 7, 1)] and told[6].collapsed == "z" and told[8].collapsed == "no runs here at all" and told[2].collapsed == ""


def test_a_step_of_many_texts_and_a_long_one(spark):
    text = " ".join(random.Random(1).choices(["w%d" % k for k in range(50_000)], k=600_000)) + " end" * 20
    docs = spark.createDataFrame([(1, text), (2, "a " * 8), (3, text)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in op13_runs.detected(docs).collect()}
    assert got == {1: [(600_000, 20, 1)], 2: [(0, 8, 1)], 3: [(600_000, 20, 1)]}


def test_ties_of_the_best_run(spark):
    rows = [(1, [(0, 8, 2), (10, 4, 1)]), (2, [(3, 8, 2), (3, 12, 3)]), (3, []), (4, [(0, 7, 2), (9, 8, 2)])]
    df = spark.createDataFrame(rows, "k int, runs array<struct<start:long,length:long,period:long>>")
    got = {r.k: r.best and tuple(r.best) for r in df.select("k", op13_runs.longest_for_its_period(F.col("runs")).alias("best")).collect()}
    assert got == {1: (0, 8, 2), 2: (3, 8, 2), 3: None, 4: (9, 8, 2)}

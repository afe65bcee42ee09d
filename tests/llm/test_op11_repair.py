"""Repairs against SQL on the given tables, and against all edit sequences on small ones."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb
import pytest

from tidewater.llm import op11_repair
from tidewater.llm.queries import ORACLE_SQL, QUERIES

NAME = "op11_conversation_repair"
BLANK = "\x20\t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired rows), of rows (role, text, fault), by a search over edits in order of (cost, audit)."""
    heap = [(0, "", 0, ())]
    seen = set()
    while heap:
        cost, audit, k, out = heapq.heappop(heap)
        initials = "".join(r[:1] for r, _ in out)
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, out
        key = (k, {"": 0, "s": 1}.get(initials, 2 if initials.endswith("u") else 3))
        if key in seen:
            continue
        seen.add(key)

        def on(more, edit, k, row):
            new = out if row is None else (*out, row)
            if re.fullmatch("(s?(ua)*u?)?", "".join(r[:1] for r, _ in new)) and all(r for r, _ in new):
                heapq.heappush(heap, (cost + more, audit + edit, k, new))

        for role in ("user", "assistant"):
            on(5, "I", k, (role, ""))
        if k < len(rows):
            role, text, fault = rows[k]
            on(2, "D", k + 1, None)
            if fault not in ("b", "d"):
                extra = 5 if fault == "t" else 0
                on(extra, "K", k + 1, (role, text))
                for made in ("user", "assistant"):
                    on(1 + extra, "R", k + 1, (made, text))
    raise AssertionError


def by_hand(conversations):
    groups = {}
    for conv, turn, role, text in conversations:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = groups.setdefault(conv, [])
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        row = (turn is not None, turn or 0, "user" if h == 4 else role, text)
        kept += [row, row] if h == 3 else [row]
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0], r[1], r[2], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
        seen, judged = set(), []
        for *_, role, text in rows:
            said = text.strip(BLANK)
            fault = "b" if not said else "d" if (role, text) in seen else "t" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for known, t, *_ in rows if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for *_, f in judged]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        cost, audit, said = cheapest(judged)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_every_short_signature():
    """Cost and audit of all signatures of up to four rows, against the search."""
    symbols = {"s": ("system", ""), "u": ("user", ""), "a": ("assistant", ""), "o": ("tool", ""), "x": ("user", "b")}
    symbols |= {k.upper(): (r, "t") for k, (r, f) in symbols.items() if not f}
    for n in range(4):
        for signature in itertools.product(symbols, repeat=n):
            path = [op11_repair.end_node()]
            for s in reversed(signature):
                path.append(op11_repair.node_before(s, path[-1]))
            want = cheapest([(symbols[s][0], str(i), symbols[s][1]) for i, s in enumerate(signature)])
            assert (path[-1][0][0], op11_repair.audit_of("".join(signature), path)) == want[:2], signature


def awkward():
    draw = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "us"]
    texts = [None, "", " \t", "Yes.", "No!", "and then", "Why? \n", "é.", "a" * 5000 + "."]
    rows = [(conv, turn, draw.choice(roles[: draw.choice((2, 3, 8))]), draw.choice(texts)) for conv in range(150) for turn in range(draw.randint(1, 9))]
    rows += [(c, None, "user", "Null turn.") for c in (1, 1, 2, None)] + [(None, t, "assistant", f"{t}.") for t in range(4)]
    rows += rows[:40] + [(-5, 2**40, "user", "Far."), (-5, 1, "user", "Near.")]
    return rows


def test_awkward_rows_by_hand_and_by_sql(spark, tmp_path):
    rows = awkward()
    table = spark.createDataFrame([(*r, 0, "x", False) for r in rows], "conv_id long, turn long, role string, text string, kind int, audit string, gone boolean")
    table.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = rows_of(QUERIES[NAME](spark, str(tmp_path)))
    assert got == by_hand(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert got == sorted(con.sql(ORACLE_SQL[NAME]).fetchall(), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_tables_by_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('/root/testdata/{sf}/conversations.parquet')")
    want = con.sql(ORACLE_SQL[NAME])
    got = QUERIES[NAME](spark, f"/root/testdata/{sf}")
    assert got.columns == want.columns
    assert rows_of(got) == sorted(want.fetchall(), key=str)
    assert {f.dataType.simpleString() for f in got.schema} == {"bigint", "string"}


def test_repaired_rows_and_a_long_conversation(spark):
    turns = [("system", "Be brief.")] + [("user", f"Question {k}?") if k % 2 == 0 else ("assistant", f"Answer {k}.") for k in range(30_000)]
    rows = [(1, k, r, t) for k, (r, t) in enumerate(turns)] + [(2, 0, "assistant", "Only this."), (3, 0, "user", "cut off")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept, signed, audits = op11_repair.repair(table)
    out = [tuple(r) for r in op11_repair.repaired(kept, audits).where("conv > 1").orderBy("conv", "place").collect()]
    assert out == []  # both are cheaper deleted (2) than completed (5)
    assert {r.conv: (r.cost, r.audit) for r in audits.collect()} == {1: (0, "K" * 30_001), 2: (2, "D"), 3: (2, "D")}
    assert [r.text for r in op11_repair.repaired(kept, audits).where("conv = 1").orderBy("place").collect()] == [t for _, t in turns]


def test_ends_are_worked_out_once(monkeypatch):
    """The nodes of the automaton that a sweep works out: one for each distinct end."""
    draw = random.Random(4)
    signatures = ["".join(draw.choices("suax", k=draw.randint(0, 6))) for _ in range(500)]
    made = []
    monkeypatch.setattr(op11_repair, "node_before", lambda s, after, real=op11_repair.node_before: made.append(s) or real(s, after))
    path, before = [op11_repair.end_node()], ""
    for ends in sorted(s[::-1] for s in signatures):
        path, before = op11_repair.on_path(path, before, ends), ends
        assert path[-1][0][0] == cheapest([({"s": "system", "a": "assistant"}.get(s, "user"), str(i), "b" if s == "x" else "") for i, s in enumerate(ends[::-1])])[0]
    assert len(made) == len({s[k:] for s in signatures for k in range(len(s))})


def test_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    rows, signed, audits = op11_repair.repair(op11_repair.damaged(none))
    assert signed.count() == audits.count() == op11_repair.repaired_digests(rows, audits).count() == 0

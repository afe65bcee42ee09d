"""Cheapest repair of conversations, by one automaton of all their signatures, shared from the end.

A row's symbol is its role's initial, or ``x`` where it has to be deleted (blank or duplicate), in upper
case where it is truncated.  A conversation's signature is its rows' symbols in order.  The grammar of
role initials is ``(s?(ua)+)?``; its states are what may follow: nothing yet, after s, after u, after a.

What a repair costs from a row on depends on the rest of the signature alone.  So ``audited`` sorts the
signatures by their reversal, dealt by ranges of it: equal ends are then neighbours, and one pass holds
the path of the automaton from the end to where the present signature stands.  A node (a distinct end of
a signature) gets, once, for each grammar state its cost-to-go and its best next edit; the node and state
that follow are given by the edit, so the best audit from there is a chain of such entries, shared by
all signatures with that end.  (Where a range begins, its first path is worked out anew.)  Ties: an edit
and a state leave one way to go on, so the ASCII-least of the cheapest audits takes the least initial at
each step.  A repaired conversation follows from its rows and its audit: Keep and Rerole and Insert yield
the role that the state asks for.

Three streams over sorted rows, none of which holds a conversation: ``signatures`` (without the texts:
each row's flags and digest), ``audited``, ``repaired`` (each conversation's audit sorted before its
rows).  A signature and an audit have one character for each row or edit of a conversation.

Defined cases: a null role or text is one space; a null turn sorts first; a null conv_id is a
conversation of its own, null in the result; rows of one turn go by role, then digest; repeated rows are
rows; an empty role has no initial and can't be kept; roles of other initials are reroled or deleted; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, parts_for, written

#: Costs and initials of the edits (fixed values of the contract).
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
#: Grammar states: nothing yet, after s, after u, after a; where a repair may end.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = (START, AFTER_A)
#: The state after a kept role of that initial, by the state before; and after one of our making.
KEPT = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
MADE = {START: (AFTER_U, USER), AFTER_S: (AFTER_U, USER), AFTER_U: (AFTER_A, ASSISTANT), AFTER_A: (AFTER_U, USER)}
BLANK = " \t\n\v\f\r"
#: Signatures that the sweep's results are sent in, and rows read at a time.
BATCH = 1024

Node = tuple  # for each state: (cost to go, best next edit)


def end_node() -> Node:
    """The node behind the last row: only inserts are left."""
    best = [(0, "") if s in ENDS else None for s in range(4)]
    best[AFTER_U] = (INSERT, "I")
    best[AFTER_S] = (2 * INSERT, "I")
    return tuple(best)


def node_before(symbol: str, after: Node) -> Node:
    """The node of a row with ``symbol`` whose rest is ``after``."""
    must_go, initial = symbol == "x", symbol.lower()
    more = TRUNCATED if symbol.isupper() else 0
    best = []
    for state in range(4):
        ways = [(after[state][0] + DELETE, "D")]
        if not must_go:
            kept = KEPT.get(initial, {}).get(state)
            if kept is not None:
                ways.append((after[kept][0] + KEEP + more, "K"))
            ways.append((after[MADE[state][0]][0] + REROLE + more, "R"))
        best.append(min(ways))
    # An insert stays at the row and changes the state; two rounds settle it, as each costs.
    for _ in range(2):
        best = [min(best[s], (best[MADE[s][0]][0] + INSERT, "I")) for s in range(4)]
    return tuple(best)


def on_path(path: list[Node], before: str, ends: str) -> list[Node]:
    """The path of the reversed signature ``ends``, from that of ``before``: what they share is kept."""
    shared = len(os.path.commonprefix([before, ends]))
    del path[shared + 1 :]
    for symbol in ends[shared:]:
        path.append(node_before(symbol, path[-1]))
    return path


def audit_of(signature: str, path: list[Node]) -> str:
    """The edits from the first row on; ``path[k]`` is the node of the last k rows."""
    out, state, left = [], START, len(signature)
    while True:
        edit = path[left][state][1]
        if not edit:
            return "".join(out)
        out.append(edit)
        if edit == "K":
            state = KEPT[signature[len(signature) - left].lower()][state]
        elif edit in "RI":
            state = MADE[state][0]
        left -= edit != "I"


def judged_rows(conversations: DataFrame) -> DataFrame:
    """Rows with their place in the conversation and what is wrong with each by itself: has, conv, kind
    (0: any row, so that none of the conversations is lost; 1: one to repair), turn, role, text, digest,
    blank, truncated.  ``conversations`` has conv_id, turn, role, text and gone."""
    said = F.rtrim("text", F.lit(BLANK))
    return conversations.select(
        F.col("conv_id").isNotNull().cast("int").alias("has"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.when(F.col("gone"), 0).otherwise(1).alias("kind"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")).alias("digest"),
        (said == "").alias("blank"),
        (~F.substring(said, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )


SIGNED = "has int, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"


def signatures(rows: DataFrame) -> DataFrame:
    """A row for each conversation: its faults and its signature, from ``judged_rows``.  Texts stay behind."""
    n = parts_for(rows.sparkSession, 0, 1)
    # A copy is one that isn't the first of its kind: a window over (conversation, digest), so that no
    # conversation's digests are held.
    same = Window.partitionBy("has", "conv", "kind", "digest").orderBy("turn")
    slim = rows.select("has", "conv", "kind", "turn", "role", "digest", "blank", "truncated", (F.row_number().over(same) > 1).alias("copy"))
    fault = F.when(F.col("blank"), "b").when(F.col("copy"), "d").when(F.col("truncated"), "t").otherwise("-")
    initial = F.substring("role", 1, 1)
    dealt = slim.select("has", "conv", "kind", "turn", "role", "digest", "copy", initial.alias("initial"), fault.alias("fault"))
    dealt = dealt.repartition(n, "has", "conv").sortWithinPartitions("has", "conv", "kind", F.col("turn").asc_nulls_first(), "role", "digest", "copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        key, state = None, None

        def close() -> None:
            first, last, turns, counts, illegal, _, signature = state
            gaps = last - first + 1 - turns if turns else 0
            done.append((*key, gaps, counts["b"], counts["d"], counts["t"], illegal, signature.decode("ascii")))

        def flush() -> pa.RecordBatch:
            kinds = [pa.int32(), *[pa.int64()] * 6, pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SIGNED.split(", ")])

        for b in batches:
            for has, conv, kind, turn, initial, fault in zip(*(b.column(x).to_pylist() for x in ("has", "conv", "kind", "turn", "initial", "fault")), strict=True):
                if (has, conv) != key:
                    if state:
                        close()
                        if len(done) >= BATCH:
                            yield flush()
                    key, state = (has, conv), [None, None, 0, {"b": 0, "d": 0, "t": 0, "-": 0}, 0, None, bytearray()]
                if not kind:
                    continue
                if turn is not None:
                    if state[0] is None:
                        state[0] = turn
                    state[2] += turn != state[1]
                    state[1] = turn
                state[3][fault] += 1
                if state[5] is not None:
                    state[4] += state[5] + initial not in ("su", "ua", "au")
                state[5] = initial
                symbol = "x" if fault in "bd" else initial if initial in ("s", "u", "a") else "o"
                state[6] += (symbol.upper() if fault == "t" else symbol).encode()
        if state:
            close()
        if done:
            yield flush()

    return dealt.drop("role", "digest", "copy").mapInArrow(run, SIGNED)


AUDITED = "has int, conv long, cost long, audit string"


def audited(signed: DataFrame) -> DataFrame:
    """has, conv, cost and audit of every conversation, from ``signatures``."""
    n = parts_for(signed.sparkSession, 0, 1)
    # A signature that a third of all conversations have is dealt over as many ranges by the conversation.
    ends = signed.select("has", "conv", F.reverse("signature").alias("ends"))
    dealt = ends.repartitionByRange(n, "ends", "conv").sortWithinPartitions("ends", "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, before, audit = [end_node()], "", ""
        for b in batches:
            costs, audits = [], []
            for ends in b.column("ends").to_pylist():
                if ends != before or not audits:
                    path, before = on_path(path, before, ends), ends
                    audit = audit_of(ends[::-1], path)
                costs.append(path[-1][START][0])
                audits.append(audit)
            columns = [b.column("has"), b.column("conv"), pa.array(costs, pa.int64()), pa.array(audits, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["has", "conv", "cost", "audit"])

    return dealt.mapInArrow(run, AUDITED)


REPAIRED = "has int, conv long, place long, role string, text string"


def sorted_with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit (as the text of a row of kind -1), then its rows, in one shuffle."""
    n = parts_for(rows.sparkSession, 0, 1)
    none = lambda t: F.lit(None).cast(t)
    told = audits.select("has", "conv", F.lit(-1).alias("kind"), none("long").alias("turn"), none("string").alias("role"), F.col("audit").alias("text"), none("string").alias("digest"))
    both = rows.where("kind = 1").select("has", "conv", "kind", "turn", "role", "text", "digest").unionByName(told)
    return both.repartition(n, "has", "conv").sortWithinPartitions("has", "conv", "kind", F.col("turn").asc_nulls_first(), "role", "digest").drop("digest")


def edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(has, conv, place, role, text) of the repaired rows, and, with place -1, each conversation's begin,
    from (has, conv, kind, role, text) in the order of ``sorted_with_audits``."""
    key, audit, at, place, state = None, "", 0, 0, START

    def inserts() -> Iterator[tuple]:
        nonlocal at, place, state
        while audit[at : at + 1] == "I":
            state, role = MADE[state]
            yield *key, place, role, ""
            at, place = at + 1, place + 1

    for has, conv, kind, role, text in rows:
        if kind == -1:
            key, audit, at, place, state = (has, conv), text, 0, 0, START
            yield *key, -1, None, None
            yield from inserts()
            continue
        edit = audit[at]
        at += 1
        if edit != "D":
            if edit == "K":
                state = KEPT[role[0]][state]
            else:
                state, role = MADE[state]
            yield *key, place, role, text
            place += 1
        yield from inserts()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for whole in batches:
        for a in range(0, whole.num_rows, BATCH):
            b = whole.slice(a, BATCH)
            yield from zip(*(b.column(x).to_pylist() for x in ("has", "conv", "kind", "role", "text")), strict=True)


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: has, conv, place (from 0), role, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = [x.split()[0] for x in REPAIRED.split(", ")]
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for row in edited(_read(batches)):
            if row[2] >= 0:
                held.append(row)
            if len(held) >= BATCH:
                yield out()
        if held:
            yield out()

    return sorted_with_audits(rows, audits).mapInArrow(run, REPAIRED)


def repaired_digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """has, conv and the SHA-256 of each repaired conversation's ``role:text``, joined by newlines: the same
    stream as ``repaired``, with a running digest in place of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), (pa.int32(), pa.int64(), pa.string()), strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["has", "conv", "repaired_sha256"])

        key, sha = None, None
        for has, conv, place, role, text in edited(_read(batches)):
            if place < 0:
                if key:
                    held.append((*key, sha.hexdigest()))
                if len(held) >= BATCH:
                    yield out()
                key, sha = (has, conv), hashlib.sha256()
            else:
                sha.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        if key:
            held.append((*key, sha.hexdigest()))
        if held:
            yield out()

    return sorted_with_audits(rows, audits).mapInArrow(run, "has int, conv long, repaired_sha256 string")


def named(conversations: DataFrame) -> DataFrame:
    """Only the operator's columns, with a space for a null role or text."""
    space = F.lit(" ")
    c = columns_of(conversations, "conv_id", "turn", "role", "text")
    return c.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, faults and signatures, audits) of ``conversations``; ``repaired(rows, audits)`` gives the
    conversations themselves.  The last two are written, as each is read again."""
    rows = judged_rows(conversations if "gone" in conversations.columns else named(conversations).withColumn("gone", F.lit(False)))
    signed = written(signatures(rows))
    return rows, signed, written(audited(signed))


def damaged(conversations: DataFrame) -> DataFrame:
    """The query's own damage, by crc32(``conv_id:turn``) % 20; dropped rows are marked as gone."""
    c = named(conversations)
    told = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    how: Column = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    text = F.when(how == 1, "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(how == 4, USER).otherwise(F.col("role"))
    times = F.when(how == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return c.select("conv_id", "turn", role.alias("role"), text.alias("text"), (how == 0).alias("gone"), F.explode(times).alias("time")).drop("time")

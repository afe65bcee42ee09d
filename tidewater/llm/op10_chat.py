"""Chat formatting, assembled from tokens.

Each turn is three segments: an opening mark, its text, a closing mark.  Marks are reserved ids beyond
the tokenizer's own; a text is encoded by itself, as ordinary text, so it can't yield a reserved id nor
merge with a mark.  In a text, control strings are escaped as well, so that the decoded string can also
be split at its marks: every backslash is doubled, and one is put behind the first character of each
control string (``</s>`` becomes ``<\\/s>``).  ``unescaped`` undoes that exactly.

``encoded`` works on each row by itself, before any shuffle.  ``assembled`` brings a conversation's
turns into order and splices the ids; the loss mask is the running sum of +1 where an assistant's text
starts and -1 where it ends.  A conversation of more than ``CHUNK_TURNS`` turns or ``CHUNK_IDS`` ids
goes on in a further row (``chunk``), so that none is held whole; ``read_back`` reads the rows as a
stream, with running digests.  (A digest over one conversation's turns is a sequence by its nature; only
that sequence runs in one task.)

Defined cases: a null text or role is empty; a null conv_id is a conversation of its own, in the result
too; turns of equal number go by role, then text, null first; repeated rows are turns of their own;
roles other than user, assistant and system are written out; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, once, parts_for

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the tokenizer's training cut text into pieces (fixed value, goes with its vocabulary).
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Reserved ids, in order from the first one beyond the vocabulary.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>")
MARKS = {"assistant": ("<s>", "</s>"), "user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>")}
FIRST_RESERVED = 50_257
IDS = {s: FIRST_RESERVED + i for i, s in enumerate(CONTROL)}
CHUNK_TURNS = 1024
CHUNK_IDS = 1 << 20
#: The two rows that the query adds.
PROBE = "</s>[INST] ok [/INST]"

_STARTS = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.DOTALL)
_SLASH = re.compile(r"\\(\\?)")


def escaped(text: str) -> str:
    return _STARTS.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return _SLASH.sub(r"\1", text)


def encoder(path: str):
    def make():
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("chat", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    return once(("encoder", path), make)


ENCODED = "has int, conv long, turn long, role string, text string, chars long, ids array<int>, starts int, ends int"


def encoded(conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """A row for each turn: its ids, marks included, and where those of its text start and end."""
    c = columns_of(conversations, "conv_id", "turn", "role", "text")
    c = c.select(
        F.col("conv_id").isNotNull().cast("int").alias("has"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for whole in batches:
            for a in range(0, whole.num_rows, 512):
                b = whole.slice(a, 512)
                ids, starts, ends, chars = [], [], [], []
                for role, text in zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True):
                    role, said = role or "", escaped(text or "")
                    body = enc.encode_ordinary(said)
                    if role in MARKS:
                        opens, closes = MARKS[role]
                        head, length = [IDS[opens]], len(opens) + len(closes)
                    else:
                        named = escaped(role)
                        closes = "<|end|>"
                        head = [IDS["<|role|>"], *enc.encode_ordinary(named), IDS["<|text|>"]]
                        length = len("<|role|><|text|><|end|>") + len(named)
                    ids.append([*head, *body, IDS[closes]])
                    starts.append(len(head))
                    ends.append(len(head) + len(body))
                    chars.append(length + len(said))
                more = [pa.array(chars, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
                yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, "chars", "ids", "starts", "ends"])

    return c.mapInArrow(run, ENCODED)


ASSEMBLED = "has int, conv long, chunk long, n_turns long, chars long, ids array<int>, mask array<boolean>"


def assembled(turns: DataFrame) -> DataFrame:
    """Conversations as ids with a loss mask, in rows of at most about CHUNK_IDS ids, from ``encoded``."""
    n = parts_for(turns.sparkSession, 0, 1)
    dealt = turns.repartition(n, "has", "conv").sortWithinPartitions("has", "conv", "turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunk, rows, size = None, 0, [], 0

        def out() -> pa.RecordBatch:
            lengths = np.array([len(r[0]) for r in rows])
            at = np.cumsum(lengths) - lengths
            delta = np.zeros(lengths.sum() + 1, dtype=np.int64)
            for (_, start, end, role, _), a in zip(rows, at, strict=True):
                if role == "assistant":
                    delta[a + start] += 1
                    delta[a + end] -= 1
            mask = np.cumsum(delta)[:-1] > 0
            ids = np.concatenate([r[0] for r in rows])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]], pa.int32()),
                    pa.array([key[1]], pa.int64()),
                    pa.array([chunk], pa.int64()),
                    pa.array([len(rows)], pa.int64()),
                    pa.array([sum(r[4] for r in rows)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(mask)),
                ],
                names=["has", "conv", "chunk", "n_turns", "chars", "ids", "mask"],
            )

        for b in batches:
            has, conv, role, chars, starts, ends = (b.column(x).to_pylist() for x in ("has", "conv", "role", "chars", "starts", "ends"))
            for i in range(b.num_rows):
                this = (has[i], conv[i])
                if rows and (this != key or len(rows) >= CHUNK_TURNS or size >= CHUNK_IDS):
                    yield out()
                    chunk, rows, size = (chunk + 1 if this == key else 0), [], 0
                key = this
                ids = b.column("ids")[i].values.to_numpy(zero_copy_only=False)
                rows.append((ids, starts[i], ends[i], role[i], chars[i]))
                size += len(ids)
        if rows:
            yield out()

    return dealt.mapInArrow(run, ASSEMBLED)


READ = "has int, conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_ROLE_OF = {IDS[a]: role for role, (a, _) in MARKS.items()}
_CLOSES = {IDS[z] for _, z in MARKS.values()} | {IDS["<|end|>"]}


def turns_in(ids: np.ndarray, mask: np.ndarray, tokenizer: str) -> Iterator[tuple[str, str, str, int]]:
    """(role, text, the part of the text under the mask, formatted length) of each turn, from ids alone."""
    decode = encoder(tokenizer).decode
    marks = np.flatnonzero(ids >= FIRST_RESERVED)
    i = 0
    while i < len(marks):
        start, opens = marks[i], ids[marks[i]]
        if opens == IDS["<|role|>"]:
            between = decode(ids[start + 1 : marks[i + 1]].tolist())
            role, length = unescaped(between), len(between) + len("<|role|><|text|>")
            i += 1
        else:
            role, length = _ROLE_OF[opens], len(CONTROL[opens - FIRST_RESERVED])
        a, z = marks[i] + 1, marks[i + 1]
        if ids[z] not in _CLOSES:
            raise ValueError(f"a turn that opens at {start} isn't closed at {z}")
        said = decode(ids[a:z].tolist())
        under = unescaped(decode(ids[a:z][mask[a:z]].tolist()))
        yield role, unescaped(said), under, length + len(said) + len(CONTROL[ids[z] - FIRST_RESERVED])
        i += 2


def read_back(chunks: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """A row for each conversation, read back from the ids and masks of ``assembled``, whose order it
    keeps to: no shuffle stands between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def fresh() -> list:
            return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            done.clear()
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [x.split()[0] for x in READ.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        def close() -> None:
            done.append((*key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for b in batches:
            has, conv = b.column("has").to_pylist(), b.column("conv").to_pylist()
            for i in range(b.num_rows):
                if (has[i], conv[i]) != key:
                    if state:
                        close()
                    key, state = (has[i], conv[i]), fresh()
                ids = b.column("ids")[i].values.to_numpy(zero_copy_only=False)
                mask = b.column("mask")[i].values.to_numpy(zero_copy_only=False)
                for role, text, under, length in turns_in(ids, mask, tokenizer):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    state[2] += len(under)
                    state[3].update(under.encode("utf-8", "surrogatepass"))
                    state[4] += length
            if len(done) >= 1000:
                yield flush()
        if state:
            close()
        if done:
            yield flush()

    return chunks.mapInArrow(run, READ)


def formatted(conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    return assembled(encoded(conversations, tokenizer))

"""Token counts of whole texts, huge ones in overlapping chunks that are spliced where both agree.

A text of at most ``long_chars`` characters is counted where it stands.  A longer one is cut into chunks of
``chunk`` characters that overlap by ``overlap``; each chunk is a row, encoded by itself wherever Spark
deals it, and tells where pre-tokenizer pieces start inside its two overlaps, with the number of its
tokens before each.  At each border the first piece start that both chunks have in common is the
splice: the left chunk counts the tokens before it, the right one those after it.  A border without one
(an overlap inside one endless piece) is widened: its text goes through another round with overlaps and
chunks eight times as long, until it fits one chunk.

Why a common piece start p is safe.  Reserved strings are found first, wherever they stand; what lies
between is cut into pieces from left to right by a pattern that looks ahead by one character and never
back, and each piece is merged by itself.  So (1) from a true piece start on, the pieces depend only on
the text behind it; (2) in a chunk that is right from some place on, a piece start is true if it ends
at least the longest reserved string before the chunk's end, as no reserved string or look-ahead that the
chunk can't see can then change what stands before.  By (2) p is true in the left chunk, whose own
beginning was spliced before; by (1) the right chunk is right from p on.  Starts inside a piece prove
nothing and aren't used.  ``loaded`` refuses tokenizers for which this doesn't hold: normalizers, other
pre-tokenizers, reserved strings that take blanks with them or overlap each other.

The same rule spares work on the others: before a blank (0x20) behind anything that isn't white space
a piece starts in any context, so a text is cut there, and the count of a word with its blank is
remembered, up to ``WORDS`` of them a process.

Defined cases: a null text is empty and has no tokens; a null doc_id stays null; repeated rows each have
their count; equal long texts share their chunks' counts; an empty table gives an empty result; further
columns are ignored.  Memory: a row's text, one batch of chunks, and the boundaries in the overlaps.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, once, parts_for, written

TOKENIZER = "byte_bpe_50k.json"
LONG_CHARS = 1 << 15
CHUNK = 1 << 14
OVERLAP = 1 << 8
WIDER = 8
LIMIT = 512
#: Characters that one call of the tokenizer takes.
BATCH_CHARS = 1 << 19
#: Remembered words of at most so many characters.
WORDS = 1 << 20
WORD_CHARS = 64
SAFE = re.compile(r"(?<=\S) ")


def vocabulary(name: str = TOKENIZER) -> str:
    """Where the installed package of public tokenizers keeps ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def loaded(name: str):
    """The tokenizer and the length of its longest reserved string, once for each process."""

    def make():
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        path = name if os.path.sep in name else vocabulary(name)
        tokenizer = Tokenizer.from_file(path)
        told = json.loads(tokenizer.to_str())
        cut = told["pre_tokenizer"] or {}
        if told["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError(f"{name}: splicing is proven for byte-level pieces of unchanged text only")
        reserved = [t for t in told["added_tokens"]]
        if any(" " in t["content"] for t in reserved):
            raise ValueError(f"{name}: a reserved string has a blank")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in reserved):
            raise ValueError(f"{name}: a reserved string depends on what stands beside it")
        strings = [t["content"] for t in reserved]
        if any(a[k:].startswith(b[: len(a) - k]) for a in strings for b in strings for k in range(1, len(a))) or any(a != b and a in b for a in strings for b in strings):
            raise ValueError(f"{name}: reserved strings overlap")
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer, max(map(len, strings), default=0)

    return once(("tokenizer", name), make)


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in lists of a bounded number of characters."""
    some, held = [], 0
    for text in texts:
        if some and held + len(text) > BATCH_CHARS:
            yield some
            some, held = [], 0
        some.append(text)
        held += len(text)
    if some:
        yield some


def _encoded(texts: list[str], name: str) -> Iterator:
    for some in _groups(texts):
        yield from loaded(name)[0].encode_batch(some, add_special_tokens=False)


def token_counts(texts: list[str], name: str) -> Iterator[int]:
    """The number of tokens of each text, by its words."""
    remembered: dict[str, int] = once(("words", name), dict)
    for some in _groups(texts):
        cut = [SAFE.split(t) for t in some]
        new = list({w for words in cut for w in words[1:]} - remembered.keys())
        counts = dict(zip(new, (len(e) for e in _encoded([" " + w for w in new], name)), strict=True))
        remembered.update(counts)
        for words, first in zip(cut, _encoded([words[0] for words in cut], name), strict=True):
            yield len(first) + sum(map(remembered.__getitem__, words[1:]))
        if len(remembered) > WORDS:
            remembered.clear()
        for w in new:
            if len(w) > WORD_CHARS:
                remembered.pop(w, None)


def piece_starts(encoding) -> Iterator[tuple[int, int]]:
    """(first character, tokens before) of each pre-tokenizer piece."""
    before = None
    for i, (piece, (at, _)) in enumerate(zip(encoding.word_ids, encoding.offsets, strict=True)):
        if piece != before:
            yield at, i
            before = piece


COUNTED = "doc_id {id}, n_bytes long, key string, n_tokens long"
BORDERS = "key string, border long, is_left boolean, starts array<long>, before array<long>, n_tokens long"


def _counted(docs: DataFrame, name: str, long_chars: int) -> DataFrame:
    """Counts of the texts of at most ``long_chars`` characters; the others have a key instead."""
    known = docs.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.when(F.length("text") > long_chars, F.md5("text")).alias("key"),
        F.when(F.length("text") <= long_chars, F.col("text")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            counts = pa.array(list(token_counts(texts, name)), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), b.column("key"), counts], names=["doc_id", "n_bytes", "key", "n_tokens"])

    return known.mapInArrow(run, COUNTED.format(id=docs.schema["doc_id"].dataType.simpleString()))


def chunked(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """A row for each chunk of a text: key, border (the chunk's number), is_last, chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, text in zip(b.column("key"), b.column("text"), strict=True):
                text, starts = text.as_py(), []
                starts = range(0, max(1, len(text) - overlap), chunk - overlap)
                for a in range(0, len(starts), 64):
                    some = starts[a : a + 64]
                    columns = [
                        pa.array([key.as_py()] * len(some), pa.string()),
                        pa.array(range(a, a + len(some)), pa.int64()),
                        pa.array([s == starts[-1] for s in some]),
                        pa.array([text[s : s + chunk] for s in some], pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "border", "is_last", "chunk"])

    return docs.select("key", "text").mapInArrow(run, "key string, border long, is_last boolean, chunk string")


def borders(chunks: DataFrame, name: str, chunk: int, overlap: int) -> DataFrame:
    """For each chunk and each of its borders, the piece starts in the overlap, counted from the overlap's
    first character, and the tokens before; ``n_tokens`` where the text ends in this chunk.  Border k
    lies between chunks k and k + 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, reserved = loaded(name)
        for b in batches:
            rows = []
            keys, numbers, last, texts = (b.column(x).to_pylist() for x in ("key", "border", "is_last", "chunk"))
            for key, k, is_last, text, encoding in zip(keys, numbers, last, texts, _encoded(texts, name), strict=True):
                heads, tails = ([], []), ([], [])
                tail = chunk - overlap
                for at, before in piece_starts(encoding):
                    if k and at < overlap:
                        heads[0].append(at)
                        heads[1].append(before)
                    if not is_last and tail <= at <= len(text) - max(1, reserved):
                        tails[0].append(at - tail)
                        tails[1].append(before)
                if k:
                    rows.append((key, k - 1, False, *heads, None))
                rows.append((key, k, True, *tails, len(encoding) if is_last else None))
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
            names = ["key", "border", "is_left", "starts", "before", "n_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    return chunks.mapInArrow(run, BORDERS)


def spliced(found: DataFrame) -> DataFrame:
    """key, n_tokens (null where a border has no common piece start), from ``borders``.  Equal texts sent
    equal rows, of which ``max`` takes one."""
    side = lambda left: F.max(F.when(F.col("is_left") == left, F.struct("starts", "before")))
    per = found.groupBy("key", "border").agg(side(True).alias("l"), side(False).alias("r"), F.max("n_tokens").alias("ends"))
    meets = F.array_min(F.array_intersect("l.starts", "r.starts"))
    place = lambda c: F.get(f"{c}.before", (F.array_position(f"{c}.starts", meets) - 1).cast("int"))
    part = per.select("key", F.coalesce("ends", place("l") - place("r")).alias("part"))
    return part.groupBy("key").agg(F.when(F.count("part") == F.count(F.lit(1)), F.sum("part")).alias("n_tokens"))


def counted(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, long_chars: int = LONG_CHARS, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text."""
    if chunk <= 2 * overlap:
        raise ValueError("a chunk must be longer than its two overlaps")
    docs = columns_of(docs, "doc_id", "text")
    spark = docs.sparkSession
    first = written(_counted(docs, tokenizer, long_chars))
    out = first.where("key is null").select("doc_id", "n_bytes", "n_tokens")
    # A round for each width that some text needs; most inputs have one, those without long texts none.
    longest = first.where("key is not null").agg(F.max("n_bytes")).first()[0]
    counts = None
    while longest is not None:
        # One text of each group of copies: each map task sends it once at most.
        texts = docs.where(F.length("text") > long_chars).groupBy(F.md5("text").alias("key")).agg(F.first("text").alias("text"))
        if counts is not None:
            texts = texts.join(waiting, "key", "left_semi")
        cut = chunked(texts, chunk, overlap).repartition(parts_for(spark, 0, 1), "key", "border")
        now = written(spliced(borders(cut, tokenizer, chunk, overlap)))
        counts = now if counts is None else counts.where("n_tokens is not null").unionByName(now)
        waiting = now.where("n_tokens is null")
        if chunk >= longest or waiting.isEmpty():
            break
        chunk, overlap = chunk * WIDER, overlap * WIDER
    if counts is not None:
        long = first.where("key is not null").select("doc_id", "n_bytes", "key")
        out = out.unionByName(long.join(counts, "key").select("doc_id", "n_bytes", "n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)

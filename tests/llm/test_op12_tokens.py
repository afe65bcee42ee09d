"""Token counts against the library's own, over whole texts."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater.llm import op12_tokens
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(op12_tokens.vocabulary())
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


def rows_of(df):
    return sorted(((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect()), key=str)


def wanted(rows, whole, limit=op12_tokens.LIMIT):
    out = [(i is None, i, len((t or "").encode()), whole(t)) for i, t in rows]
    return sorted(((*r, r[3] > limit) for r in out), key=str)


def hostile():
    """Texts whose borders are hard: endless pieces, blanks, reserved strings at every offset, marks."""
    draw = random.Random(5)
    end = "<|endoftext|>"
    yield from (None, "", " ", end, end * 300, "a" * 5000, " " * 5000, "\n" * 3000 + "x" + " " * 3000, "'" * 4000, "'ll" * 2000, "1" * 3000)
    yield from ("é漢字́🙂" * 700, "x" * 2999 + end + "y" * 3000, "<|" * 2500, "|>" * 2500 + end, " a" * 2500, "\t   " * 1500)
    for k in range(60, 80):
        yield "ab " * 40 + "z" * k + end + " tail of the text" * 60
    parts = [end, end[:7], end[3:], " ", "  ", "\n", "word", " word", "don't", "'re", "12", "é", "漢", "🙂", "...", "<|", "A" * 90]
    for _ in range(80):
        yield "".join(draw.choices(parts, k=draw.randint(1, 400)))


@pytest.mark.parametrize("chunk, overlap", [(64, 24), (200, 60)])
def test_small_chunks_of_hostile_texts(spark, whole, chunk, overlap):
    rows = list(enumerate(hostile())) + [(None, "null id " * 300), (7, "twice " * 400), (7, "twice " * 400)]
    docs = spark.createDataFrame([(i, t, 3, "k") for i, t in rows], "doc_id long, text string, n_tokens int, key string")
    got = op12_tokens.counted(docs, long_chars=chunk, chunk=chunk, overlap=overlap)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "bigint", "boolean"]
    assert rows_of(got) == wanted(rows, whole)


def test_a_border_without_a_common_piece_is_widened(spark, whole):
    text = "one two " + "q" * 1000 + " three four"
    docs = spark.createDataFrame([("k", text)], "key string, text string")
    cut = op12_tokens.chunked(docs, 200, 40)
    found = op12_tokens.spliced(op12_tokens.borders(cut, op12_tokens.TOKENIZER, 200, 40)).collect()
    assert [(r.key, r.n_tokens) for r in found] == [("k", None)]
    docs = spark.createDataFrame([(1, text), (2, "plain words " * 100)], "doc_id int, text string")
    got = {r.doc_id: r.n_tokens for r in op12_tokens.counted(docs, long_chars=100, chunk=200, overlap=40).collect()}
    assert got == {1: whole(text), 2: whole("plain words " * 100)}


def test_chunks_are_spread_and_overlap(spark):
    docs = spark.createDataFrame([("k", "".join(chr(97 + i % 26) for i in range(1000)))], "key string, text string")
    rows = sorted(op12_tokens.chunked(docs, 300, 50).collect(), key=lambda r: r.border)
    assert [r.border for r in rows] == [0, 1, 2, 3] and [r.is_last for r in rows] == [False] * 3 + [True]
    assert all(a.chunk[-50:] == b.chunk[:50] for a, b in zip(rows, rows[1:], strict=False))


def test_the_query_counts_every_document(spark, whole):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op12_token_counts"](spark, SF)) == wanted(rows, whole)


def test_a_huge_text(spark, whole):
    draw = random.Random(3)
    text = " ".join("".join(draw.choices("abcdeéü", k=draw.randint(1, 9))) for _ in range(400_000))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "short")], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_tokens for r in op12_tokens.counted(docs).collect()}
    assert got == {1: whole(text), 2: whole(text), 3: 1}


def test_empty_and_unfit(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert op12_tokens.counted(none).collect() == []
    with pytest.raises(ValueError, match="byte-level"):
        op12_tokens.loaded("word_bpe_49k.json")


def test_more_columns_and_other_ids(spark, whole):
    docs = spark.createDataFrame([("a", "some words", 1, 2)], "doc_id string, text string, n_bytes int, border int")
    assert [tuple(r) for r in op12_tokens.counted(docs, limit=1).collect()] == [("a", 10, whole("some words"), True)]
    assert op12_tokens.counted(docs.withColumn("text", F.lit(None).cast("string"))).first().n_tokens == 0

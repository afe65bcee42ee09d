"""Hashing of whole texts in bounded memory, the same in any pieces."""

import random
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import op4_jaccard, op5_toxicity, words


def texts(n=400):
    draw = random.Random(8)
    some = ["".join(draw.choices("abC dé\n漢1-", k=draw.randint(0, 300))) for _ in range(n)]
    return [*some, None, "", "x" * 3000 + " y", "Q" * 64 + " z" * 700, " ", "a"]


@pytest.mark.parametrize("step", [64, 1000])
@pytest.mark.parametrize("kind", ["PLAIN", "ALNUM"])
def test_pieces_of_any_size_give_the_same_hashes(monkeypatch, step, kind):
    def told():
        w = words.Words(pa.array(texts()), getattr(words, kind))
        long = (w.ends - w.starts) >= 3
        return w.hashes(), w.beginnings(long, 3), words.runs(w.hashes(), 4), w.starts, w.ends, w.first

    want = told()
    for module in (words, op4_jaccard):
        monkeypatch.setattr(module, "STEP", step)
    monkeypatch.delitem(sys.modules, "_tidewater_llm_once", raising=False)
    assert all((a == b).all() for a, b in zip(told(), want, strict=True))
    monkeypatch.delitem(sys.modules, "_tidewater_llm_once", raising=False)


def test_words_are_those_of_a_plain_split():
    some = texts()
    w = words.Words(pa.array(some), words.PLAIN)
    said = [w.data[a:z].tobytes() for a, z in zip(w.starts, w.ends, strict=True)]
    assert said == [x for t in some for x in (t or "").encode().split()]
    assert w.counts().tolist() == [len((t or "").encode().split()) for t in some]


def test_a_text_of_64_mb_in_half_a_gigabyte():
    many = np.array([f"w{k}" for k in range(99_999)])
    text = pa.array([" ".join(many[np.random.default_rng(1).integers(0, 99_999, 10_000_000)].tolist())], pa.large_string())
    assert text.nbytes > 64e6
    words.Words(pa.array(["a"]), words.PLAIN).hashes()

    def keys():
        return op4_jaccard.keys_of(*op4_jaccard.sets_of(text, 3), 90)

    def shingles():
        w = words.Words(text, words.ALNUM)
        return words.runs(w.hashes(), 5)

    for work in (keys, shingles, lambda: op5_toxicity.parts_of(words.Words(text, words.ALNUM))):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 500e6, (work, peak)

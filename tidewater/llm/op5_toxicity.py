"""Toxicity by weak supervision.

1. Lexica: from a bounded sample of labelled rows (``LABELLED``; never those whose crc32(doc_id) mod 5 is
   0), the words and word beginnings (``PATTERNS`` bytes) that stand in toxic texts far more often than
   their share, by z-score, and seldom elsewhere (``LEAST_TRUE``).
2. Voters: ``LEXICON_VOTERS`` lexicon voters share the words, and each length of beginnings is a pattern
   voter.  A voter says toxic where it finds one of its entries, clean where a text of ``ENOUGH`` words
   has none, else nothing.  All documents are voted on; what counts is how many show each pattern of
   votes, of which there can be at most 3 ** voters.
3. Label model: a latent-class model of the votes, fitted by EM on the counts of all documents, gives the
   voters' accuracies.  Correlations of voters within the classes, from the same counts, tell how much
   of a voter's say is an echo of others; each voter's log-likelihood is divided by that sum, and the
   model is fitted again.
4. Classifier: logistic regression on which entries a text holds, trained on the posterior labels of a
   bounded sample of documents (``FITTED``), gives every document its score.

Labels, lang, source and doc_id are no inputs of a score.  Documents are read as a stream three times and
never shuffled; the sample of labels is bounded, and so may be broadcast.

Defined cases: null text is empty; an empty text gets the classifier's base rate; a null doc_id counts
as an empty text for crc32, so it is held out; repeated rows get equal scores; without labels or without
telling words every score is the toxic share of the labelled rows (0 if there are none); an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_of, written
from .words import ALNUM, Words, steps

#: Labelled rows and documents that are fitted on, at most (about, for the latter).
LABELLED = 16_384
FITTED = 16_384
#: Bytes of word beginnings; entries kept of each kind; what makes an entry telling.
PATTERNS = (4, 5, 6, 7, 8)
ENTRIES = 96
LEAST_TOXIC = 3
LEAST_Z = 5.0
LEAST_TRUE = 0.75
LEXICON_VOTERS = 6
ENOUGH = 30
VOTERS = LEXICON_VOTERS + len(PATTERNS)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def parts_of(w: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, hashes, text of each) of a batch, one kind at a time: 0 for words, n for beginnings of n bytes."""
    of = w.doc_of_word()
    yield 0, w.hashes(), of
    for k in PATTERNS:
        some = w.ends - w.starts > k  # a whole word of k bytes is a word, not a beginning
        yield k, w.beginnings(some, k), of[some]


def labelled_sample(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """(doc_id, toxic) of at most ``most`` labelled rows outside the held-out fifth."""
    l = columns_of(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    return l.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(most)


def mined(docs: DataFrame, sample: DataFrame) -> tuple[list[tuple[int, int, float]], float]:
    """((kind, hash, z) of the telling entries, share of toxic rows)."""
    rows = docs.join(F.broadcast(sample), "doc_id").select("text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, "text"):
                w = Words(b.column("text"), ALNUM)
                toxic = b.column("toxic").to_numpy(zero_copy_only=False) > 0
                yield counted([-1], [0], [toxic.sum()], [len(toxic) - toxic.sum()])
                for kind, h, of in parts_of(w):
                    order = np.lexsort((of, h))
                    h, of = h[order], of[order]
                    new = np.ones(len(h), dtype=bool)
                    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
                    h, bad = h[new], toxic[of[new]]
                    keys, at = np.unique(h, return_inverse=True)
                    t, n = np.bincount(at, weights=bad, minlength=len(keys)), np.bincount(at, minlength=len(keys))
                    yield counted(np.full(len(keys), kind), keys.view(np.int64), t, n - t)

    def counted(kind, h, t, c) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(h, pa.int64()), pa.array(np.asarray(t, dtype=np.int64)), pa.array(np.asarray(c, dtype=np.int64))], names=["kind", "hash", "toxic", "clean"])

    seen = written(rows.mapInArrow(run, "kind int, hash long, toxic long, clean long").groupBy("kind", "hash").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(f"kind = -1 or toxic >= {LEAST_TOXIC}"))
    total = seen.where("kind = -1").first()
    if not total or not total.toxic + total.clean:
        return [], 0.0
    share = total.toxic / (total.toxic + total.clean)
    n = F.col("toxic") + F.col("clean")
    z = (F.col("toxic") - n * share) / F.sqrt(n * share * (1 - share) + 1e-9)
    found = []
    for kind in (0, *PATTERNS):
        top = seen.where(F.col("kind") == kind).select("hash", "toxic", "clean", z.alias("z")).where((F.col("z") >= LEAST_Z) & (F.col("toxic") >= LEAST_TRUE * (n + 1)))
        found += [(kind, r["hash"], r.z) for r in top.orderBy(F.col("z").desc(), "hash").limit(ENTRIES).collect()]
    return found, share


@dataclass
class Lexica:
    """The entries by kind, sorted: hashes, their numbers as features, their voters."""

    entries: list[tuple[int, int, float]]
    kinds: dict = field(default_factory=dict)

    def __post_init__(self):
        rank = 0
        for kind in (0, *PATTERNS):
            of = [(np.uint64(h & (2**64 - 1)), i) for i, (k, h, _) in enumerate(self.entries) if k == kind]
            voter = {i: (n % LEXICON_VOTERS if kind == 0 else LEXICON_VOTERS + PATTERNS.index(kind)) for n, (_, i) in enumerate(of)}
            rank += len(of)
            of.sort()
            self.kinds[kind] = (np.array([h for h, _ in of], dtype=np.uint64), np.array([i for _, i in of], dtype=np.int64), np.array([voter[i] for _, i in of], dtype=np.int64))

    def held(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature, voter) of the entries that a batch's texts hold, each once a text."""
        texts, features, voters = [], [], []
        for kind, h, of in parts_of(w):
            keys, number, voter = self.kinds[kind]
            if not len(keys):
                continue
            table = np.zeros(1 << 16, dtype=bool)
            table[keys >> np.uint64(48)] = True
            p = np.flatnonzero(table[h >> np.uint64(48)])
            at = np.minimum(np.searchsorted(keys, h[p]), len(keys) - 1)
            ok = keys[at] == h[p]
            texts.append(of[p[ok]])
            features.append(number[at[ok]])
            voters.append(voter[at[ok]])
        if not texts:
            return (np.empty(0, dtype=np.int64),) * 3
        t, f, v = (np.concatenate(x) for x in (texts, features, voters))
        _, one = np.unique(t.astype(np.int64) * max(1, len(self.entries)) + f, return_index=True)
        return t[one], f[one], v[one]


def votes_of(n: int, words: np.ndarray, texts: np.ndarray, voters: np.ndarray) -> np.ndarray:
    """Patterns of votes as numbers to base 3: 0 nothing, 1 toxic, 2 clean."""
    votes = np.where(words >= ENOUGH, 2, 0)[:, None].repeat(VOTERS, axis=1)
    votes[texts, voters] = 1
    return votes @ (3 ** np.arange(VOTERS))


def label_model(patterns: np.ndarray, counts: np.ndarray, share: float, rounds: int = 60) -> np.ndarray:
    """The posterior of being toxic for each pattern of votes."""
    votes = (patterns[:, None] // 3 ** np.arange(VOTERS)) % 3
    one = np.stack([votes == v for v in range(3)], axis=2).astype(float)  # pattern, voter, vote
    weight = np.ones(VOTERS)
    post = np.clip((votes == 1).mean(axis=1) * 2, 0.02, 0.98)
    for again in range(3):
        for _ in range(rounds):
            prior = np.clip((counts * post).sum() / max(counts.sum(), 1), 1e-4, 0.5)
            said = [np.einsum("p,pvx->vx", counts * p, one) + 0.5 for p in (1 - post, post)]
            said = [s / s.sum(axis=1, keepdims=True) for s in said]
            tell = (np.log(said[1]) - np.log(said[0])) * weight[:, None]
            logit = np.log(prior / (1 - prior)) + np.einsum("pvx,vx->p", one, tell)
            post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        # correlations of toxic votes within the classes
        echo = np.zeros((VOTERS, VOTERS))
        for p in (1 - post, post):
            c = counts * p
            x = (votes == 1) - ((votes == 1) * c[:, None]).sum(axis=0) / max(c.sum(), 1e-9)
            cov = (x * c[:, None]).T @ x / max(c.sum(), 1e-9)
            sd = np.sqrt(np.clip(np.diag(cov), 1e-12, None))
            echo += np.clip(cov / sd[:, None] / sd[None, :], 0, 1) * c.sum() / max(counts.sum(), 1)
        np.fill_diagonal(echo, 0)
        weight = 1 / (1 + echo.sum(axis=1))
    return post


def linear(rows: list[np.ndarray], soft: np.ndarray, width: int, base: float, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic regression on soft labels, the intercept last."""
    x = np.zeros((len(rows), width + 1), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, r] = 1
    x[:, -1] = 1
    w = np.zeros(width + 1)
    w[-1] = np.log(max(base, 1e-4) / max(1 - base, 1e-4))
    speed, pull = np.zeros_like(w), np.full(width + 1, 1e-4)
    pull[-1] = 0
    step = 8.0 / max(1.0, float((x.sum(axis=1)).mean()))
    for _ in range(rounds if len(rows) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        speed = 0.9 * speed - step * ((x.T @ (p - soft)) / len(rows) + pull * w)
        w = w + 0.3 * speed
    return w


@dataclass
class Model:
    lexica: Lexica
    weights: np.ndarray

    def scores(self, w: Words) -> np.ndarray:
        texts, features, _ = self.lexica.held(w)
        total = np.bincount(texts, weights=self.weights[features], minlength=w.n) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """The classifier for ``docs`` (doc_id, text) by ``labels`` (doc_id, toxic)."""
    d = columns_of(docs, "doc_id", "text")
    entries, share = mined(d, labelled_sample(labels))
    lexica = Lexica(entries)
    if not entries:
        return Model(lexica, np.array([np.log(max(share, 1e-12) / max(1 - share, 1e-12))]))
    part = FITTED / max(d.count(), 1)
    chosen = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) < int(part * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, "text"):
                w = Words(b.column("text"), ALNUM)
                texts, features, voters = lexica.held(w)
                patterns = votes_of(w.n, w.counts(), texts, voters)
                keys, n = np.unique(patterns, return_counts=True)
                fit = np.flatnonzero(b.column("chosen").to_numpy(zero_copy_only=False))
                order = np.argsort(texts, kind="stable")
                texts, features = texts[order], features[order]
                own = [features[np.searchsorted(texts, i) : np.searchsorted(texts, i, side="right")].astype(np.int32) for i in fit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([keys, patterns[fit]]), pa.int64()), pa.array(np.concatenate([n, np.zeros(len(fit), dtype=np.int64)]), pa.int64()), pa.array([None] * len(keys) + own, pa.list_(pa.int32()))],
                    names=["pattern", "n", "features"],
                )

    voted = written(d.select("text", F.coalesce(chosen & ~held_out(F.col("doc_id")), F.lit(False)).alias("chosen")).mapInArrow(run, "pattern long, n long, features array<int>"))
    counts = voted.where("features is null").groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()
    patterns, n = counts["pattern"].to_numpy(dtype=np.int64), counts["n"].to_numpy(dtype=float)
    order = np.argsort(patterns)
    patterns, n = patterns[order], n[order]
    post = label_model(patterns, n, share)
    # Copies vote alike and count once here: however often a row is repeated, what is collected is bounded
    # by the texts that differ.
    rows = sorted(voted.where("features is not null").select("pattern", "features").distinct().collect())
    soft = post[np.searchsorted(patterns, [r.pattern for r in rows])] if rows else np.empty(0)
    return Model(lexica, linear([np.array(r.features, dtype=int) for r in rows], soft, len(entries), float((post * n).sum() / max(n.sum(), 1))))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row."""
    d = columns_of(docs, "doc_id", "text").select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, "text"):
                score = model.scores(Words(b.column("text"), ALNUM))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def kept(docs: DataFrame, model: Model, most: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all their columns, that score below ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, "text"):
                yield b.filter(pa.array(model.scores(Words(b.column("text"), ALNUM)) < most))

    return docs.mapInArrow(run, docs.schema)

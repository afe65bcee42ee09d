"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Each source is a queue, served at a rate of its weight.  A document's virtual finish time is its
source's cumulative size up to and with it, in a shuffled order, divided by the weight; a second
pass over the source follows the first, and so on up to ``limit`` passes.  Copies of documents are
taken in the order of their finish times until the budget is spent.  Where the queues of all sources
hold, that moment is the same for all of them, so a source gets its weight's share; a source whose
passes are used up gets no more, and what it leaves goes to the others by weight.

The running sum inside a source is a prefix sum in two levels: over ranges of the shuffle key (their
number follows the source's rows), then inside a range.  No task holds a whole source.

The moment comes from the sources' sizes alone (``waterline``), so nothing is sorted globally to find
it.  What the sources leave of the budget because documents are whole goes, in the order of finish
times, to the documents that are under way then.  ``ordered`` range-sorts the taken copies by their
finish times: the stream to train on.

Defined cases: null text has size 0, and a document of size 0 is taken without use of the budget; a
null source is a source, the last one; rows alike in doc_id, source and text stand one behind the other,
each with its own finish time (they are counted as one group until then, so that neither a repeated row
nor a null doc_id makes a hot key, and which of them is taken makes no difference); an empty table gives
an empty result; further columns are ignored.  The table of sources passes through one
task: it holds a row for each source, not for each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import columns_of, parts_for, written

#: Words: runs of anything but blanks.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
#: Rows of a source that one range of its shuffle key holds, about.
RANGE_ROWS = 4096


def place_in_shuffle(doc_id: Column, text: Column) -> Column:
    """0 to 2**32 - 1, by the row's id and text."""
    said = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(said), 1, 8), 16, 10).cast("long")


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, at, rows): ``at`` is the place in the shuffle, ``rows`` how many are alike."""
    d = columns_of(docs, "doc_id", "source", "text")
    d = d.select("doc_id", "source", size_of(F.col("text")).alias("size"), place_in_shuffle(F.col("doc_id"), F.col("text")).alias("at"))
    return d.groupBy("doc_id", "source", "size", "at").agg(F.count("*").alias("rows"))


def waterline(sources: DataFrame, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """``sources`` (source, source_size, weight) with target and line, the common finish time.

    A source of weight w gets min(limit * size, w * line); the line is where these sum to
    share * all sizes.  With the sources in the order of limit * size / weight, it is the first
    value at which the next source isn't used up.
    """
    by_need = W.orderBy((F.col("cap") / F.col("weight")), F.col("rank"))
    before = by_need.rowsBetween(W.unboundedPreceding, -1)
    onward = by_need.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    tried = (
        sources.withColumn("cap", F.col("source_size").cast("double") * limit)
        .withColumn("budget", F.sum(F.col("source_size").cast("double")).over(everything) * share)
        .withColumn("tried", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    )
    place = F.row_number().over(by_need)
    first = F.min(F.when(F.col("tried") <= F.col("cap") / F.col("weight"), F.struct("place", "tried"))).over(everything)
    return (
        tried.withColumn("place", place)
        .withColumn("line", first["tried"])
        .withColumn("target", F.coalesce(F.least(F.col("cap"), F.col("weight") * F.col("line")), F.col("cap")))
        .drop("tried", "place")
    )


def weighted(per_source: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Sources by code point, null last, weigh ``weights``, repeating."""
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    return per_source.withColumn("rank", rank).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1)
    )


def queued(base: DataFrame, share: float = SHARE, limit: int = LIMIT, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The rows of ``base`` (see ``sized``; written, as it is read twice) with their finish times, one for
    each pass (``finishes``), their place among those alike, and their source's figures."""
    words = F.col("size") * F.col("rows")
    per = base.groupBy("source").agg(F.sum(words).alias("source_size"), F.count("*").alias("n"))
    figures = waterline(weighted(per, weights), share, limit).withColumn("ranges", F.ceil(F.col("n") / RANGE_ROWS))
    b, s = base.alias("b"), figures.alias("s")
    d = b.join(s, F.col("b.source").eqNullSafe(F.col("s.source"))).select(
        "b.*", *[F.col(f"s.{c}") for c in ("source_size", "rank", "weight", "target", "line", "budget", "ranges")]
    )
    d = d.withColumn("range", F.floor(F.col("at") * F.col("ranges") / F.lit(2.0**32)))
    ranges = d.groupBy("rank", "range").agg(F.sum(words).alias("range_size"))
    upto = W.partitionBy("rank").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("rank", "range", F.coalesce(F.sum("range_size").over(upto), F.lit(0)).alias("before"))
    inside = W.partitionBy("rank", "range").orderBy("at", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0))).join(ranges, ["rank", "range"])
    d = d.withColumn("place", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    upto = F.col("before") + F.col("inside") + F.col("size") * F.col("place")
    end = [(upto + F.col("source_size") * k) / F.col("weight") for k in range(limit)]
    return d.withColumn("finishes", F.array(*end)).drop("inside", "before", "range", "ranges", "rows")


def mixed(docs: DataFrame, share: float = SHARE, limit: int = LIMIT, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """A row for each document: doc_id, source, size, source_size, target, taken, finishes, cut.

    ``taken``: the words the mix takes of it, repeats counted; its passes up to ``cut`` are in the mix.
    """
    q = written(queued(written(sized(docs)), share, limit, weights))
    copies = q.select("rank", "size", "weight", "line", "budget", F.explode("finishes").alias("finish"))
    served = copies.groupBy("rank").agg(
        F.first("line").alias("line"),
        F.first("budget").alias("budget"),
        F.coalesce(F.sum(F.when(F.col("finish") <= F.col("line"), F.col("size"))), F.lit(0)).alias("served"),
        # the document under way when the line is reached
        F.min(F.when(F.col("finish") > F.col("line"), F.struct("finish", "size"))).alias("next"),
    )
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    queue = W.orderBy(F.col("next.finish").asc_nulls_last(), "rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    left = F.col("budget") - F.sum("served").over(everything)
    cuts = served.select(
        "rank",
        F.when(F.col("next").isNotNull() & (F.sum("next.size").over(queue) <= left), F.col("next.finish"))
        .otherwise(F.col("line"))
        .alias("cut"),
    )
    passes = F.size(F.filter("finishes", lambda f: f <= F.col("cut")))
    # no line: the budget covers all passes of all sources
    return q.join(cuts, "rank").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.when(F.col("cut").isNull(), F.lit(limit)).otherwise(passes)).alias("taken"),
        "finishes",
        "cut",
        "at",
        "place",
    )


def ordered(docs: DataFrame, share: float = SHARE, limit: int = LIMIT, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: the rows of ``docs``, as often as they are taken, with ``mix_pass`` (from 0) and
    ``mix_finish``, range-sorted by finish time."""
    decided = mixed(docs, share, limit, weights)
    copies = decided.select("doc_id", "source", "size", "at", "place", "cut", F.posexplode("finishes").alias("mix_pass", "mix_finish"))
    copies = copies.where(F.col("cut").isNull() | (F.col("mix_finish") <= F.col("cut"))).drop("cut")
    d = docs.drop("mix_pass", "mix_finish")
    row = F.struct(*[d[c] for c in d.columns]).alias("row")  # so no name of the table's can clash
    d = d.select(row, size_of(d["text"]).alias("n"), place_in_shuffle(d["doc_id"], d["text"]).alias("here"))
    alike = W.partitionBy("here", "n", "row.doc_id", "row.source").orderBy(F.xxhash64("row"))
    d = d.withColumn("number", F.row_number().over(alike))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & F.col("row.source").eqNullSafe(F.col("source"))
    on = (F.col("here") == F.col("at")) & (F.col("n") == F.col("size")) & (F.col("number") == F.col("place")) & same
    out = d.join(copies, on).select("row.*", "mix_pass", "mix_finish")
    n = parts_for(docs.sparkSession, 0, 1)
    return out.repartitionByRange(n, "mix_finish").sortWithinPartitions("mix_finish")

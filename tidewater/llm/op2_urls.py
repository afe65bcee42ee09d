"""URL filters by a sort-merge range join of addresses and rules.

A host is written backwards, each label ended by a dot (``www.example.com`` is
``com.example.www.``), so a host and all its subdomains are the keys that begin with its own:
an interval.  Addresses and rules are dealt by ranges of that key and sorted; one sweep over a range
keeps the stack of rules whose intervals hold the present key, the shortest host at the bottom.  Each
address asks the stack from the top for rules whose path its own path begins with.

The range borders come from a bounded sample of keys (``SAMPLE`` for each range), which decides only
where ranges end.  The key goes on with the path and a hash of the row, so that a host with a third of
all rows, or one address repeated, is cut into several ranges; a rule is copied to each range its
interval meets.  A sweep reads its range as a stream and holds the stack alone.

Defined cases: a null address, or one without ``://``, has an empty host and path, fits no rule and
gets the default; of several fitting rules the longest (host and path) wins, then the one of the
longer host; of two equal rules with different verdicts, block wins; a rule of an empty host fits every host; repeated rows are judged each;
an empty table of pages or rules is fine; further columns of pages are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_of, lower_ascii

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Rows of a range, about; ranges at most; sampled keys for each range; bytes of a border.
RANGE_ROWS = 4096
RANGES = 4096
SAMPLE = 16
BORDER = 256


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels backwards, each with a dot after it."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def borders(keyed: DataFrame, range_rows: int, ranges: int) -> list[str]:
    """Keys that cut ``keyed`` into about equal ranges, from a sample whose size follows their number only."""
    n = min(ranges, -(-keyed.count() // range_rows))
    if n < 2:
        return []
    rows = keyed.select(F.substring("key", 1, BORDER).alias("key"), "hash").orderBy("hash", "key").limit(n * SAMPLE).select("key")
    found = sorted(r.key for r in rows.collect())
    return sorted({found[len(found) * k // n] for k in range(1, n)} - {""})


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", range_rows: int = RANGE_ROWS, ranges: int = RANGES
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url) by ``rules``
    (host, path, verdict); rule and verdict as in the module's text."""
    p = columns_of(pages, "page_id", "url")
    host = url_host(F.col("url"))
    keyed = p.select("page_id", host.alias("host"), url_path(F.col("url")).alias("path")).withColumn(
        "hash", F.xxhash64("page_id", "host", "path")
    )
    keyed = keyed.withColumn(
        "key", F.concat(host_key(F.col("host")), F.substring("path", 1, BORDER), F.lit("#"), F.hex("hash"))
    )
    cuts = borders(keyed, range_rows, ranges)
    kind_of_id = p.schema["page_id"].dataType.simpleString()
    keyed = keyed.withColumn("page_id", F.col("page_id").cast("string"))  # pandas would turn null integers to floats
    asked = keyed.select("page_id", "host", "path", "key", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("verdict"))
    r = columns_of(rules, "host", "path", "verdict").where("host is not null and path is not null and verdict is not null")
    r = r.select(F.lit(None).cast("string").alias("page_id"), lower_ascii(F.col("host")).alias("host"), "path", "verdict")
    given = r.select("page_id", "host", "path", host_key(F.col("host")).alias("key"), F.lit(0).alias("kind"), "verdict")
    both = asked.unionByName(given)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["range"] = [bisect.bisect_right(cuts, k) for k in b["key"]]
            rule = b["kind"] == 0
            if rule.any():  # a rule goes to every range that holds keys which begin with its own
                more = b[rule]
                last = [bisect.bisect_left(cuts, k + "\U0010ffff") for k in more["key"]]
                spread = [list(range(a, z + 1)) for a, z in zip(more["range"], last, strict=True)]
                b = pd.concat([b[~rule], more.assign(range=spread).explode("range")])
                b["range"] = b["range"].astype("int64")
            yield b

    ranged = both.mapInPandas(dealt, "page_id string, host string, path string, key string, kind int, verdict string, range long").repartitionByRange(len(cuts) + 1, "range")
    ranged = ranged.sortWithinPartitions("range", "key", "kind")

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, stack = None, []  # the stack: (key, host, path -> verdict)
        for b in batches:
            rule, verdict = [], []
            for key, kind, host, path, told, at in zip(b["key"], b["kind"], b["host"], b["path"], b["verdict"], b["range"], strict=True):
                if at != here:
                    here, stack = at, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}))
                    paths = stack[-1][2]
                    paths[path] = "block" if "block" in (told, paths.get(path)) else told
                    rule.append(None)
                    verdict.append(None)
                    continue
                best = None
                for _, of, paths in stack:
                    for n in sorted({len(x) for x in paths}, reverse=True):
                        if (given := paths.get(path[:n])) is not None and n <= len(path):
                            if best is None or len(of) + n >= best[0]:
                                best = (len(of) + n, of + path[:n], given)
                            break
                rule.append(best and best[1])
                verdict.append(best[2] if best else default)
            asked = (b["kind"] == 1).to_numpy()
            yield pd.DataFrame({"page_id": b["page_id"], "host": b["host"], "path": b["path"], "rule": pd.Series(rule, dtype=object, index=b.index), "verdict": pd.Series(verdict, dtype=object, index=b.index)})[asked]

    judged = ranged.mapInPandas(sweep, "page_id string, host string, path string, rule string, verdict string")
    return judged.withColumn("page_id", F.col("page_id").cast(kind_of_id))

"""Small tables with every awkward case, and a DuckDB comparison."""

from __future__ import annotations

import os

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
LONG = " ".join(f"w{i % 5000}" for i in range(120_000))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, taken string, words string, row string, _own string, score double"


def docs_of(spark, rows):
    """documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y", "z", "r", "o", 2.0) for i, t, s in rows], DOCS)


def awkward(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    return docs_of(
        spark,
        [
            (1, None, "a"),
            (2, "", "a"),
            (3, " \n\t ", None),
            (None, "only some words that nobody else has here", "b"),
            (None, None, None),
            (4, LONG, "b"),
            (5, LONG + " end", "b"),
            (6, "the same short text", "c"),
            (6, "the same short text", "c"),
            (7, "the same short text", "c"),
            (8, "word", "d"),
            (9, "two words", "d"),
            (-3, "Ünïcödé wörds · and “quotes”\nа кириллица 漢字", "d"),
        ],
    )


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return None if value != value else float(value)
    if hasattr(value, "tolist"):
        return [normal(v) for v in value.tolist()]
    return value


def rows_of(pdf):
    columns = sorted(pdf.columns)
    return columns, sorted(repr([normal(v) for v in r]) for r in pdf[columns].astype(object).where(pdf[columns].notna(), None).itertuples(index=False))


def duck(sql: str, sf: str = SF, views: dict | None = None):
    c = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    for name, frame in (views or {}).items():
        c.sql(f"DROP VIEW IF EXISTS {name}")
        c.register(name, frame)
    return c.sql(sql).df()


def same(spark_df, sql: str, sf: str = SF, views: dict | None = None) -> None:
    got, want = rows_of(spark_df.toPandas()), rows_of(duck(sql, sf, views))
    assert got[0] == want[0]
    assert got[1] == want[1], [x for x in zip(got[1], want[1], strict=False) if x[0] != x[1]][:3]

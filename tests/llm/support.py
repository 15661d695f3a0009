"""Small tables with every awkward case, and plain yardsticks."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# A table may carry columns whose names the operators use themselves.
CLASHING = DOCS + ", kept boolean, score string, component_id string, n_words string, label string, piece string, _key long, node long"


def documents(spark: SparkSession, texts: list, ids: list | None = None, clashing: bool = False, langs: list | None = None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, langs[n] if langs else "en", "src", len(t or "")) for n, (i, t) in enumerate(zip(ids, texts))]
    if not clashing:
        return spark.createDataFrame(rows, DOCS)
    return spark.createDataFrame([(*r, None, "x", "y", "z", "l", "p", 1, 2) for r in rows], CLASHING)


def plain_rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def duck_rows(sql: str, sf: str, columns: list[str]) -> list[tuple]:
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall(), key=repr)

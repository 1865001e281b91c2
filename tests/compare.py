"""Compares a query with its SQL on the same tables."""

from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    text = frame.astype(object).where(frame.notna(), None)
    return sorted(repr(tuple(x.item() if hasattr(x, "item") else x for x in r)) for r in text.itertuples(index=False, name=None))


def same(spark_frame, sql_frame):
    assert sorted(spark_frame.columns) == sorted(sql_frame.columns)
    a, b = rows(spark_frame), rows(sql_frame)
    assert len(a) == len(b), (len(a), len(b))
    assert a == b, next((x, y) for x, y in zip(a, b, strict=True) if x != y)

"""Fixtures and the comparison with DuckDB shared by the tests."""

import duckdb
import pyarrow as pa


def duck(sql: str, **tables: pa.Table) -> list[tuple]:
    con = duckdb.connect()
    for name, data in tables.items():
        con.register(name, data)
    return con.execute(sql).fetchall()


def same_rows(df, sql: str, **tables) -> None:
    """Spark's rows equal the SQL's, columns matched by name."""
    con = duckdb.connect()
    for name, data in tables.items():
        con.register(name, data)
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r) for r in result.fetchall()), key=repr)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    assert got == want


def docs_frame(spark, texts, extra=True):
    """documents-like rows: given texts, then a null id and a repeated row."""
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)]
    rows += [(None, "a row without id.", None, None), rows[0]] if rows else []
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, labels string"), pa.table(
        {"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}
    )

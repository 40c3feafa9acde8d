"""The JDBC publish path without a database: Spark's JDBC reader and writer
are replaced by recorders, so the test checks what would be sent."""

import datetime as dt

import pytest
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from tslake.operators.publish import JdbcTarget, publish

D = dt.date


def test_append_new_pushes_max_and_appends_only_new_months(spark, monkeypatch):
    calls = {"read": [], "write": []}
    existing = spark.createDataFrame([(D(2020, 2, 1),)], "max_key date")

    def fake_read(self, url, table, properties=None, **kw):
        calls["read"].append((url, table))
        return existing

    def fake_write(self, url, table, mode=None, properties=None):
        calls["write"].append((url, table, mode, sorted(r.reference_month for r in self._df.collect())))

    monkeypatch.setattr(DataFrameReader, "jdbc", fake_read)
    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_write)
    gold = spark.createDataFrame(
        [(D(2020, 1, 1), 1.0), (D(2020, 2, 1), 2.0), (D(2020, 3, 1), 3.0)], "reference_month date, selic double"
    )
    publish(spark, gold, JdbcTarget("jdbc:test://db", "gold.macro_monthly", {"user": "u"}), mode="append_new")
    assert calls["read"] == [("jdbc:test://db", '(SELECT MAX("reference_month") AS max_key FROM gold.macro_monthly) hw')]
    assert calls["write"] == [("jdbc:test://db", "gold.macro_monthly", "append", [D(2020, 3, 1)])]


def test_upsert_is_refused(spark, monkeypatch):
    """Reading the table back and rewriting it could leave it empty half-way."""
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda *a, **k: pytest.fail("nothing may be written"))
    gold = spark.createDataFrame([(D(2020, 1, 1), 1.0)], "reference_month date, selic double")
    with pytest.raises(ValueError, match="staging"):
        publish(spark, gold, JdbcTarget("jdbc:test://db", "t"), mode="upsert")


def test_overwrite_truncates(spark, monkeypatch):
    written = {}

    def fake_write(self, url, table, mode=None, properties=None):
        written["mode"] = mode
        written["rows"] = sorted(tuple(r) for r in self._df.collect())

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_write)
    gold = spark.createDataFrame([(D(2020, 1, 1), 1.0), (D(2020, 2, 1), 2.0)], "reference_month date, selic double")
    publish(spark, gold, JdbcTarget("jdbc:test://db", "t"), mode="overwrite")
    assert written == {"mode": "overwrite", "rows": [(D(2020, 1, 1), 1.0), (D(2020, 2, 1), 2.0)]}

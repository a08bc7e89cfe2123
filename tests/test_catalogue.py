"""Every registered reference query against its DuckDB SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from decklight.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the small tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def plain(value):
    if value is None or str(value) in ("nan", "NaT", "<NA>"):
        return "null"
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def rows_of(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(plain, r)) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF)
    if name not in catalogue.ORACLE_SQL:
        assert got.count() > 0
        return
    assert rows_of(got.toPandas()) == rows_of(duck.execute(catalogue.ORACLE_SQL[name]).fetch_df())


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert len(rows) == 4 and all(not math.isnan(r.iou) for r in rows)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_halves_of_the_results_file(spark, tmp_path):
    """Heights whose decimal text is a half or just under one: rounded as the SQL rounds them."""
    con = duckdb.connect()
    con.execute("CREATE TABLE supplier AS SELECT range AS s_suppkey, CAST(range % 25 AS INTEGER) AS s_nationkey FROM range(450)")
    con.execute(
        "CREATE TABLE lineitem AS SELECT range AS l_orderkey, 0 AS l_partkey, range AS l_suppkey, 1 AS l_linenumber, CAST(1 + range % 50 AS DOUBLE) AS l_quantity, CAST(range AS DOUBLE) AS l_extendedprice, "
        "CAST(0 AS DOUBLE) AS l_discount, CAST(range % 9 AS DOUBLE) / 100 AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus FROM range(450)"
    )
    for table in ("supplier", "lineitem"):
        con.execute(f"COPY {table} TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    want = rows_of(con.execute(catalogue.ORACLE_SQL["a12_results_csv"]).fetch_df())
    assert rows_of(catalogue.QUERIES["a12_results_csv"](spark, str(tmp_path)).toPandas()) == want
    value = F.col("v")
    got = spark.createDataFrame([(-0.001,), (11.174999999999999,), (10.155,), (-10.155,), (None,)], "v double").select(F.format_string("%.3f", catalogue.round_scaled(value, 2)).alias("t")).collect()
    assert [r.t for r in got[:4]] == ["-0.000", "11.180", "10.150", "-10.150"]

"""Views of the given tables as points, bridges, sources and logs.

Each view has one text for Spark and one for DuckDB, made from one template: ``{D}`` is
the type name DOUBLE, ``{div}`` an integer division, ``{s}`` the string type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()

#: name -> (tables it reads, template)
_VIEWS: dict[str, str] = {
    "points": """
WITH base AS (
  SELECT lpad(CAST(s_nationkey AS {s}), 8, '0') AS huc_id, CAST(l_suppkey AS {s}) AS bridge_id,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS point_idx,
         CAST(l_quantity AS DOUBLE) * CAST(0.5 AS DOUBLE) + CAST(l_partkey % 100 AS DOUBLE) * CAST(0.005 AS DOUBLE) AS x,
         CAST((l_partkey * 37) % 1000 AS DOUBLE) * CAST(0.008 AS DOUBLE) AS y,
         CAST(l_extendedprice AS DOUBLE) AS intensity, CAST(l_tax AS DOUBLE) AS tax, CAST(l_discount AS DOUBLE) AS discount,
         l_returnflag AS rf, l_linestatus AS ls, l_linenumber AS ln, l_suppkey AS sk
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
), labelled AS (
  SELECT *, CASE WHEN rf = 'N' AND ls = 'F' THEN 1 WHEN rf = 'R' AND ls = 'F' THEN 3 WHEN ln = 7 THEN 0 ELSE 2 END AS gold
  FROM base
)
SELECT huc_id, bridge_id, CAST(point_idx AS BIGINT) AS point_idx, x, y,
       CAST(10 AS DOUBLE) + CAST(0.05 AS DOUBLE) * x + CAST(0.02 AS DOUBLE) * y + (tax - CAST(0.04 AS DOUBLE))
         + CASE WHEN rf = 'R' AND ls = 'F' THEN CAST(2 AS DOUBLE) WHEN rf = 'N' AND ls = 'F' THEN CAST(-3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
         - CASE WHEN sk % 10 = 9 THEN CAST(0.02 AS DOUBLE) * (x - CAST(13 AS DOUBLE)) * (x - CAST(13 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END AS z,
       intensity, CAST(CASE WHEN rf = 'N' AND ls = 'F' THEN 2 WHEN ln = 7 THEN 7 ELSE 1 END AS INT) AS classification,
       CAST(gold AS INT) AS gold,
       CAST(CASE WHEN discount >= CAST(0.09 AS DOUBLE) THEN (gold + 1) % 4 ELSE gold END AS INT) AS pred,
       CAST(CASE WHEN tax >= CAST(0.07 AS DOUBLE) THEN (gold + 2) % 4 ELSE gold END AS INT) AS silver
FROM labelled""",
    "bridges": """
SELECT lpad(CAST(c_nationkey AS {s}), 8, '0') AS huc_id, CAST(c_custkey AS {s}) AS osmid, c_name AS name, c_mktsegment AS bridge_type,
       CASE WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END AS has_lidar_tif,
       CAST((c_custkey * 7919) % 10000 AS DOUBLE) AS x0, CAST((c_custkey * 104729) % 10000 AS DOUBLE) AS y0,
       CAST((c_custkey * 7919) % 10000 + 30 AS DOUBLE) AS x1, CAST((c_custkey * 104729) % 10000 + 5 AS DOUBLE) AS y1
FROM customer""",
    "sources": """
SELECT n_name AS name, concat('ept://', n_name) AS url,
       CAST((n_nationkey % 5) * 2000 - 50 AS DOUBLE) AS xmin, CAST((n_nationkey {div} 5) * 2000 - 50 AS DOUBLE) AS ymin,
       CAST((n_nationkey % 5) * 2000 + 2050 AS DOUBLE) AS xmax, CAST((n_nationkey {div} 5) * 2000 + 2050 AS DOUBLE) AS ymax
FROM nation""",
    "run_logs": """
SELECT event_id AS line_no, ts, concat('[Child ', CAST(user_id % 10 AS {s}), '] [bridge=bridge_', CAST(event_id AS {s}), '] ',
       CASE event_type WHEN 'purchase' THEN concat('INFER_OK bridge_seconds=', CAST(CAST(floor(abs(value)) AS BIGINT) AS {s}), '.25s')
                       WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'INFER_FAILED reason=timeout' ELSE 'INFER_FAILED reason=inference_error' END
                       WHEN 'click' THEN 'SKIP_EXISTS' WHEN 'view' THEN 'INFER_START' ELSE 'SKIP_SMALL_FILE points<100' END) AS line
FROM events""",
    "summaries": """
SELECT line_no, concat('[Child ', CAST(child AS {s}), '] SUMMARY succeeded=', CAST(ok AS {s}), ' failed=', CAST(bad AS {s}), ' skipped_exists=', CAST(seen AS {s}), ' skipped_too_few_points=', CAST(small AS {s}),
       ' download_failed=', CAST(lost AS {s}), ' total=', CAST(n AS {s}), ' wall_clock_seconds=', CAST(secs AS {s}), ' wall_clock_hours=', CAST(secs {div} 3600 AS {s}), '.', lpad(CAST((secs % 3600) * 10000 {div} 3600 AS {s}), 4, '0')) AS line
FROM (SELECT user_id % 10 AS child, max(event_id) AS line_no, count(*) AS n, CAST(sum(event_id % 97) AS BIGINT) AS secs, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS ok,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS bad, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS seen,
  CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS small, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS lost FROM events GROUP BY user_id % 10) s""",
    "curved_logs": """
SELECT event_id AS line_no, concat('[', lpad(CAST(user_id AS {s}), 8, '0'), '] OSM ID ', CAST(event_id % 500 AS {s}), ' / Source S_',
       CAST(event_id % 7 AS {s}), ': Bridge is curved/arched (max deviation: ', CAST(CAST(floor(abs(value)) AS BIGINT) AS {s}), '.375m)') AS line
FROM events WHERE event_type = 'error'""",
    "metrics": """
SELECT CAST(user_id % 20 AS INT) AS epoch, event_id AS step,
       CASE WHEN event_type = 'view' THEN CAST(value AS DOUBLE) END AS train_loss_epoch,
       CASE WHEN event_type = 'click' THEN CAST(value AS DOUBLE) END AS val_loss,
       CASE WHEN event_type = 'purchase' THEN CAST(value AS DOUBLE) END AS val_deck_iou
FROM events""",
}


def spark_sql(name: str) -> str:
    return _VIEWS[name].format(s="STRING", div="div", D="DOUBLE")


def duck_sql(name: str) -> str:
    return _VIEWS[name].format(s="VARCHAR", div="//", D="DOUBLE")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view over the tables of ``sf_dir``, as a DataFrame; no temporary view is left behind."""
    text = spark_sql(name)
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f" {t}" in text.replace("\n", " ")}
    for t in tables:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
    return spark.sql(text, **tables)


def view_of_stream(stream: DataFrame, name: str) -> DataFrame:
    """A view of one table, over a stream of that table."""
    text = spark_sql(name)
    table = next(t for t in TABLES if f"FROM {t}" in text)
    return stream.sparkSession.sql(text.replace(f"FROM {table}", f"FROM {{{table}}}"), **{table: stream})


def with_duck(query: str, *names: str) -> str:
    """``query`` for DuckDB with the named views before it."""
    return "WITH " + ", ".join(f"{n} AS ({duck_sql(n)})" for n in names) + " " + query

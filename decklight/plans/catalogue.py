"""Registered queries over the point-cloud operators, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from decklight.functions import columns as C
from decklight.functions.tables import shared_folder, written
from decklight.operators import ground as G, hulls as H, learn as L, metrics as M, planes as P, runs as R, spatial as S, splits as E, training as T, voxels as V
from decklight.plans.views import view, view_of_stream, with_duck
from decklight.sources import tables as A
from decklight.streaming import monitor

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

B = V.BRIDGE


def query(name: str, sql: str | None = None, *views: str):
    """Registers a function of (get, spark, sf_dir); ``get`` gives a table or view by name."""

    def put(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            def get(n: str) -> DataFrame:
                made = n in ("points", "bridges", "sources", "run_logs", "curved_logs", "metrics", "summaries")
                return view(spark, sf_dir, n) if made else spark.read.parquet(f"{sf_dir}/{n}.parquet")

            return build(get, spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = with_duck(sql, *views) if views else sql
        return build

    return put


def r(c, n: int = 4):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def rounded(df: DataFrame, names: list[str], n: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) for c in names})


def round_scaled(c: Column, n: int) -> Column:
    """``c`` rounded as the SQL rounds a double: scaled, to the nearest whole number and back. ``F.round`` goes by its
    shortest decimal text, which differs where scaling meets a half: 11.174999999999999 is 11.18 here and 11.17 there."""
    whole = F.round(F.abs(c) * 10.0**n) / 10.0**n
    return F.when(c < 0, -whole).otherwise(whole)


def splits_of(get) -> DataFrame:
    """All bridges in splits, with a stem made of their own id and a source name."""
    return _split(get("bridges"))


def used_of(get) -> DataFrame:
    """Splits of an earlier run, which had half of the bridges: the rest is what the queries on unused ones look for."""
    return _split(get("bridges").where("CAST(osmid AS BIGINT) % 2 = 0"))


def _split(rows: DataFrame) -> DataFrame:
    split = E.stratified_split(rows, 0.70, 0.15, 0.15)
    return split.select("huc_id", "osmid", C.bridge_stem("osmid", F.lit("USGS LPC: A/1")).alias("bridge_stem"), "split")


_HASH = "md5(concat_ws('|', '27', huc_id, osmid))"
def _split_sql(where: str) -> str:
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY huc_id ORDER BY {_HASH}, osmid) AS rk, count(*) OVER (PARTITION BY huc_id) AS n FROM bridges WHERE {where}),
used_splits AS (SELECT huc_id, osmid, concat('bridge_', osmid, '_USGS_LPC__A_1') AS bridge_stem,
  CASE WHEN rk <= floor(CAST(0.70 AS DOUBLE) * n) THEN 'train' WHEN rk <= floor(CAST(0.70 AS DOUBLE) * n) + floor(CAST(0.15 AS DOUBLE) * n) THEN 'val' ELSE 'test' END AS split FROM ranked)"""


USED_SQL = _split_sql("CAST(osmid AS BIGINT) % 2 = 0")


def with_splits(sql: str, where: str = "true") -> str:
    return with_duck("", "bridges").rstrip() + ", " + _split_sql(where) + " " + sql


# ---- A: scans and sinks -------------------------------------------------------------------


@query("a1_scan_bridges", "SELECT CAST(c_custkey AS VARCHAR) AS osmid, c_name AS name FROM customer")
def _(get, spark, sf):
    made = A.scan_bridges(spark, f"{sf}/customer.parquet", ("c_custkey", "c_name"))
    return made.select(F.col("c_custkey").cast("string").alias("osmid"), F.col("c_name").alias("name"))


@query("a2_huc_partitions", "SELECT DISTINCT huc_id FROM bridges WHERE huc_id IN ('00000001', '00000007', '00000024', '99999999')", "bridges")
def _(get, spark, sf):
    return A.huc_partitions(get("bridges"), ["00000001", "00000007", "00000024", "99999999"])


@query("a4_scan_points", "SELECT huc_id, count(*) AS n FROM points WHERE huc_id IN ('00000003', '00000005') GROUP BY huc_id", "points")
def _(get, spark, sf):
    folder = shared_folder(spark)
    A.write_by_huc(get("points"), "huc_id", folder)
    return A.scan_points(spark, folder, ["00000003", "00000005"], get("points").schema).groupBy("huc_id").agg(F.count(F.lit(1)).alias("n"))


@query("a7_scan_cloud_metadata", "SELECT event_id, CAST(k AS VARCHAR) AS class, CAST(json_extract_string(props, '$.' || k) AS BIGINT) AS n FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events WHERE props IS NOT NULL)")
def _(get, spark, sf):
    return A.cloud_metadata_rows(get("events"), "props", "event_id")


@query("a8_scan_split_ids", with_splits("SELECT huc_id, bridge_stem FROM used_splits"))
def _(get, spark, sf):
    lines = splits_of(get).select(F.concat(F.lit(" "), F.col("huc_id"), F.lit("/"), F.col("bridge_stem")).alias("value"), F.col("osmid").cast("long").alias("line_no"))
    return A.split_ids(lines.unionByName(lines)).select("huc_id", "bridge_stem")


@query("a12_results_csv", """SELECT row_number() OVER (ORDER BY huc_id, osm_id) AS place, * FROM (SELECT huc_id, bridge_id AS osm_id, '' AS source_name, CASE WHEN count(*) % 3 = 0 THEN 'false' ELSE 'true' END AS success,
  CASE WHEN count(*) % 2 = 0 THEN 'true' ELSE 'false' END AS skipped, CASE WHEN count(*) % 3 = 0 THEN '' ELSE printf('%.3f', round(max(z), 2)) END AS rmse, printf('%.3f', round(min(z), 2)) AS deviation,
  CASE WHEN count(*) % 3 = 0 THEN 'too few, or "bad"' ELSE '' END AS error FROM points GROUP BY huc_id, bridge_id)""", "points")
def _(get, spark, sf):
    n = F.count(F.lit(1))
    made = get("points").groupBy("huc_id", F.col("bridge_id").alias("osmid")).agg(
        (n % 3 != 0).alias("success"), (n % 2 == 0).alias("skipped"), F.when(n % 3 != 0, round_scaled(F.max("z"), 2)).alias("rmse"), round_scaled(F.min("z"), 2).alias("deviation"),
        F.when(n % 3 == 0, 'too few, or "bad"').alias("error"),
    )
    folder = shared_folder(spark)
    R.write_results_csv(made.withColumn("source_name", F.lit(None).cast("string")), folder)
    names = ["huc_id", "osm_id", "source_name", "success", "skipped", "rmse", "deviation", "error"]
    read = spark.read.schema(", ".join(f"{c} string" for c in names)).option("escape", "\\").csv(folder, header=True)
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")]
    numbered = E.numbered(read.select(*at, *names), [F.col("file"), F.col("block"), F.col("at")], "place")
    return numbered.select("place", *(F.coalesce(c, F.lit("")).alias(c) for c in names))


@query("a13_split_manifest", with_splits("SELECT split, kind, huc_id, bridge_stem FROM used_splits, (SELECT unnest(['ids', 'json']) AS kind)"))
def _(get, spark, sf):
    folder = shared_folder(spark)
    A.write_split_manifest(splits_of(get), folder)
    ids = spark.read.schema("value string, split string").text(f"{folder}/ids")
    ids = ids.select("split", F.lit("ids").alias("kind"), F.substring_index("value", "/", 1).alias("huc_id"), F.substring_index("value", "/", -1).alias("bridge_stem"))
    rows = spark.read.schema("huc_id string, bridge_stem string, split string").json(f"{folder}/json")
    return ids.unionByName(rows.select("split", F.lit("json").alias("kind"), "huc_id", "bridge_stem"))


@query("a16_split_file_plan", with_splits("SELECT huc_id, osmid, bridge_stem, split, concat(huc_id, '/', bridge_stem, '.', ext) AS file FROM (SELECT *, unnest(CASE WHEN split = 'test' THEN ['pt', 'laz'] ELSE ['pt'] END) AS ext FROM used_splits)"))
def _(get, spark, sf):
    return R.split_file_plan(splits_of(get))


# ---- B: scalar functions ------------------------------------------------------------------


@query("b1_safe_source_name", r"SELECT n_name, regexp_replace(concat(n_name, ' /:\é.-_'), '[^\p{L}\p{N}._-]', '_', 'g') AS safe FROM nation")
def _(get, spark, sf):
    return get("nation").select("n_name", C.safe_source_name(F.concat("n_name", F.lit(" /:\\é.-_"))).alias("safe"))


@query("b2_bridge_stem", r"SELECT c_custkey, concat('bridge_', c_custkey, '_', regexp_replace(c_mktsegment || ' x', '[^\p{L}\p{N}._-]', '_', 'g')) AS stem FROM customer")
def _(get, spark, sf):
    return get("customer").select("c_custkey", C.bridge_stem("c_custkey", F.concat("c_mktsegment", F.lit(" x"))).alias("stem"))


_STEMS = "concat(CASE WHEN c_custkey % 5 = 0 THEN 'brid_' ELSE 'bridge_' END, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey AS {s}) END, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '_' END, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END)"


@query("b3_parse_bridge_stem", f"SELECT c_custkey, CASE WHEN regexp_matches(s, '^bridge_[^_]+_') THEN regexp_extract(s, '^bridge_([^_]+)_', 1) END AS osm_id, CASE WHEN regexp_matches(s, '^bridge_[^_]+_') THEN regexp_extract(s, '^bridge_[^_]+_(.*)$', 1) END AS source FROM (SELECT c_custkey, {_STEMS.format(s='VARCHAR')} AS s FROM customer)")
def _(get, spark, sf):
    parsed = get("customer").select("c_custkey", C.parse_bridge_stem(F.expr(_STEMS.format(s="STRING"))).alias("p"))
    return parsed.select("c_custkey", "p.osm_id", "p.source")


@query("b4_filter_by_ids", "SELECT osmid, name FROM bridges WHERE osmid IN ('3', '14', '159')", "bridges")
def _(get, spark, sf):
    return R.filter_by_ids(get("bridges"), "osmid", [3, 14, "159"]).select("osmid", "name")


@query("b5_lidar_subset", "SELECT has_lidar_tif, osmid FROM bridges", "bridges")
def _(get, spark, sf):
    bridges = get("bridges")
    return R.lidar_subset(bridges, "Y").unionByName(R.lidar_subset(bridges, "N")).select("has_lidar_tif", "osmid")


@query("b6_asprs_to_model", "SELECT l_partkey % 20 AS code, CASE l_partkey % 20 WHEN 2 THEN 1 WHEN 9 THEN 1 WHEN 17 THEN 2 WHEN 18 THEN 3 ELSE 0 END AS model, count(*) AS n FROM lineitem GROUP BY ALL")
def _(get, spark, sf):
    coded = get("lineitem").select((F.col("l_partkey") % 20).alias("code"))
    return coded.groupBy("code").agg(F.first(C.asprs_to_model("code")).alias("model"), F.count(F.lit(1)).alias("n"))


@query("b7_model_to_asprs", "SELECT pred, CASE pred WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 17 ELSE 18 END AS code, count(*) AS n FROM points GROUP BY ALL", "points")
def _(get, spark, sf):
    return get("points").groupBy("pred", C.model_to_asprs("pred").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("b8_deck_mask_overlay", "SELECT classification, pred, CASE WHEN pred = 2 THEN 17 ELSE classification END AS code, count(*) AS n FROM points GROUP BY ALL", "points")
def _(get, spark, sf):
    return get("points").groupBy("classification", "pred", C.deck_mask_overlay("classification", "pred").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("b9_classified_output", "SELECT output, code, count(*) AS n FROM (SELECT unnest([{'output': 'predicted', 'code': CASE pred WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 17 ELSE 18 END}, {'output': 'bridge_masked', 'code': CASE WHEN pred = 2 THEN 17 ELSE classification END}], recursive := true) FROM points) GROUP BY ALL", "points")
def _(get, spark, sf):
    return C.classified_output(get("points"), "both").groupBy("output", "code").agg(F.count(F.lit(1)).alias("n"))


@query("b10_to_web_mercator", "SELECT c_custkey, round(radians(CAST(c_custkey % 360 - 180 AS DOUBLE)) * 6378137, 2) AS x, round(ln(tan(pi() / 4 + radians(CAST(c_custkey % 170 - 85 AS DOUBLE)) / 2)) * 6378137, 2) + 0 AS y FROM customer")
def _(get, spark, sf):
    x, y = C.to_web_mercator((F.col("c_custkey") % 360 - 180).cast("double"), (F.col("c_custkey") % 170 - 85).cast("double"))
    return get("customer").select("c_custkey", r(x, 2).alias("x"), (r(y, 2) + 0).alias("y"))


@query("b11_shift_to_min", "SELECT huc_id, bridge_id, point_idx, " + ", ".join(f"round({c} - min({c}) OVER (PARTITION BY huc_id, bridge_id), 8) AS {c}" for c in "xyz") + " FROM points", "points")
def _(get, spark, sf):
    return rounded(V.shift_to_min(get("points")), ["x", "y", "z"], 8)


@query("b12_restore_absolute", "SELECT huc_id, bridge_id, point_idx, round(x, 8) AS x, round(y, 8) AS y, round(z, 8) AS z FROM points", "points")
def _(get, spark, sf):
    points = get("points")
    return rounded(V.restore_absolute(V.normalize_cloud(points), V.cloud_offsets(points)), ["x", "y", "z"], 8)


_NAMES = "CASE c_custkey % 5 WHEN 0 THEN 'None' WHEN 1 THEN ' nan' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE c_name END"


@query("b13_clean_bridge_name", f"SELECT c_custkey, CASE WHEN lower(trim(n)) IN ('none', 'nan', '') THEN '' ELSE coalesce(n, '') END AS name FROM (SELECT c_custkey, {_NAMES} AS n FROM customer)")
def _(get, spark, sf):
    return get("customer").select("c_custkey", C.clean_bridge_name(F.expr(_NAMES)).alias("name"))


@query("b14_normalize_huc8", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN concat('x', c_custkey) ELSE lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS huc8 FROM customer")
def _(get, spark, sf):
    code = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("x"), "c_custkey")).otherwise(F.concat(F.lit(" "), "c_custkey"))
    return get("customer").select("c_custkey", C.normalize_huc8(code).alias("huc8"))


def _uniform_sql(name: str, keys: str) -> str:
    return f"((CAST(('0x' || substr(md5(concat_ws('|', '27', '{name}', {keys})), 1, 8)) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE))"


def _normal_sql(name: str) -> str:
    keys = "huc_id, bridge_id, CAST(point_idx AS VARCHAR)"
    return f"(sqrt(-2 * ln({_uniform_sql(name + 'a', keys)})) * cos(2 * pi() * {_uniform_sql(name + 'b', keys)}))"


@query("b15_augment_points", f"""SELECT huc_id, bridge_id, point_idx, {", ".join(f"round({c} - min({c}) OVER (PARTITION BY huc_id, bridge_id), 4) AS {c}" for c in "xyz")} FROM (
  SELECT huc_id, bridge_id, point_idx, x * cos(a) - y * sin(a) + 0.01 * {_normal_sql("x")} AS x, x * sin(a) + y * cos(a) + 0.01 * {_normal_sql("y")} AS y, z + 0.01 * {_normal_sql("z")} AS z
  FROM (SELECT *, 2 * pi() * {_uniform_sql("angle", "huc_id, bridge_id")} AS a FROM points))""", "points")
def _(get, spark, sf):
    return rounded(V.augment_points(get("points")), ["x", "y", "z"])


def _augmented_sql() -> str:
    keys, point = "huc_id, bridge_id", "huc_id, bridge_id, CAST(point_idx AS VARCHAR)"
    flip = lambda c: f"CASE WHEN {_uniform_sql('flip' + c, keys)} > 0.5 THEN -1 ELSE 1 END"
    moved = {"x": f"(x * cos(a) - y * sin(a) + 0.01 * {_normal_sql('x')}) * {flip('x')}", "y": f"(x * sin(a) + y * cos(a) + 0.01 * {_normal_sql('y')}) * {flip('y')}", "z": f"(z + 0.01 * {_normal_sql('z')})"}
    xyz = ", ".join(f"{sql} * (0.9 + 0.2 * {_uniform_sql('scale', keys)}) AS {c}" for c, sql in moved.items())
    return f"""SELECT huc_id, bridge_id, point_idx, gold, round(intensity, 4) AS intensity, {", ".join(f"round({c} - min({c}) OVER (PARTITION BY huc_id, bridge_id), 4) AS {c}" for c in "xyz")} FROM (
  SELECT *, sum(CASE WHEN kept THEN 1 ELSE 0 END) OVER (PARTITION BY huc_id, bridge_id) AS n_left FROM (
    SELECT huc_id, bridge_id, point_idx, gold, greatest(0, least(1, intensity / 100000 + 0.02 * {_normal_sql('intensity')})) AS intensity, {xyz}, {_uniform_sql('drop', point)} > 0.05 + 0.05 * {_uniform_sql('rate', keys)} AS kept
    FROM (SELECT *, 2 * pi() * {_uniform_sql("angle", keys)} AS a FROM points))) WHERE kept OR n_left <= 10"""


@query("b15_augment_extra", _augmented_sql(), "points")
def _(get, spark, sf):
    points = get("points").select(*B, "point_idx", "x", "y", "z", (F.col("intensity") / 100000).alias("intensity"), "gold")
    return rounded(V.augment_points(points, extra=True), ["x", "y", "z", "intensity"])


@query("b16_output_keys", "SELECT osmid, concat('out/', huc_id, '/', osmid, s, '.laz') AS key FROM bridges, (SELECT unnest(['_predicted', '_bridge_masked']) AS s)", "bridges")
def _(get, spark, sf):
    lines = get("bridges").select("osmid", F.concat("huc_id", F.lit("/"), "osmid", F.lit(".laz")).alias("line"))
    return C.output_keys(lines, "line", "out", "both").select("osmid", "key")


@query("b17_short_labels", "SELECT c_custkey, split_part(c_name || '-v' || (c_custkey % 9), '-', -1) AS label, CASE WHEN length(c_mktsegment || c_name || c_name) > 40 THEN substr(c_mktsegment || c_name || c_name, 1, 37) || '...' ELSE c_mktsegment || c_name || c_name END AS stem FROM customer")
def _(get, spark, sf):
    customer = get("customer")
    label = F.concat("c_name", F.lit("-v"), (F.col("c_custkey") % 9).cast("string"))
    return customer.select("c_custkey", C.short_run_label(label).alias("label"), C.short_stem(F.concat("c_mktsegment", "c_name", "c_name")).alias("stem"))


@query("b18_min_points_gate", "SELECT huc_id, bridge_id, count(*) AS n_points, CASE WHEN count(*) < 600 THEN 'skipped' ELSE 'ok' END AS status FROM points GROUP BY ALL", "points")
def _(get, spark, sf):
    return V.min_points_gate(get("points"), 600)


@query("b19_argmax_logits", "SELECT vec_id, CAST(list_position(embedding[1:4], list_max(embedding[1:4])) - 1 AS INT) AS class FROM embeddings")
def _(get, spark, sf):
    return get("embeddings").select("vec_id", C.argmax_logits(F.slice("embedding", 1, 4)).alias("class"))


@query("b20_percent_scale", "SELECT event_id, CASE WHEN value <= 1 THEN value * 100 ELSE value END AS percent FROM events")
def _(get, spark, sf):
    return get("events").select("event_id", C.percent_scale("value").alias("percent"))


@query("b21_parse_uri", "SELECT osmid, concat('b', huc_id) AS bucket, concat(osmid, '/x.laz') AS key FROM bridges", "bridges")
def _(get, spark, sf):
    bucket, key = C.parse_uri(F.concat(F.lit("s3://b"), "huc_id", F.lit("/"), "osmid", F.lit("/x.laz")))
    return get("bridges").select("osmid", bucket.alias("bucket"), key.alias("key"))


_LINES = "SELECT c_custkey AS line_no, CASE WHEN c_custkey % 11 = 0 THEN 'x' || c_custkey ELSE c_nationkey || '/' || (c_custkey % 400) END AS line FROM customer"


@query("b22_manifest_validate", f"WITH l AS ({_LINES}), f AS (SELECT *, min(line_no) OVER (PARTITION BY line) AS first_line FROM l) SELECT line_no, line, 'no_slash' AS issue, CAST(NULL AS BIGINT) AS first_line FROM f WHERE NOT contains(line, '/') UNION ALL SELECT line_no, line, 'duplicate', first_line FROM f WHERE line_no > first_line")
def _(get, spark, sf):
    return R.manifest_validate(spark.sql(_LINES.replace("customer", "{customer}"), customer=get("customer")))


@query("b23_parse_curved_log", "SELECT line_no, lpad(CAST(user_id AS VARCHAR), 8, '0') AS huc_id, CAST(event_id % 500 AS VARCHAR) AS osm_id, concat('S_', event_id % 7) AS source, floor(abs(value)) + 0.375 AS max_deviation FROM (SELECT *, event_id AS line_no FROM events) WHERE event_type = 'error'")
def _(get, spark, sf):
    return C.parse_curved_log(get("curved_logs")).drop("line")


@query("b24_parse_run_log", r"SELECT line_no, CAST(regexp_extract(line, 'Child ([0-9]+)', 1) AS INT) AS child, regexp_extract(line, 'bridge=([^\]]+)', 1) AS bridge, regexp_extract(line, '\] ([A-Z_]+)( |$)', 1) AS event, CAST(nullif(regexp_extract(line, 'bridge_seconds=([0-9.]+)s', 1), '') AS DOUBLE) AS seconds, nullif(regexp_extract(line, 'reason=([a-z_]+)', 1), '') AS reason, coalesce(list_aggregate(list_sort(list_filter(string_split(regexp_extract(line, '\] [A-Z_]+ (.*)$', 1), ' '), lambda w: w LIKE '_%=%')), 'string_agg', ' '), '') AS pairs FROM (SELECT line_no, line FROM run_logs UNION ALL SELECT line_no, line FROM summaries)", "run_logs", "summaries")
def _(get, spark, sf):
    logs = get("run_logs").select("line_no", "line").unionByName(get("summaries"))
    pairs = F.transform(F.map_entries("pairs"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return C.parse_run_log(logs).drop("line").withColumn("bridge", F.coalesce("bridge", F.lit(""))).withColumn("pairs", F.array_join(F.array_sort(pairs), " "))


_EPOCHS = "SELECT epoch, max(train_loss_epoch) AS train_loss_epoch, max(val_loss) AS val_loss, max(val_deck_iou) AS val_deck_iou FROM metrics GROUP BY epoch"


def epochs_of(get) -> DataFrame:
    return T.epoch_metrics(get("metrics"), ["train_loss_epoch", "val_loss", "val_deck_iou"])


@query("b25_metric_pairs", f"SELECT epoch, 'loss' AS metric, train_loss_epoch AS train, val_loss AS val FROM ({_EPOCHS})", "metrics")
def _(get, spark, sf):
    return T.metric_curves(epochs_of(get))


# ---- C: joins -----------------------------------------------------------------------------



def _segment_distance_sql(px: str, py: str, x0: str, y0: str, x1: str, y1: str) -> str:
    t = f"greatest(0, least(1, (({px} - {x0}) * ({x1} - {x0}) + ({py} - {y0}) * ({y1} - {y0})) / (pow({x1} - {x0}, 2) + pow({y1} - {y0}, 2))))"
    return f"sqrt(pow({px} - {x0} - {t} * ({x1} - {x0}), 2) + pow({py} - {y0} - {t} * ({y1} - {y0}), 2))"


_CORNERS = [(x, y) for x in ("xmin", "xmax") for y in ("ymin", "ymax")]
_SIDES = [f"(x1 - x0) * ({y} - y0) - (y1 - y0) * ({x} - x0)" for x, y in _CORNERS]
_TO_BOX = [f"sqrt(pow(greatest(0, xmin - {x}, {x} - xmax), 2) + pow(greatest(0, ymin - {y}, {y} - ymax), 2))" for x, y in (("x0", "y0"), ("x1", "y1"))]
#: A segment meets a box if their bounds do and the box has corners on both sides of it; else the distance is that of an end or of a corner.
_PAIRS = f"""SELECT huc_id, osmid, s.name AS source_name, s.url AS source_url FROM bridges, sources s
WHERE (greatest(x0, x1) >= xmin AND least(x0, x1) <= xmax AND greatest(y0, y1) >= ymin AND least(y0, y1) <= ymax AND least({', '.join(_SIDES)}) <= 0 AND greatest({', '.join(_SIDES)}) >= 0)
  OR least({', '.join(_TO_BOX + [_segment_distance_sql(x, y, 'x0', 'y0', 'x1', 'y1') for x, y in _CORNERS])}) <= 10"""


def pairs_of(get) -> DataFrame:
    return S.bridge_source_join(get("bridges"), get("sources"))


@query("c1_bridge_source_join", _PAIRS, "bridges", "sources")
def _(get, spark, sf):
    return pairs_of(get)


_EDGES = """edges AS (SELECT b.huc_id, b.bridge_id, r[i].x AS ax, r[i].y AS ay, r[i % 4 + 1].x AS ex, r[i % 4 + 1].y AS ey FROM (SELECT huc_id, bridge_id, k,
  [{'x': 3 + k, 'y': CAST(1 AS DOUBLE)}, {'x': 19 - k, 'y': CAST(2 AS DOUBLE)}, {'x': 20 - k, 'y': CAST(7 AS DOUBLE)}, {'x': 4 + k, 'y': CAST(5.5 AS DOUBLE)}] AS r
  FROM (SELECT DISTINCT huc_id, bridge_id, CAST(CAST(bridge_id AS BIGINT) % 5 AS DOUBLE) * CAST(0.375 AS DOUBLE) AS k FROM points)) b, (SELECT unnest([1, 2, 3, 4]) AS i))"""


@query("c2_clip_points_to_bridge", with_duck("", "points").rstrip() + f""", {_EDGES} SELECT huc_id, bridge_id, point_idx FROM points JOIN edges USING (huc_id, bridge_id) GROUP BY ALL
HAVING count_if((ay > y) <> (ey > y) AND x < (ex - ax) * (y - ay) / nullif(ey - ay, 0) + ax) % 2 = 1 OR min({_segment_distance_sql('x', 'y', 'ax', 'ay', 'ex', 'ey')}) <= 0.625""")
def _(get, spark, sf):
    points = get("points")
    k = (F.col("bridge_id").cast("long") % 5) * 0.375
    ring = S.path((k + 3, F.lit(1.0)), (19 - k, F.lit(2.0)), (20 - k, F.lit(7.0)), (k + 4, F.lit(5.5)))
    outlines = points.select(*B).distinct().select(*B, ring.alias("ring"))
    return S.clip_points_to_bridge(points, outlines, 0.625).select(*B, "point_idx")


@query("c3_generate_tasks", f"SELECT * FROM ({_PAIRS}) WHERE huc_id IN ('00000001', '00000002')", "bridges", "sources")
def _(get, spark, sf):
    return S.generate_tasks(get("bridges"), get("sources"), ["00000001", "00000002"])


_STATE = "CASE CAST(osmid AS BIGINT) % 3 WHEN 0 THEN 'exists' WHEN 1 THEN 'no_points' ELSE 'timeout' END"


@query("c4_skip_existing", f"SELECT * FROM ({_PAIRS}) WHERE CAST(osmid AS BIGINT) % 5 <> 0", "bridges", "sources")
def _(get, spark, sf):
    tasks = pairs_of(get)
    status = tasks.where("CAST(osmid AS BIGINT) % 5 = 0").select("huc_id", "osmid", "source_name", F.expr(_STATE).alias("state"))
    return R.skip_existing(tasks, status)


@query("c5_unseen_candidates", with_duck("", "bridges", "sources").rstrip() + ", " + USED_SQL + f" SELECT osmid, huc_id, source_name, source_url, concat('bridge_', osmid, '_', replace(source_name, ' ', '_')) AS bridge_stem, osmid IN (SELECT osmid FROM used_splits) AS proven_linear FROM ({_PAIRS})")
def _(get, spark, sf):
    return R.unseen_candidates(pairs_of(get), used_of(get))


@query("c6_exclude_used", "SELECT huc_id, osmid FROM bridges WHERE CAST(osmid AS BIGINT) % 2 <> 0", "bridges")
def _(get, spark, sf):
    return R.exclude_used(get("bridges").select("huc_id", "osmid"), used_of(get))


@query("c7_apply_holdout", "SELECT 'pool' AS part, osmid FROM bridges WHERE CAST(osmid AS BIGINT) % 50 <> 0 UNION ALL SELECT 'test', osmid FROM bridges WHERE CAST(osmid AS BIGINT) % 50 = 0 UNION ALL SELECT 'absent', '-1'", "bridges")
def _(get, spark, sf):
    bridges = get("bridges")
    holdout = bridges.where("CAST(osmid AS BIGINT) % 50 = 0").select("osmid").unionByName(spark.range(1).select(F.lit("-1").alias("osmid")))
    parts = zip(("pool", "test", "absent"), E.apply_holdout(bridges, holdout))
    pool, test, absent = (df.select(F.lit(n).alias("part"), "osmid") for n, df in parts)
    return pool.unionByName(test).unionByName(absent)


@query("c8_source_availability", "SELECT osmid, CAST(osmid AS BIGINT) % 7 <> 0 AS available FROM bridges", "bridges")
def _(get, spark, sf):
    keyed = get("bridges").select("osmid", F.concat(F.lit("k"), "osmid").alias("key"))
    return R.source_availability(keyed, keyed.where("CAST(osmid AS BIGINT) % 7 <> 0").select("key")).select("osmid", "available")


_VOX = "CAST(floor(x) AS INT) AS vx, CAST(floor(y) AS INT) AS vy, CAST(floor(z) AS INT) AS vz"
_MAJORITY = f"""counted AS (SELECT huc_id, bridge_id, {_VOX}, gold AS label, count(*) AS n FROM points GROUP BY ALL),
majority AS (SELECT huc_id, bridge_id, vx, vy, vz, arg_max(label, n * 10 - label) AS label, CAST(sum(n) AS BIGINT) AS n_points FROM counted GROUP BY ALL)"""


def with_majority(sql: str) -> str:
    return with_duck("", "points").rstrip() + ", " + _MAJORITY + " " + sql


@query("c9_voxel_to_points", with_majority(f"SELECT p.huc_id, p.bridge_id, p.point_idx, m.label AS voxel_label FROM (SELECT *, {_VOX} FROM points) p JOIN majority m USING (huc_id, bridge_id, vx, vy, vz)"))
def _(get, spark, sf):
    points = get("points")
    return V.voxel_to_points(points, V.voxel_majority_label(points, 1.0), 1.0).select(*B, "point_idx", "voxel_label")


def _predicted(points: DataFrame) -> DataFrame:
    return points.where("CAST(bridge_id AS BIGINT) % 9 <> 0 AND NOT (CAST(bridge_id AS BIGINT) % 10 = 1 AND point_idx = 0)")


@query("c10_align_gold_pred", "SELECT g.huc_id, g.bridge_id, n_gold, coalesce(n_pred, 0) AS n_pred, CASE WHEN n_pred IS NULL THEN 'no_inference_file' WHEN n_gold <> n_pred THEN 'point_count_mismatch' WHEN n_gold < 580 THEN 'too_few_points' ELSE 'ok' END AS status FROM (SELECT huc_id, bridge_id, count(*) AS n_gold FROM points GROUP BY ALL) g LEFT JOIN (SELECT huc_id, bridge_id, count(*) AS n_pred FROM points WHERE CAST(bridge_id AS BIGINT) % 9 <> 0 AND NOT (CAST(bridge_id AS BIGINT) % 10 = 1 AND point_idx = 0) GROUP BY ALL) p USING (huc_id, bridge_id)", "points")
def _(get, spark, sf):
    points = get("points")
    return M.align_gold_pred(points, _predicted(points), 580)


@query("c11_resolve_input", "SELECT line_no, line, CASE line_no % 4 WHEN 0 THEN line WHEN 1 THEN line || '.laz' WHEN 2 THEN line || '.las' ELSE line || '.laz' END AS input FROM (SELECT CAST(osmid AS BIGINT) AS line_no, CASE WHEN CAST(osmid AS BIGINT) % 4 = 0 THEN 'h/' || osmid || '.las' ELSE 'h/' || osmid END AS line FROM bridges)", "bridges")
def _(get, spark, sf):
    n = F.col("osmid").cast("long")
    lines = get("bridges").select(n.alias("line_no"), F.when(n % 4 == 0, F.concat(F.lit("h/"), "osmid", F.lit(".las"))).otherwise(F.concat(F.lit("h/"), "osmid")).alias("line"))
    ext = F.when(F.col("line_no") % 4 == 1, ".laz").when(F.col("line_no") % 4 == 2, ".las")
    return R.resolve_input(lines, lines.where(ext.isNotNull()).select(F.concat("line", ext).alias("key")))


@query("c13_audit_outputs", "SELECT CAST(osmid AS BIGINT) AS line_no, concat(huc_id, '/', osmid) AS line, CAST(osmid AS BIGINT) % 7 <> 0 AND CAST(osmid AS BIGINT) % 5 <> 0 AS complete FROM bridges", "bridges")
def _(get, spark, sf):
    n = F.col("osmid").cast("long")
    lines = get("bridges").select(n.alias("line_no"), F.concat("huc_id", F.lit("/"), "osmid").alias("line"))
    keys = C.output_keys(lines, "line", "out", "both").where("line_no % 7 <> 0 AND NOT (line_no % 5 = 0 AND key LIKE '%masked%')").select("key")
    return R.audit_outputs(lines, keys, "out", "both")


@query("c14_missing_reasons", "SELECT concat('bridge_', event_id) AS bridge, CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'timeout' ELSE 'inference_error' END WHEN event_type IN ('purchase', 'click', 'view') THEN NULL ELSE 'too_few_points' END AS reason FROM events WHERE event_id % 3 = 0")
def _(get, spark, sf):
    missing = get("events").where("event_id % 3 = 0").select(F.concat(F.lit("bridge_"), "event_id").alias("bridge"))
    return R.missing_reasons(missing, get("run_logs"))


# ---- D: aggregates ------------------------------------------------------------------------


@query("d1_voxelize", f"SELECT huc_id, bridge_id, {_VOX}, round(avg(intensity), 8) AS intensity, count(*) AS n_points FROM points GROUP BY ALL", "points")
def _(get, spark, sf):
    return rounded(V.voxelize(get("points"), 1.0), ["intensity"], 8)


@query("d2_voxel_majority_label", with_majority("SELECT * FROM majority"))
def _(get, spark, sf):
    return V.voxel_majority_label(get("points"), 1.0)


_COUNTS = ", ".join(f"count_if(gold = {c}) AS class_{c}" for c in range(4))
_METADATA = f"SELECT huc_id, bridge_id, round(avg(x), 8) AS x_center, round(avg(y), 8) AS y_center, round(min(z), 8) AS z_min, count(*) AS n_points, {_COUNTS} FROM points GROUP BY ALL"


@query("d3_cloud_metadata", _METADATA.replace("count_if(", "CAST(count_if(").replace(") AS class", ") AS BIGINT) AS class"), "points")
def _(get, spark, sf):
    made = V.cloud_metadata(get("points"))
    in_map = {f"class_{c}": F.try_element_at("class_distribution", F.lit(str(c))) for c in range(4)}  # the map is what later steps read
    return rounded(made.withColumns(in_map).drop("class_distribution"), ["x_center", "y_center", "z_min"], 8)


@query("d4_normalize_cloud", "SELECT huc_id, bridge_id, point_idx, round(x - avg(x) OVER w + 0.00000123, 6) AS x, round(y - avg(y) OVER w + 0.00000123, 6) AS y, round(z - min(z) OVER w, 8) AS z, round(intensity / max(intensity) OVER w, 8) AS intensity, CASE classification WHEN 2 THEN 1 WHEN 9 THEN 1 WHEN 17 THEN 2 WHEN 18 THEN 3 ELSE 0 END AS label FROM points WINDOW w AS (PARTITION BY huc_id, bridge_id)", "points")
def _(get, spark, sf):
    made = V.normalize_cloud(get("points")).withColumns({c: F.col(c) + 0.00000123 for c in "xy"})  # off the ties of rounding
    return rounded(rounded(made, ["x", "y"], 6), ["z", "intensity"], 8)


_TOTALS = "SELECT gold AS class, count(*) AS total FROM points GROUP BY gold"


def totals_of(get) -> DataFrame:
    return V.class_totals(V.cloud_metadata(get("points")))


@query("d5_class_totals", _TOTALS, "points")
def _(get, spark, sf):
    return totals_of(get)


@query("d6_class_weights", f"SELECT class, total, round((SELECT count(*) FROM points) / (4 * total), 6) AS weight FROM ({_TOTALS})", "points")
def _(get, spark, sf):
    return rounded(V.class_weights(totals_of(get)), ["weight"], 6)


@query("d7_class_distribution", f"SELECT class, total, round(100.0 * total / (SELECT count(*) FROM points), 4) AS percent FROM ({_TOTALS})", "points")
def _(get, spark, sf):
    return rounded(V.class_distribution(totals_of(get)), ["percent"])


@query("d8_imbalance_ratio", "SELECT count_if(gold = 1)::BIGINT AS ground, count_if(gold = 2)::BIGINT AS deck, round(count_if(gold = 1) / count_if(gold = 2), 6) AS ratio, count_if(gold = 1) / count_if(gold = 2) > 100 AS warn FROM points", "points")
def _(get, spark, sf):
    return rounded(V.imbalance_ratio(totals_of(get)), ["ratio"], 6)


_CELLS = "cells AS (SELECT a.range AS gold, b.range AS pred FROM range(4) a, range(4) b), keys AS (SELECT DISTINCT huc_id, bridge_id FROM points), cm AS (SELECT k.huc_id, k.bridge_id, CAST(c.gold AS INT) AS gold, CAST(c.pred AS INT) AS pred, count(p.point_idx) AS n FROM keys k CROSS JOIN cells c LEFT JOIN points p ON p.huc_id = k.huc_id AND p.bridge_id = k.bridge_id AND p.gold = c.gold AND p.pred = c.pred GROUP BY ALL)"


def with_cm(sql: str, more: str = "") -> str:
    return with_duck("", "points").rstrip() + ", " + _CELLS + more + " " + sql


def cm_of(get, predicted: str = "pred") -> DataFrame:
    points = get("points")
    other = points.select(*B, "point_idx", F.col(predicted).alias("pred"))
    return written(M.aligned_confusion(points.select(*B, "point_idx", "gold"), other))  # sixteen rows a bridge, read several times


@query("d9_confusion_matrix", with_cm("SELECT * FROM cm"))
def _(get, spark, sf):
    return cm_of(get)


def _class_sql(source: str, keys: str = "") -> str:
    k = keys + ", " if keys else ""
    g = f"GROUP BY {keys}, class" if keys else "GROUP BY class"
    return f"""SELECT {k}class, CASE WHEN p > 0 THEN tp / p ELSE 0 END AS precision, CASE WHEN g > 0 THEN tp / g ELSE 0 END AS recall,
  CASE WHEN g + p > 0 THEN 2 * tp / (g + p) ELSE 0 END AS f1, 100 * CASE WHEN g + p - tp > 0 THEN tp / (g + p - tp) ELSE 0 END AS iou, g AS support
FROM (SELECT {k}class, CAST(sum(CASE WHEN gold = class AND pred = class THEN n ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN gold = class THEN n ELSE 0 END) AS BIGINT) AS g,
  CAST(sum(CASE WHEN pred = class THEN n ELSE 0 END) AS BIGINT) AS p FROM {source}, (SELECT CAST(range AS INT) AS class FROM range(4)) {g})"""


_ROUND = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(iou, 4) AS iou, support"
_MEASURES = ["precision", "recall", "f1"]


@query("d10_class_metrics", with_cm(f"SELECT huc_id, bridge_id, class, {_ROUND} FROM ({_class_sql('cm', 'huc_id, bridge_id')})"))
def _(get, spark, sf):
    return rounded(rounded(M.class_metrics(cm_of(get), B), _MEASURES, 6), ["iou"])


@query("d11_overall_metrics", with_cm(f"SELECT huc_id, bridge_id, round(accuracy, 6) AS accuracy, n_points, round(mean_iou, 4) AS mean_iou FROM (SELECT huc_id, bridge_id, CAST(sum(n) AS BIGINT) AS n_points, sum(CASE WHEN gold = pred THEN n ELSE 0 END) / sum(n) AS accuracy FROM cm GROUP BY ALL) JOIN (SELECT huc_id, bridge_id, coalesce(avg(CASE WHEN support > 0 THEN iou END), 0) AS mean_iou FROM ({_class_sql('cm', 'huc_id, bridge_id')}) GROUP BY ALL) USING (huc_id, bridge_id)"))
def _(get, spark, sf):
    return rounded(rounded(M.overall_metrics(cm_of(get), B), ["accuracy"], 6), ["mean_iou"])


def _binary_sql() -> str:
    """All measures of both sides, from the four sums."""
    sums = ", ".join(f"sum(CASE WHEN {g} AND {p} THEN n ELSE 0 END) AS {name}" for name, g, p in (("tp", "gold = 2", "pred = 2"), ("fn", "gold = 2", "pred <> 2"), ("fp", "gold <> 2", "pred = 2"), ("tn", "gold <> 2", "pred <> 2")))
    ratio = lambda a, b, n, k=1: f"round(CASE WHEN {b} > 0 THEN {k} * {a} / ({b}) ELSE 0 END, {n})"
    made = []
    for side, t, missed, wrong in (("deck", "tp", "fn", "fp"), ("rest", "tn", "fp", "fn")):
        made += [
            f"{ratio(t, f'{t} + {wrong}', 6)} AS {side}_precision", f"{ratio(t, f'{t} + {missed}', 6)} AS {side}_recall", f"{ratio(t, f'2 * {t} + {missed} + {wrong}', 6, 2)} AS {side}_f1",
            f"{ratio(t, f'{t} + {missed} + {wrong}', 4, 100)} AS {side}_iou", f"CAST({t} + {missed} AS BIGINT) AS {side}_support",
        ]
    return f"SELECT huc_id, bridge_id, {', '.join(made)}, {ratio('(tp + tn)', 'tp + tn + fn + fp', 6)} AS binary_accuracy FROM (SELECT huc_id, bridge_id, {sums} FROM cm GROUP BY ALL)"


def _sixes(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, [c for c in df.columns if c.endswith(("precision", "recall", "f1", "accuracy"))], 6), [c for c in df.columns if c.endswith("iou")])


@query("d12_binary_metrics", with_cm(_binary_sql()))
def _(get, spark, sf):
    return _sixes(M.binary_metrics(cm_of(get), B))


_TOTAL_CM = ", total AS (SELECT gold, pred, CAST(sum(n) AS BIGINT) AS n FROM cm GROUP BY gold, pred)"


@query("d13_micro_metrics", with_cm(f"SELECT class, {_ROUND}, round((SELECT sum(CASE WHEN gold = pred THEN n ELSE 0 END) / sum(n) FROM total), 6) AS accuracy, (SELECT CAST(sum(n) AS BIGINT) FROM total) AS n_points, round((SELECT avg(iou) FROM ({_class_sql('total')}) WHERE support > 0), 4) AS mean_iou FROM ({_class_sql('total')})", _TOTAL_CM))
def _(get, spark, sf):
    return rounded(rounded(M.micro_metrics(cm_of(get)), [*_MEASURES, "accuracy"], 6), ["iou", "mean_iou"])


@query("d14_normalized_confusion", with_cm("SELECT huc_id, bridge_id, gold, pred, round(CASE WHEN sum(n) OVER w > 0 THEN 100 * n / sum(n) OVER w ELSE 0 END, 4) AS percent FROM cm WINDOW w AS (PARTITION BY huc_id, bridge_id, gold)"))
def _(get, spark, sf):
    return rounded(M.normalized_confusion(cm_of(get), B), ["percent"])


_WIDE = ", ".join(f"{'max' if m == 'support' else 'round(max'}(CASE WHEN class = {c} THEN {m} END){'' if m == 'support' else f', {4 if m == 'iou' else 6})'} AS class_{c}_{m}" for c in range(4) for m in ("precision", "recall", "f1", "iou", "support"))


@query("d15_per_bridge_metrics", with_cm(f"SELECT * FROM (SELECT huc_id, bridge_id, {_WIDE} FROM ({_class_sql('cm', 'huc_id, bridge_id')}) GROUP BY ALL) JOIN ({_binary_sql()}) USING (huc_id, bridge_id)"))
def _(get, spark, sf):
    return _sixes(M.per_bridge_metrics(cm_of(get)))


@query("c17_model_vs_baseline", with_duck("", "points").rstrip() + f", m AS (SELECT gold, pred, count(*) AS n FROM points GROUP BY ALL), b AS (SELECT gold, silver AS pred, count(*) AS n FROM points GROUP BY ALL) SELECT class, round(m1.iou, 4) AS model_iou, round(b1.iou, 4) AS baseline_iou, round(m1.iou - b1.iou, 4) AS delta FROM ({_class_sql('m')}) m1 JOIN ({_class_sql('b')}) b1 USING (class)")
def _(get, spark, sf):
    return rounded(M.model_vs_baseline(cm_of(get), cm_of(get, "silver")), ["model_iou", "baseline_iou", "delta"])


_BINARY = ["deck_precision", "deck_recall", "deck_f1", "deck_iou", "deck_support", "rest_precision", "rest_recall", "rest_f1", "rest_iou", "rest_support", "binary_accuracy"]


@query("d13_micro_binary", with_cm(f"SELECT {', '.join(_BINARY)} FROM ({_binary_sql().replace('FROM cm GROUP BY ALL', 'FROM total_cm GROUP BY ALL')})", ", total_cm AS (SELECT '' AS huc_id, '' AS bridge_id, gold, pred, CAST(sum(n) AS BIGINT) AS n FROM cm GROUP BY gold, pred)"))
def _(get, spark, sf):
    return _sixes(M.micro_binary(cm_of(get)))


@query("d14_binary_confusion", with_cm("SELECT huc_id, bridge_id, gold_deck, pred_deck, n, round(CASE WHEN sum(n) OVER w > 0 THEN 100 * n / sum(n) OVER w ELSE 0 END, 4) AS percent FROM (SELECT huc_id, bridge_id, gold = 2 AS gold_deck, pred = 2 AS pred_deck, CAST(sum(n) AS BIGINT) AS n FROM cm GROUP BY ALL) WINDOW w AS (PARTITION BY huc_id, bridge_id, gold_deck)"))
def _(get, spark, sf):
    return rounded(M.binary_confusion(cm_of(get), B), ["percent"])


def _overall_sql(name: str) -> str:
    """(metric, value) of one summed matrix."""
    s = lambda c: f"sum(CASE WHEN {c} THEN n ELSE 0 END)"
    tp, fp, fn, tn = s("gold = 2 AND pred = 2"), s("gold <> 2 AND pred = 2"), s("gold = 2 AND pred <> 2"), s("gold <> 2 AND pred <> 2")
    values = {"overall_accuracy": f"{s('gold = pred')} / sum(n)", "deck_iou": f"{tp} / ({tp} + {fp} + {fn})", "rest_iou": f"{tn} / ({tn} + {fp} + {fn})", "binary_accuracy": f"({tp} + {tn}) / sum(n)"}
    rows = [f"SELECT '{k}' AS metric, 100 * {v} AS value FROM {name}" for k, v in values.items()]
    return " UNION ALL ".join([*rows, f"SELECT 'mean_iou', avg(iou) FROM ({_class_sql(name)}) WHERE support > 0"])


@query("c17_overall_vs_baseline", with_duck("", "points").rstrip() + f", m AS (SELECT gold, pred, count(*) AS n FROM points GROUP BY ALL), b AS (SELECT gold, silver AS pred, count(*) AS n FROM points GROUP BY ALL) SELECT metric, round(x.value, 4) AS model, round(y.value, 4) AS baseline, round(x.value - y.value, 4) AS delta FROM ({_overall_sql('m')}) x JOIN ({_overall_sql('b')}) y USING (metric)")
def _(get, spark, sf):
    return rounded(M.overall_vs_baseline(cm_of(get), cm_of(get, "silver")), ["model", "baseline", "delta"])


_PLANE_POINTS = "huc_id, bridge_id, CAST(point_idx AS VARCHAR)"
PLANE_SQL = f"""centers AS (SELECT huc_id, bridge_id, avg(x) AS x_center, avg(y) AS y_center, count(*) AS n_points FROM points GROUP BY ALL),
centred AS (SELECT p.huc_id, p.bridge_id, point_idx, z, x - x_center AS cx, y - y_center AS cy FROM points p JOIN centers USING (huc_id, bridge_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY huc_id, bridge_id, round ORDER BY md5(concat_ws('|', '27', CAST(round AS VARCHAR), {_PLANE_POINTS})), point_idx) - 1 AS rk FROM centred, (SELECT range AS round FROM range(4))),
sums AS (SELECT huc_id, bridge_id, round, rk // 10 AS block, CAST(count(*) AS DOUBLE) AS n, sum(cx) AS sx, sum(cy) AS sy, sum(z) AS sz, sum(cx * cx) AS xx, sum(cy * cy) AS yy, sum(cx * cy) AS xy, sum(cx * z) AS xz, sum(cy * z) AS yz FROM ranked WHERE rk // 10 < 25 GROUP BY ALL HAVING count(*) = 10),
solved AS (SELECT *, xx - sx * sx / n AS sxx, yy - sy * sy / n AS syy, xy - sx * sy / n AS sxy, xz - sx * sz / n AS sxz, yz - sy * sz / n AS syz FROM sums),
planes AS (SELECT huc_id, bridge_id, round, block, (sxz * syy - syz * sxy) / (sxx * syy - sxy * sxy) AS a, (syz * sxx - sxz * sxy) / (sxx * syy - sxy * sxy) AS b, n, sx, sy, sz FROM solved WHERE abs(sxx * syy - sxy * sxy) >= 1e-9),
votes AS MATERIALIZED (SELECT huc_id, bridge_id, round, block, a, b, c, count_if(abs(z - a * cx - b * cy - c) <= 0.20) AS votes FROM (SELECT *, (sz - a * sx - b * sy) / n AS c FROM planes) JOIN centred USING (huc_id, bridge_id) GROUP BY ALL),
best AS (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY huc_id, bridge_id ORDER BY votes DESC, round, block) = 1),
again AS (SELECT q.huc_id, q.bridge_id, CAST(count(*) AS DOUBLE) AS n, sum(cx) AS sx, sum(cy) AS sy, sum(z) AS sz, sum(cx * cx) AS xx, sum(cy * cy) AS yy, sum(cx * cy) AS xy, sum(cx * z) AS xz, sum(cy * z) AS yz FROM centred q JOIN best USING (huc_id, bridge_id) WHERE abs(z - a * cx - b * cy - c) <= 0.20 GROUP BY ALL),
refit AS (SELECT huc_id, bridge_id, n, sx, sy, sz, ((xz - sx * sz / n) * (yy - sy * sy / n) - (yz - sy * sz / n) * (xy - sx * sy / n)) / ((xx - sx * sx / n) * (yy - sy * sy / n) - (xy - sx * sy / n) * (xy - sx * sy / n)) AS a,
  ((yz - sy * sz / n) * (xx - sx * sx / n) - (xz - sx * sz / n) * (xy - sx * sy / n)) / ((xx - sx * sx / n) * (yy - sy * sy / n) - (xy - sx * sy / n) * (xy - sx * sy / n)) AS b FROM again),
final AS (SELECT huc_id, bridge_id, a, b, (sz - a * sx - b * sy) / n AS c FROM refit)"""


@query("d16_plane_consensus", with_duck("", "points").rstrip() + ", " + PLANE_SQL + " SELECT f.huc_id, f.bridge_id, round(a, 3) AS a, round(b, 3) AS b, round(c, 3) AS c, count_if(abs(z - a * cx - b * cy - c) <= 0.20)::BIGINT AS n_inliers, any_value(n_points) AS n_points FROM final f JOIN centred USING (huc_id, bridge_id) JOIN centers USING (huc_id, bridge_id) GROUP BY f.huc_id, f.bridge_id, a, b, c")
def _(get, spark, sf):
    return rounded(P.plane_consensus(get("points")).drop("x_center", "y_center"), ["a", "b", "c"], 3)


@query("d17_plane_residuals", with_duck("", "points").rstrip() + ", " + PLANE_SQL + " SELECT huc_id, bridge_id, point_idx, round(z - a * cx - b * cy - c, 3) + 0 AS residual, abs(z - a * cx - b * cy - c) <= 0.20 AS inlier FROM final JOIN centred USING (huc_id, bridge_id)")
def _(get, spark, sf):
    points = get("points")
    return rounded(P.plane_residuals(points, P.plane_consensus(points)).select(*B, "point_idx", "residual", "inlier"), ["residual"], 3).withColumn("residual", F.col("residual") + 0.0)  # no minus zero


@query("d18_inlier_rmse", with_duck("", "points").rstrip() + ", " + PLANE_SQL + " SELECT huc_id, bridge_id, count_if(abs(d) <= 0.20)::BIGINT AS n_inliers, round(sqrt(avg(CASE WHEN abs(d) <= 0.20 THEN d * d END)), 4) AS rmse, sqrt(avg(CASE WHEN abs(d) <= 0.20 THEN d * d END)) > 0.05 AS rejected FROM (SELECT huc_id, bridge_id, z - a * cx - b * cy - c AS d FROM final JOIN centred USING (huc_id, bridge_id)) GROUP BY ALL")
def _(get, spark, sf):
    points = get("points")
    return rounded(P.inlier_rmse(P.plane_residuals(points, P.plane_consensus(points)), 0.05), ["rmse"])


AXIS_SQL = """shape AS (SELECT huc_id, bridge_id, avg(x) AS mx, avg(y) AS my, 0.5 * atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) AS t FROM points GROUP BY ALL),
placed AS (SELECT p.*, (x - mx) * cos(t) + (y - my) * sin(t) AS axis FROM points p JOIN shape USING (huc_id, bridge_id)),
span AS (SELECT huc_id, bridge_id, min(axis) AS lo, max(axis) AS hi, count(*) AS n_all FROM placed GROUP BY ALL),
binned AS (SELECT huc_id, bridge_id, z, lo, (hi - lo) / 10 AS width, least(CAST(floor((axis - lo) / ((hi - lo) / 10)) AS INT), 9) AS bin FROM placed JOIN span USING (huc_id, bridge_id) WHERE n_all >= 50 AND hi - lo >= 5 AND axis < hi),
medians AS (SELECT huc_id, bridge_id, bin, median(z) AS mz, max(lo + (bin + CAST(0.5 AS DOUBLE)) * width) AS pos FROM binned GROUP BY ALL HAVING count(*) >= 5),
line AS (SELECT huc_id, bridge_id, regr_slope(mz, pos) AS k, regr_intercept(mz, pos) AS m FROM medians GROUP BY ALL HAVING count(*) >= 3)"""


@query("d20_principal_axis", with_duck("", "points").rstrip() + ", " + AXIS_SQL + " SELECT huc_id, bridge_id, point_idx, round(abs(axis), 3) AS off_center FROM placed")
def _(get, spark, sf):
    return P.principal_axis(get("points")).select(*B, "point_idx", r(F.abs("axis"), 3).alias("off_center"))


@query("d21_linearity_check", with_duck("", "points").rstrip() + ", " + AXIS_SQL + " SELECT huc_id, bridge_id, round(coalesce(d, 0), 3) AS deviation, coalesce(d, 0) > 0.35 AS curved FROM span LEFT JOIN (SELECT huc_id, bridge_id, max(abs(mz - k * pos - m)) AS d FROM medians JOIN line USING (huc_id, bridge_id) GROUP BY ALL) USING (huc_id, bridge_id)")
def _(get, spark, sf):
    return P.linearity_check(get("points")).withColumn("deviation", round_scaled(F.col("deviation"), 3))


@query("d22_weak_labels", with_duck("", "points").rstrip() + ", " + PLANE_SQL + " SELECT huc_id, bridge_id, label, count(*) AS n FROM (SELECT p.huc_id, p.bridge_id, CASE WHEN d > 0.20 AND d < 15 AND x BETWEEN 2 AND 22 THEN 18 WHEN d >= -0.70 AND d <= 0.20 AND x BETWEEN 2 AND 22 THEN 17 ELSE classification END AS label FROM (SELECT q.*, z - a * (x - x_center) - b * (y - y_center) - c AS d FROM points q JOIN final USING (huc_id, bridge_id) JOIN centers USING (huc_id, bridge_id)) p) GROUP BY ALL")
def _(get, spark, sf):
    points = get("points")
    labelled = P.band_labels(P.plane_residuals(points, P.plane_consensus(points)), F.col("x").between(2, 22))
    return labelled.groupBy(*B, "label").agg(F.count(F.lit(1)).alias("n"))


GATE_SQL = (
    AXIS_SQL.replace("FROM points p JOIN shape", "FROM inliers p JOIN shape").replace("FROM points GROUP BY ALL", "FROM inliers GROUP BY ALL")
    + """, flat AS (SELECT huc_id, bridge_id, count(*) AS n_inliers, sqrt(avg(d * d)) AS rmse, var_pop(x) * var_pop(y) - pow(covar_pop(x, y), 2) AS area FROM inliers GROUP BY ALL),
bends AS (SELECT huc_id, bridge_id, max(abs(mz - k * pos - m)) AS d FROM medians JOIN line USING (huc_id, bridge_id) GROUP BY ALL),
everything AS (SELECT huc_id, bridge_id, count(*) AS n_points, count(DISTINCT (x, y)) AS n_xy FROM points GROUP BY ALL),
asked AS (SELECT huc_id, bridge_id FROM everything UNION ALL SELECT '99999999', CAST(n_nationkey AS VARCHAR) FROM nation)"""
)


@query("d23_quality_gate", with_duck("", "points").rstrip() + ", " + PLANE_SQL + ", inliers AS (SELECT p.*, z - a * (x - x_center) - b * (y - y_center) - c AS d FROM points p JOIN final USING (huc_id, bridge_id) JOIN centers USING (huc_id, bridge_id) WHERE abs(z - a * (x - x_center) - b * (y - y_center) - c) <= 0.20), " + GATE_SQL + """
SELECT huc_id, bridge_id, coalesce(n_points, 0) AS n_points, n_inliers, round(rmse, 3) AS rmse, CASE WHEN n_inliers IS NOT NULL THEN round(coalesce(d, 0), 3) END AS deviation,
  CASE WHEN n_points IS NULL THEN 'no_points' WHEN n_points < 20 OR n_xy < 10 THEN 'ransac_insufficient' WHEN n_inliers IS NULL THEN 'ransac_failed' WHEN n_inliers < 20 THEN 'ransac_low_inliers' WHEN NOT area > 1e-9 THEN 'hull_failed'
  WHEN rmse > 0.06 THEN 'high_rmse' WHEN coalesce(d, 0) > 0.05 THEN 'curved' ELSE 'success' END AS status
FROM asked LEFT JOIN everything USING (huc_id, bridge_id) LEFT JOIN flat USING (huc_id, bridge_id) LEFT JOIN bends USING (huc_id, bridge_id)""")
def _(get, spark, sf):
    points = get("points")
    empty = get("nation").select(F.lit("99999999").alias("huc_id"), F.col("n_nationkey").cast("string").alias("bridge_id"))
    gate = P.quality_gate(points, points.select(*B).unionByName(empty), 0.06, 0.05)
    return gate.withColumns({c: round_scaled(F.col(c), 3) for c in ("rmse", "deviation")})


@query("d25_huc_inventory", "SELECT coalesce(huc_id, 'total') AS huc_id, count(*) AS bridges, count_if(has_lidar_tif = 'Y')::BIGINT AS with_lidar, count_if(has_lidar_tif = 'N')::BIGINT AS without_lidar FROM bridges GROUP BY ROLLUP (huc_id)", "bridges")
def _(get, spark, sf):
    return R.huc_inventory(get("bridges"))


@query("d25_huc_totals", "WITH per AS (SELECT lpad(CAST(n_nationkey + 20 AS VARCHAR), 8, '0') AS asked, count(osmid) AS n, count_if(has_lidar_tif = 'Y') AS y, count_if(has_lidar_tif = 'N') AS o FROM nation LEFT JOIN bridges ON huc_id = lpad(CAST(n_nationkey + 20 AS VARCHAR), 8, '0') GROUP BY ALL) SELECT count_if(n > 0)::BIGINT AS processed, count_if(n = 0)::BIGINT AS skipped_missing, sum(n)::BIGINT AS total_bridges, sum(y)::BIGINT AS lidar_bridges, count_if(y > 0)::BIGINT AS hucs_with_lidar, sum(o)::BIGINT AS not_lidar_bridges, count_if(o > 0)::BIGINT AS hucs_with_not_lidar FROM per".replace("WITH per AS", ", per AS", 1), "bridges")
def _(get, spark, sf):
    asked = get("nation").select(F.lpad((F.col("n_nationkey") + 20).cast("string"), 8, "0").alias("huc_id"))  # some are not there
    return R.huc_totals(get("bridges"), asked)


@query("d26_run_summary", "SELECT bridge_type, count(*) AS total, count_if(has_lidar_tif = 'Y' OR CAST(osmid AS BIGINT) % 3 = 0)::BIGINT AS success, count_if(NOT (has_lidar_tif = 'Y' OR CAST(osmid AS BIGINT) % 3 = 0))::BIGINT AS failed, count_if(CAST(osmid AS BIGINT) % 3 = 0)::BIGINT AS skipped FROM bridges GROUP BY ALL", "bridges")
def _(get, spark, sf):
    status = F.when(F.expr("CAST(osmid AS BIGINT) % 3 = 0"), "skipped").when(F.col("has_lidar_tif") == "Y", "success").otherwise("timeout")
    return R.run_summary(get("bridges").withColumn("status", status), ["bridge_type"])


_PARSED = "(SELECT event_id, user_id % 10 AS child, event_type, CASE WHEN event_type = 'purchase' THEN floor(abs(value)) + 0.25 END AS seconds FROM events)"


@query("d27_child_summaries", f"SELECT CAST(child AS INT) AS child, count_if(event_type = 'purchase')::BIGINT AS ok, count_if(event_type = 'error')::BIGINT AS failed, count_if(event_type = 'click')::BIGINT AS \"exists\", count_if(event_type NOT IN ('purchase', 'error', 'click', 'view'))::BIGINT AS small, round(coalesce(sum(seconds), 0), 2) AS seconds FROM {_PARSED} GROUP BY child")
def _(get, spark, sf):
    return rounded(R.child_summaries(get("run_logs")), ["seconds"], 2)


_CHILDREN = "(SELECT CAST(user_id % 10 AS INT) AS child, count_if(event_type = 'purchase') AS succeeded, count_if(event_type = 'error') AS failed, count_if(event_type = 'click') AS skipped_exists, count_if(event_type = 'signup') AS skipped_too_few_points, count_if(event_type = 'view') AS download_failed, count(*) AS total, sum(event_id % 97) AS wall_clock_seconds FROM events GROUP BY ALL)"
_COUNTERS = ["succeeded", "failed", "skipped_exists", "skipped_too_few_points", "download_failed", "total", "wall_clock_seconds"]
_HOURS = "floor(wall_clock_seconds * CAST(10000 AS DOUBLE) / 3600) / 10000"


def _logs(get) -> DataFrame:
    return get("run_logs").select("line_no", "line").unionByName(get("summaries"))


@query("d27_summary_totals", " UNION ALL ".join(f"SELECT '{c}' AS counter, CAST(sum({c}) AS DOUBLE) AS total, count(*) AS lines FROM {_CHILDREN}" for c in _COUNTERS) + f" UNION ALL SELECT 'wall_clock_hours', round(sum({_HOURS}), 6), count(*) FROM {_CHILDREN}")
def _(get, spark, sf):
    return rounded(R.summary_totals(_logs(get)), ["total"], 6)


@query("d27_child_reports", f"SELECT CAST(i AS INT) AS child, true AS expected, CAST(CASE WHEN total IS NULL THEN 0 ELSE 1 END AS BIGINT) AS lines, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _COUNTERS)}, round({_HOURS}, 6) AS wall_clock_hours FROM (SELECT unnest(range(12)) AS i) LEFT JOIN {_CHILDREN} ON child = i")
def _(get, spark, sf):
    return rounded(R.child_reports(_logs(get), 12), ["wall_clock_hours"], 6)


@query("d27_child_timing", f"SELECT count(*) AS children_reported, CAST(12 AS BIGINT) AS children_expected, CAST(min(wall_clock_seconds) AS DOUBLE) AS min_seconds, CAST(max(wall_clock_seconds) AS DOUBLE) AS max_seconds, round(avg(wall_clock_seconds), 1) AS avg_seconds, round(sum(wall_clock_seconds) / 3600, 4) AS total_child_hours FROM {_CHILDREN}")
def _(get, spark, sf):
    return R.child_timing(_logs(get), 12)


@query("d28_bridge_timing", f"WITH s AS (SELECT list_sort(list(seconds)) AS v, count(*) AS n, avg(seconds) AS m FROM {_PARSED} WHERE seconds IS NOT NULL) SELECT n AS count, round(m, 1) AS avg, round(v[CAST(least(floor(n * 50 / 100), n - 1) AS BIGINT) + 1], 1) AS p50, round(v[CAST(least(floor(n * 95 / 100), n - 1) AS BIGINT) + 1], 1) AS p95, round(v[1], 1) AS min, round(v[-1], 1) AS max FROM s")
def _(get, spark, sf):
    return R.bridge_timing(get("run_logs"))


@query("d29_failures_by_reason", "SELECT CASE WHEN event_id % 2 = 0 THEN 'timeout' ELSE 'inference_error' END AS reason, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL")
def _(get, spark, sf):
    return R.failures_by_reason(get("run_logs"))


@query("d29_seconds_by_child", f"SELECT CAST(child AS INT) AS child, round(avg(seconds), 4) AS avg_seconds, max(seconds) AS max_seconds, count(*) AS n FROM {_PARSED} WHERE seconds IS NOT NULL GROUP BY child")
def _(get, spark, sf):
    return rounded(R.seconds_by_child(get("run_logs")), ["avg_seconds"])


@query("d30_cost_estimate", f"SELECT count(*) AS children, round(sum(s) / 3600, 4) AS hours, round(sum(s) / 3600 * 0.234, 4) AS cost FROM (SELECT child, coalesce(sum(seconds), 0) AS s FROM {_PARSED} GROUP BY child)")
def _(get, spark, sf):
    return rounded(R.cost_estimate(R.child_summaries(get("run_logs"))), ["hours", "cost"])


@query("d30_planned_cost", "SELECT size AS array_size, ceil(n / size)::BIGINT AS chunk, round(ceil(n / size) * 90 / 3600, 4) AS hours_per_child, round(size * (ceil(n / size) * 90 / 3600) * CAST(0.234 AS DOUBLE), 4) AS cost FROM (SELECT count(*) AS n, CASE WHEN count(*) <= 60 THEN 1 ELSE least(ceil(count(*) / 60), 10000)::BIGINT END AS size FROM bridges)", "bridges")
def _(get, spark, sf):
    lines = get("bridges").select("osmid", F.col("osmid").cast("long").alias("line_no"))
    return rounded(R.planned_cost(E.manifest_chunks(lines)), ["hours_per_child", "cost"])


@query("d31_split_stats", with_splits("SELECT coalesce(split, 'all') AS split, count(*) AS n_rows, count(DISTINCT huc_id) AS n_hucs FROM used_splits GROUP BY ROLLUP (split)"))
def _(get, spark, sf):
    return E.split_stats(splits_of(get))


@query("d33_source_pair_stats", f"SELECT has_lidar_tif, count(n) AS with_source, count_if(n IS NULL)::BIGINT AS without_source, CAST(coalesce(sum(n), 0) AS BIGINT) AS pairs FROM bridges LEFT JOIN (SELECT huc_id, osmid, count(*) AS n FROM ({_PAIRS}) GROUP BY ALL) USING (huc_id, osmid) GROUP BY ALL", "bridges", "sources")
def _(get, spark, sf):
    return S.source_pair_stats(get("bridges"), pairs_of(get))


@query("d34_robust_bounds", "SELECT round(minx, 3) AS minx, round(miny, 3) AS miny, round(maxx, 3) AS maxx, round(maxy, 3) AS maxy, round((maxx - minx) / (maxy - miny), 4) AS aspect FROM (SELECT quantile_cont(least(x0, x1), 0.01) AS minx, quantile_cont(greatest(x0, x1), 0.99) AS maxx, quantile_cont(least(y0, y1), 0.01) AS miny, quantile_cont(greatest(y0, y1), 0.99) AS maxy FROM bridges)", "bridges")
def _(get, spark, sf):
    boxes = get("bridges").select(F.least("x0", "x1").alias("minx"), F.greatest("x0", "x1").alias("maxx"), F.least("y0", "y1").alias("miny"), F.greatest("y0", "y1").alias("maxy"))
    return rounded(rounded(R.robust_bounds(boxes), ["minx", "miny", "maxx", "maxy"], 3), ["aspect"])


@query("d35_epoch_metrics", _EPOCHS, "metrics")
def _(get, spark, sf):
    return epochs_of(get)


@query("d36_batch_deck_metrics", "SELECT CAST(CAST(bridge_id AS BIGINT) % 8 AS BIGINT) AS batch_no, count(*) AS n, round(count_if(gold = 2 AND pred = 2) / count_if(gold = 2), 6) AS recall, round(count_if(gold = 2 AND pred = 2) / count_if(pred = 2), 6) AS precision, round(count_if(gold = 2 AND pred = 2) / count_if(gold = 2 OR pred = 2), 6) AS iou, round(count_if(gold = pred) / count(*), 6) AS accuracy FROM points GROUP BY ALL", "points")
def _(get, spark, sf):
    made = M.batch_deck_metrics(get("points"), F.expr("CAST(bridge_id AS BIGINT) % 8"))
    return rounded(made, ["recall", "precision", "iou", "accuracy"], 6)


@query("d36_epoch_deck_metrics", "WITH b AS (SELECT CAST(bridge_id AS BIGINT) % 8 AS batch_no, count(DISTINCT bridge_id) AS clouds, count_if(gold = 2 AND pred = 2) / count_if(gold = 2) AS recall, count_if(gold = 2 AND pred = 2) / count_if(pred = 2) AS precision, count_if(gold = 2 AND pred = 2) / count_if(gold = 2 OR pred = 2) AS iou, count_if(gold = pred) / count(*) AS accuracy FROM points GROUP BY ALL) SELECT CAST(batch_no % 2 AS BIGINT) AS epoch, count(*) AS batches, round(sum(recall * clouds) / sum(clouds), 6) AS recall, round(sum(precision * clouds) / sum(clouds), 6) AS precision, round(sum(iou * clouds) / sum(clouds), 6) AS iou, round(sum(accuracy * clouds) / sum(clouds), 6) AS accuracy FROM b GROUP BY ALL".replace("WITH b AS", ", b AS", 1), "points")
def _(get, spark, sf):
    points, number = get("points"), F.expr("CAST(bridge_id AS BIGINT) % 8")
    clouds = points.select(*B, number.alias("batch_no")).distinct().groupBy("batch_no").agg(F.count(F.lit(1)).alias("clouds"))
    batches = M.batch_deck_metrics(points, number).join(clouds, "batch_no").withColumn("epoch", F.col("batch_no") % 2)
    return rounded(M.epoch_deck_metrics(batches, "clouds", ["epoch"]), ["recall", "precision", "iou", "accuracy"], 6)


_P = "list_transform(l, lambda x: exp(x - list_max(l)) / list_sum(list_transform(l, lambda y: exp(y - list_max(l)))))"


@query("d37_loss_scores", f"""WITH rows AS (SELECT label % 4 AS label, list_transform(embedding[1:4], lambda v: CAST(v AS DOUBLE)) AS l FROM embeddings), p AS (SELECT label, {_P} AS p, [CAST(6.22 AS DOUBLE), 1.49, 0.36, 2.34][label + 1] AS w FROM rows),
s AS (SELECT -sum(w * ln(p[label + 1])) / sum(w) AS ce, {", ".join(f"(2 * sum(CASE WHEN label = {c} THEN p[{c + 1}] ELSE 0 END) + 1) / (sum(p[{c + 1}]) + count_if(label = {c}) + 1) AS d{c}" for c in range(4))} FROM p)
SELECT round(ce, 6) AS cross_entropy, round(1 - (d0 + d1 + d2 + d3) / 4, 6) AS dice_loss, round(0.5 * ce + 0.5 * (1 - (d0 + d1 + d2 + d3) / 4), 6) AS combined_loss FROM s""")
def _(get, spark, sf):
    rows = get("embeddings").select((F.col("label") % 4).alias("label"), F.slice("embedding", 1, 4).cast("array<double>").alias("logits"))
    return rounded(M.loss_scores(rows, (6.22, 1.49, 0.36, 2.34)), ["cross_entropy", "dice_loss", "combined_loss"], 6)


@query("d38_voxel_compression", with_majority("SELECT huc_id, bridge_id, n_points, n_voxels, round(n_points / n_voxels, 4) AS ratio, round(ps, 4) AS points_share_2, round(vs, 4) AS voxels_share_2 FROM (SELECT huc_id, bridge_id, count(*) AS n_points, avg(CASE WHEN gold = 2 THEN 1.0 ELSE 0 END) AS ps FROM points GROUP BY ALL) JOIN (SELECT huc_id, bridge_id, count(*) AS n_voxels, avg(CASE WHEN label = 2 THEN 1.0 ELSE 0 END) AS vs FROM majority GROUP BY ALL) USING (huc_id, bridge_id)"))
def _(get, spark, sf):
    made = V.voxel_compression(get("points"), 1.0).select(*B, "n_points", "n_voxels", "ratio", "points_share_2", "voxels_share_2")
    return rounded(made, ["ratio", "points_share_2", "voxels_share_2"])


@query("d39_subset_verify", "SELECT huc_id, count_if(has_lidar_tif = 'Y')::BIGINT AS expected, count_if(has_lidar_tif = 'Y' AND NOT (huc_id IN ('00000003', '00000004') AND CAST(osmid AS BIGINT) % 2 = 0))::BIGINT AS found, CASE WHEN bool_or(has_lidar_tif = 'Y' AND huc_id IN ('00000003', '00000004') AND CAST(osmid AS BIGINT) % 2 = 0) THEN 'FAIL' ELSE 'PASS' END AS verdict, CASE WHEN bool_or(has_lidar_tif = 'Y' AND huc_id IN ('00000003', '00000004') AND CAST(osmid AS BIGINT) % 2 = 0) THEN concat('count mismatch: expected ', count_if(has_lidar_tif = 'Y'), ', got ', count_if(has_lidar_tif = 'Y' AND NOT (huc_id IN ('00000003', '00000004') AND CAST(osmid AS BIGINT) % 2 = 0))) ELSE 'OK' END AS message FROM bridges GROUP BY huc_id HAVING count_if(has_lidar_tif = 'Y') > 0", "bridges")
def _(get, spark, sf):
    bridges = get("bridges")
    damaged = bridges.where("has_lidar_tif = 'Y' AND NOT (huc_id IN ('00000003', '00000004') AND CAST(osmid AS BIGINT) % 2 = 0)")
    return R.subset_verify(bridges, damaged)


@query("d40_thin_by_resolution", f"SELECT huc_id, bridge_id, point_idx, round(x, 4) AS x FROM (SELECT *, row_number() OVER (PARTITION BY huc_id, bridge_id, floor(x), floor(y), floor(z) ORDER BY md5(concat_ws('|', '27', {_PLANE_POINTS})), point_idx) AS k FROM points) WHERE k = 1", "points")
def _(get, spark, sf):
    return rounded(V.thin_by_resolution(get("points"), 1.0).select(*B, "point_idx", "x"), ["x"])


# ---- E: windows, samples, splits ----------------------------------------------------------


@query("e1_deterministic_order", f"SELECT huc_id, bridge_id, point_idx, row_number() OVER (PARTITION BY huc_id, bridge_id ORDER BY md5(concat_ws('|', '27', {_PLANE_POINTS})), point_idx) - 1 AS shuffled_idx FROM points", "points")
def _(get, spark, sf):
    return E.deterministic_order(get("points")).select(*B, "point_idx", "shuffled_idx")


@query("e2_stratified_split", with_splits("SELECT huc_id, osmid, split FROM used_splits"))
def _(get, spark, sf):
    return splits_of(get).select("huc_id", "osmid", "split")


@query("e3_split_ratios", with_duck("", "bridges").rstrip() + f" SELECT huc_id, osmid, CASE WHEN rk <= floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' WHEN rk <= floor(CAST(0.8 AS DOUBLE) * n) + floor(CAST(0.09999999999999998 AS DOUBLE) * n) THEN 'val' ELSE 'test' END AS split FROM (SELECT *, row_number() OVER (PARTITION BY huc_id ORDER BY {_HASH}, osmid) AS rk, count(*) OVER (PARTITION BY huc_id) AS n FROM bridges)")
def _(get, spark, sf):
    return E.stratified_split(get("bridges"), *E.split_ratios(train=0.8)).select("huc_id", "osmid", "split")


@query("e4_round_robin_sample", f"SELECT huc_id, osmid FROM (SELECT *, row_number() OVER (PARTITION BY huc_id ORDER BY {_HASH}, osmid) AS rk FROM bridges) WHERE rk <= 3 ORDER BY rk, md5(concat_ws('|', '27', huc_id)), huc_id LIMIT 40", "bridges")
def _(get, spark, sf):
    return E.round_robin_sample(get("bridges"), 40, 3).select("huc_id", "osmid")


_GROUPS = "(SELECT huc_id FROM (SELECT DISTINCT huc_id FROM bridges) ORDER BY md5(concat_ws('|', '27', huc_id)), huc_id LIMIT 5)"


@query("e5_two_stage_sample", f"SELECT huc_id, osmid FROM (SELECT *, row_number() OVER (PARTITION BY huc_id ORDER BY {_HASH}, osmid) AS rk FROM bridges WHERE huc_id IN {_GROUPS}) WHERE rk <= 4", "bridges")
def _(get, spark, sf):
    return E.two_stage_sample(get("bridges"), 5, 4).select("huc_id", "osmid")


@query("e6_dedupe_max", "SELECT huc_id, osm_id, max_deviation, line_no FROM (SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS huc_id, CAST(event_id % 500 AS VARCHAR) AS osm_id, floor(abs(value)) + 0.375 AS max_deviation, event_id AS line_no FROM events WHERE event_type = 'error') QUALIFY row_number() OVER (PARTITION BY huc_id, osm_id ORDER BY max_deviation DESC, line_no) = 1")
def _(get, spark, sf):
    return E.dedupe_max(C.parse_curved_log(get("curved_logs")).drop("line", "source"), ["huc_id", "osm_id"], "max_deviation", "line_no")


@query("e7_dedupe_first", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def _(get, spark, sf):
    return E.dedupe_first(get("events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id")


@query("e8_cap_voxels", f"SELECT huc_id, bridge_id, vx, vy, vz FROM (SELECT *, row_number() OVER (PARTITION BY huc_id, bridge_id ORDER BY md5(concat_ws('|', '27', huc_id, bridge_id, CAST(vx AS VARCHAR), CAST(vy AS VARCHAR), CAST(vz AS VARCHAR))), vx, vy, vz) AS k FROM (SELECT DISTINCT huc_id, bridge_id, {_VOX} FROM points)) WHERE k <= 100", "points")
def _(get, spark, sf):
    return E.cap_per_group(V.voxelize(get("points"), 1.0), 100, B, ["vx", "vy", "vz"]).select(*B, "vx", "vy", "vz")


@query("e9_downsample", f"SELECT huc_id, bridge_id, point_idx FROM (SELECT *, row_number() OVER (PARTITION BY huc_id, bridge_id ORDER BY md5(concat_ws('|', '27', {_PLANE_POINTS})), point_idx) AS k FROM points) WHERE k <= 50", "points")
def _(get, spark, sf):
    return E.cap_per_group(get("points"), 50, B, ["point_idx"]).select(*B, "point_idx")


@query("e10_assemble_batches", f"WITH points_ AS (SELECT DISTINCT huc_id, bridge_id, {_VOX} FROM points), b AS (SELECT *, row_number() OVER (ORDER BY huc_id, bridge_id) - 1 AS i FROM (SELECT huc_id, bridge_id, count(*) AS n_voxels FROM points_ GROUP BY huc_id, bridge_id)) SELECT huc_id, bridge_id, vx, vy, vz, n_voxels, CAST(i // 4 AS INT) AS batch_no, CAST(i % 4 AS INT) AS batch_slot FROM points_ JOIN b USING (huc_id, bridge_id)".replace("WITH points_ AS", ", points_ AS", 1))
def _(get, spark, sf):
    voxels = V.voxelize(get("points"), 1.0).select(*B, "vx", "vy", "vz")
    return E.assemble_batches(voxels, 4)


ORACLE_SQL["e10_assemble_batches"] = with_duck("", "points").rstrip() + ORACLE_SQL["e10_assemble_batches"]


@query("e11_manifest_chunks", "SELECT osmid, CASE WHEN n <= 60 THEN 1 ELSE ceil(n / 60)::BIGINT END AS array_size, CAST((i - 1) // ceil(n / CASE WHEN n <= 60 THEN 1 ELSE ceil(n / 60) END)::BIGINT AS BIGINT) AS child FROM (SELECT osmid, row_number() OVER (ORDER BY CAST(osmid AS BIGINT)) AS i, count(*) OVER () AS n FROM bridges)", "bridges")
def _(get, spark, sf):
    lines = get("bridges").select("osmid", F.col("osmid").cast("long").alias("line_no"))
    return E.manifest_chunks(lines).select("osmid", "array_size", "child")


@query("e12_best_epoch", f"SELECT epoch, train_loss_epoch, val_loss, val_deck_iou FROM ({_EPOCHS}) WHERE val_deck_iou IS NOT NULL ORDER BY val_deck_iou DESC, epoch LIMIT 1", "metrics")
def _(get, spark, sf):
    return T.best_epoch(epochs_of(get), "val_deck_iou")


@query("e13_epoch_progression", f"SELECT epoch, train_loss_epoch, val_loss, val_deck_iou FROM (SELECT *, row_number() OVER (ORDER BY epoch) - 1 AS i, count(*) OVER () AS n FROM ({_EPOCHS})) WHERE n <= 5 OR i IN (0, round_even((n - 1) / 4, 0)::INT, round_even((n - 1) / 2, 0)::INT, round_even(3 * (n - 1) / 4, 0)::INT, n - 1)", "metrics")
def _(get, spark, sf):
    return T.epoch_progression(epochs_of(get))


@query("e16_shuffle_tasks", f"SELECT huc_id, osmid, row_number() OVER (ORDER BY {_HASH}, osmid) AS place FROM bridges", "bridges")
def _(get, spark, sf):
    return E.numbered(get("bridges"), [C.hash_order(27, "huc_id", "osmid"), F.col("osmid")], "place").select("huc_id", "osmid", "place")


@query("e17_sample_groups", f"SELECT huc_id, osmid FROM bridges WHERE huc_id IN {_GROUPS}", "bridges")
def _(get, spark, sf):
    return E.sample_groups(get("bridges"), 5).select("huc_id", "osmid")


@query("e18_random_val_split", "SELECT osmid, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '27', osmid)), osmid) <= floor(CAST(0.1 AS DOUBLE) * count(*) OVER ()) THEN 'val' ELSE 'train' END AS split FROM bridges", "bridges")
def _(get, spark, sf):
    return E.random_val_split(get("bridges"), 0.1, "osmid").select("osmid", "split")


# ---- F, G: order, limits, sets ------------------------------------------------------------


@query("f1_sorted_results", "SELECT huc_id, osmid, name FROM bridges", "bridges")
def _(get, spark, sf):
    return get("bridges").select("huc_id", "osmid", "name").orderBy("huc_id", "osmid")


@query("f2_first_hucs", "SELECT huc_id, osmid FROM bridges WHERE huc_id IN (SELECT DISTINCT huc_id FROM bridges ORDER BY huc_id LIMIT 3)", "bridges")
def _(get, spark, sf):
    bridges = get("bridges")
    first = bridges.select("huc_id").distinct().orderBy("huc_id").limit(3)
    return bridges.join(F.broadcast(first), "huc_id", "left_semi").select("huc_id", "osmid")  # three rows


@query("f3_capped_missing", "SELECT (SELECT string_agg(line, ' ' ORDER BY line) FROM (SELECT osmid AS line FROM bridges WHERE CAST(osmid AS BIGINT) % 7 = 0 ORDER BY line LIMIT 20)) AS lines, count(*) AS total, count(*) > 20 AS truncated FROM bridges WHERE CAST(osmid AS BIGINT) % 7 = 0", "bridges")
def _(get, spark, sf):
    return R.capped_missing(get("bridges").where("CAST(osmid AS BIGINT) % 7 = 0").select(F.col("osmid").alias("line")), 20)


@query("f4_id_lists", "SELECT string_agg(DISTINCT huc_id, ' ' ORDER BY huc_id) AS hucs FROM bridges", "bridges")
def _(get, spark, sf):
    return get("bridges").agg(F.array_join(F.array_sort(F.collect_set("huc_id")), " ").alias("hucs"))


@query("f4_sample_id_lists", f"SELECT string_agg(DISTINCT huc_id, ' ' ORDER BY huc_id) AS hucs, string_agg(DISTINCT osmid, ' ' ORDER BY osmid) AS osm_ids FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY huc_id ORDER BY {_HASH}, osmid) AS rk FROM bridges) WHERE rk <= 3 ORDER BY rk, md5(concat_ws('|', '27', huc_id)), huc_id LIMIT 40)", "bridges")
def _(get, spark, sf):
    return R.id_lists(E.round_robin_sample(get("bridges"), 40, 3))


@query("g1_used_ids_union", with_splits("SELECT DISTINCT bridge_stem, osmid AS osm_id FROM used_splits"))
def _(get, spark, sf):
    splits = splits_of(get)
    return E.used_ids(splits.unionByName(splits))


@query("g2_merge_resumed_runs", f"WITH e AS ({_EPOCHS}) SELECT epoch, val_loss FROM e WHERE epoch <= 12 UNION ALL SELECT epoch, val_loss + 1 FROM e WHERE epoch > 12 AND epoch >= 8".replace("WITH e AS", ", e AS", 1), "metrics")
def _(get, spark, sf):
    epochs = epochs_of(get).select("epoch", "val_loss")
    return T.merge_resumed_runs(epochs.where("epoch <= 12"), epochs.where("epoch >= 8").withColumn("val_loss", F.col("val_loss") + 1))




@query("g3_id_set_diff", "SELECT osmid, CASE WHEN CAST(osmid AS BIGINT) % 2 = 0 THEN 'left' ELSE 'right' END AS side FROM bridges WHERE (CAST(osmid AS BIGINT) % 2 = 0) <> (CAST(osmid AS BIGINT) % 3 = 0)".replace("CASE WHEN CAST(osmid AS BIGINT) % 2 = 0", "CASE WHEN CAST(osmid AS BIGINT) % 2 = 0"), "bridges")
def _(get, spark, sf):
    bridges = get("bridges")
    return E.id_set_diff(bridges.where("CAST(osmid AS BIGINT) % 2 = 0"), bridges.where("CAST(osmid AS BIGINT) % 3 = 0"), "osmid")


# ---- S: streams ---------------------------------------------------------------------------


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query("s1_live_run_monitor", r"SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start, CAST(regexp_extract(line, 'Child ([0-9]+)', 1) AS INT) AS child, regexp_extract(line, '\] ([A-Z_]+)( |$)', 1) AS event, nullif(regexp_extract(line, 'reason=([a-z_]+)', 1), '') AS reason, count(*) AS n, round(sum(CAST(nullif(regexp_extract(line, 'bridge_seconds=([0-9.]+)s', 1), '') AS DOUBLE)), 2) AS seconds FROM run_logs GROUP BY ALL", "run_logs")
def _(get, spark, sf):
    folder = shared_folder(spark)
    windows = monitor.live_run_monitor(view_of_stream(_stream(spark, sf), "run_logs"))
    monitor.upsert_windows(windows, f"{folder}/out", f"{folder}/state")
    read = monitor.current_windows(spark, f"{folder}/out", windows.schema)
    return rounded(read.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "child", "event", "reason", "n", "seconds"), ["seconds"], 2)


@query("s2_incremental_tasks", "SELECT user_id, event_type FROM events GROUP BY ALL")
def _(get, spark, sf):
    folder = shared_folder(spark)
    tasks = monitor.incremental_tasks(_stream(spark, sf), ["user_id", "event_type"]).select("user_id", "event_type")
    monitor.write_new_tasks(tasks, ["user_id", "event_type"], f"{folder}/out", f"{folder}/state")
    return monitor.written_tasks(spark, f"{folder}/out", tasks.schema)


# ---- hulls, registries, reports, learning -------------------------------------------------

#: Deck points in whole millimetres, in which the coordinates of the points are exact, and so are the turns between them.
_MM = "CAST(round({c} * 1000) AS DOUBLE)"
#: A corner sees all other points within less than half a turn. Its hull's edges go from corner to corner around their mean.
_HULL = f"""pts AS (SELECT DISTINCT huc_id, bridge_id, {_MM.format(c='x')} AS x, {_MM.format(c='y')} AS y FROM points WHERE gold = 2),
seen AS (SELECT a.huc_id, a.bridge_id, a.x, a.y, atan2(b.y - a.y, b.x - a.x) AS t FROM pts a JOIN pts b ON a.huc_id = b.huc_id AND a.bridge_id = b.bridge_id AND (a.x <> b.x OR a.y <> b.y)),
gaps AS (SELECT huc_id, bridge_id, x, y, coalesce(lead(t) OVER w, min(t) OVER v + 2 * pi()) - t AS gap FROM seen WINDOW v AS (PARTITION BY huc_id, bridge_id, x, y), w AS (PARTITION BY huc_id, bridge_id, x, y ORDER BY t)),
corners AS (SELECT huc_id, bridge_id, x, y FROM gaps GROUP BY ALL HAVING max(gap) > pi() + 2e-10),
turned AS (SELECT *, atan2(y - avg(y) OVER v, x - avg(x) OVER v) AS t FROM corners WINDOW v AS (PARTITION BY huc_id, bridge_id)),
edges AS (SELECT huc_id, bridge_id, x AS ax, y AS ay, coalesce(lead(x) OVER w, first_value(x) OVER w) AS ex, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ey FROM turned WINDOW w AS (PARTITION BY huc_id, bridge_id ORDER BY t))"""


def _millimetres(points: DataFrame) -> DataFrame:
    return points.select(*B, *(F.round(F.col(c) * 1000).alias(c) for c in "xy"))


def _deck(get) -> DataFrame:
    return _millimetres(get("points").where("gold = 2"))


@query("d19_convex_hull", with_duck("", "points").rstrip() + f", {_HULL} SELECT * FROM corners")
def _(get, spark, sf):
    return H.convex_hull(_deck(get)).select(*B, F.explode("hull").alias("p")).select(*B, "p.x", "p.y")


@query("c12_points_in_hull", with_duck("", "points").rstrip() + f", {_HULL}, placed AS (SELECT huc_id, bridge_id, point_idx, bool_and((ex - ax) * ({_MM.format(c='y')} - ay) - (ey - ay) * ({_MM.format(c='x')} - ax) >= 0) AS inside FROM points JOIN edges USING (huc_id, bridge_id) GROUP BY ALL) SELECT huc_id, bridge_id, count_if(inside)::BIGINT AS inside, count(*) AS n FROM placed GROUP BY ALL")
def _(get, spark, sf):
    marked = H.points_in_hull(_millimetres(get("points")), H.convex_hull(_deck(get)))
    return marked.groupBy(*B).agg(F.count_if("inside").alias("inside"), F.count(F.lit(1)).alias("n"))


@query("c15_huc8_in_split", with_splits("SELECT lpad(CAST(n_nationkey + 20 AS VARCHAR), 8, '0') AS huc8, lpad(CAST(n_nationkey + 20 AS VARCHAR), 8, '0') IN (SELECT huc_id FROM used_splits) AS in_split FROM nation", "CAST(osmid AS BIGINT) % 2 = 0"))
def _(get, spark, sf):
    hucs = get("nation").select((F.col("n_nationkey") + 20).cast("string").alias("huc8"))
    return R.huc8_in_split(hucs, used_of(get))


@query("d32_point_count_histogram", "WITH n AS (SELECT l_suppkey, log10(CAST(count(*) AS DOUBLE)) AS l FROM lineitem GROUP BY l_suppkey), s AS (SELECT min(l) AS lo, max(l) AS hi FROM n) SELECT bin, round(min(lo + bin * (hi - lo) / 40), 6) AS least, count(*) AS n FROM (SELECT CAST(least(floor((l - lo) / ((hi - lo) / 40)), 39) AS INT) AS bin, lo, hi FROM n, s) GROUP BY bin")
def _(get, spark, sf):
    return rounded(R.point_count_histogram(V.cloud_metadata(get("points"))), ["least"], 6)


@query("d32_point_count_stats", "SELECT count(*) AS clouds, round(median(n), 4) AS median, round(avg(n), 4) AS mean, min(n) AS min, max(n) AS max FROM (SELECT count(*) AS n FROM points GROUP BY huc_id, bridge_id)", "points")
def _(get, spark, sf):
    return rounded(R.point_count_stats(V.cloud_metadata(get("points"))), ["median", "mean"])


_UNSEEN = f"SELECT osmid, huc_id, source_name, osmid IN (SELECT osmid FROM used_splits) AS proven FROM ({_PAIRS})"


@query("f5_candidate_summary", with_duck("", "bridges", "sources").rstrip() + ", " + USED_SQL + f""", unseen AS ({_UNSEEN}), once AS (SELECT DISTINCT huc_id, osmid, proven FROM unseen),
sampled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY huc_id ORDER BY {_HASH}, osmid) AS rk FROM once) WHERE rk <= 3 ORDER BY rk, md5(concat_ws('|', '27', huc_id)), huc_id LIMIT 60)
SELECT part, count(*) AS n_rows, count(DISTINCT huc_id) AS n_hucs, count_if(proven)::BIGINT AS proven, count_if(NOT proven)::BIGINT AS unknown
FROM (SELECT 'all' AS part, huc_id, proven FROM unseen UNION ALL SELECT 'sample', huc_id, proven FROM sampled) GROUP BY part""")
def _(get, spark, sf):
    candidates = R.unseen_candidates(pairs_of(get), used_of(get))
    return R.candidate_summary(candidates, E.round_robin_sample(candidates, 60, 3))


def _registry(get) -> DataFrame:
    """Registry texts, one a manufacturer, a model a brand."""
    model = F.struct(
        # Brand#11 comes from Brand#10, which is not there, Brand#12 from Brand#11 and so on
        F.concat(F.lit("Brand#"), (F.substring("p_brand", 7, 9).cast("int") - 1).cast("string")).alias("parent"), F.concat(F.lit("ckpt/"), F.col("p_brand"), F.lit("_iou="), F.round(F.avg("p_retailprice") / 10000, 4).cast("string")).alias("checkpoint"),
        F.create_map(F.lit("test"), F.create_map(F.lit("iou"), F.round(F.avg("p_retailprice"), 4), F.lit("size"), F.round(F.avg("p_size"), 4))).alias("evaluation"),
    )
    models = get("part").groupBy("p_brand").agg(model.alias("m"))
    return models.select(F.to_json(F.struct(F.create_map("p_brand", "m").alias("models"))).alias("value"))


@query("a15_scan_registry", "SELECT p_brand AS model, 'test' AS eval_set, round(avg(p_retailprice), 4) AS iou FROM part GROUP BY p_brand")
def _(get, spark, sf):
    rows = A.registry_rows(_registry(get))
    return rows.select("model", "eval_set", F.try_element_at("metrics", F.lit("iou")).alias("iou"))


_MODELS = "models AS (SELECT p_brand AS model, concat('Brand#', CAST(substr(p_brand, 7) AS INT) - 1) AS parent, concat('ckpt/', p_brand, '_iou=', CAST(round(avg(p_retailprice) / 10000, 4) AS VARCHAR)) AS checkpoint, round(avg(p_retailprice) / 10000, 4) AS iou FROM part GROUP BY p_brand)"


@query("c16_model_lineage", f"WITH {_MODELS} SELECT m.model, m.parent, coalesce(p.checkpoint, 'unknown') AS parent_checkpoint FROM models m LEFT JOIN models p ON p.model = m.parent")
def _(get, spark, sf):
    return A.model_lineage(A.registry_rows(_registry(get)))


@query("e14_best_checkpoint", f"WITH {_MODELS} SELECT 'iou' AS metric, checkpoint AS path, iou AS value FROM models ORDER BY iou DESC, checkpoint DESC LIMIT 1")
def _(get, spark, sf):
    return A.best_checkpoint(A.registry_rows(_registry(get)).select(F.col("checkpoint").alias("path")))


@query("e15_model_leaderboard", "SELECT p_brand AS model, round(avg(p_size), 4) AS value FROM part GROUP BY p_brand")
def _(get, spark, sf):
    return A.model_leaderboard(A.registry_rows(_registry(get)), "test", "size")


@query("a5_write_by_huc", "SELECT huc_id, count(*) AS n FROM bridges GROUP BY huc_id", "bridges")
def _(get, spark, sf):
    folder = shared_folder(spark)
    A.write_by_huc(get("bridges"), "huc_id", folder)
    read = spark.read.schema("osmid string, huc_id string").parquet(folder)
    return read.groupBy("huc_id").agg(F.count(F.lit(1)).alias("n"))


@query("a9_scan_manifest", "SELECT row_number() OVER (ORDER BY CAST(osmid AS BIGINT)) AS line_no, concat(huc_id, '/', osmid) AS line FROM bridges", "bridges")
def _(get, spark, sf):
    folder = shared_folder(spark)
    ordered = get("bridges").orderBy(F.col("osmid").cast("long"))  # the files' names follow the order
    ordered.select(F.concat(F.lit(" "), "huc_id", F.lit("/"), "osmid")).write.text(folder)
    return A.scan_manifest(spark, folder)


@query("a10_scan_pairs", "SELECT concat(huc_id, '/', osmid, '.laz') AS input, concat('out/', osmid) AS output FROM bridges", "bridges")
def _(get, spark, sf):
    folder = shared_folder(spark)
    get("bridges").select(F.concat_ws("\t", F.concat("huc_id", F.lit("/"), "osmid", F.lit(".laz")), F.concat(F.lit("out/"), "osmid"))).write.text(folder)
    return A.scan_pairs(spark, folder)


@query("a11_scan_run_logs", "SELECT line FROM run_logs", "run_logs")
def _(get, spark, sf):
    folder = shared_folder(spark)
    get("run_logs").select("line").write.text(folder)
    return A.scan_run_logs(spark, [folder]).select("line")


@query("a6_write_labelled_points", "SELECT p.kind, count(*) AS n FROM (SELECT 'source' AS kind FROM points UNION ALL SELECT 'labelled' FROM points WHERE CAST(bridge_id AS BIGINT) % 2 = 0) p GROUP BY ALL", "points")
def _(get, spark, sf):
    folder = shared_folder(spark)
    points = get("points")
    labels = points.select(*B).distinct().withColumn("status", F.when(F.expr("CAST(bridge_id AS BIGINT) % 2 = 0"), "success").otherwise("curved"))
    A.write_labelled_points(points, labels, folder)
    count = lambda kind: spark.read.schema(points.schema).parquet(f"{folder}/{kind}").groupBy(F.lit(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return count("source").unionByName(count("labelled"))


_STATE_OF = "CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'timeout' ELSE 'inference_error' END WHEN event_type IN ('purchase', 'click', 'view') THEN NULL ELSE 'too_few_points' END"
_REPORT = f"""WITH lost AS (SELECT event_id, {_STATE_OF} AS reason FROM events WHERE event_id % 7 = 0), first AS (SELECT * FROM lost ORDER BY event_id LIMIT 50),
timed AS (SELECT count(*) AS n, round(avg(s), 1) AS m FROM (SELECT floor(abs(value)) + 0.25 AS s FROM events WHERE event_type = 'purchase')),
children AS (SELECT count(*) AS n, round(sum(wall_clock_seconds) / 3600, 4) AS h FROM {_CHILDREN})
SELECT (SELECT count(*) FROM events) AS total, (SELECT count(*) FROM events WHERE event_id % 7 <> 0) AS found, (SELECT count(*) FROM lost) AS missing,
  (SELECT CAST(sum(succeeded) AS BIGINT) FROM {_CHILDREN}) AS succeeded, (SELECT CAST(sum(download_failed) AS BIGINT) FROM {_CHILDREN}) AS download_failed,
  children.n AS children_reported, CAST(12 AS BIGINT) AS children_expected, h AS total_child_hours, round(h * CAST(0.234 AS DOUBLE), 2) AS estimated_compute_usd, timed.n AS bridges_timed, timed.m AS avg_bridge_seconds,
  (SELECT string_agg(concat('h/bridge_', event_id), ' ' ORDER BY event_id) FROM first) AS missing_entries, (SELECT count(*) > 50 FROM lost) AS missing_entries_truncated,
  CASE WHEN (SELECT count(*) FROM lost) > 50 THEN (SELECT count(*) FROM lost) END AS total_missing,
  coalesce((SELECT string_agg(concat('h/bridge_', event_id, '=', reason), ' ' ORDER BY concat('h/bridge_', event_id, '=', reason)) FROM first WHERE reason IS NOT NULL), '') AS missing_reasons,
  (SELECT string_agg(concat(r, '=', n), ' ' ORDER BY r) FROM (SELECT coalesce(reason, 'unknown') AS r, count(*) AS n FROM lost GROUP BY ALL)) AS counts_by_reason
FROM timed, children"""


@query("d41_postrun_report", _REPORT)
def _(get, spark, sf):
    n = F.col("event_id")
    lines = get("events").select(n.alias("line_no"), F.concat(F.lit("h/bridge_"), n.cast("string")).alias("line"))
    keys = C.output_keys(lines, "line", "out", "masked").where("line_no % 7 <> 0").select("key")
    report = R.postrun_report(lines, keys, _logs(get), "out", "masked", expected_children=12, most=50)
    pairs = lambda c: F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), " ").alias(c)
    counters = [F.try_element_at("aggregated_results", F.lit(c)).alias(c) for c in ("succeeded", "download_failed")]
    return report.select(
        "audit.*", *counters, "child_timing.children_reported", "child_timing.children_expected", "child_timing.total_child_hours", "cost_estimate.estimated_compute_usd",
        F.col("bridge_timing.count").alias("bridges_timed"), F.col("bridge_timing.avg").alias("avg_bridge_seconds"), F.array_join("missing_entries", " ").alias("missing_entries"),
        "missing_entries_truncated", "total_missing", pairs("missing_reasons"), pairs("counts_by_reason"),
    )


@query("m1_voxel_classifier")
def _(get, spark, sf):
    points = get("points")
    model = L.fit_voxel_classifier(points.where("CAST(bridge_id AS BIGINT) % 5 <> 0"), {0: 6.22, 1: 1.49, 2: 0.36, 3: 2.34})
    rest = points.where("CAST(bridge_id AS BIGINT) % 5 = 0")
    return model.transform(L.voxel_features(rest, 1.0)).select(*B, "vx", "vy", "vz", F.col("prediction").cast("int").alias("label"))


@query("m2_predict_points")
def _(get, spark, sf):
    points = get("points")
    model = L.fit_voxel_classifier(points.where("CAST(bridge_id AS BIGINT) % 5 <> 0"), {0: 6.22, 1: 1.49, 2: 0.36, 3: 2.34})
    out = L.predict_points(points, model, "both")
    return out.groupBy(*B, "output", "code").agg(F.count(F.lit(1)).alias("n"))


def _opening_sql() -> str:
    parts = [
        "lowest AS (SELECT huc_id, bridge_id, CAST(floor(x) AS INT) AS gx, CAST(floor(y) AS INT) AS gy, min(z) AS s FROM points WHERE classification <> 7 GROUP BY ALL)",
        "ends AS (SELECT huc_id, bridge_id, min(gx) AS x0, max(gx) AS x1, min(gy) AS y0, max(gy) AS y1 FROM lowest GROUP BY ALL)",
        "cells AS (SELECT huc_id, bridge_id, CAST(gx AS INT) AS gx, CAST(unnest(range(y0, y1 + 1)) AS INT) AS gy FROM (SELECT *, unnest(range(x0, x1 + 1)) AS gx FROM ends))",
        "g0 AS (SELECT huc_id, bridge_id, gx, gy, s, false AS object FROM cells LEFT JOIN lowest USING (huc_id, bridge_id, gx, gy))",
    ]
    for w in range(1, 11):
        over = lambda a, b: f"OVER (PARTITION BY huc_id, bridge_id, {b} ORDER BY {a} RANGE BETWEEN {w} PRECEDING AND {w} FOLLOWING)"  # noqa: E731, B023
        step = f"(SELECT *, min(s) {over('gx', 'gy')} AS o FROM g{w - 1})"
        for f, a, b in (("min", "gy", "gx"), ("max", "gx", "gy"), ("max", "gy", "gx")):
            step = f"(SELECT * EXCLUDE (o), {f}(o) {over(a, b)} AS o FROM {step})"
        parts.append(f"g{w} AS MATERIALIZED (SELECT huc_id, bridge_id, gx, gy, o AS s, object OR coalesce(s - o > CAST(0.05 AS DOUBLE) * {w}, false) AS object FROM {step})")
    return ", ".join(parts)


@query("d24_ground_filter", with_duck("", "points").rstrip() + ", " + _opening_sql() + " SELECT huc_id, bridge_id, ground, count(*) AS n FROM (SELECT p.huc_id, p.bridge_id, CASE WHEN classification = 7 THEN 7 WHEN coalesce(NOT object AND z - s <= 0.5 + 1.25 * 0.05, false) THEN 2 ELSE 1 END AS ground FROM (SELECT *, CAST(floor(x) AS INT) AS gx, CAST(floor(y) AS INT) AS gy FROM points) p LEFT JOIN g10 USING (huc_id, bridge_id, gx, gy)) GROUP BY ALL")
def _(get, spark, sf):
    return G.ground_filter(get("points")).groupBy(*B, "ground").agg(F.count(F.lit(1)).alias("n"))


def _box(x0: str, y0: str, x1: str, y1: str) -> list[tuple[str, str]]:
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


#: Every other source has a hole, the rest two parts, one of them a triangle.
_WHOLE = "CAST((xmin + ymin + 100) / 2000 AS INT) % 2 = 0"
_HOLED = [_box("xmin", "ymin", "xmax", "ymax"), _box("xmin + 500", "ymin + 500", "xmax - 500", "ymax - 500")]
_PARTS = [_box("xmin", "ymin", "xmin + 700", "ymax"), [("xmax - 700", "ymin"), ("xmax", "ymin"), ("xmax", "ymax")]]


def _geojson(get) -> DataFrame:
    """One text: a collection of a Polygon or a MultiPolygon a source."""
    ring = lambda corners: f"array({', '.join(f'array({x}, {y})' for x, y in [*corners, corners[0]])})"  # noqa: E731  the first corner again
    polygon, parts = f"array({', '.join(map(ring, _HOLED))})", f"array({', '.join(f'array({ring(p)})' for p in _PARTS)})"
    kind = lambda name, shape: F.concat(F.lit(f'{{"type": "{name}", "coordinates": '), F.to_json(F.expr(shape)), F.lit("}"))
    geometry = F.when(F.expr(_WHOLE), kind("Polygon", polygon)).otherwise(kind("MultiPolygon", parts))
    top = F.when(F.col("name") < "NATION_2", F.concat(F.lit('"url": "'), "url", F.lit('", '))).otherwise("")
    feature = F.concat(F.lit("{"), top, F.lit('"properties": '), F.to_json(F.struct("url", "name")), F.lit(', "geometry": '), geometry, F.lit("}"))
    return get("sources").agg(F.concat(F.lit('{"features": ['), F.array_join(F.collect_list(feature), ", "), F.lit("]}")).alias("value"))  # a row a nation


def _scanned_sources(get, spark) -> DataFrame:
    folder = shared_folder(spark)
    _geojson(get).write.text(folder)
    return A.scan_sources(spark, folder)


_corner_list = lambda corners: f"[{', '.join(f'[{x}, {y}]' for x, y in corners)}]"
_RINGS = f"""rings AS (SELECT name, url, unnest(CASE WHEN {_WHOLE} THEN [{', '.join(map(_corner_list, _HOLED))}] ELSE [{', '.join(map(_corner_list, _PARTS))}] END) AS ring FROM sources)"""


def _footprint_pairs_sql() -> str:
    ends = [("x0", "y0"), ("x1", "y1")]
    near = [_segment_distance_sql(x, y, "ax", "ay", "ex", "ey") for x, y in ends] + [_segment_distance_sql(x, y, "x0", "y0", "x1", "y1") for x, y in (("ax", "ay"), ("ex", "ey"))]
    side = lambda ax, ay, bx, by, px, py: f"(({bx} - {ax}) * ({py} - {ay}) - ({by} - {ay}) * ({px} - {ax}))"
    cross = " AND ".join(
        f"{side(*line, *one)} * {side(*line, *two)} < 0" for line, one, two in ((("ax", "ay", "ex", "ey"), *ends), (("x0", "y0", "x1", "y1"), ("ax", "ay"), ("ex", "ey")))
    )
    return f""", {_RINGS}, edges AS (SELECT name, url, ring[i][1] AS ax, ring[i][2] AS ay, ring[i % len(ring) + 1][1] AS ex, ring[i % len(ring) + 1][2] AS ey FROM (SELECT *, unnest(range(1, len(ring) + 1)) AS i FROM rings))
SELECT huc_id, osmid, e.name AS source_name, e.url AS source_url FROM bridges b, edges e GROUP BY ALL
HAVING count_if((ay > y0) <> (ey > y0) AND x0 < (ex - ax) * (y0 - ay) / nullif(ey - ay, 0) + ax) % 2 = 1 OR min(least({', '.join(near)})) <= 10 OR bool_or({cross})"""


@query("a3_scan_sources", with_duck("", "sources").rstrip() + f", {_RINGS} SELECT name, url, count(*) AS n_rings, CAST(sum(len(ring) + 1) AS BIGINT) AS n_corners FROM rings GROUP BY ALL")
def _(get, spark, sf):
    corners = F.aggregate("rings", F.lit(0).cast("long"), lambda n, ring: n + F.size(ring))
    return _scanned_sources(get, spark).select("name", "url", F.size("rings").cast("long").alias("n_rings"), corners.alias("n_corners"))


@query("a3_footprint_pairs", with_duck("", "bridges", "sources").rstrip() + _footprint_pairs_sql())
def _(get, spark, sf):
    return S.bridge_source_join(get("bridges"), _scanned_sources(get, spark))


@query("a14_scan_metrics", "SELECT epoch, count(val_loss) AS n FROM metrics GROUP BY epoch", "metrics")
def _(get, spark, sf):
    folder = shared_folder(spark)
    get("metrics").write.option("header", True).csv(folder)
    read = A.scan_metrics(spark, [folder], "epoch int, step long, train_loss_epoch double, val_loss double, val_deck_iou double")
    return read.groupBy("epoch").agg(F.count("val_loss").alias("n"))

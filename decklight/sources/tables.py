"""Scans and sinks of the labelling pipeline's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from decklight.functions.columns import to_web_mercator


def scan_bridges(spark: SparkSession, path: str, required: tuple[str, ...] = ("osmid",), fmt: str = "parquet") -> DataFrame:
    """The inventory; fails on missing required columns; osmid as text."""
    df = spark.read.format(fmt).load(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.withColumn("osmid", F.col("osmid").cast("string")) if "osmid" in df.columns else df


def huc_partitions(df: DataFrame, huc_ids: list[str] | None = None) -> DataFrame:
    """The sorted distinct regions, of an allow-list if given; absent ones are skipped."""
    if huc_ids is not None:
        df = df.where(F.col("huc_id").isin(list(huc_ids)))
    return df.select("huc_id").distinct().orderBy("huc_id")


def scan_points(spark: SparkSession, path: str, huc_ids: list[str] | None = None, schema=None) -> DataFrame:
    """Points written by region; a list of regions prunes the folders that are read. A schema keeps regions text."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df if huc_ids is None else df.where(F.col("huc_id").isin(list(huc_ids)))


def scan_sources(spark: SparkSession, path: str, lon_lat: bool = False) -> DataFrame:
    """(url, name, rings) of GeoJSON files: url and name at the top or in properties; rows without a url go.

    ``rings`` has all rings of a Polygon, or of all parts of a MultiPolygon, each an array of (x, y);
    other geometries have none. With ``lon_lat`` degrees become Web Mercator metres.
    """
    schema = "features array<struct<url string, name string, properties struct<url string, name string>, geometry struct<type string, coordinates string>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.posexplode("features").alias("i", "f"))
    text = lambda field: F.coalesce(F.nullif(F.col(f"f.{field}"), F.lit("")), F.nullif(F.col(f"f.properties.{field}"), F.lit("")))
    named = F.coalesce(text("name"), F.concat(F.lit("source_"), F.col("i").cast("string")))
    ring = "array<array<double>>"
    many = F.flatten(F.from_json("f.geometry.coordinates", f"array<array<{ring}>>"))
    rings = F.when(F.col("f.geometry.type") == "Polygon", F.from_json("f.geometry.coordinates", f"array<{ring}>")).when(F.col("f.geometry.type") == "MultiPolygon", many)
    xy = lambda p: to_web_mercator(F.get(p, 0), F.get(p, 1)) if lon_lat else (F.get(p, 0), F.get(p, 1))
    corner = lambda p: F.struct(*(c.alias(n) for c, n in zip(xy(p), "xy")))
    placed = F.transform(F.coalesce(rings, F.array().cast(f"array<{ring}>")), lambda r: F.transform(r, corner))
    return rows.select(text("url").alias("url"), named.alias("name"), placed.alias("rings")).where("url IS NOT NULL")


def write_by_huc(df: DataFrame, column: str, path: str, rows_a_file: int = 5_000_000) -> None:
    """One directory a value. The rows of a value go to as many tasks as it has files, so a large one is not gathered."""
    sizes = df.groupBy(column).agg(F.ceil(F.count(F.lit(1)) / rows_a_file).alias("__files"))
    dealt = df.join(sizes, df[column].eqNullSafe(sizes[column])).drop(sizes[column]).withColumn("__file", F.pmod(F.xxhash64(*df.columns), "__files"))
    dealt.repartition(column, "__file").drop("__files", "__file").write.option("maxRecordsPerFile", rows_a_file).partitionBy(column).parquet(path)


def write_labelled_points(points: DataFrame, labels: DataFrame, path: str) -> None:
    """Source clouds of all bridges, labelled ones of the bridges whose status is success, in folders a region."""
    write_by_huc(points, "huc_id", f"{path}/source")
    good = labels.where("status = 'success'").select("huc_id", "bridge_id")
    write_by_huc(points.join(good, ["huc_id", "bridge_id"], "left_semi"), "huc_id", f"{path}/labelled")


def cloud_metadata_rows(df: DataFrame, column: str, key: str) -> DataFrame:
    """(key, class, n) of JSON maps; malformed text or a missing map gives nothing."""
    return df.select(key, F.explode(F.from_json(column, "map<string,bigint>")).alias("class", "n"))


def split_ids(lines: DataFrame, line: str = "value", order: str = "line_no") -> DataFrame:
    """(huc_id, bridge_stem) of ``huc/stem`` lines: trimmed, blanks dropped, an error without a slash, the first of equal ones."""
    text = lines.select(F.col(order).alias("line_no"), F.trim(line).alias("v")).where("v <> ''")
    checked = text.select("line_no", F.when(F.contains("v", F.lit("/")), F.col("v")).otherwise(F.raise_error(F.concat(F.lit("no slash in line: "), "v"))).alias("v"))
    parts = checked.select("line_no", F.substring_index("v", "/", 1).alias("huc_id"), F.expr("substring(v, instr(v, '/') + 1)").alias("bridge_stem"))
    return parts.groupBy("huc_id", "bridge_stem").agg(F.min("line_no").alias("line_no"))


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed, non-empty lines numbered from 1 in the order of the files' names and of their lines."""
    from decklight.operators.splits import numbered

    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")]
    lines = spark.read.text(path).select(*at, F.trim("value").alias("line")).where("line <> ''")
    return numbered(lines, [F.col("file"), F.col("block"), F.col("at")], "line_no").select("line_no", "line")


def scan_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(input, output) of tab-separated lines; an error names a line that has not two fields."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    fields = F.split("value", "\t")
    good = F.when(F.size(fields) == 2, fields).otherwise(F.raise_error(F.concat(F.lit("expected two fields: "), "value")))
    return lines.select(good.alias("f")).select(F.get("f", 0).alias("input"), F.get("f", 1).alias("output"))


def scan_run_logs(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text(paths).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))


def scan_metrics(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(paths, header=True)


def registry_rows(df: DataFrame, column: str = "value") -> DataFrame:
    """One row a model and evaluation set, of registry JSON texts."""
    kind = "struct<models:map<string,struct<parent:string,checkpoint:string,evaluation:map<string,map<string,double>>>>>"
    models = df.select(F.explode(F.from_json(column, kind)["models"]).alias("model", "m"))
    return models.select("model", F.col("m.parent").alias("parent"), F.col("m.checkpoint").alias("checkpoint"), F.explode_outer("m.evaluation").alias("eval_set", "metrics"))


def model_lineage(models: DataFrame) -> DataFrame:
    """Each model's parent checkpoint, ``unknown`` if it is not there."""
    own = models.select("model", "parent", "checkpoint").distinct()
    parents = own.select(F.col("model").alias("parent"), F.col("checkpoint").alias("parent_checkpoint"))
    return own.join(parents, "parent", "left").select("model", "parent", F.coalesce("parent_checkpoint", F.lit("unknown")).alias("parent_checkpoint"))


def model_leaderboard(rows: DataFrame, eval_set: str, metric: str) -> DataFrame:
    kept = rows.where(F.col("eval_set") == eval_set).select("model", F.try_element_at("metrics", F.lit(metric)).alias("value"))
    return kept.where("value IS NOT NULL").orderBy(F.desc("value"), "model")


def best_checkpoint(files: DataFrame, column: str = "path") -> DataFrame:
    """The file of the best metric in its name: the largest iou or acc, the least loss."""
    name = F.regexp_extract(column, r"(iou|acc|loss)[=_]([0-9]+(?:\.[0-9]+)?)", 1)
    value = F.regexp_extract(column, r"(iou|acc|loss)[=_]([0-9]+(?:\.[0-9]+)?)", 2)
    scored = files.where(name != "").select(column, name.alias("metric"), value.cast("double").alias("value"))
    sign = F.when(F.col("metric") == "loss", -F.col("value")).otherwise(F.col("value"))
    return scored.groupBy("metric").agg(F.max_by(F.struct(column, "value"), F.struct(sign, F.col(column))).alias("b")).select("metric", "b.*")


def split_manifest(splits: DataFrame) -> DataFrame:
    """Lines ``huc/stem`` of each split, with their number within it."""
    from decklight.operators.splits import numbered

    placed = numbered(splits.select("split", "huc_id", "bridge_stem"), [F.col("bridge_stem")], "line_in_huc", ["split", "huc_id"])
    return placed.select("split", "huc_id", "line_in_huc", F.concat_ws("/", "huc_id", "bridge_stem").alias("line"))


def write_split_manifest(splits: DataFrame, path: str) -> None:
    """Under ``path``: ``ids``, lines huc/stem in a folder a split, and ``json``, a line {huc_id, bridge_stem} a row likewise; both in order."""
    ordered = splits.repartitionByRange("split", "huc_id", "bridge_stem").sortWithinPartitions("split", "huc_id", "bridge_stem")
    ordered.select("split", F.concat_ws("/", "huc_id", "bridge_stem").alias("line")).write.partitionBy("split").text(f"{path}/ids")
    ordered.select("split", "huc_id", "bridge_stem").write.partitionBy("split").json(f"{path}/json")

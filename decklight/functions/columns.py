"""Scalar column functions: names, codes, coordinates, keys and log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Survey class codes to the four model classes, and back.
ASPRS_TO_MODEL = {2: 1, 9: 1, 17: 2, 18: 3}
MODEL_TO_ASPRS = {0: 1, 1: 2, 2: 17, 3: 18}
DECK = 2
EARTH_RADIUS = 6378137.0
OUTPUT_MODES = {"raw": ["_predicted"], "masked": ["_bridge_masked"], "both": ["_predicted", "_bridge_masked"]}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_source_name(c) -> Column:
    """Anything but letters, digits and ``._-`` becomes an underscore."""
    return F.regexp_replace(_col(c), r"[^\p{L}\p{N}._-]", "_")


def bridge_stem(osm, source) -> Column:
    return F.concat(F.lit("bridge_"), _col(osm).cast("string"), F.lit("_"), safe_source_name(source))


def parse_bridge_stem(c) -> Column:
    """(osm_id, source), or null where the prefix, the id or the second underscore is missing."""
    c = _col(c)
    parts = F.struct(F.regexp_extract(c, "^bridge_([^_]+)_", 1).alias("osm_id"), F.regexp_extract(c, "^bridge_[^_]+_(.*)$", 1).alias("source"))
    return F.when(c.rlike("^bridge_[^_]+_"), parts)


def _lookup(codes: dict[int, int], c, default: int) -> Column:
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(c).cast("int")), F.lit(default))


def asprs_to_model(c) -> Column:
    return _lookup(ASPRS_TO_MODEL, c, 0)


def model_to_asprs(c) -> Column:
    return _lookup(MODEL_TO_ASPRS, c, 1)


def deck_mask_overlay(original, predicted) -> Column:
    """Deck points become 17; all others keep their code."""
    return F.when(_col(predicted) == DECK, 17).otherwise(_col(original))


def classified_output(df: DataFrame, mode: str, original: str = "classification", predicted: str = "pred") -> DataFrame:
    """One row a point and output: ``output`` and its ``code``."""
    if mode not in OUTPUT_MODES:
        raise ValueError(f"unknown mode: {mode}")
    code = {"_predicted": model_to_asprs(predicted), "_bridge_masked": deck_mask_overlay(original, predicted)}
    outputs = F.array(*(F.struct(F.lit(name[1:]).alias("output"), code[name].cast("int").alias("code")) for name in OUTPUT_MODES[mode]))
    return df.select("*", F.explode(outputs).alias("__o")).select(*df.columns, "__o.output", "__o.code")


def to_web_mercator(lon, lat) -> tuple[Column, Column]:
    x = F.radians(_col(lon)) * EARTH_RADIUS
    y = F.ln(F.tan(F.lit(3.141592653589793 / 4) + F.radians(_col(lat)) / 2)) * EARTH_RADIUS
    return x, y


def clean_bridge_name(c) -> Column:
    c = _col(c).cast("string")
    return F.when(F.lower(F.trim(c)).isin("none", "nan", ""), "").otherwise(F.coalesce(c, F.lit("")))


def normalize_huc8(c) -> Column:
    c = F.trim(_col(c).cast("string"))
    return F.when(c.rlike("^[0-9]+$") & (F.length(c) < 8), F.lpad(c, 8, "0")).otherwise(c)


def short_run_label(c) -> Column:
    """The part after the last dash."""
    return F.substring_index(_col(c), "-", -1)


def short_stem(c, most: int = 40) -> Column:
    c = _col(c)
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)


def argmax_logits(c) -> Column:
    """The place of the largest entry, the first of equal ones."""
    return (F.array_position(_col(c), F.array_max(_col(c))) - 1).cast("int")


def percent_scale(c) -> Column:
    c = _col(c)
    return F.when(c <= 1, c * 100).otherwise(c)


def parse_uri(c) -> tuple[Column, Column]:
    """(bucket, key) of ``scheme://bucket/key``."""
    c = _col(c)
    return F.regexp_extract(c, "^[a-z0-9]+://([^/]+)", 1), F.regexp_extract(c, "^[a-z0-9]+://[^/]+/?(.*)$", 1)


def output_keys(df: DataFrame, line: str, prefix: str, mode: str) -> DataFrame:
    """The output names expected for each manifest line: one, or two in mode ``both``."""
    if mode not in OUTPUT_MODES:
        raise ValueError(f"unknown mode: {mode}")
    stem = F.regexp_replace(F.col(line), r"\.(laz|las)$", "")
    return df.select("*", F.explode(F.array(*map(F.lit, OUTPUT_MODES[mode]))).alias("__s")).select(
        *df.columns, F.concat(F.lit(prefix), F.lit("/"), stem, F.col("__s"), F.lit(".laz")).alias("key")
    )


def parse_curved_log(df: DataFrame, line: str = "line") -> DataFrame:
    """Rows of matching lines only: huc_id, osm_id, source, max_deviation."""
    pattern = r"^\[([0-9]+)\] OSM ID ([0-9]+) / Source ([^:]+): Bridge is curved/arched \(max deviation: ([0-9.]+)m\)"
    part = lambda i: F.regexp_extract(F.col(line), pattern, i)
    return df.where(F.col(line).rlike(pattern)).select(
        *df.columns, part(1).alias("huc_id"), part(2).alias("osm_id"), part(3).alias("source"), part(4).cast("double").alias("max_deviation")
    )


def log_pairs(c) -> Column:
    """The map of all ``key=value`` words of a line after its event; of a key's values the first."""
    words = F.filter(F.split(F.regexp_extract(_col(c), r"\] [A-Z_]+ (.*)$", 1), " +"), lambda w: w.rlike("^[^=]+="))
    keys = F.transform(words, lambda w: F.substring_index(w, "=", 1))
    first = F.filter(words, lambda w, i: F.array_position(F.transform(words, lambda v: F.substring_index(v, "=", 1)), F.substring_index(w, "=", 1)) == i + 1)
    return F.map_from_arrays(F.array_distinct(keys), F.transform(first, lambda w: F.regexp_extract(w, "^[^=]+=(.*)$", 1)))


def parse_run_log(df: DataFrame, line: str = "line") -> DataFrame:
    """child, bridge, event, seconds and reason of ``[Child i] [bridge=b] EVENT k=v`` lines, and all its pairs; absent parts are null."""
    c = F.col(line)
    part = lambda pattern: F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    return df.select(
        *df.columns,
        part(r"\[Child ([0-9]+)\]").cast("int").alias("child"),
        part(r"\[bridge=([^\]]+)\]").alias("bridge"),
        part(r"\] ([A-Z_]+)(?: |$)").alias("event"),
        part(r"bridge_seconds=([0-9.]+)s").cast("double").alias("seconds"),
        part(r"reason=([a-z_]+)").alias("reason"),
        log_pairs(c).alias("pairs"),
    )


def hash_order(seed: int, *keys) -> Column:
    """A deterministic order that does not depend on partitioning or arrival."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(_col(k).cast("string") for k in keys)))

"""Task tables, audits and reports over run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from decklight.functions.columns import bridge_stem, output_keys, parse_run_log
from decklight.functions.tables import written

from .selection import grouped_median
from .splits import at_places


def filter_by_ids(df: DataFrame, column: str, ids: list | None) -> DataFrame:
    """Rows whose id, as text, is in ``ids``; none for an empty list, all for None."""
    return df if ids is None else df.where(F.col(column).cast("string").isin([str(i) for i in ids]))


def lidar_subset(df: DataFrame, flag: str) -> DataFrame:
    """Rows of the flag Y or N; none where the column is absent."""
    return df.where(F.col("has_lidar_tif") == flag) if "has_lidar_tif" in df.columns else df.limit(0)


def skip_existing(tasks: DataFrame, status: DataFrame) -> DataFrame:
    """Tasks without an output, a no-points mark or a timeout mark."""
    done = status.where(F.col("state").isin("exists", "no_points", "timeout"))
    return tasks.join(done, ["huc_id", "osmid", "source_name"], "left_anti")


def unseen_candidates(pairs: DataFrame, splits: DataFrame, proven: bool | None = None) -> DataFrame:
    """Pairs whose stem is in no split; ``proven_linear`` marks osm ids that are in one with another source."""
    stems = splits.select("bridge_stem").distinct()
    known = splits.select(F.regexp_extract("bridge_stem", "^bridge_([^_]+)", 1).alias("osmid")).distinct().withColumn("__k", F.lit(True))
    out = pairs.withColumn("bridge_stem", bridge_stem("osmid", "source_name")).join(stems, "bridge_stem", "left_anti").join(known, "osmid", "left")
    out = out.withColumn("proven_linear", F.coalesce("__k", F.lit(False))).drop("__k")
    return out if proven is None else out.where(F.col("proven_linear") == proven)


def exclude_used(df: DataFrame, splits: DataFrame) -> DataFrame:
    used = splits.select("huc_id", F.regexp_extract("bridge_stem", "^bridge_([^_]+)", 1).alias("osmid"))
    return df.join(used, ["huc_id", "osmid"], "left_anti")


def source_availability(df: DataFrame, listing: DataFrame, key: str = "key") -> DataFrame:
    found = listing.select(key).distinct().withColumn("available", F.lit(True))
    return df.join(found, key, "left").withColumn("available", F.coalesce("available", F.lit(False)))


def resolve_input(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """The file of each line: as given with an extension, else the first of .laz, .las that is there, else .laz."""
    given = F.col("line").rlike(r"\.(laz|las)$")
    options = F.when(given, F.array(F.struct(F.lit(0).alias("at"), F.col("line").alias("file")))).otherwise(
        F.array(*(F.struct(F.lit(i).alias("at"), F.concat("line", F.lit(e)).alias("file")) for i, e in enumerate((".laz", ".las"))))
    )
    tried = manifest.select("line_no", "line", F.explode(options).alias("o")).select("line_no", "line", "o.*")
    found = tried.join(listing.select(F.col("key").alias("file")).distinct().withColumn("there", F.lit(True)), "file", "left")
    best = F.min_by("file", F.when(F.col("there"), F.col("at")).otherwise(F.col("at") + 10))
    return found.groupBy("line_no", "line").agg(best.alias("input"))


def audit_outputs(manifest: DataFrame, listing: DataFrame, prefix: str, mode: str) -> DataFrame:
    """``complete`` of each manifest line: whether all its outputs are listed."""
    there = listing.select("key").distinct().withColumn("there", F.lit(True))
    found = output_keys(manifest, "line", prefix, mode).join(there, "key", "left")
    return found.groupBy("line_no", "line").agg(F.bool_and(F.coalesce("there", F.lit(False))).alias("complete"))


def missing_reasons(missing: DataFrame, logs: DataFrame) -> DataFrame:
    """The last failure reason of each missing bridge; small files are ``too_few_points``; null without a log line."""
    parsed = parse_run_log(logs).where(F.col("event").isin("INFER_FAILED", "SKIP_SMALL_FILE"))
    reason = F.when(F.col("event") == "SKIP_SMALL_FILE", "too_few_points").otherwise(F.col("reason"))
    last = parsed.groupBy("bridge").agg(F.max_by(reason, "line_no").alias("reason"))
    return missing.join(last, "bridge", "left")


def huc_inventory(bridges: DataFrame) -> DataFrame:
    """Per region and in all: bridges, and those with and without lidar."""
    with_lidar = F.count_if(F.col("has_lidar_tif") == "Y")
    counted = bridges.rollup("huc_id").agg(F.count(F.lit(1)).alias("bridges"), with_lidar.alias("with_lidar"), F.count_if(F.col("has_lidar_tif") == "N").alias("without_lidar"))
    return counted.withColumn("huc_id", F.coalesce("huc_id", F.lit("total")))


def huc_totals(bridges: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """One row over the regions of ``asked`` (huc_id), or over all: those that are there and not, those with bridges of each lidar flag, and the bridges."""
    counts = huc_inventory(bridges).where("huc_id <> 'total'")
    if asked is not None:
        counts = asked.select("huc_id").distinct().join(counts, "huc_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return counts.agg(
        F.count("bridges").alias("processed"), F.count_if(F.col("bridges").isNull()).alias("skipped_missing"), total("bridges").alias("total_bridges"), total("with_lidar").alias("lidar_bridges"),
        F.count_if(F.col("with_lidar") > 0).alias("hucs_with_lidar"), total("without_lidar").alias("not_lidar_bridges"), F.count_if(F.col("without_lidar") > 0).alias("hucs_with_not_lidar"),
    )


def run_summary(results: DataFrame, by: list[str] = ()) -> DataFrame:
    """Total, success, failed and skipped; a skipped task is a success too."""
    made = F.col("status").isin("success", "skipped")
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(made).alias("success"), F.count_if(~made).alias("failed"), F.count_if(F.col("status") == "skipped").alias("skipped")
    )


def bridge_timing(logs: DataFrame) -> DataFrame:
    """Count, mean, median, 95th percentile, least and most seconds, to one decimal; nulls in all but the count without any.

    A percentile p is the value at place min(int(n * p / 100), n - 1) of the order.
    """
    timed = written(parse_run_log(logs).where("seconds IS NOT NULL").select("seconds"))
    n = timed.count()
    at = at_places(timed, {"p": (F.col("seconds"), [max(0, min(n * p // 100, n - 1)) for p in (50, 95)])})
    one = lambda c: F.round(c, 1)
    sums = timed.agg(F.count(F.lit(1)).alias("count"), one(F.avg("seconds")).alias("avg"), one(F.min("seconds")).alias("min"), one(F.max("seconds")).alias("max"))
    return sums.crossJoin(at).select("count", "avg", one(F.get("p", 0)).alias("p50"), one(F.get("p", 1)).alias("p95"), "min", "max")  # a row each


def failures_by_reason(logs: DataFrame) -> DataFrame:
    return parse_run_log(logs).where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def seconds_by_child(logs: DataFrame) -> DataFrame:
    timed = parse_run_log(logs).where("seconds IS NOT NULL")
    return timed.groupBy("child").agg(F.avg("seconds").alias("avg_seconds"), F.max("seconds").alias("max_seconds"), F.count(F.lit(1)).alias("n"))


def child_summaries(logs: DataFrame) -> DataFrame:
    """Counters and seconds of each child."""
    event = lambda *names: F.count_if(F.col("event").isin(*names))
    return parse_run_log(logs).groupBy("child").agg(
        event("INFER_OK").alias("ok"), event("INFER_FAILED").alias("failed"), event("SKIP_EXISTS").alias("exists"),
        event("SKIP_SMALL_FILE").alias("small"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"),
    )


def summary_counters(logs: DataFrame) -> DataFrame:
    """(child, counter, value) of the children's SUMMARY lines, whatever counters they have; values that are no numbers are left out."""
    rows = parse_run_log(logs).where("event = 'SUMMARY'").select("child", F.explode("pairs").alias("counter", "text"))
    return rows.select("child", "counter", F.expr("try_cast(text AS DOUBLE)").alias("value")).where("value IS NOT NULL")


def summary_totals(logs: DataFrame) -> DataFrame:
    """Each counter summed over all SUMMARY lines, and how many lines have it."""
    return summary_counters(logs).groupBy("counter").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("lines"))


def child_reports(logs: DataFrame, expected: int) -> DataFrame:
    """Each child from 0 to ``expected`` - 1, and any other that reported: its SUMMARY lines, their counters and seconds; nulls without a line."""
    counter = lambda name: F.sum(F.when(F.col("counter") == name, F.col("value"))).alias(name)
    names = ["succeeded", "failed", "skipped_exists", "skipped_too_few_points", "download_failed", "total", "wall_clock_seconds", "wall_clock_hours"]
    own = summary_counters(logs).groupBy("child").agg(F.count_if(F.col("counter") == "wall_clock_seconds").alias("lines"), *map(counter, names))
    children = logs.sparkSession.range(expected).select(F.col("id").cast("int").alias("child"), F.lit(True).alias("__e"))
    both = children.join(own, "child", "full_outer")
    return both.select("child", F.coalesce("__e", F.lit(False)).alias("expected"), F.coalesce("lines", F.lit(0)).cast("long").alias("lines"), *names)


def child_timing(logs: DataFrame, expected: int) -> DataFrame:
    """One row: SUMMARY lines against the children that should be there, their least, greatest and mean seconds, and their hours."""
    seconds = summary_counters(logs).where("counter = 'wall_clock_seconds'")
    one = lambda c: F.round(c, 1)
    return seconds.agg(
        F.count(F.lit(1)).alias("children_reported"), F.lit(expected).cast("long").alias("children_expected"), one(F.min("value")).alias("min_seconds"), one(F.max("value")).alias("max_seconds"),
        one(F.avg("value")).alias("avg_seconds"), F.round(F.sum("value") / 3600, 4).alias("total_child_hours"),
    )


def planned_cost(chunks: DataFrame, seconds: float = 90.0, rate: float = 0.234) -> DataFrame:
    """One row of the plan of ``manifest_chunks``: children, lines and hours of each, and the cost at ``seconds`` a line."""
    plan = chunks.agg(F.max("array_size").alias("array_size"), F.max("chunk").alias("chunk"))
    hours = F.col("chunk") * seconds / 3600
    return plan.select("array_size", "chunk", hours.alias("hours_per_child"), (F.col("array_size") * hours * rate).alias("cost"))


def cost_estimate(children: DataFrame, rate: float = 0.234) -> DataFrame:
    """Hours and cost over all children."""
    hours = F.sum("seconds") / 3600
    return children.agg(F.count(F.lit(1)).alias("children"), hours.alias("hours"), (hours * rate).alias("cost"))


def subset_verify(full: DataFrame, subset: DataFrame) -> DataFrame:
    """Per region: whether ``subset`` holds just the rows of ``full`` with lidar, and what is wrong if not."""
    a = full.where("has_lidar_tif = 'Y'").select("huc_id", "osmid").distinct().withColumn("in_full", F.lit(1))
    b = subset.select("huc_id", "osmid").distinct().withColumn("in_subset", F.lit(1))
    both = a.join(b, ["huc_id", "osmid"], "full_outer")
    counts = both.groupBy("huc_id").agg(F.count("in_full").alias("expected"), F.count("in_subset").alias("found"), F.bool_and(F.col("in_full").isNotNull() & F.col("in_subset").isNotNull()).alias("same"))
    unequal = F.concat(F.lit("count mismatch: expected "), F.col("expected").cast("string"), F.lit(", got "), F.col("found").cast("string"))
    message = F.when(F.col("same"), "OK").when(F.col("expected") != F.col("found"), unequal).otherwise("osmid set mismatch (counts equal)")
    return counts.select("huc_id", "expected", "found", F.when(F.col("same"), "PASS").otherwise("FAIL").alias("verdict"), message.alias("message"))


def capped_missing(missing: DataFrame, most: int = 1000, column: str = "line") -> DataFrame:
    """One row: the first ``most`` lines in order, how many there are, and whether some are left out."""
    first = missing.select(column).orderBy(column).limit(most).agg(F.array_join(F.array_sort(F.collect_list(column)), " ").alias("lines"))
    total = missing.agg(F.count(F.lit(1)).alias("total"))
    return first.crossJoin(total).withColumn("truncated", F.col("total") > most)  # one row by one


def id_lists(sample: DataFrame) -> DataFrame:
    """One row of a sample of bounded size: its regions and its bridges' ids, each once, in order, with spaces between."""
    listed = lambda c, name: F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), " ").alias(name)
    return sample.agg(listed("huc_id", "hucs"), listed("osmid", "osm_ids"))


def results_csv(results: DataFrame) -> DataFrame:
    """The result file's text columns: three decimals, empty where null."""
    three = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.format_string("%.3f", F.col(c))), F.lit("")).alias(c)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return results.select(text("huc_id"), F.col("osmid").cast("string").alias("osm_id"), text("source_name"), "success", "skipped", three("rmse"), three("deviation"), text("error"))


def write_results_csv(results: DataFrame, path: str) -> None:
    """CSV files with a header, whose rows ascend by region and id from file to file."""
    results_csv(results).orderBy("huc_id", "osm_id", "source_name").write.option("header", True).option("emptyValue", "").csv(path)


def manifest_validate(lines: DataFrame) -> DataFrame:
    """Issues: lines without a slash, and lines seen before, with the first line's number."""
    first = lines.groupBy("line").agg(F.min("line_no").alias("first_line"))
    joined = lines.join(first, "line")
    bad = joined.where(~F.contains("line", F.lit("/"))).select("line_no", "line", F.lit("no_slash").alias("issue"), F.lit(None).cast("long").alias("first_line"))
    again = joined.where(F.col("line_no") > F.col("first_line")).select("line_no", "line", F.lit("duplicate").alias("issue"), "first_line")
    return bad.unionByName(again)


def split_file_plan(splits: DataFrame) -> DataFrame:
    """The files each split gets: tensors for all, and clouds for test as well."""
    kinds = F.when(F.col("split") == "test", F.array(F.lit("pt"), F.lit("laz"))).otherwise(F.array(F.lit("pt")))
    return splits.select("*", F.explode(kinds).alias("ext")).select(*splits.columns, F.concat("huc_id", F.lit("/"), "bridge_stem", F.lit("."), "ext").alias("file"))


def huc8_in_split(hucs: DataFrame, splits: DataFrame) -> DataFrame:
    """Whether each region, its code padded, occurs in the splits."""
    from decklight.functions.columns import normalize_huc8

    used = splits.select(normalize_huc8("huc_id").alias("__h")).distinct().withColumn("__in", F.lit(True))
    joined = hucs.withColumn("huc8", normalize_huc8("huc8")).join(used, F.col("huc8") == F.col("__h"), "left")
    return joined.withColumn("in_split", F.coalesce("__in", F.lit(False))).drop("__h", "__in")


def candidate_summary(candidates: DataFrame, sample: DataFrame) -> DataFrame:
    """Rows, regions, proven and unknown candidates, of all and of the sample."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("n_rows"), F.countDistinct("huc_id").alias("n_hucs"), F.count_if("proven_linear").alias("proven"), F.count_if(~F.col("proven_linear")).alias("unknown")
        ).withColumn("part", F.lit(name))

    return counted(candidates, "all").unionByName(counted(sample, "sample"))


def point_count_histogram(metadata: DataFrame, bins: int = 40) -> DataFrame:
    """(bin, least, n): clouds in bins of equal width of log10 of their points; empty bins are left out."""
    logs = metadata.select(F.log10(F.col("n_points").cast("double")).alias("l"))
    span = logs.agg(F.min("l").alias("lo"), F.max("l").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("l") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    placed = logs.crossJoin(F.broadcast(span)).select(at.cast("int").alias("bin"), (F.col("lo") + at * width).alias("least"))  # one row
    return placed.groupBy("bin").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("n"))


def point_count_stats(metadata: DataFrame) -> DataFrame:
    """One row: clouds, and the median, mean, least and greatest of their points."""
    sums = metadata.agg(F.count("n_points").alias("clouds"), F.avg("n_points").alias("mean"), F.min("n_points").alias("min"), F.max("n_points").alias("max"))
    middle = grouped_median(metadata.select(F.lit(0).alias("all"), "n_points"), ["all"], "n_points").select("median")
    return sums.crossJoin(middle)  # a row each


def robust_bounds(boxes: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """One row: interpolated quantiles of minx, miny (``low``) and maxx, maxy (``high``) of some boxes, and width over height."""
    n = boxes.count()
    place = lambda q: [q * max(0, n - 1)]
    at = at_places(boxes, {"minx": (F.col("minx"), place(low)), "miny": (F.col("miny"), place(low)), "maxx": (F.col("maxx"), place(high)), "maxy": (F.col("maxy"), place(high))})
    one = at.select(*(F.get(c, 0).alias(c) for c in ("minx", "miny", "maxx", "maxy")))
    return one.withColumn("aspect", F.try_divide(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")))


def postrun_report(
    manifest: DataFrame, listing: DataFrame, logs: DataFrame, prefix: str, mode: str, expected_children: int, rate: float = 0.234, most: int = 1_000
) -> DataFrame:
    """One nested row: audit, counters of the SUMMARY lines, child and bridge timing, cost, and what is missing and why.

    ``missing_entries`` are the first ``most`` missing lines of the manifest in its order, with
    ``missing_entries_truncated`` and ``total_missing`` if there are more; ``missing_reasons`` the
    reasons that the logs give for these. ``counts_by_reason`` is over all missing lines.
    """
    audit = written(audit_outputs(manifest, listing, prefix, mode))
    totals = audit.agg(F.count(F.lit(1)).alias("total"), F.count_if("complete").alias("found"), F.count_if(~F.col("complete")).alias("missing"))
    stem = F.regexp_replace(F.substring_index("line", "/", -1), r"\.(laz|las)$", "")
    missing = written(missing_reasons(audit.where(~F.col("complete")).select("line_no", "line", stem.alias("bridge")), logs))
    first = missing.orderBy("line_no", "line").limit(most).agg(F.array_sort(F.collect_list(F.struct("line_no", "line", "reason"))).alias("e"))  # ``most`` at most
    known = F.filter("e", lambda x: x["reason"].isNotNull())
    once = F.filter(known, lambda x, i: F.array_position(F.transform(known, lambda y: y["line"]), x["line"]) == i + 1)
    entries = first.select(F.transform("e", lambda x: x["line"]).alias("missing_entries"), F.map_from_entries(F.transform(once, lambda x: F.struct(x["line"], x["reason"]))).alias("missing_reasons"))
    reasons = missing.groupBy(F.coalesce("reason", F.lit("unknown")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    by_reason = reasons.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("counts_by_reason"))  # a handful of reasons
    counters = summary_totals(logs).where("counter NOT LIKE 'wall%'").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("counter", F.col("total").cast("long"))))).alias("aggregated_results"))
    timing = child_timing(logs, expected_children)
    cost = timing.select("total_child_hours", F.lit(rate).alias("spot_rate_usd"), F.round(F.col("total_child_hours") * rate, 2).alias("estimated_compute_usd"))
    one = lambda df, name: df.select(F.struct(*df.columns).alias(name))
    out = one(totals, "audit")
    for df in (counters, one(timing, "child_timing"), one(bridge_timing(logs), "bridge_timing"), one(cost, "cost_estimate"), entries, by_reason):  # one row each
        out = out.crossJoin(df)
    more = F.col("audit.missing") > most
    return out.withColumn("missing_entries_truncated", more).withColumn("total_missing", F.when(more, F.col("audit.missing")))


def report_json(report: DataFrame) -> DataFrame:
    return report.select(F.to_json(F.struct(*report.columns)).alias("report"))

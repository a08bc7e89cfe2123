"""Alignment of labels with predictions, confusion matrices and the measures made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .voxels import BRIDGE, CLASSES


def align_gold_pred(gold: DataFrame, predicted: DataFrame, least: int = 100) -> DataFrame:
    """One row a bridge of ``gold`` with its status: ok, no_inference_file, point_count_mismatch or too_few_points."""
    g = gold.groupBy(*BRIDGE).agg(F.count(F.lit(1)).alias("n_gold"))
    p = predicted.groupBy(*BRIDGE).agg(F.count(F.lit(1)).alias("n_pred"))
    status = (
        F.when(F.col("n_pred").isNull(), "no_inference_file")
        .when(F.col("n_gold") != F.col("n_pred"), "point_count_mismatch")
        .when(F.col("n_gold") < least, "too_few_points")
        .otherwise("ok")
    )
    return g.join(p, BRIDGE, "left").select(*BRIDGE, "n_gold", F.coalesce("n_pred", F.lit(0)).cast("long").alias("n_pred"), status.alias("status"))


def aligned_points(gold: DataFrame, predicted: DataFrame, least: int = 100) -> DataFrame:
    """(bridge, point, gold, pred) of the bridges whose status is ok."""
    ok = align_gold_pred(gold, predicted, least).where("status = 'ok'").select(*BRIDGE)
    pairs = gold.select(*BRIDGE, "point_idx", "gold").join(predicted.select(*BRIDGE, "point_idx", "pred"), [*BRIDGE, "point_idx"])
    return pairs.join(ok, BRIDGE, "left_semi")


_CELLS = [(g, p) for g in CLASSES for p in CLASSES]


def _cell_counts() -> list[Column]:
    return [F.count_if((F.col("gold") == g) & (F.col("pred") == p)).alias(f"c{g}{p}") for g, p in _CELLS]


def _cell_rows(counts: DataFrame, keys: list[str]) -> DataFrame:
    cell = F.explode(F.array(*(F.struct(F.lit(g).alias("gold"), F.lit(p).alias("pred"), F.col(f"c{g}{p}").alias("n")) for g, p in _CELLS)))
    return counts.select(*keys, cell.alias("cell")).select(*keys, "cell.*")


def confusion_matrix(aligned: DataFrame, keys: list[str] = BRIDGE) -> DataFrame:
    """(keys, gold, pred, n) with all sixteen cells, for each key or overall."""
    return _cell_rows(aligned.groupBy(*keys).agg(*_cell_counts()), keys)


def aligned_confusion(gold: DataFrame, predicted: DataFrame, least: int = 100) -> DataFrame:
    """The matrices of the bridges whose status is ok: one join of the points, and one aggregate for cells and status."""
    g = gold.select(*BRIDGE, "point_idx", "gold", F.lit(True).alias("in_gold"))
    p = predicted.select(*BRIDGE, "point_idx", "pred", F.lit(True).alias("in_pred"))
    counts = g.join(p, [*BRIDGE, "point_idx"], "full_outer").groupBy(*BRIDGE).agg(*_cell_counts(), F.count("in_gold").alias("n_gold"), F.count("in_pred").alias("n_pred"))
    return _cell_rows(counts.where((F.col("n_gold") == F.col("n_pred")) & (F.col("n_gold") >= least)), BRIDGE)


def _ratio(over: Column, under: Column) -> Column:
    return F.when(under > 0, over / under).otherwise(0.0)


def _measures(tp: Column, in_gold: Column, in_pred: Column) -> dict[str, Column]:
    return {
        "precision": _ratio(tp, in_pred), "recall": _ratio(tp, in_gold), "f1": _ratio(2 * tp, in_gold + in_pred),
        "iou": 100 * _ratio(tp, in_gold + in_pred - tp), "support": in_gold,
    }


def _sum_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def class_metrics(cm: DataFrame, keys: list[str] = ()) -> DataFrame:
    """precision, recall, f1, iou (percent) and support of each class; 0 on empty denominators."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("class"), (F.col("gold") == c).alias("g"), (F.col("pred") == c).alias("p")) for c in CLASSES)))
    rows = cm.select(*keys, "n", each.alias("e")).select(*keys, "n", "e.*")
    sums = rows.groupBy(*keys, "class").agg(
        _sum_where(F.col("g") & F.col("p")).alias("tp"), _sum_where(F.col("g")).alias("in_gold"), _sum_where(F.col("p")).alias("in_pred")
    )
    return sums.select(*keys, "class", *(c.alias(k) for k, c in _measures(F.col("tp"), F.col("in_gold"), F.col("in_pred")).items()))


def overall_metrics(cm: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Accuracy and the mean IoU over the classes present in gold."""
    per_class = class_metrics(cm, keys).groupBy(*keys).agg(F.coalesce(F.avg(F.when(F.col("support") > 0, F.col("iou"))), F.lit(0.0)).alias("mean_iou"))
    total = cm.groupBy(*keys).agg(_ratio(_sum_where(F.col("gold") == F.col("pred")), F.sum("n")).alias("accuracy"), F.sum("n").alias("n_points"))
    return total.join(per_class, list(keys)) if keys else total.crossJoin(per_class)  # one row each


def binary_metrics(cm: DataFrame, keys: list[str] = (), deck: int = 2) -> DataFrame:
    """Deck against the rest: both sides' measures and the accuracy."""
    g, p = F.col("gold") == deck, F.col("pred") == deck
    sums = cm.groupBy(*keys).agg(_sum_where(g & p).alias("tp"), _sum_where(g & ~p).alias("fn"), _sum_where(~g & p).alias("fp"), _sum_where(~g & ~p).alias("tn"))
    tp, fn, fp, tn = (F.col(c) for c in ("tp", "fn", "fp", "tn"))
    deck_side = {f"deck_{k}": c for k, c in _measures(tp, tp + fn, tp + fp).items()}
    rest_side = {f"rest_{k}": c for k, c in _measures(tn, tn + fp, tn + fn).items()}
    return sums.select(*keys, *(c.alias(k) for k, c in (deck_side | rest_side).items()), _ratio(tp + tn, tp + tn + fn + fp).alias("binary_accuracy"))


def micro_metrics(cm: DataFrame) -> DataFrame:
    """Measures of the matrix summed over all bridges: one row a class, with the overall ones beside them."""
    total = cm.groupBy("gold", "pred").agg(F.sum("n").alias("n"))
    return class_metrics(total).crossJoin(overall_metrics(total))  # four rows by one


def micro_binary(cm: DataFrame) -> DataFrame:
    """One row: deck against the rest, of the matrix summed over all bridges."""
    return binary_metrics(cm.groupBy("gold", "pred").agg(F.sum("n").alias("n")))


def binary_confusion(cm: DataFrame, keys: list[str] = (), deck: int = 2) -> DataFrame:
    """(keys, gold_deck, pred_deck, n, percent): the four cells of deck against the rest, and their share of their row, 0 for empty rows."""
    cells = [(g, p) for g in (False, True) for p in (False, True)]
    side = lambda c, is_deck: (F.col(c) == deck) if is_deck else (F.col(c) != deck)
    sums = cm.groupBy(*keys).agg(*(_sum_where(side("gold", g) & side("pred", p)).alias(f"c{i}") for i, (g, p) in enumerate(cells)))
    rows = {g: sum((F.col(f"c{i}") for i, (h, _) in enumerate(cells) if h == g), F.lit(0)) for g in (False, True)}
    cell = F.explode(F.array(*(F.struct(F.lit(g).alias("gold_deck"), F.lit(p).alias("pred_deck"), F.col(f"c{i}").alias("n"), (100 * _ratio(F.col(f"c{i}"), rows[g])).alias("percent")) for i, (g, p) in enumerate(cells))))
    return sums.select(*keys, cell.alias("cell")).select(*keys, "cell.*")


def normalized_confusion(cm: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Each cell as a percentage of its row, 0 for empty rows."""
    rows = cm.groupBy(*keys, "gold").agg(F.sum("n").alias("row_n"))
    return cm.join(rows, [*keys, "gold"]).select(*keys, "gold", "pred", (100 * _ratio(F.col("n"), F.col("row_n"))).alias("percent"))


def per_bridge_metrics(cm: DataFrame, keys: list[str] = BRIDGE) -> DataFrame:
    """One wide row a bridge: class_{c}_{measure} and the binary ones."""
    measures = ("precision", "recall", "f1", "iou", "support")
    long = class_metrics(cm, keys)
    wide = long.groupBy(*keys).agg(*(F.max(F.when(F.col("class") == c, F.col(m))).alias(f"class_{c}_{m}") for c in CLASSES for m in measures))
    return wide.join(binary_metrics(cm, keys), keys)


def model_vs_baseline(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """Per class, IoU of the model less that of the baseline, from two summed matrices."""
    m = class_metrics(model.groupBy("gold", "pred").agg(F.sum("n").alias("n")))
    b = class_metrics(baseline.groupBy("gold", "pred").agg(F.sum("n").alias("n")))
    both = m.select("class", F.col("iou").alias("model_iou")).join(b.select("class", F.col("iou").alias("baseline_iou")), "class")
    return both.withColumn("delta", F.col("model_iou") - F.col("baseline_iou"))


def overall_vs_baseline(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """(metric, model, baseline, delta): overall accuracy and mean IoU, and of deck against the rest both IoUs and the accuracy, in percent."""
    names = {"overall_accuracy": 100 * F.col("accuracy"), "mean_iou": F.col("mean_iou"), "deck_iou": F.col("deck_iou"), "rest_iou": F.col("rest_iou"), "binary_accuracy": 100 * F.col("binary_accuracy")}

    def measures(cm: DataFrame, name: str) -> DataFrame:
        total = cm.groupBy("gold", "pred").agg(F.sum("n").alias("n"))
        both = overall_metrics(total).crossJoin(binary_metrics(total))  # one row each
        each = F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), c.alias(name)) for k, c in names.items())))
        return both.select(each.alias("m")).select("m.*")

    joined = measures(model, "model").join(measures(baseline, "baseline"), "metric")
    return joined.withColumn("delta", F.col("model") - F.col("baseline"))


def epoch_deck_metrics(batches: DataFrame, weight: str = "n", groups: list[str] = ()) -> DataFrame:
    """The means of the batches' measures, each batch with its ``weight``, over all or in groups such as epochs."""
    measures = ("recall", "precision", "iou", "accuracy")
    mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col(weight)), F.sum(F.col(weight).cast("double"))).alias(c)
    return batches.groupBy(*groups).agg(F.count(F.lit(1)).alias("batches"), *map(mean, measures))


def batch_deck_metrics(aligned: DataFrame, batch: Column, deck: int = 2) -> DataFrame:
    """Deck recall, precision, IoU and accuracy of each batch; 0 where undefined."""
    g, p = F.col("gold") == deck, F.col("pred") == deck
    sums = aligned.groupBy(batch.alias("batch_no")).agg(
        F.count_if(g & p).alias("tp"), F.count_if(g).alias("g"), F.count_if(p).alias("p"), F.count_if(F.col("gold") == F.col("pred")).alias("right"),
        F.count(F.lit(1)).alias("n"),
    )
    tp, gold, pred, right, n = (F.col(c) for c in ("tp", "g", "p", "right", "n"))
    return sums.select("batch_no", "n", _ratio(tp, gold).alias("recall"), _ratio(tp, pred).alias("precision"), _ratio(tp, gold + pred - tp).alias("iou"), _ratio(right, n).alias("accuracy"))


def loss_scores(rows: DataFrame, weights: tuple[float, ...], smooth: float = 1.0) -> DataFrame:
    """Weighted cross-entropy, Dice loss and their mean, of ``logits`` against ``label``."""
    top = F.array_max("logits")
    e = rows.select("label", F.transform("logits", lambda x: F.exp(x - F.array_max(F.col("logits")))).alias("e"), "logits", top.alias("top"))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    p = e.select("label", "logits", "top", total.alias("total"), F.transform("e", lambda x: x / F.aggregate(F.col("e"), F.lit(0.0), lambda a, y: a + y)).alias("p"))
    log_p = F.get("logits", F.col("label")) - F.col("top") - F.ln("total")
    weight = F.get(F.array(*map(F.lit, weights)), F.col("label"))
    sums = p.agg(
        (-F.sum(weight * log_p) / F.sum(weight)).alias("cross_entropy"),
        *(F.sum(F.when(F.col("label") == c, F.get("p", F.lit(c))).otherwise(0.0)).alias(f"i{c}") for c in CLASSES),
        *(F.sum(F.get("p", F.lit(c))).alias(f"p{c}") for c in CLASSES),
        *(F.count_if(F.col("label") == c).alias(f"g{c}") for c in CLASSES),
    )
    dice = sum(((2 * F.col(f"i{c}") + smooth) / (F.col(f"p{c}") + F.col(f"g{c}") + smooth) for c in CLASSES), F.lit(0.0)) / len(CLASSES)
    return sums.select("cross_entropy", (1 - dice).alias("dice_loss"), (0.5 * F.col("cross_entropy") + 0.5 * (1 - dice)).alias("combined_loss"))

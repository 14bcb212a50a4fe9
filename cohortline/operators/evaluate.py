"""Evaluation of predictions as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.operators.ranked import running_sums
from cohortline.session import pin_small


def confusion_pairs(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) of the pairs that occur."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, classes: Sequence, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per true class, one count column per predicted class and one, ``other``,
    for predictions outside the classes."""
    counts = [F.count_if(F.col(prediction) == c).alias(str(c)) for c in classes]
    known = F.coalesce(F.col(prediction).isin(*classes), F.lit(False))
    return df.groupBy(F.col(label).alias("label")).agg(*counts, F.count_if(~known).alias("other"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, support) of every class seen on either side;
    undefined ratios are zero. Works on class pairs, so the rows are read once."""
    pairs = confusion_pairs(df, label, prediction)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hits")),
    )).alias("s")).select("s.*")
    totals = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)

    precision, recall = ratio(F.col("hits"), F.col("predicted")), ratio(F.col("hits"), F.col("support"))
    scored = totals.select("class", precision.alias("precision"), recall.alias("recall"), "support")
    both = F.col("precision") + F.col("recall")
    return scored.select(
        "class", "precision", "recall", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0).alias("f1"), "support")


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, balanced accuracy (mean recall over true classes),
    support-weighted F1 and the composite score, the mean of the last two."""
    report = class_report(df, label, prediction)
    row = report.agg(
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
    )
    return row.withColumn("composite_score", (F.col("balanced_accuracy") + F.col("f1_weighted")) / 2.0)


def roc_points(scored: DataFrame) -> DataFrame:
    """(class, threshold, tp, fp, tpr, fpr) at every distinct score, high to low.
    ``scored``: (class, is_positive, score)."""
    flags = scored.select(
        "class", "score", F.col("is_positive").cast("bigint").alias("p"), (1 - F.col("is_positive").cast("bigint")).alias("q"))
    running = running_sums(flags, ["class"], "score", ["p", "q"], ascending=False)
    totals = pin_small(flags.groupBy("class").agg(F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg")))
    return running.join(totals, "class").select(
        "class", F.col("score").alias("threshold"), "p", "q", F.col("p_cum").alias("tp"), F.col("q_cum").alias("fp"),
        (F.col("p_cum") / F.col("n_pos")).alias("tpr"), (F.col("q_cum") / F.col("n_neg")).alias("fpr"), "n_pos", "n_neg")


def roc_auc(scored: DataFrame) -> DataFrame:
    """(class, auc): trapezoids over tied scores; null without both kinds of rows.
    Each step adds its negatives times the positives above and half its own."""
    points = roc_points(scored)
    area = F.sum(F.col("q").cast("double") * (F.col("tp") - F.col("p") / 2.0))
    return points.groupBy("class").agg(
        F.when((F.max("n_pos") > 0) & (F.max("n_neg") > 0), area / (F.max("n_pos").cast("double") * F.max("n_neg"))).alias("auc"))


def one_vs_rest_scores(df: DataFrame, probability: str, classes: Sequence[int], label: str = "label") -> DataFrame:
    """(class, is_positive, score) per row and class, from a probability array."""
    entries = F.array(*[
        F.struct(F.lit(int(c)).alias("class"), (F.col(label) == c).alias("is_positive"), F.get(probability, F.lit(int(c))).alias("score"))
        for c in classes
    ])
    return df.select(F.inline(entries))


def macro_roc_auc(df: DataFrame, probability: str, classes: Sequence[int], label: str = "label") -> DataFrame:
    return roc_auc(one_vs_rest_scores(df, probability, classes, label)).agg(F.avg("auc").alias("roc_auc"))


def metric_long(runs: DataFrame) -> DataFrame:
    """(model, metric, score) rows from a run table with a metrics map."""
    return runs.select("model", F.explode("metrics").alias("metric", "score"))


def champion(runs: DataFrame, priority: Sequence[str]) -> DataFrame:
    """The run with the highest composite score; earlier names in ``priority`` win
    ties. One row per run is compared, by a map-side maximum."""
    order = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("model"))
    rank = F.struct(F.element_at("metrics", "composite_score").alias("score"), (-order).alias("prio"))
    best = runs.agg(F.max_by(F.struct("model", "metrics", "params"), rank).alias("b"))
    return best.select("b.model", F.element_at("b.metrics", "composite_score").alias("composite_score"), "b.metrics", "b.params")

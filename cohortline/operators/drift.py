"""Distribution drift of long-form (feature, value) data against stored reference
statistics: bin shares, stability index, two-sample KS, status.

The reference is one row per feature (edges, shares, mean, std and a sample of at
most ``SAMPLE_SIZE`` values), so its broadcast is bounded by the column count.
Current values are read once: each finds its bin and its place among the sample
points, and only counts per (feature, bin, place) are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortline.functions.numeric import ks_p_value, psi_term, share_or_zero, with_count_at_most
from cohortline.functions.status import KS_ALPHA, PSI_ALERT, PSI_WATCH, drift_status
from cohortline.functions.text import stable_hash
from cohortline.operators.columns import long_form
from cohortline.operators.ranked import bottom_k_sample, exact_quantiles, running_sums
from cohortline.session import pin_small

# Bins of the reference histogram and the sample kept for KS.
N_BINS = 10
SAMPLE_SIZE = 2000

#: A feature's statistics hold some 2,000 doubles, so this many fit a broadcast.
MAX_FEATURES = 5000


def per_feature(stats: DataFrame) -> DataFrame:
    """Broadcast a one-row-per-feature table once its row count is checked; a
    shuffle join on so few keys would put a whole feature into one task."""
    return F.broadcast(stats) if stats.limit(MAX_FEATURES + 1).count() <= MAX_FEATURES else stats


def clean_values(df: DataFrame) -> DataFrame:
    return df.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def quantile_edges(values: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """(feature, n, edges): distinct equal-frequency edges; with fewer than three,
    three evenly spaced ones from the minimum to just above the maximum."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_quantiles(values, "feature", "value", probs)
    distinct = q.select("feature", "n", F.array_sort(F.array_distinct("quantiles")).alias("edges"))
    low, high = F.element_at("edges", 1), F.element_at("edges", -1) + F.lit(1e-9)
    return pin_small(distinct.withColumn(
        "edges", F.when(F.size("edges") < 3, F.array(low, (low + high) / 2, high)).otherwise(F.col("edges"))))


def longest(df: DataFrame, column: str) -> int:
    """Length of the longest array of a small statistics table, the bound of a search in it."""
    return df.agg(F.max(F.size(column))).first()[0] or 0


def with_bin(df: DataFrame, max_edges: int, count_outside: bool = False) -> DataFrame:
    """Adds the 1-based ``bin`` of ``value`` among ``edges``: half-open, the last
    one closed. Values outside give 0, or the nearest outer bin with
    ``count_outside``. Never null: a null test pushed below the projections of the
    search would unfold them into one huge expression."""
    found = with_count_at_most(df, "value", "edges", max_edges, "_found")
    n_bins = F.size("edges") - 1
    if count_outside:
        placed = F.greatest(F.lit(1), F.least(F.col("_found"), n_bins))
    else:
        placed = F.when(F.col("value") == F.get("edges", n_bins), n_bins).when(F.col("_found") <= n_bins, F.col("_found")).otherwise(0)
    return found.withColumn("bin", F.coalesce(placed, F.lit(0))).drop("_found")


def histogram(values: DataFrame, edges: DataFrame, count_outside: bool = False) -> DataFrame:
    """(feature, bin, low, high, n, share) for every bin; empty bins give zero and
    shares are zero when nothing lies in range."""
    placed = with_bin(values.join(per_feature(edges.select("feature", "edges")), "feature"), longest(edges, "edges"), count_outside)
    counts = placed.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    return _all_bins(edges, counts)


def _all_bins(edges: DataFrame, counts: DataFrame) -> DataFrame:
    every = edges.select("feature", "edges", F.explode(F.sequence(F.lit(1), F.size("edges") - 1)).alias("bin")).select(
        "feature", "bin", F.get("edges", F.col("bin") - 1).alias("low"), F.get("edges", F.col("bin")).alias("high"))
    filled = every.join(counts, ["feature", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return filled.withColumn("share", share_or_zero(F.col("n"), F.sum("n").over(W.partitionBy("feature"))))


def psi(reference_bins: DataFrame, current_bins: DataFrame) -> DataFrame:
    """(feature, psi) from two histograms over the same edges."""
    ref = reference_bins.select("feature", "bin", F.col("share").alias("ref_share"))
    cur = current_bins.select("feature", "bin", F.col("share").alias("cur_share"))
    joined = ref.join(cur, ["feature", "bin"])
    return joined.groupBy("feature").agg(F.sum(psi_term(F.col("ref_share"), F.col("cur_share"))).alias("psi"))


def ks_two_sample(left: DataFrame, right: DataFrame) -> DataFrame:
    """(feature, ks_stat, ks_pvalue, n_left, n_right) over two full value sets."""
    both = left.select("feature", "value", F.lit(1).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")).unionByName(
        right.select("feature", "value", F.lit(0).cast("bigint").alias("a"), F.lit(1).cast("bigint").alias("b")))
    running = running_sums(both, ["feature"], "value", ["a", "b"])
    totals = pin_small(both.groupBy("feature").agg(F.sum("a").alias("n_left"), F.sum("b").alias("n_right")), MAX_FEATURES)
    gap = F.abs(F.col("a_cum") / F.col("n_left") - F.col("b_cum") / F.col("n_right"))
    stat = running.join(totals, "feature").groupBy("feature", "n_left", "n_right").agg(F.max(gap).alias("ks_stat"))
    return stat.withColumn("ks_pvalue", ks_p_value(F.col("ks_stat"), F.col("n_left"), F.col("n_right")))


def build_reference(df: DataFrame, features: Sequence[str], row_key: Sequence[str] | None = None, seed: int = 42,
                    n_bins: int = N_BINS, sample_size: int = SAMPLE_SIZE) -> DataFrame:
    """(feature, edges, proportions, mean, std, sample) of the present features.
    ``row_key`` names columns that identify a row, which makes the sample
    independent of the partitioning; without them a generated id is used. All
    features sample the same rows, so one hash per row serves them all."""
    present = [f for f in features if f in df.columns]
    if row_key is None:
        df, row_key = df.withColumn("_row", F.monotonically_increasing_id()), ["_row"]
    hashed = df.withColumn("_hash", stable_hash(*row_key, seed=seed))
    keyed = clean_values(long_form(hashed, present, "feature", "value", keep=["_hash", *row_key]))
    values = keyed.select("feature", "value")
    edges = quantile_edges(values, n_bins)
    shares = histogram(values, edges).groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("bin", "share"))), lambda s: s["share"]).alias("proportions"))
    moments = values.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    sample = bottom_k_sample(keyed, ["feature"], "_hash", row_key, sample_size).groupBy("feature").agg(
        F.sort_array(F.collect_list("value")).alias("sample"))
    return pin_small(edges.select("feature", "edges").join(shares, "feature").join(moments, "feature").join(sample, "feature"), MAX_FEATURES)


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """(label, share) of the non-null labels, by label."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("label", (F.col("n") / total).alias("share")).orderBy("label")


def place_counts(current: DataFrame, reference: DataFrame, count_outside: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """(feature, bin, place, on_point, n, total): current values counted by their
    bin and their place among the sorted sample points, however many bins and points
    the reference has. At most a few thousand rows per feature; counts of separate
    batches, or of the parts named by the ``by`` columns, add up."""
    bounds = reference.agg(F.max(F.size("edges")), F.max(F.size("sample"))).first()
    points = reference.select("feature", "edges", F.array_sort(F.array_distinct("sample")).alias("points"))
    binned = with_bin(clean_values(current).join(per_feature(points), "feature"), bounds[0] or 0, count_outside)
    return (
        with_count_at_most(binned, "value", "points", bounds[1] or 0, "place")
        .withColumn("on_point", F.coalesce(F.get("points", F.col("place") - 1) == F.col("value"), F.lit(False)))
        .groupBy(*by, "feature", "bin", "place", "on_point")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    )


def feature_drift(current: DataFrame, reference: DataFrame,
                  watch: float = PSI_WATCH, alert: float = PSI_ALERT, alpha: float = KS_ALPHA,
                  count_outside: bool = False) -> DataFrame:
    """(feature, n_current, psi, ks_stat, ks_pvalue, status, ref_mean, cur_mean),
    unrounded, for features present on both sides."""
    # read by three small aggregates below: one scan instead of three
    placed = pin_small(place_counts(current, reference, count_outside), 200_000)
    return drift_from_counts(placed, reference, watch, alert, alpha)


def drift_from_counts(placed: DataFrame, reference: DataFrame, watch: float = PSI_WATCH, alert: float = PSI_ALERT,
                      alpha: float = KS_ALPHA) -> DataFrame:
    """The drift of each feature from place counts, of one batch or many."""
    sizes = placed.groupBy("feature").agg(F.sum("n").alias("n_current"), (F.sum("total") / F.sum("n")).alias("cur_mean"))

    cur_bins = _all_bins(reference.select("feature", "edges"),
                         placed.filter("bin > 0").groupBy("feature", "bin").agg(F.sum("n").alias("n")))
    ref_bins = reference.select("feature", F.posexplode("proportions").alias("pos", "share")).select(
        "feature", (F.col("pos") + 1).alias("bin"), "share")
    index = psi(ref_bins, cur_bins)

    by_place = placed.groupBy("feature", "place").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("on_point"), F.col("n")).otherwise(0)).alias("n_on"))
    weights = reference.select("feature", F.explode("sample").alias("value")).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("w"))
    ranked = weights.select(
        "feature", "w", F.row_number().over(W.partitionBy("feature").orderBy("value")).alias("place"),
        F.sum("w").over(W.partitionBy("feature").orderBy("value")).alias("w_cum"),
        F.sum("w").over(W.partitionBy("feature")).alias("m"),
    )
    every = ranked.join(by_place, ["feature", "place"], "full").select(
        "feature", "place", F.coalesce("w", F.lit(0)).alias("w"), "w_cum", "m",
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_on", F.lit(0)).alias("n_on"))
    up_to = W.partitionBy("feature").orderBy("place")
    total = F.sum("n").over(W.partitionBy("feature"))
    before = F.sum("n").over(up_to) - F.col("n")
    gaps = every.select(
        "feature", "m", total.alias("n_current"),
        F.abs((before + F.col("n_on")) / total - F.col("w_cum") / F.col("m")).alias("gap_at"),
        F.abs(before / total - (F.col("w_cum") - F.col("w")) / F.col("m")).alias("gap_before"),
    ).filter("m IS NOT NULL")
    ks = gaps.filter("n_current > 0").groupBy("feature").agg(
        F.max(F.greatest("gap_at", "gap_before")).alias("ks_stat"), F.max("m").alias("m"), F.max("n_current").alias("n_ks"))
    ks = ks.select("feature", "ks_stat", ks_p_value(F.col("ks_stat"), F.col("m"), F.col("n_ks")).alias("ks_pvalue"))

    return (
        sizes.join(index, "feature").join(ks, "feature", "left")
        .join(reference.select("feature", F.col("mean").alias("ref_mean")), "feature")
        .withColumn("status", drift_status(F.col("psi"), F.col("ks_pvalue"), watch, alert, alpha))
        .select("feature", "n_current", "psi", "ks_stat", "ks_pvalue", "status", "ref_mean", "cur_mean")
    )


def rounded_report(features: DataFrame) -> DataFrame:
    """Report digits, highest index first."""
    return features.select(
        "feature", F.round("psi", 4).alias("psi"), F.round("ks_pvalue", 4).alias("ks_pvalue"), "status",
        F.round("ref_mean", 3).alias("ref_mean"), F.round("cur_mean", 3).alias("cur_mean"),
    ).orderBy(F.desc("psi"), "feature")


def drift_summary(features: DataFrame, n_samples: Column | int, checked_at: Column | None = None) -> DataFrame:
    """One row: lists by status and the worst status present. The overall status is
    null when there were no samples to check."""
    samples = n_samples if isinstance(n_samples, Column) else F.lit(n_samples)

    def named(status):
        return F.sort_array(F.collect_list(F.when(F.col("status") == status, F.col("feature"))))

    lists = features.agg(named("DRIFT").alias("drifted"), named("WATCH").alias("watch"), named("STABLE").alias("stable"))
    overall = F.when(F.size("drifted") > 0, "DRIFT").when(F.size("watch") > 0, "WATCH").otherwise("STABLE")
    return lists.select(
        (F.current_timestamp() if checked_at is None else checked_at).alias("checked_at"),
        samples.cast("bigint").alias("n_production_samples"),
        "drifted", "watch", "stable",
        F.when(samples > 0, overall).alias("overall_status"),
        F.when(samples > 0, F.lit(None).cast("string")).otherwise("No production predictions logged yet.").alias("note"),
    )

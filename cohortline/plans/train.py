"""The training plan: split, scale, select, balance, fit two candidates, evaluate,
pick the champion, persist everything a scorer needs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions.text import row_fingerprint
from cohortline.operators import balance as B
from cohortline.operators import prep
from cohortline.operators import training as T
from cohortline.session import cut_lineage
from cohortline.sources import reports


# Fixed value: the name a run records for oversampling followed by neighbour editing.
BALANCING = "SMOTEENN"


@dataclass(frozen=True)
class TrainConfig:
    features: Sequence[str]
    label: str
    test_share: float = 0.2
    seed: int = 42
    balance: bool = True
    probes: int | None = None
    neighbour_search: Callable | None = None
    forest: dict = field(default_factory=dict)
    kernel_components: int = 256
    kernel_iterations: int = 50
    search_features: bool = False


@dataclass(frozen=True)
class TrainResult:
    champion: str
    metrics: dict[str, dict[str, float]]
    features: list[str]
    run_id: str


def _as_vectors(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return df.select("_row", F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("vec"), F.col(label).alias("label"))


def train(table: DataFrame, cfg: TrainConfig, out_dir: str) -> TrainResult:
    """Writes ``models/``, ``scaler``, ``features`` and ``runs`` below ``out_dir``.
    The run log is append-only; everything else is replaced."""
    spark = table.sparkSession
    usable = table.filter(F.col(cfg.label).isNotNull())
    # copies of a row share a fingerprint, hence a side of the split
    keyed = usable.withColumn("_print", row_fingerprint(*table.columns, strict=True))
    train_raw, test_raw = prep.hash_split(keyed, ["_print"], cfg.test_share, cfg.seed)
    # ids generated once and stored: every later step refers to the same rows
    train_raw = cut_lineage(train_raw.withColumn("_row", F.monotonically_increasing_id()))
    test_raw = cut_lineage(test_raw.withColumn("_row", F.monotonically_increasing_id()))

    features = list(cfg.features)
    if cfg.search_features:
        first, _, _ = prep.scale_split(train_raw, test_raw, ["_print", "_row", cfg.label])
        path = T.eliminate_features(first, features, cfg.label, "_row", T.forest(numTrees=100, maxDepth=10))
        features = T.chosen_features(path)
    train_sel = prep.select_features(train_raw, features, ["_row", cfg.label])
    test_sel = prep.select_features(test_raw, features, ["_row", cfg.label])
    train_scaled, test_scaled, scaler = prep.scale_split(train_sel, test_sel, ["_row", cfg.label])
    vectors = _as_vectors(train_scaled, features, cfg.label)
    if cfg.balance:
        vectors = B.balance(vectors, "_row", "vec", "label", cfg.seed, cfg.probes, cfg.neighbour_search)
    balanced = cut_lineage(T.from_arrays(vectors, "vec", "label"))
    test = T.from_arrays(_as_vectors(test_scaled, features, cfg.label), "vec", "label")
    sizes = {name: df.count() for name, df in (("n_train", train_sel), ("n_test", test_sel), ("n_train_balanced", balanced))}

    classes = [int(r[0]) for r in usable.select(F.col(cfg.label).cast("int")).distinct().orderBy(cfg.label).collect()]
    forest = T.forest(seed=cfg.seed, **cfg.forest).fit(balanced)
    kernel = T.fit_kernel_svc(balanced, len(features), n_components=cfg.kernel_components, max_iter=cfg.kernel_iterations, seed=cfg.seed)
    metrics = {
        T.FOREST_NAME: T.evaluate(forest.transform(test), classes),
        T.KERNEL_NAME: T.evaluate(kernel.transform(test)),
    }

    run_id = uuid.uuid4().hex
    params = {"n_rows": sizes["n_train"] + sizes["n_test"], "n_raw_features": len(table.columns) - 1, "n_selected_features": len(features), "test_size": cfg.test_share, "balancing": BALANCING if cfg.balance else "none", **sizes}
    settings = {T.FOREST_NAME: {**T.FOREST_SETTINGS, **cfg.forest},
                T.KERNEL_NAME: {"C": T.KERNEL_C, "gamma": T.KERNEL_GAMMA, "components": cfg.kernel_components}}
    children = [T.run_record(spark, name, values, settings[name], {"model_type": name}, parent_id=run_id) for name, values in metrics.items()]
    runs = children[0].unionByName(children[1])
    best = T.E.champion(runs, [T.FOREST_NAME, T.KERNEL_NAME]).first()
    parent = T.run_record(spark, "train_pipeline", {f"champion_{k}": v for k, v in best["metrics"].items()}, params,
                          {"champion_model": best["model"]}, run_id=run_id)
    reports.append_runs(runs.unionByName(parent), f"{out_dir}/runs")

    T.save_model(forest, f"{out_dir}/models/forest")
    kernel.model.write().overwrite().save(f"{out_dir}/models/kernel")
    scaler.repartition(1).write.mode("overwrite").parquet(f"{out_dir}/scaler")
    spark.createDataFrame([(i, f) for i, f in enumerate(features)], "position int, feature string").coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/features")
    head = [(best["model"], float(best["composite_score"]), dict(best["metrics"]), len(features), run_id)]
    reports.save_report(spark.createDataFrame(
        head, "model_type string, composite_score double, metrics map<string,double>, num_features int, run_id string"), f"{out_dir}/champion")
    return TrainResult(best["model"], metrics, features, run_id)


def load_scorer(spark: SparkSession, out_dir: str):
    """(model over the ``features`` vector, scaler statistics, ordered features) of
    the stored champion. The kernel machine comes back behind its lifting."""
    features = [r["feature"] for r in spark.read.parquet(f"{out_dir}/features").orderBy("position").collect()]
    scaler = spark.read.parquet(f"{out_dir}/scaler")
    head = spark.read.json(f"{out_dir}/champion").first()
    if head["model_type"] == T.FOREST_NAME:
        model = T.load_model(f"{out_dir}/models/forest")
    else:
        model = T.KernelMachine.load(f"{out_dir}/models/kernel", len(features))
    return T.NamedFeatures(model, features), scaler, features

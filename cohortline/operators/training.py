"""Training and selection with MLlib. Every fit is distributed; the driver only
decides which fit comes next. Independent fits run side by side."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, OneVsRest, OneVsRestModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions.text import stable_hash
from cohortline.operators import evaluate as E
from cohortline.operators import kernels, polynomial
from cohortline.operators.forest import GrownForest, grow_forest
from cohortline.operators.kernels import Landmarks, TensorSketch
from cohortline.operators.prep import HASH_RANGE, stratified_folds, with_class_weight
from cohortline.session import cut_lineage

# Settings of the two candidates.
FOREST_SETTINGS = {"numTrees": 70, "maxDepth": 18, "minInstancesPerNode": 5, "featureSubsetStrategy": "sqrt", "seed": 42}
KERNEL_C, KERNEL_GAMMA = 5.0, 0.05
# How the forest is grown, not what grows: wide levels in few passes, row-to-node
# ids kept and checkpointed instead of replayed from the root; not at the last pass of a forest of 10 levels, which nothing follows.
FOREST_EXECUTION = {"maxMemoryInMB": 1024, "cacheNodeIds": True, "checkpointInterval": 20}
#: Nodes of the forests that grow side by side, at most so many where there is more than one forest.
MAX_GROWN_NODES = 1_000_000
#: Bytes of draws and node ids (four numbers a row and tree) that the forests growing side by side keep, where there is more than one.
MAX_KEPT_BYTES = 12 * 2 ** 30
#: From so many rows on, a forest's rows are dealt out evenly (a task more than cores is a second wave in every pass) and sorted by
#: their values: neighbours then meet in the same nodes, which stay in the processor's cache.
SORTED_ROWS = 100_000
#: Training rows of one partition, at most; fewer where that leaves cores idle.
PARTITION_ROWS, EXPANDED_ROWS = 1_000_000, 256
FOREST_NAME, KERNEL_NAME = "RandomForestClassifier", "SVC"


def assemble(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """(features vector, label double) plus kept columns."""
    vector = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)
    return vector.select("features", F.col(label).cast("double").alias("label"), *keep)


def from_arrays(df: DataFrame, vec: str, label: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"), F.col(label).cast("double").alias("label"), *keep)


class BinnedForest(RandomForestClassifier):
    """The library's forest, which can also be grown by ``operators.forest``: same settings and rules, other draws."""

    def can_grow(self) -> bool:
        """Whether every setting is one the growth from bins knows."""
        plain = self.getImpurity() == "gini" and self.getSubsamplingRate() == 1.0 and self.getMinInfoGain() == 0.0 and self.getMinWeightFractionPerNode() == 0.0
        return plain and not self.isSet("weightCol") and not self.isSet("thresholds") and self.getMaxBins() <= 256 and self.getFeatureSubsetStrategy() in TRIED

    def grow(self, rows: DataFrame) -> GrownForest:
        settings = {"n_trees": self.getNumTrees(), "depth": self.getMaxDepth(), "least": self.getMinInstancesPerNode(), "seed": self.getSeed(),
                    "tried": TRIED[self.getFeatureSubsetStrategy()], "bootstrap": self.getBootstrap()}
        return grow_forest(rows, self.getFeaturesCol(), self.getLabelCol(), self.getMaxBins(), settings)


#: Features a node chooses from, by strategy.
TRIED = {"all": lambda n: n, "sqrt": lambda n: math.ceil(math.sqrt(n)), "log2": lambda n: max(1, math.ceil(math.log2(n))), "onethird": lambda n: math.ceil(n / 3.0)}


def forest(**settings) -> BinnedForest:
    return BinnedForest(**{**FOREST_SETTINGS, **FOREST_EXECUTION, **settings})


def _fitted(estimator: Estimator, rows: DataFrame) -> Model:
    """Forests are grown from binned rows where their settings allow it; anything else is fitted by the library."""
    return estimator.grow(rows) if isinstance(estimator, BinnedForest) and estimator.can_grow() else estimator.fit(rows)


def _released(model: Model) -> None:
    """A grown forest's copies on the workers are dropped."""
    if isinstance(model, GrownForest):
        model.release()


def fourier_features(df: DataFrame, n_inputs: int, n_components: int = 256, gamma: float = KERNEL_GAMMA, seed: int = 42) -> DataFrame:
    """Random Fourier features of the RBF kernel: a fixed seeded projection applied
    to Arrow batches, so a linear machine on top approximates the kernel one."""
    return kernels.map_features(df, kernels.Fourier(n_inputs, n_components, gamma, seed))


def linear_one_vs_rest(reg: float, max_iter: int = 50, weighted: bool = True, parallelism: int = 2) -> OneVsRest:
    """Linear machines, one per class."""
    machine = LinearSVC(maxIter=max_iter, regParam=reg, standardization=False)
    rest = OneVsRest(classifier=machine, parallelism=parallelism)
    return rest.setWeightCol("weight") if weighted else rest


@dataclass(frozen=True)
class KernelMachine:
    """One-vs-rest machines over the lifted features; the lifting is a function of
    its settings, so only the machines are stored."""

    model: OneVsRestModel
    n_inputs: int
    n_components: int = 256
    gamma: float = KERNEL_GAMMA
    seed: int = 42

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(fourier_features(df, self.n_inputs, self.n_components, self.gamma, self.seed))

    @classmethod
    def load(cls, path: str, n_inputs: int, gamma: float = KERNEL_GAMMA, seed: int = 42) -> KernelMachine:
        model = OneVsRestModel.load(path)
        return cls(model, n_inputs, model.models[0].numFeatures, gamma, seed)


@dataclass(frozen=True)
class NamedFeatures:
    """A model over a ``features`` vector, applied to named columns."""

    model: object
    features: Sequence[str]

    def transform(self, df: DataFrame) -> DataFrame:
        vector = VectorAssembler(inputCols=list(self.features), outputCol="features", handleInvalid="keep")
        return self.model.transform(vector.transform(df))


def fit_kernel_svc(train: DataFrame, n_inputs: int, c: float = KERNEL_C, gamma: float = KERNEL_GAMMA, n_components: int = 256,
                   max_iter: int = 50, seed: int = 42) -> KernelMachine:
    """RBF support-vector classifier with balanced class weights, approximated.
    The mean-loss form of the C-machine has regularisation 1 / (C n)."""
    n_rows = train.count()
    lifted = with_class_weight(fourier_features(train, n_inputs, n_components, gamma, seed), "label")
    model = linear_one_vs_rest(1.0 / (c * max(n_rows, 1)), max_iter).fit(lifted)
    return KernelMachine(model, n_inputs, n_components, gamma, seed)


@dataclass(frozen=True)
class LandmarkMachine:
    """One-vs-rest machines over Nystroem features. Saved as the landmark rows and the machines; the whitening
    follows from the rows."""

    model: OneVsRestModel
    landmarks: Landmarks

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(kernels.map_features(df, self.landmarks))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, point, self.landmarks.gamma) for i, point in enumerate(self.landmarks.points.tolist())]
        spark.createDataFrame(rows, "place int, point array<double>, gamma double").coalesce(1).write.mode("overwrite").parquet(f"{path}/landmarks")
        self.model.write().overwrite().save(f"{path}/machines")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LandmarkMachine:
        rows = spark.read.parquet(f"{path}/landmarks").orderBy("place").collect()  # at most kernels.MAX_LANDMARKS
        points = np.array([row["point"] for row in rows], dtype=np.float64)
        return cls(OneVsRestModel.load(f"{path}/machines"), Landmarks(points, rows[0]["gamma"]))


def fit_landmark_svc(train: DataFrame, c: float = KERNEL_C, gamma: float = KERNEL_GAMMA, n_landmarks: int = 256, max_iter: int = 50,
                     seed: int = 42) -> LandmarkMachine:
    """``fit_kernel_svc`` over landmark rows of the data instead of random projections; the mapped rows are stored
    once. Needs at least one row."""
    points = kernels.choose_landmarks(train.select(vector_to_array("features").alias("v")), "v", n_landmarks, seed)
    landmarks = Landmarks(points, gamma)
    base = _stored(with_class_weight(kernels.map_features(train, landmarks), "label"))
    try:
        model = linear_one_vs_rest(1.0 / (c * max(base.count(), 1)), max_iter).fit(base)
    finally:
        base.unpersist()
    return LandmarkMachine(model, landmarks)


def fit_poly_svc(train: DataFrame, classes: Sequence[int], c: float = 1.0, gamma: float = 0.1, degree: int = 3, max_iter: int = 50) -> Callable[[DataFrame], DataFrame]:
    """One-vs-rest machines on polynomial features with balanced weights per class
    task; adds ``margins``, one decision value per class."""
    rows = cut_lineage(train.select("features", "label"))
    n_rows = rows.count()
    # expanded rows are many times wider than their inputs: the inputs are spread, and expanded a few at a time
    base = spread(rows, n_rows, EXPANDED_ROWS)
    # inputs times sqrt(gamma), so that products carry the kernel's scale
    scale = math.sqrt(gamma)
    models = _class_machines(base, "features", classes, n_rows, c, max_iter, 1, (scale, degree))

    def scored(df: DataFrame) -> DataFrame:
        spaced = spread(df, df.count(), EXPANDED_ROWS)
        return spaced.withColumn("margins", polynomial.margins(F.col("features"), models, scale, degree, df.sparkSession))
    return scored


def fit_sketched_poly_svc(train: DataFrame, n_inputs: int, classes: Sequence[int], c: float = 1.0, gamma: float = 0.1, degree: int = 3,
                          n_components: int = 1_024, max_iter: int = 50, seed: int = 42, parallelism: int = 2) -> Callable[[DataFrame], DataFrame]:
    """``fit_poly_svc`` over a sketch of the kernel without constant, whose width does not grow with inputs and
    degree; the sketched rows are stored once and read by the machines of all classes."""
    sketch = TensorSketch(n_inputs, n_components, degree, gamma, seed)

    def lifted(df: DataFrame) -> DataFrame:
        return df.withColumn("poly", array_to_vector(kernels.lifted(vector_to_array("features"), sketch)))

    base = _stored(lifted(train).select("poly", "label"))
    try:
        models = _class_machines(base, "poly", classes, base.count(), c, max_iter, parallelism)
    finally:
        base.unpersist()
    return lambda df: _with_margins(lifted(df), "poly", models).drop("poly")


def _class_machines(base: DataFrame, vec: str, classes: Sequence[int], n_rows: int, c: float, max_iter: int, parallelism: int = 1,
                    expansion: tuple[float, int] | None = None) -> dict:
    """A linear machine with balanced weights for each class against the rest; over the polynomial ``expansion`` (scale,
    degree) of the inputs, one pass serves those of all classes."""
    if expansion:
        # one array leaves a partition: no more of them than cores
        cores = base.sparkSession.sparkContext.defaultParallelism
        return polynomial.fit_machines(cut_lineage(base.coalesce(cores)), classes, *expansion, 1.0 / (c * max(n_rows, 1)), max_iter)
    def task(cls):
        def fit():
            rows = with_class_weight(base.withColumn("target", (F.col("label") == cls).cast("double")), "target")
            return LinearSVC(featuresCol=vec, labelCol="target", weightCol="weight", maxIter=max_iter, regParam=1.0 / (c * max(n_rows, 1)),
                             standardization=False, rawPredictionCol=f"raw_{cls}", predictionCol=f"hit_{cls}").fit(rows)
        return fit
    return dict(zip(classes, _side_by_side([task(cls) for cls in classes], parallelism)))


def _with_margins(df: DataFrame, vec: str, models: dict) -> DataFrame:
    """``margins``: the decision value of each class."""
    scored = df
    for model in models.values():
        scored = model.transform(scored)
    margins = F.array(*[F.get(vector_to_array(f"raw_{cls}"), F.lit(1)) for cls in models])
    return scored.withColumn("margins", margins).drop(*[f"{p}_{cls}" for cls in models for p in ("raw", "hit")])


def evaluate(scored: DataFrame, classes: Sequence[int] | None = None) -> dict[str, float]:
    """Metrics of a scored frame; ROC-AUC only with a probability column."""
    row = E.classification_metrics(scored).first()
    metrics = {name: float(row[name]) for name in ("accuracy", "balanced_accuracy", "f1_weighted", "composite_score")}
    if classes is not None and "probability" in scored.columns:
        arrays = scored.withColumn("p", vector_to_array("probability"))
        found = E.macro_roc_auc(arrays, "p", classes).first()["roc_auc"]
        if found is not None:
            metrics["roc_auc"] = float(found)
    return metrics


def _accuracy(scored: DataFrame) -> float:
    return float(scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] or 0.0)


def _stored(df: DataFrame) -> DataFrame:
    """Read by many fits: checkpointed, which also settles on as few partitions as
    the data needs, then kept near the executors."""
    return cut_lineage(df).persist()


def spread(df: DataFrame, n_rows: int, rows_each: int = PARTITION_ROWS) -> DataFrame:
    """``df`` dealt out in turn: a small file is one partition, which one core alone would work on, fit after fit."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-n_rows // rows_each)))


def _side_by_side(tasks: list[Callable], parallelism: int) -> list:
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return [future.result() for future in [pool.submit(task) for task in tasks]]


def _tree_nodes(estimator: RandomForestClassifier, n_rows: int) -> int:
    """Nodes of a tree, at most."""
    return min(2 ** (estimator.getMaxDepth() + 1), 2 * n_rows // estimator.getMinInstancesPerNode() + 1)


def _fits_at_once(estimator: Estimator, n_rows: int, parallelism: int) -> int:
    """How many fits run side by side: the driver holds the nodes of every forest that grows, so large ones take turns."""
    if not isinstance(estimator, RandomForestClassifier):
        return parallelism
    nodes = estimator.getNumTrees() * _tree_nodes(estimator, n_rows)
    kept = 16 * estimator.getNumTrees() * max(n_rows, 1)
    return max(1, min(parallelism, MAX_GROWN_NODES // nodes, MAX_KEPT_BYTES // kept))


@dataclass(frozen=True)
class ForestParts:
    """A forest grown in parts: the votes of all its trees, summed as one model would."""

    models: Sequence[Model]

    def transform(self, df: DataFrame) -> DataFrame:
        scored = df
        for i, model in enumerate(self.models):
            scored = model.copy({model.rawPredictionCol: f"_votes_{i}", model.probabilityCol: "", model.predictionCol: ""}).transform(scored)
        arrays = [vector_to_array(f"_votes_{i}") for i in range(len(self.models))]
        votes = reduce(lambda total, part: F.zip_with(total, part, lambda x, y: x + y), arrays)
        best = (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")
        return scored.withColumn("_votes", votes).withColumn("prediction", best).drop("_votes", *[f"_votes_{i}" for i in range(len(self.models))])


def _part_sizes(estimator: RandomForestClassifier, n_rows: int, cores: int) -> list[int]:
    """Trees of each part: a part for each core, smaller ones where the nodes that grow together would pass the bound."""
    trees = estimator.getNumTrees()
    each = max(2, min(-(-trees // cores), MAX_GROWN_NODES // _tree_nodes(estimator, n_rows) // cores))
    n_parts = max(1, trees // each)
    return [trees // n_parts + (i < trees % n_parts) for i in range(n_parts)]


def _grow(estimator: Estimator, rows: DataFrame, n_rows: int, at_once: int) -> Model | ForestParts:
    """Fit as one of ``at_once`` fits side by side. Each partition sends the counts of every node, whatever rows it has, so
    a deep forest reads no more partitions than its share of the cores; one that takes its turn alone is grown in parts,
    which share the cores. A shallow one has few nodes and keeps its partitions."""
    if isinstance(estimator, BinnedForest) and estimator.can_grow():
        return estimator.grow(rows)
    if not isinstance(estimator, RandomForestClassifier) or _tree_nodes(estimator, n_rows) == 2 ** (estimator.getMaxDepth() + 1):
        return estimator.fit(rows)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    sizes = _part_sizes(estimator, n_rows, cores) if at_once == 1 else [estimator.getNumTrees()]
    together = max(1, min(len(sizes), cores, MAX_GROWN_NODES // (max(sizes) * _tree_nodes(estimator, n_rows))))
    read = rows.coalesce(max(1, cores // (at_once * together), -(-n_rows // PARTITION_ROWS)))
    if len(sizes) == 1:
        return estimator.fit(read)

    def part(i):
        return lambda: estimator.copy({estimator.numTrees: sizes[i], estimator.seed: estimator.getSeed() + i}).fit(read)
    with ThreadPoolExecutor(max_workers=together) as pool:
        return ForestParts([future.result() for future in [pool.submit(part(i)) for i in range(len(sizes))]])


def cross_validate(df: DataFrame, estimator: Estimator, key: str, n_folds: int = 5, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """(fold, accuracy) of stratified shuffled folds."""
    folded = _stored(stratified_folds(df, "label", key, n_folds, seed))
    try:
        def task(fold):
            def run():
                model = _grow(estimator, folded.filter(F.col("fold") != fold), n_rows, at_once)
                accuracy = _accuracy(model.transform(folded.filter(F.col("fold") == fold)))
                _released(model)
                return fold, accuracy
            return run
        n_rows = folded.count()
        at_once = _fits_at_once(estimator, n_rows, parallelism)
        rows = _side_by_side([task(fold) for fold in range(n_folds)], at_once)
    finally:
        folded.unpersist()
    return df.sparkSession.createDataFrame(rows, "fold int, accuracy double")


def fold_summary(folds: DataFrame) -> DataFrame:
    return folds.agg(F.avg("accuracy").alias("mean"), F.stddev_pop("accuracy").alias("std"))


def learning_curve(df: DataFrame, estimator: Estimator, key: str, fractions: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0),
                   n_folds: int = 5, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """(fraction, fold, n_train, train_accuracy, test_accuracy). The training rows
    of smaller fractions are contained in those of larger ones."""
    folded = _stored(stratified_folds(df, "label", key, n_folds, seed).withColumn("_pick", stable_hash(key, seed=seed + 1)))
    try:
        def task(fraction, fold, n_train, at_once):
            def run():
                taught, tested = (F.col("fold") != fold) & (F.col("_pick") < int(fraction * HASH_RANGE)), F.col("fold") == fold
                model = _grow(estimator, folded.filter(taught), n_train, at_once)
                # both sides in one pass: a model of many nodes is sent out once
                scored, hit = model.transform(folded.filter(taught | tested)), (F.col("label") == F.col("prediction")).cast("double")
                n_rows, *found = scored.agg(F.count_if(taught), F.avg(F.when(taught, hit)), F.avg(F.when(tested, hit))).first()
                _released(model)
                return (float(fraction), fold, n_rows, *(float(x or 0.0) for x in found))
            return run
        # small fractions grow small trees: each takes turns by its own rows, not by those of the largest
        picked = folded.groupBy("fold").agg(*[F.count_if(F.col("_pick") < int(f * HASH_RANGE)).alias(f"n{i}") for i, f in enumerate(fractions)]).collect()
        rows = []
        for i, fraction in enumerate(fractions):
            n_train = max((sum(r[f"n{i}"] for r in picked if r["fold"] != fold) for fold in range(n_folds)), default=0)
            at_once = _fits_at_once(estimator, n_train, parallelism)
            rows += _side_by_side([task(fraction, fold, n_train, at_once) for fold in range(n_folds)], at_once)
    finally:
        folded.unpersist()
    return df.sparkSession.createDataFrame(rows, "fraction double, fold int, n_train bigint, train_accuracy double, test_accuracy double")


def curve_summary(curve: DataFrame) -> DataFrame:
    return curve.groupBy("fraction").agg(
        F.avg("n_train").alias("n_train"), F.avg("train_accuracy").alias("train_mean"), F.stddev_pop("train_accuracy").alias("train_std"),
        F.avg("test_accuracy").alias("test_mean"), F.stddev_pop("test_accuracy").alias("test_std")).orderBy("fraction")


def eliminate_features(df: DataFrame, features: Sequence[str], label: str, key: str, estimator: RandomForestClassifier, step: int = 1,
                       n_folds: int = 5, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """(n_features, mean_accuracy, features): recursive elimination. Each fold drops
    its weakest features by itself and scores every size; the final lists come from
    the same elimination on all rows. The best size is the highest mean, the
    smaller on ties."""
    folded = stratified_folds(df, label, key, n_folds, seed)
    n_rows = df.count()
    folded = _stored(spread(folded, n_rows).sortWithinPartitions(*[f"`{f}`" for f in features]) if n_rows >= SORTED_ROWS else folded)
    try:
        def path(train, test):
            left, scores, kept = list(features), {}, {}
            while left:
                model = _fitted(estimator, assemble(train, left, label))
                kept[len(left)] = list(left)
                if test is not None:
                    scores[len(left)] = _accuracy(model.transform(assemble(test, left, label)))
                _released(model)
                if len(left) == 1:
                    break
                weight = model.importances if isinstance(model, GrownForest) else model.featureImportances.toArray()
                weakest = sorted(range(len(left)), key=lambda i: (weight[i], -i))[:min(step, len(left) - 1)]
                left = [f for i, f in enumerate(left) if i not in set(weakest)]
            return scores, kept

        tasks = [(lambda f=f: path(folded.filter(F.col("fold") != f), folded.filter(F.col("fold") == f))) for f in range(n_folds)]
        results = _side_by_side([*tasks, lambda: path(folded, None)], _fits_at_once(estimator, n_rows, parallelism))
    finally:
        folded.unpersist()
    kept = results[-1][1]
    rows = [(size, float(np.mean([scores[size] for scores, _ in results[:-1]])), kept[size]) for size in sorted(kept)]
    return df.sparkSession.createDataFrame(rows, "n_features int, mean_accuracy double, features array<string>")


def chosen_features(path: DataFrame) -> list[str]:
    return path.orderBy(F.desc("mean_accuracy"), "n_features").first()["features"]


def run_record(spark, model: str, metrics: dict[str, float], params: dict | None = None, tags: dict | None = None,
               parent_id: str | None = None, run_id: str | None = None) -> DataFrame:
    """One append-only run-log row."""
    row = (run_id or uuid.uuid4().hex, parent_id, model, {k: str(v) for k, v in (params or {}).items()},
           {k: float(v) for k, v in metrics.items()}, {k: str(v) for k, v in (tags or {}).items()})
    schema = "run_id string, parent_id string, model string, params map<string,string>, metrics map<string,double>, tags map<string,string>"
    return spark.createDataFrame([row], schema).withColumn("logged_at", F.current_timestamp())


def save_model(model: Model, path: str) -> None:
    wrapped = model if isinstance(model, PipelineModel) else PipelineModel([model])
    wrapped.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_pipeline(train: DataFrame, features: Sequence[str], estimator: Estimator) -> PipelineModel:
    """Assembler and estimator as one persistable model over named columns. Rows are spread over the cores and stored in
    the order of their values, so that every pass and every run draws the same rows for a tree."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    read = [f"`{c}`" for c in dict.fromkeys([*features, estimator.getLabelCol()])]
    rows = train.select(*read)
    if isinstance(estimator, BinnedForest) and estimator.can_grow():
        # its draws follow stored bins, whatever the order of the rows
        return PipelineModel([assembler, estimator.grow(assembler.transform(cut_lineage(rows)))])
    return Pipeline(stages=[assembler, estimator]).fit(cut_lineage(spread(rows, rows.count()).sortWithinPartitions(*read)))

"""The row-preserving layer chain: staged -> cleaned -> features -> model table.

Every layer is one lazy projection over the one before, so Catalyst collapses the
chain and prunes to the columns a consumer asks for. Vocabularies, columns and
contract are configuration.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortline.functions.numeric import flag_sum, log1p
from cohortline.functions.text import LabelRule, lower_trim, normalise_label, ordinal_encode
from cohortline.operators import checks as C
from cohortline.operators.columns import project, rename_first, replace_at_end, star_exclude


@dataclass(frozen=True)
class LayerConfig:
    source_columns: tuple[str, ...]
    folded_text: tuple[str, ...] = ()
    label_column: str | None = None
    label_rules: tuple[LabelRule, ...] = ()
    label_default: str = "other"
    constant_columns: tuple[str, ...] = ()
    log_columns: tuple[str, ...] = ()
    correlated_columns: tuple[str, ...] = ()
    flag_columns: tuple[str, ...] = ()
    flag_sum_column: str = "flag_count"
    skip_null_flags: bool = False
    id_columns: tuple[str, ...] = ()
    encoders: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    renames: tuple[tuple[str, str], ...] = ()
    contract: StructType | None = None
    layer_checks: Mapping[str, tuple[C.ColumnCheck, ...]] = field(default_factory=dict)
    fingerprint_columns: tuple[str, ...] = ()
    duplicate_band: tuple[float, float] | None = None
    id_band: tuple[str, int, int] | None = None


def staged_with_raw_label(raw: DataFrame, cfg: LayerConfig) -> DataFrame:
    """Staged rows plus the trimmed raw label, for checks that report it."""
    df = project(raw, cfg.source_columns)
    df = df.withColumns({c: lower_trim(F.col(c)) for c in cfg.folded_text})
    if cfg.label_column is None:
        return df
    label = cfg.label_column
    df = df.withColumn(f"{label}_raw", F.trim(F.col(label)))
    return replace_at_end(df, {label: normalise_label(F.col(label), cfg.label_rules, cfg.label_default)})


def stage(raw: DataFrame, cfg: LayerConfig) -> DataFrame:
    df = staged_with_raw_label(raw, cfg)
    return star_exclude(df, [f"{cfg.label_column}_raw"]) if cfg.label_column else df


def clean(staged: DataFrame, cfg: LayerConfig) -> DataFrame:
    df = star_exclude(staged, cfg.constant_columns)
    df = replace_at_end(df, {c: log1p(F.col(c)) for c in cfg.log_columns})
    return star_exclude(df, cfg.correlated_columns)


def add_features(cleaned: DataFrame, cfg: LayerConfig) -> DataFrame:
    if not cfg.flag_columns:
        return cleaned
    return cleaned.withColumn(cfg.flag_sum_column, flag_sum(cfg.flag_columns, cfg.skip_null_flags))


def _encoded(features: DataFrame, cfg: LayerConfig) -> DataFrame:
    df = star_exclude(features, cfg.id_columns)
    df = replace_at_end(df, {c: ordinal_encode(F.col(c), codes) for c, codes in cfg.encoders.items()})
    return rename_first(df, cfg.renames)


def model_table(features: DataFrame, cfg: LayerConfig) -> DataFrame:
    df = _encoded(features, cfg)
    return C.enforce_schema(df, cfg.contract) if cfg.contract is not None else df


def layer_chain(raw: DataFrame, cfg: LayerConfig) -> dict[str, DataFrame]:
    """All layers by name, lazily, in build order."""
    staged = stage(raw, cfg)
    cleaned = clean(staged, cfg)
    features = add_features(cleaned, cfg)
    return {"raw": raw, "staged": staged, "cleaned": cleaned, "features": features, "model": model_table(features, cfg)}


def _column_checks(raw: DataFrame, cfg: LayerConfig) -> DataFrame | None:
    """The column checks of every layer over one scan: each layer's check columns
    travel with the rows through the layers after it."""
    marks = []
    df = raw
    steps = (("staged", stage), ("cleaned", clean), ("features", add_features), ("model", _encoded))
    for name, step in steps:
        # staging selects its columns by name, so its flags start after it
        df, found = C.flag_violations(step(df, cfg), name, cfg.layer_checks.get(name, ()))
        marks += found
    return C.count_violations(df, marks) if marks else None


def check_layers(raw: DataFrame, layers: Mapping[str, DataFrame], cfg: LayerConfig) -> DataFrame:
    """One result row per check over all layers."""
    columns = _column_checks(raw, cfg)
    results = [columns] if columns is not None else []
    results.append(C.summarise(C.row_loss(C.layer_counts(dict(layers)), "raw"), "row_loss", "all", None, "error"))
    if cfg.duplicate_band:
        rate = C.duplicate_rate(layers["staged"], cfg.fingerprint_columns)
        results.append(C.summarise(C.outside_band(rate, "duplicate_rate", *cfg.duplicate_band), "duplicate_rate", "staged", None, "warn"))
    if cfg.id_band:
        column, low, high = cfg.id_band
        found = C.id_cardinality(layers["staged"], column)
        results.append(C.summarise(C.outside_band(found, "distinct_ids", low, high), "id_cardinality", "staged", column, "error"))
    if cfg.label_column:
        unmapped = C.unmapped_labels(staged_with_raw_label(raw, cfg), f"{cfg.label_column}_raw", cfg.label_column, cfg.label_default)
        results.append(C.summarise(unmapped, "unmapped_labels", "staged", cfg.label_column, "error"))
    combined = results[0]
    for result in results[1:]:
        combined = combined.unionByName(result)
    return combined


def materialise(raw: DataFrame, cfg: LayerConfig, prefix: str = "", mart_database: str = "marts",
                results_path: str | None = None) -> list[str]:
    """Check every layer, then publish: views for staged and cleaned, tables for
    features and the model table. A failed error-severity check stops before any
    table is replaced; the returned names are failed warnings."""
    spark = raw.sparkSession
    layers = layer_chain(raw, cfg)
    results = check_layers(raw, layers, cfg)
    if results_path:
        results.write.mode("overwrite").parquet(results_path)
        results = spark.read.parquet(results_path)
    warnings = C.enforce(results)
    layers["staged"].createOrReplaceTempView(f"{prefix}staged")
    layers["cleaned"].createOrReplaceTempView(f"{prefix}cleaned")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {mart_database}")
    features = f"{mart_database}.{prefix}features"
    layers["features"].write.mode("overwrite").saveAsTable(features)
    # from the narrower table just written, not from the raw source again
    model = model_table(spark.table(features), cfg)
    model.write.mode("overwrite").saveAsTable(f"{mart_database}.{prefix}model")
    return warnings

"""Session defaults, and what is stored in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

def build_session(app_name: str = "cohortline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume (UTC, AQE, no web page)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if current:
        if not context.getCheckpointDir():
            context.setCheckpointDir(current)
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortline-checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that a lost executor never replays the steps before it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder once and read it back: cut lineage of a known size."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin_small(df: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """A statistics table (one row per column, class or bucket) computed once and
    kept as a local relation, so that plans using it several times neither repeat
    the scans behind it nor guess its size. Anything larger is checkpointed."""
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return cut_lineage(df)
    return df.sparkSession.createDataFrame(rows, df.schema)

"""Loading record tables from CSV and writing them out."""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortline.functions.names import plan_names

# Texts read as null, besides the empty field.
NULL_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

LOAD_ID = "_load_id"
ROW_ID = "_row_id"


@dataclass(frozen=True)
class LoadResult:
    status: str
    data: DataFrame | None
    lost_columns: tuple[tuple[str, str], ...] = field(default=())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence on whatever file system the path names (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header. A schema avoids the extra pass that inference costs and
    is what a production load should give; its columns are found by their names in
    the header, whatever their order, and a name missing on either side raises; without one the types are inferred
    from the texts after the null markers are removed. ``multi_line`` accepts line
    breaks inside quotes, but then a file is read by one task."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if schema is not None:
        kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        text = reader.csv(path)  # all texts; only the header line is read for the names
        missing, unknown = set(kinds.names) - set(text.columns), set(text.columns) - set(kinds.names)
        if missing or unknown:
            raise ValueError(f"{path}: columns missing {sorted(missing)}, unknown {sorted(unknown)}")
        return text.select(*[_null_marked(f.name).cast(f.dataType).alias(f.name) for f in kinds.fields])
    text = reader.csv(path)
    cleaned = text.select(*[_null_marked(name).alias(name) for name in text.columns])
    kinds = _column_kinds(cleaned)
    return cleaned.select(*[F.col(f"`{name}`").cast(kinds[name]).alias(name) for name in text.columns])


def _null_marked(name: str):
    col = F.col(f"`{name}`")
    return F.when(~col.isin(*NULL_TEXTS), col)


def _column_kinds(text: DataFrame) -> dict[str, str]:
    """bigint, double or string per column, in one aggregate pass. A whole-number
    column with nulls reads as double."""
    checks = []
    for position, name in enumerate(text.columns):
        col = F.col(f"`{name}`")
        whole = F.trim(col).rlike(r"^[+-]?\d+$") & col.try_cast("bigint").isNotNull()
        checks += [
            F.coalesce(F.bool_and(F.when(col.isNotNull(), whole)), F.lit(False)).alias(f"w{position}"),
            F.coalesce(F.bool_and(F.when(col.isNotNull(), col.try_cast("double").isNotNull())), F.lit(True)).alias(f"d{position}"),
            (F.count(col) < F.count(F.lit(1))).alias(f"n{position}"),
        ]
    found: dict[str, str] = {}
    row = text.agg(*checks).first()
    for position, name in enumerate(text.columns):
        if row[f"w{position}"] and not row[f"n{position}"]:
            found[name] = "bigint"
        else:
            found[name] = "double" if row[f"d{position}"] else "string"
    return found


def load_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             keep: str = "underscore", load_id: str | None = None, multi_line: bool = False) -> LoadResult:
    """CSV with normalised names and load metadata; a missing or empty file gives
    status ``missing`` / ``empty`` and must not replace an earlier load."""
    if not path_exists(spark, path):
        return LoadResult("missing", None)
    raw = read_csv(spark, path, schema, multi_line)
    if raw.isEmpty():
        return LoadResult("empty", None)
    names = plan_names(raw.columns, keep)
    renamed = raw.select(*[F.col(f"`{source}`").alias(target) for source, target in names.kept])
    stamp = F.lit(load_id) if load_id else F.date_format(F.current_timestamp(), "yyyyMMddHHmmssSSS")
    return LoadResult("loaded", renamed.withColumns({LOAD_ID: stamp, ROW_ID: F.uuid()}), names.lost)


def replace_table(result: LoadResult, table: str) -> bool:
    """Full refresh of a table; nothing is written when nothing was loaded."""
    if result.data is None:
        return False
    database = table.rpartition(".")[0]
    if database:
        result.data.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    result.data.write.mode("overwrite").saveAsTable(table)
    return True


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalogue table by name, or parquet by path."""
    if "/" in name_or_path or urlparse(name_or_path).scheme:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def column_catalogue(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, position, type) of the given frames, from schemas alone."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (table, f.name, position, f.dataType.simpleString())
        for table, df in tables.items()
        for position, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, position int, data_type string")

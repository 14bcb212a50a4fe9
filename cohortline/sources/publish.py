"""Tables published by versions: written beside the old one, checked, then switched.

``root``/versions/<id> holds the data, ``root``/manifest one small file per published version, numbered
in order. A version counts from the moment its manifest file has its name, which a rename gives it
at once; readers take the highest number. A version that fails its checks never gets one, so
the earlier version stays what readers see, and a load that dies half-way leaves it untouched.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortline.operators import checks as C
from cohortline.sources.records import LoadResult, path_exists


@dataclass(frozen=True)
class Published:
    """``number`` is None where nothing was published; ``problems`` says why, or lists failed warnings."""

    number: int | None
    problems: tuple[str, ...] = ()


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, version id) of everything published, oldest first."""
    if not path_exists(spark, f"{root}/manifest"):
        return []
    _, path, files = _files(spark, f"{root}/manifest")
    names = [status.getPath().getName() for status in files.listStatus(path)]
    numbers = sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0].isdigit())
    if not numbers:
        return []
    found = spark.read.schema("number int, version string").json([f"{root}/manifest/{n:08d}.json" for n in numbers]).collect()
    return sorted((r["number"], r["version"]) for r in found)


def publish(loaded: DataFrame | LoadResult, root: str, checks: Callable[[DataFrame], DataFrame] | None = None) -> Published:
    """Write a version, run ``checks`` (a result per check, see ``operators.checks``) on what was written, switch.

    A missing or empty load and a failed check of severity error publish nothing. Two publishers at once cannot
    both take a number: the second rename fails."""
    if isinstance(loaded, LoadResult):
        if loaded.data is None:
            return Published(None, (loaded.status,))
        loaded = loaded.data
    spark = loaded.sparkSession
    version = uuid.uuid4().hex
    loaded.write.parquet(f"{root}/versions/{version}")
    problems: tuple[str, ...] = ()
    if checks:
        try:
            problems = tuple(C.enforce(checks(spark.read.schema(loaded.schema).parquet(f"{root}/versions/{version}"))))
        except C.CheckFailed as failed:
            return Published(None, (str(failed),))
    number = max((n for n, _ in versions(spark, root)), default=0) + 1
    jvm, folder, files = _files(spark, f"{root}/manifest")
    files.mkdirs(folder)
    draft, final = (jvm.org.apache.hadoop.fs.Path(f"{root}/manifest/{name}") for name in (f"_{version}", f"{number:08d}.json"))
    out = files.create(draft, False)
    out.write(bytearray(json.dumps({"number": number, "version": version}).encode()))
    out.close()
    if files.exists(final) or not files.rename(draft, final):
        raise RuntimeError(f"version {number} of {root} was published by someone else")
    return Published(number, problems)


def read_published(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The latest published version, or the one of the given number."""
    found = dict(versions(spark, root))
    if not found or (number is not None and number not in found):
        raise FileNotFoundError(f"{root}: no published version" + (f" {number}" if number is not None else ""))
    return spark.read.parquet(f"{root}/versions/{found[max(found) if number is None else number]}")

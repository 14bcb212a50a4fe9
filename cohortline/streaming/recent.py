"""Drift of the recent part of a stream: the last triggers, events or hours.

Place counts (``operators.drift``) add up, so they can be taken away again. Each trigger stores its own
counts, per slot (a trigger or an event hour), adds them to the running sum and subtracts the slots
that left the window. A trigger costs what is new, what expires and the sum itself, however long
the window is. Sum and list of live slots are in two folders that take turns, so that a replayed
trigger starts from the same state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortline.operators import drift as D
from cohortline.session import pin_small
from cohortline.sources import logs

KEYS = ("feature", "bin", "place", "on_point")
COUNT_SCHEMA = "feature string, bin int, place int, on_point boolean, n bigint, total double"
SLOT_SCHEMA = "slot bigint, trigger bigint, n bigint, stored boolean"


@dataclass(frozen=True)
class Last:
    """What counts as recent; exactly one is given. ``triggers``: the last triggers. ``events``: the fewest last
    triggers that hold so many events with features. ``hours``: hours up to that of the latest event; events
    without a time are left out, events of hours already expired too."""

    triggers: int | None = None
    events: int | None = None
    hours: int | None = None

    def __post_init__(self):
        if sum(x is not None for x in (self.triggers, self.events, self.hours)) != 1:
            raise ValueError("give one of triggers, events, hours")

    def live(self, slots: dict[tuple[int, int], int]) -> set[tuple[int, int]]:
        """Those of the (slot, trigger), with their numbers of events, that stay."""
        newest = max((slot for slot, _ in slots), default=0)
        if self.events is None:
            size = self.hours if self.triggers is None else self.triggers
            return {(slot, trigger) for slot, trigger in slots if slot > newest - size}
        kept, held = set(), 0
        for place in sorted(slots, reverse=True):
            if held >= self.events:
                break
            kept.add(place)
            held += slots[place]
        return kept


def start_recent_drift(predictions: DataFrame, reference: DataFrame, last: Last, path: str, report_path: str, checkpoint: str,
                       features: list[str] | None = None, refresh: int = 100, available_now: bool = True) -> StreamingQuery:
    """Report of the recent events after every trigger. Sums of doubles drift by rounding when terms are
    subtracted, so every ``refresh`` triggers the sum is made anew from the live slots."""
    def folder(trigger: int, slot: int) -> str:
        return f"{path}/slots/trigger={trigger}/slot={slot}"

    def counts_of(spark: SparkSession, slots: list[tuple[int, int]], sign: int = 1) -> DataFrame:
        if not slots:
            return spark.createDataFrame([], COUNT_SCHEMA)
        found = spark.read.schema(COUNT_SCHEMA).parquet(*[folder(trigger, slot) for slot, trigger in slots])
        return found.select(*KEYS, (F.col("n") * sign).alias("n"), (F.col("total") * sign).alias("total"))

    def check(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known: dict[tuple[int, int], int] = {}
        stored: set[tuple[int, int]] = set()
        if batch_id > 0:
            # one row per live slot
            for r in spark.read.schema(SLOT_SCHEMA).parquet(f"{path}/live/turn-{(batch_id - 1) % 2}").collect():
                known[r["slot"], r["trigger"]] = r["n"]
                stored |= {(r["slot"], r["trigger"])} if r["stored"] else set()
        slot = F.lit(batch_id) if last.hours is None else F.floor(F.unix_timestamp("ts") / 3600)
        # only what is read below, so that the other fields of a line are neither taken out nor kept
        events = batch.filter("features IS NOT NULL").select("features", slot.cast("bigint").alias("slot")).filter("slot IS NOT NULL").persist()
        try:
            sizes = events.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per slot
            fresh = {(r["slot"], batch_id): r["n"] for r in sizes}
            live = last.live({**known, **fresh})
            new = [place for place in fresh if place in live]
            recent = events.filter(F.col("slot").isin([s for s, _ in new])) if new else events.limit(0)
            values = logs.feature_values(recent, features, keep=["slot"])
            counted = D.place_counts(values, reference, by=["slot"])
            counted.write.mode("overwrite").partitionBy("slot").parquet(f"{path}/slots/trigger={batch_id}")
        finally:
            events.unpersist()
        # slots whose events carry no number of a known feature have no folder
        written = spark.read.schema(COUNT_SCHEMA + ", slot bigint").parquet(f"{path}/slots/trigger={batch_id}")
        stored |= {(r["slot"], batch_id) for r in written.select("slot").distinct().collect()}
        kept = [place for place in known if place in live]
        expired = [place for place in known if place not in live]
        if batch_id > 0 and batch_id % refresh:
            before = spark.read.schema(COUNT_SCHEMA).parquet(f"{path}/sum/turn-{(batch_id - 1) % 2}")
            parts = before.unionByName(counts_of(spark, [p for p in new if p in stored])).unionByName(
                counts_of(spark, [p for p in expired if p in stored], -1))
        else:
            parts = counts_of(spark, [p for p in [*kept, *new] if p in stored])
        total = parts.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("total").alias("total")).filter("n <> 0")
        total = pin_small(total, 200_000)
        total.write.mode("overwrite").parquet(f"{path}/sum/turn-{batch_id % 2}")
        sizes_of = {**known, **fresh}
        rows = [(*place, sizes_of[place], place in stored) for place in [*kept, *new]]
        spark.createDataFrame(rows, SLOT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/live/turn-{batch_id % 2}")
        D.drift_from_counts(total, reference).repartition(1).write.mode("overwrite").parquet(report_path)

    writer = predictions.writeStream.option("checkpointLocation", checkpoint).foreachBatch(check)
    return (writer.trigger(availableNow=True) if available_now else writer).start()

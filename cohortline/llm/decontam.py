"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask names the word positions of a window that count; the others may differ. Both sides hash
every window of every mask, equal hashes join, and each hit fixes an alignment of document and
benchmark item. The alignment is verified word by word: the best stretch of ``window`` words must
agree in at least ``min_percent`` of them, so that substituted words between hits do not hide a copy.

The masks of an item follow from its length: the heaviest family of which some mask fits between the
substituted words wherever these lie. Every placement is tried when the plan is made, so that no
stretch that would verify goes without a hit.

Only windows whose hashes may occur in the benchmark leave the documents: two bitmaps of bounded
size, over the first two words and over whole windows, are literals of the plan. They only spare
shuffled rows; the join on the hashes decides, whatever the size of the benchmark.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import let, store

#: Families of masks (1: the word counts), the heaviest first. All start with two counted words, which the first bitmap tests.
FAMILIES = (
    ("11101011", "1100100001011", "110010000010011", "1100001111", "110110101"),
    ("111011", "1100001011", "11010011", "110100000011"),
    ("11011", "1111", "1100011"),
    ("111", "1101"),
)
#: With more placements of the substituted words than this, none is tried: a run of words is the mask.
MAX_PLACEMENTS = 20_000
WINDOW = 20
MIN_PERCENT = 75
#: Largest bitmap: 2 ** 22 bits, 512 KiB. Fewer where the benchmark is small; a larger one fills it more, which
#: costs shuffled rows only.
MAX_BITMAP_BITS = 22
#: Alignments are verified by stretches of a document in which so many of them begin.
STRETCH = 1024


def hits_all(masks: tuple[str, ...], length: int, misses: int) -> bool:
    """Whether some mask fits between any ``misses`` substituted words of a stretch of ``length``."""
    places = [sum(1 << start + at for at, bit in enumerate(mask) if bit == "1") for mask in masks for start in range(length - len(mask) + 1)]
    return all(any(not place & wrong for place in places) for wrong in (sum(1 << at for at in chosen) for chosen in combinations(range(length), misses)))


@lru_cache(maxsize=None)
def masks_of(length: int, min_percent: int = MIN_PERCENT) -> tuple[str, ...]:
    """Masks that hit every stretch of ``length`` words of which ``min_percent``, and at least one word, agree."""
    misses = min(length * (100 - min_percent) // 100, length - 1)
    if math.comb(length, misses) <= MAX_PLACEMENTS:
        for family in FAMILIES:
            if hits_all(family, length, misses):
                return tuple(mask for mask in family if len(mask) <= length)
    # the agreeing words lie in at most misses + 1 runs
    return ("1" * -(-(length - misses) // (misses + 1)),)


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _pair(hashes: Column, i: Column) -> Column:
    return F.xxhash64(hashes[i], hashes[i + 1])


def _seed(hashes: Column, i: Column, mask: str) -> Column:
    """Null where the mask does not fit."""
    return F.when(i + len(mask) <= F.size(hashes), F.xxhash64(F.lit(mask), *[F.get(hashes, i + at) for at, bit in enumerate(mask) if bit == "1"]))


def _starts(hashes: Column, span: int) -> Column:
    """Positions at which a window fits; none in a shorter text."""
    return F.when(F.size(hashes) >= span, F.sequence(F.lit(0), F.size(hashes) - span)).otherwise(F.array().cast("array<int>"))


def _bitmap(keys: DataFrame) -> tuple[int, Column]:
    """Number of address bits, and an array literal of 64-bit words, of the keys' leading bits."""
    distinct = keys.distinct().count()
    bits = min(MAX_BITMAP_BITS, max(10, (16 * distinct).bit_length()))
    at = F.shiftrightunsigned("key", 64 - bits)
    # at most 2 ** (MAX_BITMAP_BITS - 6) rows
    rows = keys.groupBy(F.shiftright(at, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 63 as int))")).alias("value")).collect()
    values = [0] * (1 << (bits - 6))
    for r in rows:
        values[r["word"]] = r["value"]
    return bits, F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _may_hold(bitmap: tuple[int, Column], key: Column) -> Column:
    bits, words = bitmap
    at = F.shiftrightunsigned(key, 64 - bits)
    return F.getbit(words[F.shiftright(at, 6).cast("int")], at.bitwiseAND(F.lit(63)).cast("int")) == 1


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 item_column: str = "item_id", item_text_column: str = "text", window: int = WINDOW,
                 min_percent: int = MIN_PERCENT) -> DataFrame:
    """One row per document and item that verifiably overlap: doc_id, item_id, matched_words and
    window_words of the best stretch (the shorter of ``window`` and the item), doc_start (its first
    word; the earliest of equally good ones).

    Items of any length count, a single word too. Null texts have no words; items without words and rows without
    an id are left out; repeated rows give one result; an empty table on either side gives no rows;
    other columns are ignored.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where("doc_id is not null")
    items = benchmark.select(
        F.col(item_column).cast("long").alias("item_id"), words_of(F.col(item_text_column).cast("string")).alias("item_words")
    ).where("item_id is not null and size(item_words) > 0").distinct()
    items = items.withColumn("window_words", F.least(F.size("item_words"), F.lit(window)))
    items = store(items.withColumn("hashes", F.transform("item_words", lambda w: F.xxhash64(w))), "items")

    hashes = F.col("hashes")
    # at most ``window`` lengths; documents are searched for the masks of those that occur
    lengths_of: dict[str, list[int]] = {}
    for row in items.select("window_words").distinct().collect():
        for mask in masks_of(row["window_words"], min_percent):
            lengths_of.setdefault(mask, []).append(row["window_words"])
    if not lengths_of:
        lengths_of["11"] = []
    paired = sorted(mask for mask in lengths_of if mask.startswith("11"))
    single = sorted(mask for mask in lengths_of if not mask.startswith("11"))
    span = min(map(len, paired), default=2)
    pairs = items.select(F.explode(F.transform(_starts(hashes, span), lambda i: _pair(hashes, i))).alias("key"))

    def placed(mask: str) -> Column:
        return F.when(F.col("window_words").isin(lengths_of[mask]), F.transform(
            _starts(hashes, len(mask)), lambda i: F.struct(i.alias("item_at"), _seed(hashes, i, mask).alias("key"))))

    none = F.array().cast("array<struct<item_at:int,key:bigint>>")
    seeds = items.select("item_id", F.explode(F.flatten(F.array(none, *[F.coalesce(placed(mask), none) for mask in paired + single]))).alias("seed"))
    seeds = seeds.select("item_id", "seed.*").distinct()
    pair_map, seed_map = _bitmap(pairs), _bitmap(seeds.select("key"))

    def found(hashes: Column) -> Column:
        def hits(starts: Column, masks: list[str]) -> Column:
            return F.flatten(F.transform(starts, lambda i: F.transform(
                F.filter(F.array(*[_seed(hashes, i, mask) for mask in masks]), lambda key: key.isNotNull() & _may_hold(seed_map, key)),
                lambda key: F.struct(i.alias("doc_at"), key.alias("key")))))

        likely = F.filter(_starts(hashes, span), lambda i: _may_hold(pair_map, _pair(hashes, i)))
        parts = [(likely, paired), (_starts(hashes, 1), single)]
        return F.concat(*[hits(starts, masks) for starts, masks in parts if masks])

    hashed = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
    windows = store(texts.select("doc_id", let(hashed, found).alias("windows")), "windows")
    windows = windows.select("doc_id", F.explode("windows").alias("window")).select("doc_id", "window.*")
    alignments = store(
        windows.join(seeds, "key").select("doc_id", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct(), "alignments")

    # a document's words are split once and only the stretches that alignments fall on are kept
    longest = items.agg(F.coalesce(F.max(F.size("item_words")), F.lit(0))).first()[0]
    grouped = store(alignments.groupBy("doc_id", "item_id", F.floor(F.col("shift") / STRETCH).cast("int").alias("stretch")).agg(
        F.collect_set("shift").alias("shifts")), "grouped")  # at most STRETCH of them
    # stored, so that its size is known before the texts are joined: a small one is broadcast, a large one shuffled
    wanted = store(grouped.groupBy("doc_id").agg(F.collect_set("stretch").alias("wanted")), "stretches")
    stretches = texts.join(wanted, "doc_id").select("doc_id", F.explode(let(
        words_of(F.col("text")), lambda words: F.transform("wanted", lambda c: F.struct(
            c.alias("stretch"), F.greatest(c * STRETCH, F.lit(0)).alias("base"),
            F.slice(words, F.greatest(c * STRETCH, F.lit(0)) + 1, STRETCH + longest).alias("words"))))).alias("s"))
    aligned = stretches.select("doc_id", "s.*").join(grouped, ["doc_id", "stretch"]).join(
        items.select("item_id", "item_words", "window_words"), "item_id")

    def same_at(shift: Column) -> Column:
        return F.transform("item_words", lambda w, i: F.coalesce((F.get("words", i + shift - F.col("base")) == w).cast("int"), F.lit(0)))

    def best_stretch(same: Column, shift: Column) -> Column:
        return F.array_max(F.transform(
            F.sequence(F.lit(0), F.size(same) - F.col("window_words")),
            lambda s: F.struct(
                F.aggregate(F.slice(same, s + 1, F.col("window_words")), F.lit(0), lambda total, x: total + x).alias("matched"),
                (-(s + shift)).alias("minus_start"))))

    best = aligned.select("doc_id", "item_id", "window_words", F.array_max(F.transform(
        "shifts", lambda shift: let(same_at(shift), lambda same: best_stretch(same, shift)))).alias("best"))
    best = best.groupBy("doc_id", "item_id", "window_words").agg(F.max("best").alias("best"))
    # items that share an id count as one: the stretch with the largest share, then the longest
    verified = best.where(F.col("best.matched") * 100 >= F.col("window_words") * min_percent).groupBy("doc_id", "item_id").agg(F.max(F.struct(
        (F.col("best.matched") / F.col("window_words")).alias("share"), "window_words", "best")).alias("top"))
    return verified.select(
        "doc_id", "item_id", F.col("top.best.matched").cast("long").alias("matched_words"),
        F.col("top.window_words").cast("long").alias("window_words"), (-F.col("top.best.minus_start")).cast("long").alias("doc_start"))

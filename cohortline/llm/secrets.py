"""Secrets in texts, in DataFrame functions only.

Three rules find base spans: assignments to telling names, access keys, long hexadecimal runs. Two
character Markov models add more: one of random strings, trained on the values of base spans, one
of ordinary identifiers, trained on the words of all rows without a base span. A long run of token
characters becomes a span when its log-likelihood ratio speaks for the random model.

Positions come from splitting a text at its matches: the pieces between them and the matches
alternate, so lengths add up to offsets. They count code points.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import let

# The patterns of the base rules and their least lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: A run of at least so many token characters is scored by the models.
MIN_RUN = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{4,}"
#: Log-likelihood ratio, in nats a character pair, from which a run counts as random.
MIN_RATIO = 0.5


@dataclass(frozen=True)
class RandomnessModel:
    """Log-likelihood ratio of each pair of characters, ``(len(ALPHABET) + 1) ** 2`` numbers."""

    ratios: tuple[float, ...]


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, hit) of the leftmost non-overlapping matches."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def placed(hits: Column) -> Column:
        widths = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda gap, hit: F.length(gap) + F.length(hit))
        return F.zip_with(scan(widths, lambda a, b: a + b), hits, lambda end, hit: F.struct(
            (end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")))

    return let(hits, lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(empty))


def scan(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running result of an associative ``join`` over an array, by doubling: after step i each place has joined the
    2 ** (i + 1) values up to it, so n values take n log n operations."""
    def step(joined: Column, i: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), i)
        return F.transform(joined, lambda x, at: F.when(at >= back, join(F.get(joined, at - back), x)).otherwise(x))

    return let(values, lambda a: F.when(F.size(a) > 1, F.aggregate(
        F.sequence(F.lit(0), F.ceil(F.log2(F.size(a).cast("double"))).cast("int") - 1), a, step)).otherwise(a))


def _spans(kind: str, matches: Column) -> Column:
    return F.transform(matches, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"), m["hit"].alias("hit")))


NO_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,hit:string>>"


def base_spans(text: Column) -> Column:
    """Spans of the three rules by start, then kind. Cheap tests keep texts without a match from being split."""
    none = F.array().cast(NO_SPANS)
    # the match holds its value last, and what precedes the value holds no value character but the name's
    assign = F.filter(_matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["hit"], ASSIGN, 1)) >= MIN_VALUE)
    access = F.filter(_matches(text, ACCESS), lambda m: F.length(m["hit"]) >= MIN_ACCESS)
    # maximal runs: the run that is long enough is the leftmost match of the bounded pattern too
    long_hex = _matches(text, rf"[0-9a-f]{{{MIN_HEX},}}")
    return F.array_sort(F.concat(
        F.when(F.rlike(text, F.lit(ASSIGN)), _spans("assign", assign)).otherwise(none),
        F.when(F.contains(text, F.lit("AKIA")), _spans("access", access)).otherwise(none),
        F.when(F.rlike(text, F.lit(rf"[0-9a-f]{{{MIN_HEX}}}")), _spans("hex", long_hex)).otherwise(none)))


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _pairs(token: Column) -> Column:
    codes, width = _codes(token), len(ALPHABET) + 1
    return F.when(F.length(token) > 1, F.zip_with(
        F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
        lambda a, b: a * F.lit(width) + b)).otherwise(F.array().cast("array<int>"))


def _log_chances(counts: dict[int, int], weight: float = 20.0) -> np.ndarray:
    """log P(next character | character), the pair counts backed by those of the single characters."""
    width = len(ALPHABET) + 1
    table = np.zeros((width, width))
    for code, n in counts.items():
        table[divmod(code, width)] = n
    single = (table.sum(axis=0) + 1) / (table.sum() + width)
    return np.log((table + weight * single[None, :]) / (table.sum(axis=1, keepdims=True) + weight))


def train(docs: DataFrame, text_column: str = "text") -> RandomnessModel:
    """Both Markov models from all rows of ``docs``; only counts of character pairs reach the driver."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    marked = docs.select(text.alias("text"), base_spans(text).alias("spans"))
    values = F.transform("spans", lambda s: F.when(s["kind"] == "assign", F.regexp_extract(s["hit"], ASSIGN, 1)).otherwise(s["hit"]))
    words = F.when(F.size("spans") > 0, values).otherwise(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0)))
    tokens = marked.select((F.size("spans") > 0).alias("random"), F.explode(words).alias("token")).groupBy("random", "token").count()
    pairs = tokens.select("random", F.explode(_pairs(F.col("token"))).alias("pair"), "count")
    counts: dict[bool, dict[int, int]] = {True: {}, False: {}}
    # at most twice as many rows as there are pairs of characters
    for r in pairs.groupBy("random", "pair").agg(F.sum("count").alias("n")).collect():
        counts[r["random"]][r["pair"]] = r["n"]

    ratio = _log_chances(counts[True]) - _log_chances(counts[False])
    return RandomnessModel(tuple(round(float(x), 4) for x in ratio.ravel()))


def randomness(token: Column, model: RandomnessModel) -> Column:
    """Mean log-likelihood ratio of a token's character pairs; 0 without a pair."""
    table = F.split(F.lit(",".join(map(str, model.ratios))), ",").cast("array<double>")
    pairs = _pairs(token)
    total = F.aggregate(pairs, F.lit(0.0), lambda acc, pair: acc + table[pair])
    return F.when(F.size(pairs) > 0, total / F.size(pairs)).otherwise(F.lit(0.0))


def find_secrets(docs: DataFrame, model: RandomnessModel, id_column: str = "doc_id", text_column: str = "text", min_ratio: float = MIN_RATIO) -> DataFrame:
    """doc_id, base and spans: arrays of (start, rank, end, kind, hit), by start, then kind.

    ``spans`` holds the base spans and those runs the models call random that overlap none of
    them. Null and empty texts have none, long ones take n log n steps for n matches; repeated rows are searched each; an empty table gives no
    rows; other columns are ignored."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    runs = let(_matches(F.col("text"), RUN), lambda found: F.when(F.size("base") > 0, _apart(found, F.col("base"))).otherwise(found))
    likely = F.filter(runs, lambda m: randomness(m["hit"], model) >= min_ratio)
    added = F.when(F.rlike("text", F.lit(RUN)), _spans("markov", likely)).otherwise(F.array().cast(NO_SPANS))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def _apart(runs: Column, base: Column) -> Column:
    """The runs that overlap no base span. Both are laid out by their starts; a run overlaps one if a span that begins
    up to its start ends behind it, or one that begins later begins before its end."""
    far = F.lit(2 ** 31 - 1)
    laid = F.array_sort(F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("is_run"), s["end"].alias("end"), F.lit("").alias("hit"))),
        F.transform(runs, lambda m: F.struct(m["start"].alias("start"), F.lit(1).alias("is_run"), m["end"].alias("end"), m["hit"].alias("hit")))))

    def free(all_spans: Column) -> Column:
        ends = scan(F.transform(all_spans, lambda s: F.when(s["is_run"] == 0, s["end"]).otherwise(F.lit(0))), F.greatest)
        starts = F.reverse(scan(F.reverse(F.transform(all_spans, lambda s: F.when(s["is_run"] == 0, s["start"]).otherwise(far))), F.least))
        marked = F.zip_with(all_spans, F.arrays_zip(ends.alias("e"), starts.alias("s")), lambda s, b: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"),
            ((s["is_run"] == 1) & (b["e"] <= s["start"]) & (b["s"] >= s["end"])).alias("free")))
        return F.transform(F.filter(marked, lambda s: s["free"]), lambda s: F.struct(s["start"], s["end"], s["hit"]))

    return let(laid, free)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

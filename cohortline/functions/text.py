"""Text and label expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_trim(col: Column) -> Column:
    """Lower case without surrounding spaces (spaces only, not tabs)."""
    return F.lower(F.trim(col))


@dataclass(frozen=True)
class LabelRule:
    raw: str
    target: str
    case_sensitive: bool = False


def normalise_label(col: Column, rules: Sequence[LabelRule], default: str) -> Column:
    """Vocabulary lookup as one CASE; nulls and unknown labels take ``default``."""
    trimmed = F.trim(col)
    folded = F.lower(trimmed)
    result = None
    for rule in rules:
        match = trimmed == F.lit(rule.raw) if rule.case_sensitive else folded == F.lit(rule.raw.lower())
        result = F.when(match, F.lit(rule.target)) if result is None else result.when(match, F.lit(rule.target))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def ordinal_encode(col: Column, codes: Mapping[str, int]) -> Column:
    """Fixed label -> code map as INTEGER; unmapped labels give null."""
    result = None
    for label, code in codes.items():
        hit = col == F.lit(label)
        result = F.when(hit, F.lit(code)) if result is None else result.when(hit, F.lit(code))
    return (F.lit(None) if result is None else result).cast("int")


def ordinal_decode(col: Column, codes: Mapping[str, int]) -> Column:
    """Code -> label; a code without a label gives null."""
    result = None
    for label, code in codes.items():
        hit = col == F.lit(code)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return (F.lit(None) if result is None else result).cast("string")


def row_fingerprint(*cols: Column | str, strict: bool = False) -> Column:
    """md5 over the texts of the columns joined by ``|``. Nulls are skipped, so a
    null can collide with a shifted row; ``strict`` marks them instead."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    if strict:
        texts = [F.coalesce(text, F.lit("\\N")) for text in texts]
    return F.md5(F.concat_ws("|", *texts))


def stable_hash(*cols: Column | str, seed: int = 42) -> Column:
    """32 bits of md5 over key texts and a seed, as BIGINT in [0, 2^32): the same
    on every engine, partitioning and retry, unlike ``rand``."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    digest = F.md5(F.concat_ws("|", *texts, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def follow_up_tag(label: Column, needle: str = "lupus", hit: str = "specialist", other: str = "general") -> Column:
    """Advice tag by substring of the predicted label."""
    return F.when(F.lower(label).contains(needle), F.lit(hit)).otherwise(F.lit(other))


def short_request_id() -> Column:
    """First eight characters of a random UUID."""
    return F.substring(F.uuid(), 1, 8)

"""Column-name normalisation."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

# The patterns of the naming rule that loaded columns follow.
_NON_WORD = re.compile(r"\W+", re.ASCII)
_WORD_START = re.compile(r"([^_])([A-Z][a-z]+)")
_CASE_CHANGE = re.compile(r"([a-z0-9])([A-Z])")
_UNDERSCORES = re.compile(r"_+")


def snake_case(name: str) -> str:
    text = _NON_WORD.sub("_", name)
    text = _CASE_CHANGE.sub(r"\1_\2", _WORD_START.sub(r"\1_\2", text))
    return _UNDERSCORES.sub("_", text.lower()).strip("_")


@dataclass(frozen=True)
class NamePlan:
    """``kept`` pairs source names with new names in source order; ``lost`` lists
    the source columns that a collision removed, with the name they lost."""

    kept: tuple[tuple[str, str], ...]
    lost: tuple[tuple[str, str], ...]


def plan_names(columns: Sequence[str], keep: str = "underscore") -> NamePlan:
    """Resolve collisions. ``underscore`` keeps the one source name that is
    already a plain identifier; ``error`` (or no single such name) raises."""
    if keep not in ("underscore", "error"):
        raise ValueError(f"unknown collision policy: {keep}")
    groups: dict[str, list[str]] = {}
    for column in columns:
        groups.setdefault(snake_case(column), []).append(column)
    winners: dict[str, str] = {}
    for target, sources in groups.items():
        if len(sources) > 1:
            plain = [source for source in sources if not _NON_WORD.search(source)]
            if keep == "error" or len(plain) != 1:
                raise ValueError(f"columns {sources} all normalise to {target!r}")
            winners[target] = plain[0]
        else:
            winners[target] = sources[0]
    kept = tuple((c, snake_case(c)) for c in columns if winners[snake_case(c)] == c)
    lost = tuple((c, snake_case(c)) for c in columns if winners[snake_case(c)] != c)
    return NamePlan(kept, lost)

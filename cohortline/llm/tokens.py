"""Token ids of whole texts with a public tokenizer file (library ``tokenizers``).

A byte-level BPE without normaliser never merges across its pre-token borders, and a single
space between two non-space characters always starts a pre-token. Texts are therefore cut
there, each distinct unit is encoded once per worker by the tokenizer, and a text's ids are
its units' ids joined. A unit of Latin letters and punctuation behind them is two pre-tokens,
which go straight to the tokenizer's model. Other kinds of tokenizer encode whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np

from cohortline.llm.common import worker_state

MAX_CACHED_UNITS = 800_000
MAX_CACHED_UNIT_CHARS = 64
#: Without the apostrophe, which may begin a pre-token of its own.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for
    itself, the other bytes from U+0100 on in ascending order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def _cuts_at_spaces(spec: dict) -> bool:
    pre = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
        and pre.get("use_regex", True) and not any(" " in t["content"] or t.get("lstrip") or t.get("rstrip")
                                                   or t.get("normalized") or t.get("single_word")
                                                   for t in spec.get("added_tokens", [])))


class Units(dict):
    """Ids of units; a unit is encoded when it is first asked for. What comes early comes often, so a
    full cache stays as it is."""

    def __init__(self, encode: Callable[[str], tuple[bytes, bool]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        ids, worth_keeping = self.encode(unit)
        if worth_keeping and len(unit) <= MAX_CACHED_UNIT_CHARS and len(self) < MAX_CACHED_UNITS:
            self[unit] = ids
        return ids


class UnitEncoder:
    """``encode_all`` yields, for each text, its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer_json: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json.decode("utf-8"))
        self.by_unit = _cuts_at_spaces(json.loads(tokenizer_json))
        self.vocabulary_size = self.tokenizer.get_vocab_size()
        self.odd = re.compile(r"\s\s")
        self.cut = re.compile(r"(?<=\S) (?=\S)")
        self.latin = re.compile(f"[{LATIN}]+").fullmatch
        self.space = re.compile(r"\s")
        self.alphabet = byte_alphabet()
        self.line_break = self.whole("\n")
        self.first = Units(lambda unit: self._unit("", unit))
        self.later = Units(lambda unit: self._unit(" ", unit))
        self.tails = Units(lambda tail: (self._pre_token(tail), True))

    @staticmethod
    def shared(tokenizer_json: bytes) -> "UnitEncoder":
        """The worker's own encoder for this file."""
        state, key = worker_state("tokens"), hashlib.md5(tokenizer_json).hexdigest()
        if key not in state:
            state[key] = UnitEncoder(tokenizer_json)
        return state[key]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _pre_token(self, text: str) -> bytes:
        """Ids of one pre-token, which the model reads in the byte alphabet."""
        if text.isascii():  # visible ASCII stands for itself
            shown = text.replace(" ", self.alphabet[0x20])
        else:
            shown = "".join([self.alphabet[b] for b in text.encode("utf-8")])
        return array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def _unit(self, space: str, unit: str) -> tuple[bytes, bool]:
        """Ids of a unit, behind a space or at the start of a line, and whether to keep them."""
        known = self.later if space else self.first
        if self.latin(unit):
            return self._pre_token(space + unit), True
        if "\n" in unit:
            # one line break between other characters is a pre-token of its own
            lines = unit.split("\n")
            if all(lines) and not any(map(self.space.search, lines)):
                return self.line_break.join([known[lines[0]], *map(self.first.__getitem__, lines[1:])]), False
        core = unit.rstrip(PUNCTUATION)
        if not self.latin(core):
            return self.whole(space + unit), True
        seen = core in known
        return known[core] + self.tails[unit[len(core):]], seen

    def encode(self, text: str) -> bytes:
        units = self.cut.split(text) if self.odd.search(text) else text.split(" ")
        head = self.first[units[0]]
        return b"".join([head, *map(self.later.__getitem__, units[1:])])

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        encode = self.encode if self.by_unit else self.whole
        for text in texts:
            yield encode(text or "")

"""Byte-level BPE by a rank file: ids of texts, and texts of ids.

A pattern cuts texts into pre-tokens. The distinct pre-tokens a worker has not met yet are laid out,
by length, as padded matrices of byte ids; in each round every row merges its leftmost pair of least
rank, the ranks come from one hashed lookup of all changed pairs, and rows are closed up by one
place. Finished rows leave the matrix. Pre-tokens longer than the widest matrix are merged rank by
rank over linked arrays, which gives the same ids in time proportional to their length.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import worker_state
from cohortline.llm.tokens import LATIN

#: Widths of the matrices; cells of one matrix at most.
WIDTHS = (2, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)
MAX_CELLS = 1 << 20
#: A rank, or an id, that no pair or token has.
NONE = np.int64(2 ** 31 - 1)
EMPTY = np.int64(-1)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
MAX_CACHED = 150_000
MAX_CACHED_CHARS = 64
#: Characters of texts that are cut into pre-tokens at a time.
GROUP_CHARS = 500_000
#: Bytes of one batch that a worker hands back, if a single text has no more.
SENT_BYTES = 4 << 20


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: lines of base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, data.splitlines()))}


class PairTable:
    """Open addressing over pairs of ids: the rank (id) of their concatenation."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, byte_ids: np.ndarray, hasty: np.ndarray):
        self.keys, self.values, self.byte_ids, self.hasty = keys, values, byte_ids, set(hasty.tolist())
        self.shift = np.uint64(64 - (len(keys).bit_length() - 1))
        self.mask = len(keys) - 1

    @staticmethod
    def arrays(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The table's parts, plain enough for a broadcast; the last are the tokens that, once made, merge
        at a lower rank than their own."""
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        pairs = [
            (ranks[token[:cut]], ranks[token[cut:]], rank) for token, rank in ranks.items() for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks]
        left, right, merged = np.array(pairs or np.empty((0, 3)), dtype=np.int64).T
        byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        hasty = np.setdiff1d(np.concatenate([left[left > merged], right[right > merged]]), byte_ids)
        size = 1 << max(8, (3 * len(pairs)).bit_length())
        keys, values = np.full(size, EMPTY), np.full(size, NONE)
        wanted = left << 32 | right
        at = PairTable._slot(wanted, np.uint64(64 - (size.bit_length() - 1)))
        pending = np.arange(len(wanted))
        while len(pending):
            free = pending[keys[at[pending]] == EMPTY]
            slots, first = np.unique(at[free], return_index=True)
            keys[slots], values[slots] = wanted[free[first]], merged[free[first]]
            pending = pending[keys[at[pending]] != wanted[pending]]
            at[pending] = (at[pending] + 1) & (size - 1)
        return keys, values, byte_ids, hasty

    @staticmethod
    def _slot(key: np.ndarray, shift: np.uint64) -> np.ndarray:
        return ((key.astype(np.uint64) * FACTOR) >> shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where the two do not merge."""
        key = left << 32 | right
        at = self._slot(key, self.shift)
        held = self.keys[at]
        out = np.where(held == key, self.values[at], NONE)
        again = np.nonzero((held != key) & (held != EMPTY))
        while len(again[0]):
            at[again] = (at[again] + 1) & self.mask
            held = self.keys[at[again]]
            same = held == key[again]
            hit = tuple(i[same] for i in again)
            out[hit] = self.values[at[hit]]
            again = tuple(i[~same & (held != EMPTY)] for i in again)
        return out


def merge_rows(tokens: np.ndarray, table: PairTable) -> np.ndarray:
    """The matrix of byte ids, padded with ``NONE``, becomes one of token ids."""
    out = np.full(tokens.shape, NONE)
    rows = np.arange(len(tokens))
    ranks = table.ranks(tokens[:, :-1], tokens[:, 1:])
    while len(rows):
        least = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), dtype=np.int64)
        rank = ranks[np.arange(len(rows)), least] if ranks.shape[1] else np.full(len(rows), NONE)
        going = rank != NONE
        if not going.all():
            out[rows[~going], :tokens.shape[1]] = tokens[~going]
            rows, tokens, ranks, least, rank = rows[going], tokens[going], ranks[going], least[going], rank[going]
            if not len(rows):
                break
        each = np.arange(len(rows))
        tokens[each, least] = rank
        keep = np.ones(tokens.shape, dtype=bool)
        keep[each, least + 1] = False
        width = tokens.shape[1] - 1
        tokens = tokens[keep].reshape(len(rows), width)
        keep = np.ones(ranks.shape, dtype=bool)
        keep[each, least] = False
        ranks = ranks[keep].reshape(len(rows), width - 1)
        before, behind = least >= 1, least < width - 1
        left = (each[before], least[before] - 1)
        ranks[left] = table.ranks(tokens[left], tokens[left[0], left[1] + 1])
        right = (each[behind], least[behind])
        ranks[right] = table.ranks(tokens[right], tokens[right[0], right[1] + 1])
    return out


def merge_long(tokens: np.ndarray, table: PairTable) -> np.ndarray:
    """Ids of one long row of byte ids. Where a merge only makes pairs of higher rank, all pairs of the least
    rank merge together, from left to right without overlap; else only the leftmost does."""
    n = len(tokens)
    tokens = tokens.copy()
    behind, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    alive = np.ones(n, dtype=bool)
    ranks = np.full(n, NONE)
    ranks[:-1] = table.ranks(tokens[:-1], tokens[1:])
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def wait(places: np.ndarray) -> None:
        places = places[ranks[places] != NONE]
        places = places[np.argsort(ranks[places], kind="stable")]
        found = ranks[places]
        starts = np.flatnonzero(np.diff(found, prepend=-1))
        for rank, group in zip(found[starts].tolist(), np.split(places, starts[1:])):
            if rank not in waiting:
                waiting[rank] = []
                heapq.heappush(heap, rank)
            waiting[rank].append(group)

    wait(np.arange(n))
    while heap:
        rank = heapq.heappop(heap)
        places = np.unique(np.concatenate(waiting.pop(rank)))
        places = places[alive[places] & (ranks[places] == rank)]
        if not len(places):
            continue
        if rank in table.hasty:
            wait(places[1:])
            places = places[:1]
        index = np.arange(len(places))
        opens = np.ones(len(places), dtype=bool)
        opens[1:] = behind[places[:-1]] != places[1:]
        chosen = places[(index - np.maximum.accumulate(np.where(opens, index, 0))) % 2 == 0]
        gone = behind[chosen]
        after = behind[gone]
        tokens[chosen], alive[gone], ranks[gone], behind[chosen] = rank, False, NONE, after
        inside = after < n
        before[after[inside]] = chosen[inside]
        changed = np.unique(np.concatenate([chosen, before[chosen]]))
        changed = changed[changed >= 0]
        ranks[changed] = NONE
        changed = changed[behind[changed] < n]
        ranks[changed] = table.ranks(tokens[changed], tokens[behind[changed]])
        wait(changed)
    return tokens[alive]


class Encoder:
    """Ids of texts; keeps those of units and pre-tokens it has met.

    With ``cut_at_spaces`` texts are first cut into units before each single space or line break that
    stands between two other characters, for patterns that always start a pre-token there and keep
    Latin letters together; the pattern then runs over units not met yet."""

    def __init__(self, table: PairTable, pattern: str, cut_at_spaces: bool = False):
        self.table, self.pattern, self.cut_at_spaces = table, regex.compile(pattern), cut_at_spaces
        self.pieces: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.double = re.compile(r"\s\s")
        self.cuts = re.compile(r"(?<=\S)(?=[ \n]\S)")
        self.latin = re.compile(f" ?[{LATIN}]+").fullmatch

    def merge(self, pieces: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """(piece, ids as little-endian unsigned 32-bit integers), in any order."""
        pieces = list(pieces)
        encoded = [piece.encode("utf-8") for piece in pieces]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        data = np.frombuffer(b"".join(encoded), np.uint8)
        starts = np.cumsum(sizes) - sizes
        least = 0
        for width in WIDTHS:
            of_width = np.flatnonzero((least < sizes) & (sizes <= width))
            least, height = width, MAX_CELLS // width
            for part in (of_width[at:at + height] for at in range(0, len(of_width), height)):
                inside = np.arange(width)[None, :] < sizes[part, None]
                places = np.where(inside, starts[part, None] + np.arange(width)[None, :], 0)
                ids = merge_rows(np.where(inside, self.table.byte_ids[data[places]], NONE), self.table)
                real = ids != NONE
                ends = (4 * np.cumsum(real.sum(axis=1))).tolist()
                flat = ids[real].astype("<u4").tobytes()
                yield from zip([pieces[i] for i in part], [flat[a:b] for a, b in zip([0, *ends], ends)])
        for i in np.flatnonzero(sizes > least):
            tokens = self.table.byte_ids[data[starts[i]:starts[i] + sizes[i]]]
            yield pieces[i], merge_long(tokens, self.table).astype("<u4").tobytes()

    @contextmanager
    def ids_of(self, cache: dict[str, bytes], wanted: set[str], encode: Callable) -> Iterator[Callable[[str], bytes]]:
        """Ids of the wanted texts, from the cache or from ``encode``. What comes early comes often, so a full
        cache stays as it is, and what does not belong there is forgotten afterwards."""
        missing, room = wanted.difference(cache), MAX_CACHED - len(cache)
        cache.update(encode(missing))
        yield cache.__getitem__
        for text in missing:
            room -= 1
            if room < 0 or len(text) > MAX_CACHED_CHARS:
                del cache[text]

    def split(self, units: set[str]) -> Iterator[tuple[str, bytes]]:
        """(unit, ids) of units not met yet."""
        whole = set(filter(self.latin, units)) if self.cut_at_spaces else set()
        mixed = units - whole
        found = list(map(self.pattern.findall, mixed))
        with self.ids_of(self.pieces, whole.union(*found), self.merge) as ids_of:
            yield from zip(whole, map(ids_of, whole))
            yield from zip(mixed, [b"".join(map(ids_of, pieces)) for pieces in found])

    def cut(self, text: str) -> list[str]:
        if not self.cut_at_spaces:
            return [text]
        if self.double.search(text):
            return self.cuts.split(text)
        return text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0") if "\0" not in text else self.cuts.split(text)

    def encode_group(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut(text) for text in texts]
        with self.ids_of(self.units, set(chain.from_iterable(cut)), self.split) as ids_of:
            return [b"".join(map(ids_of, units)) for units in cut]

    def encode_long(self, text: str) -> bytes:
        """A text of any length, some pre-tokens at a time."""
        found, out = self.pattern.finditer(text), []
        while pieces := [m[0] for m in islice(found, GROUP_CHARS // 4)]:
            with self.ids_of(self.pieces, set(pieces), self.merge) as ids_of:
                out.append(b"".join(map(ids_of, pieces)))
        return b"".join(out)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        group, held = [], 0
        for text in texts:
            text = text or ""
            if held and held + len(text) > GROUP_CHARS:
                yield from self.encode_group(group)
                group, held = [], 0
            if len(text) > GROUP_CHARS:
                yield from self.encode_group(group)
                group, held = [], 0
                yield self.encode_long(text)
            else:
                group.append(text)
                held += len(text)
        yield from self.encode_group(group)


def portions(values: Iterable[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, values) in runs of about ``SENT_BYTES``, so that a task never holds a whole batch's results."""
    start, held, size = 0, [], 0
    for value in values:
        held.append(value)
        size += len(value)
        if size >= SENT_BYTES:
            yield start, held
            start, held, size = start + len(held), [], 0
    if held:
        yield start, held


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, cut_at_spaces: bool = False,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row's whole text. ``cut_at_spaces``: see ``Encoder``.

    Null and empty texts have no ids; repeated rows are encoded each; an empty table gives no rows; other
    columns are ignored. Equal ranks do not occur; of equal pairs the leftmost merges first."""
    shared = docs.sparkSession.sparkContext.broadcast((PairTable.arrays(ranks), pattern, cut_at_spaces))  # bounded by the vocabulary
    owner = f"bytebpe-{len(ranks)}"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state(owner)
        parts, pattern, cut_at_spaces = shared.value
        key = (pattern, cut_at_spaces, *parts[0][:64].tolist(), len(parts[0]))
        encoder = state.get("encoder")
        if state.get("key") != key:
            encoder = Encoder(PairTable(*parts), pattern, cut_at_spaces)
            state.update(key=key, encoder=encoder)
        for batch in batches:
            for start, found in portions(encoder.encode_all(text.as_py() for text in batch.column(1))):
                ends = np.cumsum([0, *[len(ids) // 4 for ids in found]], dtype=np.int32)
                ids = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(found), "<i4"))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(found)), ids], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(search, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the bytes of the ids; a null list has none. An id that is no
    rank raises."""
    tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)  # the vocabulary

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_of = shared.value.__getitem__
        for batch in batches:
            column = batch.column(1)
            sizes = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            ids = column.flatten().to_numpy(zero_copy_only=False)
            for start, texts in portions(b"".join(map(token_of, ids[a:b].tolist())) for a, b in zip(sizes[:-1], sizes[1:])):
                kept = [c.slice(start, len(texts)) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(lookup, "doc_id long, ids array<int>, decoded binary")

"""Forests grown from binned rows: the library's settings and rules (candidate splits, Poisson draws, a feature subset a
node, Gini gain, merged leaves), without its statistics of every bin and class for each small node.

Rows become bins once. Where the bins have fewer combinations than there are rows, equal ones are counted, and a tree draws
a Poisson number for the count: the law of the summed draws of its rows. Each tree's draws go to the task of their node. A
node with more than ``LOCAL_ROWS`` rows is split first, by histograms added up over all partitions, so that no task holds
more; below that a task grows the whole subtree."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.session import cut_lineage

#: Binned rows of a tree that a task holds, about, and of one piece of the stored rows.
LOCAL_ROWS, PIECE_ROWS = 1 << 18, 1 << 16
#: Combinations of bins and classes that are counted, or whose votes a scoring task remembers, at most.
MAX_CELLS, KNOWN_CELLS = 1 << 22, 1 << 21
#: Numbers of a histogram, and of sorted entries times classes, worked on at a time.
CHUNK_CELLS, CHUNK_ENTRIES = 1 << 18, 1 << 18
#: Rows from which the candidate splits come, as in the library.
SPLIT_ROWS = 10_000
LEAST_GAIN = 1e-15


@dataclass(frozen=True)
class Growth:
    """What a forest is grown by. ``n_bins``: of each feature; ``n_tried``: features a node chooses from."""

    n_trees: int
    depth: int
    least: int
    n_tried: int
    seed: int
    n_classes: int
    n_bins: tuple[int, ...]
    bootstrap: bool = True

    @property
    def width(self) -> int:
        return max(self.n_bins)


@dataclass
class Tree:
    """Nodes in arrays, the root first. A leaf has feature -1; the second child follows the first, ``left``."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    counts: np.ndarray
    importance: np.ndarray


# -- bins ------------------------------------------------------------------------------------------------------

def split_points(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between the distinct values, about as many values between two of them."""
    distinct, counts = np.unique(values, return_counts=True)
    between = (distinct[:-1] + distinct[1:]) / 2.0
    if len(between) <= most:
        return between
    held = np.cumsum(counts)
    # a value closes its range where the next one would lead further past the wished number
    halfway, stride = (held[:-1] + held[1:]) / 2.0, len(values) / (most + 1)
    found: list[int] = []
    while (at := max(np.searchsorted(halfway, (len(found) + 1) * stride, side="right"), found[-1] + 1 if found else 0)) < len(between):
        found.append(int(at))
    return between[found]


def to_bins(values: np.ndarray, splits: Sequence[np.ndarray]) -> np.ndarray:
    """A value's bin is the number of thresholds below it; not a number is above all."""
    out = np.empty(values.shape, dtype=np.uint8)
    for f, points in enumerate(splits):
        out[:, f] = np.searchsorted(points, values[:, f], side="left")
    return out


def _matrix(column, width: int) -> np.ndarray:
    values = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if values.null_count or len(flat) != len(values) * width:
        raise ValueError(f"a row has no vector of {width} features")
    return flat.reshape(len(values), width)


def _finite(values: np.ndarray) -> np.ndarray:
    """Rows to learn from; the library refuses others too."""
    if not np.isfinite(values).all():
        raise ValueError("features to learn from must be finite numbers")
    return values


def _cells(bins: np.ndarray, n_bins: Sequence[int]) -> np.ndarray:
    cell = np.zeros(len(bins), dtype=np.int64)
    for f, n in enumerate(n_bins):
        cell = cell * n + bins[:, f]
    return cell


def _of_cells(cell: np.ndarray, n_bins: Sequence[int]) -> np.ndarray:
    out = np.empty((len(cell), len(n_bins)), dtype=np.uint8)
    for f in range(len(n_bins) - 1, -1, -1):
        cell, out[:, f] = np.divmod(cell, n_bins[f])
    return out


PIECES = "bins binary, labels binary, copies binary"


def _piece(bins: np.ndarray, labels: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
    parts = [np.ascontiguousarray(bins), labels.astype(np.uint8), copies.astype(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["bins", "labels", "copies"])


def stored_pieces(rows: DataFrame, splits: Sequence[np.ndarray], growth: Growth, n_rows: int) -> tuple[DataFrame, int]:
    """(piece, bins, labels, copies), some rows in each, stored: every pass draws the same rows for a tree. And their number."""
    n_bins, n_classes = growth.n_bins, growth.n_classes
    n_cells = math.prod(n_bins) * n_classes
    cores = rows.sparkSession.sparkContext.defaultParallelism

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            yield _piece(to_bins(_finite(_matrix(batch.column(0), len(splits))), splits), labels, np.ones(len(labels)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_cells, dtype=np.int64)
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            cell = _cells(to_bins(_finite(_matrix(batch.column(0), len(splits))), splits), n_bins) * n_classes + labels
            one, n = np.unique(cell, return_counts=True)
            held[one] += n
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(held[found])], names=["cell", "n"])

    def unfolded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, label = np.divmod(batch.column(0).to_numpy(), n_classes)
            if len(cell):
                yield _piece(_of_cells(cell, n_bins), label, batch.column(1).to_numpy())

    if n_cells <= min(n_rows, MAX_CELLS):
        cells = rows.mapInArrow(counted, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
        pieces = cells.repartition(cores, "cell").sortWithinPartitions("cell").mapInArrow(unfolded, PIECES)
    else:
        pieces = rows.mapInArrow(binned, PIECES).repartition(cores)
    stored = cut_lineage(pieces.withColumn("piece", F.monotonically_increasing_id()))
    return stored, int(stored.agg(F.coalesce(F.sum(F.octet_length("labels")), F.lit(0))).first()[0])


# -- splits ----------------------------------------------------------------------------------------------------

def tried_features(draws: np.random.Generator, n_nodes: int, growth: Growth) -> np.ndarray:
    """(nodes, tried): the features each node chooses from."""
    n_features = len(growth.n_bins)
    if growth.n_tried >= n_features:
        return np.tile(np.arange(n_features), (n_nodes, 1))
    return np.argpartition(draws.random((n_nodes, n_features)), growth.n_tried - 1, axis=1)[:, :growth.n_tried]


def histogram(bins: np.ndarray, labels: np.ndarray, weights: np.ndarray, pos: np.ndarray, tried: np.ndarray, growth: Growth) -> np.ndarray:
    """(nodes, tried, bins, classes): summed weights; ``pos`` is the node of each row."""
    n_nodes, k = tried.shape
    total = np.zeros(n_nodes * k * growth.width * growth.n_classes)
    flat, slots = bins.ravel(), np.arange(k)
    for at in range(0, len(pos), PIECE_ROWS):
        node = pos[at:at + PIECE_ROWS]
        found = flat[(np.arange(at, at + len(node)) * bins.shape[1])[:, None] + tried[node]]
        key = ((node[:, None] * k + slots) * growth.width + found) * growth.n_classes + labels[at:at + PIECE_ROWS, None]
        total += np.bincount(key.ravel(), weights=np.repeat(weights[at:at + PIECE_ROWS], k), minlength=len(total))
    return total.reshape(n_nodes, k, growth.width, growth.n_classes)


def _gains(left: np.ndarray, total: np.ndarray, least: int) -> np.ndarray:
    """Gini gain of sending the class counts ``left`` of the ``total`` to the first child; -inf where a child has too few."""
    right = total - left
    n_left, n_right, n = left.sum(-1), right.sum(-1), total.sum(-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (np.einsum("...c,...c", left, left) / n_left + np.einsum("...c,...c", right, right) / n_right) / n - np.einsum("...c,...c", total, total) / (n * n)
    return np.where((n_left < least) | (n_right < least), -np.inf, gain)


def best_of_histogram(hist: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(gain, slot, bin, class counts of the first child) of each node's best split."""
    left, nodes = hist.cumsum(axis=2), np.arange(len(hist))
    gain = _gains(left[:, :, :-1], left[:, :, -1:], least).reshape(len(hist), -1)
    best = gain.argmax(1)
    slot, split = np.divmod(best, hist.shape[2] - 1)
    return gain[nodes, best], slot, split, left[nodes, slot, split]


def best_of_sorted(bins: np.ndarray, labels: np.ndarray, weights: np.ndarray, sizes: np.ndarray, tried: np.ndarray, growth: Growth) -> tuple[np.ndarray, ...]:
    """The same for small nodes, whose rows follow each other: their bins are sorted, since most would be empty."""
    n_nodes, k = tried.shape
    node = np.repeat(np.arange(n_nodes), sizes)
    found = np.take_along_axis(bins, tried[node], axis=1).astype(np.int64)
    key = ((node[:, None] * k + np.arange(k)) * growth.width + found) * growth.n_classes + labels[:, None]
    key = ((key << 31) | weights[:, None].astype(np.int64)).ravel()
    key.sort()
    place, label = np.divmod(key >> 31, growth.n_classes)
    one = np.zeros((len(key), growth.n_classes))
    one[np.arange(len(key)), label] = key & ((1 << 31) - 1)
    held = one.cumsum(axis=0)
    lengths = np.repeat(sizes, k)
    ends = np.cumsum(lengths)
    before = np.concatenate([np.zeros((1, growth.n_classes)), held[ends[:-1] - 1]])
    total = held[ends - 1] - before
    left = held - np.repeat(before, lengths, axis=0)
    gain = _gains(left, np.repeat(total, lengths, axis=0), growth.least)
    gain[:-1][place[1:] == place[:-1]] = -np.inf
    of_node = np.concatenate([[0], np.cumsum(sizes * k)[:-1]])
    most = np.maximum.reduceat(gain, of_node)
    reach = np.flatnonzero(gain == np.repeat(most, sizes * k))
    first = reach[np.searchsorted(reach, of_node)]
    return most, (place[first] // growth.width) % k, place[first] % growth.width, left[first]


def _best_splits(bins, labels, weights, sizes, tried, growth) -> tuple[np.ndarray, ...]:
    """Best splits of nodes whose rows follow each other: small nodes by sorting, others by histograms, some at a time."""
    m, n_classes = len(sizes), growth.n_classes
    gain, slot, split, left = np.empty(m), np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64), np.empty((m, n_classes))
    small, of_row = sizes < growth.width, np.repeat(np.arange(m), sizes)
    for few in (True, False):
        nodes = np.flatnonzero(small == few)
        if not len(nodes):
            continue
        inside = np.flatnonzero(small[of_row] == few)
        cost = np.cumsum(sizes[nodes] * tried.shape[1] * n_classes) if few else np.arange(len(nodes)) * tried.shape[1] * growth.width * n_classes
        group = cost // (CHUNK_ENTRIES if few else CHUNK_CELLS)
        ends = np.cumsum(sizes[nodes])
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(nodes)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part, rows = nodes[a:b], inside[ends[a] - sizes[nodes[a]]:ends[b - 1]]
            if few:
                found = best_of_sorted(bins[rows], labels[rows], weights[rows], sizes[part], tried[part], growth)
            else:
                pos = np.repeat(np.arange(len(part)), sizes[part])
                found = best_of_histogram(histogram(bins[rows], labels[rows], weights[rows], pos, tried[part], growth), growth.least)
            gain[part], slot[part], split[part], left[part] = found
    return gain, slot, split, left


# -- trees -----------------------------------------------------------------------------------------------------

def closed(counts: np.ndarray, growth: Growth) -> np.ndarray:
    """Nodes that cannot be split: of one class, or too small for two children."""
    return (counts.max(axis=1) >= counts.sum(axis=1)) | (counts.sum(axis=1) < 2 * growth.least)


def grow_rows(bins: np.ndarray, labels: np.ndarray, weights: np.ndarray, depth: int, growth: Growth, draws: np.random.Generator) -> Tree:
    """The tree of these rows, ``depth`` levels below its root at most."""
    labels = labels.astype(np.int64)
    counts = np.bincount(labels, weights=weights, minlength=growth.n_classes)[None, :]
    feature, split, left, gains = np.full(1, -1, dtype=np.int32), np.zeros(1, dtype=np.uint8), np.zeros(1, dtype=np.int32), np.zeros(1)
    levels, ids, sizes = [np.zeros(1, dtype=np.int64)], np.zeros(1, dtype=np.int64), np.array([len(labels)])
    if closed(counts, growth)[0]:
        ids = ids[:0]
    while len(ids) and depth > 0:
        depth -= 1
        tried = tried_features(draws, len(ids), growth)
        gain, slot, place, first = _best_splits(bins, labels, weights, sizes, tried, growth)
        good = gain > LEAST_GAIN
        chosen = tried[np.arange(len(ids)), slot]
        grown, parents = np.flatnonzero(good), ids[good]
        if not len(parents):
            break
        children = len(feature) + np.arange(2 * len(parents), dtype=np.int64)
        feature[parents], split[parents], left[parents], gains[parents] = chosen[good], place[good], children[::2], gain[good]
        both = np.empty((len(children), growth.n_classes))
        both[::2], both[1::2] = first[good], counts[parents] - first[good]
        counts = np.concatenate([counts, both])
        feature = np.concatenate([feature, np.full(len(children), -1, dtype=np.int32)])
        split, left, gains = [np.concatenate([x, np.zeros(len(children), dtype=x.dtype)]) for x in (split, left, gains)]
        levels.append(children)
        # rows of the children that stay open, laid out child by child
        of_row = np.repeat(np.arange(len(ids)), sizes)
        right = bins[np.arange(len(of_row)), chosen[of_row]] > place[of_row]
        rank = np.full(len(ids), -1)
        rank[grown] = np.arange(len(grown))
        child = 2 * rank[of_row] + right
        is_open = ~closed(both, growth)
        stays = (rank[of_row] >= 0) & is_open[child]
        order = np.flatnonzero(stays)
        order = order[np.argsort(child[order], kind="stable")]
        sizes = np.bincount(child[order], minlength=len(children))[is_open]
        bins, labels, weights, ids = bins[order], labels[order], weights[order], children[is_open]
    return merged(Tree(feature, split, left, counts, np.zeros(len(growth.n_bins))), gains, levels)


def merged(tree: Tree, gains: np.ndarray, levels: Sequence[np.ndarray]) -> Tree:
    """Sibling leaves of one prediction become one leaf, from below, as the library merges them."""
    feature, left, vote = tree.feature, tree.left, tree.counts.argmax(axis=1)
    for ids in reversed(levels):
        inner = ids[feature[ids] >= 0]
        below = left[inner]
        same = (feature[below] < 0) & (feature[below + 1] < 0) & (vote[below] == vote[below + 1])
        feature[inner[same]] = -1
    kept = np.zeros(len(feature), dtype=bool)
    kept[0] = True
    for ids in levels:
        inner = ids[kept[ids] & (feature[ids] >= 0)]
        kept[left[inner]] = kept[left[inner] + 1] = True
    number = np.cumsum(kept) - 1
    inner = kept & (feature >= 0)
    importance = tree.importance + np.bincount(feature[inner], weights=gains[inner] * tree.counts[inner].sum(axis=1), minlength=len(tree.importance))
    return Tree(feature[kept], tree.split[kept], np.where(feature >= 0, number[np.where(feature >= 0, left, 0)], 0)[kept].astype(np.int32), tree.counts[kept], importance)


def walk(nodes: Sequence[np.ndarray], bins: np.ndarray, levels: int) -> np.ndarray:
    """The node each row ends in after at most so many steps; ``nodes``: a tree's feature, split and left."""
    at, flat, start = np.zeros(len(bins), dtype=np.int64), bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    leaf = nodes[0] < 0
    feature, split = np.where(leaf, 0, nodes[0]), np.where(leaf, 255, nodes[1]).astype(np.uint8)
    left = np.where(leaf, np.arange(len(leaf)), nodes[2]).astype(np.int64)
    for _ in range(levels):
        at = left[at] + (flat[start + feature[at]] > split[at])
    return at


def _ways(tree: Tree) -> tuple[np.ndarray, ...]:
    """What a walk needs, as workers without this package can read it."""
    return tree.feature, tree.split, tree.left


def drawn(copies: np.ndarray, growth: Growth, tree: int, piece: int) -> np.ndarray:
    """How often a tree takes each row of a piece."""
    return np.random.default_rng([growth.seed & 0xFFFFFFFF, tree, piece]).poisson(copies) if growth.bootstrap else copies


def _unpacked(batch: pa.RecordBatch, growth: Growth) -> Iterator[tuple]:
    for piece, bins, labels, copies in zip(*(batch.column(c).to_pylist() for c in ("piece", "bins", "labels", "copies"))):
        yield (piece, np.frombuffer(bins, np.uint8).reshape(-1, len(growth.n_bins)), np.frombuffer(labels, np.uint8), np.frombuffer(copies, np.int64))


# -- the levels above, by all partitions -----------------------------------------------------------------------

def _top_levels(pieces: DataFrame, growth: Growth, n_rows: int) -> tuple[dict[int, Tree], dict[tuple[int, int], int], dict[int, tuple]]:
    """Trees split until no open node has more than ``LOCAL_ROWS`` rows, their open nodes with the levels left, and what
    merging needs. Only splits reach the driver."""
    width, k, n_classes = growth.width, growth.n_tried, growth.n_classes
    empty = lambda: Tree(np.full(1, -1, dtype=np.int32), np.zeros(1, dtype=np.uint8), np.zeros(1, dtype=np.int32), np.zeros((1, n_classes)), np.zeros(len(growth.n_bins)))
    tops = {t: empty() for t in range(growth.n_trees)}
    gains, levels = {t: np.zeros(1) for t in tops}, {t: [np.zeros(1, dtype=np.int64)] for t in tops}
    ready: dict[tuple[int, int], int] = {}
    large = [(t, 0) for t in tops]
    if n_rows <= LOCAL_ROWS or growth.depth == 0:
        return tops, {key: growth.depth for key in large}, {t: (gains[t], levels[t]) for t in tops}
    schema = "tree int, node int, hist binary"
    for depth in range(growth.depth):
        if not large:
            break
        wanted: dict[int, list[int]] = {}
        for t, node in large:
            wanted.setdefault(t, []).append(node)
        tried = {t: np.stack([tried_features(np.random.default_rng([growth.seed & 0xFFFFFFFF, t, node, 1]), 1, growth)[0] for node in nodes]) for t, nodes in wanted.items()}
        sent = pieces.sparkSession.sparkContext.broadcast(({t: _ways(tree) for t, tree in tops.items()}, wanted, tried))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, nodes_of, tried_of = sent.value
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for piece, bins, labels, copies in _unpacked(batch, growth):
                    for t, nodes in nodes_of.items():
                        weights = drawn(copies, growth, t, piece)
                        place = np.full(len(trees[t][0]), -1)
                        place[nodes] = np.arange(len(nodes))
                        pos = place[walk(trees[t], bins, depth)]
                        rows = np.flatnonzero((weights > 0) & (pos >= 0))
                        # the last class counts the rows themselves
                        one = histogram(bins[rows], labels[rows].astype(np.int64), weights[rows], pos[rows], tried_of[t], growth)
                        seen = histogram(bins[rows], np.zeros(len(rows), dtype=np.int64), np.ones(len(rows)), pos[rows], tried_of[t], growth)[..., :1]
                        held[t] = held.get(t, 0) + np.concatenate([one, seen], axis=3)
            for t, hists in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(hists), pa.int32()), pa.array(nodes_of[t], pa.int32()), pa.array([h.tobytes() for h in hists], pa.binary())], names=["tree", "node", "hist"])

        def choose(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            hist = sum(np.frombuffer(h, np.float64) for h in table["hist"].to_pylist()).reshape(1, -1, width, n_classes + 1)
            gain, slot, split, first = best_of_histogram(hist[..., :-1], growth.least)
            rows = hist[0, slot[0], :, -1]
            found = np.array([gain[0], slot[0], split[0], rows[:split[0] + 1].sum(), rows.sum(), *first[0], *hist[0, 0, :, :-1].sum(axis=0)])
            return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([found.tobytes()], pa.binary())], names=["tree", "node", "hist"])

        found = pieces.mapInArrow(count, schema).groupBy("tree", "node").applyInArrow(choose, schema).collect()  # one row per large node
        large = []
        for r in sorted(found, key=lambda r: (r["tree"], r["node"])):
            t, node, tree = r["tree"], r["node"], tops[r["tree"]]
            gain, slot, split, n_left, n_both, *rest = np.frombuffer(r["hist"], np.float64)
            first, total = np.array(rest[:n_classes]), np.array(rest[n_classes:])
            tree.counts[node] = total
            if closed(total[None, :], growth)[0] or gain <= LEAST_GAIN:
                continue
            child = len(tree.feature)
            tree.feature[node], tree.split[node], tree.left[node], gains[t][node] = tried[t][wanted[t].index(node)][int(slot)], int(split), child, gain
            both = np.stack([first, total - first])
            tops[t] = Tree(*[np.concatenate([old, new.astype(old.dtype)]) for old, new in (
                (tree.feature, np.full(2, -1)), (tree.split, np.zeros(2)), (tree.left, np.zeros(2)), (tree.counts, both))], tree.importance)
            gains[t] = np.concatenate([gains[t], np.zeros(2)])
            if len(levels[t]) == depth + 1:
                levels[t].append(np.zeros(0, dtype=np.int64))
            levels[t][depth + 1] = np.concatenate([levels[t][depth + 1], [child, child + 1]])
            for i, n in enumerate((n_left, n_both - n_left)):
                if depth + 1 < growth.depth and not closed(both[i:i + 1], growth)[0]:
                    if n > LOCAL_ROWS:
                        large.append((t, child + i))
                    else:
                        ready[t, child + i] = growth.depth - depth - 1
        sent.destroy()
    return tops, ready, {t: (gains[t], levels[t]) for t in tops}


def grow_trees(pieces: DataFrame, growth: Growth, n_rows: int) -> list[Tree]:
    """All trees of the stored rows."""
    tops, ready, notes = _top_levels(pieces, growth, n_rows)
    depth_of = {t: len(levels) - 1 for t, (_, levels) in notes.items()}
    sent = pieces.sparkSession.sparkContext.broadcast(({t: _ways(tree) for t, tree in tops.items()}, ready))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, levels_left = sent.value
        for batch in batches:
            for piece, bins, labels, copies in _unpacked(batch, growth):
                for t, top in trees.items():
                    weights = drawn(copies, growth, t, piece)
                    at = walk(top, bins, depth_of[t])
                    for node in np.unique(at).tolist():
                        rows = np.flatnonzero((weights > 0) & (at == node))
                        if (t, node) in levels_left and len(rows):
                            parts = [np.ascontiguousarray(bins[rows]), labels[rows], np.minimum(weights[rows], (1 << 31) - 1).astype(np.int32)]
                            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([node], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                                                             names=["tree", "node", "bins", "labels", "weights"])

    def grow(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        t, node = key[0].as_py(), key[1].as_py()
        bins, labels, weights = [np.concatenate([np.frombuffer(b, kind) for b in table[c].to_pylist()]) for c, kind in (("bins", np.uint8), ("labels", np.uint8), ("weights", np.int32))]
        draws = np.random.default_rng([growth.seed & 0xFFFFFFFF, t, node, 2])
        tree = grow_rows(bins.reshape(len(labels), -1), labels, weights, sent.value[1][t, node], growth, draws)
        leaf = tree.feature < 0
        parts = [tree.feature.astype(np.int32), tree.split, tree.left, np.where(leaf[:, None], tree.counts, 0)[leaf].astype(np.uint32), tree.importance, tree.counts[0]]
        return pa.table([pa.array([t], pa.int32()), pa.array([node], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], names=GROWN_NAMES)

    dealt = pieces.mapInArrow(deal, "tree int, node int, bins binary, labels binary, weights binary")
    grown = dealt.repartition(4 * max(1, len(ready)), "tree", "node").groupBy("tree", "node").applyInArrow(grow, GROWN).toArrow()
    sent.destroy()
    below: dict[int, list] = {}
    for row in zip(*(grown.column(c).to_pylist() for c in GROWN_NAMES)):
        below.setdefault(row[0], []).append(row)
    return [_joined(tops[t], below.get(t, []), *notes[t], growth) for t in range(growth.n_trees)]


GROWN_NAMES = ["tree", "node", "feature", "split", "left_child", "counts", "importance", "total"]
GROWN = "tree int, node int, feature binary, split binary, left_child binary, counts binary, importance binary, total binary"


def _joined(top: Tree, grown: list, gains: np.ndarray, levels: Sequence[np.ndarray], growth: Growth) -> Tree:
    """A tree from its top and the subtrees below it; counts are kept for leaves only."""
    subs = {}
    for _, node, feature, split, left, counts, importance, total in grown:
        feature = np.frombuffer(feature, np.int32)
        full = np.zeros((len(feature), growth.n_classes), dtype=np.uint32)
        full[feature < 0] = np.frombuffer(counts, np.uint32).reshape(-1, growth.n_classes)
        subs[node] = Tree(feature, np.frombuffer(split, np.uint8), np.frombuffer(left, np.int32), full, np.frombuffer(importance, np.float64))
        top.counts[node] = np.frombuffer(total, np.float64)
    if len(top.feature) == 1 and subs:
        return subs[0]
    # an open node counts as inner unless its subtree is one leaf; merging then looks at the top alone
    inner = [node for node, sub in subs.items() if len(sub.feature) > 1]
    mark = len(growth.n_bins)
    top.feature[inner], top.left[inner] = mark, 0
    vote = top.counts.argmax(axis=1)
    for ids in reversed(levels):
        split = ids[(top.feature[ids] >= 0) & (top.feature[ids] < mark)]
        a = top.left[split]
        same = (top.feature[a] < 0) & (top.feature[a + 1] < 0) & (vote[a] == vote[a + 1])
        top.feature[split[same]] = -1
    importance = top.importance.copy()
    feature, split, left, counts = [top.feature.copy()], [top.split.copy()], [top.left.copy()], [top.counts.astype(np.uint32)]
    own = np.flatnonzero((top.feature >= 0) & (top.feature < mark))
    np.add.at(importance, top.feature[own], gains[own] * top.counts[own].sum(axis=1))
    size = len(top.feature)
    for node in inner:
        sub = subs[node]
        # the root takes the open node's place, the others follow
        feature[0][node], split[0][node], left[0][node] = sub.feature[0], sub.split[0], sub.left[0] - 1 + size
        feature.append(sub.feature[1:])
        split.append(sub.split[1:])
        left.append(np.where(sub.feature[1:] >= 0, sub.left[1:] - 1 + size, 0).astype(np.int32))
        counts.append(sub.counts[1:])
        importance += sub.importance
        size += len(sub.feature) - 1
    return Tree(np.concatenate(feature), np.concatenate(split), np.concatenate(left), np.concatenate(counts), importance)


# -- the model -------------------------------------------------------------------------------------------------

class GrownForest(Model, MLWritable, MLReadable):
    """Trees over the bins of a ``features`` vector; adds ``rawPrediction``, ``probability`` and ``prediction`` as the
    library's model does."""

    def __init__(self, trees: Sequence[Tree] = (), splits: Sequence[np.ndarray] = (), n_classes: int = 0, depth: int = 0, features_col: str = "features"):
        super().__init__()
        self.trees, self.splits, self.n_classes, self.depth, self.features_col = list(trees), list(splits), n_classes, depth, features_col
        self._sent = None

    @property
    def importances(self) -> np.ndarray:
        """Summed gains of each feature, every tree's scaled to 1."""
        total = np.zeros(len(self.splits))
        for tree in self.trees:
            total += tree.importance / (tree.importance.sum() or 1.0)
        return total / (total.sum() or 1.0)

    def votes(self, x: Column, spark) -> Column:
        """Summed class shares of the leaves a row reaches, as an array."""
        if self._sent is None:
            self._sent = spark.sparkContext.broadcast([(*_ways(tree), tree.counts) for tree in self.trees])
        sent, splits, n_classes, depth = self._sent, self.splits, self.n_classes, self.depth
        n_bins = [len(s) + 1 for s in splits]
        n_cells = math.prod(n_bins)

        def summed(bins: np.ndarray) -> np.ndarray:
            total = np.zeros((len(bins), n_classes))
            for *nodes, counts in sent.value:
                counts = counts[walk(nodes, bins, depth)].astype(np.float64)
                n = counts.sum(axis=1, keepdims=True)
                total += np.divide(counts, n, out=np.zeros_like(counts), where=n > 0)
            return total

        @F.arrow_udf("array<double>")
        def voted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            # few combinations of bins: each is scored once a task
            known = np.zeros(n_cells, dtype=bool) if n_cells * n_classes <= KNOWN_CELLS else None
            kept = np.zeros((n_cells, n_classes)) if known is not None else None
            for batch in batches:
                bins = to_bins(_matrix(batch, len(splits)), splits)
                if known is None:
                    total = summed(bins)
                else:
                    cell = _cells(bins, n_bins)
                    new = np.unique(cell[~known[cell]])
                    if len(new):
                        kept[new], known[new] = summed(_of_cells(new, n_bins)), True
                    total = kept[cell]
                places = np.arange(len(batch) + 1, dtype=np.int32) * n_classes
                yield pa.ListArray.from_arrays(pa.array(places), pa.array(total.ravel()))

        return voted(x)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        voted = dataset.withColumn("_votes", self.votes(vector_to_array(self.features_col), dataset.sparkSession))
        total = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
        best = (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")
        return voted.withColumn("rawPrediction", array_to_vector("_votes")).withColumn(
            "probability", array_to_vector(F.transform("_votes", lambda v: F.when(total > 0, v / total).otherwise(0.0)))).withColumn("prediction", best).drop("_votes")

    def release(self) -> None:
        """The copies that were sent out are not needed any more."""
        if self._sent is not None:
            self._sent.destroy()
            self._sent = None

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


STORED = ("feature", "split", "left", "counts", "importance")
STORED_KINDS = dict(zip(STORED, (np.int32, np.uint8, np.int32, np.float64, np.float64)))


class _ForestWriter(MLWriter):
    def __init__(self, model: GrownForest):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        shape = {"n_classes": m.n_classes, "depth": m.depth, "features_col": m.features_col, "splits": [s.tolist() for s in m.splits]}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=shape)
        rows = [(t, *(bytearray(np.ascontiguousarray(getattr(tree, c), dtype=STORED_KINDS[c]).tobytes()) for c in STORED)) for t, tree in enumerate(m.trees)]
        schema = "tree int, feature binary, split binary, left binary, counts binary, importance binary"
        self.sparkSession.createDataFrame(rows, schema).write.parquet(f"{path}/trees")


class _ForestReader(MLReader):
    def load(self, path: str) -> GrownForest:
        shape = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        trees = []
        for row in self.sparkSession.read.parquet(f"{path}/trees").orderBy("tree").collect():  # one row per tree
            parts = {c: np.frombuffer(bytes(row[c]), STORED_KINDS[c]) for c in STORED}
            trees.append(Tree(**{**parts, "counts": parts["counts"].reshape(-1, shape["n_classes"])}))
        return GrownForest(trees, [np.array(s) for s in shape["splits"]], shape["n_classes"], shape["depth"], shape["features_col"])


def grow_forest(rows: DataFrame, features_col: str, label_col: str, max_bins: int, settings: dict) -> GrownForest:
    """``settings``: n_trees, depth, least, tried (a function of the number of features), seed, bootstrap."""
    spark = rows.sparkSession
    shaped = rows.select(vector_to_array(features_col).alias("x"), F.col(label_col).cast("double").alias("label"))
    odd = F.col("label").isNull() | F.isnan("label") | (F.col("label") < 0) | (F.col("label") != F.floor("label"))
    seen = shaped.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("top"), F.count_if(odd).alias("odd")).first()
    if seen["odd"] or not seen["n"] or seen["top"] >= 100:
        raise ValueError(f"{seen['odd']} of {seen['n']} rows have no label from 0 to 99; the largest is {seen['top']}")
    n_rows, n_classes = seen["n"], max(2, int(seen["top"]) + 1)
    share = min(1.0, max(max_bins * max_bins, SPLIT_ROWS) / n_rows)
    sample = (shaped if share == 1.0 else shaped.sample(False, share, settings["seed"] & 0x7FFFFFFF)).select("x").toArrow()
    first = sample.column(0)[0].as_py() if sample.num_rows else shaped.first()["x"]
    if first is None:
        raise ValueError("a row has no features")
    values = _finite(_matrix(sample.column(0), len(first)))
    most = min(max_bins, n_rows) - 1
    splits = [split_points(values[:, f], most) for f in range(values.shape[1])]
    growth = Growth(settings["n_trees"], settings["depth"], settings["least"], settings["tried"](len(splits)), settings["seed"], n_classes,
                    tuple(len(s) + 1 for s in splits), settings["bootstrap"])
    if growth.width == 1:
        growth = Growth(**{**growth.__dict__, "n_bins": (2, *growth.n_bins[1:])})
    pieces, n_stored = stored_pieces(shaped, splits, growth, n_rows)
    return GrownForest(grow_trees(pieces, growth, n_stored), splits, n_classes, growth.depth, features_col)

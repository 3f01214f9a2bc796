"""Exact near-duplicates among embeddings by dual traversal of cover trees.

Vectors are compared as unit vectors, where a cosine bound is a distance bound. Equal vectors become one
with a weight. The upper level of the tree is a set of cells around centres from a bounded sample; every
vector lives in the cell of its nearest centre, in one of its blocks. A block has a centre, a covering radius
and a tree of nested levels of nodes with halving radii, and is stored once. Two blocks meet if their centres
and radii allow vectors near enough. Blocks are read where they meet and not copied by a shuffle, so what is
on disk grows with the rows, however many blocks meet. There both trees are descended at once: a pair of nodes
is left as soon as their centres are farther apart than the bound and both covering radii, and counted as a
whole, without looking at its vectors, when even their farthest vectors are near. What is left is decided by
exact cosines.

Tasks return the number of links of each vector and a spanning forest of the links, never all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stored
from ordermill.llm.components import components

COSINE = 0.95
#: Vectors of a block, about; larger cells are dealt into blocks. Small tables have smaller ones, for all cores.
BLOCK_ROWS = 8192
_LEAST_BLOCK_ROWS = 1024
_LEAST_BLOCKS = 12
#: Components of the vectors of a block, about.
_BLOCK_VALUES = 1 << 19
#: Rows that centres are chosen from, and centres at most.
SAMPLE_ROWS = 2048
MOST_CELLS = 1024
_MARGIN = 1e-9
#: Sides of the part of a matrix of cosines that is looked at at a time.
_AT_A_TIME = (256, 2048)
#: Of vectors of so many components at least, so large a part is multiplied first.
_LEAST_TO_CUT = 32
_HEAD = 3 / 8
#: Blocks of a partition; a task compares two partitions, and there are a few of them for all cores.
_TOGETHER = 16
_LEAST_TOGETHER = 6
#: Pairs of nodes that are taken one by one.
_MANY_OPEN = 64
#: Pairs of points that are compared in the time that one pair of nodes takes, about.
_POINTS_A_NODE = 1000
#: Wider nodes exclude nothing: unit vectors are at most 2 apart.
_RADII = (0.5, 0.25, 0.125)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def _net(points: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres that are more than ``radius`` apart, and for each point the centre within ``radius`` of it."""
    centres: list[np.ndarray] = []
    of = np.full(len(points), -1)
    n = 0
    open_ = np.arange(len(points))
    while len(open_):
        some = open_[:256]
        near = _apart(points[some], points[some]) <= radius
        chosen: list[int] = []
        for i in range(len(some)):
            if not near[i, chosen].any():
                chosen.append(i)
        new = some[chosen]
        distance = _apart(points[open_], points[new])
        nearest = distance.argmin(axis=1)
        covered = distance[np.arange(len(open_)), nearest] <= radius
        of[open_[covered]] = n + nearest[covered]
        of[new] = n + np.arange(len(new))
        n += len(new)
        centres.append(new)
        open_ = open_[of[open_] < 0]
    return np.concatenate(centres), of


def _nearest(rough: np.ndarray) -> np.ndarray:
    """For each point the cosine of the nearest other one, in single precision."""
    found = np.full(len(rough), -1.0, np.float32)
    rows, columns = _AT_A_TIME
    for s in range(0, len(rough), rows):
        for t in range(0, len(rough), columns):
            cosines = rough[s : s + rows] @ rough[t : t + columns].T
            itself = np.arange(max(s, t), min(s + rows, t + columns, len(rough)))
            cosines[itself - s, itself - t] = -1
            found[s : s + rows] = np.maximum(found[s : s + rows], cosines.max(axis=1))
    return found


class CoverTree:
    """Nested levels over points: ``levels[0]`` are single points, each further one has fewer, wider nodes.

    A level holds the points at its centres, covering radii (the farthest point below), points below, and the
    members of each node in the level under it. Levels that would gather almost nothing are left out.
    """

    def __init__(self, points: np.ndarray, weights: np.ndarray, packed: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.points, self.weights = points, weights
        self.rough = points.astype(np.float32)
        n = len(points)
        at, below = np.arange(n), np.arange(n)  # centres of the level so far; for each point its node there
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, list]] = [(at, np.zeros(n), np.ones(n, np.int64), [])]
        #: Of each level over the points: which nodes of the level under it are its centres, and the node each of them is in.
        self.packed: list[tuple[np.ndarray, np.ndarray]] = []
        for chosen, of in self._nets() if packed is None else packed:
            at, below = self._add(at, below, chosen, of)
            self.packed.append((chosen, of))

    def _add(self, at: np.ndarray, below: np.ndarray, chosen: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(of, kind="stable")
        members = np.split(order, np.searchsorted(of[order], np.arange(1, len(chosen))))
        below = of[below]
        at = at[chosen]
        far = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", self.points, self.points[at[below]]), 0))
        reach = np.zeros(len(at))
        np.maximum.at(reach, below, far)
        self.levels.append((at, reach, np.bincount(below, minlength=len(at)), members))
        return at, below

    def _nets(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        nearest = None
        for radius in reversed(_RADII):
            at = self.levels[-1][0]
            if nearest is None:
                nearest = _nearest(self.rough[at])
            crowded = nearest >= 1 - radius**2 / 2 - 1e-5
            if crowded.sum() < 0.05 * len(at):
                continue
            # A point without another one near is a node of its own.
            some, lone = np.flatnonzero(crowded), np.flatnonzero(~crowded)
            centres, in_net = _net(self.points[at[some]], radius)
            chosen = np.concatenate([some[centres], lone])
            if len(chosen) > 0.95 * len(at):
                continue
            of = np.empty(len(at), np.int64)
            of[some], of[lone] = in_net, len(centres) + np.arange(len(lone))
            yield chosen, of
            nearest = None

    def under(self, level: int, node: int) -> np.ndarray:
        """Points below a node."""
        nodes = np.array([node])
        while level:
            nodes = np.concatenate([self.levels[level][3][i] for i in nodes])
            level -= 1
        return nodes


def _head(rough: np.ndarray) -> np.ndarray:
    """The first components and the length of the others: products of these are never less than the cosines."""
    n = int(rough.shape[1] * _HEAD)
    others = rough[:, n:]
    return np.column_stack([rough[:, :n], np.sqrt(np.einsum("ij,ij->i", others, others))])


def _cosines(a: CoverTree, x: np.ndarray, b: CoverTree, y: np.ndarray, least: float, later: bool = False, crowded=None) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs (i, j) of ``x`` and ``y`` with their cosines, of which none of ``least`` or more is missing.

    Single precision finds the pairs, double precision gives the cosines. Where the first components and the
    lengths of the others exclude all pairs of a part, the others are not multiplied. With ``later``, pairs of
    a ``y`` before ``x`` in their order may be missing. Parts that are full of pairs go to ``crowded``, if
    given, as slices of ``x`` and ``y``.
    """
    rough_a, rough_b = a.rough[x], b.rough[y]
    rows, columns = _AT_A_TIME
    cut = rough_a.shape[1] >= _LEAST_TO_CUT
    head_a, head_b = (_head(rough_a), _head(rough_b)) if cut else (rough_a, rough_b)
    seen = passed = 0
    room = np.empty(min(rows, len(x)) * min(columns, len(y)), np.float32)
    for s in range(0, len(x), rows):
        for t in range(0, len(y), columns):
            if later and t + columns <= s:
                continue
            some, others = x[s : s + rows], y[t : t + columns]
            rough = room[: len(some) * len(others)].reshape(len(some), len(others))
            if cut:
                seen += 1
                if np.matmul(head_a[s : s + rows], head_b[t : t + columns].T, out=rough).max() < least - 1e-5:
                    continue
                passed += 1
                cut = seen < 8 or 2 * passed < seen
            if np.matmul(rough_a[s : s + rows], rough_b[t : t + columns].T, out=rough).max() < least - 1e-5:
                continue
            pairs = rough >= least - 1e-5
            if crowded is not None and np.count_nonzero(pairs) > pairs.size / 16:
                crowded(slice(s, s + rows), slice(t, t + columns))
                continue
            i, j = np.divmod(np.flatnonzero(pairs), len(others))
            if len(i) > len(some) * 16:
                cosines = (a.points[some] @ b.points[others].T)[i, j]
            else:
                cosines = np.einsum("ij,ij->i", a.points[some[i]], b.points[others[j]])
            yield some[i], others[j], cosines


class Links:
    """Numbers of links, and a forest of them, for the points of two trees (or one with itself)."""

    def __init__(self, n: int):
        self.count = np.zeros(n, np.int64)
        self.root = np.arange(n)

    def grow(self, n: int) -> None:
        """Adds ``n`` points."""
        self.root = np.r_[self.root, np.arange(len(self.root), len(self.root) + n)]
        self.count = np.r_[self.count, np.zeros(n, np.int64)]

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while True:
            low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
            apart = low != high
            if not apart.any():
                return
            np.minimum.at(root, high[apart], low[apart])
            while (root != (up := root[root])).any():
                root[:] = up


def traverse(a: CoverTree, b: CoverTree, links: Links, shift_a: int, shift_b: int, cosine: float = COSINE) -> None:
    """Adds the links between the points of two trees, numbered from ``shift_a`` and ``shift_b`` on.

    If both are the same tree, each pair is taken once: an entry that waits has either the same nodes on both
    sides, of which a pair is taken as (smaller, larger), or nodes with no point in common.
    """
    bound = float(np.sqrt(2 - 2 * cosine))

    def exact(x: np.ndarray, y: np.ndarray, same: bool) -> None:
        if same:
            x = y = np.sort(x)

        def crowded(rows: slice, columns: slice) -> None:
            """Counts links without making a list of them."""
            i, j = x[rows], y[columns]
            near = a.points[i] @ b.points[j].T >= cosine
            if same:
                near &= i[:, None] < j
            ones = near.astype(np.float64)
            links.count[i + shift_a] += (ones @ b.weights[j].astype(np.float64)).astype(np.int64)
            links.count[j + shift_b] += (a.weights[i].astype(np.float64) @ ones).astype(np.int64)
            some, others = near.any(axis=1), near.any(axis=0)
            links.join(i[some] + shift_a, j[near.argmax(axis=1)[some]] + shift_b)
            links.join(i[near.argmax(axis=0)[others]] + shift_a, j[others] + shift_b)
            k, m = np.nonzero(near & (links.root[i + shift_a][:, None] != links.root[j + shift_b]))
            links.join(i[k] + shift_a, j[m] + shift_b)

        for i, j, cosines in _cosines(a, x, b, y, cosine, same, crowded):
            near = cosines >= cosine
            if same:
                near &= i < j
            i, j = i[near], j[near]
            np.add.at(links.count, i + shift_a, b.weights[j])
            np.add.at(links.count, j + shift_b, a.weights[i])
            links.join(i + shift_a, j + shift_b)

    def whole(la: int, p: int, lb: int, q: int, same: bool) -> None:
        x = a.under(la, p)
        if same and p == q:
            links.count[x + shift_a] += int(a.weights[x].sum()) - a.weights[x]
            links.join(np.repeat(x[:1], len(x)) + shift_a, x + shift_a)
            return
        y = b.under(lb, q)
        links.count[x + shift_a] += int(b.weights[y].sum())
        links.count[y + shift_b] += int(a.weights[x].sum())
        links.join(np.repeat(x[:1], len(y)) + shift_a, y + shift_b)
        links.join(x + shift_a, np.repeat(y[:1], len(x)) + shift_b)

    waiting = [(len(a.levels) - 1, np.arange(len(a.levels[-1][0])), len(b.levels) - 1, np.arange(len(b.levels[-1][0])), a is b)]
    while waiting:
        la, nodes_a, lb, nodes_b, same = waiting.pop()
        at_a, reach_a, many_a, members_a = a.levels[la]
        at_b, reach_b, many_b, members_b = b.levels[lb]
        if la == 0 and lb == 0:
            exact(nodes_a, nodes_b, same)
            continue
        # Nodes of a single point reach nowhere and are kept from those that do, so that they exclude more.
        lone_a, lone_b = many_a[nodes_a] == 1, many_b[nodes_b] == 1
        if lone_a.all() and lone_b.all():
            waiting.append((0, at_a[nodes_a], 0, at_b[nodes_b], same))
            continue
        if 0 < lone_a.sum() < len(lone_a) or 0 < lone_b.sum() < len(lone_b):
            for in_a in (lone_a, ~lone_a):
                for in_b in (lone_b, ~lone_b):
                    # Of the two entries of different nodes of one tree one is enough.
                    if in_a.any() and in_b.any() and not (same and in_b is lone_b and in_a is not lone_a):
                        waiting.append((la, nodes_a[in_a], lb, nodes_b[in_b], same and (in_a is lone_a) == (in_b is lone_b)))
            continue
        widest = bound + reach_a[nodes_a].max() + reach_b[nodes_b].max() + _MARGIN
        parts = []
        for i, j, cosines in _cosines(_Centres(a, at_a), nodes_a, _Centres(b, at_b), nodes_b, 1 - min(widest, 2.0) ** 2 / 2):
            apart = np.sqrt(np.maximum(2 - 2 * cosines, 0))
            reach = reach_a[i] + reach_b[j]
            keep = apart - reach <= bound + _MARGIN
            if same:
                keep &= (i < j) | (i == j) & (many_a[i] > 1)
            parts.append((i[keep], j[keep], (apart + reach <= bound - _MARGIN)[keep]))
        if not parts:
            continue
        i, j, near = (np.concatenate(x) for x in zip(*parts, strict=True))
        points = float(many_a[np.unique(i)].sum()) * float(many_b[np.unique(j)].sum())
        if (~near).sum() > _MANY_OPEN or len(i) * _POINTS_A_NODE > points:
            # Many small nodes close to each other: their points are compared at once. Pairs of nodes
            # that were left hold no links, so nothing is counted that shouldn't be.
            nodes_a, nodes_b = np.unique(i), np.unique(j)
            if same:
                nodes_a = nodes_b = np.union1d(nodes_a, nodes_b)
            x = np.concatenate([a.under(la, p) for p in nodes_a.tolist()])
            y = x if same else np.concatenate([b.under(lb, q) for q in nodes_b.tolist()])
            waiting.append((0, x, 0, y, same))
            continue
        for p, q in zip(i[near].tolist(), j[near].tolist(), strict=True):
            whole(la, p, lb, q, same)
        # Both sides descend, so that in a tree with itself they stay on one level.
        for p, q in zip(i[~near].tolist(), j[~near].tolist(), strict=True):
            da, db = max(la - 1, 0), max(lb - 1, 0)
            below_a = members_a[p] if la else np.array([p])
            below_b = members_b[q] if lb else np.array([q])
            waiting.append((da, below_a, db, below_b, same and p == q))


class _Centres:
    """The centres of a level, as points of their own."""

    def __init__(self, tree: CoverTree, at: np.ndarray):
        self.points, self.rough = tree.points[at], tree.rough[at]


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, as doubles."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]  # neither too large nor too small to square
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _by_size(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Rows, vectors and digests of their unit vectors, by size, without vectors that link with nothing."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    starts, sizes = offsets[:-1], np.diff(offsets)
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), sizes, 0)
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        vectors = values[starts[rows][:, None] + np.arange(size)]
        good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
        rows, vectors = rows[good], vectors[good]
        if len(rows):
            yield rows, vectors, [hashlib.md5(unit).digest() for unit in _unit(vectors)]


def _vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` in floats or doubles."""
    exact = embeddings.schema["embedding"].dataType.simpleString() in ("array<float>", "array<double>")
    vector = F.col("embedding") if exact else F.col("embedding").cast("array<double>")
    return embeddings.select("vec_id", vector.alias("embedding"))


def _digested(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``size`` and ``digest``; null for vectors that link with nothing."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [None] * batch.num_rows, [None] * batch.num_rows
            for rows, part, own in _by_size(batch.column("embedding")):
                for row, digest in zip(rows.tolist(), own, strict=True):
                    sizes[row], digests[row] = part.shape[1], digest
            columns = [batch.column("vec_id"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "size", "digest"])

    return vectors.mapInArrow(run, f"vec_id {kind}, size int, digest binary")


def _centres(vectors: DataFrame, kinds: DataFrame, size: int, cells: int) -> np.ndarray:
    """Centres far from each other, from a sample of at most ``SAMPLE_ROWS`` vectors taken by hash."""
    if cells == 1:
        return np.zeros((1, size))
    sample = kinds.orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE_ROWS).select("digest").collect()
    wanted = {bytes(r["digest"]) for r in sample}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}
            for _, part, digests in _by_size(batch.column("embedding")):
                found |= {d: part[i] for i, d in enumerate(digests) if d in wanted}
            if found:
                units = [unit.tobytes() for unit in _unit(np.stack(list(found.values())))]
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(units, pa.binary())], names=["digest", "unit"])

    rows = vectors.mapInArrow(run, "digest binary, unit binary").groupBy("digest").agg(F.first("unit").alias("unit")).collect()
    units = [bytes(r["unit"]) for r in sorted(rows, key=lambda r: bytes(r["digest"]))]
    points = np.frombuffer(b"".join(units), np.float64).reshape(-1, size)
    chosen, far = [0], _apart(points[:1], points)[0]
    while len(chosen) < min(cells, MOST_CELLS, len(points)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _apart(points[chosen[-1:]], points)[0])
    return points[chosen]


def _cells(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    if len(centres) == 1:
        return np.zeros(len(vectors), np.int64)
    unit = _unit(vectors)
    return np.concatenate([_apart(unit[s : s + 1024], centres).argmin(axis=1) for s in range(0, len(unit), 1024)])


def _at_home(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """``cell`` and ``digest``, once in a batch at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part, digests in _by_size(batch.column("embedding")):
                cell = dict(zip(digests, _cells(part, centres).tolist(), strict=True))
                columns = [pa.array(list(cell.values()), pa.int32()), pa.array(list(cell), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "digest"])

    return vectors.mapInArrow(run, "cell int, digest binary")


def _dealt(vectors: DataFrame, centres: np.ndarray, blocks: np.ndarray, first: int) -> DataFrame:
    """``block``, ``digest``, ``weight``, ``vector`` (its bytes); equal vectors of a batch are one row."""
    before = first + np.r_[0, np.cumsum(blocks)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part, digests in _by_size(batch.column("embedding")):
                index: dict[bytes, int] = {}
                kind = np.array([index.setdefault(d, len(index)) for d in digests])
                rows = np.unique(kind, return_index=True)[1]
                cell = _cells(part[rows], centres)
                own = np.frombuffer(b"".join(index), np.uint64)[::2] % blocks[cell].astype(np.uint64)
                columns = [
                    pa.array(before[cell] + own.astype(np.int64), pa.int32()),
                    pa.array(list(index), pa.binary()),
                    pa.array(np.bincount(kind)),
                    pa.array([v.tobytes() for v in part[rows]], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "digest", "weight", "vector"])

    return vectors.mapInArrow(run, "block int, digest binary, weight long, vector binary")


_BLOCK = "block int, n int, centre array<double>, reach double, weights binary, vectors binary, tree binary, digests binary"


def _packed(tree: CoverTree) -> bytes:
    parts = [np.array([len(tree.packed)], np.int32)]
    for chosen, of in tree.packed:
        parts += [np.array([len(chosen), len(of)], np.int32), chosen.astype(np.int32), of.astype(np.int32)]
    return b"".join(p.tobytes() for p in parts)


def _unpacked(packed: bytes) -> list[tuple[np.ndarray, np.ndarray]]:
    numbers, at, levels = np.frombuffer(packed, np.int32).astype(np.int64), 1, []
    for _ in range(numbers[0]):
        n, m = numbers[at : at + 2].tolist()
        levels.append((numbers[at + 2 : at + 2 + n], numbers[at + 2 + n : at + 2 + n + m]))
        at += 2 + n + m
    return levels


def _blocks(dealt: DataFrame, size: int, kind: str) -> DataFrame:
    """A row per block, as in ``_BLOCK``, with its vectors in the order of their digests."""

    def row(block: int, parts: list[tuple[list[bytes], np.ndarray, list[bytes]]]) -> pa.RecordBatch:
        digests = [d for p in parts for d in p[0]]
        weights, vectors = np.concatenate([p[1] for p in parts]), [v for p in parts for v in p[2]]
        new = np.array([i for i, d in enumerate(digests) if i == 0 or d != digests[i - 1]])
        weights = np.add.reduceat(weights, new)
        held = b"".join(vectors[i] for i in new)
        points = _unit(np.frombuffer(held, kind).reshape(-1, size))
        centre = points.mean(axis=0)
        if np.sqrt(centre @ centre) < 1e-6:
            centre = points[0]
        centre = centre / np.sqrt(centre @ centre)
        reach = float(_apart(points, centre[None]).max())
        tree = _packed(CoverTree(points, weights))
        values = [block, len(new), centre.tolist(), reach, weights.tobytes(), held, tree, b"".join(digests[i] for i in new)]
        types = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.float64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[f.split()[0] for f in _BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = -1, []
        for batch in batches:
            of = batch.column("block").to_numpy()
            turn = (np.flatnonzero(of[1:] != of[:-1]) + 1).tolist()
            for a, z in zip([0, *turn], [*turn, len(of)], strict=True):
                if a == z:
                    continue
                if of[a] != block and parts:
                    yield row(block, parts)
                    parts = []
                block = int(of[a])
                part = batch.slice(a, z - a)
                parts.append((part.column("digest").to_pylist(), part.column("weight").to_numpy(), part.column("vector").to_pylist()))
        if parts:
            yield row(block, parts)

    return dealt.repartition("block").sortWithinPartitions("block", "digest").mapInArrow(run, _BLOCK)


def _node(block: int) -> int:
    """The node of the first vector of a block; the others follow."""
    return block << 32


def _members(blocks: DataFrame) -> DataFrame:
    """``digest`` and ``node`` of the vectors of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, joined in zip(batch.column("block").to_pylist(), batch.column("digests").to_pylist(), strict=True):
                digests = [joined[i : i + 16] for i in range(0, len(joined), 16)]
                nodes = _node(block) + np.arange(len(digests))
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(nodes)], names=["digest", "node"])

    return blocks.select("block", "digests").mapInArrow(run, "digest binary, node long")


def _meetings(blocks: DataFrame, n: int, bound: float) -> DataFrame:
    """Pairs of blocks, a block with itself included, that may hold vectors within ``bound`` of each other.

    A task reads two partitions of stored blocks and pairs them there. Nothing is written, however many pairs.
    """
    held = blocks.select("block", "centre", "reach", "weights", "vectors", "tree").coalesce(max(-(-n // _TOGETHER), min(n, _LEAST_TOGETHER)))
    a, b = (held.select(*(F.col(c).alias(f"{side}_{c}") for c in held.columns)) for side in "ab")
    cosine = F.aggregate(F.zip_with("a_centre", "b_centre", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.sqrt(F.greatest(F.lit(2.0) - F.lit(2.0) * cosine, F.lit(0.0)))
    near = apart <= F.col("a_reach") + F.col("b_reach") + F.lit(bound + 1e-6)
    return a.join(b.hint("shuffle_replicate_nl"), (F.col("a_block") <= F.col("b_block")) & near).drop("a_centre", "a_reach", "b_centre", "b_reach")


def _linked(meetings: DataFrame, size: int, kind: str, cosine: float) -> DataFrame:
    """``u``, ``v``, ``n``: links of ``u`` found in a task (where ``v`` is ``u``), and links that span them (n = 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, at, trees = Links(0), {}, {}

        def tree(batch: pa.RecordBatch, row: int, side: str) -> tuple[CoverTree, int]:
            block = batch.column(f"{side}_block")[row].as_py()
            if block not in trees:
                weights, vectors, packed = (batch.column(f"{side}_{c}")[row].as_buffer() for c in ("weights", "vectors", "tree"))
                if len(trees) > _TOGETHER + 2:
                    del trees[next(iter(trees))]
                points = _unit(np.frombuffer(vectors, kind).reshape(-1, size))
                trees[block] = CoverTree(points, np.frombuffer(weights, np.int64).copy(), _unpacked(packed))
            trees[block] = trees.pop(block)  # the last to go
            if block not in at:
                at[block] = len(links.root)
                links.grow(len(trees[block].points))
            return trees[block], at[block]

        for batch in batches:
            for row in range(batch.num_rows):
                (a, from_a), (b, from_b) = tree(batch, row, "a"), tree(batch, row, "b")
                traverse(a, b, links, from_a, from_b, cosine)
        node = np.concatenate([np.zeros(0, np.int64), *(_node(b) + np.arange(z - a) for b, a, z in zip(at, at.values(), [*at.values(), len(links.root)][1:]))])
        counted = np.flatnonzero(links.count)
        joined = np.flatnonzero(links.root != np.arange(len(node)))
        for u, v, n in ((counted, counted, links.count[counted]), (joined, links.root[joined], np.zeros(len(joined), np.int64))):
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v]), pa.array(n)], names=["u", "v", "n"])

    return meetings.mapInArrow(run, "u long, v long, n long")


def _blocks_of_size(vectors: DataFrame, kinds: DataFrame, size: int, block_rows: int, first: int) -> tuple[DataFrame, int]:
    """Stored blocks of the vectors of a size, numbered from ``first``, and the number after them."""
    vectors, kinds = vectors.filter(F.size("embedding") == size).select("embedding"), kinds.filter(F.col("size") == size)
    n = kinds.count()
    rows = min(block_rows, max(_LEAST_BLOCK_ROWS, n // _LEAST_BLOCKS), max(256, _BLOCK_VALUES // size))
    centres = _centres(vectors, kinds, size, -(-n // rows))
    blocks = np.ones(len(centres), np.int64)
    if len(centres) > 1:
        for r in _at_home(vectors, centres).distinct().groupBy("cell").count().collect():
            blocks[r["cell"]] = -(-r["count"] // rows)
    else:
        blocks[0] = -(-n // rows)
    kind = "f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "f8"
    return stored(_blocks(_dealt(vectors, centres, blocks, first), size, kind)), first + int(blocks.sum())


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row ``vec_id``, ``n_links``, ``component_id``, ``kept``, over all pairs with ``cosine`` or more.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; vectors of
    different lengths don't link either. Equal vectors link with each other. Repeated rows count as further
    vectors; a null ``vec_id`` is in its component but doesn't name it unless it has no other; an empty table
    gives no rows; other columns, labels included, are ignored.
    """
    vectors = _vectors(embeddings)
    kind = "f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "f8"
    rows = stored(_digested(vectors))
    kinds = rows.filter("digest IS NOT NULL").groupBy("digest", "size").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"))
    kinds = stored(kinds)
    found = members = None
    n = 0
    for r in sorted(kinds.select("size").distinct().collect()):
        before = n
        blocks, n = _blocks_of_size(vectors, kinds, r["size"], block_rows, before)
        links = _linked(_meetings(blocks, n - before, float(np.sqrt(2 - 2 * cosine))), r["size"], kind, cosine)
        found = links if found is None else found.unionByName(links)
        members = _members(blocks) if members is None else members.unionByName(_members(blocks))
    alone = rows.filter("digest IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if found is None:
        return alone
    found = stored(found)
    counts = found.groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("u != v").select("u", "v"))
    named = kinds.join(members, "digest").join(counts, "node", "left").join(roots, "node", "left")
    named = named.select("digest", "weight", "first", "n", F.coalesce("root", "node").alias("root"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "root").select("digest", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    linked = rows.select("vec_id", "digest").join(named, "digest")
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    return linked.select("vec_id", "n_links", "component_id", kept).unionByName(alone)

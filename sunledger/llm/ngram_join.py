"""N-gram Jaccard join over count vectors, as a packed R-tree whose levels are Spark jobs.

A text's set is its distinct word shingles, as 64-bit hashes. The hash range is cut into
groups; the number of a set's shingles in each group is a coordinate, so a set is a point,
and the overlap of two sets is at most the sum over the groups of the smaller count. Two
sets of sizes a and b that reach the threshold t differ in at most
d = (100 - t)(a + b) / (100 + t) shingles.

Levels of the tree, from the root:

1. size bands: a pair's sizes lie in one band or in two neighbours;
2. cells: a band cuts the hash range into more than d blocks, so that a linked pair has
   equal contents in one block at least (blocks that are empty are left out as far as the
   number of blocks allows it). A block and its content name a cell. Points in equal cells
   are found by one shuffle of (cell, set), in which a task first merges its own rows;
3. leaves: the smallest set of a cell is its hub, and each set is compared with up to three
   hubs of its cells. The sets that links connect form a leaf. A hot cell of near copies is one leaf, and
   its members are never paired with each other: their component is known;
4. nodes: only cells with several leaves are left. Their points are packed, by leaf, into
   nodes of at most 64, and up to 16 nodes into a page, a row of a table; a node's bounding box
   holds the largest count of each coordinate and the smallest size. Pages of a cell meet in a
   join, and their nodes in its tasks. Two nodes are opened if the summed
   coordinate minima of their boxes allow a link, and only pairs of points of different
   leaves whose own minima allow one leave the task. Alike sets meet in most of their cells:
   a point carries its least cells, and a pair that these show to meet in a lesser cell too
   is left to that cell, so a pair leaves the tasks about once and not once per cell.

For components the last level runs in rounds: a task passes on two pairs of each leaf, the
likeliest and the one with the least leaf in the round's order, and those that link make one
leaf of theirs. So the sets of a group that hangs together leave as pairs of leaves and not as
all their pairs. Cells in which no pair was found are left out of the next round. When a round
joins few leaves, every pair of different leaves that remains leaves the tasks and is verified.
These pairs are tried once more by wide points: a long set has coordinates in proportion to its size. With a fixed
number of them the counts of all long sets are alike, and any two that share a cell would pass.

Pairs are verified on the shingles themselves, which are made anew from the texts of the sets
in question and go when their pairs are decided. Pairs are verified in slices, so that what is
shuffled at once is no more than the shingles of all sets. For components (``join``) every pair
of different sets that reaches the threshold is verified or already joined by links, so no
component is lost; most links inside a group are not looked at. ``similarity_join`` returns
all links: in its cells every set is a leaf of its own, so every pair of different sets that
the points allow is verified. A group of k texts that all link has k (k - 1) / 2 of them.

Hash equality stands for equality of shingles: within a pair that is a matter of 2**-64.

Defined cases: null or wordless text has an empty set and links with nothing; a text of
fewer words than the width is one shingle; equal sets link; rows with a null doc_id form
no links and have a null component. A set goes by the smallest doc_id that has it, and sets
that go by one doc_id are one node, as in the SQL: their links are united. So a doc_id with
several texts has a row for each, and the rows differ in component if one text is a copy of
a document with a smaller doc_id. ``keep_one`` goes by texts and not by documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import count
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sunledger.llm import common
from sunledger.session import materialise, new_shared_path, table_scope

#: Coordinates of a point.
GROUPS = 128
#: Shingles that a coordinate of a wide point stands for, at most.
LOAD = 8
#: Points of a node.
NODE = 64
#: Points of a page. Every pair of pages that meet is a row for Python, with all their points.
PAGE = 1024
#: Least cells that a point carries.
FIRST_CELLS = 8
_NO_CELL = (1 << 63) - 1
#: Pairs whose least cells are compared at once.
_CHUNK = 1 << 12
#: Pairs of sets that a task holds before it passes them on.
_HELD = 1 << 18
#: Rounds go on while they join at least one in so many of the leaves that have pairs.
_WORTH = 32
#: Tasks that pack the leaves of one cell side by side, at most.
_PACKERS = 16

_EMPTY = common.salt(5)


@lru_cache(maxsize=None)
def bands(percent: int, most: int = 1 << 31) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(smallest size, blocks, spare blocks) of each band.

    A band is at least as wide as a link: sets of a band link within it or with the next.
    Wider bands cost blocks, narrower ones make more sets count in two bands.
    """
    lows, blocks, spares = [], [], []
    low = 1
    while low <= most:
        high = max(low * 100 // percent, low * 3 // 2)
        differ = (100 - percent) * (high + high * 100 // percent) // (100 + percent)
        spare = 0
        if differ:
            empty = (differ + 2) * exp(-low / (differ + 2))
            spare = max(1, ceil(empty + 3 * sqrt(empty)))
        lows.append(low)
        blocks.append(differ + 1 + spare)
        spares.append(spare)
        low = high + 1
    return np.array(lows), np.array(blocks), np.array(spares)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles of one text's word hashes."""
    if not len(hashes):
        return hashes
    return np.unique(common.gram_hashes(hashes, min(width, len(hashes))))


def set_id(own: np.ndarray) -> np.uint64:
    total = np.add.reduce(common.mix(own ^ common.salt(11)))
    return common.mix(np.array([total + np.uint64(len(own))], np.uint64))[0]


def cells(own: np.ndarray, percent: int) -> np.ndarray:
    """The cells of a set: those of its band, and those it shares with the band below."""
    lows, blocks, spares = bands(percent)
    band = int(np.searchsorted(lows, len(own), "right")) - 1
    sums = np.zeros(len(own) + 1, np.uint64)
    np.cumsum(common.mix(own ^ common.salt(12)), out=sums[1:])
    # Only sets that can reach into the band below count there too.
    below = band > 0 and len(own) <= (int(lows[band]) - 1) * 100 // percent
    out = []
    for tag in range(band - below, band + 1):
        count = int(blocks[tag])
        step = (1 << 64) // count + 1
        borders = np.array([i * step for i in range(1, count)], np.uint64)
        at = np.concatenate(([0], np.searchsorted(own, borders), [len(own)]))
        full = np.diff(at) > 0
        code = sums[at[1:]] - sums[at[:-1]]
        code[~full] = _EMPTY
        keep = full if count - full.sum() <= spares[tag] else slice(None)
        place = np.arange(count, dtype=np.uint64) + np.uint64(tag << 32)
        out.append(common.mix(code + common.mix(place))[keep])
    return np.concatenate(out)


def _sets(column: pa.Array, width: int):
    """(first row, list of shingle sets) of each slice of texts."""
    for low, data, offsets in common.text_slices(column):
        words = common.split_words(data, offsets, common.SPACED)
        hashes = common.word_hashes(data, words)
        yield low, [shingles(hashes[a:b], width) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]


def _packed(points: np.ndarray) -> bytes:
    """Counts as bytes, in one byte each where all fit."""
    return points.astype(np.uint8 if points.max(initial=0) < 256 else np.int32).tobytes()


def _unpacked(data: np.ndarray, count: int = 1, groups: int = GROUPS) -> np.ndarray:
    kind = np.uint8 if len(data) == count * groups else np.int32
    return data.view(kind).reshape(count, groups).astype(np.int32)


def _width(n: int) -> int:
    """Coordinates of the wide point of a set of n shingles."""
    return max(GROUPS, 1 << (-(-n // LOAD) - 1).bit_length())


def _folded(points: np.ndarray, groups: int) -> np.ndarray:
    """Points in fewer coordinates: a group is the low bits of a hash, fewer bits join groups."""
    return points.reshape(len(points), -1, groups).sum(axis=1, dtype=np.int32)


def _points(column: pa.Array) -> np.ndarray:
    """The packed points of a column, one per row."""
    data, at = common.utf8(column)
    if (np.diff(at) == GROUPS).all():
        return _unpacked(data[at[0] : at[-1]], len(column))
    return np.concatenate([_unpacked(data[a:b].copy()) for a, b in zip(at[:-1], at[1:], strict=True)])


def _describe(width: int):
    """Per row: doc_id, n, set id, the point as counts, and the wide point if it is another."""

    def wide(own: np.ndarray) -> bytes | None:
        groups = _width(len(own))
        if groups == GROUPS:
            return None
        return _packed(np.bincount((own & np.uint64(groups - 1)).astype(np.int64), minlength=groups))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, sets in _sets(batch.column(1), width):
                points = np.zeros((len(sets), GROUPS), np.int32)
                for i, own in enumerate(sets):
                    points[i] = np.bincount((own & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([int(set_id(s).view(np.int64)) if len(s) else None for s in sets], pa.int64()),
                        pa.array([_packed(point) for point in points], pa.binary()),
                        pa.array([wide(s) for s in sets], pa.binary()),
                    ],
                    ["doc_id", "n", "sid", "point", "wide"],
                )

    return run


def _cell_rows(width: int, percent: int):
    """Rows (cell, sid, hub): a slice's sets of one cell are merged at once.

    The smallest set of a slice's cell goes to the cell's task; its hub is null, or itself
    if others stand behind it. The others already have it as their hub.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _sets(batch.column(1), width):
                found = {}
                for own in sets:
                    if len(own):
                        sid = set_id(own).view(np.int64)
                        if sid not in found:
                            found[sid] = cells(own, percent)
                if not found:
                    continue
                cell = np.concatenate(list(found.values())).view(np.int64)
                sid = np.repeat(np.fromiter(found, np.int64, len(found)), [len(c) for c in found.values()])
                order = np.lexsort((sid, cell))
                cell, sid = cell[order], sid[order]
                at = _begins(cell)
                sizes = np.diff(at, append=len(cell))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell),
                        pa.array(sid),
                        pa.array(np.repeat(sid[at], sizes), mask=np.repeat(sizes == 1, sizes)),
                    ],
                    ["cell", "sid", "hub"],
                )

    return run


def _begins(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


def _shared_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (merged, cell, sid): (cell, sid, hub) of cells with several sets.

    One row is held back at a time, so a hot cell streams through.
    """
    last = (None, None, True)  # cell, its hub, whether it is known to be shared
    for batch in batches:
        cell, sid = (batch.column(i).to_numpy() for i in range(2))
        many = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        hub = batch.column(2).fill_null(0).to_numpy()
        outer = int(np.searchsorted(many & (hub != sid), True))  # merged rows sort last
        out = [(cell[outer:], sid[outer:], hub[outer:])]
        if outer:
            cell, sid, many = cell[:outer], sid[:outer], many[:outer]
            at = _begins(cell)
            sizes = np.diff(at, append=outer)
            top = np.repeat(sid[at], sizes)
            goes_on = last[0] == cell[0]
            if goes_on:
                top[: sizes[0]] = last[1]
            shared = np.logical_or.reduceat(many | (sid != top), at)
            if goes_on:
                if shared[0] and not last[2]:
                    out.append(tuple(np.array([x]) for x in (last[0], last[1], last[1])))
                shared[0] |= last[2]
            last = (cell[-1], top[-1], bool(shared[-1]))
            keep = np.repeat(shared, sizes)
            out.append((cell[keep], sid[keep], top[keep]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([o[i] for o in out]).astype(np.int64)) for i in range(3)],
            ["cell", "sid", "hub"],
        )


def _allows(least: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m shingles with at most ``least`` in common may link."""
    # overlap / union >= t, with union = n + m - overlap
    return (100 + percent) * least.astype(np.int64) >= percent * (n + m)


def _near(percent: int):
    """Pairs (a, b) whose points allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = np.minimum(_points(batch.column(2)), _points(batch.column(3))).sum(axis=1)
            n, m = (batch.column(i).to_numpy() for i in (4, 5))
            both = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])
            yield both.filter(pa.array(_allows(least, n, m, percent)))

    return run


_PAGE = "cell long, page long, low long, high long, least long, most long, sids binary, leaves binary, sizes binary, points binary, firsts binary"


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (cell, leaf, sid, n, point, firsts) by cell and leaf: pages of at most ``PAGE`` points.

    Only the rows of an unfinished page are held back, so a hot cell streams through.
    """
    rest = None

    def cut(columns, final):
        cell, leaf, sid, n, points, firsts = columns
        borders = [*_begins(cell), len(cell)] if len(cell) else [0]
        out, done = [], 0
        for begin, end in zip(borders[:-1], borders[1:], strict=True):
            for low in range(begin, end, PAGE):
                high = min(low + PAGE, end)
                if high == len(cell) and not final:
                    break
                at, done = slice(low, high), high
                out.append(
                    (cell[low], sid[low], leaf[low], leaf[high - 1], n[at].min(), n[at].max(),
                     sid[at].tobytes(), leaf[at].tobytes(), n[at].tobytes(), _packed(points[at]), firsts[at].tobytes())
                )
        names = [field.split()[0] for field in _PAGE.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.binary()] * 5
        arrays = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(arrays, names), [c[done:] for c in columns]

    for batch in batches:
        firsts = batch.column(5).flatten().to_numpy().reshape(-1, FIRST_CELLS)
        columns = [batch.column(i).to_numpy() for i in range(4)] + [_points(batch.column(4)), firsts]
        if rest is not None:
            columns = [np.concatenate(pair) for pair in zip(rest, columns, strict=True)]
        pages, rest = cut(columns, False)
        yield pages
    if rest is not None:
        yield cut(rest, True)[0]


_PAIR = "a long, b long, la long, lb long, least long"
_PICK = f"{_PAIR}, cell long"


def _near_by_wide(percent: int):
    """Of rows (columns of ``_PAIR``, both wide points and sizes): pairs that these allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (7, 8))
            least = np.zeros(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                raw = (np.frombuffer(batch.column(j)[i].as_buffer(), np.uint8) for j in (5, 6))
                p, q = (_unpacked(x, 1, _width(int(k))) for x, k in zip(raw, (n[i], m[i]), strict=True))
                groups = min(p.shape[1], q.shape[1])
                least[i] = np.minimum(_folded(p, groups), _folded(q, groups)).sum()
            rows = pa.RecordBatch.from_arrays(batch.columns[:5], batch.schema.names[:5])
            yield rows.filter(pa.array(_allows(least, n, m, percent)))

    return run


_PACKED = ("sids", "leaves", "sizes", "points", "firsts")


def _met_before(cell: int, firsts: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Of pairs by their least cells: whether they are known to meet in a lesser cell."""
    out = np.zeros(len(firsts), bool)
    for low in range(0, len(firsts), _CHUNK):
        x, y = firsts[low : low + _CHUNK], others[low : low + _CHUNK]
        both = (x[:, :, None] == y[:, None, :]) & (x < cell)[:, :, None]
        out[low : low + _CHUNK] = both.any(axis=(1, 2))
    return out


def _picked(found: np.ndarray, round_: int) -> np.ndarray:
    """Of pairs (columns of ``_PICK``): each leaf's likeliest one, its one with the least leaf in
    the round's order, and one of each cell."""
    _, _, la, lb, least, cell = found
    leaf, other = np.concatenate([la, lb]), _in_round(np.concatenate([lb, la]), round_)
    least = np.concatenate([least, least])
    keep = [np.unique(cell, return_index=True)[1]]
    for order in (np.lexsort((other, -least, leaf)), np.lexsort((-least, other, leaf))):
        keep.append(order[_begins(leaf[order])] % len(la))
    return found[:, np.unique(np.concatenate(keep))]


def _in_round(leaves: np.ndarray, round_: int) -> np.ndarray:
    return common.mix(leaves.view(np.uint64) ^ common.salt(32 + round_))


class _Page:
    """A page's columns and, of each of its nodes, the box, the range of sizes and that of leaves."""

    def __init__(self, sids, leaves, sizes, points, firsts):
        self.sids, self.leaves, self.sizes = (x.view(np.int64) for x in (sids, leaves, sizes))
        self.points = _unpacked(points, len(self.sids))
        self.firsts = firsts.view(np.int64).reshape(-1, FIRST_CELLS)
        at = np.arange(0, len(self.sids), NODE)
        self.box = np.maximum.reduceat(self.points, at)
        self.least, self.most = np.minimum.reduceat(self.sizes, at), np.maximum.reduceat(self.sizes, at)
        self.low, self.high = np.minimum.reduceat(self.leaves, at), np.maximum.reduceat(self.leaves, at)


def _open_nodes(p: _Page, q: _Page, percent: int) -> np.ndarray:
    """Which nodes of two pages are opened: by sizes, leaves and boxes."""
    near = (100 * p.most[:, None] >= percent * q.least) & (100 * q.most >= percent * p.least[:, None])
    near &= (p.low[:, None] != q.high) | (p.high[:, None] != q.low)
    for i in np.flatnonzero(near.any(axis=1)):
        bound = np.minimum(p.box[i], q.box).sum(axis=1)
        near[i] &= _allows(bound, p.least[i], q.least, percent)
    return near


def _opened(percent: int, round_: int | None = None):
    """Of pairs of pages: the pairs of sets of different leaves that boxes and points allow,
    with their leaves (the smaller first) and the bound on what they share.

    In a round, what ``_picked`` keeps of a task's pairs, with their cells.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [np.zeros((6, 0), np.int64)], 0
        for batch in batches:
            same, cell = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            raw = [batch.column(i) for i in range(2, 12)]
            for row in range(batch.num_rows):
                parts = [np.frombuffer(c[row].as_buffer(), np.uint8) for c in raw]
                p, q = _Page(*parts[:5]), _Page(*parts[5:])
                near = _open_nodes(p, q, percent)
                if same[row]:
                    near = np.triu(near)
                for i, j in np.argwhere(near):
                    x, y = slice(i * NODE, (i + 1) * NODE), slice(j * NODE, (j + 1) * NODE)
                    ends = _met(p, x, q, y, cell[row], percent, same[row] and i == j)
                    found.append(ends)
                    held += ends.shape[1]
                    if held <= _HELD:
                        continue
                    if round_ is not None:
                        found[1:] = [_picked(np.concatenate(found, axis=1), round_)]
                        held = found[1].shape[1]
                    if round_ is None or 2 * held > _HELD:
                        yield rows(found)
                        found, held = found[:1], 0
            common.release_memory()
        yield rows(found)

    def rows(found):
        pairs = np.concatenate(found, axis=1)
        if round_ is not None and pairs.shape[1]:
            pairs = _picked(pairs, round_)
        names = [field.split()[0] for field in (_PAIR if round_ is None else _PICK).split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in pairs[: len(names)]], names)

    return run


def _met(p: _Page, x: slice, q: _Page, y: slice, cell: int, percent: int, same: bool) -> np.ndarray:
    """Of the points of two nodes: the pairs that leave the task (columns of ``_PICK``)."""
    n, m, points = p.sizes[x], q.sizes[y], q.points[y]
    leaves, others = p.leaves[x], q.leaves[y]
    least = np.empty((len(n), len(m)), np.int64)
    for i, point in enumerate(p.points[x]):
        least[i] = np.minimum(point, points).sum(axis=1)
    keep = _allows(least, n[:, None], m[None, :], percent) & (leaves[:, None] != others[None, :])
    if same:
        keep = np.triu(keep, 1)
    a, b = np.nonzero(keep)
    new = ~_met_before(cell, p.firsts[x][a], q.firsts[y][b])
    a, b = a[new], b[new]
    ends = np.stack([p.sids[x][a], q.sids[y][b], leaves[a], others[b], least[a, b], np.full(len(a), cell)])
    swap = ends[2] > ends[3]
    ends[:4, swap] = ends[[1, 0, 3, 2]][:, swap]
    return ends


def _stars(a: np.ndarray, b: np.ndarray, tops: bool = False) -> tuple[list[int], list[int]]:
    """The components of some links as one link per member to its least: the same
    components from fewer links, in the groups where every set links with every other.

    With ``tops`` the least of each also has a link, to itself.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        parent[max(x, y)] = min(x, y)
    ends = [(x, top) for x in parent if (top := root(x)) != x or tops]
    return [x for x, _ in ends], [top for _, top in ends]


def _verify(percent: int, stars: bool = True):
    """Of a batch of pairs (a, b) with their shingles: the stars of the true links, or the
    true links themselves with the shingles in both sets and in either."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            common_, either = np.zeros((2, batch.num_rows), np.int64)
            for i in range(batch.num_rows):
                a = np.frombuffer(left[i].as_buffer(), np.uint64)
                b = np.frombuffer(right[i].as_buffer(), np.uint64)
                common_[i] = len(np.intersect1d(a, b, assume_unique=True))
                either[i] = len(a) + len(b) - common_[i]
            keep = 100 * common_ >= percent * either
            ends = [batch.column(i).to_numpy()[keep] for i in range(2)]
            names = ["a", "b"]
            if stars:
                ends = _stars(*ends)
            else:
                ends, names = [*ends, common_[keep], either[keep]], [*names, "n_common", "n_either"]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], names)

    return run


def _with_shingles(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the shingles of both."""
    left = sets.select(F.col("sid").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("sid").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")


def _sets_of(pairs: DataFrame, texts: DataFrame, points: DataFrame, width: int) -> DataFrame:
    """(sid, shingles) of the sets of the pairs, made from their texts."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    found = materialise(
        texts.join(wanted.join(points.select("sid", "doc_id", "several"), "sid"), "doc_id")
        .select("sid", "text", "several")
        .mapInArrow(common.tidy(_shingle_rows(width)), "sid long, shingles binary, several boolean"),
        "shingles",
    )
    # Sets go by their smallest doc_id, so only a doc_id with several rows can give one twice.
    several = found.where("several")
    if several.isEmpty():
        return found.select("sid", "shingles")
    once = materialise(several.dropDuplicates(["sid"]), "shingles-once")
    return found.where("not several").unionByName(once).select("sid", "shingles")


def _slices(pairs: DataFrame, points: DataFrame) -> int:
    """How often the shingles that go with the pairs exceed those of all sets."""
    sent = pairs.join(points.select(F.col("sid").alias("a"), "n"), "a").agg(F.sum("n")).first()[0] or 0
    return max(1, -(-sent // max(1, points.agg(F.sum("n")).first()[0] or 0)))


def _links(
    pairs: DataFrame, texts: DataFrame, points: DataFrame, width: int, percent: int, label: str, stars: bool = True
) -> DataFrame:
    """Links (a, b) with the components of the pairs that reach the threshold, or all of them."""
    spark = pairs.sparkSession
    path = new_shared_path(spark, label)
    schema = "a long, b long" if stars else "a long, b long, n_common long, n_either long"
    # The shingles go when the pairs are verified.
    with table_scope(spark), common.small_batches(spark):
        pairs = materialise(pairs.select("a", "b"), "candidates")
        sets = _sets_of(pairs, texts, points, width)
        common.free_shuffles(spark)
        slices = _slices(pairs, points)
        for part in range(slices):
            some = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(slices)) == part) if slices > 1 else pairs
            both = _with_shingles(some, sets).mapInArrow(common.tidy(_verify(percent, stars)), schema)
            both.write.mode("append").parquet(path)
            common.free_shuffles(spark)
    return spark.read.schema(schema).parquet(path)


def _shingle_rows(width: int):
    """(sid, shingles, several) of the rows (sid, text, several) whose set is the one asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, sets in _sets(batch.column(1), width):
                want = batch.column(0).slice(low, len(sets)).to_numpy()
                good = [i for i, s in enumerate(sets) if len(s) and set_id(s).view(np.int64) == want[i]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(want[i]) for i in good], pa.int64()),
                        pa.array([sets[i].tobytes() for i in good], pa.binary()),
                        batch.column(2).slice(low, len(sets)).take(pa.array(good, pa.int64())),
                    ],
                    ["sid", "shingles", "several"],
                )

    return run


def _forest(most: int):
    """The stars of a task's links, with their tops, and the number of the lot that they are of:
    a task puts up to ``most`` links together, and goes on with their stars while these are few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, held = TaskContext.get().partitionId() << 32, np.zeros((2, 0), np.int64)
        for batch in batches:
            held = np.concatenate([held, [batch.column(i).to_numpy() for i in range(2)]], axis=1)
            if held.shape[1] <= most:
                continue
            held = np.array(_stars(*held, tops=True), np.int64)
            if 2 * held.shape[1] > most:
                yield rows(lot, held)
                lot, held = lot + 1, held[:, :0]
        yield rows(lot, _stars(*held, tops=True))

    def rows(lot, stars):
        columns = [*stars, np.full(len(stars[0]), lot, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["a", "b", "lot"])

    return run


def components(links: DataFrame) -> DataFrame:
    """(sid, component) of every end of a link between two: the smallest sid that links reach.

    First links are contracted to stars, lot by lot, in as many tasks as there are lots, as long
    as that halves the lots. Stars of one lot are the components. Stars of several meet in rounds.
    Each round a node takes the least label of its neighbours, and then its label's label,
    so a chain halves; a round is written before the next reads it.
    """
    links, lots = links.select("a", "b").where("a <> b"), None
    while True:
        stars = materialise(links.mapInArrow(common.tidy(_forest(_HELD)), "a long, b long, lot long"), "stars")
        found = stars.agg(F.min("lot").alias("low"), F.max("lot").alias("high"), F.count("*").alias("n")).first()
        if found.low == found.high:
            return stars.select(F.col("a").alias("sid"), F.col("b").alias("component"))
        links, before, lots = stars.select("a", "b").where("a <> b"), lots, -(-found.n // _HELD)
        if before is not None and 2 * lots > before:
            break
        links = links.coalesce(lots)
    both = links.union(links.select("b", "a")).toDF("a", "b")
    labels = materialise(
        both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).select(F.col("a").alias("sid"), "label"),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("sid").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("sid"))
            .agg(F.min("label").alias("near"))
        )
        stepped = labels.join(near, "sid").select("sid", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("sid").alias("label"), F.col("label").alias("far"))
        new = materialise(
            stepped.join(jump, "label").select("sid", "old", F.least("label", "far").alias("label")), "labels"
        )
        if new.where("old <> label").isEmpty():
            return new.select("sid", F.col("label").alias("component"))
        labels = new.select("sid", "label")


def _indexed(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, ...]:
    """The texts, the rows with their sets, the points, the shared cells, and the hubs."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    described = materialise(
        texts.mapInArrow(
            common.tidy(_describe(width)), "doc_id long, n long, sid long, point binary, wide binary"
        ),
        "sets",
    )
    counted = described.where("doc_id is not null").groupBy("doc_id").agg((F.count("*") > 1).alias("several"))
    points = materialise(
        described.where("sid is not null and doc_id is not null")
        .groupBy("sid")
        .agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("n", "point", "wide")))
        .join(counted, "doc_id"),
        "points",
    )

    found = common.tidy(_cell_rows(width, percent))
    rows = texts.where("doc_id is not null").mapInArrow(found, "cell long, sid long, hub long")
    # Rows that were merged already need not meet their cell: they are spread by set.
    merged = F.coalesce(F.col("hub") != F.col("sid"), F.lit(False))
    shared = materialise(
        rows.repartition(F.when(merged, F.xxhash64("cell", "sid")).otherwise(F.col("cell")))
        .sortWithinPartitions(merged, "cell", "sid")
        .mapInArrow(common.tidy(_shared_cells), "cell long, sid long, hub long"),
        "cells",
    )
    common.free_shuffles(spark)

    # Up to three hubs of a set's cells: what one misses another may link.
    other = F.min_by("hub", F.xxhash64("hub", "sid"))
    picked = F.array_distinct(F.array(F.min("hub"), F.max("hub"), other))
    hubs = materialise(shared.groupBy("sid").agg(F.explode(picked).alias("hub")), "hubs")
    common.free_shuffles(spark)
    return texts, described, points, shared, hubs


def join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    described, points, links = _spanning(docs, width, percent)
    return _named(described, components(links.union(_same_name(points)))).drop("sid")


def _spanning(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their sets, the points, and links (a, b) that span every component."""
    with common.small_batches(docs.sparkSession):
        texts, described, points, shared, hubs = _indexed(docs, width, percent)
    first = (
        hubs.where("hub <> sid")
        .join(points.select("sid", F.col("point").alias("p"), "n"), "sid")
        .join(points.select(F.col("sid").alias("hub"), F.col("point").alias("q"), F.col("n").alias("m")), "hub")
        .select(F.col("sid").alias("a"), F.col("hub").alias("b"), "p", "q", "n", "m")
        .mapInArrow(common.tidy(_near(percent)), "a long, b long")
    )
    links = _links(first, texts, points, width, percent, "hub-links")

    # Only pairs of different leaves are met: the links inside a leaf join nothing new. In a
    # round each leaf tries two of its pairs, and those that link make one leaf; cells without
    # a pair are left. When a round joins few leaves, all pairs that remain are verified.
    members, going = shared, True
    for round_ in count():
        members = _open_leaves(members, components(links))
        if not going:
            break
        picked = _pairs(members, points, percent, round_)
        leaves = picked.select(F.explode(F.array("la", "lb"))).distinct().count()
        if not leaves:
            return described, points, links
        members = members.join(picked.select("cell").distinct(), "cell", "left_semi")
        new = _links(_tried(picked, round_), texts, points, width, percent, "leaf-links")
        links = links.union(new)
        going = _WORTH * new.count() >= leaves
    rest = _pairs(members, points, percent)
    return described, points, links.union(_links(rest, texts, points, width, percent, "rest-links"))


def _tried(picked: DataFrame, round_: int) -> DataFrame:
    """Of the tasks' picks: each leaf's likeliest pair, and its pair with the least leaf."""
    sides = picked.select("a", "b", "least", F.inline(F.array(*(
        F.struct(F.col(leaf).alias("leaf"), F.xxhash64(other, F.lit(round_)).alias("other"))
        for leaf, other in (("la", "lb"), ("lb", "la"))
    ))))
    pair = F.struct("a", "b")
    chosen = sides.groupBy("leaf").agg(
        F.max_by(pair, F.struct("least", "other", "a", "b")).alias("likely"),
        F.min_by(pair, F.struct("other", -F.col("least"), "a", "b")).alias("first"),
    )
    return chosen.select(F.inline(F.array("likely", "first"))).distinct()


def _same_name(points: DataFrame) -> DataFrame:
    """Sets that go by one doc_id, as links (a, b) to the least of them."""
    least = points.groupBy("doc_id").agg(F.min("sid").alias("a"), F.max("sid").alias("high")).where("a <> high")
    return points.join(least, "doc_id").where("sid <> a").select("a", F.col("sid").alias("b"))


def similarity_join(docs: DataFrame, width: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(members, links): the columns of ``join`` with set_id and n_links, and all links.

    A link is a pair of different sets that reach the threshold: left_set, right_set, the
    smallest doc_id of each (left_id, right_id), and the shingles in both (n_common) and in
    either (n_either). n_links of a row counts the links of its set. Rows of equal sets are
    found by set_id.
    """
    with common.small_batches(docs.sparkSession):
        texts, described, points, shared, _ = _indexed(docs, width, percent)
    sizes = shared.groupBy("cell").agg(_packers().alias("packers"))
    members = shared.select("cell", F.col("sid").alias("leaf"), "sid").distinct().join(sizes, "cell")
    pairs = _pairs(members, points, percent).select("a", "b")
    links = _links(pairs, texts, points, width, percent, "links", stars=False)
    ends = links.select(F.explode(F.array("a", "b")).alias("sid")).groupBy("sid").agg(F.count("*").alias("n_links"))
    rows = _named(described, components(links.select("a", "b").union(_same_name(points)))).join(ends, "sid", "left")
    least = points.select("sid", "doc_id")
    named = links.join(least.toDF("a", "left_id"), "a").join(least.toDF("b", "right_id"), "b")
    return (
        rows.select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("sid").alias("set_id"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
        ),
        named.select(
            "left_id", "right_id", F.col("a").alias("left_set"), F.col("b").alias("right_set"), "n_common", "n_either"
        ),
    )


def _named(described: DataFrame, found: DataFrame) -> DataFrame:
    """sid, doc_id, n_shingles and component_id of every row."""
    named = described.join(found, "sid", "left").withColumn("group", F.coalesce("component", "sid"))
    least = named.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    return named.join(least, "group", "left").select(
        "sid",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
    )


def _packers() -> Column:
    """How many tasks pack the points of a cell: one for each full page, up to ``_PACKERS``."""
    return F.least(F.ceil(F.count("*") / PAGE), F.lit(_PACKERS))


def _open_leaves(shared: DataFrame, leaves: DataFrame) -> DataFrame:
    """(cell, leaf, sid) of cells that hold several leaves, with the tasks that pack them."""
    members = shared.select("cell", "sid").join(leaves, "sid", "left")
    members = members.select("cell", "sid", F.coalesce("component", "sid").alias("leaf"))
    several = (
        members.groupBy("cell")
        .agg(F.min("leaf").alias("low"), F.max("leaf").alias("high"), _packers().alias("packers"))
        .where("low <> high")
        .select("cell", "packers")
    )
    return materialise(members.join(several, "cell").distinct(), "open-cells")


def _pairs(members: DataFrame, points: DataFrame, percent: int, round_: int | None = None) -> DataFrame:
    """Pairs of sets of different leaves that the boxes of nodes and the wide points allow; in
    a round, those that the tasks pick by their points."""
    spark = members.sparkSession
    path = new_shared_path(spark, "near-pairs")
    # A set has as many cells as its band has blocks.
    listed = F.concat(F.sort_array(F.collect_list("cell")), F.array_repeat(F.lit(_NO_CELL), FIRST_CELLS))
    firsts = members.groupBy("sid").agg(F.slice(listed, 1, FIRST_CELLS).alias("firsts"))
    # The pages are the largest table; they go when their pairs are written.
    with table_scope(spark), common.small_batches(spark):
        pages = materialise(
            members.join(points.select("sid", "n", "point").join(firsts, "sid"), "sid")
            .select("cell", "leaf", "sid", "n", "point", "firsts", "packers")
            .repartition("cell", F.pmod("leaf", "packers"))
            .sortWithinPartitions("cell", "leaf", "sid")
            .drop("packers")
            .mapInArrow(common.tidy(_pages), _PAGE),
            "pages",
        )
        common.free_shuffles(spark)
        x, y = pages.alias("x"), pages.alias("y")
        one_leaf = (F.col("x.low") == F.col("y.high")) & (F.col("x.high") == F.col("y.low"))
        near = (100 * F.col("x.most") >= percent * F.col("y.least")) & (100 * F.col("y.most") >= percent * F.col("x.least"))
        met = x.join(
            y, (F.col("x.cell") == F.col("y.cell")) & (F.col("x.page") <= F.col("y.page")) & near & ~one_leaf
        )
        packed = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "xy" for c in _PACKED]
        opened = met.select((F.col("x.page") == F.col("y.page")).alias("same"), F.col("x.cell").alias("cell"), *packed)
        if round_ is None:
            found = materialise(opened.mapInArrow(common.tidy(_opened(percent)), _PAIR).distinct(), "allowed-pairs")
            wide = points.select("sid", F.coalesce("wide", "point"), "n")
            found = found.join(wide.toDF("a", "p", "n"), "a").join(wide.toDF("b", "q", "m"), "b")
            found.select("a", "b", "la", "lb", "least", "p", "q", "n", "m").mapInArrow(
                common.tidy(_near_by_wide(percent)), _PAIR
            ).write.parquet(path)
        else:
            opened.mapInArrow(common.tidy(_opened(percent, round_)), _PICK).write.parquet(path)
    common.free_shuffles(spark)
    return spark.read.schema(_PAIR if round_ is None else _PICK).parquet(path)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.table(spark, sf_dir, "documents"), width=4, percent=85)


def _row_sets(width: int):
    """Rows (row, key, sid) of rows (row, key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, sets in _sets(batch.column(2), width):
                ids = pa.array([int(set_id(s).view(np.int64)) if len(s) else None for s in sets], pa.int64())
                rows = batch.slice(low, len(sets))
                yield pa.RecordBatch.from_arrays([*rows.columns[:2], ids], ["row", "key", "sid"])

    return run


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of texts that links connect.

    The row with the smallest doc_id stays, of several the one with the smallest set id, then
    text, then the other columns as JSON. A doc_id with texts of several groups can keep a row
    for each. Rows without a doc_id link with nothing and stay; so does a row for each doc_id
    with an empty text. The tables written on the way are deleted before the rows are read.
    """
    spark = docs.sparkSession
    # Outside the scope: what the rows are chosen by, a few numbers per kept document.
    paths = [new_shared_path(spark, label) for label in ("kept", "several")]
    with table_scope(spark):
        described, _, links = _spanning(docs, width, percent)
        rows = described.where("doc_id is not null").select("doc_id", "sid")
        group = F.coalesce("component", "sid")
        first = F.min(F.struct("doc_id", "sid")).alias("first")
        led = rows.where("sid is not null").join(components(links), "sid", "left").groupBy(group).agg(first)
        found = led.select("first.*").union(rows.where("sid is null").distinct())
        repeated = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
        for table, path in zip((found, repeated), paths, strict=True):
            table.write.parquet(path)
    common.free_shuffles(spark)
    kept = spark.read.schema("doc_id long, sid long").parquet(paths[0])
    several = spark.read.schema("doc_id long").parquet(paths[1])

    # A doc_id with one row needs its number alone; only rows of the others are compared.
    alone = kept.join(several, "doc_id", "left_anti")
    plain = docs.join(alone, docs["doc_id"] == alone["doc_id"], "left_semi")
    row = F.struct(*[docs[c] for c in docs.columns])
    packed = docs.join(several, docs["doc_id"] == several["doc_id"], "left_semi").select(
        row.alias("row"), docs["doc_id"].cast("long").alias("key"), docs["text"].cast("string").alias("text")
    )
    kind = packed.schema["row"].dataType
    schema = StructType([StructField("row", kind), StructField("key", LongType()), StructField("sid", LongType())])
    sets = packed.mapInArrow(common.tidy(_row_sets(width)), schema)
    of_kept = (sets["key"] == kept["doc_id"]) & sets["sid"].eqNullSafe(kept["sid"])
    order = F.struct(F.col("row")["text"], F.to_json("row"))
    odd = sets.join(kept, of_kept, "left_semi").groupBy("key", "sid").agg(F.min_by("row", order).alias("row"))
    chosen = odd.select(*[F.col("row")[c].alias(c) for c in docs.columns])
    return docs.where(docs["doc_id"].isNull()).unionByName(plain).unionByName(chosen)


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS g
  FROM w),
sets AS (SELECT min(doc_id) AS rep, g, len(g) AS n FROM s WHERE len(g) > 0 GROUP BY g),
x AS (SELECT rep, n, md5(unnest(g)) AS g FROM sets),
p AS (
  SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p UNION SELECT rep, rep FROM sets),
r(node, low) AS (
  SELECT a, b FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.low = e.a),
c AS (SELECT node, min(low) AS component FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(c.component, s.doc_id) AS component_id
FROM s LEFT JOIN sets ON s.g = sets.g LEFT JOIN c ON c.node = sets.rep
"""

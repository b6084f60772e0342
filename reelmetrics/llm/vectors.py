"""Near-duplicate vectors: tiles compared in order of principal components, stopped where the cosine cannot be reached."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import released, saved
from .components import components

#: Least vectors of a block; blocks grow beyond, up to so many bytes, before there are more than MANY of them.
BLOCK, BLOCK_BYTES, MANY = 4096, 1 << 23, 16
#: Vectors of a tile on either side, and how many leading dimensions the first steps take.
TILE, STEPS = (512, 2048), (24, 48)
#: Slack of the single-precision bounds; what passes them is decided in double precision.
SLACK = 1e-4
#: Tasks that send moments; partitions that blocks are read in for their pairs, and most blocks of one beyond that.
MOMENT_TASKS, SIDES, SIDE_BLOCKS = 32, 32, 8


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Double-precision unit vectors."""
    rows = rows.astype(float)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def unpacked(rows: bytes, kind: str, width: int) -> np.ndarray:
    """Double-precision unit vectors of a block."""
    return unit_rows(np.frombuffer(rows, kind).reshape(-1, width))


def principal_axes(blocks: DataFrame, kind: str, width: int) -> np.ndarray:
    """Axes by falling variance, from the second moments of all unit vectors (width x width numbers a task)."""

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for frame in frames:
            for packed in frame["rows"]:
                rows = unpacked(packed, kind, width)
                total += rows.T @ rows
        yield pd.DataFrame({"at": np.arange(width * width), "m": total.ravel()})

    tasks = blocks.select("rows").coalesce(MOMENT_TASKS).mapInPandas(moments, "at int, m double")
    sums = tasks.groupBy("at").agg(F.sum("m").alias("m")).collect()
    matrix = np.zeros(width * width)
    for row in sums:
        matrix[row["at"]] = row["m"]
    _, axes = np.linalg.eigh(matrix.reshape(width, width))
    return axes[:, ::-1]


def heads(rows: np.ndarray, to: int) -> np.ndarray:
    """The leading dimensions and the norm of the rest: products of two heads bound those of their rows."""
    return np.concatenate([rows[:, :to], np.sqrt((rows[:, to:] ** 2).sum(1, keepdims=True))], axis=1)


def positions(flags: np.ndarray) -> np.ndarray:
    """Where flat flags are set, eight at once: mostly none is."""
    whole = len(flags) // 8 * 8
    words = np.flatnonzero(flags[:whole].view(np.uint64))
    at, bit = np.nonzero(flags[:whole].reshape(-1, 8)[words])
    return np.concatenate([words[at] * 8 + bit, whole + np.flatnonzero(flags[whole:])])


def steps(width: int) -> list[int]:
    return [*(step for step in STEPS if step < width), width]


def near_pairs(
    left: np.ndarray, right: np.ndarray, exact_left: np.ndarray, exact_right: np.ndarray, threshold: float,
    first: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs with cosine >= threshold. left, right: single-precision rotated unit vectors.

    The product over the leading dimensions is bounded by the norms of the rest; pairs that cannot reach the
    threshold stop, the others take the next dimensions; survivors are decided in double precision. first: both
    sides' heads of the first step, if they are known.
    """
    width = left.shape[1]
    at, dense = 0, True
    for to in steps(width):
        if dense:
            a, b = first if first and not at else (heads(left, to), heads(right, to))
            bound = (a @ b.T).ravel()
            open_ = bound >= threshold - SLACK
            dense = to < width and np.count_nonzero(open_) > open_.size // 20
            if not dense:
                flat = positions(open_)
                i, j = np.divmod(flat, len(right))
                total = bound[flat] - a[i, to] * b[j, to]
        else:
            total = total + np.einsum("ij,ij->i", left[i, at:to], right[j, at:to])
            a, b = left[i, to:], right[j, to:]
            open_ = total + np.sqrt((a * a).sum(1) * (b * b).sum(1)) >= threshold - SLACK
            i, j, total = i[open_], j[open_], total[open_]
        at = to
    keep = np.zeros(len(i), bool)
    for a in range(0, len(i), 1 << 16):
        b = slice(a, a + (1 << 16))
        keep[b] = np.einsum("ij,ij->i", exact_left[i[b]], exact_right[j[b]]) >= threshold
    return i[keep], j[keep]


def forest(part: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of links (a, b) that unite parts, one fewer than parts that they unite.

    part: the part of every node, named by one of its nodes; brought up to date. In each round every part takes one
    link to another part, so the rounds are few, however many links there are.
    """
    kept: list[int] = []
    rest = np.flatnonzero(part[a] != part[b])
    while len(rest):
        taken = np.full(len(part), -1)
        taken[part[a[rest]]] = rest
        taken[part[b[rest]]] = rest
        taken = np.unique(taken[taken >= 0])
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x

        for at, x, y in zip(taken.tolist(), part[a[taken]].tolist(), part[b[taken]].tolist()):
            p, q = root(x), root(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
                kept.append(at)
        now = np.arange(len(part))
        for x in list(parent):
            now[x] = root(x)
        part[:] = now[part]
        rest = rest[part[a[rest]] != part[b[rest]]]
    return np.array(kept, int)


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding).

    Null, empty or zero vectors, and those with null or non-finite components, link with nothing; so do vectors of
    different lengths. Equal vectors are one node with a count, so copies cost nothing. Nodes are packed into blocks of
    `block` or more; a task compares pairs of blocks and returns link counts and a spanning forest, never its pairs. Blocks are stored once and read by the tasks of their pairs, so disk grows with the vectors, only
    the work with their square. Rows without an id take part in no component but count as links.
    """
    single = isinstance(vectors.select("embedding").schema[0].dataType.elementType, FloatType)
    doubles = F.col("embedding").cast("array<double>")
    norm = F.aggregate(doubles, F.lit(0.0), lambda s, x: s + x * x)
    usable = F.coalesce((norm > 0) & (norm < float("inf")), F.lit(False))
    name = F.struct(*(F.xxhash64(F.lit(k), "embedding" if single else doubles).alias(f"h{k}") for k in range(2)))
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable, name).alias("name"))

    def linked() -> tuple[DataFrame, ...]:
        rows = vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("embedding") if single else doubles).alias("v"))
        nodes = rows.groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
        nodes = nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("width", F.size("v"))
        nodes = saved(nodes)
        found = [
            links_of_width(nodes.where(F.col("width") == row["width"]), "<f4" if single else "<f8", row["width"], row["n"], threshold, block)
            for row in nodes.groupBy("width").agg(F.count("*").alias("n")).collect()
        ]
        if not found:
            return ()
        names = F.struct(*(F.xxhash64(F.lit(k), "v").alias(f"h{k}") for k in range(2)))
        return nodes.select(names.alias("name"), "node", "copies", "first"), reduce(DataFrame.unionByName, found)

    found = released(linked)
    if not found:
        return source.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    nodes, links = found
    forests = links.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    (groups,) = released(lambda: (components(forests),))
    least = nodes.join(groups, "node").groupBy("component").agg(F.min("first").alias("least"))
    groups = groups.join(least, "component").join(links.where("other is null").select("node", "n"), "node")
    placed = nodes.join(saved(groups.select("node", "least", "n")), "node", "left")
    known = placed.select("name", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id"))
    out = source.join(known, "name", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


def packed_blocks(nodes: DataFrame, kind: str, width: int, count: int, size: int) -> DataFrame:
    """(block, nodes, copies, rows): vectors in the order they are read in, as one packed row and one file a block."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def whole(least: int) -> Iterator[pa.RecordBatch]:
            nodes, copies, rows = map(np.concatenate, zip(*held))
            at = 0
            while len(nodes) - at >= least:
                own = slice(at, at := min(at + size, len(nodes)))
                yield pa.RecordBatch.from_pydict({"nodes": [nodes[own].tobytes()], "copies": [copies[own].tobytes()], "rows": [rows[own].tobytes()]})
            held[:] = [(nodes[at:], copies[at:], rows[at:])] if at < len(nodes) else []

        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)
            held.append((batch.column("node").to_numpy().astype("<i8"), batch.column("copies").to_numpy().astype("<i8"), values))
            if sum(len(nodes) for nodes, _, _ in held) >= size:
                yield from whole(size)
        if held:
            yield from whole(1)

    tasks = nodes.select("node", "copies", "v").coalesce(-(-count // size))
    blocks = tasks.mapInArrow(packed, "nodes binary, copies binary, rows binary")
    return saved(blocks.withColumn("block", F.monotonically_increasing_id()), maxRecordsPerFile=1)


def links_of_width(nodes: DataFrame, kind: str, width: int, count: int, threshold: float, block: int) -> DataFrame:
    """(node, null, n): links to n further rows; (node, other, null): links of spanning forests.

    The tasks of the pairs read the stored blocks of either side: no exchange, whatever the number of pairs. Of the two
    tasks that read two blocks each has the pair or not by the blocks' parities, so all have about as many pairs.
    """
    size = max(block, min(-(-count // MANY), BLOCK_BYTES // (width * np.dtype(kind).itemsize)))
    blocks = packed_blocks(nodes, kind, width, count, size)
    axes = principal_axes(blocks, kind, width)
    read = blocks.coalesce(max(SIDES, count // size // SIDE_BLOCKS))
    x, y = (read.select(*(F.col(c).alias(f"{s}_{c}") for c in ("block", "nodes", "copies", "rows"))) for s in "xy")
    same = F.col("x_block") == F.col("y_block")
    here = (F.col("x_block") < F.col("y_block")) == ((F.col("x_block") + F.col("y_block")) % 2 == 0)
    other = (F.when(~same, F.col(f"y_{c}")).alias(f"y_{c}") for c in ("nodes", "copies", "rows"))
    work = x.join(y, same | here).select("x_block", "x_nodes", "x_copies", "x_rows", "y_block", *other)

    def turned(rows: bytes) -> tuple[np.ndarray, ...]:
        exact = unpacked(rows, kind, width)
        rotated = (exact @ axes).astype(np.float32)
        return exact, rotated, heads(rotated, steps(width)[0])

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        links = Links()
        for frame in frames:
            for row in frame.itertuples(index=False):
                left, x = turned(row.x_rows), links.place(row.x_block, row.x_nodes, row.x_copies)
                if row.y_rows is None:
                    right, y = left, x
                else:
                    right, y = turned(row.y_rows), links.place(row.y_block, row.y_nodes, row.y_copies)
                for i, j in pairs_of_blocks(left, right, threshold):
                    links.add(i + x, j + y)
        yield from links.frames()

    return work.mapInPandas(compare, "node long, other long, n long").groupBy("node", "other").agg(F.sum("n").alias("n"))


def pairs_of_blocks(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of two blocks (unit rows, rotated rows, heads), or of one with itself, tile by tile."""
    same = left is right
    for a in range(0, len(left[0]), TILE[0]):
        for b in range(a // TILE[1] * TILE[1] if same else 0, len(right[0]), TILE[1]):
            x, y = slice(a, a + TILE[0]), slice(b, b + TILE[1])
            i, j = near_pairs(left[1][x], right[1][y], left[0][x], right[0][y], threshold, (left[2][x], right[2][y]))
            i, j = i + a, j + b
            if same:
                upper = i < j
                i, j = i[upper], j[upper]
            if len(i):
                yield i, j


class Links:
    """Link counts and a spanning forest of all pairs of a task: at most two rows a vector that it reads."""

    def __init__(self) -> None:
        self.starts: dict[int, int] = {}
        self.nodes, self.copies, self.part = np.zeros((3, 0), np.int64)
        self.sums = np.zeros(0)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0
        self.kept: list[tuple[np.ndarray, np.ndarray]] = []

    def place(self, block: int, nodes: bytes, copies: bytes) -> int:
        """Number of the block's first vector in this task."""
        if block not in self.starts:
            start = self.starts[block] = len(self.nodes)
            self.nodes = np.concatenate([self.nodes, np.frombuffer(nodes, "<i8")])
            self.copies = np.concatenate([self.copies, np.frombuffer(copies, "<i8")])
            self.part = np.concatenate([self.part, np.arange(start, len(self.nodes))])
            self.sums = np.concatenate([self.sums, np.zeros(len(self.nodes) - start)])
        return self.starts[block]

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        self.held.append((i, j))
        self.waiting += len(i)
        if self.waiting > 1 << 18:
            self.fold()

    def fold(self) -> None:
        i, j = map(np.concatenate, zip(*self.held))
        self.sums += np.bincount(i, self.copies[j], len(self.sums)) + np.bincount(j, self.copies[i], len(self.sums))
        at = forest(self.part, i, j)
        self.kept.append((i[at], j[at]))
        self.held.clear()
        self.waiting = 0

    def frames(self) -> Iterator[pd.DataFrame]:
        """(node, null, n): links to n further rows; (node, other, null): links of the forest."""
        if self.held:
            self.fold()
        if not self.kept:
            return
        hit = np.flatnonzero(self.sums)
        i, j = map(np.concatenate, zip(*self.kept))
        yield pd.DataFrame({"node": self.nodes[hit], "other": None, "n": self.sums[hit].astype(np.int64)}).astype("Int64")
        yield pd.DataFrame({"node": self.nodes[i], "other": self.nodes[j], "n": None}).astype("Int64")

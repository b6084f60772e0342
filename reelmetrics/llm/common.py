"""Helpers of the training-data operators: tables, shared scratch tables, word hashes, bounded sketches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import Folder

#: Work tables (folder, frame) saved since the innermost `released` began; None outside of any.
TABLES: ContextVar[list[tuple[str, DataFrame]] | None] = ContextVar("work_tables", default=None)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share: below spark.checkpoint.dir, or the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def saved(df: DataFrame, **options) -> DataFrame:
    """The frame written to a shared table, with a writer's options, and read again: work done once, no lineage to lose."""
    path = scratch(df.sparkSession)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if (tables := TABLES.get()) is not None:
        tables.append((path, out))
    return out


def released(make: Callable[..., tuple[DataFrame, ...]], *args) -> tuple[DataFrame, ...]:
    """The frames that make(*args) returns, saved; every other work table saved meanwhile is deleted.

    So disk holds what later steps read, not all that a run has written. Frames of make that it does not return must
    not be used afterwards.
    """
    own: list[tuple[str, DataFrame]] = []
    kept: list[tuple[str, DataFrame]] = []
    try:
        token = TABLES.set(own)
        try:
            frames = make(*args)
        finally:
            TABLES.reset(token)
        out = tuple(frame if any(frame is table for _, table in own) else saved(frame) for frame in frames)
        kept = [(path, table) for path, table in own if any(table is frame for frame in out)]
        if (outer := TABLES.get()) is not None:
            outer.extend(kept)
        return out
    finally:
        for path, table in own:
            if not any(path == other for other, _ in kept):
                root, _, name = path.rpartition("/")
                Folder(table.sparkSession, root).delete(name)


def mapped(df: DataFrame, schema: str, rows: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """mapInPandas of a function of one batch."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield rows(frame)

    return df.mapInPandas(batches, schema)


def texts_with_id(docs: DataFrame) -> DataFrame:
    """doc_id as text, and text: pandas would round a batch's long ids if one of them is null."""
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def text_name():
    """64-bit name of a row's text. Rows are told apart by doc_id and this; rows with both equal count as one."""
    return F.xxhash64("text")


def named_texts(docs: DataFrame) -> DataFrame:
    """doc_id as text, name and text; see texts_with_id and text_name."""
    return texts_with_id(docs).withColumn("name", text_name())


def with_long_id(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))


class Powers:
    """Powers of an odd hash base and of its inverse modulo 2**64, as far as needed."""

    base = 0x9E3779B97F4A7C15
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            size = max(n + 1, 1 << 16)
            for name, base in (("up", cls.base), ("down", pow(cls.base, -1, 1 << 64))):
                values = np.full(size, base, np.uint64)
                values[0] = 1
                setattr(cls, name, np.cumprod(values))
        return cls.up, cls.down


class Runs:
    """Hashes of the runs [start, end) of a sequence of 64-bit values, equal wherever equal runs stand."""

    def __init__(self, values: np.ndarray) -> None:
        up, self.down = Powers.to(len(values))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A 64-bit value for every byte, and which bytes are ASCII white space.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
SPACES = np.isin(np.arange(256), [32, *range(9, 14)])


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, A-Z lower-cased; none of a null text."""
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    edge = np.diff(SPACES[data].view(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return mix(Runs(BYTES[data]).hashes(starts, ends) ^ (ends - starts).astype(np.uint64))


def windows(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` ids; a shorter sequence is one run, an empty one has none."""
    width = min(width, len(ids))
    if not width:
        return ids[:0]
    total = np.full(len(ids) - width + 1, width, np.uint64)
    for i in range(width):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(ids) - width + 1 + i])
    return total


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles."""
    return np.unique(windows(word_hashes(text), width))


#: Cells of a count sketch (one byte each once counted) and bits of a membership map, whatever the input's size.
SKETCH_CELLS, SKETCH_PARTS, MAP_BITS = 1 << 22, 1024, 1 << 25


def count_sketch(df: DataFrame, hashes: Callable[[pd.DataFrame], Iterator[np.ndarray]]) -> np.ndarray:
    """Classes of the counts of hashes over all rows, by hash % SKETCH_CELLS: the count, from 64 on quarter powers of two.

    Tasks add up fixed arrays and send the non-empty cells in SKETCH_PARTS slices; each slice is added
    up as a stream. What comes to the driver is one byte a cell: 4 MB at every input size.
    """
    size = SKETCH_CELLS // SKETCH_PARTS

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(SKETCH_CELLS, np.int64)
        held: list[np.ndarray] = []

        def add() -> None:
            at, n = np.unique(np.concatenate(held) & np.uint64(SKETCH_CELLS - 1), return_counts=True)
            cells[at.astype(np.int64)] += n
            held.clear()

        for frame in frames:
            for found in hashes(frame):
                held.append(found)
                if sum(map(len, held)) > 1 << 18 or len(held) > 256:
                    add()
        if held:
            add()
        for part in range(SKETCH_PARTS):
            own = cells[part * size : (part + 1) * size]
            at = np.flatnonzero(own)
            if len(at):
                yield pd.DataFrame({"part": [part], "at": [at.astype("<u2").tobytes()], "n": [own[at].astype("<u4").tobytes()]})

    def total(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for part, at, n in zip(frame["part"], frame["at"], frame["n"]):
                own = sums.setdefault(part, np.zeros(size, np.int64))
                own[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<u4")
        for part, own in sums.items():
            classes = np.where(own < 64, own, 40 + np.floor(4 * np.log2(np.maximum(own, 1))))
            yield pd.DataFrame({"part": [part], "classes": [classes.astype(np.uint8).tobytes()]})

    found = df.mapInPandas(partial, "part int, at binary, n binary").repartition("part").mapInPandas(total, "part int, classes binary")
    classes = np.zeros(SKETCH_CELLS, np.uint8)
    for row in found.collect():
        classes[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(row["classes"], np.uint8)
    return classes


def membership_map(df: DataFrame, column: str) -> np.ndarray:
    """Bit map of a long column's hashes, packed: 4 MB at every size; a clear bit proves absence."""
    bit = F.pmod(F.col(column), F.lit(MAP_BITS))
    words = df.where(F.col(column).isNotNull()).select((bit / 64).cast("int").alias("word"), (bit % 64).cast("int").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    packed = found.groupBy((F.col("word") % 64).alias("part")).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    bits = np.zeros(MAP_BITS // 64, np.int64)
    for row in packed.toLocalIterator():
        for word, value in row["words"]:
            bits[word] = value
    return bits.astype("<i8").view(np.uint8)


def may_meet(bits: np.ndarray):
    """Column function of a long name: false where the bit map proves that it is not among the mapped ones."""

    @F.pandas_udf("boolean")
    def there(names: pd.Series) -> pd.Series:
        return pd.Series(in_map(names.to_numpy(np.int64).view(np.uint64), bits))

    return there


def in_map(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = (hashes & np.uint64(MAP_BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


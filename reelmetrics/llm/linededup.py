"""Line dedup: equal lines by hash, near-equal lines by a segment-partition edit join."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Powers, Runs, in_map, may_meet, membership_map, mix, named_texts, released, saved, text_name, windows, with_long_id
from .components import linked_groups

#: Edits that near-equal lines may differ by, and the length from which lines are compared at all but for equality.
EDITS, LEAST_CHARS = 2, 20
#: White space as str.isspace knows it: lines of it alone are never compared or removed.
BLANK = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
#: Characters whose hashes a task holds at once.
CHUNK = 1 << 18
#: What a task returns of the lines that may have near-equal ones.
BODIES = pa.schema([("node", pa.int64()), ("body", pa.string()), ("keys", pa.list_(pa.int64())), ("p", pa.list_(pa.int64()))])


def char_hashes(points: np.ndarray) -> np.ndarray:
    return mix((points.astype(np.uint64) + np.uint64(1)) * np.uint64(Powers.base))


#: Hashes of the characters that most texts are made of; others are hashed where they stand.
CHARS = char_hashes(np.arange(1 << 14))


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(shorter, segment, shift): where a line looks for segments of lines `shorter` than itself by 0 to `edits`.

    Of edits + 1 segments one is untouched in a near-equal line, and of those that are, one lies within these
    shifts, counted from the left and from the right. A line's own segments are those at (0, segment, 0).
    """
    found = []
    for shorter in range(edits + 1):
        for segment in range(edits + 1):
            low = max(-segment, shorter - (edits - segment))
            high = min(segment, shorter + (edits - segment))
            found += [(shorter, segment, shift) for shift in range(low, high + 1)]
    return found


def segment_keys(lines: list[str], edits: int) -> np.ndarray:
    """A row of keys for each line: hashes of the substrings at its probes, with length and segment number.

    Lines that share no key differ by more than `edits`. A probe outside the line repeats the line's first key.
    """
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    values = CHARS.take(points, mode="clip")
    rare = np.flatnonzero(points >= len(CHARS))
    values[rare] = char_hashes(points[rare])
    runs = Runs(values)
    length = np.array([len(line) for line in lines], np.int64)
    start = np.cumsum(length) - length
    columns = []
    for shorter, segment, shift in probes(edits):
        of = length - shorter
        width = of // (edits + 1)
        longer = of % (edits + 1)  # the last segments are one longer
        at = segment * width + np.maximum(0, segment - (edits + 1 - longer)) + shift
        width = width + (segment >= edits + 1 - longer)
        inside = (at >= 0) & (at + width <= length) & (width > 0)
        a = np.where(inside, start + at, 0)
        b = np.where(inside, a + width, 0)
        key = mix(runs.hashes(a, b) ^ mix(of.astype(np.uint64) * np.uint64(64) + np.uint64(segment)))
        columns.append(np.where(inside, key, columns[0]) if columns else key)
    return np.column_stack(columns).view(np.int64)


#: Lengths of the character runs whose parities bound the edits between two lines.
RUNS = (1, 2, 3)


def parities(lines: list[str]) -> list[list[int]]:
    """Of each line for each run length a long whose bit i tells whether an odd number of the line's runs falls on i.

    An edit takes away and adds at most as many runs as a run is long, so near lines differ in few bits. A line shorter
    than a run is one run.
    """
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    length = np.array([len(line) for line in lines], np.int64)
    ends = np.cumsum(length)
    owner = np.repeat(np.arange(len(lines)), length)
    found = []
    for width in RUNS:
        runs = windows(points, width)
        whole = np.arange(len(runs)) + width <= ends[owner[: len(runs)]]
        at, runs = owner[: len(runs)][whole], runs[whole]
        short = [(i, windows(points[ends[i] - length[i] : ends[i]], width)) for i in np.flatnonzero(length < width)]
        at, runs = np.concatenate([at, *([i] * len(own) for i, own in short)]).astype(np.int64), np.concatenate([runs, *(own for _, own in short)])
        bit = (runs >> np.uint64(40)).astype(np.int64) & 63
        odd = np.bincount(at * 64 + bit, minlength=64 * len(lines)).reshape(-1, 64) & 1
        found.append(np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view("<i8")[:, 0])
    return np.column_stack(found).tolist()


def may_be_near(edits: int):
    """SQL condition on n (characters) and p0, p1, ... (parities) of two lines."""

    def condition(x: str, y: str) -> str:
        bits = " and ".join(f"bit_count({x}.p{i} ^ {y}.p{i}) <= {2 * width * edits}" for i, width in enumerate(RUNS))
        return f"abs({x}.n - {y}.n) <= {edits} and {bits}"

    return condition


def line_names(lines: list[str]) -> np.ndarray:
    """64-bit names of lines, signed."""
    return np.array([xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) for line in lines], np.uint64).view(np.int64)


def within(a: str, b: str, edits: int) -> bool:
    """Whether two strings differ by at most `edits` insertions, deletions and replacements.

    Common ends are cut off; then one machine word holds the vertical differences of the diagonal band of
    2 * edits + 1 cells, moved down a row for each character, and stops once the distance is out of reach.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > edits:
        return False
    low, high = 0, len(b)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    a, b = a[low:], b[low:]
    low, high = 0, len(b)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[-middle:] == b[-middle:] else (low, middle - 1)
    a, b = a[: len(a) - low], b[: len(b) - low]
    if not b:
        return len(a) <= edits
    return banded(a, b, edits)


def banded(a: str, b: str, edits: int) -> bool:
    """Banded bit-parallel edit distance of a (rows) and b (columns), len(a) >= len(b)."""
    places: dict[str, int] = {}
    for i, char in enumerate(a):
        places[char] = places.get(char, 0) | 1 << i
    # Bit k of the band stands for row j - edits + k of column j; rows above the first match nothing.
    band = 2 * edits + 1
    full = (1 << band) - 1
    up, down = full & ~((1 << edits) - 1), 0
    diagonal = 1 << edits
    distance, slack = 0, edits - (len(a) - len(b))
    for j, char in enumerate(b):
        shift = j - edits
        own = places.get(char, 0)
        match = (own >> shift if shift >= 0 else own << -shift) & full
        # d0: the diagonal step costs nothing.
        d0 = ((((match & up) + up) ^ up) | match | down) & full
        horizontal_up = (down | ~(d0 | up)) & full
        horizontal_down = d0 & up
        distance += not d0 & diagonal
        if distance > edits + slack + (len(a) - len(b)):
            return False
        moved = d0 >> 1
        up = (horizontal_down | ~(moved | horizontal_up)) & full
        down = moved & horizontal_up
    # The last column's rows below the diagonal: add the vertical differences down to the last row.
    for k in range(len(a) - len(b)):
        bit = 1 << (edits + k)
        distance += bool(up & bit) - bool(down & bit)
    return distance <= edits


def chunks(texts: Iterable[str | None]):
    """(document numbers, line numbers, lines) of a batch's non-blank lines, about CHUNK characters at a time."""
    at, number, lines, size = [], [], [], 0
    for i, text in enumerate(texts):
        for k, line in enumerate(text.split("\n") if text else ()):
            if line and not line.isspace():
                at.append(i)
                number.append(k)
                lines.append(line)
                size += len(line)
                if size >= CHUNK:
                    yield at, number, lines
                    at, number, lines, size = [], [], [], 0
    if lines:
        yield at, number, lines


def kept_first(docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, name, dropped (line numbers): the lines that repeat an earlier one, for documents that have any.

    Equal lines form a group, and so do lines of at least `least_chars` characters linked by at most `edits`
    edits, directly or over others. The line first by (doc_id, line number) stays. Blank lines are never touched.
    Ids that are null come last. Rows with one id, or none, and different texts are different documents, told apart by
    the name of the text, which also breaks ties; equal rows count as one, so each keeps the lines that come first.
    """
    source = with_long_id(named_texts(docs)).where("text is not null")
    columns = [f"key{i}" for i in range(len(probes(edits)))]
    schema = pa.schema([("doc_id", pa.int64()), ("name", pa.int64()), ("line", pa.int32()), ("node", pa.int64()), *[(c, pa.int64()) for c in columns]])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, number, lines in chunks(batch["text"].to_pylist()):
                short = np.array([len(line) < least_chars for line in lines])
                keys = np.zeros((len(lines), len(columns)), np.int64)
                if not short.all():
                    keys[~short] = segment_keys([line for line in lines if len(line) >= least_chars], edits)
                own = [batch["doc_id"].take(pa.array(at)), batch["name"].take(pa.array(at)), pa.array(number, pa.int32()), pa.array(line_names(lines))]
                own += [pa.array(keys[:, i], mask=short) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays(own, schema=schema)

    # The keys stand in columns of their own: Parquet writes and reads those for much less than an array of them.
    longs = ", ".join(f"{c} long" for c in columns)
    lines = saved(source.mapInArrow(named, f"doc_id long, name long, line int, node long, {longs}"))
    entries = lines.where(F.col(columns[0]).isNotNull()).select(F.explode(F.array(*columns)).alias("key"), "node")
    shared = entries.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = saved(shared.where("low <> high").select("key"))
    bits = membership_map(shared, "key")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, own in chain.from_iterable(chunks(batch["text"].to_pylist()) for batch in batches):
            own = list({line for line in own if len(line) >= least_chars})
            if not own:
                continue
            keys = segment_keys(own, edits)
            hit = in_map(keys.view(np.uint64), bits)
            some = np.flatnonzero(hit.any(1)).tolist()
            if some:
                bodies = [own[i] for i in some]
                found = [line_names(bodies), bodies, [np.unique(keys[i][hit[i]]) for i in some], parities(bodies)]
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(found, BODIES.types)], schema=BODIES)

    bodies = source.select("text").mapInArrow(candidates, "node long, body string, keys array<long>, p array<long>")
    found = saved(bodies.dropDuplicates(["node"]))
    entries = found.select("node", F.explode("keys").alias("key")).join(shared, "key", "left_semi")
    bodies = found.select("node", "body")
    attributes = found.select("node", F.char_length("body").alias("n"), *[F.col("p")[i].alias(f"p{i}") for i in range(len(RUNS))])

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within(x, y, edits) for x, y in zip(a, b)], dtype=bool)

    def verify(pairs: DataFrame) -> DataFrame:
        a, b = (bodies.select(F.col("node").alias(s), F.col("body").alias(f"body_{s}")) for s in "ab")
        return saved(pairs.join(a, "a").join(b, "b").where(near("body_a", "body_b")).select("a", "b"))

    groups = linked_groups(entries, attributes, may_be_near(edits), verify)

    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line", "name")
    firsts = lines.groupBy("node").agg(F.min(place).alias("first"), F.count("*").alias("n")).join(groups, "node", "left")
    # Most lines stand once and are linked with none: they are groups of their own, from which nothing goes.
    grouped = saved(firsts.where("n > 1 or component is not null").withColumn("component", F.coalesce("component", "node")))
    best = saved(grouped.groupBy("component").agg(F.min("first").alias("best"), F.sum("n").alias("n")).where("n > 1"))
    repeated = saved(grouped.select("node", "component").join(best, "component").select("node", "best"))
    again = lines.select("doc_id", "name", "line", "node", place.alias("place")).join(repeated, "node").where(~F.col("place").eqNullSafe(F.col("best")))
    return saved(again.groupBy("doc_id", "name").agg(F.collect_set("line").alias("dropped")))


def not_blank(line):
    """Column condition: most lines show by their first character, as a range of strings, that they are not blank; the others are trimmed."""
    first = F.lit(False)
    for low, high in (("!", "\x7f"), ("\u00c0", "\u1680"), ("\u3001", None)):
        first = first | ((line >= low) & (line < high) if high else line >= low)
    return first | (F.length(F.btrim(line, F.lit(BLANK))) > 0)


def dedup_lines(docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The input with repeated lines taken out of `text`, n_lines (non-blank) and n_removed; see kept_first.

    Null and empty texts stay as they are with 0 lines. Other columns stay; columns of the two names are replaced.
    """
    (dropped,) = released(lambda: (kept_first(docs, edits, least_chars),))
    dropped = dropped.select(F.col("doc_id").alias("_id"), F.col("name").alias("_name"), "dropped")
    own = docs.drop("n_lines", "n_removed", "_id", "_name", "dropped")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (text_name() == F.col("_name"))
    # Only texts that lose lines are exchanged; a bit map of fixed size proves of most that they lose none.
    there = may_meet(membership_map(dropped, "_name"))(text_name())
    some, rest = own.where(there), own.where(~there)
    joined = some.join(dropped.hint("merge"), same, "left").unionByName(rest, allowMissingColumns=True)
    # A column of its own, used more than once, so that a text is split once, not again for every line that stays.
    split = "_lines" + "_" * max(map(len, own.columns))
    joined = joined.withColumn(split, F.split("text", "\n", -1))
    lines = F.col(split)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
    filled = F.size(F.filter(lines, not_blank))
    filled = F.coalesce(filled, F.lit(0)).cast("long")
    removed = F.coalesce(F.size("dropped"), F.lit(0)).cast("long")
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    names = [F.col(name) if name != "text" else text.alias("text") for name in own.columns]
    return joined.select(*names, F.when(F.col("text").isNull(), F.lit(0)).otherwise(filled).alias("n_lines"), F.when(F.col("dropped").isNull(), F.lit(0)).otherwise(removed).alias("n_removed"))

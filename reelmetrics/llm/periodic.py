"""Periodic runs of words by internal pattern matching.

The words of some documents stand in one sequence with a separator of its own after each. Its suffix array names all
factors of 2**k words; an aligned (dyadic) block is looked up as a range of that array, and range successor queries on a
wavelet matrix give its next occurrences. A run of period q, block <= q < 2 * block, has an aligned block that occurs again q
words on; three and more occurrences form a progression, whose two stretches then give q by the distance of their ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts_with_id, with_long_id

#: Least length of a run in words and in periods; words put into one sequence.
LEAST_WORDS, LEAST_PERIODS, SEQUENCE = 24, 3, 1 << 18
#: Blocks of 8 words find periods of 1 to 8 too: a run of 24 words holds an aligned one and its next occurrence.
FIRST_LEVEL = 3


class Suffixes:
    """Suffix array of a sequence whose last value is unique, and the names of its factors of 2**k values.

    A factor's name is the first row of the suffix array that begins with it; `starts[k]` holds all names of level k. Only
    suffixes that are not told apart yet are sorted again.
    """

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        self.size = n
        self.order = np.argsort(values, kind="stable")
        first = np.diff(values[self.order], prepend=-1) != 0
        name = np.empty(n, np.int64)
        self.names: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []
        open_rows, span = np.arange(n), 1
        while True:
            starts = np.flatnonzero(first)
            name[self.order[open_rows]] = starts[np.searchsorted(starts, open_rows, "right") - 1]
            self.names.append(name.astype(np.int32))
            self.starts.append(starts.astype(np.int32))
            alone = first & np.append(first[1:], True)
            open_rows = open_rows[~alone[open_rows]]
            if not len(open_rows):
                return
            at = self.order[open_rows]
            follow = np.where(at + span < n, name[np.minimum(at + span, n - 1)] + 1, 0)
            key = name[at] * (n + 1) + follow
            moved = np.argsort(key, kind="stable")
            self.order[open_rows] = at[moved]
            first[open_rows] = np.diff(key[moved], prepend=-1) != 0
            span *= 2

    def rows_of(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffix array rows that begin with the factor of 2**level values at each position."""
        low, starts = self.names[level][at], self.starts[level]
        after = np.searchsorted(starts, low, "right")
        return low.astype(np.int64), np.append(starts, self.size)[after].astype(np.int64)

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal values from a and from b on."""
        length = np.zeros(len(a), np.int64)
        for level in reversed(range(len(self.names))):
            names, x, y = self.names[level], a + length, b + length
            same = (x < self.size) & (y < self.size)
            same &= names[np.minimum(x, self.size - 1)] == names[np.minimum(y, self.size - 1)]
            length += same.astype(np.int64) << level
        return length

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal values before a and before b."""
        length = np.zeros(len(a), np.int64)
        for level in reversed(range(len(self.names))):
            names, x, y = self.names[level], a - length - (1 << level), b - length - (1 << level)
            same = (x >= 0) & (y >= 0)
            same &= names[np.maximum(x, 0)] == names[np.maximum(y, 0)]
            length += same.astype(np.int64) << level
        return length


class WaveletMatrix:
    """Range successor over a sequence of numbers below its length: bits by level, about a quarter byte a number and level."""

    def __init__(self, values: np.ndarray) -> None:
        self.size = len(values)
        self.levels = []
        for bit in reversed(range(max(1, self.size.bit_length()))):
            ones = (values >> bit) & 1 > 0
            packed = np.zeros(8 * (self.size // 64 + 2), np.uint8)
            bits = np.packbits(ones, bitorder="little")
            packed[: len(bits)] = bits
            packed = packed.view("<u8")
            before = np.append(0, np.cumsum(np.bitwise_count(packed), dtype=np.int64))
            self.levels.append((bit, packed, before, self.size - int(np.count_nonzero(ones))))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & below)

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest number >= least in rows low to high (exclusive); the sequence's length if there is none."""
        least = np.minimum(least, self.size)
        smaller, l, r = np.zeros(len(low), np.int64), low, high
        for bit, packed, before, zeros in self.levels:
            l1, r1 = self._ones(packed, before, l), self._ones(packed, before, r)
            up = (least >> bit) & 1 > 0
            smaller += np.where(up, (r - r1) - (l - l1), 0)
            l, r = np.where(up, zeros + l1, l - l1), np.where(up, zeros + r1, r - r1)
        found = smaller < high - low
        value, rank, l, r = np.zeros(len(low), np.int64), np.where(found, smaller, 0), low, high
        for bit, packed, before, zeros in self.levels:
            l1, r1 = self._ones(packed, before, l), self._ones(packed, before, r)
            none = (r - r1) - (l - l1)
            up = rank >= none
            rank -= np.where(up, none, 0)
            value |= up.astype(np.int64) << bit
            l, r = np.where(up, zeros + l1, l - l1), np.where(up, zeros + r1, r - r1)
        return np.where(found, value, self.size)


def candidates(suffixes: Suffixes, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance): equal blocks among which every run of a document of at most `longest` words has one at its period."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    matrix = None
    for level in range(FIRST_LEVEL, len(suffixes.names)):
        block = 1 << level
        if level > FIRST_LEVEL and LEAST_PERIODS * block > longest:
            break
        at = np.arange(0, suffixes.size - block + 1, block)
        low, high = suffixes.rows_of(level, at)
        again = high - low > 1
        at, low, high = at[again], low[again], high[again]
        if not len(at):
            continue
        if matrix is None:
            matrix = WaveletMatrix(suffixes.order)
        if level == FIRST_LEVEL:
            next_one = matrix.successor(low, high, at + 1)
            near = next_one <= at + block
            found.append((at[near], next_one[near] - at[near]))
        one = matrix.successor(low, high, at + block)
        near = one < at + 2 * block
        at, low, high, one = at[near], low[near], high[near], one[near]
        found.append((at, one - at))
        two = matrix.successor(low, high, one + 1)
        near = two < at + 2 * block
        at, low, high, one, two = at[near], low[near], high[near], one[near], two[near]
        found.append((at, two - at))
        near = matrix.successor(low, high, two + 1) < at + 2 * block
        at, one, step = at[near], one[near], (two - one)[near]
        ends = suffixes.forward(one, one + step) + one - suffixes.forward(at, at + step) - at
        begins = one - suffixes.backward(one, one + step) - at + suffixes.backward(at, at + step)
        for distance in (ends, begins):
            fits = (distance >= block) & (distance < 2 * block)
            found.append((at[fits], distance[fits]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([d for _, d in found])


def runs_of(values: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence, by start, then period; its last value must be unique."""
    suffixes = Suffixes(values)
    at, period = candidates(suffixes, longest)
    start = at - suffixes.backward(at, at + period)
    length = at + period + suffixes.forward(at, at + period) - start
    real = (length >= LEAST_WORDS) & (length >= LEAST_PERIODS * period)
    rows = np.unique(np.stack([start[real], length[real], period[real]], axis=1), axis=0)
    # A multiple of the smallest period spans the same words.
    least = np.ones(len(rows), bool)
    least[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[least]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def without_repeats(words: list[bytes], runs: np.ndarray) -> bytes:
    """Words joined by one space, of every run the first period only."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)])


def together(documents: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each document (start, length, period), found in one sequence of all of them."""
    sizes = np.array([len(words) for words in documents])
    ends = np.cumsum(sizes + 1)
    flat = np.array([word for words in documents for word in words], dtype=object)
    codes, distinct = pd.factorize(flat) if len(flat) else (np.zeros(0, np.int64), [])
    values = np.empty(int(ends[-1]), np.int64)
    inside = np.ones(len(values), bool)
    inside[ends - 1] = False
    values[inside] = codes
    values[ends - 1] = len(distinct) + np.arange(len(documents))
    rows = runs_of(values, int(sizes.max()))
    owner = np.searchsorted(ends, rows[:, 0], "right")
    rows[:, 0] -= (ends - sizes - 1)[owner]
    edges = np.searchsorted(owner, np.arange(len(documents) + 1))
    return [rows[a:b] for a, b in zip(edges[:-1], edges[1:])]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period in words, by start, then period) and collapsed text of every whole text.

    A run: a stretch of words with smallest period q, of 24 words and 3 q at least, that no neighbour extends. Collapsed: the words joined
    by one space, those a run holds after its first period left out. Words are runs between ASCII white space. Null, empty and
    blank texts have no words, no runs and an empty collapsed text; equal rows and null ids give a row each; other columns are left aside.
    About 2**18 words, or one longer document, are held at a time, some 150 bytes a word.
    """
    schema = "doc_id string, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def found(ids: list, documents: list[list[bytes]]) -> pd.DataFrame:
        runs = together(documents)
        return pd.DataFrame(
            {
                "doc_id": ids,
                "runs": [[{"start": int(s), "length": int(n), "period": int(q)} for s, n, q in rows] for rows in runs],
                "collapsed": [without_repeats(w, r).decode("utf-8", "surrogatepass") for w, r in zip(documents, runs)],
            }
        )

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, documents, size = [], [], 0
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids.append(doc_id)
                documents.append(text.encode("utf-8", "surrogatepass").split() if text else [])
                size += len(documents[-1]) + 1
                if size >= SEQUENCE:
                    yield found(ids, documents)
                    ids, documents, size = [], [], 0
            if ids:
                yield found(ids, documents)

    return with_long_id(texts_with_id(docs).mapInPandas(batches, schema))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the documents, by crc32 of doc_id, repeat a stretch of their words to the end. A null id changes nothing."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    marked = docs.select("doc_id", "text", hashed.alias("h"), F.expr("h div 10").alias("g"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = marked.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    placed = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0, n - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return placed.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the run with the greatest length / period (exact; ties: smallest start, then period) and hashes."""
    better = (
        "best IS NULL OR r.length * best.period > best.length * r.period OR (r.length * best.period = best.length * r.period "
        "AND (r.start < best.start OR (r.start = best.start AND r.period < best.period)))"
    )
    kind = "struct<start: bigint, length: bigint, period: bigint>"
    best = F.expr(f"aggregate(runs, CAST(NULL AS {kind}), (best, r) -> if({better}, r, best))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha256(lines).alias("runs_sha256"),
        sha256(F.col("collapsed")).alias("collapsed_sha256"),
    )


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


#: crc32 of decimal digits, bit by bit, then pairs of equal runs of four words, in islands.
TWIN = r"""
WITH hashed AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda ch: list_concat([ascii(ch)::BIGINT], list_transform(range(8), lambda i: (-1)::BIGINT))))),
      lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS h
  FROM documents),
placed AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM hashed),
stepped AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
texts AS (
  SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w
  FROM stepped),
grams AS (
  SELECT r, n, unnest(range(n - 3)) AS i, unnest(list_transform(range(1, n - 2), lambda i: array_to_string(w[i:i + 3], ' '))) AS g
  FROM texts WHERE n >= 24),
same AS (
  SELECT a.r, b.i - a.i AS q, a.i FROM grams a JOIN grams b ON a.r = b.r AND a.g = b.g AND a.i < b.i AND 3 * (b.i - a.i) <= a.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same),
stretches AS (SELECT r, q, min(i) AS start, count(*) + 3 + q AS length FROM islands GROUP BY r, q, island),
runs AS (
  SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= 24 AND length >= 3 * q GROUP BY r, start, length),
best AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY length / period DESC, start, period) AS place FROM runs),
listed AS (
  SELECT r, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256
  FROM runs GROUP BY r),
spread AS (SELECT r, unnest(range(n)) AS i, unnest(w) AS x FROM texts WHERE r IN (SELECT r FROM runs)),
kept AS (
  SELECT r, i, x FROM spread s
  WHERE NOT EXISTS (SELECT 1 FROM runs u WHERE u.r = s.r AND s.i >= u.start + u.period AND s.i < u.start + u.length)),
collapsed AS (SELECT r, sha256(string_agg(x, ' ' ORDER BY i)) AS collapsed_sha256 FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (1000 * length // period)::BIGINT AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
  coalesce(collapsed_sha256, sha256(array_to_string(w, ' '))) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (r) LEFT JOIN collapsed USING (r) LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (r)"""

"""Benchmark decontamination: windows of canonical templates joined by hash, slots checked for consistency."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Runs, in_map, mapped, may_meet, membership_map, mix, named_texts, saved, text_name, with_long_id

#: Words of a window, words of it that must be no placeholder, and the share of an item's windows that makes a leak.
WINDOW, LITERALS, COVERAGE = 8, 4, 0.5
#: Words of the shorter windows that stand between changed words, and of a stretch that makes a leak whatever its share.
SHORT, STRETCH = 6, 14
WORD, NUMBER, UNIT, NAME = range(4)
#: Words whose windows a task holds at a time.
HELD = 1 << 17
#: Rows that a task holds as Python strings, and what it returns of the windows met.
FRAME = 256
MET = pa.schema([
    ("doc_id", pa.string()), ("name", pa.int64()), ("width", pa.int32()), ("place", pa.int32()), ("hash", pa.int64()), ("values", pa.list_(pa.string())),
])

#: Words that stand for numbers and units, and given names known at the start of a sentence.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons pound pounds ounce ounces "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months "
    "year years cent cents dollar dollars euro euros meter meters metre metres kilometer kilometers kilometre kilometres "
    "percent degree degrees mph kph".split()
)
NAMES = frozenset(
    "alice anna ben bob carlos charlie david emily emma eric george grace henry jack james jane jim john joe kate laura lisa "
    "lucy maria mark mary mia mike natalia nina olivia paul peter robert sam sara sarah susan tim tom weng".split()
)
NUMERIC = re.compile(r"[+-]?\d[\d.,:/]*\d*(?:st|nd|rd|th|%)?")
MEASURE = re.compile(r"([+-]?\d[\d.,]*)([a-z]{1,3})")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
KNOWN = dict.fromkeys(NAMES, NAME) | dict.fromkeys(UNITS, UNIT) | dict.fromkeys(NUMBER_WORDS, NUMBER)


def core_of(chunk: str) -> str:
    """The run without marks at its ends."""
    return chunk[:-1] if chunk[:-1].isalnum() and not chunk[-1].isalnum() else EDGE.sub("", chunk)


class Chunks(dict):
    """What the runs between white space are: a code (kind, ends a sentence, starts with a capital) and a hash, by number.

    Codes and hashes take 9 bytes a run; its value is made anew from the run where it is asked for.
    """

    LIMIT = 300_000

    def __init__(self) -> None:
        self.codes = bytearray()
        self.hashes = array("Q")
        self.runs: list[str] = []

    def empty(self) -> None:
        self.clear()
        self.__init__()

    def __missing__(self, chunk: str) -> int:
        plain = chunk.isalnum()
        core = chunk if plain else core_of(chunk)
        low = core.lower()
        if low.isalpha():
            kind = KNOWN.get(low, WORD)
        elif NUMERIC.fullmatch(low) or ((measure := MEASURE.fullmatch(low)) and measure.group(2) in UNITS):
            kind = NUMBER
        else:
            kind = WORD if core else -1
        ends = not plain and chunk.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":", ";")
        capital = core[:1].isupper() and core[1:].islower()
        number = self[chunk] = len(self.runs)
        self.runs.append(chunk)
        self.codes.append(kind + 1 | ends << 3 | capital << 4)
        self.hashes.append(xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass")))
        return number

    def columns(self, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Kinds, which end a sentence, which start with a capital, hashes."""
        codes = np.frombuffer(self.codes, np.uint8)[at] if len(at) else np.zeros(0, np.uint8)
        hashes = np.frombuffer(self.hashes, np.uint64)[at] if len(at) else np.zeros(0, np.uint64)
        return (codes & 7).astype(np.int8) - np.int8(1), codes & 8 > 0, codes & 16 > 0, hashes

    def numbers(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The chunks' numbers, and which chunks come first in a line."""
        if len(self) > self.LIMIT:
            self.empty()
        lines = [line.split() for line in text.splitlines()]
        at = np.fromiter(map(self.__getitem__, chain.from_iterable(lines)), np.int64)
        first = np.zeros(len(at) + 1, bool)
        first[np.cumsum([0, *map(len, lines)])] = True
        return at, first[:-1]


CHUNKS = Chunks()


class Words(NamedTuple):
    """A text's words: kinds, kinds if line ends do not start sentences, hashes of the words, numbers in CHUNKS, capitals."""

    kinds: np.ndarray
    running: np.ndarray
    plain: np.ndarray
    numbers: np.ndarray
    capitals: np.ndarray


def canonical(text: str | None) -> Words:
    """A name is a capitalised word inside a sentence, or a known given name anywhere. Marks without a letter or digit
    are no words.
    """
    return canonical_all([CHUNKS.numbers(text or "")])[0]


def canonical_all(read: list[tuple[np.ndarray, np.ndarray]]) -> tuple[Words, np.ndarray]:
    """The words of texts read by CHUNKS.numbers in one sequence, and how many each text has."""
    at, first = (np.concatenate(parts) for parts in zip(*read))
    edges = np.cumsum([0, *(len(own) for own, _ in read)])
    kinds, ends, capitals, hashes = CHUNKS.columns(at)
    inside = np.ones(len(at) + 1, bool)
    inside[1:-1] = ~ends[:-1]
    inside[edges] = False  # a text's first word stands after none
    running = np.where((kinds == WORD) & inside[:-1] & capitals, np.int8(NAME), kinds)
    kinds = np.where(first, kinds, running)
    real = kinds >= 0
    sizes = np.diff(np.concatenate([[0], np.cumsum(real)])[edges])
    return Words(kinds[real], running[real], hashes[real], at[real], capitals[real]), sizes


class Reading:
    """Window hashes of a sequence of words in one reading, each from one running sum whatever its width.

    Numbers, units and names have their kind as hash.
    """

    def __init__(self, kinds: np.ndarray, plain: np.ndarray) -> None:
        self.kinds = kinds
        self.runs = Runs(np.where(kinds == WORD, plain, mix(kinds.astype(np.uint64) + np.uint64(1))))
        self.words = np.concatenate([[0], np.cumsum(kinds == WORD)])

    def literal(self, at: np.ndarray, width: int, literals: int) -> np.ndarray:
        """Those positions whose window has enough literal words."""
        return at[self.words[at + width] - self.words[at] >= min(literals, width)]

    def hashes(self, at: np.ndarray, width: int) -> np.ndarray:
        return mix(self.runs.hashes(at, at + width) ^ np.uint64(width))


def literal_hashes(runs: Runs, at: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows with placeholders undone, in a range of their own."""
    return mix(runs.hashes(at, at + width) ^ np.uint64(0x5851F42D4C957F2D + width))


def values_at(at: np.ndarray) -> list[str]:
    """The lower-cased words of numbers given since CHUNKS was last emptied."""
    return [core_of(CHUNKS.runs[i]).lower() for i in at.tolist()]


def both_readings(words: Words) -> tuple[Reading, Reading, np.ndarray]:
    """Line starts start sentences, or do not; and how many words before each place read differently."""
    moved = np.concatenate([[0], np.cumsum(words.kinds != words.running)])
    first = Reading(words.kinds, words.plain)
    return first, Reading(words.running, words.plain) if moved[-1] else first, moved


def slots_of(kinds: np.ndarray, numbers: np.ndarray, start: int, width: int) -> list[str]:
    """Values of a window's placeholders, in order."""
    own = slice(start, start + width)
    return values_at(numbers[own][kinds[own] != WORD])


def item_windows(text: str, width: int, literals: int) -> list[tuple]:
    """(width, at, n_windows, n_words, hash, slots) of an item's windows; slots of literal windows are the item's own.

    The first word of an item is read as a name too. An item without template windows has all its literal ones.
    """
    words = canonical(text)
    n, out = len(words.kinds), []
    first, second, moved = both_readings(words)
    plain = Runs(words.plain)
    for own in dict.fromkeys((min(width, n), SHORT if n >= width else min(width, n))):
        if not own:
            break
        everywhere = np.arange(n - own + 1)
        places = first.literal(everywhere, own, literals)
        other = second.literal(everywhere, own, literals)
        other = other[moved[other + own] > moved[other]]
        read = [(words.kinds, places, first.hashes(places, own)), (words.running, other, second.hashes(other, own))]
        if len(places) and not places[0] and words.kinds[0] == WORD and words.capitals[0]:
            kinds = words.kinds.copy()
            kinds[0] = NAME
            read.append((kinds, places[:1], Reading(kinds[:own], words.plain[:own]).hashes(places[:1], own)))
        if not len(places) and own == min(width, n):
            places = everywhere
        read.append((words.kinds, places, literal_hashes(plain, places, own)))
        for kinds, at, found in read:
            out += [
                (own, i, len(places), n, h, slots_of(kinds, words.numbers, i, own))
                for i, h in zip(at.tolist(), found.view(np.int64).tolist())
            ]
    return out


def windows_met(words: Words, sizes: np.ndarray, widths: list[int], literals: int, bits: np.ndarray) -> Iterator[tuple]:
    """(document number, width, place, hash, values) of all windows of some texts that the bit map may hold.

    The texts' words stand in one sequence, so that each width costs a few array operations for all of them.
    """
    ends = np.cumsum(sizes)
    end_of = np.repeat(ends, sizes)
    first, second, moved = both_readings(words)
    plain = Runs(words.plain)
    for width in widths:
        at = np.arange(len(end_of))
        at = at[at + width <= end_of]
        one, other = first.literal(at, width, literals), second.literal(at, width, literals)
        other = other[moved[other + width] > moved[other]]
        for kinds, places, hashes in (
            (words.kinds, one, first.hashes(one, width)),
            (words.running, other, second.hashes(other, width)),
            (None, at, literal_hashes(plain, at, width)),
        ):
            hit = in_map(hashes, bits)
            places, hashes = places[hit], hashes[hit].view(np.int64)
            owner = np.searchsorted(ends, places, "right")
            starts = places - (ends - sizes)[owner]
            for i, place, start, h in zip(owner.tolist(), places.tolist(), starts.tolist(), hashes.tolist()):
                yield i, width, start, h, None if kinds is None else slots_of(kinds, words.numbers, place, width)


def frames_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """FRAME rows at a time as pandas: a whole batch of 10,000 texts would stand in memory twice, and the one before it too."""
    for batch in batches:
        for at in range(0, batch.num_rows, FRAME):
            yield batch.slice(at, FRAME).to_pandas()


def rows_met(frames: Iterator[pd.DataFrame], widths: list[int], literals: int, bits: np.ndarray) -> Iterator[pd.DataFrame]:
    """doc_id, name, width, place, hash, values of the windows that the bit map may hold, about HELD words at a time.

    Outside a job's closure on purpose: a closure would take its own copy of CHUNKS along and not see it emptied.
    """
    held: list[tuple] = []
    size = 0

    def rows() -> pd.DataFrame:
        words, sizes = canonical_all([own for _, _, own in held])
        out = [(*held[i][:2], *row) for i, *row in windows_met(words, sizes, widths, literals, bits)]
        held.clear()
        return pd.DataFrame(out, columns=["doc_id", "name", "width", "place", "hash", "values"])

    for frame in frames:
        for doc, name, text in zip(frame["doc_id"], frame["name"], frame["text"]):
            # Numbers of words hold until CHUNKS is emptied, which the next text does once it is full.
            if held and (size > HELD or len(CHUNKS) > CHUNKS.LIMIT):
                yield rows()
                size = 0
            held.append((doc, name, CHUNKS.numbers(text or "")))
            size += len(held[-1][2][0])
    if held:
        yield rows()
    CHUNKS.empty()  # a worker that waits for its next task holds none


def longest_stretch(spans):
    """Words from the first to the last of the longest chain of spans (at, end), in order, at most one word apart."""
    zero = F.struct(F.lit(-9).alias("start"), F.lit(-9).alias("end"), F.lit(0).alias("best"))

    def step(held, span):
        start = F.when(span["at"] > held["end"] + 1, span["at"]).otherwise(held["start"])
        end = F.greatest(held["end"], span["end"])
        return F.struct(start.alias("start"), end.alias("end"), F.greatest(held["best"], end - start).alias("best"))

    return F.aggregate(spans, zero, step, lambda held: held["best"])


def leaks(
    docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, literals: int = LITERALS, coverage: float = COVERAGE, stretch: int = STRETCH
) -> DataFrame:
    """doc_id, name, item_id, coverage of leaked items: at least that share of the item's windows stands in the text, or
    a stretch of at least that many words with at most single words changed.

    Windows that match at one distance between item and text are one alignment. Numbers, names and units may be
    changed, but an old value must always have the same new one: windows that hold a value with several new ones do
    not count. Windows match as templates or word by word, whatever starts a sentence. A stretch is a chain of windows
    (SHORT words and more) of one alignment; its coverage is its share of the item's words. Items shorter than a
    window are one window of their own length; texts are searched for every such length. Items without words or id
    leak nowhere. Rows with one id, or none, and different texts are told apart by the name of the text.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")

    def item_rows(frame: pd.DataFrame) -> pd.DataFrame:
        out = [(item, *row) for item, text in zip(frame["item_id"], frame["text"]) for row in item_windows(text, width, literals)]
        return pd.DataFrame(out, columns=["item_id", "width", "at", "n_windows", "n_words", "hash", "slots"])

    known = saved(mapped(items, "item_id long, width int, at int, n_windows int, n_words int, hash long, slots array<string>", item_rows))
    widths = sorted(row["width"] for row in known.select("width").distinct().collect())
    bits = membership_map(known, "hash")

    def doc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in rows_met(frames_of(batches), widths, literals, bits):
            yield pa.RecordBatch.from_pandas(frame, MET, preserve_index=False)

    source = named_texts(docs).where("text is not null")
    found = source.mapInArrow(doc_rows, "doc_id string, name long, width int, place int, hash long, values array<string>")
    values = F.coalesce("values", "slots")
    matched = with_long_id(found).join(known, ["hash", "width"]).where(F.size("slots") == F.size(values))
    matched = saved(matched.select(
        "doc_id", "name", "item_id", (F.col("place") - F.col("at")).alias("shift"), "at", "width", "n_windows", "n_words", "slots",
        F.arrays_zip("slots", values.alias("values")).alias("pairs"),
    ).distinct())
    key = ["doc_id", "name", "item_id", "shift"]
    slots = matched.select(*key, F.explode("pairs").alias("pair")).select(*key, "pair.slots", "pair.values").distinct()
    torn = slots.groupBy(*key, "slots").count().where("count > 1").groupBy(*key).agg(F.collect_set("slots").alias("torn"))
    torn = torn.select(F.col("doc_id").alias("_doc"), F.col("name").alias("_name"), F.col("item_id").alias("_item"), F.col("shift").alias("_shift"), "torn")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("name") == F.col("_name")) & (F.col("item_id") == F.col("_item")) & (F.col("shift") == F.col("_shift"))
    whole = matched.join(saved(torn), same, "left").where(F.col("torn").isNull() | ~F.arrays_overlap("slots", "torn"))
    whole = saved(whole.select(*key, "at", "width", "n_windows", "n_words").distinct())
    own = key[:3]
    places = whole.where(F.col("width") == F.least(F.lit(width), "n_words")).select(*own, "n_windows", "at").distinct()
    shares = places.groupBy(*own).agg((F.count("*") / F.max("n_windows")).alias("coverage")).where(F.col("coverage") >= coverage)
    span = F.struct("at", (F.col("at") + F.col("width")).alias("end"))
    runs = whole.groupBy(*key, "n_words").agg(longest_stretch(F.sort_array(F.collect_set(span))).alias("words")).where(F.col("words") >= stretch)
    runs = runs.select(*own, (F.col("words") / F.col("n_words")).alias("coverage"))
    return saved(shares.unionByName(runs).groupBy(*own).agg(F.max("coverage").alias("coverage")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The input with contaminated, n_items, items (leaked item ids, ascending, comma-joined) and coverage (largest).

    Null and empty texts are clean. Columns of those names are replaced.
    """
    found = leaks(docs, benchmark, **settings).groupBy("doc_id", "name").agg(
        F.count("*").alias("n_items"),
        F.array_join(F.transform(F.array_sort(F.collect_set("item_id")), lambda x: x.cast("string")), ",").alias("items"),
        F.max("coverage").alias("coverage"),
    ).withColumnsRenamed({"doc_id": "_id", "name": "_name"})
    own = docs.drop("contaminated", "n_items", "items", "coverage", "_id", "_name")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (text_name() == F.col("_name"))
    found = saved(found)
    # Only texts that may have leaks are exchanged; a bit map of fixed size proves of most that they have none.
    there = may_meet(membership_map(found, "_name"))(text_name())
    some, rest = own.where(there), own.where(~there)
    joined = some.join(found.hint("merge"), same, "left").unionByName(rest, allowMissingColumns=True)
    return joined.select(
        *own.columns,
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )

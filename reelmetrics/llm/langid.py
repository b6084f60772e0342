"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: n-grams of a profile, of a document's list, and the longest n-gram (three code points fit one long).
PROFILE, LISTED, LONGEST = 400, 300, 3
UNKNOWN = "und"
#: Characters counted at a time.
PORTION = 1 << 20


def letter_table() -> np.ndarray:
    """Whether each code point is a letter; planes above the third hold none."""
    table = np.zeros(0x110000, bool)
    table[:0x40000] = [chr(point).isalpha() for point in range(0x40000)]
    return table


_LETTERS: list[np.ndarray] = []


def counted_keys(keys: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below `bins` with counts, by counting where bins are few and by sorting where not."""
    if bins > 1 << 18:
        return np.unique(keys, return_counts=True)
    counts = np.bincount(keys, minlength=1)
    found = np.flatnonzero(counts)
    return found, counts[found]


def portions(texts: Iterable[str], most: int = PORTION) -> Iterator[str]:
    """The texts in strings of about `most` characters, cut between words only (a longer word stays whole)."""
    held, size = [], 0
    for text in texts:
        at = 0
        while at < len(text):
            end = at + most - size
            while end < len(text) and text[end].isalpha():
                end += 1
            held.append(text[at:end])
            size += len(held[-1]) + 1
            at = end
            if size >= most:
                yield "\n".join(held)
                held, size = [], 0
    if held:
        yield "\n".join(held)


def added_up(counted: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of all parts together, in key order."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for more, own in counted:
        found, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, at, np.concatenate([counts, own]))
        keys, counts = found, total
    return keys, counts


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text with counts, see portion_ngrams; a long text is counted portion by portion."""
    if text is None or len(text) <= PORTION:
        return portion_ngrams(text)
    return added_up(map(portion_ngrams, portions([text])))


def portion_ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the lower-cased words with counts; keys are code points packed 21 bits each.

    A space stands around each word; single letters and n-grams with a space at one end count, none reaches over one.
    """
    if not _LETTERS:
        _LETTERS.append(letter_table())
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = _LETTERS[0][points]
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # one space after each word
    kept[0] = True
    points = np.where(letter, points, 32)[kept]
    if len(points) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    alphabet = np.unique(points) if len(points) < 1000 else np.flatnonzero(np.bincount(points))
    code = np.zeros(alphabet[-1] + 1, np.int64)
    code[alphabet] = np.arange(len(alphabet))
    space, size = code[32], len(alphabet)
    own = code[points]
    keys, counts = [], []
    for n in range(1, LONGEST + 1):
        key, inner = own[: len(own) - n + 1], np.ones(len(own) - n + 1, bool)
        for i in range(1, n):
            key = key * size + own[i : len(own) - n + 1 + i]
            if i < n - 1:
                inner &= own[i : len(own) - n + 1 + i] != space
        if n == 1:
            inner = key != space
        found, number = counted_keys(key[inner], size**n)
        packed = np.zeros(len(found), np.int64)
        for i in range(n):
            packed = (packed << 21) | alphabet[(found // size ** (n - 1 - i)) % size]
        keys.append(packed)
        counts.append(number)
    return np.concatenate(keys), np.concatenate(counts)


def ranked(keys: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Keys by falling count, ties by key."""
    return keys[np.lexsort((keys, -counts))[:most]]


def learn_profiles(docs: DataFrame, most: int = PROFILE) -> dict[str, list[int]]:
    """The most frequent n-grams of every language over all rows with a language and text.

    Counting adds up in tasks, then by key; only `most` keys a language come to the driver.
    """

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                keys, counts = added_up(map(portion_ngrams, portions(texts)))
                yield pd.DataFrame({"lang": lang, "gram": keys, "n": counts})

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = saved(known.mapInPandas(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    langs = sorted(row[0] for row in counts.select("lang").distinct().collect())
    best = [counts.where(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(most) for lang in langs]
    rows = reduce(DataFrame.union, best).collect() if best else []
    profiles: dict[str, list[int]] = {}
    for row in sorted(rows, key=lambda row: (row["lang"], -row["n"], row["gram"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Profiles:
    """Rank tables of the languages; compares one document with all of them."""

    def __init__(self, profiles: dict[str, list[int]], listed: int = LISTED) -> None:
        self.langs, self.listed = sorted(profiles), listed
        self.missing = max(map(len, profiles.values()), default=1)
        self.keys, self.ranks = [], []
        for lang in self.langs:
            keys = np.array(profiles[lang], np.int64)
            order = np.argsort(keys)
            self.keys.append(keys[order])
            self.ranks.append(order)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Nearest language (ties: first by name) and 1 - out-of-place distance / its largest value."""
        grams = ranked(*ngrams(text), self.listed)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        own, far = np.arange(len(grams)), []
        for keys, ranks in zip(self.keys, self.ranks):
            at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            moved = np.where(keys[at] == grams, np.minimum(np.abs(ranks[at] - own), self.missing), self.missing)
            far.append(moved.sum())
        best = int(np.argmin(far))
        return self.langs[best], float(1 - far[best] / (self.missing * len(grams)))


def identify(docs: DataFrame, profiles: dict[str, list[int]]) -> DataFrame:
    """The input with lang_pred and score (0 to 1); `und` with score 0 where the text is null or has no letter,
    or no profile was learned. Every row gives a row; columns of those two names are replaced."""
    tables = Profiles(profiles)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([tables.predict(text) for text in texts], columns=["lang_pred", "score"])

    kept = docs.drop("lang_pred", "score")
    # Nondeterministic by name only: else Spark pushes a filter on the result below, predicts twice and holds two workers a task.
    found = kept.withColumn("_found", predicted.asNondeterministic()("text"))
    return found.select(*[found[name] for name in kept.columns], "_found.lang_pred", "_found.score")

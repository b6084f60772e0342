"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of the training sample that comes to the driver: documents, and lines of all of them.
TRAIN_DOCS, TRAIN_LINES = 4000, 400_000
OTHER, LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL = range(7)
FEATURES = 11


def classes() -> np.ndarray:
    """Class of every code point, by its Unicode category."""
    kinds = {"Ll": LOWER, "Lo": LOWER, "Lm": LOWER, "Lu": UPPER, "Lt": UPPER, "Nd": DIGIT, "Zs": SPACE, "Cc": SPACE}
    table = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x30000):
        category = unicodedata.category(chr(point))
        table[point] = kinds.get(category, SYMBOL if category[0] in "PSC" else OTHER)
    table[[ord(c) for c in ".,;:?'\"()-"]] = STOP
    return table


_TABLE: list[np.ndarray] = []


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for every line, and the lines' lengths; empty text is one empty line.

    Shares of character classes, length, words: how many, how long, how often repeated, how many short.
    """
    if not _TABLE:
        _TABLE.append(classes())
    text = text or ""
    lines = text.split("\n")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    line = np.zeros(len(points), np.int64)
    if len(points):
        np.cumsum(points[:-1] == 10, out=line[1:])
    n = np.bincount(line * 7 + _TABLE[0][points], minlength=7 * len(lines)).reshape(-1, 7)[: len(lines)].astype(float)
    letters = n[:, LOWER] + n[:, UPPER]
    shown = np.maximum(n.sum(1) - n[:, SPACE], 1)
    words = np.zeros((len(lines), 4))
    for i, own in enumerate(lines):
        found = own.split()
        if found:
            words[i] = len(found), len(set(found)), sum(len(w) <= 3 for w in found), sum(a == b for a, b in zip(found, found[1:]))
    some = np.maximum(words[:, 0], 1)
    lengths = np.array([len(own) for own in lines], float)
    rows = np.column_stack([
        np.ones(len(lines)),
        np.log1p(lengths) / 5,
        letters / shown,
        n[:, UPPER] / np.maximum(letters, 1),
        n[:, DIGIT] / shown,
        n[:, STOP] / shown,
        n[:, SYMBOL] / shown,
        words[:, 1] / some,
        words[:, 2] / some,
        words[:, 3] / some,
        np.minimum(shown / some, 20) / 10,
    ])
    return rows, lengths


def with_neighbours(rows: np.ndarray) -> np.ndarray:
    """Own features, the previous line's and the next line's (zeros beyond the ends)."""
    none = np.zeros((1, rows.shape[1]))
    return np.hstack([rows, np.vstack([none, rows[:-1]]), np.vstack([rows[1:], none])])


@dataclass
class LineField:
    """Weights of the log odds of `good`, and log potentials of neighbouring labels (bad, good)."""

    weights: np.ndarray
    pairs: np.ndarray

    @classmethod
    def blank(cls) -> LineField:
        return cls(np.zeros(3 * FEATURES), np.zeros((2, 2)))

    def passes(self, odds: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over many chains at once: P(good) of each line, sums of the pair marginals.

        odds holds the chains one after another; step t works on all chains longer than t.
        """
        order = np.argsort(-sizes, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        longest = sizes[order]
        here = np.exp(np.column_stack([-odds, odds]) / 2 - np.abs(odds)[:, None] / 2)
        move = np.exp(self.pairs - self.pairs.max())
        forward, backward = here.copy(), np.ones_like(here)
        active = np.searchsorted(-longest, -np.arange(1, (longest[0] if len(longest) else 0) + 1), side="right")
        for t in range(1, len(active)):
            at = starts[: active[t]] + t
            step = (forward[at - 1] @ move) * here[at]
            forward[at] = step / step.sum(1, keepdims=True)
        for t in range(len(active) - 1, 0, -1):
            at = starts[: active[t]] + t
            step = (backward[at] * here[at]) @ move.T
            backward[at - 1] = step / step.sum(1, keepdims=True)
        both = forward * backward
        good = both[:, 1] / both.sum(1)
        inner = np.ones(len(odds), bool)
        inner[starts] = False
        after = np.flatnonzero(inner)
        edge = forward[after - 1][:, :, None] * move * (here[after] * backward[after])[:, None, :]
        edge /= edge.sum((1, 2), keepdims=True)
        return good, edge.sum(0)

    def fit(self, rows: np.ndarray, sizes: np.ndarray, labels: np.ndarray, steps: int = 200, ridge: float = 1e-3) -> LineField:
        """Gradient ascent (Adam) on the chains' log likelihood; every line has its document's label.

        A document counts as one whatever its lines. Deterministic.
        """
        if not len(rows):
            return self
        line = np.repeat(labels, sizes)
        share = np.repeat(1 / sizes, sizes)
        starts = np.zeros(len(rows), bool)
        starts[np.cumsum(sizes) - sizes] = True
        seen = np.zeros((2, 2))
        for value in (0, 1):
            seen[value, value] = (~starts & (line == value)).sum()
        theta = np.concatenate([self.weights, self.pairs.ravel()])
        first, second = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            now = LineField(theta[:-4], theta[-4:].reshape(2, 2))
            good, edges = now.passes(rows @ now.weights, sizes)
            up = np.concatenate([rows.T @ ((line - good) * share) / len(sizes), (seen - edges).ravel() / max(1, len(rows))])
            up -= ridge * theta
            first, second = 0.9 * first + 0.1 * up, 0.999 * second + 0.001 * up * up
            theta = theta + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        return LineField(theta[:-4], theta[-4:].reshape(2, 2))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted mean of the lines' P(good); lines of no length count where a text has no other."""
        if not texts:
            return np.zeros(0)
        found = [line_features(text) for text in texts]
        sizes = np.array([len(lengths) for _, lengths in found])
        rows = np.vstack([with_neighbours(rows) for rows, _ in found])
        good, _ = self.passes(rows @ self.weights, sizes)
        weight = np.concatenate([lengths if lengths.any() else np.ones(len(lengths)) for _, lengths in found])
        at = np.cumsum(sizes) - sizes
        return np.clip(np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at), 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, most_docs: int = TRAIN_DOCS, most_lines: int = TRAIN_LINES) -> LineField:
    """A field fitted to the texts (doc_id, text) of at most `most_docs` label rows (doc_id, label 0 or 1).

    The label rows are chosen by a hash of their id, then sent to the texts: at most `most_docs` pairs of numbers.
    Rows without id, text or label teach nothing; of several texts with a chosen id each teaches. All lines
    of a chosen text are used; ids whose texts would bring the sum of lines above `most_lines` are left out. Without rows the field is blank and scores 0.5.
    """

    @F.pandas_udf("size int, rows array<double>")
    def features(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            rows, _ = line_features(text)
            out.append((len(rows), with_neighbours(rows).ravel()))
        return pd.DataFrame(out, columns=["size", "rows"])

    known = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "label")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most_docs)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    sizes = texts.groupBy("doc_id").agg(F.sum(F.size(F.split("text", "\n", -1))).alias("n"))
    total, left_out = 0, []
    for row in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if total + row["n"] > most_lines:
            left_out.append(row["doc_id"])
        else:
            total += row["n"]
    if left_out:
        texts = texts.where(~F.col("doc_id").isin(left_out))
    rows = sorted(texts.select("label", features("text").alias("f")).select("label", "f.size", "f.rows").collect(), key=repr)
    if not rows:
        return LineField.blank()
    matrix = np.vstack([np.array(r["rows"]).reshape(r["size"], -1) for r in rows])
    return LineField.blank().fit(matrix, np.array([r["size"] for r in rows]), np.array([r["label"] for r in rows]))


def score(docs: DataFrame, field: LineField) -> DataFrame:
    """The input with quality_score (0 to 1); null text counts as empty; a column of that name is replaced."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        values = texts.tolist()
        parts = [field.scores(values[i : i + 200]) for i in range(0, len(values), 200)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    return docs.withColumn("quality_score", scored("text"))

"""Language-model scores: a log-bilinear model of word classes on exact word counts.

Tokens are lower-cased words and one end. A frequent word is a class of its own, the others share classes by their last
bytes. The model predicts the next class from the three before: each context vector is weighted by a diagonal matrix, their sum
meets the vectors of all classes. Training is noise-contrastive: a token is told from class samples. Scoring
normalises over all classes by products of table entries; inside a class a word has its share of the class's count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTES, SPACES, Runs, mapped, mix, saved, texts_with_id, with_long_id

#: Classes of one word each (the end among them), classes of words by ending, words of context, width of the vectors.
HEADS, TAILS, CONTEXT, WIDTH = 384, 128, 3, 16
#: Training: each round reads an own part of the documents and averages its tasks' models; tokens and noise samples of a step.
ROUNDS, STEP, NOISE, RATE = 3, 1024, 64, 0.2
#: Words whose counts every task holds (16 bytes each); the counts of all others are joined.
TABLE = 1 << 18
#: Tokens held at a time; parameters in a slice of the averaging; bytes of short texts hashed together.
CHUNK, SLICE, JOINED = 1 << 19, 4096, 1 << 16


def tokens(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text the 64-bit hashes of its words, A-Z lower-cased, and a number below TAILS that their last three bytes give."""
    at = 0
    while at < len(texts):
        parts, sizes = [], []
        while at < len(texts) and sum(sizes) < JOINED:
            parts.append((texts[at] or "").encode("utf-8", "surrogatepass"))
            sizes.append(len(parts[-1]) + 1)
            at += 1
        data = np.frombuffer(b"\n".join(parts).lower(), np.uint8)
        edge = np.diff(SPACES[data].view(np.int8), prepend=1, append=1)
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        runs = Runs(BYTES[data])
        lengths = (ends - starts).astype(np.uint64)
        words = mix(runs.hashes(starts, ends) ^ lengths)
        tails = mix(runs.hashes(np.maximum(starts, ends - 3), ends) ^ np.minimum(lengths, np.uint64(3)))
        tails = (tails % np.uint64(TAILS)).astype(np.uint8)
        edges = np.searchsorted(starts, np.append(0, np.cumsum(sizes)))
        for low, high in zip(edges[:-1], edges[1:]):
            yield words[low:high], tails[low:high]


def count_words(docs: DataFrame) -> DataFrame:
    """word (64-bit hash), tail, c: counts of all words of all texts, written once."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def combined() -> pd.DataFrame:
            words, tails = (np.concatenate(parts) for parts in zip(*held))
            words, at, n = np.unique(words, return_index=True, return_counts=True)
            return pd.DataFrame({"word": words.view(np.int64), "tail": tails[at].astype(np.int16), "c": n})

        for frame in frames:
            for found in tokens(list(frame["text"])):
                held.append(found)
                size += len(found[0])
                if size >= CHUNK or len(held) > 1 << 14:
                    yield combined()
                    held, size = [], 0
        if held:
            yield combined()

    counted = docs.select("text").mapInPandas(partial, "word long, tail short, c long")
    return saved(counted.groupBy("word").agg(F.min("tail").alias("tail"), F.sum("c").alias("c")))


@dataclass
class Vocabulary:
    """Counts of fixed size: the table of frequent words, the heads among them, the totals of the tails."""

    words: np.ndarray  # sorted hashes of the table
    counts: np.ndarray  # their counts
    heads: np.ndarray  # their class if they have their own, else -1
    ends: int  # training documents
    tail_counts: np.ndarray  # tokens of each tail's words
    tail_words: np.ndarray  # distinct words of each tail
    least: int  # words with this count and more are in the table
    n_heads: int

    @property
    def total(self) -> int:
        """Training tokens, ends included."""
        heads = self.counts[self.heads > 0].sum() if len(self.heads) else 0
        return int(self.ends + heads + self.tail_counts.sum())

    @property
    def distinct(self) -> int:
        return int((self.ends > 0) + (self.heads > 0).sum() + self.tail_words.sum())

    @property
    def classes(self) -> int:
        return self.n_heads + TAILS

    def weights(self) -> np.ndarray:
        """Smoothed counts of the classes."""
        found = np.zeros(self.classes)
        found[0] = self.ends
        own = self.heads > 0
        found[self.heads[own]] = self.counts[own]
        found[self.n_heads :] = self.tail_counts
        return found + 0.5

    def tail_sizes(self) -> np.ndarray:
        """What the smoothed counts of a tail's words, an unseen one among them, add up to."""
        return self.tail_counts + 0.5 * (self.tail_words + 1)

    def look_up(self, words: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and count of each word; a word outside the table has the count -1."""
        if not len(self.words):
            return self.n_heads + tails.astype(np.int32), np.full(len(words), -1, np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        known = self.words[at] == words
        head = np.where(known, self.heads[at], -1)
        classes = np.where(head > 0, head, self.n_heads + tails.astype(np.int32))
        return classes.astype(np.int32), np.where(known, self.counts[at], -1)


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """The most frequent words, as many classes of counts as fit in TABLE. What reaches the driver has a fixed size."""
    sizes = counts.groupBy(F.floor(4 * F.log2("c")).alias("size")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least"))
    room, least = TABLE, None
    for row in sorted(sizes.collect(), key=lambda row: -row["size"]):
        room -= row["n"]
        if room < 0:
            break
        least = row["least"]
    frame = counts.where(F.col("c") >= (least if least is not None else 1 << 62)).toPandas()
    words, tails, c = frame["word"].to_numpy(np.int64).view(np.uint64), frame["tail"].to_numpy(np.int64), frame["c"].to_numpy(np.int64)
    order = np.argsort(words)
    words, tails, c = words[order], tails[order], c[order]
    heads = np.full(len(words), -1, np.int32)
    best = np.lexsort((words, -c))[: HEADS - 1]
    heads[best] = np.arange(1, len(best) + 1)
    tail_counts, tail_words = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
    for row in counts.groupBy("tail").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        tail_counts[row["tail"]], tail_words[row["tail"]] = row["c"], row["n"]
    np.subtract.at(tail_counts, tails[best], c[best])
    np.subtract.at(tail_words, tails[best], 1)
    return Vocabulary(words, c, heads, ends, tail_counts, tail_words, least if least is not None else 1 << 62, len(best) + 1)


class Network:
    """Parameters in one vector: class vectors, context vectors, context weights, class biases."""

    def __init__(self, weights: np.ndarray, flat: np.ndarray | None = None) -> None:
        k = len(weights)
        self.shapes = [(k, WIDTH), (k, WIDTH), (CONTEXT, WIDTH), (k,)]
        if flat is None:
            random = np.random.default_rng(7)
            start = [random.normal(0, 0.1, (k, WIDTH)), random.normal(0, 0.1, (k, WIDTH)), np.ones((CONTEXT, WIDTH)), np.log(weights / weights.sum())]
            flat = np.concatenate([part.ravel() for part in start])
        self.flat = flat.astype(np.float32)
        edges = np.cumsum([0, *(int(np.prod(shape)) for shape in self.shapes)])
        self.out, self.context, self.weight, self.bias = (
            self.flat[a:b].reshape(shape) for a, b, shape in zip(edges[:-1], edges[1:], self.shapes)
        )

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        """The vector predicted from each row of context classes, nearest first."""
        found = self.weight[0] * self.context[contexts[:, 0]]
        for i in range(1, CONTEXT):
            found += self.weight[i] * self.context[contexts[:, i]]
        return found

    def log_probabilities(self, contexts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Natural log probabilities of classes given contexts, normalised over all classes.

        A logit is a sum of one number for each context word, so its exp is a product of CONTEXT table entries (classes x
        classes each, scaled to 1 at most). Tokens whose products all but vanish are reckoned from their logits.
        """
        logits = [(self.weight[i] * self.context) @ self.out.T for i in range(CONTEXT)]
        logits[0] += self.bias
        tops = [table.max(axis=1) for table in logits]
        exps = [np.exp(table - top[:, None]) for table, top in zip(logits, tops)]
        sums = np.empty(len(classes), np.float32)
        held, factor = (np.empty((256, len(self.bias)), np.float32) for _ in range(2))
        for at in range(0, len(classes), 256):
            rows = contexts[at : at + 256]
            product, other = held[: len(rows)], factor[: len(rows)]
            np.take(exps[0], rows[:, 0], axis=0, out=product, mode="clip")
            for i in range(1, CONTEXT):
                np.take(exps[i], rows[:, i], axis=0, out=other, mode="clip")
                if i < CONTEXT - 1:
                    product *= other
            sums[at : at + len(rows)] = np.vecdot(product, other)
        found = -np.log(np.maximum(sums, 1e-30).astype(np.float64))
        for i, (table, top) in enumerate(zip(logits, tops)):
            found += table[contexts[:, i], classes].astype(np.float64) - top[contexts[:, i]]
        far = np.flatnonzero(sums < 1e-30)
        found[far] = self.shifted_log_probabilities(contexts[far], classes[far])
        return found

    def shifted_log_probabilities(self, contexts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The same at any size of the logits."""
        found = np.empty(len(classes))
        for at in range(0, len(classes), 256):
            rows = slice(at, at + 256)
            h = self.predicted(contexts[rows])
            logits = h @ self.out.T + self.bias
            own = logits[np.arange(len(h)), classes[rows]].astype(np.float64)
            shift = logits.max(axis=1, keepdims=True)
            sums = np.exp(logits - shift).sum(axis=1, dtype=np.float64)
            found[rows] = own - shift[:, 0] - np.log(sums)
        return found


def add_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")  # classes are few: 16 bits are sorted by digits
    sorted_rows = rows[order]
    starts = np.flatnonzero(np.diff(sorted_rows, prepend=-1))
    return sorted_rows[starts], np.add.reduceat(values[order], starts, axis=0)


class Trainer:
    """Noise-contrastive steps with one step size a row, lowered by the gradients seen (Adagrad)."""

    def __init__(self, network: Network, weights: np.ndarray, seed: int) -> None:
        self.net = network
        share = weights / weights.sum()
        self.log_noise = np.log(NOISE * share).astype(np.float32)
        self.edges = np.cumsum(share)
        self.random = np.random.default_rng(seed)
        k = len(weights)
        self.seen = {"out": np.full(k, 1e-3, np.float32), "context": np.full(k, 1e-3, np.float32), "bias": np.full(k, 1e-1, np.float32), "weight": np.full(CONTEXT, 1.0, np.float32)}

    def gradients(self, contexts: np.ndarray, classes: np.ndarray, noise: np.ndarray):
        """Of the log-likelihood that a token is told from noise; (rows, sums) of the out, bias and context rows, and of the weights."""
        net = self.net
        h = net.predicted(contexts)
        own, others = net.out[classes], net.out[noise]
        real = (h * own).sum(axis=1) + net.bias[classes] - self.log_noise[classes]
        false = h @ others.T + (net.bias[noise] - self.log_noise[noise])
        g = 1 / (1 + np.exp(np.clip(real, -30, 30)))
        e = np.clip(np.negative(false, out=false), -30, 30, out=false)
        np.exp(e, out=e)
        e += 1
        np.divide(-1, e, out=e)
        back = g[:, None] * own + e @ others
        both = np.concatenate([classes, noise])
        values = np.empty((len(both), WIDTH + 1), np.float32)
        values[: len(classes), :WIDTH], values[: len(classes), WIDTH] = g[:, None] * h, g
        values[len(classes) :, :WIDTH], values[len(classes) :, WIDTH] = e.T @ h, e.sum(axis=0)
        rows, sums = add_rows(both, values)
        vectors = [net.context[contexts[:, i]] for i in range(CONTEXT)]
        at, context = add_rows(contexts.T.ravel(), np.concatenate([net.weight[i] * back for i in range(CONTEXT)]))
        weight = np.stack([(back * v).sum(axis=0) for v in vectors])
        return rows, sums[:, :WIDTH], sums[:, WIDTH], at, context, weight

    def step(self, contexts: np.ndarray, classes: np.ndarray) -> None:
        noise = np.minimum(np.searchsorted(self.edges, self.random.random(NOISE)), len(self.edges) - 1)
        rows, out, bias, at, context, weight = self.gradients(contexts, classes, noise)
        net, seen = self.net, self.seen
        seen["out"][rows] += (out * out).mean(axis=1)
        seen["bias"][rows] += bias * bias
        seen["context"][at] += (context * context).mean(axis=1)
        seen["weight"] += (weight * weight).mean(axis=1)
        net.out[rows] += RATE * out / np.sqrt(seen["out"][rows])[:, None]
        net.bias[rows] += 0.3 * RATE * bias / np.sqrt(seen["bias"][rows])
        net.context[at] += RATE * context / np.sqrt(seen["context"][at])[:, None]
        net.weight += 0.3 * RATE * weight / np.sqrt(seen["weight"])[:, None]

    def run(self, contexts: np.ndarray, classes: np.ndarray) -> None:
        order = self.random.permutation(len(classes))
        for at in range(0, len(order), STEP):
            chosen = order[at : at + STEP]
            self.step(contexts[chosen], classes[chosen])


def examples(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Contexts (nearest first) and classes of all tokens of documents given as classes; class 0 stands before and after a text."""
    pad = np.zeros(CONTEXT, np.int32)
    flat = np.concatenate([part for classes in documents for part in (pad, classes)] + [pad[:1]])
    sizes = np.array([len(classes) for classes in documents])
    after = np.cumsum(sizes + CONTEXT)
    # A text's end is the first 0 after it: the next text's padding, or the one added last.
    inside = np.ones(len(flat), bool)
    for i in range(CONTEXT):
        inside[after - sizes - CONTEXT + i] = False
    inside[after] = True
    at = np.flatnonzero(inside)
    return np.stack([flat[at - 1 - i] for i in range(CONTEXT)], axis=1), flat[at]


@dataclass
class Model:
    vocabulary: Vocabulary
    network: Network
    counts: DataFrame


def train(docs: DataFrame, words: Vocabulary) -> Network:
    """Every text is a training text of one round. Tasks start a round from one network and send theirs in slices of SLICE numbers,
    weighted by their tokens; a slice is averaged as a stream. A network of fixed size comes to the driver.
    """
    weights = words.weights()
    network = Network(weights)
    rows = docs.select("text", (F.pmod(F.xxhash64("text"), F.lit(ROUNDS))).alias("round"))
    for number in range(ROUNDS):
        start = network.flat.copy()

        def learned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            context = TaskContext.get()
            own = Network(weights, start)
            trainer = Trainer(own, weights, 1 + (context.partitionId() if context else 0))
            held, size, total = [], 0, 0
            for frame in frames:
                for found in tokens(list(frame["text"])):
                    held.append(words.look_up(*found)[0])
                    size += len(held[-1]) + 1
                    if size >= CHUNK:
                        trainer.run(*examples(held))
                        held, total, size = [], total + size, 0
            if held:
                trainer.run(*examples(held))
            total += size
            for at in range(0, len(own.flat) if total else 0, SLICE):
                yield pd.DataFrame({"at": [at], "n": [total], "values": [own.flat[at : at + SLICE].tobytes()]})

        def averaged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[int, np.ndarray] = {}
            sizes: dict[int, int] = {}
            for frame in frames:
                for at, n, values in zip(frame["at"], frame["n"], frame["values"]):
                    values = n * np.frombuffer(values, np.float32).astype(np.float64)
                    sums[at] = sums[at] + values if at in sums else values
                    sizes[at] = sizes.get(at, 0) + n
            for at, values in sums.items():
                yield pd.DataFrame({"at": [at], "values": [(values / sizes[at]).tobytes()]})

        found = rows.where(F.coalesce("round", F.lit(0)) == number).mapInPandas(learned, "at int, n long, values binary")
        for row in found.repartition("at").mapInPandas(averaged, "at int, values binary").collect():
            values = np.frombuffer(row["values"], np.float64)
            network.flat[row["at"] : row["at"] + len(values)] = values
    return network


def learn(docs: DataFrame) -> Model:
    """Word counts and network of all given texts; null texts are empty ones. Without any text all words are unseen and alike."""
    counts = count_words(docs)
    words = vocabulary(counts, docs.count())
    return Model(words, train(docs, words), counts)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every whole text, logs to the base 10.

    base_score adds log10((c + 0.5) / (N + 0.5 (V + 1))) of all tokens, score the model's log probabilities. Null, empty and blank texts
    are their end alone; equal rows and null ids give a row each; other columns are left aside. Words beyond the table
    meet the count table by a join on their hash, one row a text and word.
    """
    words, network = model.vocabulary, model.network
    total, distinct, end = words.total, words.distinct, np.log10(words.ends + 0.5)
    inside = np.log10(words.tail_sizes())

    def rows_of(ids: list, found: list[tuple], first: int) -> pd.DataFrame:
        contexts, classes = examples([classes for classes, _, _ in found])
        logs = network.log_probabilities(contexts, classes) / np.log(10)
        tail = classes - words.n_heads
        logs[tail >= 0] -= inside[tail[tail >= 0]]
        sizes = np.array([len(classes) + 1 for classes, _, _ in found])
        model_part = np.add.reduceat(logs, np.cumsum(sizes) - sizes)
        rows = []
        for (classes, counts, hashes), size, part in zip(found, sizes, model_part):
            there = counts >= 0
            logs10 = np.log10(counts[there] + 0.5)
            own = classes[there] >= words.n_heads
            rare, times = np.unique(hashes[~there], return_counts=True)
            rows.append((int(size), int(there.sum()) + (words.ends > 0), end + logs10.sum(), part + logs10[own].sum(), rare.view(np.int64), times))
        frame = pd.DataFrame(rows, columns=["n_tokens", "n_known", "base", "model", "rare", "times"])
        return frame.assign(doc_id=ids, row=np.arange(first, first + len(ids)))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        ids, found, size = [], [], 0
        for frame in frames:
            for doc_id, (hashes, tails) in zip(frame["doc_id"], tokens(list(frame["text"]))):
                ids.append(doc_id)
                found.append((*words.look_up(hashes, tails), hashes))
                size += len(hashes) + 1
                if size >= CHUNK or len(ids) >= 1 << 13:
                    yield rows_of(ids, found, number)
                    number += len(ids)
                    ids, found, size = [], [], 0
        if ids:
            yield rows_of(ids, found, number)

    schema = "row long, doc_id string, n_tokens long, n_known long, base double, model double, rare array<long>, times array<long>"
    texts = saved(texts_with_id(docs).mapInPandas(scored, schema))
    unseen = F.log10(F.lit(0.5))
    rare = texts.select("row", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("times"))))
    met = rare.join(model.counts.where(F.col("c") < words.least).select("word", "c"), "word")
    sums = met.groupBy("row").agg(F.sum("times").alias("seen"), F.sum(F.col("times") * (F.log10(F.col("c") + 0.5) - unseen)).alias("gain"))
    beyond = F.aggregate("times", F.lit(0).cast("long"), lambda a, n: a + n) * unseen + F.coalesce("gain", F.lit(0.0))
    size = float(np.log10(total + 0.5 * (distinct + 1)))
    return with_long_id(
        texts.join(sums, "row", "left").select(
            "doc_id",
            "n_tokens",
            (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + beyond - F.col("n_tokens") * size).alias("base_score"),
            (F.col("model") + beyond).alias("score"),
        )
    )

"""Language-model scores, filter audit and periodic runs against plain versions, with odd inputs."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from reelmetrics.llm import filteraudit, lm, periodic
from reelmetrics.llm.queries import ORACLE, QUERIES

ODD = [
    (1, "Hello  world\n\nagain", "x"),
    (2, None, "x"),
    (3, "", None),
    (4, " \t\n", ""),
    (5, "long " * 5000, "x"),
    (1, "Hello  world\n\nagain", "x"),
    (None, "été 日本 \x1c ▁ 😀 12", "x"),
    (None, "été 日本 \x1c ▁ 😀 12", None),
    (9, "Hello  world\n\nagain", "y"),
    (7, "HELLO $ WORLD", "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, long, repeated and id-less rows; extra columns with the names of results."""
    schema = "doc_id long, text string, lang string, score double, n_words int, word string, mask int, runs int, salt int"
    return spark.createDataFrame([(*row, 0.5, 7, "w", 1, 2, 3) for row in ODD], schema)


def rows_of(frame, *names):
    return sorted((tuple(row[name] for name in names) for row in frame.collect()), key=repr)


# Language-model scores

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_tokens(text):
    return [*WORDS.findall((text or "").encode().lower()), None]


def plain_base(training, texts):
    counts = collections.Counter(t for text in training for t in plain_tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    below = math.log10(total + 0.5 * (distinct + 1))
    return [
        (len(tokens), sum(counts[t] > 0 for t in tokens), total, sum(math.log10(counts[t] + 0.5) - below for t in tokens))
        for tokens in map(plain_tokens, texts)
    ]


@pytest.mark.parametrize("table", [0, 3, 1 << 18])
def test_base_scores_equal_plain_counts_with_any_table(spark, odd, monkeypatch, table):
    """Words in the table and words that are joined give the same sums."""
    monkeypatch.setattr(lm, "TABLE", table)
    texts = ["a b b c c c d d d d", "Hello q q", None, "b\tz long A"]
    training = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = lm.score(odd, lm.learn(training))
    expected = plain_base(texts, [text for _, text, _ in ODD])
    rows = rows_of(found, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    want = sorted(((row[0], *e) for row, e in zip(ODD, expected)), key=repr)
    assert [r[:4] for r in rows] == [w[:4] for w in want]
    assert np.allclose([r[4] for r in rows], [w[4] for w in want])
    assert all(r[5] < 0 and math.isfinite(r[5]) for r in rows)


def test_no_training_rows_and_empty_tables(spark, odd):
    model = lm.learn(odd.where("false"))
    assert {r["train_tokens"] for r in lm.score(odd, model).collect()} == {0}
    assert all(abs(r["base_score"]) < 1e-9 for r in lm.score(odd, model).collect())
    assert lm.score(odd.where("false"), model).count() == 0


def test_model_probabilities_add_up_to_one(spark):
    """All words of the vocabulary, an unseen one of each tail and the end, after any context."""
    texts = [" ".join(random.Random(i).choices("the of cat dog running jumping a b".split(), k=30)) for i in range(40)]
    model = lm.learn(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    words = model.vocabulary
    contexts = np.array([[0, 0, 0], [1, 2, 3], [4, 0, 0]], np.int32)
    classes = np.arange(words.classes, dtype=np.int32)
    for context in contexts:
        logs = model.network.log_probabilities(np.repeat(context[None], words.classes, axis=0), classes)
        assert np.isclose(np.exp(logs).sum(), 1, atol=1e-4)
    assert np.allclose(words.tail_sizes(), words.tail_counts + 0.5 * words.tail_words + 0.5)


def test_training_follows_the_gradient_of_the_noise_contrastive_likelihood():
    random_ = np.random.default_rng(1)
    weights = random_.random(lm.HEADS) + 0.5
    network = lm.Network(weights)
    network.flat[:] += random_.normal(0, 0.3, len(network.flat)).astype(np.float32)
    trainer = lm.Trainer(network, weights, 1)
    contexts, classes = random_.integers(0, 9, (20, lm.CONTEXT)), random_.integers(0, 9, 20)
    noise = random_.integers(0, 9, lm.NOISE)
    log_noise = np.log(lm.NOISE * weights / weights.sum())

    def likelihood():
        out, context, weight, bias = (part.astype(float) for part in (network.out, network.context, network.weight, network.bias))
        h = sum(weight[i] * context[contexts[:, i]] for i in range(lm.CONTEXT))
        real = (h * out[classes]).sum(1) + bias[classes] - log_noise[classes]
        false = h @ out[noise].T + bias[noise] - log_noise[noise]
        return -np.log1p(np.exp(-real)).sum() - np.log1p(np.exp(false)).sum()

    rows, out, bias, at, context, weight = trainer.gradients(contexts, classes, noise)
    for part, where, value in (
        (network.out, (rows[2], 5), out[2, 5]),
        (network.bias, (rows[1],), bias[1]),
        (network.context, (at[3], 7), context[3, 7]),
        (network.weight, (1, 4), weight[1, 4]),
    ):
        before = part[where]
        part[where] = before + np.float32(0.01)
        high = likelihood()
        part[where] = before - np.float32(0.01)
        low = likelihood()
        part[where] = before
        assert math.isclose((high - low) / 0.02, value, rel_tol=0.02, abs_tol=0.02)


def test_normalising_takes_exps_of_classes_not_of_tokens(monkeypatch):
    """Log probabilities at small, large and opposed logits as in double precision; their cost in exps does not grow with the tokens."""
    random = np.random.default_rng(5)
    contexts, classes = random.integers(0, 40, (20_000, lm.CONTEXT)), random.integers(0, 40, 20_000)
    for scale in (0.3, 2.0, 9.0):
        network = lm.Network(random.random(40) + 0.5)
        network.out[:], network.context[:] = random.normal(0, scale, (2, 40, lm.WIDTH))
        network.bias += 30 * scale
        taken, exp = [0], np.exp

        def counted(x, *args, **named):
            taken[0] += np.size(x)
            return exp(x, *args, **named)

        monkeypatch.setattr(np, "exp", counted)
        found = network.log_probabilities(contexts, classes)
        monkeypatch.setattr(np, "exp", exp)
        h = sum((network.weight[i] * network.context)[contexts[:, i]].astype(float) for i in range(lm.CONTEXT))
        logits = h @ network.out.T.astype(float) + network.bias
        logits -= logits.max(axis=1, keepdims=True)
        wanted = logits[np.arange(len(classes)), classes] - np.log(np.exp(logits).sum(axis=1))
        assert np.allclose(found, wanted, rtol=1e-5, atol=1e-4 * scale)
        assert scale > 1 or taken[0] <= lm.CONTEXT * 40 * 40
    assert len(network.log_probabilities(contexts[:0], classes[:0])) == 0


def test_model_beats_unigrams_on_held_out_texts(spark, sf_dir):
    found = QUERIES["op11_lm"](spark, sf_dir.replace("sf0.001", "sf0.01")).toPandas()
    unseen = found[found["held_out"]]
    assert len(found) == 1000 and 100 < len(unseen) < 300
    assert unseen["score"].sum() > 0.97 * unseen["base_score"].sum()


# Filter audit


def plain_audit(rows, labels):
    docs = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            *("A" if len(words) < 200 else ""),
            *("B" if 100 * len(set(words)) < 50 * len(words) else ""),
            *("C" if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text) else ""),
            *("D" if set(text) & set("#$%&*|") else ""),
        }
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
            failed.add("E")
        own = [label for label in labels if doc_id is not None and label[0] == doc_id]
        docs.append((lang or "", failed, any(q == 1 for _, q, _ in own), any(t == 1 for _, _, t in own)))
    found = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                out = [d for d in left if letter in d[1]]
                redundant = sum(letter in d[1] for d in mine) - len(out)
                left = [d for d in left if letter not in d[1]]
                alone = sum(d[1] == {letter} for d in mine)
                found.append((part, order, step, len(left), len(out), redundant, alone, sum(d[2] for d in out), sum(d[3] for d in out)))
    total = collections.Counter()
    for row in found:
        total[row[0], row[1][row[2] - 1]] += row[4]
    return sorted(((*row, total[row[0], row[1][row[2] - 1]]) for row in found), key=repr)


def test_audit_equals_plain_filters_on_odd_rows(spark, odd):
    labels = [(1, 1, 0), (1, 0, 1), (5, 1, 1), (None, 1, 1), (9, None, 1), (77, 1, 1)]
    frame = spark.createDataFrame([(*row, "z") for row in labels], "doc_id long, quality int, toxic int, part string")
    found = rows_of(filteraudit.audit(odd, frame), "part", "filter_order", "step", *filteraudit.COUNTS, "shapley")
    assert found == plain_audit(ODD, labels)
    assert filteraudit.audit(odd.where("false"), frame).count() == 0
    assert len(filteraudit.audit(odd, frame.where("false")).collect()) == 600 * len({lang or "" for _, _, lang in ODD})


def test_audit_twin_on_odd_rows(spark, odd):
    docs, labels = odd.toPandas(), spark.createDataFrame([(1, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int").toPandas()
    twin = duckdb.connect()
    twin.register("documents", docs.astype({"doc_id": "Int64"}))
    twin.register("labels", labels)
    found = [tuple(row) for row in twin.execute(ORACLE["op12_filter_audit"]).fetchall()]
    assert sorted(found, key=repr) == plain_audit(ODD, [(1, 1, 0), (5, 1, 1)])


def test_orders_of_few_filters_and_too_many(spark):
    cells = spark.createDataFrame([("x", 1, 2, 1, 0), ("x", 3, 4, 0, 0), ("x", 0, 5, 5, 5)], "part string, mask int, docs long, good long, toxic long")
    found = rows_of(filteraudit.interactions(cells, "PQ"), "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "shapley")
    assert found == [("PQ", 1, 5, 6, 0, 2, 8), ("PQ", 2, 5, 0, 4, 0, 4), ("QP", 1, 7, 4, 0, 0, 4), ("QP", 2, 5, 2, 4, 2, 8)]
    with pytest.raises(ValueError):
        filteraudit.interactions(cells, "ABCDEFG")


# Periodic runs


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_words(source):
    words = []
    while len(words) < source.randint(1, 300):
        unit = [str(source.randrange(source.choice([1, 2, 3, 40]))) for _ in range(source.randint(1, 50))]
        if source.random() < 0.5:
            unit = ["a"] * source.randint(1, 20) + unit
        words += (unit * source.randint(1, 6))[: source.randint(1, 200)]
    return words


def test_runs_equal_all_periods_tried():
    source = random.Random(4)
    for _ in range(150):
        documents = [[w.encode() for w in periodic_words(source)] for _ in range(source.randint(1, 5))]
        for words, found in zip(documents, periodic.together(documents)):
            assert [tuple(map(int, row)) for row in found] == plain_runs(words)


def test_range_successor_and_equal_stretches():
    source = np.random.default_rng(2)
    values = source.permutation(200)
    matrix = periodic.WaveletMatrix(values)
    low, least = source.integers(0, 200, 400), source.integers(0, 230, 400)
    high = np.minimum(low + source.integers(0, 40, 400), 200)
    want = [min([v for v in values[a:b] if v >= x], default=200) for a, b, x in zip(low, high, least)]
    assert matrix.successor(low, high, least).tolist() == want
    sequence = np.append(source.integers(0, 2, 120), 9)
    suffixes = periodic.Suffixes(sequence)
    assert suffixes.order.tolist() == sorted(range(121), key=lambda i: sequence[i:].tolist())
    for a, b in source.integers(0, 120, (60, 2)):
        if a != b:
            forward = next(i for i in range(121) if max(a, b) + i >= 121 or sequence[a + i] != sequence[b + i])
            backward = next(i for i in range(121) if min(a, b) - i <= 0 or sequence[a - 1 - i] != sequence[b - 1 - i])
            assert suffixes.forward(np.array([a]), np.array([b]))[0] == forward
            assert suffixes.backward(np.array([a]), np.array([b]))[0] == backward


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_digests_of_odd_and_planted_rows(spark, odd):
    source = random.Random(8)
    rows = [(row[0], row[1]) for row in ODD] + [(i, " ".join(periodic_words(source))) for i in range(100, 180)]
    rows += [(i, " ".join(str(source.randrange(500)) for _ in range(60))) for i in range(200, 280)]
    docs = odd.select("doc_id", "text", "runs").unionByName(spark.createDataFrame([(*row, 1) for row in rows[len(ODD) :]], "doc_id long, text string, runs int"))
    found = periodic.digest(periodic.periodic_runs(periodic.with_planted_runs(docs)))
    want = [plain_digest(*row) for row in rows]
    assert rows_of(found, *COLUMNS) == sorted(want, key=repr)
    assert sum(row[1] > 0 for row in want) > 20
    assert periodic.periodic_runs(odd.where("false")).count() == 0


def test_one_very_long_text_keeps_its_runs(spark):
    """A text longer than a sequence: 300,000 words, a stretch of 90,000 with the period 20,000 in it."""
    source = random.Random(1)
    unit = [str(source.randrange(10**6)) for _ in range(20_000)]
    words = [f"x{i}" for i in range(100_000)] + (unit * 5)[:90_000] + [f"y{i}" for i in range(110_000)]
    row = periodic.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).collect()[0]
    assert [tuple(r) for r in row["runs"]] == [(100_000, 90_000, 20_000)]
    assert row["collapsed"] == " ".join(words[:120_000] + words[190_000:])


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_periodic_runs"])
def test_twins(spark, sf_dir, name):
    from oracle_check import connect, difference

    assert difference(QUERIES[name](spark, sf_dir).toPandas(), connect(sf_dir).execute(ORACLE[name]).df()) is None

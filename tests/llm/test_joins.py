"""Joins of vectors, shingle sets, lines, licenses and benchmark items against brute force, with odd inputs."""

from __future__ import annotations

import random
import re
import textwrap
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from reelmetrics.llm import common, decontam, jaccard, licenses, linededup, vectors
from reelmetrics.llm.common import released, saved
from reelmetrics.llm.components import components, linked_groups
from reelmetrics.llm.queries import ORACLE, QUERIES


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# Work tables


def work_tables(spark):
    """Folders of the work tables that are there."""
    return set(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")).glob("llm-*"))


def test_released_keeps_what_it_returns(spark):
    before = work_tables(spark)

    def inner():
        return saved(spark.range(3)), saved(spark.range(4)).where("id > 1")

    def outer():
        saved(spark.range(9))
        a, b = released(inner)
        assert len(work_tables(spark) - before) == 3  # the range of 4 is gone, what was taken of it is there
        return a, a.join(b, "id")

    a, b = released(outer)
    assert (a.count(), b.count(), len(work_tables(spark) - before)) == (3, 1, 2)
    alone = saved(spark.range(2))

    def broken():
        saved(spark.range(9))
        raise ValueError

    with pytest.raises(ValueError):
        released(broken)
    assert alone.count() == 2 and len(work_tables(spark) - before) == 3


def test_work_tables_go_with_their_step(spark, monkeypatch):
    """When texts are read again the first table of prefixes is gone; results leave narrow tables only."""
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[i:] + [f"x{i}"] * (i % 3))) for i in range(40)] + [(50, None), (51, "")]
    docs = spark.createDataFrame([(i, f"{t}\nline {i} of its own, unlike the others" if t else t) for i, t in rows], "doc_id long, text string")
    before, seen = work_tables(spark), []

    def columns():
        return [set(spark.read.parquet(str(path)).columns) for path in work_tables(spark) - before]

    exact = jaccard.contents
    monkeypatch.setattr(jaccard, "contents", lambda *a: (seen.append(columns()), exact(*a))[1])
    assert jaccard.one_of_each(docs, 3, 80).count() < len(rows)
    assert seen and all(sum("prefix" in c for c in own) == 1 and not any("own" in c for c in own) for own in seen)
    assert not any({"prefix", "own", "at", "row"} & c for c in columns())
    assert linededup.dedup_lines(docs).count() == len(rows)
    assert not any({"keys", "body", "line"} & c for c in columns())


def test_work_tables_of_a_turn_go_with_it(spark):
    """Numbers that take several turns: a turn adds its links and groups to what stays, not its buckets, pairs and rounds."""
    numbers = [3 * i for i in range(20)] + list(range(100, 140))
    rows = spark.createDataFrame([(1, n) for n in numbers], "key long, node long")
    before, seen = work_tables(spark), []

    def verify(pairs):
        seen.append(len(work_tables(spark) - before))
        return pairs.where("abs(a - b) in (1, 7)")

    linked_groups(rows, rows.select("node").distinct(), lambda x, y: "true", verify)
    assert len(seen) == 3 and seen[2] <= seen[0] + 6


# Components


def test_components_of_chains_stars_and_noise(spark):
    random.seed(5)
    links = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    links += [(random.randint(200, 400), random.randint(200, 400)) for _ in range(150)]
    real = [(a, b) for a, b in links if a is not None and a != b]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == least_reachable({n for pair in real for n in pair}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_linked_groups_keep_links_between_any_members(spark):
    """A bucket of 60 numbers, linked when they differ by 1 or 7: found without comparing all pairs."""
    numbers = [3 * i for i in range(20)] + list(range(100, 140))
    rows = spark.createDataFrame([(1, n) for n in numbers] + [(2, 5)], "key long, node long")
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.where("abs(a - b) in (1, 7)")

    links = [(a, b) for a in numbers for b in numbers if a < b and b - a in (1, 7)]
    nodes = {n for pair in links for n in pair}
    found = {r["node"]: r["component"] for r in linked_groups(rows, rows.select("node").distinct(), lambda x, y: "true", verify).collect()}
    assert found == least_reachable(nodes, links)


def test_copies_of_one_text_are_united_by_it(spark):
    """200 nodes that link with node 0 alone: it shares the most keys, so the first turn finds all links and no pairs are left."""
    rows = spark.createDataFrame([(1, n) for n in range(201)] + [(2 + n % 7, n) for n in range(1, 201)] + [(k, 0) for k in range(2, 9)], "key long, node long")
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.where("a = 0")

    found = linked_groups(rows, rows.select("node").distinct(), lambda x, y: "true", verify).collect()
    assert len(found) == 201 and {r["component"] for r in found} == {0}
    assert sum(seen) < 3000  # all pairs would be 20,100


# Vectors


def brute_vectors(rows, threshold):
    usable = {}
    for i, (key, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    links = [
        (i, j) for i in usable for j in usable
        if i < j and len(usable[i]) == len(usable[j]) and float(usable[i] @ usable[j]) >= threshold
    ]
    counts = [sum(i in pair for pair in links) for i in range(len(rows))]
    groups = least_reachable(range(len(rows)), links)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[groups[i]] = min(key, least.get(groups[i], key))
    return sorted(((key, counts[i], least.get(groups[i], key)) for i, (key, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("block", [7, 4096])
def test_vectors_equal_brute_force(spark, block):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 40))
    rows = [(int(i), (base[i % 12] + rng.normal(size=40) * 0.25).tolist()) for i in range(90)]
    rows += [(200 + i, rows[0][1]) for i in range(5)] + [(300, None), (301, []), (302, [0.0] * 40), (303, [float("nan")] * 40)]
    rows += [(304, [None] + [1.0] * 39), (305, [float("inf")] + [1.0] * 39), (306, [1.0, 2.0]), (307, [2.0, 4.0]), (306, [1.0, 2.0])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, n_links int")
    found = vectors.near_duplicates(frame, 0.9, block).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=repr) == brute_vectors(rows, 0.9)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_vectors_of_empty_and_unusable_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicates(none).count() == 0
    rows = vectors.near_duplicates(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect()
    assert [tuple(r) for r in rows] == [(1, 0, 1, True)]


def shuffled(spark) -> dict[str, int]:
    """Bytes of every shuffle file that is on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = {}
    while files.hasNext():
        file = files.next()
        if file.getName().startswith("shuffle_"):
            found[file.getPath()] = file.length()
    return found


def test_shuffle_of_vectors_does_not_grow_with_the_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(2000, 64))
    rows = np.concatenate([base, base[:60] + rng.normal(size=(60, 64)) * 0.1]).astype(np.float32)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<float>")
    before, seen, write = shuffled(spark), {}, common.saved

    def watched(df, **options):
        out = write(df, **options)
        seen.update(shuffled(spark))
        return out

    for module in (common, vectors):
        monkeypatch.setattr(module, "saved", watched)
    found = {r["vec_id"]: r for r in vectors.near_duplicates(frame, 0.9, 130).collect()}
    written = sum(size for path, size in (seen | shuffled(spark)).items() if path not in before)
    assert written < 4 * rows.nbytes  # 16 blocks: a copy of every vector for each would be 16 and more
    assert all((found[i]["n_links"], found[i]["component_id"]) == (int(i < 60 or i >= 2000), i - 2000 * (i >= 2000)) for i in range(2060))


@pytest.mark.parametrize("element", ["float", "double", "int"])
def test_equal_vectors_are_one_node_whatever_their_type(spark, element):
    rows = [(9, [0, 3, 4]), (4, [0, 3, 4]), (None, [0, 3, 4]), (5, [4, -3, 0]), (2, [0, 30, 40]), (1, [3, 0, 0]), (7, [3, 0])]
    if element != "int":
        rows = [(key, [float(x) for x in v]) for key, v in rows] + [(3, [-0.0, 3.0, 4.0])]
    found = vectors.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<{element}>"), 0.9, 2).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=repr) == brute_vectors(rows, 0.9)


def test_links_of_a_task_are_counts_and_a_forest():
    """All pairs of a large group leave two rows a vector at most, whatever the tiles and the order of the blocks."""
    rng = np.random.default_rng(8)
    rows = np.concatenate([rng.normal(size=(1, 24)) + rng.normal(size=(700, 24)) * 0.02, rng.normal(size=(60, 24))])
    exact = vectors.unit_rows(rows[rng.permutation(760)])
    wanted = exact @ exact.T >= 0.9
    np.fill_diagonal(wanted, False)
    copies = rng.integers(1, 4, 760)
    links, starts = vectors.Links(), [300, 0, 500]
    for x in starts:
        for y in starts:
            if x <= y:
                sides = []
                for at in (x, y):
                    own = slice(at, {0: 300, 300: 500, 500: 760}[at])
                    rotated = exact[own].astype(np.float32)
                    nodes = np.arange(760)[own]
                    sides.append(((exact[own], rotated, vectors.heads(rotated, vectors.steps(24)[0])), links.place(at, nodes.tobytes(), copies[own].tobytes())))
                (left, a), (right, b) = sides
                for i, j in vectors.pairs_of_blocks(left, left if x == y else right, 0.9):
                    links.add(i + a, j + b)
    counts, kept = links.frames()
    assert dict(zip(counts["node"], counts["n"])) == {i: n for i, n in enumerate((wanted * copies).sum(1)) if n}
    groups = least_reachable(range(760), np.argwhere(wanted).tolist())
    assert least_reachable(range(760), list(zip(kept["node"].astype(int), kept["other"].astype(int)))) == groups
    assert len(kept) == 760 - len(set(groups.values() if isinstance(groups, dict) else groups))


def test_early_stop_loses_no_pair():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 48))
    base[100:200] = base[0] + rng.normal(size=(100, 48)) * rng.uniform(0.1, 0.6, (100, 1))
    exact = base / np.linalg.norm(base, axis=1, keepdims=True)
    i, j = vectors.near_pairs(exact.astype(np.float32), exact.astype(np.float32), exact, exact, 0.9)
    wanted = np.argwhere(np.einsum("ik,jk->ij", exact, exact) >= 0.9)
    assert set(zip(i.tolist(), j.tolist())) == set(map(tuple, wanted.tolist()))


# Shingle sets


def shingle_set(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if len(words) >= width else {tuple(words)}


def brute_jaccard(rows, width, threshold):
    sets = [shingle_set(text, width) for _, text in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])
    ]
    groups = least_reachable(range(len(rows)), links)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[groups[i]] = min(key, least.get(groups[i], key))
    return sorted(((key, len(sets[i]), least.get(groups[i], key)) for i, (key, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("width,threshold", [(3, 90), (5, 80)])
def test_jaccard_groups_equal_brute_force(spark, width, threshold):
    random.seed(7)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for base in range(6):
        text = random.choices(words, k=random.choice([20, 60, 150]))
        for _ in range(12):
            own = list(text)
            for _ in range(random.randint(0, 4)):
                own[random.randrange(len(own))] = random.choice(words)
            rows.append((len(rows), " ".join(own)))
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "One Two"), (504, "one two"), (505, "one"), (None, "ONE"), (3, rows[3][1]), (506, "É b c d e f"), (507, "é b c d e f")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, n int")
    found = jaccard.jaccard_groups(frame, width, threshold).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_jaccard(rows, width, threshold)
    kept = jaccard.one_of_each(frame, width, threshold)
    assert kept.columns == frame.columns
    expected = {(key, text) for key, text in rows for k, _, c in [next(b for b in brute_jaccard(rows, width, threshold) if b[0] == key)] if k == c}
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == expected
    assert jaccard.jaccard_groups(frame.limit(0), width, threshold).count() == 0


# Lines


def edit_distance(a, b):
    while a and b and a[-1] == b[-1] and len(a) > 1000:
        cut = next((n for n in (len(a) // 2, 1) if a[-n:] == b[-n:] and n < len(b)), 0)
        if not cut:
            break
        a, b = a[:-cut], b[:-cut]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(text, edits, letters="abcé"):
    own = list(text)
    for _ in range(edits):
        at = random.randrange(len(own) + 1)
        how = random.random()
        if how < 0.4:
            own.insert(at, random.choice(letters))
        elif at < len(own) and how < 0.7 and len(own) > 1:
            del own[at]
        elif at < len(own):
            own[at] = random.choice(letters)
    return "".join(own)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance_and_segments(edits):
    random.seed(edits)
    for _ in range(3000):
        a = "".join(random.choice("abc") for _ in range(random.randint(edits + 1, 25)))
        b = changed(a, random.randint(0, edits + 2))
        near = edit_distance(a, b) <= edits
        assert linededup.within(a, b, edits) == near, (a, b)
        if near and min(len(a), len(b)) > edits:
            keys = linededup.segment_keys([a, b], edits)
            assert set(keys[0]) & set(keys[1]), (a, b)


def brute_lines(rows, edits, least_chars):
    places = [
        (key is None, key, n, line) for key, text in rows for n, line in enumerate((text or "").split("\n")) if line and not line.isspace()
    ]
    lines = sorted({p[3] for p in places})
    links = [
        (a, b) for a in lines for b in lines
        if a < b and min(len(a), len(b)) >= least_chars and abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits
    ]
    groups = least_reachable(lines, links)
    first = {}
    for p in sorted(places, key=lambda p: (p[0], p[1] or 0, p[2])):
        first.setdefault(groups[p[3]], p[1:3])
    out = []
    for key, text in rows:
        own = text.split("\n") if text is not None else None
        if own is not None:
            own = [x for n, x in enumerate(own) if not x or x.isspace() or first[groups[x]] == (key, n)]
        out.append((key, None if own is None else "\n".join(own)))
    return sorted(out, key=repr)


def test_line_dedup_equals_brute_force(spark):
    random.seed(11)
    base = ["".join(random.choice("abc déf") for _ in range(random.randint(15, 60))).strip() or "x" for _ in range(12)]
    rows = []
    for i in range(40):
        own = [changed(random.choice(base), random.choice([0, 0, 1, 2, 3])) for _ in range(random.randint(1, 5))]
        rows.append((i, "\n".join(own + random.choice([[], [""], ["ok."], ["  "]]))))
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "ok.\r"), (None, rows[0][1]), (54, "y" * 50_000), (55, "y" * 50_001), (7, rows[7][1])]
    frame = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, n_removed int, node string")
    found = linededup.dedup_lines(frame)
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=repr) == brute_lines(rows, 2, 20)
    assert set(found.columns) == {"doc_id", "text", "node", "n_lines", "n_removed"}
    assert linededup.dedup_lines(frame.limit(0)).count() == 0


# Licenses


def test_licenses_equal_sql_on_odd_texts(spark):
    texts = [
        None, "", "Released under the MIT License.\nUnder the MIT license under the mit license", "cc-by-nc CC BY/NC cc by nc",
        "Apache License, Version 2.0", "all rights. reserved", "All rights reserved! x", "licensed under gnu the affero general public license",
        "This work is licenced under the GNU General Public License, version 3. More", "é under the mit license", "mit " * 3000, "under the",
    ]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(2, texts[2], "x"), (None, texts[4], "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    found = licenses.scan(frame).collect()
    documents = frame.toPandas()  # noqa: F841 (the query's table)
    wanted = duckdb.sql(licenses.twin_sql()).fetchall()
    norm = lambda rows: sorted((tuple(None if v != v else v for v in r) for r in rows), key=repr)
    assert norm(map(tuple, found)) == norm(wanted)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[2]["n_base"] == 3 and by_id[2]["labels"] == "mit" and by_id[0]["score"] == 0.0
    assert by_id[7]["labels"].split(",").count("agpl") == 1 and by_id[5]["labels"] == ""
    assert licenses.scan(frame.limit(0)).count() == 0


MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use'
)


def test_wrapped_notices_are_found_whatever_stands_around_them(spark):
    texts, labels = [], []
    for notice, label in [*licenses.TEMPLATES, (MPL, "mpl-2"), (MIT, "mit")]:
        for width, mark in ((1000, ""), (72, " * "), (30, "# "), (12, "// ")):
            lines = [mark + line for line in textwrap.wrap(notice, width, break_long_words=False)]
            texts.append("\n".join(["int main() {", *lines, mark + "x = 1", "}"]))
            labels.append(label)
    far = " ".join(f"w{i}" for i in range(200))
    clean = [MIT.replace("hereby", f"hereby {far}"), "permission is hereby granted free\n\nof charge to any person", f"all {far} rights {far} reserved", far,
             f"Licensed under the Apache license, {far[:300]} mit x"]
    late = [f"{far * n} {MIT.lower()}" for n in (1, 2, 3)] + [f"{far} {MIT} {far}"]
    rows = list(enumerate(texts + clean + late))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scan(frame).collect()}
    for i, label in enumerate(labels):
        assert label in found[i]["labels"].split(","), texts[i]
    for i in range(len(texts), len(texts) + len(clean)):
        assert found[i]["labels"] == "" and found[i]["score"] == 0.0, rows[i]
    for i in range(len(texts) + len(clean), len(rows)):
        assert found[i]["labels"] == "mit", rows[i]
    documents = frame.toPandas()  # noqa: F841 (the query's table)
    wanted = duckdb.sql(licenses.twin_sql()).df().set_index("doc_id")
    assert {i: (r["labels"], r["score"]) for i, r in found.items()} == {i: (r["labels"], r["score"]) for i, r in wanted.iterrows()}


@given(st.lists(st.sampled_from(["\n", ". ", " ", "\n \n", "! ", "v. 2.0", "\t", ".\n3", "#", "all", "rights", "reserved", "mit", ".\r\n"]), max_size=14))
@settings(max_examples=40, deadline=None)
def test_passages_end_where_the_sql_ends_them(parts):
    text = "".join(parts)
    own = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", p) for p in re.split(licenses.PASSAGE_END, text)]
    documents = pd.DataFrame({"doc_id": [1], "text": [text]})  # noqa: F841 (the query's table)
    passages = licenses.twin_sql().split("blocks AS")[0].rstrip().rstrip(",") + " SELECT w FROM passages"
    assert sorted(w for w in own if w) == sorted(list(r[0]) for r in duckdb.sql(passages).fetchall() if r[0])


# Benchmark items

ITEMS = [
    (1, "A train leaves the old station with 120 people and after 35 minutes it has gone 40 km along the coast towards Lisbon without a stop."),
    (2, "Short item here."),
    (3, None),
    (4, ""),
    (5, "The baker sold 14 loaves before noon and then 14 loaves after noon so that none was left on the shelf at night."),
]


def test_decontamination(spark):
    item, loaves = ITEMS[0][1], ITEMS[4][1]
    texts = {
        10: f"Some words before. {item} And more after.",
        11: "x y z. " + item.replace("120", "77").replace("35", "90").replace("40 km", "12 miles").replace("Lisbon", "Porto"),
        12: "A train leaves the old station with many friends, it was a fine day and they all went along the coast.",
        13: None, 14: "", 15: "1 2 3 4 5 6 7 8 9 10 " * 200,
        16: "Note. " + loaves.replace("14", "9"),
        17: "Note. " + loaves.replace("14", "9", 1),
        18: "one. Short item here. two", 19: item * 300, 20: "clean text " * 3000,
    }
    rows = [(k, v, 0) for k, v in texts.items()] + [(None, item, 0), (10, texts[10], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items int")
    bench = spark.createDataFrame([(*i, "z") for i in ITEMS] + [(None, item, "z")], "item_id long, text string, hash string")
    found = decontam.decontaminate(docs, bench).collect()
    assert len(found) == len(rows)
    items = {(r["doc_id"]): r["items"] for r in found}
    assert items == {10: "1", 11: "1", 12: "", 13: "", 14: "", 15: "", 16: "5", 17: "", 18: "2", 19: "1", 20: "", None: "1"}
    assert all(r["contaminated"] == (r["items"] != "") for r in found)
    assert not any(r["contaminated"] for r in decontam.decontaminate(docs, bench.limit(0)).collect())
    assert decontam.decontaminate(docs.limit(0), bench).count() == 0


def test_verbatim_items_are_found(spark):
    sf = "/root/testdata/sf0.01"
    found = {r["doc_id"] for r in QUERIES["op8_decontamination"](spark, sf).where("contaminated").collect()}
    exact = duckdb.sql(f"select distinct doc_id from '{sf}/documents.parquet' d, '{sf}/benchmark.parquet' b where contains(d.text, b.text)").fetchall()
    assert found == {row[0] for row in exact}


def found_items(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return [r["items"] for r in sorted(decontam.decontaminate(docs, bench).collect(), key=lambda r: r["doc_id"])]


def test_items_with_few_literal_words_and_at_line_starts(spark):
    items = [(1, "Compute 12 * 7 + 5"), (2, "The Old Man And The Sea"), (3, "What is the boiling point of water"), (4, "Add 12 and 30 twice")]
    texts = [
        "Task\nCompute 12 * 7 + 5\nnow", "He read The Old Man and the Sea twice", "Question 5\nWhat is the boiling point of water\nA) 100",
        "so we ask What is the boiling point of water here", "Add 12 and 30 twice.", "Compute 13 * 7 + 5", "The Old House And The Sea", "What is the boiling point of oil", "",
    ]
    assert found_items(spark, items, texts) == ["1", "2", "3", "3", "4", "", "", "", ""]


def test_changed_values_of_one_alignment(spark):
    sums = "Each of the 3 gardeners plants 5 rose bushes near the old wall every single morning before lunch"
    long_ = "The 14 boats left " + " ".join(f"part{i} goes" for i in range(40)) + " and all 14 came home again in the evening"
    texts = [sums.replace("3", "4").replace("5", "4"), long_.replace("14", "9", 1), long_.replace("14", "9"), "The 9 boats left and all 14 came home again"]
    assert found_items(spark, [(1, sums), (2, long_)], texts) == ["1", "2", "2", ""]


def test_quoted_and_edited_passages(spark):
    words = [f"term{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    edited = [f"other{i}" if i % 8 == 7 else w for i, w in enumerate(words)]
    texts = [" ".join(part) for part in (words[15:45], words[:20], edited, words[20:30], words[:5] + ["x"] + words[5:10] + ["y"] + words[10:15])]
    texts.append("see " + " ".join(f"{a} stop" for a in words))
    assert found_items(spark, [(1, " ".join(words))], texts) == ["1", "1", "1", "", "", ""]


# Rows without an id, or with one id and different texts


@pytest.mark.parametrize("key", [None, 7])
def test_lines_of_rows_with_one_id(spark, key):
    same = "a line that stands in several of these texts"
    texts = [f"{same}\nfirst text only, its own second line", f"second text only, its own first line\n{same}\nlast", same, f"x\n{same}\nunlike all others, in the last place"]
    frame = spark.createDataFrame([(key, t) for t in texts], "doc_id long, text string")
    rows = linededup.dedup_lines(frame).collect()
    lines = [line for r in rows for line in r["text"].split("\n") if line]
    assert sorted(lines) == sorted({line for t in texts for line in t.split("\n")})
    assert sum(r["n_removed"] for r in rows) == 3 and sum(r["n_lines"] for r in rows) == 9


@pytest.mark.parametrize("key", [None, 7])
def test_near_copies_among_rows_with_one_id(spark, key):
    words = [f"w{i}" for i in range(80)]
    near, alone = " ".join(words), " ".join(reversed(words))
    rows = [(key, near), (key, near + " more"), (key, alone), (key, None), (key, ""), (key, alone)]
    kept = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    texts = [r["text"] for r in kept]
    assert len(texts) == 4 and {alone, None, ""} < set(texts) and len({near, near + " more"} & set(texts)) == 1
    rows += [(3, near + " and"), (3, "other words of another text")]
    kept = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    found = sorted(((r["doc_id"], r["text"]) for r in kept), key=repr)
    assert found == sorted([(3, near + " and"), (3, rows[-1][1]), (key, alone), (key, None), (key, "")], key=repr)


@pytest.mark.parametrize("key", [None, 7])
def test_leaks_among_rows_with_one_id(spark, key):
    rows = [(key, f"See. {ITEMS[0][1]}"), (key, "A clean text of some words."), (key, None), (key, f"Also. {ITEMS[4][1]}")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontam.decontaminate(docs, bench).collect()
    assert [next(r["items"] for r in found if r["text"] == t) for _, t in rows] == ["1", "", "", "5"]


# Registered twins


@pytest.mark.parametrize("name", ["op2_vectors", "op7_jaccard", "op9_licenses"])
def test_twins(spark, sf_dir, name):
    tables = duckdb.connect()
    for table in ("documents", "embeddings"):
        tables.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    found = QUERIES[name](spark, sf_dir)
    names = sorted(found.columns)
    wanted = tables.execute(f"select {', '.join(names)} from ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, map(tuple, found.select(*names).collect()))) == sorted(map(repr, wanted))


def test_windows_of_many_texts_equal_those_of_each_alone(monkeypatch):
    """Whatever is held together, and however often the table of words is emptied in between."""
    import pandas as pd

    random.seed(9)
    texts = [" ".join(random.choice("Ann went 3 km to the big Red house on day 12 .\n".split(" ")) + str(random.randrange(30)) * random.randrange(2) for _ in range(random.randint(0, 40))) for _ in range(60)]
    frame = pd.DataFrame({"doc_id": [str(i) for i in range(60)], "name": range(60), "text": texts})
    bits = np.full(1 << 22, 255, np.uint8)

    def found(frames):
        rows = pd.concat(list(decontam.rows_met(frames, [3, 6, 8], 4, bits)))
        return sorted((tuple(map(repr, row)) for row in rows.itertuples(index=False)))

    alone = found(iter([frame.iloc[[i]] for i in range(60)]))
    together = found(iter([frame]))
    monkeypatch.setattr(decontam.Chunks, "LIMIT", 15)
    monkeypatch.setattr(decontam, "HELD", 50)
    assert len(alone) > 1000 and alone == together == found(iter([frame]))


def test_window_search_holds_few_texts_and_leaves_nothing_in_the_worker():
    """A batch of many texts reaches Python in small frames, and the table of words is empty once the task is done."""
    n = 3 * decontam.FRAME + 5
    batch = pa.RecordBatch.from_pydict({"doc_id": [str(i) for i in range(n)], "name": list(range(n)), "text": [f"Words of text {i} stand here in a row" for i in range(n)]})
    frames = list(decontam.frames_of(iter([batch, batch.slice(0, 0), batch.slice(1, 2)])))
    assert [len(frame) for frame in frames] == [decontam.FRAME] * 3 + [5, 2]
    assert list(frames[3]["doc_id"]) == [str(i) for i in range(n - 5, n)]
    rows = pd.concat(list(decontam.rows_met(iter(frames), [6], 4, np.full(1 << 22, 255, np.uint8))))
    assert set(rows["doc_id"]) == {str(i) for i in range(n)}
    assert not len(decontam.CHUNKS) and not decontam.CHUNKS.runs and not len(decontam.CHUNKS.hashes)


def test_runs_between_blanks_are_read_as_the_patterns_say():
    """Shortcuts for runs of letters or with one mark at the end change no reading."""
    parts = ["", "a", "Bob", "KM", "two", "Σ", "ΑΣ", "ǅa", "İx", "Ⅷ", "²", "½", "٣", "5", "12km", "5xy", "+3.5", "7th", "x_y", "_", "'", ".", "?\"", "é", "e\u0301", "ⓐ", "中文"]
    table = decontam.Chunks()
    for chunk in {a + b + c for a in parts for b in parts for c in parts if a + b + c}:
        core = decontam.EDGE.sub("", chunk)
        low = core.lower()
        measure = decontam.MEASURE.fullmatch(low)
        if decontam.NUMERIC.fullmatch(low) or low in decontam.NUMBER_WORDS or (measure and measure.group(2) in decontam.UNITS):
            kind = decontam.NUMBER
        else:
            kind = decontam.UNIT if low in decontam.UNITS else decontam.NAME if low in decontam.NAMES else decontam.WORD if core else -1
        ends = chunk.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":", ";")
        capital = len(core) > 1 and core[0].isupper() and core[1:].islower()
        found = [column[0] for column in table.columns(np.array([table[chunk]]))]
        assert found == [kind, ends, capital, xxhash.xxh64_intdigest(low.encode())], chunk
        assert decontam.core_of(chunk).lower() == low


def test_lines_ending_in_carriage_returns_go_whole(spark):
    """A text whose lines all repeat counts as emptied, though its line ends keep blanks."""
    rows = [(1, "one line of some length here\r\nanother line of some length\r\n\u3000"), (2, "one line of some length here\r\n\x1c\r\nanother line of some length\r\n")]
    found = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (2, 0), 2: (2, 2)}


def test_parities_of_many_lines_equal_those_of_each_alone():
    random.seed(4)
    lines = ["".join(random.choice("ab é中😀") for _ in range(random.choice([1, 2, 3, 20, 70]))) for _ in range(200)]

    def alone(line, width):
        points = np.array([ord(char) + 1 for char in line], np.uint64)
        odd = 0
        for run in linededup.windows(points, width).tolist():
            odd ^= 1 << (run >> 40 & 63)
        return odd - (1 << 64) if odd >> 63 else odd

    wanted = [[alone(line, width) for width in linededup.RUNS] for line in lines]
    assert linededup.parities(lines) == wanted == [linededup.parities([line])[0] for line in lines]


def test_lines_are_blank_as_isspace_says_and_few_are_trimmed(spark):
    chars = [chr(i) for i in range(1, 0x3100) if i != 10]
    rows = [(line,) for c in chars for line in (c, f" {c}", f"{c}a", f"　{c}\t")] + [("",), ("\U0001f600",)]
    lines = spark.createDataFrame(rows, "line string")
    found = {r["line"]: r["full"] for r in lines.select("line", linededup.not_blank(lines["line"]).alias("full")).collect()}
    assert found == {line: bool(line) and not line.isspace() for line, in rows}
    # What starts with a letter, a digit or a mark is told by comparison, before the trimming.
    plan = lines.select(linededup.not_blank(lines["line"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index(">= !") < plan.index("trim(")


def test_a_text_is_split_once_however_many_lines_stay(spark):
    rows = [(1, "one line of some length here\nanother line of some length\nmore", "a"), (2, "more\none line of some length here\nless\nmost", "b"), (3, None, "c")]
    found = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, _lines string"))
    wanted = [(1, rows[0][1], "a", 3, 0), (2, "less\nmost", "b", 4, 2), (3, None, "c", 0, 0)]
    assert sorted(map(tuple, found.collect())) == wanted
    # Once on either side of the union, and in no function of a line.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2


def test_only_lines_that_repeat_are_grouped(spark, monkeypatch):
    grouped = []

    def watched(df):
        out = saved(df)
        if "component" in out.columns and "first" in out.columns:
            grouped.append({(row["node"], row["n"]) for row in out.select("node", "n").collect()})
        return out

    saved = linededup.saved
    monkeypatch.setattr(linededup, "saved", watched)
    lines = ["a line that stands once only", "a line that stands in two texts", "a line with a near copy, here", "a line with a near copy, hers", "short"]
    rows = [(1, "\n".join(lines)), (2, lines[1] + "\nshort too")]
    linededup.kept_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    names = linededup.line_names(lines).tolist()
    assert grouped == [{(names[1], 2), (names[2], 1), (names[3], 1)}]


def test_keys_of_frequent_and_rare_characters_have_one_formula(monkeypatch):
    random.seed(5)
    lines = ["".join(random.choice("ab é中😀\U0010ffff\u3fff\u4000") for _ in range(random.choice([3, 20, 70]))) for _ in range(100)]
    keys = linededup.segment_keys(lines, 2)
    assert keys.tolist() == [linededup.segment_keys([line], 2)[0].tolist() for line in lines]
    monkeypatch.setattr(linededup, "CHARS", linededup.CHARS[:1])
    assert (linededup.segment_keys(lines, 2) == keys).all()

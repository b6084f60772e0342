"""License scans: exact phrases, and a set-similarity join of text blocks with notice templates. DataFrame functions only."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, and what ends a passage: a blank line, or a sentence mark and white space before a word that
#: starts with no digit (`v. 2.0` goes on). A line end alone ends nothing: notices are wrapped.
BETWEEN, PASSAGE_END = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"\n[ \t\r]*\n|[.!?][ \t\r\n](?![\x00-\x2F\x3A-\x60\x7B-\x7F]*[0-9])"

#: Phrases with the labels they stand for.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Usual notice sentences with their labels.
TEMPLATES = (
    ("released under the MIT license", "mit"),
    ("licensed under the MIT license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the Apache License Version 2.0", "apache-2"),
    ("licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "cc-by-nc"),
    ("licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "cc-by-sa"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("this work is licensed under the GNU General Public License version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the GNU General Public License", "gpl"),
    ("licensed under the GNU Lesser General Public License", "lgpl"),
    ("licensed under the GNU Affero General Public License", "agpl"),
    ("this source code form is subject to the terms of the Mozilla Public License v 2.0", "mpl-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
)
THRESHOLD = 0.9


@dataclass(frozen=True)
class Template:
    """A template's distinct words, rare first, the overlap a block needs and the stretch of words it may be spread over."""

    number: int
    label: str
    words: tuple[str, ...]
    need: int
    reach: int

    @property
    def prefix(self) -> tuple[str, ...]:
        """A block that shares none of these cannot reach the overlap."""
        return self.words[: len(self.words) - self.need + 1]


def template_words(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, LOWER)))))


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none of null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def reach(text: str) -> int:
    """Words over which a notice may be spread: the power of four from twice the template's words on, 16 at least."""
    words = len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text))
    return max(16, 4 ** math.ceil(math.log(2 * words, 4) - 1e-9))


def windows(words: Column, step: int) -> Column:
    """Overlapping blocks of 2 * step words, `step` apart: each stretch of `step` words lies in one of them."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - step - 1, F.lit(0)), F.lit(step))
    return F.transform(starts, lambda i: F.slice(words, i + 1, 2 * step))


def strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def ordered(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> tuple[list[Template], list[str]]:
    """Templates and vocabulary with words ordered by how many documents have them, over all rows (ties by word).

    Only the templates' own vocabulary is counted and comes to the driver.
    """
    sets = [(template_words(text), label) for text, label in templates]
    vocabulary = sorted({word for words, _ in sets for word in words})
    hits = docs.select(F.explode(F.array_intersect(strings(vocabulary), words_of(F.col("text")))).alias("word"))
    counts = {row["word"]: row["n"] for row in hits.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return [
        Template(i, label, tuple(sorted(words, key=lambda w: (counts.get(w, 0), w))), math.ceil(threshold * len(words) - 1e-9), reach(templates[i][0]))
        for i, (words, label) in enumerate(sets)
    ], sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def phrase_starts(words: Column, phrase: str) -> Column:
    """Indexes of the words where the phrase starts."""
    parts = phrase.split()
    here = F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0)))
    return F.filter(here, lambda i: F.slice(words, i + 1, len(parts)) == strings(parts))


def scan(docs: DataFrame, templates=TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    A block has a template's label if it holds at least `threshold` of the template's distinct words. Blocks are windows of
    a passage (16 and 64 words apart, twice as long, by the template's length), which ends at blank lines and sentence marks, not at line ends; a shorter passage is one block. They are cut
    only in documents that have a word of a template's prefix; a block's words in global order
    are joined with the prefixes, thinned by length and position, and verified. score: 1 with a phrase, else the
    best containment found, else 0. Null text is empty; repeated rows and null ids give a row each.
    """
    found, order = ordered(docs, templates, threshold)
    spark = docs.sparkSession
    prefix_words = sorted({word for t in found for word in t.prefix})
    prefixes = spark.createDataFrame(
        [(w, t.reach, i, t.number, t.label, list(t.words), len(t.words), t.need) for t in found for i, w in enumerate(t.prefix)],
        "word string, reach int, at int, template int, label string, template_words array<string>, n int, need int",
    )
    starts = F.flatten(
        F.array(*[
            F.when(F.contains(F.col("joined"), F.lit(f" {p} ")), phrase_starts(F.col("words"), p)).otherwise(F.array().cast("array<int>"))
            for p in phrases
        ])
    )
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*[
        F.when(F.contains(F.col("joined"), F.lit(f" {p} ")), F.lit(label)) for p, label in phrases.items()
    ]))))
    passages = F.transform(F.split("text", PASSAGE_END), words_of)

    def blocks_of(step: int) -> Column:
        firsts = strings(sorted({word for t in found if t.reach == step for word in t.prefix}))
        cut = F.flatten(F.transform(passages, lambda own: windows(own, step)))
        known = F.filter(F.transform(cut, lambda block: F.array_intersect(strings(order), block)), lambda own: F.arrays_overlap(own, firsts))
        return F.transform(known, lambda own: F.struct(F.lit(step).alias("reach"), own.alias("own")))

    blocks = F.concat(*[blocks_of(step) for step in sorted({t.reach for t in found})])
    rows = (
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("words", words_of(F.col("text")))
        .withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
        .select(
            "row", "doc_id", F.size("words").cast("long").alias("n_words"), starts.alias("starts"), base.alias("base"),
            F.when(F.arrays_overlap("words", strings(prefix_words)), blocks).alias("blocks"),
        )
    )
    tokens = rows.withColumn("block", F.explode_outer("blocks")).select("*", "block.reach", "block.own").select(
        "row", "doc_id", "n_words", "starts", "base", "reach", "own", F.posexplode_outer("own").alias("own_at", "word")
    )
    most = F.least("at", "own_at") + 1 + F.least(F.col("n") - F.col("at") - 1, F.size("own") - F.col("own_at") - 1)
    joined = tokens.join(prefixes, ["word", "reach"], "left").withColumn(
        "share",
        F.when((F.size("own") >= F.col("need")) & (most >= F.col("need")), F.size(F.array_intersect("template_words", "own")) / F.col("n")),
    )
    hit = F.col("share") >= F.lit(threshold)
    grouped = joined.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.first("starts").alias("starts"),
        F.first("base").alias("base"),
        F.collect_set(F.when(hit, F.col("label"))).alias("more"),
        F.max(F.when(hit, F.col("share"))).alias("best"),
    )
    return grouped.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "more")), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def twin_sql(templates=TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> str:
    """The same scan as DuckDB SQL: every block against every template, without filters.

    Paragraphs are split first, then sentences, after what stands between a mark and a number is taken out.
    """
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    values = ", ".join(f"('{label}', {quoted(template_words(text))}, {reach(text)})" for text, label in templates)
    bases = ", ".join(f"('{label}', {quoted(phrase.split())})" for phrase, label in phrases.items())
    lowered = f"translate(coalesce({{}}, ''), '{UPPER}', '{LOWER}')"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lowered.format("text")}, '{word}') AS words, text FROM documents),
phrases(label, parts) AS (VALUES {bases}),
templates(label, parts, reach) AS (VALUES {values}),
places AS (
  SELECT r, label, i FROM (SELECT r, words, unnest(range(len(words))) AS i FROM docs) w, phrases
  WHERE words[i + 1] = parts[1] AND words[i + 1 : i + len(parts)] = parts),
base AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS b, list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY r),
paragraphs AS (SELECT r, unnest(string_split_regex(coalesce(text, ''), '\\n[ \\t\\r]*\\n')) AS p FROM docs),
sentences AS (
  SELECT r, unnest(string_split_regex(regexp_replace(p, '([.!?])[ \\t\\r\\n][\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]*([0-9])', '\\1\\2', 'g'), '[.!?][ \\t\\r\\n]')) AS sentence
  FROM paragraphs),
passages AS (SELECT r, regexp_extract_all({lowered.format("sentence")}, '{word}') AS w FROM sentences),
blocks AS (
  SELECT r, w, reach, unnest(range(0, greatest(len(w) - reach, 1), reach)) AS i FROM passages, (SELECT DISTINCT reach FROM templates) t),
sets AS (SELECT r, reach, list_distinct(w[i + 1 : i + 2 * reach]) AS own FROM blocks),
found AS (
  SELECT r, label, len(list_intersect(parts, own)) / len(parts) AS share FROM sets JOIN templates USING (reach) WHERE len(list_intersect(parts, own)) / len(parts) >= {threshold}),
more AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS best FROM found GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word,
  coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ','), '') AS labels,
  CAST(CASE WHEN n > 0 THEN 1 ELSE coalesce(best, 0) END AS DOUBLE) AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN more USING (r)"""

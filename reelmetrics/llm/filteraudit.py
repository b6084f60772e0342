"""Filter interaction audit: what every order of a set of filters removes, step by step, by a recursive query.

Documents are reduced to mask cells first: (part, set of failed filters) with its counts, at most 2**filters a part.
The recursive query then extends filter prefixes by unused letters; every level joins the cells of its part and emits
the counts of its step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

#: Words are runs between ASCII white space.
BLANKS = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def text_failures(docs: DataFrame) -> DataFrame:
    """The columns of docs and `failed`: bits 1, 2, 4, 8 of the filters short, repetitive, capitals, symbols; null texts are empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    capitals = F.char_length(text) - F.char_length(F.translate(text, CAPITALS, ""))
    found = docs.withColumns({"_words": words(text)})
    n, distinct = F.size("_words"), F.size(F.array_distinct("_words"))
    fails = [
        n < 200,
        100 * distinct < 50 * n,
        100 * capitals > 3 * F.char_length(text),
        text.rlike(r"[#$%&*|]"),
    ]
    bits = [F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)]
    return found.withColumn("failed", bits[0] + bits[1] + bits[2] + bits[3]).drop("_words")


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, docs, good, toxic: documents by part and set of failed filters; bit 16 is a copy of a smaller doc_id.

    Texts are told apart by 128 bits of hash and their length. A null doc_id is no copy and has no label; rows with
    equal id and text are no copies of each other. The rows of a hot text are added up by (text, part, labels) before
    they meet, and null ids are spread over the join's tasks.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = text_failures(docs).select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("part"),
        "failed",
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
        F.length(text).alias("size"),
        F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id() % 1024).otherwise(0).alias("salt"),
    )
    flags = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    flags = flags.withColumn("salt", F.lit(0).cast("long"))
    labelled = rows.join(flags, ["doc_id", "salt"], "left").na.fill(0, ["good", "toxic"])
    one_text = ["h1", "h2", "size"]
    kinds = [*one_text, "failed", "part", "good", "toxic"]
    by_id = labelled.groupBy("doc_id", "salt", *kinds).agg(F.count(F.lit(1)).alias("n"))
    named = F.col("doc_id").isNotNull()
    groups = by_id.groupBy(*kinds).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(named, F.col("n")).otherwise(0)).alias("named"),
        F.min("doc_id").alias("low"),
        F.min(F.when(named, F.struct("doc_id", "n"))).alias("first"),
    )
    least = F.min("low").over(_by(one_text))
    originals = F.when(F.col("low") == F.col("least"), F.col("first.n")).otherwise(0)
    split = groups.withColumn("least", least).withColumn("copies", F.col("named") - originals)
    split = split.withColumn("copies", F.coalesce("copies", F.lit(0)))
    cells = split.select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct(F.col("failed").alias("mask"), (F.col("n") - F.col("copies")).alias("docs")),
                F.struct((F.col("failed") + 16).alias("mask"), F.col("copies").alias("docs")),
            )
        ),
    )
    return cells.where("docs > 0").groupBy("part", "mask").agg(
        F.sum("docs").alias("docs"),
        F.sum(F.col("docs") * F.col("good")).alias("good"),
        F.sum(F.col("docs") * F.col("toxic")).alias("toxic"),
    )


def _by(columns: Sequence[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*columns)


def _total(condition: str, counter: str) -> str:
    return f"aggregate(c.cells, 0L, (a, x) -> a + if({condition}, x.{counter}, 0L))"


#: One level extends every prefix by an unused letter and emits its step; `applied` carries the bits of the prefix.
RECURSION = f"""
WITH RECURSIVE steps(part, filter_order, applied, emitted) AS (
  SELECT part, '', 0, CAST(array() AS array<struct<step: int, letter: string, kept: bigint, removed: bigint,
    redundant: bigint, unique_fails: bigint, good_lost: bigint, toxic_lost: bigint>>)
  FROM {{cells}}
  UNION ALL
  SELECT s.part, concat(s.filter_order, s.l.letter), s.applied | s.l.bit, array_append(s.emitted, named_struct(
    'step', size(s.emitted) + 1, 'letter', s.l.letter,
    'kept', {_total("x.mask & (s.applied | s.l.bit) = 0", "docs")},
    'removed', {_total("x.mask & s.applied = 0 AND x.mask & s.l.bit <> 0", "docs")},
    'redundant', {_total("x.mask & s.applied <> 0 AND x.mask & s.l.bit <> 0", "docs")},
    'unique_fails', {_total("x.mask = s.l.bit", "docs")},
    'good_lost', {_total("x.mask & s.applied = 0 AND x.mask & s.l.bit <> 0", "good")},
    'toxic_lost', {_total("x.mask & s.applied = 0 AND x.mask & s.l.bit <> 0", "toxic")}))
  FROM (
    SELECT part, filter_order, applied, emitted, explode(filter({{letters}}, l -> applied & l.bit = 0)) AS l FROM steps) s
    JOIN {{cells}} c ON c.part = s.part)
SELECT part, filter_order, inline(emitted) FROM steps WHERE size(emitted) = {{n}} LIMIT ALL"""


def interactions(cells: DataFrame, letters: Sequence[str]) -> DataFrame:
    """part, filter_order, step, letter, counts and shapley for every order of the filters; bit i of a mask is letter i.

    cells: part, mask, docs, good, toxic. They are packed per part (2**filters entries at most), written once and joined at
    every level. Orders grow as the factorial of the filters, so six filters are the most. An empty table gives no rows.
    """
    if not 1 <= len(letters) <= 6:
        raise ValueError("one to six filters: every order of them is listed")
    spark = cells.sparkSession
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("cells"))
    bits = ", ".join(f"named_struct('letter', '{letter}', 'bit', {1 << i})" for i, letter in enumerate(letters))
    query = RECURSION.replace("{n}", str(len(letters))).replace("{letters}", f"array({bits})")
    steps = spark.sql(query, cells=saved(packed))
    return steps.withColumn("shapley", F.sum("removed").over(_by(["part", "letter"])))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A (short), B (repetitive), C (capitals), D (symbols), E (copy of a smaller doc_id) in all orders.

    Null and empty languages are one part. Labels may repeat: a document is good or toxic if any of its rows says so.
    Columns other than doc_id, text, lang (docs), quality and toxic (labels) are left aside.
    """
    chosen = docs.select("doc_id", "text", "lang")
    return interactions(mask_cells(chosen, labels.select("doc_id", "quality", "toxic")), "ABCDE")


#: Every document against every order by the position of its first failing letter, without cells or recursion.
TWIN = r"""
WITH marked AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic
  FROM documents),
failing AS (
  SELECT part, good, toxic,
    concat(CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS failed
  FROM marked),
kinds AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
placed AS (
  SELECT part, filter_order, failed, n, good, toxic,
    coalesce(list_min(list_transform(string_split(nullif(failed, ''), ''), lambda f: strpos(filter_order, f))), 6) AS first
  FROM kinds, orders),
counted AS (
  SELECT part, filter_order, step::INTEGER AS step, substr(filter_order, step, 1) AS letter,
    sum(CASE WHEN first > step THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN first = step THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN first < step AND contains(failed, substr(filter_order, step, 1)) THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN failed = substr(filter_order, step, 1) THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN first = step THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN first = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM placed, range(1, 6) r(step) GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted"""

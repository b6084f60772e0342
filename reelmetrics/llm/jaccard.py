"""Jaccard join of word n-gram sets: rare-first prefixes, length, positional and suffix filters, one check a pair."""

from __future__ import annotations

from collections.abc import Iterator


import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SKETCH_CELLS, count_sketch, in_map, mapped, may_meet, membership_map, named_texts, released, saved, shingles, text_name, with_long_id
from .components import linked_groups

#: Words of the parity sketch that bounds how far two sets differ (the suffix filter), 64 bits each.
SKETCH_WORDS = 4
#: Parts a set is cut into by hash; their sizes bound the difference of long sets.
PARTS = 128


def set_key(values: np.ndarray) -> int:
    """64-bit name of a whole set, signed."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(values.tobytes())).astype(np.int64))


def parity(values: np.ndarray) -> np.ndarray:
    """Bit i: whether an odd number of the set's elements falls on i. Two sets differ in at least as many elements as
    their parities differ in bits."""
    odd = np.bincount((values >> np.uint64(40)).astype(np.int64) & (64 * SKETCH_WORDS - 1), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def prefix_length(n: int, threshold: int) -> int:
    """Two sets of at least `threshold` percent Jaccard share one of this many first elements."""
    return n - -(-threshold * n // 100) + 1 if n else 0


def described(docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """doc_id, name, key, n, prefix (rare first) and parity of every row; null key for texts without words.

    Rare first: by the class of an n-gram's count over all rows (a sketch of fixed size), then by its hash. Any
    fixed order gives whole results; the classes keep frequent n-grams out of the prefixes.
    """
    source = named_texts(docs)

    def hashes(frame: pd.DataFrame) -> Iterator[np.ndarray]:
        return (shingles(text, width) for text in frame["text"])

    classes = count_sketch(source.select("text"), hashes)

    def rows(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in frame["text"]:
            own = shingles(text, width)
            if not len(own):
                out.append((pd.NA, 0, None, None, None))
                continue
            order = np.lexsort((own, classes[(own & np.uint64(SKETCH_CELLS - 1)).astype(np.int64)]))
            first = own[order[: prefix_length(len(own), threshold)]].view(np.int64)
            parts = np.bincount((own >> np.uint64(57)).astype(np.int64), minlength=PARTS)
            out.append((set_key(own), len(own), first, parity(own), parts))
        keys, sizes, prefixes, parities, parts = zip(*out) if out else ([], [], [], [], [])
        return pd.DataFrame({
            "doc_id": frame["doc_id"].to_numpy(), "name": frame["name"].to_numpy(), "key": pd.array(keys, "Int64"), "n": sizes, "prefix": pd.Series(prefixes, dtype=object),
            "parity": pd.Series(parities, dtype=object), "parts": pd.Series(parts, dtype=object),
        })

    return saved(with_long_id(mapped(source, "doc_id string, name long, key long, n long, prefix array<long>, parity array<long>, parts array<int>", rows)))


def may_link(threshold: int):
    """Length, positional and suffix filters on rows with n, at (place in the rare-first order) and parity words p0, p1, ...

    Positional: the overlap that is still possible at a shared n-gram reaches what the threshold asks. Suffix: a lower
    bound of the symmetric difference does not exceed what the threshold leaves.
    """

    def condition(x: str, y: str) -> str:
        differ = " + ".join(f"bit_count({x}.p{i} ^ {y}.p{i})" for i in range(SKETCH_WORDS))
        return (
            f"{x}.n * 100 >= {y}.n * {threshold} and {y}.n * 100 >= {x}.n * {threshold} and "
            f"(least({x}.at, {y}.at) + least({x}.n - {x}.at, {y}.n - {y}.at)) * {100 + threshold} >= {threshold} * ({x}.n + {y}.n) and "
            f"({differ}) * {100 + threshold} <= {100 - threshold} * ({x}.n + {y}.n)"
        )

    return condition


def jaccard_groups(docs: DataFrame, width: int = 3, threshold: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; see grouped_rows."""
    return grouped_rows(docs, width, threshold).select("doc_id", "n_shingles", "component_id")


def grouped_rows(docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """doc_id, name, n_shingles, component (null without n-grams), component_id of every row: groups of documents linked by Jaccard similarity of their word
    n-gram sets, at least `threshold` percent.

    Words are runs without ASCII white space, A-Z lower-cased; a text with fewer words than `width` is one n-gram. Null
    texts and texts without words have no n-gram and link with nothing. Equal sets are one node, so copies
    and repeated rows cost nothing; component_id is the least doc_id of the group (rows without id are linked too).
    """
    return released(placed_rows, docs, width, threshold)[0]


def placed_rows(docs: DataFrame, width: int, threshold: int) -> tuple[DataFrame]:
    """The rows of grouped_rows, not yet saved."""
    rows, sets = released(rows_and_sets, docs, width, threshold)
    buckets = sets.select(F.col("key").alias("node"), F.posexplode("prefix").alias("at", "key"))
    attributes = sets.select(F.col("key").alias("node"), "n", *[F.col("parity")[i].alias(f"p{i}") for i in range(SKETCH_WORDS)])

    def verify(pairs: DataFrame) -> DataFrame:
        """Pairs whose parts differ too much go; the exact overlap decides on the others."""
        a, b = (sets.select(F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("parts").alias(f"parts_{s}")).hint("merge") for s in "ab")
        differ = F.aggregate(F.zip_with("parts_a", "parts_b", lambda p, q: F.abs(p - q).cast("long")), F.lit(0).cast("long"), lambda s, v: s + v)
        close = differ * (100 + threshold) <= (100 - threshold) * (F.col("n_a") + F.col("n_b"))
        pairs = saved(pairs.join(a, "a").join(b, "b").where(close).select("a", "b"))
        named = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        wanted = saved(named.join(sets.select("key", "source"), "key"))
        content = contents(docs, wanted, width).hint("merge")
        a, b = (content.select(F.col("key").alias(s), F.col("own").alias(f"own_{s}")) for s in "ab")
        both = F.size(F.array_intersect("own_a", "own_b")).cast("long")
        union = F.size("own_a") + F.size("own_b") - both
        return saved(pairs.join(a, "a").join(b, "b").where(both * 100 >= union * threshold).select("a", "b"))

    groups = linked_groups(buckets, attributes, may_link(threshold), verify)
    placed = sets.select("key", "first").join(groups.withColumnRenamed("node", "key"), "key", "left")
    placed = saved(placed.withColumn("component", F.coalesce("component", "key")))
    least = saved(placed.groupBy("component").agg(F.min("first").alias("component_id")))
    named = placed.join(least, "component").select("key", "component", "component_id")
    out = rows.join(named, "key", "left").select(
        "doc_id", "name", F.col("n").cast("long").alias("n_shingles"), "component", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return (out,)


def rows_and_sets(docs: DataFrame, width: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, name, key, n of every row, without the prefixes; and one row per key with its set's n, prefix, parity and parts."""
    found = described(docs, width, threshold)
    sets = found.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("first"), F.max("n").alias("n"), F.min("name").alias("source"),
        F.first("prefix").alias("prefix"), F.first("parity").alias("parity"), F.first("parts").alias("parts")
    )
    return found.select("doc_id", "name", "key", "n"), sets


def one_of_each(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """The input with one document of every group of jaccard_groups, the first by (doc_id, name of the text) with null
    ids last; equal rows stay once.

    Documents without n-grams stay. Rows with one id, or none, and different texts are different documents.
    """
    groups = grouped_rows(docs, width, threshold)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "name")
    firsts = groups.where("component is not null").groupBy("component").agg(F.min(place).alias("first"))
    later = groups.withColumn("place", place).join(saved(firsts), "component").where(~F.col("place").eqNullSafe(F.col("first")))
    dropped = saved(later.select(F.col("doc_id").alias("_dropped"), F.col("name").alias("_name")).distinct())
    repeated = groups.groupBy("doc_id", "name").count().where("count > 1").select(F.col("name").alias("_name"))
    # Only documents that may go, or may repeat, are exchanged; a bit map of fixed size proves of the others that they stay.
    there = may_meet(membership_map(saved(dropped.select("_name").unionByName(repeated)), "_name"))(text_name())
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_dropped")) & (text_name() == F.col("_name"))
    some = docs.where(there).join(dropped.hint("merge"), same, "left_anti").dropDuplicates(["doc_id", "text"])
    return some.unionByName(docs.where(~there))


def contents(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """key, own (n-grams) of the wanted sets (key, and source: the name of a text that has it), once each.

    A bit map of fixed size lets tasks pass over texts that are surely not wanted; the join decides.
    """
    bits = membership_map(wanted, "source")

    def rows(frame: pd.DataFrame) -> pd.DataFrame:
        out = {}
        texts = frame["text"].tolist()
        hit = in_map(frame["name"].to_numpy(np.int64).view(np.uint64), bits)
        for text in (texts[i] for i in np.flatnonzero(hit)):
            own = shingles(text, width)
            if len(own):
                out[set_key(own)] = own.view(np.int64)
        return pd.DataFrame({"key": list(out), "own": pd.Series(list(out.values()), dtype=object)})

    found = mapped(docs.select("text", text_name().alias("name")), "key long, own array<long>", rows)
    return saved(found.join(wanted.select("key").hint("merge"), "key", "left_semi").dropDuplicates(["key"]))

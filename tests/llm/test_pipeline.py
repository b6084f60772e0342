"""The corpus pipeline stage by stage, and as a whole."""

from __future__ import annotations

import re

import corpus_pipeline
import pandas as pd
from test_joins import brute_jaccard, brute_lines


def test_stages(spark, tmp_path):
    words = "the of and to in a is that for it as was with be by on not he this are from at".split()
    text = lambda seed: " ".join(words[(i * i + seed * i) % len(words)] for i in range(40))
    item = "A train leaves the old station with 120 people and after 35 minutes it has gone 40 km along the coast without a stop."
    rows = [(i, text(i)) for i in range(8)]
    rows += [(20, text(3)), (21, text(4) + " more words"), (22, "12 34 !!"), (23, None), (24, "日本語の文書"), (25, f"see. {item}"), (26, "")]
    rows += [(27, text(5) + "\n" + "A line of its own that stands in no other text at all")]
    docs = spark.createDataFrame([(i, t, None if i == 24 else "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    sf_dir = str(tmp_path)
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), rows
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.saved(stage(spark, now, sf_dir))
        if name == "packing":
            assert sum(r["length"] for r in out.collect()) >= len(kept) and {r["doc_id"] for r in out.collect()} == {i for i, _ in kept}
            break
        assert out.columns == corpus_pipeline.COLUMNS
        found = sorted((r["doc_id"], r["text"]) for r in out.collect())
        if name == "language ID":
            wanted = [(i, t) for i, t in kept if t and re.search("[a-z]", t)]
        elif name == "line dedup":
            before = dict(kept)
            wanted = [(i, t) for i, t in brute_lines(kept, 2, 20) if t == before[i] or t.strip()]
        elif name == "n-gram Jaccard join":
            keep = {i for i, _, c in brute_jaccard(kept, 5, 80) if i == c}
            wanted = [(i, t) for i, t in kept if i in keep]
        else:
            wanted = [(i, t) for i, t in kept if i != 25]
        assert found == sorted(wanted), name
        now, kept = out, wanted
    whole = corpus_pipeline.run(spark, sf_dir)
    assert whole.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {r["doc_id"] for r in whole.collect()} == {i for i, _ in kept}


def test_language_is_predicted_once(spark):
    docs = spark.createDataFrame([(1, "the old man and the sea", "en", "s", 23), (2, "12 34", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.by_language(spark, docs, "")
    assert [r["doc_id"] for r in found.collect()] == [1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # a second one is a second pass over the texts, in a second worker of each task


def test_texts_go_to_python_in_small_batches(spark, tmp_path):
    limit = corpus_pipeline.BATCH_LIMIT
    before = spark.conf.get(limit, None)
    spark.range(200).selectExpr("id as doc_id", "repeat('the old man and the sea ', 4000) as text", "'en' as lang", "'s' as source", "96000L as n_chars").coalesce(1).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")

    def sizes(frames):
        for frame in frames:
            yield pd.DataFrame({"bytes": [frame["text"].str.len().sum()]})

    try:
        for _, stage in corpus_pipeline.STAGES[:1] + corpus_pipeline.STAGES[2:3]:
            spark.conf.unset(limit)
            stage(spark, docs, "")
            found = [r["bytes"] for r in docs.select("text").mapInPandas(sizes, "bytes long").collect()]
            assert sum(found) == 200 * 96_000 and max(found) < 5 << 20
        spark.conf.set(limit, "1m")
        corpus_pipeline.by_language(spark, docs, "")
        assert spark.conf.get(limit) == "1m"
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)

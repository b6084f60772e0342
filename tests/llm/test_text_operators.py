"""Token counts, packing, languages, quality and page text against plain versions, with odd inputs."""

from __future__ import annotations

import math
import random
import time
import zlib

import numpy as np
import pytest

from reelmetrics.llm import htmltext, langid, packing, quality, tokencounts
from reelmetrics.llm.queries import QUERIES, tokenizer

ODD = [
    (1, "Hello  world\n\nagain", "x"),
    (2, None, "x"),
    (3, "", None),
    (4, " \t\n", "x"),
    (5, "long " * 5000, "x"),
    (1, "Hello  world\n\nagain", "x"),
    (None, "été 日本 ▁ 😀 12", "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, long, repeated and id-less rows; extra columns with the names of results."""
    return spark.createDataFrame([(*row, 0.5, 7) for row in ODD], "doc_id long, text string, source string, score double, n_words int")


def rows_of(frame, *names):
    return sorted((tuple(row[name] for name in names) for row in frame.collect()), key=repr)


# Token counts


def plain_count(text: str, scores: dict[str, float]) -> tuple[int, int]:
    low = min(scores.values()) - 10
    best = [(0.0, 0, 0)] + [(-math.inf, 0, 0)] * len(text)
    for end in range(1, len(text) + 1):
        options = [(best[i][0] + scores[text[i:end]], -best[i][1] - 1, best[i][2]) for i in range(end) if text[i:end] in scores]
        if text[end - 1] not in scores:
            before = best[end - 1]
            options.append((before[0] + low, -before[1] - len(text[end - 1].encode()), before[2] + 1))
        score, tokens, unknown = max(options)
        best[end] = score, -tokens, unknown
    return best[-1][1:]


def test_trie_counts_equal_plain_forward_search():
    random.seed(3)
    scores = {"▁": -3.0, "▁a": -2.0, "a": -4.0, "b": -4.5, "ab": -5.0, "ba": -1.5, "bab": -3.2, "▁ab": -5.5}
    trie = tokencounts.PrefixTrie(scores, limit=200)
    for _ in range(500):
        word = "".join(random.choice("abc") for _ in range(random.randint(1, 9)))
        assert trie.count(word) == plain_count("▁" + word, scores), word


def test_token_counts_of_odd_rows(odd, spark):
    found = tokencounts.token_counts(odd, tokenizer("piece_bpe_32k.model"))
    scores = tokencounts.unigram_scores(tokenizer("piece_bpe_32k.model"))
    expected = []
    for doc_id, text, _ in ODD:
        words = (text or "").split()
        counts = {word: plain_count("▁" + word, scores) for word in set(words)}
        expected.append((doc_id, len(words), sum(counts[w][0] for w in words), sum(counts[w][1] for w in words)))
    assert rows_of(found, "doc_id", "n_words", "n_tokens", "n_unknown") == sorted(expected, key=repr)
    assert tokencounts.token_counts(odd.limit(0), tokenizer("piece_bpe_32k.model")).count() == 0


# Packing


def check_packing(pieces, docs, size=1024):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    wanted = sorted(
        ((d, [*encoder.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in docs), key=repr
    )
    sequences = {}
    for row in pieces:
        sequences.setdefault(row["sequence_id"], []).append(row)
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for row in own:
            assert row["offset"] == at
            at += row["length"]
        assert at <= size and at & (at - 1) == 0, at
    by_id = {}
    for d, ids in wanted:
        by_id.setdefault(d, []).append(ids)
    for d, all_ids in by_id.items():
        own = [r for r in pieces if r["doc_id"] == d]
        assert sum(r["length"] for r in own) == sum(map(len, all_ids))
        for r in own:
            part = [np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes() for ids in all_ids if len(ids) == r["doc_tokens"]]
            assert r["ids_crc32"] in [zlib.crc32(p) for p in part]
        if len(all_ids) == 1:
            at = 0
            for r in sorted(own, key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]


def test_packing_is_whole_and_unpadded(odd, spark, sf_dir):
    encoder = tokenizer("byte_bpe_50k.json")
    check_packing(packing.packed(odd, encoder).collect(), [(d, t) for d, t, _ in ODD])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    many = docs.repartition(40)
    check_packing(packing.packed(many, encoder, spaces=3).collect(), [tuple(r) for r in docs.collect()])
    assert packing.packed(odd.limit(0), encoder).count() == 0


def test_packing_refuses_other_sizes(odd):
    with pytest.raises(ValueError):
        packing.packed(odd, tokenizer("byte_bpe_50k.json"), size=1000)


def test_fast_ids_equal_the_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), packing.TokenBytes(tokenizer("byte_bpe_50k.json"))
    for text in [" a  b ", "x\n\n y z", "", "\tq 　 r", "it's 'twas don't", "a <|endoftext|> b", "é à́ ß 12 a1b2", "😀日本"]:
        assert np.frombuffer(own.of(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_blank_runs_have_the_library_s_ids(spark):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), packing.TokenBytes(path)
    texts = [" " * 1_500_000, "a" + "\n" * 1_500_000 + "b", "x" + " \n\t" * 400_000]
    for text in texts:
        assert np.frombuffer(own.of(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    docs = [(i, text) for i, text in enumerate([*texts, "short"])]
    check_packing(packing.packed(spark.createDataFrame(docs, "doc_id long, text string"), path).collect(), docs)


# Language


def plain_ngrams(text: str) -> dict[str, int]:
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    counts: dict[str, int] = {}
    for word in words:
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram != " " and " " not in gram[1:-1]:
                    counts[gram] = counts.get(gram, 0) + 1
    return counts


def test_ngrams_equal_plain_count():
    for text in ["It's a day, ÉTÉ 12 été", "x", "", None, "日本語 の", "a-b_c\n\nd"]:
        keys, counts = langid.ngrams(text)
        found = {}
        for key, n in zip(keys.tolist(), counts.tolist()):
            gram = ""
            while key:
                gram = chr(key & 0x1FFFFF) + gram
                key >>= 21
            found[gram] = n
        assert found == plain_ngrams(text or "")


@pytest.mark.parametrize("most", [1, 3, 7, 50, 10_000])
def test_ngrams_of_portions_equal_those_of_whole_texts(most):
    texts = ["It's a day, ÉTÉ 12 été", "", "日本語 の" * 9, "a-b_c\n\nd " * 30, "x" * 300, "ü"]
    portions = list(langid.portions(texts, most))
    keys, counts = langid.added_up(map(langid.portion_ngrams, portions))
    whole = langid.portion_ngrams("\n".join(texts))
    assert dict(zip(keys.tolist(), counts.tolist())) == dict(zip(*(a.tolist() for a in whole)))
    assert max(map(len, portions)) <= most + 301 and langid.added_up([])[0].size == 0


def test_long_texts_are_counted_by_portions(monkeypatch):
    text = "It was a day, été 12, and a night. " * 50
    whole = langid.ngrams(text)
    monkeypatch.setattr(langid, "PORTION", 100)
    monkeypatch.setattr(langid.portions, "__defaults__", (100,))
    parts = langid.ngrams(text)
    assert dict(zip(*(a.tolist() for a in parts))) == dict(zip(*(a.tolist() for a in whole)))


def test_nearest_language_by_plain_ranks_and_ties_by_name():
    profiles = {"b": [5, 9, 7], "a": [5, 9, 7], "c": [9, 5]}
    tables = langid.Profiles(profiles)
    text = "the sun of the day"
    grams = langid.ranked(*langid.ngrams(text), langid.LISTED).tolist()
    own = {"a": grams[:3][::-1], "b": grams[:3], "c": grams[:3]}
    far = {
        lang: sum(min(abs(ranks.index(g) - i), 3) if g in ranks else 3 for i, g in enumerate(grams)) for lang, ranks in own.items()
    }
    assert langid.Profiles(own).predict(text) == ("b", pytest.approx(1 - far["b"] / (3 * len(grams)))) and far["b"] < far["a"]
    assert tables.predict(text)[0] == "a"


def test_languages_of_odd_rows(odd, spark):
    train = spark.createDataFrame([("en", "the day of the night and the sun"), ("fr", "le jour de la nuit et le soleil"), (None, "x"), ("de", None)], "lang string, text string")
    profiles = langid.learn_profiles(train)
    assert sorted(profiles) == ["en", "fr"]
    found = langid.identify(odd, profiles)
    assert found.columns.count("score") == 1 and found.count() == len(ODD)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert [rows[i]["lang_pred"] for i in (2, 3, 4)] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert {r["lang_pred"] for r in langid.identify(odd, {}).collect()} == {"und"}


def test_language_accuracy_on_held_out(spark):
    found = QUERIES["op5_langid"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    hits = [r["lang"] == r["lang_pred"] for r in found.where("held_out").join(docs, "doc_id").collect()]
    assert np.mean(hits) > 0.97


# Quality


def plain_marginals(odds, pairs):
    """P(good) of every line by summing over all labellings."""
    n = len(odds)
    total, good = 0.0, np.zeros(n)
    for labels in np.ndindex(*[2] * n):
        value = sum((odds[i] / 2 if y else -odds[i] / 2) for i, y in enumerate(labels))
        value += sum(pairs[a, b] for a, b in zip(labels, labels[1:]))
        total += math.exp(value)
        good += math.exp(value) * np.array(labels)
    return good / total


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    sizes = np.array([3, 1, 6, 2])
    field = quality.LineField(np.zeros(3 * quality.FEATURES), rng.normal(size=(2, 2)))
    odds = rng.normal(size=sizes.sum()) * 2
    good, edges = field.passes(odds, sizes)
    at = 0
    for size in sizes:
        assert np.allclose(good[at : at + size], plain_marginals(odds[at : at + size], field.pairs))
        at += size
    assert edges.sum() == pytest.approx((sizes - 1).sum())


def test_quality_accuracy_on_held_out(spark):
    found = QUERIES["op1_quality"](spark, "/root/testdata/sf0.01").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def test_quality_of_odd_rows(odd):
    scored = quality.score(odd, quality.LineField.blank()).collect()
    assert len(scored) == len(ODD) and all(r["quality_score"] == pytest.approx(0.5) for r in scored)


def test_training_without_rows_is_blank(odd, spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert not quality.train(odd, none).weights.any()


def test_training_reads_whole_texts(spark):
    same = "\n".join(f"the same line {i % 7}" for i in range(400))
    good, bad = same + "\nIt was a fine day for all of us." * 200, same + "\n$$$ 12 >> 34 ##" * 200
    docs = spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    low, high = quality.train(docs, labels).scores(["$$$ 12 >> 34 ##", "It was a fine day for all of us."])
    assert high - low > 0.1
    assert not quality.train(docs, labels, most_lines=599).weights.any()


# Page text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu of the site</a></li></ul></nav><div class="ad">Buy now.</div>
<article><h1>Title &amp; more</h1><p>It was the day of the night and the sun was in the sky, as it is on all the days of the year.
<p>Short   one.<br>Next</p><aside>Aside of the day and the night and more of it all in the sky and the sun.</aside>
<section id="comments"><p>I like the text of the day and the night, it is the best of all that I have read in years.</p></section>
</article><form><input name="q"><p>Search</p></form><footer>&copy; the owner of the site"""


def test_page_text():
    assert htmltext.main_text(PAGE) == (
        "Title & more\n\nIt was the day of the night and the sun was in the sky, as it is on all the days of the year.\n\nShort one. Next"
    )


def test_blocks_without_article_take_their_neighbours_label():
    good = "It was the day of the night and the sun was in the sky, as it is on all the days of the year."
    page = f"<div><p>Head</p><p>{good}</p><p>Then.</p></div><ul><li><a href=x>one</a></li><li>two</li></ul>"
    assert htmltext.main_text(page) == f"Head\n\n{good}"  # "Then." stands as near to a link


@pytest.mark.parametrize("paragraph", [
    "Утром поезд вышел из старого города и медленно пошёл вдоль берега моря, а люди в вагонах долго смотрели на воду и горы.",
    "Rano pociąg wyjechał ze starego miasta i powoli jechał wzdłuż brzegu morza, a ludzie długo patrzyli na wodę oraz góry.",
    "早上火车离开了老城，沿着海岸慢慢地行驶，车上的人们长时间望着海水和远处的群山，没有人说话。",
])
def test_pages_of_divs_in_unlisted_languages(paragraph):
    menu = "<div class='menu'><a href='/a'>A</a> <a href='/b'>B</a></div>"
    links = "<div><a href='/c'>C c c c</a> <a href='/d'>D d d d</a></div>"
    page = f"{menu}<div><h1>Title</h1></div><div>{paragraph}</div><div>{paragraph * 3}</div>{links}<div class='footer'>(c) 2020 {paragraph}</div>"
    assert htmltext.main_text(page) == f"Title\n\n{paragraph}\n\n{paragraph * 3}"


def test_furniture_has_no_say_on_its_neighbours():
    good = "It was the day of the night and the sun was in the sky, as it is on all the days of the year."
    assert htmltext.main_text(f"<nav>Menu</nav><h1>Head</h1><p>{good}</p><footer>End</footer>") == f"Head\n\n{good}"


RUNNING = "It was the day of the night and the sun was in the sky, as it is on all the days of the year."


@pytest.mark.parametrize("around", [
    '<div class="layout has-sidebar">{}</div>', '<article class="post no-comments">{}</article>', '<div id="social-science">{}</div>',
    '<section class="legal">{}</section>', '<form method=post><article>{}</article></form>', '<div class="content-wrapper form">{}</div>',
    '<form><div class="notice"><main>{}</main></div></form>',
])
def test_a_class_word_or_form_around_the_article_hides_nothing(around):
    menu, foot = '<nav><a href="/">Menu</a></nav>', '<div class="site-footer">All rights of the page are with the owner.</div>'
    page = f"<body>{menu}{around.format(f'<h1>Head</h1><p>{RUNNING}</p><p>{RUNNING * 2}</p>')}{foot}</body>"
    assert htmltext.main_text(page) == f"Head\n\n{RUNNING}\n\n{RUNNING * 2}"


@pytest.mark.parametrize("inside", [
    '<div class="comment-list"><p>{}</p></div>', '<ul class="comments"><li>{}</li></ul>', '<div id=respond>{}</div>', '<aside>{}</aside>',
    '<div class="main sponsored">{}</div>', '<form><label>{}</label></form>', '<div class="cookie-bar">{}</div>', "<div role=search>{}</div>",
])
def test_furniture_in_an_article_stays_out(inside):
    page = f"<article><p>{RUNNING}</p><p>{RUNNING * 2}</p>{inside.format(RUNNING)}</article>"
    assert htmltext.main_text(page) == f"{RUNNING}\n\n{RUNNING * 2}"


def test_comments_stay_out_though_they_are_longer():
    comments = f"<div class='comments'><p>{RUNNING * 3}</p><p>{RUNNING * 4}</p></div>"
    assert htmltext.main_text(f"<div><p>{RUNNING}</p>{comments}</div>") == RUNNING


@pytest.mark.parametrize("markup", [
    '<svg width="1"/>', "<math/>", "<svg><path d='M0'/></svg>", "<canvas>", "<svg>", "<p title=it's>", "<p title=a'b class=x>", '<p data-x="a>b">',
    "<script>var a = '<p>';</script>", "<template><p>T</p></template>", "<p =x 'y'>", "<P\nCLASS='ad-free'>", "<img alt=\"it's\">",
])
def test_markup_hides_no_text_after_it(markup):
    assert htmltext.main_text(f"<article><p>{RUNNING}</p>{markup}{RUNNING}</article>").replace("\n\n", "") == RUNNING * 2


def test_open_elements_take_linear_time():
    start = time.perf_counter()
    for part in ("<svg>x ", "<p title='>", "<a b=\">", "<!-", "< a= ='"):
        htmltext.main_text(part * 40_000)
    assert time.perf_counter() - start < 60


def test_odd_pages(spark):
    pages = [(1, "u", None), (2, "u", ""), (3, None, "<p"), (4, "u", "<b>x" * 3000), (4, "u", "plain"), (None, "u", "<a href='<p>'>t</a")]
    rows = htmltext.extract(spark.createDataFrame([(*p, "e") for p in pages], "page_id long, url string, html string, text string")).collect()
    assert len(rows) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert htmltext.main_text("plain") == "plain" and htmltext.main_text(None) == ""
    assert htmltext.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0

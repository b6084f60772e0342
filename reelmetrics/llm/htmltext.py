"""Main text of web pages by two passes of block rules."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent function words of the languages the rules know; in others length and links decide.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he i this are or his from at which but have an had "
    "they you were there been one all we can her has will if no when who so "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie "
    "nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man "
    "de la que el en los se del las un por con no una su para es al lo como más pero sus le ya este si porque esta entre "
    "cuando muy sin sobre también me hasta hay donde quien desde todo nos "
    "le les et des est une dans qui pour pas au sur ne ce il sont avec plus par je mais ou nous elle leur ont aux cette "
    "ses être comme même son sa ces".split()
)
#: Length below which a block is short, and from which stop words decide alone; link and stop-word shares.
SHORT, LONG, MANY_LINKS, FEW_STOPS, MANY_STOPS = 70, 200, 0.33, 0.1, 0.25

GAP_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE_TAGS = frozenset("nav footer aside form menu dialog head button select textarea option fieldset iframe object".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer comment comments commentlist disqus respond cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended form search widget masthead copyright legal disclaimer pagination pager toolbar".split()
)
#: Of these, the words of reader comments: their text is never the article, however much of it there is.
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond".split())
#: Class words that mean page furniture only outside the article.
FRAME_WORDS = frozenset("header head top".split())
#: Words that say nothing beside one of the words above: `site-footer` is a footer, `no-comments` is not a list of comments.
PLAIN_WORDS = frozenset(
    "site page main global primary secondary inner outer left right top bottom box bar block section wrapper wrap container "
    "content area list item items slot unit links link buttons button posts header body widget text menu panel region".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Attributes as browsers read them: quotes count at the start of a value only.
VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|[^\s/>=]+(?:\s*=\s*{VALUE})?|=)*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^<>]*\Z",
    re.S,
)
ATTRIBUTE = re.compile(rf"([^\s/>=]+)(?:\s*=\s*({VALUE}))?")
#: Elements without text to read; those in CODE_TAGS cannot be closed by `/>` and last to the page's end if nothing ends them.
CODE_TAGS = frozenset("script style xmp".split())
SKIPPED_ENDS = {
    tag: re.compile(rf"</{tag}\s*>", re.I) for tag in (*CODE_TAGS, "noscript", "template", "svg", "math", "canvas")
}
WORD = re.compile(r"[^\W\d_]+")
#: Characters of scripts without spaces; one says as much as three letters.
DENSE = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")
SPACE = re.compile(r"\s+")


@dataclass
class Block:
    """Text between two block boundaries, with what the rules look at.

    `outside`: in furniture by tag or role, or by a mark that counts. `marks`: places in the page of the elements around it
    that only a class word, an id or the form tag calls furniture.
    """

    text: str
    links: int
    outside: bool
    marks: tuple[int, ...]
    article: int
    heading: bool
    good: bool | None = None


def attributes(text: str) -> dict[str, str]:
    return {name.lower(): html.unescape(value.strip("\"'")).lower() for name, value in ATTRIBUTE.findall(text)}


def means(token: str, inside: bool) -> frozenset[str]:
    """The furniture words of one class or id; none if other words beside them give it another meaning."""
    words = frozenset(re.split(r"[^a-z]+", token)) - {""}
    own = words & OUTSIDE_WORDS if inside else words & (OUTSIDE_WORDS | FRAME_WORDS)
    return own if words <= own | PLAIN_WORDS else frozenset()


def furniture(tag: str, attrs: dict[str, str], inside: bool) -> str | None:
    """How an element is a menu, form, advert, comment or the like: `sure` by tag, role or words of comments, `marked`
    by another class word, its id or as a form, None if it is not."""
    if attrs.get("role") in OUTSIDE_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return "sure"
    if (tag in OUTSIDE_TAGS and tag != "form") or (tag == "header" and not inside):
        return "sure"
    if tag in ("html", "body", "main"):
        return None
    if "display:none" in attrs.get("style", "").replace(" ", ""):
        return "sure"
    words = frozenset().union(*(means(token, inside) for token in [*attrs.get("class", "").split(), attrs.get("id", "")]))
    if words & COMMENT_WORDS:
        return "sure"
    return "marked" if words or tag == "form" else None


def blocks(page: str, released: frozenset[int] = frozenset()) -> list[Block]:
    """The page's non-empty blocks in order; marks of elements at the places `released` do not count."""
    found: list[Block] = []
    stack: list[tuple[str, bool, tuple[int, ...], int]] = []
    texts: list[str] = []
    linked: list[str] = []
    endless: set[str] = set()
    at, articles, link, heading = 0, 0, 0, False

    def around() -> tuple[bool, tuple[int, ...], int]:
        return stack[-1][1:] if stack else (False, (), 0)

    def enter(tag: str, attrs: dict[str, str], place: int) -> None:
        nonlocal articles
        sure, marks, article = around()
        own = furniture(tag, attrs, bool(article))
        if own == "marked" and place not in released:
            marks = (*marks, place)
        body = tag in ("article", "main") or attrs.get("role") in ("main", "article") or "articlebody" in attrs.get("itemprop", "")
        if body and not (article or sure or marks or own == "sure"):
            articles += 1
            article = articles
        stack.append((tag, sure or own == "sure", marks, article))

    def close() -> None:
        nonlocal texts, linked
        text = SPACE.sub(" ", html.unescape("".join(texts))).strip()
        if text:
            links = len(SPACE.sub(" ", html.unescape("".join(linked))).strip())
            sure, marks, article = around()
            found.append(Block(text, links, sure or bool(marks), () if sure else marks, article, heading))
        texts, linked = [], []

    def take(text: str) -> None:
        if text:
            texts.append(text)
            if link:
                linked.append(text)

    while match := TOKEN.search(page, at):
        take(page[at : match.start()])
        at = match.end()
        slash, tag, inner = match.group(1), (match.group(2) or "").lower(), match.group(3) or ""
        if not tag:
            continue
        if tag in SKIPPED_ENDS and not slash and tag not in endless and (tag in CODE_TAGS or not inner.endswith("/")):
            if end := SKIPPED_ENDS[tag].search(page, at):
                at = end.end()
                continue
            if tag in CODE_TAGS:
                at = len(page)
                break
            endless.add(tag)
        if tag == "br":
            take(" ")
        elif tag == "a":
            link = 0 if slash else 1
        if tag in GAP_TAGS:
            close()
            link = 0
            heading = tag in HEADINGS and not slash
        if tag in VOID_TAGS:
            continue
        if tag == "body":
            stack = []
        if slash:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
        elif tag in GAP_TAGS or tag in OUTSIDE_TAGS:
            if tag in ("p", "li") and stack and stack[-1][0] == tag:
                stack.pop()
            enter(tag, attributes(inner), match.start())
        elif inner and not inner.endswith("/") and re.search(r"class|id|hidden|role|style", inner, re.I):
            enter(tag, attributes(inner), match.start())
    take(page[at:])
    close()
    return found


def holds_most(found: list[Block]) -> frozenset[int]:
    """Places of the marked elements that hold more than half of the page's running text: a class word, an id or a form
    around a whole page says nothing of its text."""
    total, inside = 0, Counter()
    for block in found:
        size = len(block.text) + 2 * len(DENSE.findall(block.text))
        if (block.outside and not block.marks) or block.heading or size < SHORT or block.links > MANY_LINKS * len(block.text):
            continue
        total += size
        for place in block.marks:
            inside[place] += size
    return frozenset(place for place, size in inside.items() if 2 * size > total)


def first_pass(found: list[Block]) -> None:
    """good, bad, or None where length, links and stop words leave it open.

    Where the blocks that could be good have almost no known stop words the language is none the rules know: there
    the blocks that are not short are good.
    """
    marked = any(block.article and not block.outside for block in found)
    stops, words, open_ = 0, 0, []
    for block in found:
        length = len(block.text)
        if block.outside or (marked and not block.article) or block.links > MANY_LINKS * length:
            block.good = False
        elif length + 2 * len(DENSE.findall(block.text)) < SHORT or block.heading:
            block.good = False if block.links and not block.article else None
        else:
            own = WORD.findall(block.text.lower())
            known = sum(word in STOP_WORDS for word in own)
            stops, words = stops + known, words + len(own)
            open_.append((block, length, known / max(1, len(own))))
    unlisted = stops < FEW_STOPS * words
    for block, length, share in open_:
        if unlisted or (length >= SHORT and (share >= MANY_STOPS or (length >= LONG and share >= FEW_STOPS))):
            block.good = True
        elif length < SHORT and block.links and not block.article:
            block.good = False


def second_pass(found: list[Block]) -> None:
    """Open blocks take the label of the nearest decided block of their article (or of the page, outside articles).

    Furniture has no say. At equal distance an article's block is good and a page's bad; without decided neighbours it
    is good.
    """
    decided: dict[int, list[int]] = {}
    for i, block in enumerate(found):
        if block.good is not None and not block.outside:
            decided.setdefault(block.article, []).append(i)
    before: dict[int, int] = {}
    labels: dict[int, bool] = {}
    after = {article: 0 for article in decided}
    for i, block in enumerate(found):
        own = decided.get(block.article, [])
        at = after.get(block.article, 0)
        while at < len(own) and own[at] <= i:
            before[block.article] = own[at]
            at += 1
        after[block.article] = at
        if block.good is None:
            near = [j for j in (before.get(block.article), own[at] if at < len(own) else None) if j is not None]
            if near:
                least = min(abs(j - i) for j in near)
                votes = [found[j].good for j in near if abs(j - i) == least]
                labels[i] = all(votes) or (bool(block.article) and any(votes))
            else:
                labels[i] = True
    for i, good in labels.items():
        found[i].good = good


def main_text(page: str | None) -> str:
    """The article's blocks joined by a blank line; empty for null, empty or furniture-only pages.

    A class word, an id or a form hides an element unless it holds most of the running text; comments are hidden always.
    """
    found = blocks(page or "")
    if released := holds_most(found):
        found = blocks(page, released)
    first_pass(found)
    second_pass(found)
    return "\n\n".join(block.text for block in found if block.good)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row; repeated rows and null ids give rows too."""

    @F.pandas_udf("string")
    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(main_text, na_action=None)

    return pages.select("page_id", "url", texts("html").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))

"""Comment text: cleaning and scoring."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Token sets of the default scorer. They carry no meaning; on the
# invented test prose they yield all three classes.
POSITIVE_TOKENS = ("the", "der", "la", "le")
NEGATIVE_TOKENS = ("and", "und", "de", "et")

# Class label to score.
LABEL_SCORES = {"positive": 1, "neutral": 0, "negative": -1}


def clean_comment(comment: Column) -> Column:
    """Drop both quote characters and wrap the text in double quotes."""
    bare = comment.cast("string")
    for quote in ("'", '"'):
        bare = F.replace(bare, F.lit(quote), F.lit(""))
    return F.concat(F.lit('"'), bare, F.lit('"'))


def lexicon_score(
    text: Column,
    positive: Iterable[str] = POSITIVE_TOKENS,
    negative: Iterable[str] = NEGATIVE_TOKENS,
) -> Column:
    """Sign of (positive tokens - negative tokens); tokens are split at spaces."""
    tokens = F.split(F.lower(text), " ")
    weight = lambda token: (
        F.when(token.isin(*positive), 1).when(token.isin(*negative), -1).otherwise(0)
    )
    total = F.aggregate(tokens, F.lit(0), lambda total, token: total + weight(token))
    return F.signum(total).cast("int")


# Loaded models of this process, by the scorer that loaded them.
_MODELS: dict[str, Callable[[list[str]], list[str | int]]] = {}


def model_score(
    load: Callable[[], Callable[[list[str]], list[str | int]]], batch_size: int = 8
) -> Callable[[Column], Column]:
    """Adapt a text classifier to a scorer.

    ``load`` runs once per Python process, whatever the number of its tasks, and returns a function from a list of
    texts to labels or scores; it is called with at most ``batch_size`` texts.
    """

    name = uuid.uuid4().hex

    @F.pandas_udf("int")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from reelmetrics.functions.text import _MODELS as models  # the process's, not a pickled copy

        classify = models.get(name)
        if classify is None:
            classify = models[name] = load()
        for texts in batches:
            found = texts.dropna()
            scores: list[int] = []
            for start in range(0, len(found), batch_size):
                answers = classify(found.iloc[start : start + batch_size].tolist())
                scores += [LABEL_SCORES.get(a, a) for a in answers]
            yield pd.Series(scores, index=found.index, dtype="Int32").reindex(texts.index)

    return score

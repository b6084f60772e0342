"""Token counts by a unigram model: words share the forward scores of their prefixes in a trie."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .common import texts_with_id, with_long_id

MARK = "▁"


def unigram_scores(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file with log probabilities by Zipf's law over their order (frequent first).

    Control, unknown and byte pieces are left out: a character no piece covers costs its UTF-8 bytes.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    total = sum(1 / (rank + 1) for rank in range(len(pieces)))
    return {piece: -math.log((rank + 1) * total) for rank, piece in enumerate(pieces)}


class PrefixTrie:
    """Best segmentations of words, computed once for each prefix.

    A node is a prefix; it keeps its best log probability, tokens and unknown characters. The best score wins,
    then fewer tokens. Past `limit` nodes the trie starts anew, which bounds memory and changes no count.
    """

    def __init__(self, scores: dict[str, float], limit: int = 400_000) -> None:
        self.scores, self.limit = scores, limit
        self.unknown = min(scores.values(), default=0.0) - 10
        # Every ending of a piece, with the piece's score if it is one: a search backwards stops at the first other.
        self.endings: dict[str, float | None] = {piece[i:]: None for piece in scores for i in range(len(piece))}
        self.endings.update(scores)
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
        self.counts: dict[str, tuple[int, int]] = {}

    def count(self, word: str) -> tuple[int, int]:
        """Tokens and unknown characters of a word."""
        known = self.counts.get(word)
        if known is None:
            known = self.counts[word] = self.insert(MARK + word)
        return known

    def insert(self, text: str) -> tuple[int, int]:
        if len(self.best) > self.limit:
            self.clear()
        child, best, endings = self.child, self.best, self.endings
        node, path = 0, [0]
        for end, char in enumerate(text, 1):
            key = (node, char)
            before, node = node, child.get(key)
            if node is None:
                score, tokens, unknown = best[before]
                if endings.get(char) is None:
                    score, tokens, unknown = score + self.unknown, tokens + len(char.encode("utf-8", "surrogatepass")), unknown + 1
                else:
                    score, tokens = score + endings[char], tokens + 1
                start = end - 1
                while start:
                    start -= 1
                    piece = text[start:end]
                    if piece not in endings:
                        break
                    own = endings[piece]
                    if own is not None:
                        at = best[path[start]]
                        if (own := own + at[0]) > score or (own == score and at[1] + 1 < tokens):
                            score, tokens, unknown = own, at[1] + 1, at[2]
                node = child[key] = len(best)
                best.append((score, tokens, unknown))
            path.append(node)
        return best[node][1:]


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown (characters outside the pieces) of every whole text.

    Words are runs between Unicode white space, each with a leading mark. Null and empty texts count 0; repeated
    rows and null ids give a row each; other columns are left aside.
    """
    scores = unigram_scores(model_path)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = PrefixTrie(scores)
        for frame in frames:
            rows = []
            for text in frame["text"]:
                words = text.split() if text else []
                found = [trie.count(word) for word in words]
                rows.append((len(words), sum(n for n, _ in found), sum(n for _, n in found)))
            counts = pd.DataFrame(rows, columns=["n_words", "n_tokens", "n_unknown"])
            yield counts.assign(doc_id=frame["doc_id"].to_numpy())

    return with_long_id(texts_with_id(docs).mapInPandas(counted, "doc_id string, n_words long, n_tokens long, n_unknown long"))

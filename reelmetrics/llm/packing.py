"""Bounded-space packing of documents into sequences: few open windows a task, best fit, leftovers merged at last."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, texts_with_id, with_long_id

#: Open windows a task, and tasks whose leftovers meet in one task of the next round.
OPEN_WINDOWS, FAN_IN = 8, 32
PIECES = (
    "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "capacity long, ids binary"
)
COLUMNS = [part.split()[0] for part in PIECES.split(", ")]


class TokenBytes:
    """Ids of a byte-pair vocabulary as little-endian 32-bit words.

    The ids are those of the tokenizers library, computed by a faster encoder of the same merges; a text that holds
    one of the vocabulary's added tokens goes to the library itself, and so does a text the faster one gives up on
    (its pattern runs out of stack in about a million blanks in a row).
    """

    def __init__(self, tokenizer_path: str) -> None:
        import tiktoken
        import tokenizers

        with open(tokenizer_path, encoding="utf-8") as file:
            model = json.load(file)
        # The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, others from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.special = [t["content"] for t in model.get("added_tokens", [])]
        ranks = {bytes(letters[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in self.special}
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = tokenizers.Tokenizer.from_file(tokenizer_path)

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not any(token in text for token in self.special):
            try:
                return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4").tobytes()
            except ValueError:
                pass
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class Window:
    """An open sequence: its pieces and how many ids it has."""

    __slots__ = ("pieces", "used")

    def __init__(self) -> None:
        self.pieces: list[tuple] = []
        self.used = 0


class Packer:
    """Best fit over at most `spaces` open windows of `size` ids.

    A piece goes to the fullest window that holds it. If none does and all windows are open, the fullest is topped
    up with the head of the piece, emitted full, and the rest is placed anew.
    """

    def __init__(self, size: int, spaces: int, first_id: int) -> None:
        self.size, self.spaces, self.next_id = size, spaces, first_id
        self.open: list[Window] = []
        self.rows: list[tuple] = []

    def add(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        while ids:
            n = len(ids) // 4
            if n >= self.size:
                head, ids = ids[: 4 * self.size], ids[4 * self.size :]
                full = Window()
                self.put(full, doc_id, start, head, doc_tokens)
                self.emit(full, self.size)
                start += self.size
                continue
            fits = [w for w in self.open if self.size - w.used >= n]
            if fits:
                window = max(fits, key=lambda w: w.used)
                self.put(window, doc_id, start, ids, doc_tokens)
            elif len(self.open) < self.spaces:
                window = Window()
                self.open.append(window)
                self.put(window, doc_id, start, ids, doc_tokens)
            else:
                window = max(self.open, key=lambda w: w.used)
                room = self.size - window.used
                self.put(window, doc_id, start, ids[: 4 * room], doc_tokens)
                self.close(window)
                start, ids = start + room, ids[4 * room :]
                continue
            if window.used == self.size:
                self.close(window)
            return

    def put(self, window: Window, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        window.pieces.append((doc_id, start, ids, doc_tokens))
        window.used += len(ids) // 4

    def close(self, window: Window) -> None:
        self.open.remove(window)
        self.emit(window, self.size)

    def emit(self, window: Window, capacity: int | None, keep: bool = False) -> None:
        """Rows of a window; capacity is null and the ids are kept while it may still be merged."""
        offset = 0
        for doc_id, start, ids, doc_tokens in window.pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, zlib.crc32(ids), doc_tokens, self.next_id, offset, capacity, ids if keep else None))
            offset += n
        self.next_id += 1

    def leave(self) -> None:
        """Open windows as leftovers."""
        for window in self.open:
            self.emit(window, None, keep=True)
        self.open = []

    def finish(self) -> None:
        """Open windows cut at powers of two, so that none needs padding."""
        last = self.open
        self.open = []
        for window in last:
            pieces, size = window.pieces, 1
            while size * 2 <= window.used:
                size *= 2
            while pieces:
                part, room = Window(), size
                rest = []
                for doc_id, start, ids, doc_tokens in pieces:
                    head, tail = ids[: 4 * room], ids[4 * room :]
                    if head:
                        self.put(part, doc_id, start, head, doc_tokens)
                        room -= len(head) // 4
                    if tail:
                        rest.append((doc_id, start + len(head) // 4, tail, doc_tokens))
                self.emit(part, size)
                pieces = rest
                left = sum(len(p[2]) // 4 for p in rest)
                while size > left > 0:
                    size //= 2

    def taken(self) -> pd.DataFrame:
        frame = pd.DataFrame(self.rows, columns=COLUMNS)
        self.rows = []
        return frame.astype({"capacity": "Int64"})


def packed(docs: DataFrame, tokenizer_path: str, size: int = 1024, spaces: int = OPEN_WINDOWS, end_id: int = 0) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, capacity, ids.

    A document is its ids followed by `end_id` (null or empty text: that id alone). Each task packs its rows with
    `spaces` open windows; what stays open is merged in rounds, the windows of FAN_IN tasks in one, until one task
    is left, whose last windows are cut at powers of two. Hence no sequence is padded: capacity is `size`, or a power of
    two for the few last ones, and always the sum of its pieces. Repeated rows and null ids are packed like others.
    Sequence ids are unique, not dense. `ids` is kept only while a window may still be merged.
    """
    if size & (size - 1):
        raise ValueError("the window size must be a power of two")
    end = np.array([end_id], "<u4").tobytes()

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder = TokenBytes(tokenizer_path)
        packer = Packer(size, spaces, TaskContext.get().partitionId() << 36)
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = encoder.of(text) + end
                packer.add(doc_id, 0, ids, len(ids) // 4)
                if len(packer.rows) >= 50_000:
                    yield packer.taken()
            yield packer.taken()
        packer.leave()
        yield packer.taken()

    def merged(turn: int, last: bool):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext

            packer = Packer(size, spaces, turn << 60 | TaskContext.get().partitionId() << 36)
            for frame in frames:
                for row in frame.itertuples(index=False):
                    packer.add(row.doc_id, row.start, row.ids, row.doc_tokens)
                yield packer.taken()
            packer.finish() if last else packer.leave()
            yield packer.taken()

        return run

    source = texts_with_id(docs)
    done = saved(source.mapInPandas(first, PIECES))
    out, turn = [done.where("capacity is not null")], 0
    rest = done.where("capacity is null")
    while True:
        turn += 1
        open_tasks = rest.select(F.shiftright("sequence_id", 36).alias("task")).distinct().count()
        groups = -(-open_tasks // FAN_IN)
        last = groups <= 1
        # Leftovers of one task keep together; their order is fixed, so a lost task gives the same pieces again.
        task = F.shiftright("sequence_id", 36) % F.lit(1 << 24)
        dealt = rest.repartition(max(1, groups), task % max(1, groups)).sortWithinPartitions("sequence_id", "offset")
        done = saved(dealt.mapInPandas(merged(min(turn, 7), last), PIECES))
        out.append(done.where("capacity is not null"))
        if last:
            break
        rest = done.where("capacity is null")
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return with_long_id(result)

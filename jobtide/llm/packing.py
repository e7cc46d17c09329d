"""Order-preserving packing of tokenised documents into windows.

Documents stay in the order of their input split, so nothing is shuffled.  A
window may end at a document, after a sentence, or (at a higher price) at every
64th token.  With ``f`` the least cost up to a cut and windows of at most W,

    f(j) = penalty(j) + min over pos(j) - W <= pos(i) < pos(j) of f(i) + W - (pos(j) - pos(i))

so the minimum slides over ``f(i) + pos(i)``: a monotone queue makes each cut
enter and leave once.  Tokens are packed in stretches; the last window of a
stretch is open and goes on with the next one.  What is left at the end of a
split is padded, or cut into powers of two, which need no padding, if that is
cheaper.

Defined cases: a null or empty text is the one end id.  A null ``doc_id`` is
passed through.  Repeated rows are packed each.  A sequence never spans two
splits; its id is the split's number and a count, so a split that is computed
again gives the same ids.  Other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from jobtide.llm.common import record_batch, slices, texts_of

WINDOW = 2048
#: Prices of a cut, in tokens of padding.
AFTER_SENTENCE, WITHIN_SENTENCE = 8, 32
HARD_STEP = 64
#: Tokens packed at a time, and distinct word ids remembered by a worker.
STRETCH = 128 * WINDOW
REMEMBERED = 500_000
END_ID = 1
#: Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Two white spaces side by side, or a blank at an end; and a blank between two other marks.
_WIDE = re.compile(r"\s\s|^ | $")
_ASCII_WIDE = [pair for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f" for pair in (c + " ", " " + c)]
_BLANK = re.compile(r"(?<=\S) (?=\S)")
DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, padded_length long"
)


class Encoder:
    """Token ids of whole texts.

    A single blank between two other marks always starts a token, so the parts between such
    blanks are encoded alone, each with the blank before it, and remembered.
    """

    def __init__(self, path: str) -> None:
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {_bytes_of(t): i for t, i in vocabulary.items() if t not in added}
        # The same merges, several times as fast on the short parts that are not remembered yet.
        merge = Encoding("parts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added = re.compile("|".join(map(re.escape, sorted(added)))) if added else None
        self.known = _Remembered(merge)
        ends = tuple(x.encode() for x in ".!?\n")
        self.ends_sentence = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends_sentence[[i for t, i in ranks.items() if t.endswith(ends)]] = True

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.added:  # these stand for themselves wherever they occur: left to the library
            plain = [not self.added.search(t) for t in texts]
        else:
            plain = [True] * len(texts)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known.__getitem__
        end = array("I", [END_ID]).tobytes()
        cut = (_parts(t) if p else (t, []) for t, p in zip(texts, plain, strict=True))
        return [np.frombuffer(b"".join([self._ids(head), *map(known, rest), end]), dtype="<u4") for head, rest in cut]


class _Remembered(dict):
    """Ids, as bytes, of a part and the blank before it."""

    def __init__(self, merge: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.merge = merge

    def __missing__(self, part: str) -> bytes:
        self[part] = found = array("I", self.merge(" " + part)).tobytes()
        return found


def _bytes_of(token: str) -> bytes:
    """The bytes that a token of the byte-level alphabet stands for."""
    return bytes(map(_ALPHABET.__getitem__, token))


def _alphabet() -> dict[str, int]:
    """Printable bytes of Latin-1 stand for themselves, the others for the letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


_ALPHABET = _alphabet()


def _parts(text: str) -> tuple[str, list[str]]:
    """The text up to the first such blank, and what follows each of them."""
    parts = text.split(" ")
    if text.isascii():
        wide = "" in parts or any(x in text for x in _ASCII_WIDE)
    else:
        wide = _WIDE.search(text)
    head, *rest = _BLANK.split(text) if wide else parts
    return head, rest


def best_cuts(
    cuts: list[int], prices: list[int], window: int = WINDOW, last: bool = True, tail_price: int = AFTER_SENTENCE
) -> list[int]:
    """Ends of the windows over tokens ``0 .. cuts[-1]``; ``cuts`` ascending, gaps of at most a window.

    ``last``: the final cut must be an end, and its window may be cut into powers of two.
    Otherwise the cheapest of the cuts in the final window's reach ends the result.
    """
    at, cost, come = [0, *cuts], [0] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    queue: deque[int] = deque([0])
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0]] < here - window:
            queue.popleft()
        i = come[j] = queue[0]
        cost[j] = cost[i] + at[i] + window - here + prices[j - 1]
        value = cost[j] + here
        while queue and cost[queue[-1]] + at[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    end = len(at) - 1
    tail: list[int] = []
    if last:
        least = None
        for i in range(end - 1, -1, -1):
            rest = at[end] - at[i]
            if rest > window:
                break
            powers = (rest.bit_count() - 1) * tail_price
            price = cost[i] + min(window - rest, powers)
            if least is None or price < least:
                least, come[end] = price, i
                tail = _powers(at[i], rest) if powers < window - rest else []
    else:
        reach = [j for j in range(1, len(at)) if at[j] > at[end] - window]
        end = min(reach, key=lambda j: (cost[j], -j))
    out = []
    j = end
    while j:
        out.append(at[j])
        j = come[j]
    return sorted({*out, *tail})


def _powers(start: int, length: int) -> list[int]:
    out = []
    for bit in range(length.bit_length() - 1, -1, -1):
        if length >> bit & 1:
            start += 1 << bit
            out.append(start)
    return out


class _Packer:
    """The open documents of one split: ``(doc_id, ids, start in the document, document's length)``."""

    def __init__(self, ends_sentence: np.ndarray, window: int, first_id: int) -> None:
        self.ends_sentence, self.window, self.next_id = ends_sentence, window, first_id
        self.open: list[tuple[int | None, np.ndarray, int, int]] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.open.append((doc_id, ids, 0, len(ids)))
        self.size += len(ids)

    def flush(self, last: bool) -> list[tuple]:
        if not self.open:
            return []
        ids = np.concatenate([x[1] for x in self.open])
        ends = np.cumsum([len(x[1]) for x in self.open])
        price = np.full(len(ids) + 1, -1, dtype=np.int64)
        price[HARD_STEP::HARD_STEP] = WITHIN_SENTENCE
        price[1:][self.ends_sentence[ids]] = AFTER_SENTENCE
        price[ends] = 0
        cuts = np.flatnonzero(price >= 0)
        cuts = cuts[cuts > 0]
        bounds = best_cuts(cuts.tolist(), price[cuts].tolist(), self.window, last)
        rows, begin = [], 0
        starts = (ends - [len(x[1]) for x in self.open]).tolist()
        for end in bounds:
            used = end - begin
            padded = used if used & (used - 1) == 0 else self.window
            at = begin
            while at < end:
                k = bisect_right(starts, at) - 1
                doc_id, own, done, whole = self.open[k]
                a = at - starts[k]
                z = min(len(own), end - starts[k])
                crc = zlib.crc32(own[a:z].tobytes())
                rows.append((doc_id, done + a, z - a, crc, whole, self.next_id, at - begin, padded))
                at = starts[k] + z
            self.next_id += 1
            begin = end
        k = bisect_right(ends.tolist(), begin)
        if k < len(self.open):
            doc_id, own, done, whole = self.open[k]
            a = begin - starts[k]
            self.open = [(doc_id, own[a:], done + a, whole), *self.open[k + 1 :]]
        else:
            self.open = []
        self.size = len(ids) - begin
        return rows


_ENCODERS: dict[str, Encoder] = {}


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    padded_length``.  ``tokenizer``: a byte-level BPE file of the ``tokenizers`` library, which
    every executor can read."""
    kinds = [(x.split()[0], pa.int64()) for x in DDL.split(", ")]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, Encoder(tokenizer))
        packer = _Packer(encoder.ends_sentence, window, TaskContext.get().partitionId() << 32)

        def out(last: bool) -> Iterator[pa.RecordBatch]:
            if rows := packer.flush(last):
                yield record_batch(list(zip(*rows, strict=True)), schema)

        for batch in slices(batches, 200):
            ids = encoder.encode(batch.column(1).to_pylist())
            for doc_id, tokens in zip(batch.column(0).to_pylist(), ids, strict=True):
                packer.add(doc_id, tokens)
            if packer.size >= STRETCH:
                yield from out(last=False)
        yield from out(last=True)

    return texts_of(docs).mapInArrow(run, DDL)

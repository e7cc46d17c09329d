"""Two tokenizers aligned over the bytes of every document, with corpus-wide pair counts by external spill counting.

A text is cut at single blanks between two other marks, where tokens of both tokenizers
start, so each part is aligned once per worker and remembered.  Where a token of one and a
token of the other overlap, the pair of ids is a link.

Counting how many documents hold a pair:

1. *Spill.*  A task gathers ``(pair, document, times)`` records, sorts them by pair and spills
   them as runs, radix-partitioned by the first tokenizer's id into buckets, each a zstd
   block in a table of the shared folder.  The head of a block has its distinct pairs with
   their numbers of documents, the tail the documents.
2. *Merge.*  A bucket's heads, and only these, are shuffled together: a pair costs one entry
   per run, however many documents hold it, so a frequent pair or id is no hot group.  A k-way
   heap merge adds up each pair.  Pairs come ordered by the first tokenizer's id; when an id
   is over, its maximum is known, and the counts of its pairs go back to the runs they came from.
3. *Return.*  A run's tails and the counts sent back to it meet by run, and are added up per
   document.

Runs are bounded in records and documents, whatever the input.  What is spilled is written
once and read from there, so a lost executor repeats tasks, not runs.

Defined cases: a text that is null or empty, or that the tokens of either tokenizer do not
spell out byte by byte behind a blank, has no tokens: zeros and an empty string.  Special
tokens' strings are plain text.  Repeated rows, and rows without ``doc_id``, are documents
each.  Of equal counts all are the highest.  An empty table gives an empty result.  Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from jobtide.llm import packing
from jobtide.llm.common import record_batch, slices, stored, text_bytes, texts_of

#: Records and documents of a run, and bytes of text per bucket.
RUN_RECORDS, RUN_DOCS = 4_000_000, 1 << 18
BUCKET_BYTES = 1 << 30
LEAST_BUCKETS, MOST_BUCKETS = 12, 1024
#: Parts remembered by a worker, the longest of them, and parts aligned at once.
REMEMBERED, LONGEST_REMEMBERED, LEARNT_AT_A_TIME = 400_000, 200, 50_000
MARK = "▁"


class Aligner(dict):
    """``part -> (n_a, n_b, n_groups, links, groups)`` of ``" " + part``; None where the tokens do not spell it."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        super().__init__()
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(byte_level)
        self.whole.encode_special_tokens = True
        added = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        ranks = {packing._bytes_of(t): i for t, i in vocabulary.items() if t not in added}
        self.merge = Encoding("parts", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for shown, i in ranks.items():
            self.a_bytes[i] = shown
        model = SentencePieceProcessor(model_file=pieces)
        self.b_encode = model.encode
        self.n_b = model.get_piece_size()
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in ((i, model.id_to_piece(i)) for i in range(self.n_b))
        ]
        #: Only where no piece goes on behind a later word mark is a blank a cut for both.
        self.cuts = not any(MARK in model.id_to_piece(i).lstrip(MARK) for i in range(self.n_b))
        n_a = len(self.a_bytes)
        self.n_pairs = n_a * self.n_b
        self.a_size, self.b_size = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        # How an id is written in a group, before another of its side, and at the end of its side.
        shown = [f"{i}{mark}" for n, ends in ((n_a, ",|"), (self.n_b, ",;")) for i in range(n) for mark in ends]
        self.shown = np.array(shown, dtype=object)

    def _a_ids(self, part: str) -> list[int]:
        # White space and controls, which the two libraries may class differently, are left to the one that is asked for.
        plain = " " not in part and part.isprintable()
        return self.merge(" " + part) if plain else self.whole.encode(" " + part, add_special_tokens=False).ids

    def learn(self, parts: list[str]) -> None:
        """Aligns parts that are not remembered, all at once."""
        raw = [(" " + p).encode() for p in parts]
        a, b = list(map(self._a_ids, parts)), self.b_encode(parts, num_threads=1)
        a_all, b_all = list(chain.from_iterable(a)), list(chain.from_iterable(b))
        whole = b"".join(raw)
        spelled = all(b"".join(map(x.__getitem__, ids)) == whole for x, ids in ((self.a_bytes, a_all), (self.b_bytes, b_all)))
        part_end = np.cumsum(list(map(len, raw)))
        n_a, n_b = np.array(list(map(len, a))), np.array(list(map(len, b)))
        if spelled and n_a.all() and n_b.all():
            a_ids, b_ids = np.array(a_all), np.array(b_all)
            a_end, b_end = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
            spelled = all((end[np.cumsum(n) - 1] == part_end).all() for end, n in ((a_end, n_a), (b_end, n_b)))
        if not spelled:
            spells = [all(b"".join(map(x.__getitem__, ids)) == r for x, ids in ((self.a_bytes, i), (self.b_bytes, j))) for r, i, j in zip(raw, a, b, strict=True)]
            self.update((p, None) for p, ok in zip(parts, spells, strict=True) if not ok)
            if any(spells):
                self.learn([p for p, ok in zip(parts, spells, strict=True) if ok])
            return
        # Ends of both sides, ascending; a place where both end stands there twice.
        both = np.sort(np.concatenate((a_end, b_end)))
        again = np.concatenate((both[1:] == both[:-1], [False]))
        shared, ends = both[again], both[~again]
        links = (a_ids[np.searchsorted(a_end, ends)] * self.n_b + b_ids[np.searchsorted(b_end, ends)]).astype(link_type(self.n_pairs))
        # Side by side within its group stands what a token is written as.
        a_group, b_group = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        a_before = np.concatenate(([0], np.searchsorted(a_end, shared, "right")))
        b_before = np.concatenate(([0], np.searchsorted(b_end, shared, "right")))
        written = np.empty(len(a_ids) + len(b_ids), dtype=object)
        a_place = np.arange(len(a_ids)) + b_before[a_group]
        b_place = np.arange(len(b_ids)) + a_before[b_group + 1]
        written[a_place] = self.shown[2 * a_ids + (a_end == shared[a_group])]
        written[b_place] = self.shown[2 * (len(self.a_bytes) + b_ids) + (b_end == shared[b_group])]
        shown = written.tolist()
        raw_links, width = links.tobytes(), links.itemsize
        link_end, group_end = (np.searchsorted(x, part_end, "right").tolist() for x in (ends, shared))
        at = link = group = 0
        for part, x, y, k, g in zip(parts, n_a.tolist(), n_b.tolist(), link_end, group_end, strict=True):
            text = "".join(shown[at : at + x + y])[:-1]
            self[part] = (x, y, g - group, raw_links[link * width : k * width], text)
            at, link, group = at + x + y, k, g

    def documents(self, texts: list[str]) -> list[tuple[int, int, int, bytes, str]]:
        """Of each text: tokens of both, groups, links and the groups' hash."""
        split = [packing._parts(t) if self.cuts else (t, []) for t in texts]
        asked = {p for text, (head, rest) in zip(texts, split, strict=True) if text for p in (head, *rest)}
        if len(self) + len(asked) > REMEMBERED:
            self.clear()
        missing = [p for p in asked if p not in self]
        for i in range(0, len(missing), LEARNT_AT_A_TIME):
            self.learn(missing[i : i + LEARNT_AT_A_TIME])
        out = []
        for text, (head, rest) in zip(texts, split, strict=True):
            found = [self[head], *map(self.__getitem__, rest)] if text else [None]
            if None in found:
                out.append((0, 0, 0, b"", ""))
            else:
                a, b, n, links, groups = zip(*found, strict=True)
                digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
                out.append((sum(a), sum(b), sum(n), b"".join(links), digest))
        for p in missing:
            if len(p) > LONGEST_REMEMBERED:
                del self[p]
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def link_type(n_pairs: int) -> str:
    return "<u4" if n_pairs < 1 << 32 else "<i8"


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as one zstd block, byte planes apart."""
    planes = [np.ascontiguousarray(x, dtype="<i8").view("u1").reshape(-1, 8).T for x in arrays]
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(planes).tobytes())


def unpacked(block: bytes, n_arrays: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), "u1").reshape(n_arrays, 8, -1)
    return [np.ascontiguousarray(p.T).view("<i8").ravel() for p in planes]


DOC_FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
_DOC_NAMES, _N_LINKS = (*DOC_FIELDS, "groups_sha256"), 4
_DOC_TYPE = pa.struct([*((n, pa.int64()) for n in DOC_FIELDS), ("groups_sha256", pa.string())])
RUN_SCHEMA = pa.schema(
    [("run", pa.int64()), ("bucket", pa.int32()), ("heads", pa.binary()), ("tails", pa.binary()), ("docs", pa.list_(_DOC_TYPE))]
)
RUN_DDL = (
    "run long, bucket int, heads binary, tails binary, "
    "docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string>>"
)
SENT_DDL = "run long, bucket int, counts binary"
SENT_SCHEMA = pa.schema([("run", pa.int64()), ("bucket", pa.int32()), ("counts", pa.binary())])
OUT_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
OUT_SCHEMA = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (x.split() for x in OUT_DDL.split(", "))])


class Run:
    """The records of some documents, until they are spilled."""

    def __init__(self, n_b: int, n_pairs: int, buckets: int) -> None:
        self.n_b, self.n_pairs, self.buckets = n_b, n_pairs, buckets
        self.link_type = link_type(n_pairs)
        self.width = np.dtype(self.link_type).itemsize
        self.docs: list[tuple] = []
        self.records: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, docs: list[tuple], links: list[bytes]) -> None:
        """``docs``: rows as in ``DOC_FIELDS`` and the hash; ``links``: pairs of each."""
        own = np.frombuffer(b"".join(links), self.link_type)
        ordinal = np.repeat(np.arange(len(self.docs), len(self.docs) + len(docs)), [d[_N_LINKS] for d in docs])
        every = np.sort(ordinal * self.n_pairs + own)
        first = np.flatnonzero(np.concatenate((np.ones(min(len(every), 1), dtype=bool), every[1:] != every[:-1])))
        found, times = every[first], np.diff(first, append=len(every))
        self.docs += docs
        self.records.append((found, times))
        self.size += len(found)

    def full(self) -> bool:
        return self.size >= RUN_RECORDS or len(self.docs) >= RUN_DOCS

    def spilled(self, run: int) -> Iterator[pa.RecordBatch]:
        """A row with the documents, and a row per bucket with its block."""
        if not self.docs:
            return
        rows: list[tuple] = [(run, -1, None, None, [dict(zip(_DOC_NAMES, d, strict=True)) for d in self.docs])]
        record, times = (np.concatenate(x) for x in zip(*self.records, strict=True))
        ordinal, pair = np.divmod(record, self.n_pairs)
        # By bucket, first id, second id and document.
        bucket = bucket_of(pair // self.n_b, self.buckets)
        order = np.lexsort((ordinal, pair, bucket))
        ordinal, pair, bucket, times = ordinal[order], pair[order], bucket[order], times[order]
        ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket))
        begin = 0
        for end in ends.tolist() if len(bucket) else ():
            own = pair[begin:end]
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            heads = packed(np.diff(own[first], prepend=0), np.diff(first, append=len(own)))
            tails = packed(np.diff(ordinal[begin:end], prepend=0), times[begin:end])
            rows.append((run, int(bucket[begin]), heads, tails, None))
            begin = end
        self.docs, self.records, self.size = [], [], 0
        for row in rows:
            yield record_batch([[x] for x in row], RUN_SCHEMA)


def bucket_of(first_id: np.ndarray, buckets: int) -> np.ndarray:
    return ((first_id * 2_654_435_761) >> 16) % buckets


def spill(docs: DataFrame, byte_level: str, pieces: str, buckets: int) -> DataFrame:
    """Runs of pair-document records; both tokenizer files must be readable by every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (byte_level, pieces)
        aligner = _ALIGNERS.get(key) or _ALIGNERS.setdefault(key, Aligner(*key))
        number = TaskContext.get().partitionId() << 32
        now = Run(aligner.n_b, aligner.n_pairs, buckets)
        for batch in slices(batches, 200):
            found = aligner.documents(batch.column(1).to_pylist())
            ids = batch.column(0).to_pylist()
            rows = [(d, a, b, n, len(own) // now.width, groups) for d, (a, b, n, own, groups) in zip(ids, found, strict=True)]
            now.add(rows, [x[3] for x in found])
            if now.full():
                yield from now.spilled(number)
                number += 1
        yield from now.spilled(number)

    return texts_of(docs).mapInArrow(run, RUN_DDL)


def merged(bucket: pa.Table, n_b: int) -> pa.Table:
    """``run, bucket, counts`` from one bucket's heads: for each run its pairs' counts, in order, and which are highest."""
    runs = bucket.column("run").to_pylist()
    counts: list[list[int]] = [[] for _ in runs]
    highest: list[list[bool]] = [[] for _ in runs]

    def entries(k: int, block: bytes) -> Iterator[tuple[int, int, int]]:
        step, n = unpacked(block, 2)
        return zip(np.cumsum(step).tolist(), [k] * len(n), n.tolist(), strict=True)

    side: list[tuple[int, list[int]]] = []  # the pairs of the first id at hand: count and runs

    def over() -> None:
        most = max(n for n, _ in side)
        for n, held in side:
            for k in held:
                counts[k].append(n)
                highest[k].append(n == most)
        side.clear()

    last = None
    heads = (entries(k, block.as_py()) for k, block in enumerate(bucket.column("heads")))
    for pair, found in groupby(heapq.merge(*heads), key=itemgetter(0)):
        if side and pair // n_b != last:
            over()
        last, total, held = pair // n_b, 0, []
        for _, k, n in found:
            total += n
            held.append(k)
        side.append((total, held))
    if side:
        over()
    blocks = [packed(np.array(n), np.array(h)) for n, h in zip(counts, highest, strict=True)]
    return pa.Table.from_arrays([pa.array(runs, pa.int64()), bucket.column("bucket"), pa.array(blocks, pa.binary())], schema=SENT_SCHEMA)


def returned(run: pa.Table, sent: pa.Table) -> pa.Table:
    """The documents of one run, with what their links add up to."""
    counts = dict(zip(sent.column("bucket").to_pylist(), sent.column("counts"), strict=True))
    rows = run.to_pylist()
    docs = next(r["docs"] for r in rows if r["bucket"] < 0)
    best, total = np.zeros((2, len(docs)), dtype=np.int64)
    for r in rows:
        if r["bucket"] >= 0:
            _, held = unpacked(r["heads"], 2)
            step, times = unpacked(r["tails"], 2)
            ordinal = np.cumsum(step)
            n, high = (np.repeat(x, held) for x in unpacked(counts[r["bucket"]].as_py(), 2))
            np.add.at(total, ordinal, n * times)
            np.add.at(best, ordinal, high * times)
    columns = {name: [d[name] for d in docs] for name in _DOC_NAMES} | {"n_best": best, "count_sum": total}
    return pa.Table.from_arrays([pa.array(columns[f.name], f.type) for f in OUT_SCHEMA], schema=OUT_SCHEMA)


def align(docs: DataFrame, byte_level: str, pieces: str, buckets: int | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``."""
    from sentencepiece import SentencePieceProcessor

    n_b = SentencePieceProcessor(model_file=pieces).get_piece_size()
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, text_bytes(docs) // BUCKET_BYTES))
    runs = stored(spill(docs, byte_level, pieces, buckets), "runs")
    heads = runs.filter("bucket >= 0").select("run", "bucket", "heads")
    sent = heads.groupBy("bucket").applyInArrow(lambda bucket: merged(bucket, n_b), SENT_DDL)
    return runs.groupBy("run").cogroup(sent.groupBy("run")).applyInArrow(returned, OUT_DDL)

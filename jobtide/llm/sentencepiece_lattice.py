"""SentencePiece encoding and decoding over a relational lattice.

A text is cut at each blank that follows another character; a word is what stands
between two such blanks, with the word mark before it and for every blank in it.  Every distinct word is encoded once: its substrings of bounded
length are exploded and equi-joined to the piece table, the joined edges are
grouped by word, and a fold with Spark's higher-order ``aggregate`` reads the ids
off the lattice.  Words stay where the count of words put them, so grouping the
edges needs no further shuffle.  The piece table is the model's vocabulary, which
is what bounds the broadcast.

The fold depends on the vocabulary.  With unigram scores it is Viterbi: over the
word's positions, the best path to each.  A byte-pair vocabulary scores a piece by
the rank of its merge, and the best sum of ranks is not what such a model means:
there the fold takes the edges by rank, once, and merges two neighbours wherever
an edge spans just these.  (A merge that only one of higher rank makes possible
would be left out; a trained vocabulary, whose longer pieces have the higher
ranks, gives no such words, and a test compares all with the model's library.)

A character without a piece is encoded by its UTF-8 bytes, as byte pieces, at a
price above every piece; so every text can be encoded, and decoding gives it back
exactly, U+2581 included, which is always written in bytes.  A word of more than
``MOST_WORD_CHARS`` is cut where two neighbouring characters occur in no piece, so
that no piece could span the cut, and its parts, the later ones without the mark,
are encoded apart.  A part that has no such place stays whole; its lattice is not
exploded into rows, and ``encode_long`` reads the same ids off it in one task.

Defined cases: a null text is empty; an empty text is one empty word, encoded as
the word mark.  Equal sums: the greater list of ids wins; equal ranks: the
leftmost.  Repeated rows count each; rows without ``doc_id`` count like others.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import record_batch, slices, text_bytes, texts_of

MARK = "\u2581"
#: Stands for a mark inside of a word while pieces are looked up: no piece has it.
INNER_MARK = "\uf8ff"
#: Price of a byte above the dearest piece, as in unigram models.
BYTE_PRICE = 10.0
MOST_WORD_CHARS = 256
DISTINCT_AT_A_TIME = 400_000
TEXT_PER_PARTITION = 4 << 20
#: Words that are asked for at a time, and bytes of text in a block of documents.
ASKED_AT_A_TIME = 300_000
BLOCK_BYTES = 8 << 20
_CUT = re.compile(r"(?<=[^ ]) ")


@dataclass(frozen=True)
class Vocabulary:
    """``pieces``: (piece, id, score) of ordinary pieces; ``byte_ids``: the id of each byte.

    ``merges``: scores are ranks of merges, not logarithms of probabilities.
    """

    pieces: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...]
    merges: bool = False

    @property
    def byte_price(self) -> float:
        return BYTE_PRICE - min(s for _, _, s in self.pieces)

    @cached_property
    def neighbours(self) -> frozenset[str]:
        """All two characters that stand side by side in a piece."""
        return frozenset(p[i : i + 2] for p, _, _ in self.pieces for i in range(len(p) - 1))

    @cached_property
    def longest(self) -> int:
        """Characters of the longest piece, which bounds the substrings of a word."""
        return max((len(p) for p, _, _ in self.pieces), default=1)

    @cached_property
    def table(self) -> dict[str, tuple[int, float]]:
        return {p: (i, s) for p, i, s in self.pieces}


def load_vocabulary(path: str, merges: bool) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces, byte_ids = [], [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if INNER_MARK not in piece:
                pieces.append((piece, i, float(model.get_score(i))))
    return Vocabulary(tuple(pieces), tuple(byte_ids), merges)


def words_of(text: str) -> list[str]:
    """The text cut at each blank that follows another character."""
    return _CUT.split(text) if "  " in text or text.startswith(" ") else text.split(" ")


def marked(word: str, lead: bool) -> str:
    """The word as pieces are looked up in it."""
    return (MARK if lead else "") + word.replace(MARK, INNER_MARK).replace(" ", MARK)


def parts_of(word: str, vocabulary: Vocabulary) -> Iterator[tuple[str, bool]]:
    """A word cut where no piece can span the cut, into parts of ``MOST_WORD_CHARS`` where there are such places.

    The flag says whether the word mark leads.
    """
    if len(word) <= MOST_WORD_CHARS:
        yield word, True
        return
    line, known = marked(word, False), vocabulary.neighbours
    begin = last = 0
    for at in range(1, len(word)):
        if line[at - 1 : at + 1] not in known:
            if last > begin and at - begin > MOST_WORD_CHARS:
                yield word[begin:last], begin == 0
                begin = last
            last = at
    if last > begin and len(word) - begin > MOST_WORD_CHARS:
        yield word[begin:last], begin == 0
        begin = last
    yield word[begin:], begin == 0


def units(text: str, vocabulary: Vocabulary) -> Iterator[tuple[str, bool]]:
    """The words of a text, long ones in parts."""
    for word in words_of(text):
        yield from parts_of(word, vocabulary)


def encode_long(line: str, vocabulary: Vocabulary) -> list[int]:
    """Ids of a marked line of any length: what the folds below find, without an edge list per position."""
    ends = _merged_ends(line, vocabulary) if vocabulary.merges else _best_ends(line, vocabulary)
    out, begin = [], 0
    for end in ends:
        piece = line[begin:end]
        found = vocabulary.table.get(piece)
        if found:
            out.append(found[0])
        else:
            out += [vocabulary.byte_ids[b] for b in piece.replace(INNER_MARK, MARK).encode()]
        begin = end
    return out


def _merged_ends(line: str, vocabulary: Vocabulary) -> list[int]:
    """Ends of the symbols after merging neighbours by rank, equal ranks from the left."""
    n, table = len(line), vocabulary.table
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the symbol that starts here
    heap: list[tuple[float, int, int, int]] = []

    def offer(start: int) -> tuple[float, int, int, int] | None:
        middle = after[start]
        if middle < n:
            found = table.get(line[start : after[middle]]) if after[middle] - start <= vocabulary.longest else None
            if found:
                return -found[1], start, middle, after[middle]
        return None

    heap = [x for x in map(offer, range(n)) if x]
    heapify(heap)
    while heap:
        _, start, middle, end = heappop(heap)
        if after[start] != middle or middle < 0 or after[middle] != end:
            continue  # one of the two has been merged since
        after[start], after[middle] = end, -1
        if end < n:
            before[end] = start
        for left in (before[start], start):
            if left >= 0 and (x := offer(left)):
                heappush(heap, x)
    ends, at = [], 0
    while at < n:
        at = after[at]
        ends.append(at)
    return ends


def _best_ends(line: str, vocabulary: Vocabulary) -> list[int]:
    """Ends of the pieces of the cheapest path; of equal sums the greater list of ids."""
    table, n = vocabulary.table, len(line)
    best: list[tuple[float, int]] = [(0.0, 0)]  # score, start of the last piece

    def path(end: int, start: int) -> list[int]:
        out = []
        while end:
            found = table.get(line[start:end])
            own = [found[0]] if found else [vocabulary.byte_ids[b] for b in line[start:end].replace(INNER_MARK, MARK).encode()]
            out += reversed(own)
            end, start = start, best[start][1]
        return out[::-1]

    for end in range(1, n + 1):
        arriving = []
        for start in range(max(0, end - vocabulary.longest), end):
            found = table.get(line[start:end])
            if found:
                arriving.append((best[start][0] - -found[1], start))
            elif end - start == 1:
                size = len(line[start:end].replace(INNER_MARK, MARK).encode())
                arriving.append((best[start][0] - vocabulary.byte_price * size, start))
        top = max(arriving)[0]
        tied = [x for x in arriving if x[0] == top]
        best.append(tied[0] if len(tied) == 1 else max(tied, key=lambda x: path(end, x[1])))
    ends, at = [], n
    while at:
        ends.append(at)
        at = best[at][1]
    return ends[::-1]


def word_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``word, lead, n``: how often each word occurs; words are counted per task before the shuffle."""
    schema = pa.schema([("word", pa.string()), ("lead", pa.bool_()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: Counter[str] = Counter()
        parts: Counter[str] = Counter()

        def counted() -> Iterator[pa.RecordBatch]:
            for found, lead in ((whole, True), (parts, False)):
                if found:
                    yield record_batch([list(found), [lead] * len(found), list(found.values())], schema)
                    found.clear()

        for batch in slices(batches, 100):
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                if max(map(len, words)) <= MOST_WORD_CHARS:
                    whole.update(words)
                else:
                    for word, lead in units(text, vocabulary):
                        (whole if lead else parts)[word] += 1
            if len(whole) > DISTINCT_AT_A_TIME:
                yield from counted()
        yield from counted()

    counted = texts_of(docs).select("text").mapInArrow(count, "word string, lead boolean, n long")
    # So many partitions that the edges of a partition's words are grouped in memory.
    parts = -(-text_bytes(docs) // TEXT_PER_PARTITION) or 1
    return counted.repartition(parts, "word", "lead").groupBy("word", "lead").agg(F.sum("n").alias("n"))


def piece_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    frame = pd.DataFrame(vocabulary.pieces, columns=["piece", "id", "score"])
    return spark.createDataFrame(frame, "piece string, id int, score double")


def edges(words: DataFrame, pieces: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds ``edge`` (price, start, end, ids) to ``words``: one row per edge of each word's lattice."""
    lead = F.when(F.col("lead"), F.lit(MARK)).otherwise("")
    marked = F.replace(F.replace("word", F.lit(MARK), F.lit(INNER_MARK)), F.lit(" "), F.lit(MARK))
    line = F.concat(lead, marked)
    byte_ids = F.array(*(F.lit(i) for i in vocabulary.byte_ids))
    raw = F.hex(F.encode(F.substring(F.concat(lead, "word"), F.col("at"), F.lit(1)), "UTF-8"))
    by_bytes = F.transform(
        F.sequence(F.lit(1), F.length(raw), F.lit(2)),
        lambda i: F.element_at(byte_ids, F.conv(F.substring(raw, i, F.lit(2)), 16, 10).cast("int") + 1),
    )
    longest = F.least(F.lit(vocabulary.longest), F.length("line") - F.col("at") + 1)
    spans = (
        words.withColumn("line", line)
        # A long part has one row, and no lattice.
        .select("*", F.explode(F.sequence(F.lit(1), F.when(_is_long(), 1).otherwise(F.length("line")))).alias("at"))
        .select("*", F.explode(F.sequence(F.lit(1), longest)).alias("size"))
        .withColumn("piece", F.substring("line", F.col("at"), F.col("size")))
    )
    joined = spans.join(F.broadcast(pieces), "piece", "left").filter("id IS NOT NULL OR size = 1")
    edge = F.struct(
        F.coalesce(-F.col("score"), F.lit(vocabulary.byte_price) * F.length(raw) / 2).alias("price"),
        (F.col("at") - 1).alias("start"),
        (F.col("at") + F.col("size") - 1).alias("end"),
        F.when(F.col("id").isNull(), by_bytes).otherwise(F.array("id")).alias("ids"),
    )
    return joined.select(*words.columns, edge.alias("edge"))


def _is_long() -> Column:
    return F.length("word") > MOST_WORD_CHARS


def _size(listed: Column) -> Column:
    return F.array_max(F.transform(listed, lambda e: e["end"]))


def best_path(listed: Column) -> Column:
    """Ids of the cheapest path through a word's edges, by a fold over the positions."""
    incoming = F.transform(
        F.sequence(F.lit(1), _size(listed)), lambda j: F.filter(listed, lambda e: e["end"] == j)
    )
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))

    def step(best: Column, arriving: Column) -> Column:
        paths = F.transform(
            arriving,
            lambda e: F.struct(
                (best[e["start"]]["score"] - e["price"]).alias("score"), F.concat(best[e["start"]]["ids"], e["ids"]).alias("ids")
            ),
        )
        return F.concat(best, F.array(F.array_max(paths)))

    return F.aggregate(incoming, start, step, lambda best: F.element_at(best, -1)["ids"])


def merged_pairs(listed: Column) -> Column:
    """Ids after merging neighbours by rank, by a fold over the edges; the state are the bounds of the symbols."""

    def merge(bounds: Column, edge: Column) -> Column:
        i = F.array_position(bounds, edge["start"]).cast("int")
        spans_two = (i > 0) & (F.try_element_at(bounds, i + 2) == edge["end"])
        return F.when(spans_two, F.array_remove(bounds, F.element_at(bounds, i + 1))).otherwise(bounds)

    place = lambda start, end: start * F.lit(MOST_WORD_CHARS + 2) + end

    def read(bounds: Column) -> Column:
        ends = F.slice(bounds, F.lit(2), F.size(bounds) - 1)
        places = F.transform(listed, lambda e: place(e["start"], e["end"]))
        own = F.zip_with(
            F.slice(bounds, F.lit(1), F.size(bounds) - 1), ends, lambda a, z: F.array_position(places, place(a, z))
        )
        return F.flatten(F.transform(own, lambda i: F.element_at(listed, i.cast("int"))["ids"]))

    ranked = F.sort_array(F.filter(listed, lambda e: e["end"] - e["start"] > 1))
    return F.aggregate(ranked, F.sequence(F.lit(0), _size(listed)), merge, read)


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``word, lead, n, ids`` of distinct words; ``n`` is passed on as it is."""
    pieces = piece_table(words.sparkSession, vocabulary)
    numbered = words.filter("lead OR word <> ''").withColumn("row", F.monotonically_increasing_id())
    # The row number is a short key to sort by; the word keeps the grouping where the words are.
    keys = ["row", "word", "lead", "n"]
    grouped = edges(numbered, pieces, vocabulary).groupBy(*keys).agg(F.collect_list("edge").alias("edges"))
    fold = merged_pairs if vocabulary.merges else best_path

    @F.pandas_udf("array<int>")
    def whole(words: pd.Series, leads: pd.Series) -> pd.Series:
        found = (w and encode_long(marked(w, y), vocabulary) for w, y in zip(words, leads, strict=True))
        return pd.Series(list(found), dtype=object)

    long = whole(F.when(_is_long(), F.col("word")), "lead")
    return grouped.select("word", "lead", "n", F.when(_is_long(), long).otherwise(fold(F.col("edges"))).alias("ids"))


def _shown(vocabulary: Vocabulary) -> dict[int, bytes]:
    """The bytes that an id stands for."""
    shown = {i: p.replace(MARK, " ").encode() for p, i, _ in vocabulary.pieces}
    return shown | {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}


def decoded(ids: Column, lead: Column, vocabulary: Vocabulary) -> Column:
    """The text that a list of ids stands for; with ``lead`` the first word mark is taken off."""
    shown = _shown(vocabulary)

    @F.pandas_udf("string")
    def decode(lists: pd.Series, leads: pd.Series) -> pd.Series:
        found = (b"".join(shown[i] for i in x).decode()[int(y) :] for x, y in zip(lists, leads, strict=True))
        return pd.Series(list(found), dtype=object)

    return decode(ids, lead)


def _blocks(docs: DataFrame, size: int) -> DataFrame:
    n = max(1, -(-size // BLOCK_BYTES))
    # Equal rows are dealt apart as well, by where they are read.
    block = F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(n)).alias("block")
    return texts_of(docs).select(block, "doc_id", "text").repartition("block")


def encode_documents(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, n_ids, ids, ids_crc32, decoded_sha256`` of every row of ``docs``.

    Documents are dealt to blocks of bounded size.  A block asks once for each of its words, each
    distinct word is encoded once, and block and answers meet in one task, which puts the ids of a
    text together, and decodes them.  ``ids_crc32``: of the ids as little-endian words of four bytes.
    """
    size = text_bytes(docs)
    blocks = _blocks(docs, size)
    asked_schema = pa.schema([("block", pa.int64()), ("word", pa.string()), ("lead", pa.bool_())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each word of a block once, or again after so many words that they are sent on."""
        of_block: dict[tuple[int, bool], set[str]] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for (block, lead), found in of_block.items():
                n = len(found)
                yield record_batch([np.full(n, block), list(found), np.full(n, lead)], asked_schema)
            of_block.clear()

        for part in slices(batches, 100):
            for block, text in zip(part.column("block").to_pylist(), part.column("text").to_pylist(), strict=True):
                words = words_of(text)
                if max(map(len, words)) <= MOST_WORD_CHARS:
                    of_block.setdefault((block, True), set()).update(words)
                else:
                    for unit, lead in units(text, vocabulary):
                        of_block.setdefault((block, lead), set()).add(unit)
            if sum(map(len, of_block.values())) > ASKED_AT_A_TIME:
                yield from sent()
        yield from sent()

    # All columns, so that questions and encodings read the same shuffled texts.
    asked = blocks.mapInArrow(ask, "block long, word string, lead boolean")
    asked = asked.repartition(-(-size // TEXT_PER_PARTITION) or 1, "word", "lead")
    # Each word is encoded once, where its questions are; those who asked meet the ids afterwards, in the same place.
    encoded = encode_words(asked.groupBy("word", "lead").agg(F.count("block").alias("n")), vocabulary)
    answers = asked.join(encoded.drop("n"), ["word", "lead"]).select("block", "word", "lead", "ids")
    shown = _shown(vocabulary)
    fields = [("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(pa.int32()))]
    schema = pa.schema([*fields, ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string())])

    def put_together(rows: pa.Table, known: pa.Table) -> pa.Table:
        ids = known.column("ids").combine_chunks()
        own = np.asarray(ids.flatten()).astype("<i4").tobytes()
        ends = (np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)) * 4).tolist()
        keys = zip(known.column("word").to_pylist(), known.column("lead").to_pylist(), strict=True)
        of_word: dict[str, bytes] = {}
        of_part: dict[str, bytes] = {}
        for (word, lead), a, z in zip(keys, [0, *ends], ends, strict=False):
            (of_word if lead else of_part)[word] = own[a:z]
        out: list[list] = [[], [], [], []]
        offsets = [0]
        for text in rows.column("text"):
            text = text.as_py()
            words = words_of(text)
            if max(map(len, words)) <= MOST_WORD_CHARS:
                raw = b"".join(map(of_word.__getitem__, words))
            else:
                raw = b"".join((of_word if lead else of_part)[u] for u, lead in units(text, vocabulary))
            found = np.frombuffer(raw, dtype="<i4")
            # The first mark is not a blank of the text.
            back = b"".join(map(shown.__getitem__, found.tolist()))[1:]
            offsets.append(offsets[-1] + len(found))
            for column, x in zip(out, (len(found), found, zlib.crc32(raw), hashlib.sha256(back).hexdigest()), strict=True):
                column.append(x)
        values = pa.array(np.concatenate([np.zeros(0, "<i4"), *out[1]]), pa.int32())
        lists = pa.LargeListArray.from_arrays(np.array(offsets, dtype=np.int64), values).cast(pa.list_(pa.int32()))
        doc_id = rows.column("doc_id").combine_chunks().cast(pa.int64())
        columns = [doc_id, pa.array(out[0], pa.int64()), lists, pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())]
        return pa.Table.from_arrays(columns, schema=schema)

    ddl = "doc_id long, n_ids long, ids array<int>, ids_crc32 long, decoded_sha256 string"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(put_together, ddl)

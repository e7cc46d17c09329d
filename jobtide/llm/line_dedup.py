"""Line dedup.

Long lines become 128-bit hashes, which are range-partitioned with the document
in the range and sorted by document and position.  One pass streams each range:
the first document of a run of equal hashes keeps its lines, later ones lose
them once enough documents were seen.  A run may be cut by the border of two
ranges, so a very common line is spread over as many tasks as it needs; every
range reports its first and last run (two rows), which settles the rows there.
The result is a compressed bitmap per document, not text.

Defined cases: a null text is one empty line.  Rows without ``doc_id`` lose
nothing and count for nothing.  Rows that repeat a ``doc_id`` count as one
document, and each row gets the bitmap of its own text.  Other columns are not
read.  Lines are told apart by 128-bit XXH3.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from jobtide.llm.common import SPACES, kept, record_batch, slices, texts_of

DROPPED, OPEN, BORDER = 0, 1, 2
LINE = "hi long, lo long, doc_id long, text_key long, pos long"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points."""
    schema = _arrow(LINE)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, text_keys, places, hashes = [], [], [], []
            for doc_id, text, text_key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for place, line in enumerate(text.split("\n")):
                    key = line.strip(SPACES)
                    if len(key) >= min_chars:
                        hashes.append(xxhash.xxh3_128_digest(key.encode().lower()))
                        ids.append(doc_id)
                        text_keys.append(text_key)
                        places.append(place)
            if ids:
                halves = np.frombuffer(b"".join(hashes), dtype=">i8").astype("i8").reshape(-1, 2)
                yield record_batch([halves[:, 0], halves[:, 1], ids, text_keys, places], schema)

    return docs.filter("doc_id IS NOT NULL").mapInArrow(lines, LINE)


def _stream_first(min_docs: int):
    """Marks lines of one sorted range: DROPPED rows, OPEN rows of a run that may reach
    over the border, and a BORDER row for the first and the last run."""
    ddl = f"{LINE}, kind int, n_docs long"
    schema = _arrow(ddl)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        run, first_run, n_docs, last, top, pending = None, True, 0, None, None, []

        def border():
            out.append((*run, top, 0, 0, BORDER, n_docs))

        for batch in batches:
            for hi, lo, doc_id, text_key, pos in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run != (hi, lo):
                    if run is not None:
                        if first_run:
                            border()
                        first_run = False
                    run, n_docs, last, top, pending = (hi, lo), 0, None, doc_id, []
                if doc_id != last:
                    n_docs, last = n_docs + 1, doc_id
                    if n_docs == min_docs and not first_run:
                        out.extend((*row, DROPPED, 0) for row in pending)
                        pending = []
                row = (hi, lo, doc_id, text_key, pos)
                if first_run:
                    out.append((*row, OPEN, 0))
                elif n_docs > 1:
                    if n_docs >= min_docs:
                        out.append((*row, DROPPED, 0))
                    else:
                        pending.append(row)
            if len(out) > 20_000:
                yield record_batch(list(zip(*out, strict=True)), schema)
                out = []
        if run is not None:
            out.extend((*row, OPEN, 0) for row in pending)
            border()
            yield record_batch(list(zip(*out, strict=True)), schema)

    return stream, ddl


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``doc_id, text_key, pos`` of every line that goes.  ``docs`` has these and ``text``."""
    stream, ddl = _stream_first(min_docs)
    order = ["hi", "lo", F.desc("doc_id")]
    marked = kept(
        line_hashes(docs, min_chars)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, "text_key", "pos")
        .mapInArrow(stream, ddl)
    )
    settled = (
        marked.filter(F.col("kind") == BORDER)
        .groupBy("hi", "lo")
        .agg(F.max("doc_id").alias("top"), F.sum("n_docs").alias("n"))
        .filter(F.col("n") >= min_docs)
        .drop("n")
    )
    where = ["doc_id", "text_key", "pos"]
    # At most two rows per range: the broadcast is bounded by the number of partitions.
    open_rows = marked.filter(F.col("kind") == OPEN).join(F.broadcast(settled), ["hi", "lo"])
    return (
        marked.filter(F.col("kind") == DROPPED)
        .select(*where)
        .union(open_rows.filter(F.col("doc_id") != F.col("top")).select(*where))
    )


@F.pandas_udf(BinaryType())
def _bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    def one(n: int, gone) -> bytes:
        bits = np.ones(n, dtype=bool)
        bits[np.asarray(gone, dtype=np.int64)] = False
        return zlib.compress(np.packbits(bits).tobytes(), 1)

    return pd.Series([one(*x) for x in zip(n_lines, dropped, strict=True)], dtype=object)


def with_text_key(docs: DataFrame, *more: str) -> DataFrame:
    return texts_of(docs, *more).withColumn("text_key", F.xxhash64("text"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``doc_id, text_key, n_lines, n_dropped, keep`` (zlib over one bit per line, 1: stays)."""
    keyed = with_text_key(docs)
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    sizes = keyed.select("doc_id", "text_key", n_lines.cast("long").alias("n"), F.lit(None).cast("long").alias("pos"))
    gone = dropped_lines(keyed, min_chars, min_docs)
    return (
        sizes.union(gone.select("doc_id", "text_key", F.lit(None).cast("long"), "pos"))
        .groupBy("doc_id", "text_key")
        .agg(F.max("n").alias("n_lines"), F.collect_set("pos").alias("gone"))
        .select(
            "doc_id",
            "text_key",
            "n_lines",
            F.size("gone").cast("long").alias("n_dropped"),
            _bitmap("n_lines", "gone").alias("keep"),
        )
    )


def keep_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text`` without the lines whose bit in ``keep`` is 0; the column ``keep`` goes, the others stay.

    Few texts are Python objects at a time, and each is handed back with its slice: a column of
    whole texts would be held several times over, as Arrow and as Python objects, in and out.
    """

    def one(text: str, keep: bytes) -> str:
        lines = text.split("\n")
        bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8), count=len(lines))
        return text if bits.all() else "\n".join(line for line, bit in zip(lines, bits, strict=True) if bit)

    for batch in slices(batches):
        at, kind = batch.schema.get_field_index("text"), batch.schema.field("text").type
        pairs = zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist(), strict=True)
        texts = pa.array([one(*x) for x in pairs], type=kind)
        yield batch.set_column(at, "text", texts).drop_columns(["keep"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` after the drop, ``n_lines``, ``n_dropped`` and the columns named."""
    keyed = with_text_key(docs, *more).alias("d")
    same = F.expr("d.doc_id <=> b.doc_id AND d.text_key = b.text_key")
    columns = ["d.doc_id", "d.text", *(f"d.{c}" for c in more), "b.n_lines", "b.n_dropped"]
    joined = keyed.join(bitmaps.alias("b"), same).select(*columns, "b.keep")
    return joined.mapInArrow(keep_lines, joined.drop("keep").schema)

"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its features are its own and those of the lines
before and after; neighbouring labels are tied by transition weights.  Training
takes documents' labels for all of their lines, from a bounded sample of labelled
documents.  A document's score is the mean of the lines' forward-backward
marginals, weighted by length.

Defined cases: a null text is empty; an empty text is one empty line and gets
that line's score.  Without labels of both kinds every score is the share of
label 1 (0.5 without labels).  Rows without ``doc_id`` are scored, and counted as
not held out.  Repeated rows are scored alike; a ``doc_id`` labelled twice counts
with its highest label.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import kept, record_batch, slices, texts_of

#: Labelled documents that training reads at most, each whole, and the lines of all of them: a bound on the fit.
SAMPLE_DOCS = 4000
SAMPLE_LINES = 800_000
HELD_OUT = 5
THRESHOLD = 0.3
ROUNDS = 300

_CLASSES = bytearray(b"s" * 256)
for _chars, _mark in (
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"U"),
    (b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)), b"l"),
    (b"0123456789", b"d"),
    (b" \t\x0b\x0c\r", b" "),
    (b".,;:'?-()", b"p"),
):
    for _c in _chars:
        _CLASSES[_c] = _mark[0]
_CLASSES = bytes(_CLASSES)
N_OWN = 14


def line_features(line: str) -> list[float]:
    raw = line.encode()
    n = len(raw)
    words = raw.split()
    if not words:
        return [1.0] + [0.0] * (N_OWN - 1)
    marks = raw.translate(_CLASSES)
    letters = marks.count(b"U") + marks.count(b"l")
    symbols = marks.count(b"s")
    k = len(words)
    tails = sum(1 for w in marks.split() if w.endswith(b"s"))
    repeats = sum(map(eq, words, words[1:]))
    distinct = len(set(words)) / k
    return [
        0.0,
        1.0,
        min(1.0, math.log2(1 + k) / 8),
        marks.count(b"U") / (letters + 1),
        float(marks.count(b"U") * 2 > letters),
        min(1.0, 5 * symbols / n),
        float(symbols * 20 > n),
        marks.count(b"d") / n,
        min(1.0, 5 * marks.count(b"p") / n),
        tails / k,
        repeats / k,
        distinct,
        float(distinct < 0.5),
        float(raw.rstrip().endswith((b".", b"!", b"?"))),
    ]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features per line (own, previous, next, bias) and the lines' lengths plus one."""
    lines = text.split("\n")
    own = np.array([line_features(x) for x in lines])
    edge = np.zeros((1, N_OWN))
    before, after = np.concatenate((edge, own[:-1])), np.concatenate((own[1:], edge))
    weight = np.array([len(x) + 1.0 for x in lines])
    return np.hstack((own, before, after, np.ones((len(lines), 1)))), weight


@dataclass
class LineField:
    """``emission`` weighs features for good against bad; ``transition[a, b]`` ties neighbours."""

    emission: np.ndarray
    transition: np.ndarray

    def marginals(self, features: np.ndarray) -> np.ndarray:
        """P(good) of every line, by scaled forward and backward passes."""
        odds = np.clip(features @ self.emission, -30, 30)
        good = (1 / (1 + np.exp(-odds))).tolist()
        (bb, bg), (gb, gg) = np.exp(self.transition).tolist()
        n = len(good)
        forward = []
        b, g = 1 - good[0], good[0]
        forward.append((b, g))
        for e in good[1:]:
            b, g = (b * bb + g * gb) * (1 - e), (b * bg + g * gg) * e
            total = b + g
            b, g = b / total, g / total
            forward.append((b, g))
        out = [0.0] * n
        b = g = 1.0
        for t in range(n - 1, -1, -1):
            fb, fg = forward[t]
            out[t] = fg * g / (fb * b + fg * g)
            e = good[t]
            b, g = bb * (1 - e) * b + bg * e * g, gb * (1 - e) * b + gg * e * g
            total = b + g
            b, g = b / total, g / total
        return np.array(out)

    def score(self, text: str) -> float:
        features, weight = document_features(text)
        return float(np.clip((self.marginals(features) * weight).sum() / weight.sum(), 0.0, 1.0))


def fit(documents: list[np.ndarray], labels: list[int], rounds: int = ROUNDS, ridge: float = 1e-3) -> LineField:
    """Maximum likelihood with every line labelled as its document, by Adam over all documents at once."""
    order = np.argsort([-len(d) for d in documents], kind="stable")
    docs, y = [documents[i] for i in order], np.array(labels)[order]
    lengths = np.array([len(d) for d in docs])
    n, steps, width = len(docs), int(lengths[0]), docs[0].shape[1]
    x = np.concatenate(docs)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    active = [int((lengths > t).sum()) for t in range(steps)]
    truth = np.repeat(y, lengths)
    theta = np.zeros(width + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    pairs = np.maximum(lengths - 1, 0)
    seen = np.zeros(4)  # bad-bad, bad-good, good-bad, good-good as labelled
    seen[0], seen[3] = pairs[y == 0].sum(), pairs[y == 1].sum()
    for step in range(1, rounds + 1):
        odds = np.clip(x @ theta[:width], -30, 30)
        good = 1 / (1 + np.exp(-odds))
        link = np.exp(theta[width:].reshape(2, 2))
        alpha = np.empty((len(x), 2))
        for t in range(steps):
            at = first[: active[t]] + t
            now = np.column_stack((1 - good[at], good[at]))
            if t:
                now = now * (alpha[at - 1] @ link)
            alpha[at] = now / now.sum(axis=1, keepdims=True)
        beta = np.ones((len(x), 2))
        expected = np.zeros((2, 2))
        for t in range(steps - 1, 0, -1):
            at = first[: active[t]] + t
            ahead = np.column_stack((1 - good[at], good[at])) * beta[at]
            joint = alpha[at - 1][:, :, None] * link[None] * ahead[:, None, :]
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            back = ahead @ link.T
            beta[at - 1] = back / back.sum(axis=1, keepdims=True)
        post = alpha * beta
        p = post[:, 1] / post.sum(axis=1)
        slope = np.concatenate((x.T @ (truth - p), seen - expected.ravel())) / n - ridge * theta
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope**2
        theta += 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return LineField(theta[:width], theta[width:].reshape(2, 2))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> LineField | float:
    """The field, or the share of label 1 where there is nothing to tell apart.

    The sample are the ``most`` labelled rows, not held out, with the smallest hash of their id,
    each with all lines of one text; a document that would bring them above ``SAMPLE_LINES`` is left out.
    """
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    usable = usable.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out())
    sample = usable.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    ddl = "quality int, n int, features binary"
    schema = pa.schema([("quality", pa.int32()), ("n", pa.int32()), ("features", pa.binary())])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [document_features(t)[0] for t in batch.column(1).to_pylist()]
            yield record_batch([batch.column(2), [len(f) for f in found], [f.astype("<f4").tobytes() for f in found]], schema)

    joined = texts_of(docs).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "quality")
    # An id in very many rows is one row per task before it is shuffled; the smallest hash of a text counts.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    texts = kept(joined.groupBy("doc_id", "quality").agg(one).select("doc_id", "one.text", "quality"))
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    # Bounded: `most` rows of two numbers.
    sizes = texts.select("doc_id", n_lines.alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    over, total = [], 0
    for r in sizes:
        if total + r.n > SAMPLE_LINES:
            over.append(r.doc_id)
        else:
            total += r.n
    whole = texts.filter(~F.col("doc_id").isin(over)) if over else texts
    # Bounded: SAMPLE_LINES lines in all, a few hundred bytes each.
    rows = whole.mapInArrow(features, ddl).collect()
    y = [r.quality for r in rows]
    if len(set(y)) < 2:
        return float(sum(y)) / len(y) if y else 0.5
    rows.sort(key=lambda r: (r.n, bytes(r.features), r.quality))  # the same sum in every run
    x = [np.frombuffer(r.features, dtype="<f4").reshape(r.n, -1).astype(float) for r in rows]
    return fit(x, [r.quality for r in rows])


def score(docs: DataFrame, model: LineField | float, *more: str) -> DataFrame:
    """``doc_id, text, <more>, score``."""
    names = ["doc_id", "text", *more]
    scored = texts_of(docs, *more).select(*names)
    if not isinstance(model, LineField):
        return scored.withColumn("score", F.lit(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array([model.score(t) for t in batch.column(1).to_pylist()], type=pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*names, "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return scored.mapInArrow(run, StructType([*scored.schema.fields, StructField("score", DoubleType())]))

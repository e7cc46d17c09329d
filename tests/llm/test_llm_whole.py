"""Operators on inputs where doing less than the whole job shows."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from jobtide.llm import language_model, quality
from jobtide.llm import sentencepiece_lattice as lattice
from jobtide.llm.queries import QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.load_vocabulary(PIECES, merges=True)


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECES)


def long_texts():
    rng = random.Random(5)
    letters = "".join(rng.choice("etaoinshrdlu") for _ in range(4000))
    return [
        "x" * 5000,
        "=" * 3001 + " and then " + "\n" * 700,
        " " * 2000 + "end",
        letters,
        base64.b64encode(rng.randbytes(3000)).decode(),
        "漢字仮名交じり文。" * 400,
        "function(a,b){return a+b;}" * 150 + "\U0001f600é" * 300,
        "internationalization" * 200 + " short words",
    ]


def test_long_words_are_encoded_as_by_the_library(spark, frame, vocabulary, library):
    texts = long_texts()
    encoded = lattice.encode_documents(frame(list(enumerate(texts))), vocabulary)
    shown = encoded.select("doc_id", "ids", lattice.decoded(F.col("ids"), F.lit(True), vocabulary).alias("text")).collect()
    assert len(shown) == len(texts)
    for r in shown:
        assert r.text == texts[r.doc_id] and r.ids == library.encode(r.text)


def test_long_parts_are_encoded_as_by_the_folds(spark, vocabulary):
    rng = random.Random(6)
    words = ["".join(rng.choice("abc e▁漢") for _ in range(rng.randint(1, 60))).strip() or "a" for _ in range(200)]
    pieces = [("▁", 0, -3.0), ("a", 1, -2.0), ("b", 2, -2.5), ("ab", 3, -3.1), ("ba", 4, -2.2), ("aba", 5, -4.2), ("c", 6, -2.1)]
    unigram = lattice.Vocabulary(tuple(pieces), tuple(range(100, 356)))
    rows = spark.createDataFrame([(w, True, 1) for w in set(words)], "word string, lead boolean, n long")
    for own in (vocabulary, unigram):
        for r in lattice.encode_words(rows, own).collect():
            assert lattice.encode_long(lattice.marked(r.word, True), own) == r.ids


def test_every_document_is_encoded_and_decoded(spark, sf_dir, plain_rows, library):
    rows = {r.doc_id: r for r in QUERIES["op10_documents"](spark, sf_dir).collect()}
    assert len(rows) == len(plain_rows)
    for d, text in plain_rows:
        got, ids = rows[d], library.encode(text or "")
        assert got.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
        if text:
            assert (got.n_ids, got.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))


def test_repeated_and_missing_rows_are_encoded_each(frame, odd_rows, vocabulary):
    rows = lattice.encode_documents(frame(odd_rows), vocabulary).collect()
    want = [(str(d), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in odd_rows]
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in rows) == sorted(want)
    assert all(r.n_ids == len(r.ids) for r in rows)


def test_no_count_is_dropped_however_full_the_filter(spark, sf_dir, documents, plain_rows, monkeypatch):
    # Before, this bound made every slice drop its single occurrences, as a large input did.
    monkeypatch.setattr(language_model, "FILTER_BYTES", 64 << 10, raising=False)
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in plain_rows}
    tokens = {d: ["\n", *brute.words(t or ""), "\n"] for d, t in plain_rows}
    single = Counter(w for d, ws in tokens.items() if not held[d] for w in ws[1:])
    pairs = Counter(p for d, ws in tokens.items() if not held[d] for p in zip(ws, ws[1:]))
    shown = language_model.level_counts()
    level = lambda c: float(shown[language_model.level_of(np.array([c]))[0]]) if c else 0.0
    spread = sum(single.values()) + len(single) + 1
    off = []
    for r in language_model.score(spark, documents).collect():
        own = tokens[r.doc_id]
        want = 0.0
        for v, w in zip(own, own[1:]):
            p = (level(single[w]) + 1) / spread
            seen = level(single[v])
            mu = 1 + language_model.SPREAD * seen**language_model.POWER
            want += math.log10((min(level(pairs[v, w]), seen) + mu * p) / (seen + mu))
        off.append(abs(r.score - want) / r.n_tokens)
    # What is left are the filter's false positives.
    assert sum(off) / len(off) < 0.02


def collected_lines(monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda docs, labels: seen.extend(map(len, docs)) or 0.5)
    return seen


def not_held_out(n):
    return [i for i in range(200) if zlib.crc32(str(i).encode()) % quality.HELD_OUT][:n]


def test_training_reads_every_line(spark, frame, monkeypatch):
    a, b = not_held_out(2)
    seen = collected_lines(monkeypatch)
    labels = spark.createDataFrame([(a, 0, 0), (b, 1, 0)], "doc_id long, quality int, toxic int")
    quality.train(frame([(a, "bad\n" * 499 + "end"), (b, "good")]), labels)
    assert sorted(seen) == [1, 500]


def test_a_repeated_id_is_one_text_of_the_sample(spark, frame, monkeypatch):
    a, b = not_held_out(2)
    seen = collected_lines(monkeypatch)
    labels = spark.createDataFrame([(a, 0, 0), (b, 1, 0)], "doc_id long, quality int, toxic int")
    quality.train(frame([(a, f"text {i}") for i in range(50)] + [(b, "one\ntwo")]), labels)
    assert sorted(seen) == [1, 2]

import math
import random
import zlib
from collections import Counter
from itertools import product

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from jobtide.llm import language_model, packing, quality
from jobtide.llm import sentencepiece_lattice as lattice
from jobtide.llm.queries import QUERIES

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# Packing


def check_packed(rows, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for d, t in texts}
    pieces, sequences = {}, {}
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.length > 0
        assert r.ids_crc32 == zlib.crc32(np.array(own[r.start : r.start + r.length], dtype="<u4").tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.padded_length))
    assert pieces.keys() == ids.keys()
    for d, own in pieces.items():
        assert sorted(own)[0][0] == 0 and sum(n for _, n in own) == len(ids[d])
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:]))
    padding = 0
    for own in sequences.values():
        at = 0
        for offset, length, padded in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048 and padded == (at if at.bit_count() == 1 else 2048)
        padding += padded - at
    return padding / sum(map(len, ids.values()))


def test_packing_covers_every_token(spark, sf_dir, plain_rows):
    assert check_packed(QUERIES["op6_packing"](spark, sf_dir).collect(), plain_rows) < 0.02


def test_packing_on_odd_rows(frame, odd_rows):
    rows = list(dict(x for x in odd_rows if x[0] is not None).items()) + [(99, "<|endoftext|> a  b <|endoftext|>")]
    check_packed(packing.pack(frame(rows), BPE).collect(), rows)
    assert packing.pack(frame([(None, "a"), (None, "a")]), BPE).count() >= 2
    assert packing.pack(frame([]), BPE).count() == 0


def test_encoder_agrees_with_the_library():
    rng = random.Random(1)
    marks = ["a", " ", "  ", "\n", "é", "!", " \n", "'s", "12", " ", "　", " x", "<|endoftext|>", "\x1c", "\x85", "\ta"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["", " ", "a ", " a"]
    encoder = packing.Encoder(BPE)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_cost_no_more_than_any_other_choice(seed):
    rng = random.Random(seed)
    window = 8
    cuts = sorted({*rng.sample(range(1, 18), 7), 6, 12, 18})
    prices = [rng.choice([0, 1, 3]) for _ in cuts]

    def cost(ends, tail):
        total, begin = 0, 0
        for end in ends:
            total += window - (end - begin) + (prices[cuts.index(end)] if end != cuts[-1] else 0)
            begin = end
        rest = cuts[-1] - begin
        return total + (min(window - rest, (rest.bit_count() - 1) * tail) if rest else 0)

    def valid(ends):
        return all(b - a <= window for a, b in zip([0, *ends], [*ends, cuts[-1]]))

    inner = cuts[:-1]
    best = min(
        cost([c for c, k in zip(inner, keep) if k], 2)
        for keep in product([0, 1], repeat=len(inner))
        if valid([c for c, k in zip(inner, keep) if k])
    )
    got = packing.best_cuts(cuts, prices, window, last=True, tail_price=2)
    begins = [0, *got]
    assert got[-1] == cuts[-1] and all(b - a <= window for a, b in zip(begins, got))
    # The windows before the tail, as the dynamic programme chose them.
    possible = [cost(got[:k], 2) for k in range(len(got)) if valid(got[:k]) and set(got[:k]) <= set(cuts)]
    assert min(possible) == best


# Language model


def test_base_scores_match_brute_force(spark, sf_dir, plain_rows):
    tokens = {d: brute.words(t or "") + ["\n"] for d, t in plain_rows}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    c = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    rows = QUERIES["op7_lm_scoring"](spark, sf_dir).collect()
    assert len(rows) == len(tokens)
    for r in rows:
        own = tokens[r.doc_id]
        want = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known) == (held[r.doc_id], len(own), sum(c[w] > 0 for w in own))
        assert r.train_tokens == n and r.base_score == pytest.approx(want)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_scores_on_odd_rows(spark, frame, odd_rows):
    rows = language_model.score(spark, frame(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    assert {r.n_tokens for r in rows if r.doc_id in (10, 11, 12)} == {1}
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert language_model.score(spark, frame([])).count() == 0
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = language_model.score(spark, frame([(alone, "a b")])).collect()
    assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0)


def test_filter_holds_levels():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(1, 1 << 62, 40_000).astype(np.uint64))
    c = rng.integers(1, 2000, len(h))
    own = language_model.slice_of(h, 64)
    parts = {int(s): language_model.build_slice(h[own == s], c[own == s]) for s in np.unique(own)}
    held = language_model.CountFilter(parts, 64)
    shown = language_model.level_counts()[language_model.level_of(c)]
    found = held.counts(h)
    assert (found >= shown).all() and (found == shown).mean() > 0.98
    others = rng.integers(1 << 62, 1 << 63, 40_000).astype(np.uint64)
    assert (held.counts(others) > 0).mean() < 0.02


def test_packed_counts_come_back():
    h = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    c = np.arange(len(h)) * 5_000
    back, counts = language_model.unpacked(language_model.packed(h, c))
    assert (back == h).all() and (counts == c).all()


def test_token_hashes_tell_words_apart():
    rng = random.Random(8)
    long = ["y" * n for n in (63, 64, 65, 66, 1000)] + ["y" * 64 + "z", "ab" * 40, "ba" * 40]
    words = list({"".join(rng.choice("ab\x00é漢.") for _ in range(rng.randrange(1, 9))) for _ in range(20_000)}) + long
    texts = ["", " \t", *(" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(3000)), " ".join(words).upper(), "\x0bA\x0c b\r"]
    seen = {}
    for some in (texts, texts[:1], texts[2:9]):
        h, before, starts = language_model.joined_tokens(some)
        want = [brute.words(t) + ["\n"] for t in some]
        assert starts.tolist() == [sum(map(len, want[:i])) for i in range(len(want))]
        flat = [w for own in want for w in own]
        assert len(flat) == len(h) and (before[1:] == h[:-1]).all() and before[0] == language_model.END
        for w, x in zip(flat, h.tolist()):
            assert seen.setdefault(w, x) == x and x % 2 == 1
    assert len(set(seen.values())) == len(seen)


# Quality


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest tables have 19 such labels
    rows = {r.doc_id: r for r in QUERIES["op9_quality_classifier"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    unseen = [x for x in labels if rows[x.doc_id].held_out]
    assert sum(rows[x.doc_id].predicted == x.quality for x in unseen) > 0.95 * len(unseen)


def test_quality_on_odd_rows(spark, frame, odd_rows):
    docs = frame(odd_rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(6)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    for model in (quality.train(docs, labels), quality.train(docs, labels.limit(0)), quality.train(docs, labels.filter("quality = 1"))):
        rows = quality.score(docs, model, "lang").collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
        assert quality.score(frame([]), model).count() == 0
    assert quality.train(docs, labels.filter("quality = 1")) == 1.0


def test_marginals_match_all_labellings():
    rng = np.random.default_rng(2)
    field = quality.LineField(rng.normal(size=4), rng.normal(size=(2, 2)))
    x = rng.normal(size=(6, 4))
    odds = x @ field.emission
    total, good = 0.0, np.zeros(6)
    for y in product([0, 1], repeat=6):
        w = math.exp(sum(o * k for o, k in zip(odds, y)) + sum(field.transition[a, b] for a, b in zip(y, y[1:])))
        total += w
        good += w * np.array(y)
    assert field.marginals(x) == pytest.approx(good / total)


def test_fit_raises_the_likelihood_of_the_labels():
    rng = np.random.default_rng(4)
    docs = [rng.normal(loc=k % 2, size=(1 + k % 7, 3)) for k in range(80)]
    field = quality.fit(docs, [k % 2 for k in range(80)])
    right = sum((field.marginals(d).mean() > 0.5) == k % 2 for k, d in enumerate(docs))
    assert right > 68


# Word pieces


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.load_vocabulary(PIECES, merges=True)


def test_words_are_encoded_as_by_the_library(spark, sf_dir, vocabulary):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    rows = QUERIES["op10_sentencepiece"](spark, sf_dir).collect()
    assert all(r.word == r.decoded and r.n_pieces == len(r.ids) for r in rows)
    assert all(r.ids == model.encode(r.word) for r in rows if r.word)


def test_documents_round_trip(spark, frame, odd_rows, vocabulary):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    rows = odd_rows + [(70, "漢字 \U0001f600 tab\there\nend"), (71, "▁ ▁a "), (72, "  two  blanks  ")]
    texts = frame(rows)
    encoded = lattice.encode_documents(texts, vocabulary)
    shown = encoded.select("doc_id", "ids", lattice.decoded(F.col("ids"), F.lit(True), vocabulary).alias("text")).collect()
    assert {(r.doc_id, r.text) for r in shown} == {(d, t or "") for d, t in rows}
    for r in shown:
        if r.text and len(max(r.text.split(" "), key=len)) <= lattice.MOST_WORD_CHARS and not set("▁") & set(r.text):
            assert r.ids == model.encode(r.text)
    assert lattice.encode_documents(frame([]), vocabulary).count() == 0


def test_viterbi_matches_all_paths(spark):
    pieces = [("▁", 0, -3.0), ("a", 1, -2.0), ("b", 2, -2.5), ("ab", 3, -3.1), ("ba", 4, -2.2), ("▁a", 5, -4.0), ("aba", 6, -6.0)]
    small = lattice.Vocabulary(tuple(pieces), tuple(range(100, 356)))
    words = ["", "a", "ab", "abab", "baab", "abcba", "aabbaba"]
    frame = spark.createDataFrame([(w, True, 1) for w in words], "word string, lead boolean, n long")
    scores = {p: s for p, _, s in pieces}
    price = {i: s for _, i, s in pieces}

    def best(line):
        if not line:
            return 0.0
        found = [scores[line[:k]] + best(line[k:]) for k in range(1, len(line) + 1) if line[:k] in scores]
        if line[0] not in scores:
            found.append(-small.byte_price + best(line[1:]))
        return max(found)

    for r in lattice.encode_words(frame, small).collect():
        assert sum(price.get(i, -small.byte_price) for i in r.ids) == pytest.approx(best("▁" + r.word))

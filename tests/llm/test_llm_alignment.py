"""Token alignment against the libraries' own encodings, pair by pair."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from jobtide.llm import packing
from jobtide.llm import token_alignment as ta
from jobtide.llm.queries import QUERIES

BPE, PIECES = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BPE)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PIECES)


def spelled(text, libraries):
    a, b = libraries
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [packing._bytes_of(a.id_to_token(i)) for i in a_ids]
    b_bytes = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in ((i, b.id_to_piece(i)) for i in b_ids)
    ]
    whole = (" " + text).encode()
    return (a_ids, a_bytes, b_ids, b_bytes) if b"".join(a_bytes) == whole == b"".join(b_bytes) else ([], [], [], [])


def ranges(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def expected(rows, libraries):
    """``rows``: (doc_id, text); one tuple per row, sorted."""
    docs, held = [], Counter()
    for doc_id, text in rows:
        a_ids, a_bytes, b_ids, b_bytes = spelled(text, libraries) if text else ([], [], [], [])
        a_at, b_at = ranges(a_bytes), ranges(b_bytes)
        links, j = [], 0
        for i, (x, y) in enumerate(a_at):
            while j < len(b_at) and b_at[j][1] <= x:
                j += 1
            k = j
            while k < len(b_at) and b_at[k][0] < y:
                links.append((a_ids[i], b_ids[k]))
                k += 1
        shared = sorted({z for _, z in a_at} & {z for _, z in b_at})
        groups, low = [], 0
        for high in shared:
            sides = [[n for n, (x, y) in zip(ids, at) if low <= x and y <= high] for ids, at in ((a_ids, a_at), (b_ids, b_at))]
            groups.append("|".join(",".join(map(str, s)) for s in sides))
            low = high
        held.update(set(links))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        docs.append((doc_id, len(a_ids), len(b_ids), len(groups), links, digest))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return sorted(
        (
            (d, n_a, n_b, n_groups, len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), digest)
            for d, n_a, n_b, n_groups, links, digest in docs
        ),
        key=str,
    )


def result(frame):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert tuple(frame.columns) == names
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_the_whole_table(spark, sf_dir, plain_rows, libraries):
    assert result(QUERIES["op13_token_alignment"](spark, sf_dir)) == expected(plain_rows, libraries)


def test_odd_rows(frame, odd_rows, libraries):
    texts = ["<|endoftext|> a <s> b", " lead", "tail ", "two  blanks", "a▁b", "▁", "a\n\nb \t c", "漢字 仮名", "\x00\x1c\x85　 x", "é ﬁ"]
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(texts)]
    assert result(ta.align(frame(rows), BPE, PIECES)) == expected(rows, libraries)
    assert result(ta.align(frame([]), BPE, PIECES)) == []
    assert result(ta.align(frame([(1, None), (1, "")]), BPE, PIECES)) == [(1, 0, 0, 0, 0, 0, 0, "")] * 2


def test_many_small_runs_count_like_one(frame, plain_rows, libraries, monkeypatch):
    rows = plain_rows[:60] + [(1000 + i, plain_rows[0][1]) for i in range(30)]
    want = expected(rows, libraries)
    frame = frame(rows)
    assert result(ta.align(frame, BPE, PIECES, buckets=1)) == want
    assert result(ta.align(frame, BPE, PIECES, buckets=1000)) == want

    def small(docs, a, b, buckets):
        """Runs as a task spills them that has room for few records."""
        aligner, rows = ta.Aligner(a, b), []
        for n, row in enumerate(docs.select("doc_id", "text").collect()):
            run = ta.Run(aligner.n_b, aligner.n_pairs, buckets)
            ((*counts, links, digest),) = aligner.documents([row.text])
            run.add([(row.doc_id, *counts, len(links) // run.width, digest)], [links])
            rows += [r for batch in run.spilled(n) for r in batch.to_pylist()]
        return docs.sparkSession.createDataFrame(rows, ta.RUN_DDL)

    monkeypatch.setattr(ta, "spill", small)
    assert result(ta.align(frame, BPE, PIECES, buckets=5)) == want


def test_random_texts_are_cut_as_by_the_libraries(libraries):
    rng = random.Random(7)
    marks = list("abcXYZ019 .,!'-\n\t\r") + ["  ", " '", " ", "　", "é", "ß", "漢", "\U0001f600", "\x1c", "\x85", " ", "́", "'s", "<s>", "​"]
    aligner = ta.Aligner(BPE, PIECES)
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    found = [x for i in range(0, 4000, 500) for x in aligner.documents(texts[i : i + 500])]
    for text, own in zip(texts, found, strict=True):
        a, _, b, _ = spelled(text, libraries)
        assert own[:2] == (len(a), len(b)), repr(text)
        ids = [int(x) for g in ";".join(p[4] for p in _parts(aligner, text)).split(";") if g for x in g.split("|")[0].split(",")]
        assert not a or ids == a


def _parts(aligner, text):
    head, rest = packing._parts(text)
    return [x for x in (aligner[p] for p in (head, *rest)) if x]


def test_blocks_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        x, y = rng.integers(-(2**40), 2**40, n), rng.integers(0, 3, n)
        got = ta.unpacked(ta.packed(x, y), 2)
        assert (got[0] == x).all() and (got[1] == y).all()

import hashlib
import random

import brute
import numpy as np
import pytest

from jobtide.llm import quality, simhash_dedup, warc
from jobtide.llm.queries import QUERIES, tokenizer_file

PAGES = "page_id long, url string, html string, digest string, top long, segment long"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], PAGES).repartition(3)


def round_trip(spark, tmp_path, rows):
    path = str(tmp_path / "archive")
    warc.write_archives(pages_of(spark, rows), path)
    logical = warc.reassembled(warc.read_records(spark, path))
    return logical, warc.page_payloads(logical)


def want(rows):
    out, groups = [], {}
    for p, _, html in rows:
        groups.setdefault(html or "", []).append(p)
    for p, _, html in rows:
        raw = (html or "").encode()
        ids = [x for x in groups[html or ""] if x is not None]
        top = max(ids) if ids else None
        seen = len(raw) >= 1000 and len(groups[html or ""]) > 1 and top is not None and p != top
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if seen else "response", top if seen else None, True))
    return out


ROWS = [
    (1, "http://a/", "<p>short</p>"),
    (2, "http://b/", "<p>short</p>"),
    (3, "http://c/", "é" * 600),
    (4, "http://d/", "é" * 600),
    (5, None, "é" * 600),
    (6, "http://e/\r\nWARC-Type: evil", None),
    (7, "", ""),
    (8, "http://long/", "long \r\n\r\n text " * 40_000),
    (9, "http://long/2", "other\r\n\r\n" * 30_000),
    (10, "http://long/3", "long \r\n\r\n text " * 40_000),
    (None, "http://n/", "n" * 2000),
]


def test_pages_come_back(spark, tmp_path):
    logical, got = round_trip(spark, tmp_path, ROWS)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want(ROWS), key=key)
    payloads = {r.page_id: bytes(r.payload).decode() for r in logical.filter("record_type = 'response'").collect()}
    assert payloads[10] == ROWS[9][2] and payloads[9] == ROWS[8][2] and payloads[6] == ""


def test_repeated_pages_and_no_pages(spark, tmp_path):
    twice = [(1, "u", "z" * 1500)] * 2 + [(0, "u", "z" * 1500)]
    _, got = round_trip(spark, tmp_path, twice)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got.collect()) == [
        (0, "revisit", 1),
        (1, "response", None),
        (1, "response", None),
    ]
    _, none = round_trip(spark, tmp_path / "none", [])
    assert none.count() == 0


def test_a_lost_segment_shows(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(pages_of(spark, [(1, "u", "q" * 300_000)]), path)
    records = warc.read_records(spark, path)
    assert records.count() > 3
    (r,) = warc.reassembled(records.filter("segment IS NULL OR segment <> 2")).collect()
    assert not r.complete and r.payload is None


@pytest.mark.parametrize("size", [0, 1, 5, 8192, 20_000])
def test_chunked_framing(size):
    body = b"\r\n0\r\n" * size
    assert warc.dechunked(warc.chunked(body)) == body


def test_warc_query(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, QUERIES["op8_warc"](spark, sf_dir).collect())) == sorted(want(pages))


def test_pipeline_stages_match_brute_force(spark, sf_dir, plain_rows):
    import corpus_pipeline as P
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(P.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "simhash_near_dedup", "packing"]
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = [(d, t) for d, t in plain_rows if model.score(t or "") >= quality.THRESHOLD]
    first = stages["quality_classifier"](spark, docs, sf_dir)
    assert first.columns == docs.columns
    assert sorted(first.select("doc_id", "text").collect()) == sorted(good)
    second = stages["line_dedup"](spark, first, sf_dir)
    assert second.columns == docs.columns
    rows = {r.doc_id: r.text for r in second.collect()}
    assert {d: brute.sha(t) for d, t in rows.items()} == {d: x[2] for d, x in brute.line_dedup(good).items()}
    third = stages["simhash_near_dedup"](spark, second, sf_dir)
    assert third.columns == docs.columns
    left = {r.doc_id: r.text for r in third.collect()}
    named = brute.similar_components(rows)
    assert left == {d: t for d, t in rows.items() if named[d] == d}
    packed = stages["packing"](spark, third, sf_dir).groupBy("doc_id").sum("length").collect()
    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    assert {r[0]: r[1] for r in packed} == {d: len(tokenizer.encode(t).ids) + 1 for d, t in left.items()}


def test_near_duplicates_are_found_and_others_stay(spark):
    """Over all pairs of a larger table: nothing is merged that links do not connect, nine tenths of the copies go."""
    rows = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rng = random.Random(9)
    long = [d for d, t in rows.items() if t and 60 < len(t.split()) < 400]
    for i, d in enumerate(rng.sample(long, 60)):  # copies with some words changed, left out or added
        words = rows[d].split()
        for _ in range(max(1, len(words) * (i % 4) // 100)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice(([], ["other"], [words[at], "more"]))
        rows[10_000 + i] = " ".join(words)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(5)
    left = {r.doc_id for r in simhash_dedup.without_near_duplicates(docs).collect()}
    named = brute.similar_components(rows)
    first = {d for d in rows if named[d] == d}
    assert first <= left
    assert len(left - first) <= 0.1 * (len(rows) - len(first)) and len(rows) - len(first) > 100


def test_near_duplicates_are_linked_whatever_their_fingerprints(spark):
    """Over all pairs: every link of four fifths counts, however far the fingerprints of its texts lie apart."""
    rng = random.Random(21)
    rows = {}
    for i in range(120):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(28, 60))]
        rows[i] = " ".join(words)
        rows[1000 + i] = " ".join(words + [f"v{rng.randrange(400)}" for _ in range(i % 7)])
        rows[2000 + i] = " ".join([f"u{rng.randrange(400)}" for _ in range(i % 5)] + words)
    prints = {d: simhash_dedup.shingle_set(t)[0] for d, t in rows.items()}
    named = brute.similar_components(rows)
    far = [d for d in rows if named[d] != d and (prints[d] ^ prints[named[d]]).bit_count() > simhash_dedup.GROUP_RADIUS]
    assert len(far) > 10
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in simhash_dedup.without_near_duplicates(docs).collect()} == {d for d in rows if named[d] == d}


def test_first_shingles_of_similar_texts_meet(spark):
    """Whatever shingles are known as frequent; and groups that are connected are not compared within."""
    rng = np.random.default_rng(5)
    known = np.unique(rng.integers(0, 400, 60, dtype=np.uint64))
    ranks = 1 + rng.permutation(len(known))
    for _ in range(300):
        both = rng.choice(400, rng.integers(1, 60), replace=False).astype(np.uint64)
        one = np.unique(both[: max(1, int(len(both) * rng.uniform(0.8, 1)))])
        other = np.unique(both)
        firsts = [simhash_dedup.first_shingles(x, (known, ranks), 0.8) for x in (one, other)]
        if len(one) >= 0.8 * len(other):
            assert set(firsts[0].tolist()) & set(firsts[1].tolist())
    rows = [(i, " ".join(f"w{j}" for j in range(40)) + f" end{i}") for i in range(6)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = [simhash_dedup.node_of(simhash_dedup.shingle_set(t)[1]) for _, t in rows]
    for groups, pairs in ((range(6), 15), ([0, 0, 0, 1, 1, 1], 9), ([0] * 6, 0)):
        labels = spark.createDataFrame(list(zip(nodes, groups, strict=True)), "node long, label long")
        assert simhash_dedup.unconnected_pairs(texts, labels).count() == pairs


def test_near_duplicates_on_odd_rows(spark):
    base = " ".join(f"word{i}" for i in range(100))
    near, far = base + " more", base.replace("word5 ", "x ")
    same_words = " ".join(reversed(base.split()))
    rows = [(5, base), (3, near), (None, base), (3, "z"), (7, "z"), (8, None), (9, ""), (None, " "), (10, same_words), (11, far)]
    rows += [(20 + i, "spam " * (i + 6)) for i in range(40)] + [(70, "a b"), (71, "A  b"), (72, "b a"), (5, base)]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, node string, size int").repartition(3)
    got = sorted((r.doc_id, r.text) for r in simhash_dedup.without_near_duplicates(docs).collect())
    assert got == [(3, near), (3, "z"), (8, None), (10, same_words), (20, "spam " * 6), (70, "a b"), (72, "b a")]
    nameless = spark.createDataFrame([(None, "b c"), (None, "b c"), (None, "d")], "doc_id long, text string")
    assert sorted(r.text for r in simhash_dedup.without_near_duplicates(nameless).collect()) == ["b c", "d"]
    assert simhash_dedup.without_near_duplicates(docs.limit(0)).columns == docs.columns


def test_dense_keys_are_split_for_the_stage_too(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(12)) for _ in range(300)]
    texts += [t + " end" for t in texts[:30]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = {r.doc_id for r in simhash_dedup.without_near_duplicates(docs).collect()}
    split = {r.doc_id for r in simhash_dedup.without_near_duplicates(docs, dense=20).collect()}
    named = brute.similar_components(dict(enumerate(texts)))
    first = {d for d in named if named[d] == d}
    assert first <= plain and first <= split and len(split ^ plain) <= 3


def test_pipeline_runs_whole(spark, sf_dir):
    import corpus_pipeline as P

    got = P.run(spark, sf_dir)
    assert got.columns[:3] == ["doc_id", "start", "length"] and got.count() > 0


def test_pipeline_on_odd_rows(spark, frame, odd_rows, sf_dir):
    import corpus_pipeline as P

    docs = frame(odd_rows)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() > 0
    empty = frame([])
    for _, stage in P.STAGES:
        empty = stage(spark, empty, sf_dir)
    assert empty.count() == 0


def test_sketches_leave_every_pair_that_shares_enough():
    rng = np.random.default_rng(8)
    pairs, n_shared = [], 0
    for _ in range(2000):
        both = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 3000), dtype=np.uint64))
        own = np.unique(rng.integers(0, 1 << 63, rng.integers(0, 1 + len(both) // 3), dtype=np.uint64))
        pairs.append((both[int(len(both) * rng.uniform(0, 0.3)) :], np.union1d(both, own)))
    sides = [np.array([np.frombuffer(simhash_dedup.sketch_of(p[i]), dtype=np.uint8) for p in pairs]) for i in (0, 1)]
    sizes = np.array([len(a) + len(b) for a, b in pairs])
    left = simhash_dedup.may_share(*sides, sizes, 0.8)
    for (a, b), kept in zip(pairs, left, strict=True):
        shares = simhash_dedup.shared_part(a.tobytes(), b.tobytes()) >= 0.8
        n_shared += shares
        assert kept or not shares
    assert n_shared > 200
    unrelated = sizes + np.roll(sizes, 1) <= 3000
    mixed = np.array([len(pairs[i][0]) + len(pairs[i - 1][1]) for i in range(len(pairs))])
    others = simhash_dedup.may_share(sides[0], np.roll(sides[1], 1, axis=0), mixed, 0.8)
    assert unrelated.sum() > 100 and others[unrelated].mean() < 0.02


def test_sets_of_shingles_are_not_stored(spark):
    """What is compared is moved, not written a second time; the same rows stay."""
    from jobtide.llm.common import working_folder
    from jobtide.session import folder_bytes

    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(1500)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " end") for i, t in enumerate(texts)] + [(500, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = working_folder(spark)
    before = folder_bytes(spark, folder)
    left = simhash_dedup.without_near_duplicates(docs)
    assert folder_bytes(spark, folder) - before < 120 * 1500 * 8 / 2
    assert {r.doc_id for r in left.collect()} == set(range(60))

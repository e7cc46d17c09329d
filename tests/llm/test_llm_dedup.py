import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobtide.llm import components, exact_dedup, line_dedup, simhash_dedup
from jobtide.llm.queries import QUERIES


def distinct_ids(rows):
    seen = {}
    for d, t in rows:
        if d is not None and d not in seen:
            seen[d] = t
    return list(seen.items())


def lines_of(docs):
    found = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()


def test_lines_match_brute_force(spark, sf_dir, plain_rows):
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op1_line_dedup"](spark, sf_dir).collect()}
    assert got == brute.line_dedup(plain_rows)


def test_lines_on_odd_rows(frame, odd_rows):
    rows = distinct_ids(odd_rows)
    got = {r[0]: tuple(r[1:]) for r in lines_of(frame(rows))}
    assert got == brute.line_dedup(rows)
    assert got[0][1] > 0 and got[11] == (1, 0, brute.sha(""))


def test_lines_repeated_ids_and_nulls(frame, odd_rows):
    got = lines_of(frame(odd_rows))
    assert len(got) == len(odd_rows)
    assert all(r[2] == 0 for r in got if r[0] is None)


def test_lines_split_over_ranges(spark, frame):
    """A line of every document, over more ranges than it has neighbours."""
    rows = [(i, f"{'shared line of many documents ' * 2}\nown {i}") for i in range(400)]
    got = {r[0]: tuple(r[1:]) for r in lines_of(frame(rows))}
    assert got == brute.line_dedup(rows)


def test_lines_are_dropped_a_few_texts_at_a_time():
    """One large batch of texts comes back in small ones, so no column of whole texts is built in a task."""
    texts = [f"kept {i}\ngone\n\nkept too" for i in range(1201)]
    bits = zlib.compress(np.packbits([True, False, True, True]).tobytes())
    whole = pa.RecordBatch.from_pydict({"doc_id": range(1201), "text": texts, "keep": [bits] * 1201, "n": [4] * 1201})
    parts = list(line_dedup.keep_lines(iter([whole])))
    assert max(p.num_rows for p in parts) <= 500
    rows = [r for p in parts for r in p.to_pylist()]
    assert rows == [{"doc_id": i, "text": f"kept {i}\n\nkept too", "n": 4} for i in range(1201)]


def test_lines_empty_table(frame):
    assert lines_of(frame([])) == []


def test_exact_matches_brute_force(spark, sf_dir, plain_rows):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in QUERIES["op2_exact_dedup"](spark, sf_dir).collect()}
    assert got == brute.exact_dedup(plain_rows)


def test_exact_on_odd_rows(frame, odd_rows):
    rows = [(d, t) for d, t in odd_rows if d is not None]
    got = exact_dedup.exact_groups(frame(rows)).collect()
    assert len(got) == len(rows)
    groups = {}
    for d, t in rows:
        key = brute.exact_dedup([(d, t)])[d][3]
        groups.setdefault(key, []).append((-len(t or ""), d))
    want = sorted((d, min(g)[1], len(g), key) for key, g in groups.items() for _, d in g)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert next(r.keep_id for r in got if r.doc_id == 16) == 14  # the longer original stays


def test_exact_null_ids(frame):
    got = exact_dedup.exact_groups(frame([(None, "a b"), (1, "ab"), (None, "c")])).collect()
    assert {(r.doc_id, r.text_sha256[:6]): (r.keep_id, r.group_size, r.kept) for r in got} == {
        (None, brute.sha("ab")[:6]): (None, 2, True),
        (1, brute.sha("ab")[:6]): (None, 2, False),
        (None, brute.sha("c")[:6]): (None, 1, True),
    }
    assert exact_dedup.exact_groups(frame([])).count() == 0


def test_exact_overflow_pages(frame, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MIN_CAPACITY", 4)
    rows = [(i, "same text " + " " * (i % 3)) for i in range(50)] + [(100 + i, f"text {i % 30}") for i in range(60)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_groups(frame(rows)).collect()}
    assert got == brute.exact_dedup(rows)


def test_directory_stops_at_the_shortest_prefix_that_fits(spark):
    hashes = spark.range(1000).select(F.xxhash64("id").alias("hash"))
    rows = exact_dedup.directory(hashes, 100, 8).collect()
    taken = {tuple(r.bucket) for r in rows}
    assert len(taken) > 8
    assert all(r.slot >> (8 - r.bucket.d) == r.bucket.prefix for r in rows)


def test_simhash_matches_brute_force(spark, sf_dir, plain_rows):
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in QUERIES["op4_simhash_near_dedup"](spark, sf_dir).collect()}
    prints = {d: brute.fingerprint64(t or "") for d, t in plain_rows}
    named = brute.near_components(prints)
    assert got == {d: (prints[d], named[d]) for d in prints}


def test_simhash_on_odd_rows(frame, odd_rows):
    rows = distinct_ids(odd_rows)
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash_dedup.near_classes(frame(rows)).collect()}
    prints = {d: brute.fingerprint64(t or "") for d, t in rows}
    named = brute.near_components(prints)
    assert got == {d: (prints[d], named[d]) for d in prints}
    assert simhash_dedup.near_classes(frame(odd_rows)).count() == len(odd_rows)
    assert simhash_dedup.near_classes(frame([])).count() == 0


@pytest.mark.parametrize("dense", [simhash_dedup.DENSE, 16])
def test_links_of_planted_neighbours(spark, dense):
    """Random fingerprints, neighbours at each distance, and a crowd around one of them."""
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(200)]
    flip = lambda x, k: x ^ sum(1 << b for b in rng.sample(range(64), k))
    found = base + [flip(x, 1 + i % 5) for i, x in enumerate(base)] + [flip(base[0], 1 + i % 3) for i in range(150)]
    prints = dict(enumerate(sorted(set(found))))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = spark.createDataFrame([(signed(p),) for p in prints.values()], "fp long")
    labels = components.components(simhash_dedup.close_links(nodes, dense=dense)).collect()
    label = {r.node: r.label for r in labels}
    want = brute.near_components(prints)
    groups = lambda f: sorted(sorted(k for k in prints if f(k) == r) for r in {f(k) for k in prints})
    assert groups(lambda k: label.get(signed(prints[k]), signed(prints[k]))) == groups(lambda k: want[k])


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 50)}


def test_forest_spans_the_close_pairs():
    members = np.array([0, 1, 3, 7, 15, 15 << 40], dtype=np.uint64)
    assert len(list(simhash_dedup._forest(members, 1))) == 4

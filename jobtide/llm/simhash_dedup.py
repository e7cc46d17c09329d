"""SimHash near-dedup by deletion-variant signatures.

Two 64-bit fingerprints with at most three differing bits agree, but for one
bit at most, in one of two 32-bit segments.  Every distinct fingerprint is
indexed under each segment, and under each segment with one bit left out; an
equality join on these keys (here: rows of a key side by side) meets every
close pair, and the whole fingerprints verify it.

Keys that very many fingerprints share are not joined as they stand: with at
most d bits to differ in the rest, one of d + 1 blocks of the rest is equal, so
the key is split by each block's value, again and again.  A key that fixes all
but a few bits has few distinct fingerprints.  Within a key, rows are linked by
a spanning forest of the close pairs instead of all pairs: the components, which
are what is asked for, are the same.

``without_near_duplicates`` cleans a corpus by the same search, with parameters of its own:
fingerprints over the set of words find candidates, which must share four fifths of their
shingles of five words to be linked.  No distance of fingerprints is sure to hold all such
pairs, so what the search has not connected is completed exactly: texts that share so much
have one of their first shingles in common, the rare ones being first (prefix filter).

Defined cases: a null text is empty; a text without words has fingerprint zero,
which links like any other.  Rows without ``doc_id`` are linked, but lend no
name; a component of such rows alone has a null name.  Repeated rows share a
fingerprint.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import kept, record_batch, slices, texts_of
from jobtide.llm.components import components

RADIUS = 3
SEED = 42
#: Above so many fingerprints a key is split.
DENSE = 4096
#: Bits of the largest group that is linked without a further split.
LAST_BITS = 12


def simhash64(text: str, words: int = 3) -> int:
    """Fingerprint over shingles, repeats included; unsigned."""
    found = text.encode().lower().split()  # bytes: A-Z and the six white spaces only
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in found])
        starts = np.concatenate(([0], ends[:-1]))[: len(found) - words + 1]
        digest = xxhash.xxh64_intdigest
        spans = zip(starts.tolist(), (ends[words - 1 :] - 1).tolist(), strict=True)
        hashes = [digest(line[a:b], SEED) for a, b in spans]
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype=np.uint64)
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fp`` (signed long)."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([simhash64(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield record_batch([batch.column(0), found.view(np.int64)], schema)

    return texts_of(docs).mapInArrow(prints, "doc_id long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def segment_keys(radius: int = RADIUS) -> list[tuple[int, int, int]]:
    """``(mask, wild, rest)``: bits that must be equal, the bit left out (or 0), and how
    many bits may differ elsewhere.  Few enough segments for one to differ by one bit."""
    n = (radius + 1) // 2
    edges = [64 * i // n for i in range(n + 1)]
    out = []
    for low, high in zip(edges, edges[1:], strict=False):
        mask = (1 << high) - (1 << low)
        out.append((mask, 0, radius))
        out += [(mask ^ (1 << bit), 1 << bit, radius - 1) for bit in range(low, high)]
    return out


def _split(mask: int, wild: int, rest: int) -> list[int]:
    """Masks that add one of ``rest + 1`` blocks of the free bits."""
    free = [b for b in range(64) if not (mask | wild) >> b & 1]
    edges = [len(free) * i // (rest + 1) for i in range(rest + 2)]
    return [mask | sum(1 << b for b in free[a:z]) for a, z in zip(edges, edges[1:], strict=False)]


def _indexed(nodes: DataFrame, keys: list[tuple[int, int, int]]) -> DataFrame:
    listed = F.array(*(F.struct(F.lit(_signed(m)).alias("mask"), F.lit(_signed(w)).alias("wild")) for m, w, _ in keys))
    return nodes.select("fp", F.explode(listed).alias("key")).select(
        F.col("key.mask").alias("mask"),
        F.col("key.wild").alias("wild"),
        F.col("fp").bitwiseAND(F.col("key.mask")).alias("value"),
        "fp",
    )


def _forest(members: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that span the close pairs among distinct fingerprints."""
    left = members
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                queue.extend(found)
                yield from ((int(root), int(x)) for x in found)


def _link_runs(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key.  Only the run at a batch's end is carried over."""
        held = np.zeros((0, 4), dtype=np.int64)

        def linked(rows: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(rows)]))
            # Without one bit: only pairs that differ there, the others have their own key.
            wild, fp = rows[:, 1], rows[:, 3].view(np.uint64)
            hit = ((rows[:, 3] & wild) != 0).astype(np.int64)
            ones = np.add.reduceat(hit, starts) if len(rows) else hit
            size = ends - starts
            useful = (size > 1) & ((wild[starts] == 0) | ((ones > 0) & (ones < size)))
            runs = list(zip(starts[useful].tolist(), ends[useful].tolist(), strict=True))
            pairs = [p for a, z in runs for p in _forest(fp[a:z], radius)]
            found = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return record_batch([found[:, 0], found[:, 1]], schema)

        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows = np.concatenate((held, rows))
            if not len(rows):
                continue
            same = (rows[:, :3] == rows[-1, :3]).all(axis=1)
            cut = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield linked(rows[:cut])
            held = rows[cut:]
        if len(held):
            yield linked(held)

    return link


def close_links(nodes: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """``a, b``: links that join the same fingerprints as all pairs within the radius would.

    ``nodes``: distinct fingerprints in ``fp``.
    """
    index = _indexed(nodes, segment_keys(radius))
    rest = {(_signed(m), _signed(w)): r for m, w, r in segment_keys(radius)}
    key = ["mask", "wild", "value"]
    found = None
    while True:
        masks = list(rest)
        splittable = [k for k in masks if 64 - bin(k[0] & (2**64 - 1)).count("1") > LAST_BITS]
        hot = kept(index.groupBy(*key).count().filter(F.col("count") > dense).drop("count")) if splittable else None
        last = hot is None or hot.isEmpty()
        calm = index if last else index.join(hot, key, "left_anti")
        links = kept(
            calm.repartition(*key).sortWithinPartitions(*key).mapInArrow(_link_runs(radius), "a long, b long").distinct()
        )
        found = links if found is None else found.union(links)
        if last:
            return found
        # The hot keys' rows, once under every block of their free bits.
        unsigned = lambda x: x & (2**64 - 1)
        blocks = {k: _split(unsigned(k[0]), unsigned(k[1]), rest[k]) for k in masks}
        finer = F.create_map(
            *(
                x
                for (m, w), parts in blocks.items()
                for x in (
                    F.struct(F.lit(m).alias("mask"), F.lit(w).alias("wild")),
                    F.array(*(F.lit(_signed(p)) for p in parts)),
                )
            )
        )
        hot_rows = index.join(hot, key).select(
            F.explode(finer[F.struct("mask", "wild")]).alias("mask"), "wild", "fp", F.col("value").alias("outer_value")
        )
        index = kept(
            hot_rows.select("mask", "wild", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp").distinct()
        )
        rest = {(_signed(p), w): rest[(m, w)] for (m, w), parts in blocks.items() for p in parts}


def near_classes(docs: DataFrame, words: int = 3, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """``doc_id, fp, component_id``, one row per row of ``docs``."""
    prints = kept(fingerprints(docs, words))
    nodes = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = components(close_links(nodes, radius, dense))
    named = nodes.join(labels, nodes.fp == labels.node, "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = named.join(smallest, "label").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


#: Near duplicates of a corpus: words per shingle, the least share of shingles in common, and the bits in which
#: fingerprints over the sets of words may differ to be looked at.
GROUP_WORDS, SIMILARITY, GROUP_RADIUS = 5, 0.8, 7


def shingle_set(text: str, words: int = GROUP_WORDS) -> tuple[int, np.ndarray]:
    """A fingerprint over the set of words, and the ascending hashes of the distinct shingles."""
    found = text.encode().lower().split()
    if not found:
        return 0, np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    each = np.unique(np.array([digest(w, SEED) for w in set(found)], dtype=np.uint64))
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(each), 1 << 16):
        part = each[at : at + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    fp = int(np.packbits(votes * 2 > len(each), bitorder="little").view(np.uint64)[0])
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    n = max(1, len(found) - words + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    spans = zip(starts, (ends[min(words, len(found)) - 1 :] - 1).tolist(), strict=True)
    hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype=np.uint64)
    hashes.sort()
    return fp, hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))]


def node_of(shingles: np.ndarray) -> int:
    """One number for texts with the same shingles, signed."""
    return int(np.array([xxhash.xxh3_64_intdigest(shingles.tobytes(), SEED)], dtype=np.uint64).view(np.int64)[0])


def shared_part(a: bytes, b: bytes) -> float:
    """Of the shingles of two texts, the share that both have; texts without any are alike."""
    if not (a or b):
        return 1.0
    both = np.sort(np.concatenate((np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64))))
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


#: Bits of a sketch: of the shingles that fall on each, whether their number is odd.
SKETCH_BITS = 1024


def sketch_of(shingles: np.ndarray) -> bytes:
    """Where two sketches differ, some shingle is in one text only."""
    odd = np.bincount((shingles & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_share(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs of sketches, one a row, whose texts may share ``similarity``; ``sizes``: the shingles of both together.

    Never false for texts that do: so much in common leaves few shingles that only one of them has.
    """
    apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return apart <= sizes * (1 - similarity) / (1 + similarity) + 1e-6


#: Bits of the map that tells which nodes are asked for.
MARKS = 1 << 26


def marks_of(nodes: DataFrame) -> np.ndarray:
    """A bitmap of the nodes, of fixed size: of a node that is not marked nothing is asked."""
    at = nodes.select((F.pmod("node", F.lit(MARKS)) + 1).alias("at"))
    found = at.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    marks = np.zeros(MARKS // 8, dtype=np.uint8)
    for part, bits in found.collect():
        marks[(part - 1) * len(bits) : part * len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return marks


def marked(marks: np.ndarray, node: int) -> bool:
    at = node % MARKS
    return bool(marks[at >> 3] >> (at & 7) & 1)


#: Shingles that a task meets so often among so many are counted as frequent, and so many of the most frequent are known
#: by name.  That orders the shingles of a text, and decides nothing.
OFTEN, COUNTED, MOST_FREQUENT = 4, 1 << 22, 200_000


def frequent_shingles(texts: DataFrame, words: int = GROUP_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many texts have, ascending, and the rank of each, the most frequent last."""
    schema = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def often() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return record_batch([found[n >= OFTEN].view(np.int64), n[n >= OFTEN]], schema)

        for batch in slices(batches):
            held += [shingle_set(t, words)[1] for t in batch.column("text").to_pylist()]
            size += sum(len(x) for x in held[-batch.num_rows :])
            if size >= COUNTED:
                yield often()
                held, size = [], 0
        if held:
            yield often()

    many = texts.mapInArrow(counted, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = many.orderBy(F.col("n").desc(), "shingle").limit(MOST_FREQUENT).select("shingle").collect()
    found = np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], (len(found) - order).astype(np.int64)


def first_shingles(shingles: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """So many shingles, the rare ones first, that two texts with ``similarity`` have one of them in common."""
    n = len(shingles)
    if not n:
        return shingles
    known, ranks = frequent
    rank = np.zeros(n, dtype=np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        rank = np.where(known[at] == shingles, ranks[at], 0)
    return shingles[np.lexsort((shingles, rank))][: n - math.ceil(similarity * n - 1e-9) + 1]


def _apart(similarity: float):
    """Pairs of a run of ``shingle, node, label, size, at`` that may be similar and are in different groups."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    share = similarity / (1 + similarity)

    def pairs_of(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All pairs whose sizes fit, a block at a time; ``at`` is where the shingle stands in the text's order."""
        if len(rows) < 2 or (rows[:, 2] == rows[0, 2]).all():
            return
        rows = rows[np.argsort(rows[:, 3], kind="stable")]
        node, label, size, at = rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 4]
        ends = np.searchsorted(size, size / similarity + 1e-6, side="right")
        step = max(1, (1 << 20) // len(rows))
        for low in range(0, len(rows), step):
            i, j = np.arange(low, min(low + step, len(rows))), np.arange(low, ends[min(low + step, len(rows)) - 1])
            left = np.minimum((size - at)[i, None], (size - at)[None, j])  # what can be shared from here on
            near = (label[i, None] != label[None, j]) & (i[:, None] < j[None, :])
            near &= left >= share * (size[i, None] + size[None, j]) - 1e-6
            x, y = np.nonzero(near)
            if len(x):
                a, b = node[i[x]], node[j[y]]
                yield record_batch([np.minimum(a, b), np.maximum(a, b)], schema)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shingle.  Only the run at a batch's end is carried over."""
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if not len(rows):
                continue
            cuts = np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1
            runs = np.split(rows, cuts)
            if held and held[0][0, 0] != runs[0][0, 0]:
                yield from pairs_of(np.concatenate(held))
                held = []
            for run in runs[:-1]:
                yield from pairs_of(np.concatenate([*held, run]) if held else run)
                held = []
            held.append(runs[-1])
        if held:
            yield from pairs_of(np.concatenate(held))

    return met


def unconnected_pairs(
    texts: DataFrame, labels: DataFrame, words: int = GROUP_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """``a, b``: nodes of different groups, among them every pair that shares ``similarity`` of its shingles.

    ``labels``: ``node, label``, the group of every node.  Texts meet under each of their first
    shingles; groups that are connected already are not compared within.
    """
    frequent = texts.sparkSession.sparkContext.broadcast(frequent_shingles(texts, words))
    schema = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("first", pa.binary())])
    opened = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("label", pa.int64()), ("size", pa.int64()), ("at", pa.int64())])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t, words)[1] for t in batch.column("text").to_pylist()]
            firsts = [first_shingles(x, frequent.value, similarity).tobytes() for x in sets]
            yield record_batch([[node_of(x) for x in sets], [len(x) for x in sets], firsts], schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.frombuffer(x, dtype=np.int64) for x in batch.column("first").to_pylist()]
            n = [len(x) for x in found]
            columns = [np.repeat(batch.column(c).to_numpy(), n) for c in ("node", "label", "size")]
            at = np.concatenate([np.arange(k) for k in n])
            yield record_batch([np.concatenate(found), *columns, at], opened)

    firsts = texts.mapInArrow(first, "node long, size long, first binary").dropDuplicates(["node"]).join(labels, "node")
    rows = firsts.select("node", "label", "size", "first").mapInArrow(
        each, "shingle long, node long, label long, size long, at long"
    )
    return rows.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(_apart(similarity), "a long, b long").distinct()


def without_near_duplicates(
    docs: DataFrame,
    words: int = GROUP_WORDS,
    similarity: float = SIMILARITY,
    radius: int = GROUP_RADIUS,
    dense: int = DENSE,
) -> DataFrame:
    """One row of each group of near duplicates, with all its columns; texts are as they were.

    Texts are linked if they share ``similarity`` of their shingles, whatever their fingerprints.
    Most links are found by deletion-variant signatures of the fingerprints over their words, and
    judged by the shingles; pairs that are not connected by these are met by their first shingles,
    and judged alike.  Groups are what links connect.  Of a group the smallest ``doc_id`` stays; rows without one come last,
    and of rows with one id, or without, the smallest text.  Texts with the same set of shingles
    are one group, whatever their ids; so are empty and null texts.
    """
    numbers = [("doc_id", pa.int64()), ("node", pa.int64()), ("fp", pa.int64()), ("size", pa.int64())]
    prints_schema = pa.schema([*numbers, ("sketch", pa.binary()), ("key", pa.binary())])
    sets_schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, np.ndarray]]]]:
        for batch in slices(batches):
            yield batch, [shingle_set(t, words) for t in batch.column("text").to_pylist()]

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in each(batches):
            fps = np.array([fp for fp, _ in found], dtype=np.uint64).view(np.int64)
            columns = [batch.column("doc_id"), [node_of(x) for _, x in found], fps, [len(x) for _, x in found]]
            yield record_batch([*columns, [sketch_of(x) for _, x in found], batch.column("key")], prints_schema)

    def sets_of(marks):
        """Shingles of the nodes that are marked: others are not moved."""

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, found in each(batches):
                named = [(node_of(x), x) for _, x in found]
                named = [(node, x.tobytes()) for node, x in named if marked(marks.value, node)]
                yield record_batch([[n for n, _ in named], [x for _, x in named]], sets_schema)

        return sets

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("a_shingles", "b_shingles"))
            near = pa.array([shared_part(x, y) >= similarity for x, y in zip(a, b, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(near)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, SKETCH_BITS // 8)
                for c in ("a_sketch", "b_sketch")
            )
            sizes = batch.column("a_size").to_numpy() + batch.column("b_size").to_numpy()
            near = pa.array(may_share(a, b, sizes, similarity), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(near)

    texts = texts_of(docs)
    ddl = "doc_id long, node long, fp long, size long, sketch binary, key binary"
    found = kept(texts.withColumn("key", _text_key()).mapInArrow(prints, ddl))
    nodes = kept(
        found.groupBy("node").agg(
            F.min("fp").alias("fp"), F.min("size").alias("size"), F.min("doc_id").alias("first_id"), F.count("*").alias("n_rows")
        )
    )

    def links_of(pairs: DataFrame) -> DataFrame:
        """Pairs of nodes that share enough; shingles are moved for those only that the sketches leave."""
        sketches = found.select("node", "size", "sketch").dropDuplicates(["node"])
        drawn = lambda c: sketches.select(*(F.col(x).alias(y) for x, y in (("node", c), ("size", f"{c}_size"), ("sketch", f"{c}_sketch"))))
        pairs = kept(pairs.join(drawn("a"), "a").join(drawn("b"), "b").mapInArrow(likely, "a long, b long"))
        asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
        marks = docs.sparkSession.sparkContext.broadcast(marks_of(asked))
        # Dealt by node once: both sides read the same shuffle, and only the first one's sets are moved again.
        known = texts.mapInArrow(sets_of(marks), "node long, shingles binary").dropDuplicates(["node"])
        side = lambda c: known.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_shingles"))
        return kept(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(judged, "a long, b long"))

    def groups(links: DataFrame) -> DataFrame:
        labels = components(links).withColumnRenamed("label", "_label")
        return nodes.join(labels, nodes.node == labels.node, "left").select(
            nodes.node, "first_id", "n_rows", F.coalesce("_label", nodes.node).alias("label")
        )

    links = links_of(_node_pairs(nodes, close_links(nodes.select("fp").distinct(), radius, dense)))
    near = kept(groups(links))
    rest = links_of(unconnected_pairs(texts, near.select("node", "label"), words, similarity))
    named = near if rest.isEmpty() else kept(groups(links.union(rest)))
    # Of each group the node with the smallest id; ids are missing only where no row of the group has one.
    first = named.groupBy("label").agg(
        F.min(F.struct(F.col("first_id").isNull().alias("lacks"), "first_id", "node")).alias("f"), F.sum("n_rows").alias("rows")
    )
    stay = first.select(F.col("f.node").alias("node"), "rows")
    # A row that is a group of its own stays where it is; only texts of the others are asked for, and moved.
    judged_nodes = named.select("node").join(stay, "node", "left").filter("rows IS NULL OR rows > 1")
    judged_nodes = judged_nodes.select("node", F.col("rows").isNotNull().alias("_stays"))
    asked = found.select("node", F.col("key").alias("_key")).distinct().join(judged_nodes, "node")
    asked = kept(asked.select("_key", F.col("node").alias("_node"), "_stays"))
    marks = docs.sparkSession.sparkContext.broadcast(marks_of(asked.select(F.xxhash64("_key").alias("node"))))
    names = docs.columns

    def picked(wanted: int):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.column("_at").to_numpy() % MARKS
                is_marked = (marks.value[at >> 3] >> (at & 7) & 1) == wanted
                yield batch.filter(pa.array(is_marked, pa.bool_()))

        return pick

    keyed = docs.withColumn("_key", _text_key()).withColumn("_at", F.xxhash64("_key"))
    lone = keyed.mapInArrow(picked(0), keyed.schema).select(*names)
    met = keyed.mapInArrow(picked(1), keyed.schema).join(asked, "_key", "left").filter("_stays IS NULL OR _stays")
    # A text that was not asked for, but has the mark of one that was, is a group of its own too.
    met = met.withColumn("_lone", F.when(F.col("_node").isNull(), F.col("_key")))
    order = Window.partitionBy("_node", "_lone").orderBy(F.asc_nulls_last("doc_id"), F.asc_nulls_last("text"))
    return lone.union(met.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").select(*names))


def _text_key() -> Column:
    """What equal texts have in common, null as empty."""
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def _node_pairs(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``a, b``: nodes to compare, for links of fingerprints and for nodes that share one.

    Nodes that share a fingerprint are ranked by size, and meet their neighbours in rank; across a
    link, ranks meet: so many pairs as nodes, not all of both sides.
    """
    order = Window.partitionBy("fp").orderBy("size", "node")
    ranked = nodes.select("fp", "node", F.row_number().over(order).alias("rank"), F.lead("node").over(order).alias("next"))
    within = ranked.filter("next IS NOT NULL").select(F.col("node").alias("a"), F.col("next").alias("b"))
    top = ranked.groupBy("fp").agg(F.max("rank").alias("top"))
    both = links.union(links.select("b", "a")).distinct()
    left = both.join(ranked.select(F.col("fp").alias("a"), F.col("node").alias("a_node"), "rank"), "a")
    met = left.join(top.select(F.col("fp").alias("b"), "top"), "b").withColumn("rank", F.least("rank", "top"))
    right = ranked.select(F.col("fp").alias("b"), F.col("node").alias("b_node"), "rank")
    across = met.join(right, ["b", "rank"]).select("a_node", "b_node")
    pairs = within.union(across).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.filter("a <> b").distinct()

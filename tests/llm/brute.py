"""Plain versions of the operators, for small tables: lists of rows in, dicts out."""

from __future__ import annotations

import hashlib
import re

import xxhash

WS = " \t\n\x0b\x0c\r"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", lower(text))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(rows):
    """``rows``: (doc_id, text); doc ids differ."""
    holders: dict[str, set] = {}
    split = [(d, (t or "").split("\n")) for d, t in rows]
    for d, lines in split:
        for line in lines:
            key = lower(line.strip(WS))
            if len(key) >= 40:
                holders.setdefault(key, set()).add(d)
    out = {}
    for d, lines in split:
        stay = []
        for line in lines:
            held = holders.get(lower(line.strip(WS)), set())
            if len(held) < 5 or max(held) == d:
                stay.append(line)
        out[d] = (len(lines), len(lines) - len(stay), sha("\n".join(stay)))
    return out


def exact_dedup(rows):
    groups: dict[str, list] = {}
    for d, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), d))
    return {d: (min(g)[1], len(g), min(g)[1] == d, sha(key)) for key, g in groups.items() for _, d in g}


def edited_texts(rows):
    rows = sorted((d, t or "") for d, t in rows)
    out = {}
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        out[d] = t[: len(t) - half] + after[:half]
    return out


def fingerprint64(text: str) -> int:
    found = words(text)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def near_components(prints: dict[int, int], radius: int = 3) -> dict[int, int]:
    label = {d: d for d in prints}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {d: root(d) for d in ids}


def similar_components(texts: dict[int, str], k: int = 5, least: float = 0.8) -> dict[int, int]:
    """Of each document the smallest one reachable over pairs that share so many of their shingles; all pairs are tried."""
    sets = {}
    for d, t in texts.items():
        found = words(t or "")
        sets[d] = {tuple(found[i : i + k]) for i in range(max(1, len(found) - k + 1))} if found else set()
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) < least * max(len(x), len(y)):
                continue
            shared = len(x & y)
            if shared >= least * (len(x) + len(y) - shared):
                p, q = sorted((root(a), root(b)))
                label[q] = p
    return {d: root(d) for d in ids}

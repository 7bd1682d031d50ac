"""Near copies of texts and of lines against brute force."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import lines, ngram_join
from tests.llm.conftest import ODD, near_copies


def shingles(text: str) -> set:
    words = text.encode().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def alike(a: set, b: set) -> bool:
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def lower(text: str | None) -> str:
    return (text or "").encode().lower().decode()


def by_brute_force(rows):
    sets = [shingles(lower(text)) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if alike(sets[a], sets[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        groups[find(k)].append(doc_id)
    least = {k: min((d for d in ids if d is not None), default=None) for k, ids in groups.items()}
    return sorted(((d, len(s), least[find(k)]) for k, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("rows", [ODD, list(enumerate(near_copies())) + [(100 + k, t) for k, t in enumerate(near_copies())]])
def test_components(documents, rows):
    rows = [(d, t) for d, t in rows]
    got = ngram_join.join(documents(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == by_brute_force(rows)


def test_frequent_tokens_keep_every_link(documents, monkeypatch):
    rows = list(enumerate(near_copies(80, 40)))
    monkeypatch.setattr(ngram_join, "LEAST_LEVEL", 1)
    got = ngram_join.join(documents(rows).coalesce(1)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == by_brute_force(rows)


@pytest.mark.parametrize("block", [1, 3])
def test_blocks_of_a_key_lose_no_link(documents, monkeypatch, block):
    rows = list(enumerate(near_copies(80, 40)))
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "TILE_BYTES", 2_000)
    got = ngram_join.join(documents(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == by_brute_force(rows)


def test_tiles_pair_what_may_link():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    sets = [base[np.sort(rng.choice(400, size, replace=False))] for size in rng.integers(200, 400, 60)] + [base[:3], base[:2]]
    n, bits = np.array([len(x) for x in sets]), [ngram_join.signature(x) for x in sets]
    root, side = np.arange(len(sets)) // 2, np.repeat([0, 1], len(sets) // 2)
    for sides in (side, np.zeros(len(sets), int)):
        got = set(zip(*(x.tolist() for x in ngram_join.tile_pairs(n, root, sides, bits))))
        every = [(a, b) for b in range(len(sets)) for a in range(b) if root[a] != root[b] and (sides[a] != sides[b] or not sides.any())]
        shared = {(a, b): ngram_join.most_shared(bits[a], n[a], bits[b], n[b]) for a, b in every}
        assert got == {(a, b) for (a, b), s in shared.items() if 100 * s >= 75 * (n[a] + n[b] - s) and 100 * min(n[a], n[b]) >= 75 * max(n[a], n[b])}
        assert got


def test_one_of_each_group_stays(documents):
    docs = documents(ODD)
    kept = ngram_join.representatives(docs, ngram_join.join(docs)).select("doc_id", "text").collect()
    assert sorted(((d, t) for d, t in kept), key=str) == sorted(
        [(1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, "one two three"), (7, ODD[7][1]), (8, ODD[9][1]), (9, ODD[10][1])], key=str
    )


def test_no_rows(documents):
    assert ngram_join.join(documents([])).count() == 0
    assert lines.dedup(documents([])).count() == 0


def deduped(rows):
    seen, out = [], {}
    order = sorted(dict.fromkeys(rows), key=lambda row: (row[0] is None, row[0] or 0))
    for doc_id, text in order:
        if text is None:
            out[doc_id, text] = (None, 0, 0)
            continue
        kept, removed = [], 0
        for line in text.split("\n"):
            own = shingles(line)
            if own and any(alike(own, other) for other in seen):
                removed += 1
            else:
                kept.append(line)
            if own:
                seen.append(own)
        out[doc_id, text] = ("\n".join(kept), text.count("\n") + 1, removed)
    return out


def test_lines(documents):
    copies = near_copies()
    rows = [(k, f"{line}\nshort line\n\n{line} tail{k}") for k, line in enumerate(copies)]
    rows += [(50, None), (51, ""), (52, "short line"), (None, copies[0]), (53, "  short   line "), (53 + 1, "x\ty  z")]
    want = deduped(rows)
    docs = documents(rows + rows[:2])
    got = lines.dedup(docs).select("doc_id", "text", "n_lines", "n_removed", "source").collect()
    left = defaultdict(list)
    for row in got:
        left[row.doc_id].append((row.text, row.n_lines, row.n_removed))
    for (doc_id, _), value in want.items():
        assert set(left[doc_id]) == {value}
    assert len(got) == len(rows) + 2


def test_leaders_are_only_paired_with_other_components(spark):
    """A class of another component meets each turn's leader; the many of one component make no pairs."""
    rows = [(key, c, 7 if c % 50 == 7 else 1) for key in range(3) for c in range(200)]
    placed = spark.createDataFrame(rows, "key long, class long, root long")
    root = {c: r for _, c, r in rows}
    for turn in range(1, 4):
        found = [tuple(r) for r in ngram_join.apart_pairs(placed, turn).collect()]
        assert found and all(a < b and root[a] != root[b] for a, b in found)

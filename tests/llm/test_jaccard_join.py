from __future__ import annotations

import random
import re

import numpy as np
import pytest

from railyard.llm import jaccard_join
from railyard.llm.jaccard_join import Join, near_components, op9_jaccard_join


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, width):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < width else frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def brute(rows, join):
    """{(doc_id, text): (n, component)} by comparing all sets."""
    sets = {r: shingles(r[1], join.width) for r in rows}
    parent = {r: r for r in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    rows = list(sets)
    for i, a in enumerate(rows):
        for b in rows[:i]:
            x, y = sets[a], sets[b]
            if not x or not y or min(len(x), len(y)) * join.den < max(len(x), len(y)) * join.num:
                continue
            common = len(x & y)
            if common * join.den >= (len(x) + len(y) - common) * join.num:
                parent[top(a)] = top(b)
    low = {}
    for r in rows:
        if r[0] is not None:
            low[top(r)] = min(low.get(top(r), r[0]), r[0])
    return {r: (len(sets[r]), low.get(top(r))) for r in rows}


def check(docs, join):
    rows = {(r.doc_id, r.text) for r in docs.collect()}
    want = sorted((r[0], *v) for r, v in brute(rows, join).items() if r[0] is not None)
    got = sorted(tuple(r) for r in near_components(docs, join).collect() if r.doc_id is not None)
    assert got == want


@pytest.mark.parametrize("join", [Join(3, 90, 100), Join(5, 8, 10), Join(2, 7, 10)])
def test_edits_match_brute_force(docs_of, join):
    rng = random.Random(join.num)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for size in (1, 2, 3, 5, 9, 12, 13, 20, 40, 90, 200, 420):
        for _ in range(2):
            base = [rng.choice(vocab) for _ in range(size)]
            for edits in (0, 0, 1, 1, 2, 3, 5, 9):
                copy = list(base)
                for _ in range(min(edits, size)):
                    at, kind = rng.randrange(len(copy)), rng.random()
                    copy[at:at + 1] = [] if kind < 0.2 and len(copy) > 1 else [rng.choice(vocab)] * (2 if kind > 0.9 else 1)
                texts.append(" ".join(copy))
    check(docs_of(texts), join)


def signatures_of(join, sets):
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    found, owner = jaccard_join.signatures(join, np.concatenate(sets), at)
    return [set(found[owner == i].tolist()) for i in range(len(sets))]


@pytest.mark.parametrize("join", [Join(3, 90, 100), Join(5, 8, 10), Join(2, 7, 10)])
def test_sets_at_the_threshold_share_a_signature(join):
    rng = np.random.default_rng(join.num)
    for n in (5, 9, 10, 20, 37, 60, 110, 240, 700, 1900):
        for _ in range(12):
            m = int(rng.integers(n, n * join.den // join.num + 1))
            common = -(-join.num * (n + m) // (join.num + join.den))
            if common > n or common == m:  # they can't link, or are equal
                continue
            all_ = rng.integers(0, 1 << 63, n + m - common).astype(np.uint64)
            one, other = signatures_of(join, [np.sort(all_[:n]), np.sort(np.concatenate([all_[:common], all_[n:]]))])
            assert one & other


def test_sets_without_a_common_element_share_no_signature():
    rng = np.random.default_rng(1)
    found = signatures_of(Join(5, 8, 10), [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in rng.integers(150, 1500, 300)])
    assert sum(map(len, found)) == len(set().union(*found))


def test_chain_of_near_copies_is_one_component(docs_of):
    base = [f"a{i}" for i in range(150)]
    texts = [" ".join([f"b{j}" for j in range(i)] + base[i:]) for i in range(0, 60)]
    rows = near_components(docs_of(texts), Join(3, 90, 100)).collect()
    assert {r.component_id for r in rows} == {0}


def test_unlinked_texts_that_share_much(docs_of):
    """A template with an own part each: many share signatures, none link."""
    rng = random.Random(3)
    base = [f"t{i}" for i in range(100)]
    texts = []
    for i in range(60):
        t = list(base)
        for at in rng.sample(range(100), 6):
            t[at] = f"x{i}"
        texts.append(" ".join(t))
    check(docs_of(texts), Join(3, 90, 100))


@pytest.mark.parametrize("many", [20, 4096])
def test_large_group_in_which_only_some_link(docs_of, monkeypatch, many):
    """Copies of one text with one to nine own edits, two variants of it, and copies that share edits."""
    monkeypatch.setattr(jaccard_join, "MANY", many)
    rng = random.Random(8)
    base = [f"t{i}" for i in range(120)]
    variant = base[:40] + [f"v{i}" for i in range(9)] + base[49:]
    texts = []
    for i in range(150):
        t = list(base if i % 3 else variant)
        for at in rng.sample(range(120), rng.choice([1, 2, 3, 4, 9])):
            t[at] = f"x{i}"
        texts.append(" ".join(t))
        if i % 10 == 0:
            t[rng.randrange(120)] = "again"
            texts.append(" ".join(t))
    check(docs_of(texts), Join(3, 90, 100) if many == 20 else Join(5, 8, 10))


def test_edges(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\x0btwo"), (7, "ONE\x0btwo"),
            (None, "one two"), (9, "É a b"), (10, "é a b"), (11, "x y z " * 40000)]
    docs = docs_of(rows, node="n", sig="s", comp="c", h="h")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_components(docs, Join(3, 90, 100)).collect()),
                 key=lambda r: (r[0] is None, r))
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6), (7, 1, 6), (9, 1, 9),
                   (10, 1, 10), (11, 3, 11), (None, 1, 6)]
    assert near_components(docs.limit(0), Join()).collect() == []


def test_query_matches_brute_force_on_whole_table(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = {(r.doc_id, r.text) for r in docs.collect()}
    want = sorted((r[0], *v) for r, v in brute(rows, Join(3, 90, 100)).items())
    assert sorted(tuple(r) for r in op9_jaccard_join(spark, sf001).collect()) == want


def test_fine_sketches_fold_and_never_dismiss_a_link():
    """Two sets of different sizes meet on sketches of one width; their distance bounds the sets' difference."""
    import numpy as np
    import pyarrow as pa

    from railyard.llm import jaccard_join as J
    from railyard.llm.wordhash import list_column

    rng = np.random.default_rng(8)
    join = J.Join(width=5, num=8, den=10)
    sets, pairs = [], []
    for n in (1, 40, 300, 700, 1023, 1025, 5000):
        base = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
        for share in (0.0, 0.05, 0.11, 0.5, 1.0):
            other = base.copy()
            k = int(n * share)
            other[:k] = rng.integers(0, 2 ** 63, k, dtype=np.uint64)
            other = np.concatenate([other, rng.integers(0, 2 ** 63, int(n * 0.04), dtype=np.uint64)])
            pairs.append((len(sets), len(sets) + 1))
            sets += [base, other]
    at = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    words, ends = J._fine(np.concatenate(sets), at)
    sketches = [words[ends[i]:ends[i + 1]] for i in range(len(sets))]
    assert all(len(w) * 64 >= len(x) if len(x) > J.LARGE // 2 else not len(w) for w, x in zip(sketches, sets))
    side = lambda k: list_column(np.concatenate([sketches[p[k]] for p in pairs]),
                                 np.concatenate([[0], np.cumsum([len(sketches[p[k]]) for p in pairs])]))
    rows = pa.RecordBatch.from_arrays([
        pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs]), pa.array([len(sets[p[0]]) for p in pairs]),
        pa.array([len(sets[p[1]]) for p in pairs]), side(0), side(1)], ["u", "v", "u_n", "v_n", "a", "b"])
    kept = {tuple(r.values())[:2] for b in J._near_on_fine(join, iter([rows])) for r in b.to_pylist()}
    for u, v in pairs:
        a, b = set(sets[u].tolist()), set(sets[v].tolist())
        if len(a & b) * join.den >= len(a | b) * join.num:
            assert (u, v) in kept
        elif len(a ^ b) > 0.6 * (len(a) + len(b)) and len(a) >= 300:
            assert (u, v) not in kept


def test_large_sets_are_compared_on_fine_sketches(docs_of, monkeypatch):
    """Long texts that share a passage but don't link, and such that do; the result is that of the whole sets."""
    import random

    from railyard.llm import jaccard_join as J

    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    shared = [word() for _ in range(60)]
    texts = [" ".join(shared + [word() for _ in range(900)]) for _ in range(25)]
    for t in texts[:5]:
        words = t.split()
        words[500] = "edited"
        texts.append(" ".join(words))
    seen = []
    real = J._verified
    monkeypatch.setattr(J, "_verified", lambda close, sets, join: (seen.append(close.count()), real(close, sets, join))[1])
    got = {r.doc_id: r.component_id for r in J.near_components(docs_of(texts), J.Join(5, 8, 10)).collect()}
    assert got == {i: i if i < 25 else i - 25 for i in range(30)}
    assert sum(seen) == 5


def test_blocks_of_large_sets_emit_only_near_pairs():
    import numpy as np
    import pandas as pd

    from railyard.llm import jaccard_join as J

    rng = np.random.default_rng(9)
    join = J.Join(width=5, num=8, den=10)
    sets = [np.sort(rng.integers(0, 2 ** 63, n, dtype=np.uint64)) for n in (300, 300, 1000, 1100, 4000, 4100, 5000, 9000)]
    sets += [np.sort(np.concatenate([sets[4][:-100], rng.integers(0, 2 ** 63, 300, dtype=np.uint64)]))]
    sets += [sets[2][:-20], sets[0][5:], np.sort(np.concatenate([sets[7], sets[1]]))]
    at = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    flat = np.concatenate(sets)
    words, ends = J._fine(flat, at)
    rows = pd.DataFrame({"i_side": True, "j_side": True, "node": np.arange(len(sets)), "comp": np.arange(len(sets)),
                         "n": [len(x) for x in sets], "sketch": [w if len(x) <= J.LARGE else None for w, x in zip(J._sketch(flat, at).view(np.int64), sets)],
                         "fine": [words[ends[i]:ends[i + 1]].view(np.int64) for i in range(len(sets))]})
    got = {tuple(sorted(p)) for p in J._compare_block(join, rows).itertuples(index=False, name=None)}
    assert got == {(4, 8), (2, 9), (0, 10), (7, 11)}


@pytest.mark.parametrize("join", [Join(3, 90, 100), Join(5, 8, 10)])
def test_linked_members_near_or_far_from_the_pivot_share_a_closer_bucket(spark, join):
    """Members at all distances from the pivot; each has linked ones, by edits of its own or towards the pivot."""
    rng = random.Random(4)
    pivot = set(range(200))
    sets = [pivot]
    for far in (0, 3, 10, 20, 25, 30, 45, 60, 120, 190):
        for _ in range(4):
            one = set(rng.sample(sorted(pivot), 200 - far)) | {rng.randrange(1000, 10**6) for _ in range(far)}
            sets.append(one)
            for edits in (1, 4, 8, 18):
                gone = rng.sample(sorted(one), edits)
                sets += [one - set(gone), one - set(gone) | {rng.randrange(10**6, 10**7) for _ in gone}]

    def links(a, b):
        common = len(a & b)
        return common * join.den >= (len(a) + len(b) - common) * join.num

    whole = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "node long, elements array<long>")
    rows = spark.createDataFrame([(0, 0, 0, i, 0 if links(s, pivot) else i, 1) for i, s in enumerate(sets) if i],
                                 "cluster long, pivot long, pivot_comp long, node long, comp long, weight long")
    buckets = {}
    for r in jaccard_join._closer_buckets(rows, whole, whole.where("node = 0"), join).collect():
        buckets.setdefault(r.node, set()).add(r.key)
    outside = [i for i, s in enumerate(sets) if not links(s, pivot)]
    pairs = [(x, y) for x in outside for y in range(1, len(sets)) if x != y and links(sets[x], sets[y])]
    assert len(pairs) > 100
    assert all(buckets[x] & buckets[y] for x, y in pairs)

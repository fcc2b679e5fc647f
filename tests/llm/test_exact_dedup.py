from __future__ import annotations

import hashlib
import re

from railyard.llm.exact_dedup import drop_exact_copies, exact_groups


def sha(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def test_groups(docs_of):
    rows = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, "a\n\tb"), (5, None), (6, ""), (7, " "), (8, "A b"), (9, "é "),
            (10, "x" * 200000), (11, "x" * 200000), (None, "ab")]
    got = {r.doc_id: r for r in exact_groups(docs_of(rows, sha="s", h="h", maybe="m", bit="b")).collect()}
    assert len(got) == len(rows)
    by_text = {}
    for i, t in rows:
        by_text.setdefault(sha(t), []).append((-len(t or ""), i is None, i or 0, i))
    for i, t in rows:
        group = by_text[sha(t)]
        assert got[i].text_sha256 == sha(t)
        assert got[i].group_size == len(group)
        assert got[i].keep_id == min(group)[3]
        assert got[i].kept == (i == min(group)[3])


def test_repeated_rows_keep_one(docs_of):
    rows = [(1, "ab"), (1, "ab"), (1, "a b"), (2, "c"), (2, "c")]
    got = exact_groups(docs_of(rows)).collect()
    assert len(got) == 5
    assert sorted((r.doc_id, r.group_size) for r in got if r.kept) == [(1, 3), (2, 2)]
    kept = drop_exact_copies(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "a b"), (2, "c")]


def test_hot_group_and_columns(docs_of):
    rows = [(i, "same text") for i in range(500)] + [(1000 + i, f"own {i}") for i in range(500)]
    docs = docs_of(rows, row="r", h="h", sha="s")
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(1000, 1500)]
    assert exact_groups(docs.limit(0)).collect() == [] and drop_exact_copies(docs.limit(0)).collect() == []


def test_plan_has_no_python(docs_of):
    plan = exact_groups(docs_of(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

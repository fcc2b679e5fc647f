from __future__ import annotations

import random
from collections import defaultdict

from railyard.llm import line_dedup as D


def lines_of(text):
    return [x for x in (line.strip(" \t\n\x0b\x0c\r") for line in (text or "").split("\n")) if x]


def brute(rows, least):
    """{(doc_id, text): lines to delete} from the shortest windows of ``least`` words that start, or end, at each line,
    compared as texts."""
    places = defaultdict(set)
    docs = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    for nr, (i, t) in enumerate(docs):
        lines = lines_of(t)
        words = [len(x.split()) for x in lines]
        for at in range(len(lines)):
            for step in (1, -1):
                total, n = 0, 0
                while 0 <= at + step * n < len(lines) and total < least:
                    total += words[at + step * n]
                    n += 1
                if total >= least:
                    start = at if step == 1 else at - n + 1
                    places[tuple(lines[start:start + n])].add((nr, start, n))
    out = defaultdict(set)
    for copies in places.values():
        for nr, at, n in sorted(copies)[1:]:  # in order of document and line
            out[docs[nr]].update(range(at, at + n))
    return out


def check(docs, least):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, least)
    expected = sorted((str(i), len(lines_of(t)), len(want[i, t]), ",".join(map(str, sorted(want[i, t])))) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.dropped_lines) for r in D.line_report(docs, least).collect()) == expected
    return want


def test_runs(docs_of):
    rng = random.Random(6)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randint(1, 6))) for _ in range(12)]
    runs = [[rng.choice(pool) for _ in range(rng.randint(2, 9))] for _ in range(6)]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one line"), (None, "null id\n" + "\n".join(runs[0]))]
    for i in range(10, 70):
        lines = []
        for _ in range(rng.randint(1, 4)):
            lines += rng.choice(runs) if rng.random() < 0.7 else [f"own {i} {rng.random()}"]
        rows.append((i, "\n".join(f"  {x}\t" if rng.random() < 0.1 else x for x in lines) + "\n" * rng.randint(0, 2)))
    rows += [(500, "same\n" * 3000), (501, rows[-1][1]), (501, rows[-1][1])]
    docs = docs_of(rows, rank="r", at="a", did="d", h="h")
    want = check(docs, 12)
    kept = {(r.doc_id, r.h): r.text for r in D.drop_repeated_lines(docs, 12).collect()}
    for i, t in rows:
        gone = want[i, t]
        lines = lines_of(t)
        assert kept[i, "h"] == ("\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else t)
    assert D.line_report(docs.limit(0)).collect() == [] and D.drop_repeated_lines(docs.limit(0)).collect() == []


def test_whole_table(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    want = check(docs, D.MIN_WORDS)
    assert sum(map(len, want.values())) > 0


def test_plan_has_no_python(docs_of):
    plan = D.line_report(docs_of(["a\nb"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def maximal(rows, least):
    """{(doc_id, text): lines to delete} by maximal runs: a line goes if a run of ``least`` words through it has an
    earlier copy. Tries every run of every length, compared as texts."""
    first, out = {}, defaultdict(set)
    for i, t in sorted(rows):
        lines = lines_of(t)
        for at in range(len(lines)):
            for end in range(at + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[at:end]) >= least and first.setdefault(tuple(lines[at:end]), (i, at)) != (i, at):
                    out[i, t].update(range(at, end))
    return out


def test_whole_runs(docs_of):
    sized = lambda name, *sizes: [" ".join(f"{name}{k}x{j}" for j in range(n)) for k, n in enumerate(sizes)]
    run, other, middle = sized("r", 7, 25, 25, 3, 4), sized("o", 1, 2, 49, 1, 30, 1), sized("m", 30, 15, 30, 2)
    parts = [run, other, middle, sized("s", 60, 1, 1)]
    rows = [(2, run), (5, ["own a"] + run + ["own b"]), (7, other), (8, other[1:] + ["own c"]), (9, middle), (10, middle),
            (11, sized("u", 20, 20)), (12, sized("u", 20, 20)), (13, parts[3]), (14, parts[3] + run[:3])]
    rng = random.Random(4)
    rows += [(i, sum((rng.choice(parts)[rng.randint(0, 2):] for _ in range(2)), [f"own {i}"])) for i in range(20, 30)]
    rows = [(i, "\n".join(lines)) for i, lines in rows]
    docs = docs_of(rows)
    want = maximal(rows, D.MIN_WORDS)
    assert want[rows[1]] == {1, 2, 3, 4, 5} and brute(rows, D.MIN_WORDS) == {k: v for k, v in want.items() if v}
    got = {r.doc_id: r.dropped_lines for r in D.line_report(docs).collect()}
    assert got == {i: ",".join(map(str, sorted(want[i, t]))) for i, t in rows}
    texts = {r.doc_id: r.text for r in D.drop_repeated_lines(docs).collect()}
    assert texts[2] == rows[0][1] and texts[5] == "own a\nown b"


def test_repeated_rows_take_part_once(docs_of, monkeypatch):
    """Rows of equal id and text are one document before the self-join, not after it."""
    sizes, stored = [], D.stored

    def counting(df, name):
        out = stored(df, name)
        if name == "suffixes":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(D, "stored", counting)
    text = "\n".join(" ".join(f"w{k}x{j}" for j in range(20)) for k in range(4))
    got = D.line_report(docs_of([(1, text)] * 30 + [(2, text)])).collect()
    assert sizes[0] == 8
    assert sorted((r.doc_id, r.dropped_lines) for r in got) == [(1, "")] * 30 + [(2, "0,1,2,3")]

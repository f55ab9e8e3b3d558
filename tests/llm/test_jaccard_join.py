import random
from collections import defaultdict

import numpy as np
import pytest

from incidentmart.llm import jaccard_join as join
from incidentmart.llm.components import components
from incidentmart.llm.jaccard_join import jaccard_join, keep_one, roots_of, runs_for, sketches, estimate, short
from incidentmart.llm.queries import op10_jaccard_join
from incidentmart.llm.words import Words

from cases import ODD, empty, odd, words


def shingles(t):
    w = words(t)
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(class, links, kept) per row position, by all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    seen, links, root = defaultdict(list), [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in seen[x]:
                shared[j] += 1
            seen[x].append(i)
        for j, n in shared.items():
            if 9 * n >= 4 * (len(s) + len(sets[j])):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    key = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    best = {}
    for i in range(len(rows)):
        best[find(i)] = min(best.get(find(i), i), i, key=key)
    win = [best[find(i)] for i in range(len(rows))]
    return [(rows[w][0], n, key(i) == key(w) and words(rows[i][1]) == words(rows[w][1])) for i, (w, n) in enumerate(zip(win, links))]


def compare(df, rows):
    order = lambda x: tuple((v is None, v) for v in x)
    got = sorted(((r.doc_id, r.class_id, r.n_links, r.kept) for r in jaccard_join(df).collect()), key=order)
    assert got == sorted(((i, *x) for (i, _), x in zip(rows, brute(rows))), key=order)


def test_odd_rows(spark):
    rows = [(i, t) for i, t, *_ in ODD]
    compare(odd(spark).selectExpr("*", "1 AS class_id", "2 AS v"), rows)


@pytest.mark.parametrize("shared", [False, True])
def test_large_cluster_and_frequent_passage(spark, shared):
    rng = random.Random(3)
    passage = [f"p{k}" for k in range(40)]
    base = passage * shared + [f"b{k}" for k in range(160)]     # shared: large nodes hold the cluster and others
    rows = []
    for i in range(900):
        if i % 3 == 0:                          # a third of all rows are near copies of one text
            t = list(base)
            for _ in range(rng.choice([0, 1, 2, 3])):
                t[rng.randrange(len(t))] = f"z{i}"
        else:                                   # and most of the others share a passage
            t = passage + [f"w{rng.randrange(3000)}" for _ in range(60)]
            if i % 50 == 1:
                t = list(rows[-1][1].split()) + ["end"]
        rows.append((i, " ".join(t)))
    compare(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), rows)


def test_keep_one(spark):
    df = odd(spark).selectExpr("*", "1 AS class_id")
    got = keep_one(df)
    assert got.columns == df.columns
    exp = sorted(str((i, t)) for (i, t, *_), x in zip(ODD, brute([(i, t) for i, t, *_ in ODD])) if x[2])
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == exp


def test_empty_table(spark):
    assert jaccard_join(empty(spark)).count() == 0 and keep_one(empty(spark)).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = sorted((r.doc_id, r.class_id, r.n_links, r.kept) for r in op10_jaccard_join(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted((i, *x) for (i, _), x in zip(rows, brute(rows)))


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(7, 7)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    own = {}
    for a, b in edges:
        if a != b:
            own.setdefault(a, a), own.setdefault(b, b)
    for _ in range(100):
        for a, b in edges:
            if a != b:
                own[a] = own[b] = min(own[a], own[b])
    assert got == own


def test_parts():
    assert runs_for(0.999) >= 15 > runs_for(0.9)
    assert list(roots_of(6, np.array([4, 2, 1]), np.array([5, 4, 2]))) == [0, 1, 1, 3, 1, 1]
    a = [f"w{k}" for k in range(400)]
    b = a[:380] + [f"x{k}" for k in range(20)]
    sk = short(sketches(Words([" ".join(a).encode(), " ".join(b).encode()]), 5))
    assert abs(estimate(sk[:1], sk[1:])[0] - 376 / 416) < 0.15


def test_deep_nodes_take_further_runs(spark, monkeypatch):
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(55)]                  # far from near copies, but every node of it is split again and again
    rows = [(i, " ".join(passage + [f"w{rng.randrange(9000)}" for _ in range(45)])) for i in range(300)]
    rows += [(1000 + i, t + " end") for i, t in rows[::20]]
    monkeypatch.setattr(join, "LIMIT", 4)
    monkeypatch.setattr(join, "SETTLE", 4)
    reached, runs, follow, stream = [], [], join.follow, join.stream

    def followed(*a):
        out = follow(*a)
        reached.append(out[1])
        return out

    monkeypatch.setattr(join, "follow", followed)
    monkeypatch.setattr(join, "stream", lambda seed, n: runs.append(n) or stream(seed, n))
    compare(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)
    assert max(reached) > join.DEPTH and len(reached) > 1
    assert max(runs) == runs_for(0.999, max(reached)) > runs_for(0.999)

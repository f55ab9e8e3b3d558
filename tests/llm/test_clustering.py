import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentmart.llm.clustering import OUT, cluster, moved, nearest, round_sums


def brute_force(rows, dims, k, rounds, scale=256, seed=2):
    """Plain integers: every vector against every centroid."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    ordered = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in ordered[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    if not cents:
        return []
    for _ in range(rounds):
        own = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, c) in zip(kept, own) if c == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    per = {}
    for far, j in own:
        per[j] = per.get(j, 0) + far
    return sorted((i is None, i or 0, j, far, per[j], sum(per.values()), cents[j]) for (i, _), (far, j) in zip(kept, own))


def run(spark, rows, dims, k, rounds, kind="array<float>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}").repartition(4)
    got = cluster(df, dims=dims, k=k, rounds=rounds, columns=["vec_id"]).collect()
    return sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid)) for r in got)


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_equals_brute_force(spark, kind):
    r = random.Random(3)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, [0.5] * 6) for i in range(40)] + [(7, [0.25] * 6), (7, [0.125] * 6)]            # copies, a repeated id
    assert run(spark, rows, 6, 9, 4, kind) == brute_force(rows, 6, 9, 4)


def test_unusable_vectors_are_left_out(spark):
    ok = [(i, [i / 7, -i / 3, 0.0]) for i in range(12)]
    bad = [(90, None), (91, []), (92, [1.0, 2.0]), (93, [1.0, None, 2.0]), (94, [float("nan"), 0.0, 0.0]), (95, [0.0, float("-inf"), 0.0]), (96, [0.0] * 4)]
    rows = ok + bad + [(None, [1.0, 1.0, 1.0]), (3, [3 / 7, -1.0, 0.0])]
    got = run(spark, rows, 3, 5, 3, "array<double>")
    assert got == brute_force(rows, 3, 5, 3) and len(got) == 14


def test_empty_centroids_stay_and_ties_go_to_the_smaller_number(spark):
    rows = [(i, [1.0, 1.0]) for i in range(10)] + [(10, [2.0, 2.0])]
    got = run(spark, rows, 2, 8, 5, "array<double>")
    assert got == brute_force(rows, 2, 8, 5)
    assert len({r[2] for r in got}) == 2


def test_no_vectors_and_fewer_than_centroids(spark):
    assert run(spark, [], 3, 5, 2) == []
    assert run(spark, [(None, [1.0, 2.0, 3.0])], 3, 5, 2) == []
    rows = [(1, [1.0, 2.0, 3.0]), (2, [9.0, 2.0, 3.0])]
    assert run(spark, rows, 3, 5, 2) == brute_force(rows, 3, 5, 2)


def test_clashing_columns_come_back(spark):
    rows = [(i, [i * 1.0, -i * 1.0], "a", i, "b") for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whole_vector string, vector_key long, of_cluster string").withColumn("distance", F.lit("old"))
    got = cluster(df, dims=2, k=3, rounds=2)
    assert got.columns == ["vec_id", "embedding", "whole_vector", "vector_key", "of_cluster", *OUT]
    assert {(r.whole_vector, r.vector_key == r.vec_id, r.of_cluster) for r in got.collect()} == {("a", True, "b")}


def test_too_large_components_fail(spark):
    with pytest.raises(Exception, match="beyond"):
        run(spark, [(1, [1e30, 0.0])], 2, 1, 1, "array<double>")


def test_tables_equal_direct_distances():
    r = np.random.default_rng(1)
    x, c = r.integers(-(1 << 20), 1 << 20, (500, 7)), r.integers(-(1 << 20), 1 << 20, (11, 7))
    own, far = nearest(x, c)
    direct = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (own == direct.argmin(axis=1)).all() and (far == direct.min(axis=1)).all()


def test_sums_do_not_depend_on_the_partitions(spark):
    r = np.random.default_rng(2)
    x, c = r.integers(-300, 300, (200, 4)), r.integers(-300, 300, (6, 4))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<int>")
    want = round_sums(df.coalesce(1), "v", c)
    assert round_sums(df.repartition(7), "v", c) == want
    own, _ = nearest(x, c)
    assert (moved(c, want) == np.array([x[own == j].sum(axis=0) // (own == j).sum() if (own == j).any() else c[j] for j in range(6)])).all()

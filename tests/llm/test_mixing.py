import random

import pytest
from pyspark.sql import functions as F

from incidentmart.llm.common import WORD
from incidentmart.llm.mixing import mix_sources, water_level
from incidentmart.llm.queries import mixed

from cases import empty, odd, words


def fill(sources, budget):
    """Plain water-filling: clamp, share the rest again."""
    level, full = 0.0, set()
    while True:
        free = [s for s in sources if s not in full]
        if not free:
            return {s: sources[s][1] for s in sources}
        level = (budget - sum(sources[s][1] for s in full)) / sum(sources[s][0] for s in free)
        over = {s for s in free if sources[s][0] * level >= sources[s][1]}
        if not over:
            return {s: sources[s][1] if s in full else sources[s][0] * level for s in sources}
        full |= over


@pytest.mark.parametrize("seed", range(4))
def test_water_level(spark, seed):
    rng = random.Random(seed)
    sources = {i: (rng.choice([1.0, 2.0, 3.0]), 2.0 * rng.randint(0, 1000)) for i in range(12)}
    budget = 0.75 * sum(c for _, c in sources.values())
    level = water_level(spark.createDataFrame([(w, c) for w, c in sources.values()], "weight double, cap double"), budget)
    exp = fill(sources, budget)
    for s, (w, c) in sources.items():
        assert min(c, w * level) == pytest.approx(exp[s])


def test_targets_are_met(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('s', id % 5) END AS source",
        "repeat('word ', cast(1 + pmod(xxhash64(id), 40) AS int)) AS text")
    got = mixed(docs)
    by = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("n"),
                                   F.max("size").alias("most"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
    assert len(by) == 7
    for r in by:
        assert abs(r.taken - r.target) <= r.most and r.target <= 2 * r.n + 1e-6 and r.over <= 0
    assert sum(r.target for r in by) == pytest.approx(1.5 * sum(r.n for r in by))
    one = sorted(map(tuple, got.select("doc_id", "taken").collect()))
    assert one == sorted(map(tuple, mixed(docs.repartition(7)).select("doc_id", "taken").collect()))


def test_odd_rows(spark):
    got = mixed(odd(spark).selectExpr("*", "'x' AS taken", "5 AS SIZE")).collect()
    assert len(got) == 11
    for r in got:
        assert r["size"] == len(words(r.text)) and r.taken == r.repeats * r["size"] and r.taken <= 2 * r["size"]


def test_empty_and_unweighted(spark):
    assert mixed(empty(spark)).count() == 0
    weights = spark.createDataFrame([("a", 1)], "source string, weight int")
    got = mix_sources(odd(spark), weights, F.regexp_count("text", F.lit(WORD)))
    assert {r.taken for r in got.filter("source = 'b' OR source IS NULL").collect()} == {0}

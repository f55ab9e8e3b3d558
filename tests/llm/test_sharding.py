from collections import Counter

import numpy as np
import pytest

from incidentmart.llm.queries import op4_sharding
from incidentmart.llm.sharding import locate, permute, row_at, shard_rows

from cases import empty, odd


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation_and_inverse(n):
    p = permute(np.arange(n), n, seed=5)
    assert sorted(p) == list(range(n))
    assert (permute(p, n, 5, back=True) == np.arange(n)).all()
    if n > 100:
        assert (p != permute(np.arange(n), n, 6)).mean() > 0.9 and abs(np.corrcoef(np.arange(n), p)[0, 1]) < 0.1
    for row in (0, n - 1):
        assert row_at(*locate(row, n, 8, 5), n, 8, 5) == row


def check(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_brute_force_placement(spark):
    docs = spark.range(500).selectExpr("999 - id AS doc_id", "id % 3 AS shard").repartition(5)
    got = shard_rows(docs, ["doc_id"], shards=8, seed=17).collect()
    check(got, 8)
    for r in got:
        assert r.row_number == r.doc_id - 500 and (r.shard, r.slot) == locate(r.row_number, 500, 8, 17)


def test_odd_rows(spark):
    got = shard_rows(odd(spark).selectExpr("*", "1 AS slot"), ["doc_id", "text"], shards=4).collect()
    assert len(got) == 11
    check(got, 4)
    assert next(r for r in got if r.doc_id is None).row_number == 0
    assert shard_rows(empty(spark), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        shard_rows(odd(spark).selectExpr("doc_id AS Slot"), ["Slot"])


def test_query(spark):
    rows = op4_sharding(spark, "/root/testdata/sf0.001").collect()
    check(rows, 8)
    assert Counter(r.law for r in rows) == {"rows": len(rows)}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op4_sharding(spark, "/root/testdata/sf0.001").collect()))

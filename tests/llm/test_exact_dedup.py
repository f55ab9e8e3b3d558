import hashlib
from collections import defaultdict

from incidentmart.llm.exact_dedup import exact_dedup

from cases import ODD, empty, odd

SPACES = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def norm(t):
    return (t or "").translate(SPACES)


def test_against_brute_force(spark):
    groups = defaultdict(list)
    for i, t, *_ in ODD:
        groups[norm(t)].append((-len(t or ""), i is None, i))
    got = exact_dedup(odd(spark)).collect()
    assert len(got) == len(ODD)
    for r in got:
        g = groups[norm(r.text)]
        assert (r.keep_id, r.group_size) == (min(g)[2], len(g))
        assert r.text_sha256 == hashlib.sha256(norm(r.text).encode()).hexdigest()
    kept = [norm(r.text) for r in got if r.kept]
    assert sorted(kept) == sorted(groups)       # one row of each group, also where rows repeat


def test_full_filter_changes_nothing(spark):
    a = sorted(map(str, exact_dedup(odd(spark)).collect()))
    assert a == sorted(map(str, exact_dedup(odd(spark), bits_per_row=1, max_buckets=1).collect()))


def test_copies_of_a_third(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same text' ELSE concat('text ', id) END AS text")
    got = exact_dedup(rows).groupBy("kept").count().collect()
    assert {r.kept: r["count"] for r in got} == {True: 2001, False: 999}


def test_empty_and_clashing_columns(spark):
    assert exact_dedup(empty(spark)).count() == 0
    got = exact_dedup(odd(spark).selectExpr("*", "'x' AS kept", "1 AS Group_Size", "2 AS text_SHA256"))
    assert [c for c in got.columns if c.lower() in ("kept", "group_size", "text_sha256")] == ["group_size", "kept", "text_sha256"]
    assert got.count() == len(ODD)


def test_native_plan(spark):
    plan = exact_dedup(odd(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan

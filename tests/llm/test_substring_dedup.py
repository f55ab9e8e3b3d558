import hashlib

import numpy as np
import pytest

from incidentmart.llm.substring_dedup import COVER, PERIOD, by_bucket, covers, remove_repeats

from cases import ODD, empty, odd, words


def brute(rows, width=13):
    first = {}
    far = float("inf")
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            first[key] = min(first.get(key, far), far if i is None else i)
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < (far if i is None else i):
                gone |= set(range(k, k + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i is None, i or 0, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(df, **kw):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(df, **kw).collect())


def test_cover():
    assert covers(PERIOD, COVER) and not covers(7, (1, 2, 3))
    for a in range(PERIOD):
        for b in range(PERIOD):
            assert any((a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER for d in range(PERIOD))


def test_a_group_visits_the_buckets_it_fills_only():
    hashes = np.array([5 << 20, 5 << 20, 7 << 20, (7 << 20) + 1, 3], np.uint64)
    distinct, full, starts = by_bucket(hashes, 1 << 31)
    assert full.tolist() == [0, 5, 7] and starts.tolist() == [0, 1, 2, 4]
    assert distinct.tolist() == [3, 5 << 20, 7 << 20, (7 << 20) + 1]
    distinct, full, starts = by_bucket(np.zeros(0, np.uint64), 64)
    assert not len(full) and starts.tolist() == [0]


def test_odd_rows(spark):
    assert run(odd(spark).selectExpr("*", "1 AS grp", "2 AS N_words")) == brute([(i, t) for i, t, *_ in ODD])
    assert remove_repeats(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(odd(spark), width=7)


def test_shifted_passages_in_many_groups(spark):
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(120):
        own = [f"d{i}x{k}" for k in range(40)]
        cut = i % 17
        rows.append((i, " ".join(own[:cut] + base[i % 23:i % 23 + 10 + i % 25] + own[cut:] + (base[:13] if i % 5 == 0 else base[:12]))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df, group_bytes=4000, min_buckets=8) == brute(rows)
    assert run(df, group_bytes=4000, min_buckets=100_000) == brute(rows)
    got = {r.doc_id: r for r in remove_repeats(df, group_bytes=4000).collect()}
    for i, t in rows:
        w, spans = t.split(), got[i].removed_spans
        assert got[i].kept_text.split() == [x for k, x in enumerate(w) if not any(a <= k < b for a, b in spans)]

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import LONG, empty, odd
from incidentmart.llm.decontamination import OUT, Recognizer, decontaminate, winnow, words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(texts, items, window=10):
    wins = {}
    for i, t in items:
        w = split(t)
        n = min(len(w), window)
        for p in range(len(w) - n + 1) if n else []:
            wins.setdefault(tuple(w[p:p + n]), set()).add("" if i is None else str(i))
    out = []
    for t in texts:
        w, hit, met = split(t), set(), set()
        for n in {len(x) for x in wins}:
            for p in range(len(w) - n + 1):
                if own := wins.get(tuple(w[p:p + n])):
                    hit |= set(range(p, p + n))
                    met |= own
        spans = [(p, next(q for q in range(p, len(w) + 1) if q not in hit)) for p in sorted(hit) if p - 1 not in hit]
        out.append((len(w), len(hit), len(met), sorted(met), spans))
    return out


def run(spark, texts, items, **more):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate(docs.repartition(3), bench, columns=["doc_id"], **more).collect()
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, list(r.item_ids), [tuple(s) for s in r.hit_spans]) for r in rows}


@pytest.mark.parametrize("gram", [1, 3, 6, 10])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, gram):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["Ärger", "日本", "x1y2"]

    def text(n):
        return "".join(r.choice(vocabulary).upper() + r.choice([" ", ", ", "\n", "--"]) if r.random() < 0.2 else r.choice(vocabulary) + " " for _ in range(n))

    items = [(i, text(r.choice([3, 5, 9, 10, 11, 25, 40]))) for i in range(12)] + [(12, None), (13, ""), (None, text(12)), (5, text(15))]
    texts = []
    for _ in range(60):
        parts = [text(r.randrange(30))]
        for _ in range(r.randrange(3)):
            w = (r.choice(items)[1] or "").split()
            a = r.randrange(len(w) + 1)
            parts += [" ".join(w[a:a + r.randrange(4, 30)]).swapcase(), text(r.randrange(12))]
        texts.append(" . ".join(parts))
    assert run(spark, texts, items, gram=gram) == dict(enumerate(brute_force(texts, items)))


def test_every_long_shared_span_has_a_common_fingerprint():
    r = random.Random(5)
    for _ in range(200):
        shared = [str(r.randrange(4)) for _ in range(10)]
        sides = []
        for _ in range(2):
            t = [f"a{r.random()}" for _ in range(r.randrange(8))] + shared + [f"b{r.random()}" for _ in range(r.randrange(8))]
            sides.append(set(winnow(words([" ".join(t).replace(".", "").encode()]), 10, 6)[2].tolist()))
        assert sides[0] & sides[1]


def test_fingerprints_are_fewer_than_words():
    w = words([" ".join(f"w{i}" for i in range(20_000)).encode()])
    assert len(np.unique(winnow(w, 10, 6)[1])) < 0.4 * 20_000


def test_passage_that_most_documents_and_items_share(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    items = [(i, f"item{i} {passage} end{i}") for i in range(30)]
    texts = [f"a{i} {passage} {passage} z{i}" if i % 3 else f"clean {i}" for i in range(90)]
    assert run(spark, texts, items) == dict(enumerate(brute_force(texts, items)))


def test_odd_rows_and_clashing_columns(spark):
    docs = odd(spark).withColumns({c: F.lit(k) for k, c in enumerate(["hits", "row_no", "whole_text", "start", "r", "kind", "item", "doc", "new", "run", "fingerprint"])})
    docs = docs.withColumns({"n_hit": F.lit("old"), "hit_spans": F.lit("old")})
    items = [(1, "quick brown fox jumps over the lazy dog and runs far away"), (2, "eine kleine"), (3, LONG[-500:]), (4, None)]
    got = decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == [c for c in docs.columns if c not in OUT] + OUT
    got = got.collect()
    want = brute_force([r.text for r in docs.collect()], items)
    assert sorted((r.n_words, r.n_hit, r.n_items, list(r.item_ids), [tuple(s) for s in r.hit_spans]) for r in got) == sorted(want)
    assert {tuple(r[c] for c in ("hits", "row_no", "whole_text", "start", "r", "kind", "item", "doc", "new", "run", "fingerprint")) for r in got} == {tuple(range(11))}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(empty(spark), none).count() == 0
    rows = decontaminate(odd(spark), none).collect()
    assert len(rows) == odd(spark).count() and not any(r.n_hit or r.n_items for r in rows)


def test_full_bitmaps_change_no_result(spark, monkeypatch):
    monkeypatch.setattr("incidentmart.llm.decontamination.MAX_BUCKETS", 1)
    monkeypatch.setattr(Recognizer, "holds", lambda self, prints: np.ones(len(prints), bool))
    items, texts = [(1, " ".join(f"w{i}" for i in range(30)))], [" ".join(f"w{i}" for i in range(k, k + 14)) for k in range(40)]
    assert run(spark, texts, items) == dict(enumerate(brute_force(texts, items)))

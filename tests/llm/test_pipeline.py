"""The pipeline, stage by stage, against plain Python over the same rows."""

import os
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline as C
from incidentmart.llm.langid import identify_language
from incidentmart.llm.piece_sampling import pieces
from incidentmart.llm.queries import language_model

from cases import empty, odd, words
from test_exact_dedup import norm
from test_jaccard_join import brute as classes

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_whole_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by_id = {r.doc_id: r for r in docs.collect()}
    pred = {r.doc_id: (r.rejected, r.lang_pred) for r in identify_language(docs, language_model(docs)).collect()}
    left = [i for i in sorted(by_id) if not pred[i][0]]
    groups = defaultdict(list)
    for i in left:
        groups[norm(by_id[i].text)].append((-len(by_id[i].text), i))
    left = sorted(min(g)[1] for g in groups.values())
    keep = classes([(i, by_id[i].text) for i in left])
    left = [i for i, x in zip(left, keep) if x[2]]
    got = C.run(spark, SF).collect()
    times = Counter(r.doc_id for r in got)
    assert set(times) <= set(left)
    size = {i: len(words(by_id[i].text)) for i in left}
    order = sorted({by_id[i].source for i in left})
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total = {s: sum(size[i] for i in left if by_id[i].source == s) for s in order}
    budget, full = 1.5 * sum(total.values()), set()
    while True:
        level = (budget - sum(2 * total[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and weight[s] * level >= 2 * total[s]}
        if not over:
            break
        full |= over
    for s in order:
        target = 2 * total[s] if s in full else weight[s] * level
        own = [i for i in left if by_id[i].source == s]
        assert abs(sum(times[i] * size[i] for i in own) - target) <= max(size[i] for i in own)
    p = pieces(public_tokenizers.path(C.MODEL), 1.0)
    for r in got:
        assert p.decode(np.array(r.pieces)) == by_id[r.doc_id].text and r.n_pieces == len(r.pieces)
        assert r.lang == pred[r.doc_id][1]
    assert "text" not in got[0]


@pytest.mark.parametrize("k", range(len(C.STAGES)))
def test_stage_takes_odd_and_empty_tables(spark, k):
    name, step = C.STAGES[k]
    extra = "*", "1 AS kept", "2 AS size", "'s' AS score", "3 AS class_id", "4 AS __t_"
    for docs in (odd(spark), empty(spark)):
        docs = docs.selectExpr(*extra)
        out = step(spark, docs, SF)
        if k < len(C.STAGES) - 1:
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        n = out.count()
        assert n == 0 if docs.isEmpty() else n > 0


def test_oracle_is_none_and_names():
    assert C.ORACLE_SQL is None and len(C.STAGES) == 5 and os.path.basename(C.__file__) == "corpus_pipeline.py"

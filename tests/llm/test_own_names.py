"""Input columns named like an operator's helper columns come back as they were."""

import os
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import incidentmart.llm
from incidentmart.llm.bpe_count import count_tokens
from incidentmart.llm.exact_dedup import exact_dedup
from incidentmart.llm.jaccard_join import keep_one
from incidentmart.llm.langid import fit_languages, identify_language
from incidentmart.llm.mixing import mix_sources
from incidentmart.llm.quality import quality_filter
from incidentmart.llm.sharding import shard_rows
from incidentmart.llm.substring_dedup import remove_repeats
from cases import odd

FOLDER = os.path.dirname(incidentmart.llm.__file__)
HELPERS = sorted({n for f in os.listdir(FOLDER) if f.endswith(".py")
                  for n in re.findall(r"__[a-z][a-z_]*\b(?!__)", open(os.path.join(FOLDER, f)).read()) if not n.endswith("__")} | {"__own_0", "__copy"})


def weights(docs):
    return docs.select("source").distinct().withColumn("weight", F.lit(1))


OPERATORS = {
    "identify_language": lambda d: identify_language(d, fit_languages(d.filter("lang IS NOT NULL"))),
    "mix_sources": lambda d: mix_sources(d, weights(d), F.length("text")),
    "exact_dedup": exact_dedup,
    "shard_rows": lambda d: shard_rows(d, ["doc_id", "text", "__p"]),
    "remove_repeats": remove_repeats,
    "count_tokens": lambda d: count_tokens(d, public_tokenizers.path("byte_bpe_50k.json")),
    "quality_filter": quality_filter,
    "keep_one": keep_one,
    "stage language_id": lambda d: corpus_pipeline.identify(d.sparkSession, d, ""),
    "stage exact_dedup": lambda d: corpus_pipeline.drop_copies(d.sparkSession, d, ""),
    "stage jaccard_join": lambda d: corpus_pipeline.drop_near_copies(d.sparkSession, d, ""),
    "stage mixing": lambda d: corpus_pipeline.mix(d.sparkSession, d, ""),
    "stage piece_sampling": lambda d: corpus_pipeline.encode(d.sparkSession, d, ""),
}


def test_helpers_are_found():
    assert {"__sha", "__points", "__id", "__text", "__t", "__v", "__u", "__p"} <= set(HELPERS)


@pytest.mark.parametrize("name", OPERATORS)
def test_helper_names_come_back(spark, name):
    docs = odd(spark).withColumns({h: F.concat_ws("/", F.lit(h), F.col("doc_id")) for h in HELPERS})
    got = OPERATORS[name](docs)
    assert [c for c in got.columns if c in HELPERS] == HELPERS
    rows = got.collect()
    assert rows
    for r in rows:
        assert all(r[h] == (h + "/" + str(r.doc_id) if r.doc_id is not None else h) for h in HELPERS)


@pytest.mark.parametrize("name", ["exact_dedup", "remove_repeats", "quality_filter", "mix_sources"])
def test_other_columns_are_judged_alike(spark, name):
    plain = OPERATORS[name](odd(spark))
    more = OPERATORS[name](odd(spark).withColumns({h: F.lit(0) for h in HELPERS}))
    assert sorted(map(repr, more.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_columns_named_like_helpers_as_parameters(spark):
    docs = odd(spark).withColumnsRenamed({"doc_id": "__g", "text": "__sha"})
    got = exact_dedup(docs, id_col="__g", text_col="__sha")
    want = exact_dedup(odd(spark))
    assert sorted(map(repr, ((r["__g"], r.keep_id, r.group_size, r.kept) for r in got.collect()))) == \
        sorted(map(repr, ((r.doc_id, r.keep_id, r.group_size, r.kept) for r in want.collect())))

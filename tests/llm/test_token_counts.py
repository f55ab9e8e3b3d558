import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from incidentmart.llm.bpe_count import count_tokens, counter, merge_count
from incidentmart.llm.queries import op8_token_counts

from cases import LONG, ODD, empty, odd

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" '’\n\t\r\x0b\x85　abcstelvd12é日本½Ⅷ🎉<|>endoftx"), st.characters(exclude_categories=["Cs", "Cn"])), max_size=60))
def test_any_text(text):
    assert counter(PATH).count(text) == library(text)


def test_special_and_long():
    for t in ["<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "<|endoftext", "a" * 5000, " " * 700 + "x", LONG, "\x1c\x1d x"]:
        assert counter(PATH).count(t) == library(t)


def test_lowest_rank_first():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2}
    assert merge_count(list("abc"), ranks) == 2 and merge_count(list("ab"), ranks) == 1 and merge_count([], ranks) == 0
    assert merge_count(list("aaa"), {("a", "a"): 0}) == 1


def test_rows(spark):
    got = count_tokens(odd(spark).selectExpr("*", "1 AS N_Tokens", "'x' AS over_limit"), PATH, columns=["doc_id", "source", "over_limit"]).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (len((t or "").encode()), library(t), library(t) > 1024) for _, t, *_ in ODD)
    assert count_tokens(empty(spark), PATH).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op8_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts) and all(r.n_tokens == library(texts[r.doc_id]) for r in got)

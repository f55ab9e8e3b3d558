from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from incidentmart.llm.piece_sampling import decode_pieces, encode_sampled, pieces
from incidentmart.llm.queries import op7_piece_sampling

from cases import LONG, ODD, empty, odd

PATH = public_tokenizers.path("piece_bpe_32k.model")
P = pieces(PATH, 1.0)


def sample(texts, seed=0):
    return P.sample(texts, np.arange(len(texts), dtype=np.uint64) + np.uint64(seed))


def paths(text):
    """Every segmentation of ``text`` with its probability, by brute force."""
    out = {}

    def walk(at, ids, weight):
        if at == len(text):
            out[tuple(ids)] = weight
        for end in range(at + 1, len(text) + 1):
            if hit := P.weight.get(text[at:end]):
                walk(end, [*ids, hit[0]], weight * hit[1])

    walk(0, [], 1.0)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def test_draws_follow_the_lattice():
    exp, n = paths(" there"), 20_000
    got = Counter(tuple(x.tolist()) for x in sample(["there"] * n))
    assert set(got) <= set(exp)
    likely = {k: p for k, p in exp.items() if n * p > 5}
    chi = sum((got[k] - n * p) ** 2 / (n * p) for k, p in likely.items())
    assert chi < 3 * len(likely) + 12


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁abcé日🎉"), st.characters(exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=4))
def test_lossless(texts):
    assert [P.decode(x) for x in sample(texts, 9)] == texts


def test_pieces_are_valid_for_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    text = "Hello there,  general text\nwith lines 日本 🎉"
    for ids in sample([text] * 20):
        assert sp.decode(ids.tolist()) == text


def test_long_texts():
    for t in (LONG, "x" * 4000, " " * 300, "日" * 500):
        assert P.decode(sample([t])[0]) == t


def test_independent_of_batches():
    texts = [f"the {k} there then" for k in range(50)]
    seeds = np.arange(50, dtype=np.uint64)
    whole = P.sample(texts, seeds)
    P._forget()
    parts = [P.sample([t], seeds[k:k + 1])[0] for k, t in reversed(list(enumerate(texts)))][::-1]
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_rows(spark):
    got = encode_sampled(odd(spark).selectExpr("*", "'x' AS Pieces"), PATH)
    assert got.columns[-1] == "pieces"
    back = decode_pieces(got.withColumnRenamed("text", "orig"), PATH).collect()
    assert len(back) == len(ODD) and all(r.text == r.orig for r in back)
    rows = [r.pieces for r in back if r.doc_id == 2]
    assert rows[0] == rows[1] and {r.pieces is None for r in back if r.orig is None} == {True}
    assert encode_sampled(empty(spark), PATH).count() == 0


def test_query(spark):
    got = op7_piece_sampling(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(r.lossless for r in got)
    again = op7_piece_sampling(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_what_is_kept_has_no_influence(monkeypatch):
    texts = [" ".join(f"w{(i * k) % 397} the{i % 7}" for i in range(60)) for k in range(1, 60)]
    seeds = np.arange(len(texts), dtype=np.uint64)
    P._forget()
    whole = P.sample(texts, seeds)
    for arcs, chunks in ((600, 100), (1, 1), (1 << 12, 1 << 8)):
        monkeypatch.setattr("incidentmart.llm.piece_sampling.ARCS", arcs)
        monkeypatch.setattr("incidentmart.llm.piece_sampling.CHUNKS", chunks)
        P._forget()
        for _ in range(2):
            parts = [P.sample([t], seeds[k:k + 1])[0] for k, t in enumerate(texts)]
            assert all((a == b).all() for a, b in zip(whole, parts))
        assert P.kept.n_arcs <= arcs and P.kept.n_chunks <= chunks
    monkeypatch.undo()
    P._forget()


def test_one_long_chunk_is_filtered_like_short_ones():
    for chunk in (" there", " ", "日本語テキスト", "xthenthereforeandunder🎉é", "a" * 40):
        many, one = P.arcs([chunk]), P.long_arcs(chunk)
        assert (many[0] == one[0]).all() and (many[2] == one[2]).all()
        assert np.abs(many[1].astype(np.int64) - one[1].astype(np.int64)).max() < 64


def test_unspaced_text_of_many_characters():
    text = "日本語テキスト" * 3_000 + "x" * 30_000
    assert P.decode(sample([text])[0]) == text

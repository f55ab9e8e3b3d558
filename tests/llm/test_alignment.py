import hashlib
import json

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import LONG, empty, odd
from incidentmart.llm.alignment import COUNTS, align_tokens, alignment_counts, linked_ids

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def libraries():
    left = Tokenizer.from_file(A)
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_table():
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(spare)}


def brute_force(texts):
    """Every token pair of every text compared, by the libraries themselves."""
    left, right = libraries()
    entry = {i: k for k, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}
    byte_of, out, having = byte_table(), [], {}
    for t in texts:
        a = left.encode(" " + t, add_special_tokens=False).ids if t else []
        b = right.encode(t) if t else []
        raw_a = [bytes(byte_of[c] for c in entry[i]) for i in a]
        raw_b = [bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(raw_a) != (" " + t).encode() or b"".join(raw_b) != (" " + t).encode():
            out.append(([], [], [], []))
            continue
        spans = []
        for ids, raw in ((a, raw_a), (b, raw_b)):
            at, own = 0, []
            for i, r in zip(ids, raw):
                own.append((at, at + len(r), i))
                at += len(r)
            spans.append(own)
        links = [(x, y) for x, (s, e, _) in enumerate(spans[0]) for y, (u, v, _) in enumerate(spans[1]) if s < v and u < e]
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, begin = [], 0
        for c in cuts:
            groups.append(tuple([i for s, e, i in own if begin <= s and e <= c] for own in spans))
            begin = c
        out.append((a, b, links, groups))
        for p in {(a[x], b[y]) for x, y in links}:
            having[p] = having.get(p, 0) + 1
    most = {}
    for (x, _), n in having.items():
        most[x] = max(most.get(x, 0), n)
    rows = []
    for a, b, links, groups in out:
        ids = [(a[x], b[y]) for x, y in links]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        rows.append((len(a), len(b), len(groups), len(links), sum(having[p] == most[p[0]] for p in ids), sum(having[p] for p in ids),
                     hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return rows, out, having, most


TEXTS = ["The quick brown fox isn't here.", "the the the", "naïve café – 日本語 🎉\n\n\ttabs  and   spaces ", "▁under▁", "<|endoftext|> <s> <0x41>", "", None,
         "a", " ", "\x00nul\x7f", "The quick brown fox isn't here.", "12345 67.89e-3 ### $$$ 'll", "'" * 40, "é \U0001F468‍\U0001F469 \u0085  x"]


def rows_of(spark, texts, name="text"):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"doc_id long, {name} string")


def test_counts_equal_brute_force(spark):
    texts = [*TEXTS, " ".join(f"word{i % 50} tail{i}" for i in range(120))]
    got = {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in alignment_counts(rows_of(spark, texts).repartition(3), A, B).collect()}
    want, _, _, _ = brute_force(texts)
    assert got == dict(enumerate(want))
    assert want[3] == (0, 0, 0, 0, 0, 0, "")        # U+2581 comes back as a space, so the text has no tokens


def test_blocks_do_not_change_the_counts(spark, monkeypatch):
    texts = TEXTS * 3
    whole = sorted(alignment_counts(rows_of(spark, texts).coalesce(1), A, B).collect())
    monkeypatch.setattr("incidentmart.llm.alignment.BLOCK_BYTES", 20)
    monkeypatch.setattr("incidentmart.llm.alignment.SLICE_BYTES", 10)
    assert sorted(alignment_counts(rows_of(spark, texts).repartition(5), A, B).collect()) == whole


def test_arrays_are_whole(spark):
    want, texts, _, _ = brute_force(TEXTS)
    for r in align_tokens(rows_of(spark, TEXTS), A, B).collect():
        a, b, links, groups = texts[r["doc_id"]]
        assert (r["left_ids"], r["right_ids"]) == (a, b)
        assert [tuple(x) for x in r["links"]] == sorted(links)
        got = [([], []) for _ in groups]
        for k, (ids, at) in enumerate(((r["left_ids"], r["left_group"]), (r["right_ids"], r["right_group"]))):
            for i, g in zip(ids, at):
                got[g][k].append(i)
        assert got == groups


def test_translation_table(spark):
    _, _, having, most = brute_force(TEXTS)
    got = {(r.left_id, r.right_id): (r.n_docs, r.best) for r in linked_ids(rows_of(spark, TEXTS), A, B).collect()}
    assert got == {p: (n, n == most[p[0]]) for p, n in having.items()}


def test_odd_rows_and_clashing_columns(spark):
    made = {"block": F.lit(7), "places": F.lit("p"), "whole_text": F.lit("w"), "pairs": F.lit(1), "of": F.lit(3), "at": F.lit(4), "n_a": F.lit("old"), "p": F.lit(9)}
    docs = odd(spark).withColumns(made)
    got = alignment_counts(docs, A, B)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "block", "places", "whole_text", "pairs", "of", "at", "p", *COUNTS]
    got = got.collect()
    assert len(got) == docs.count()
    assert {(r.block, r.places, r.whole_text, r.pairs, r.of, r["at"], r.p) for r in got} == {(7, "p", "w", 1, 3, 4, 9)}
    texts = [r.text for r in docs.collect() if r.text != LONG]
    plain = sorted(tuple(r[c] for c in COUNTS[:4]) for r in got)
    assert plain == sorted([w[:4] for w in brute_force(texts)[0]] + [next(tuple(r[c] for c in COUNTS[:4]) for r in got if r.doc_id == 8)])


def test_empty_table(spark):
    assert alignment_counts(empty(spark), A, B).count() == 0
    assert align_tokens(empty(spark), A, B).count() == 0


@pytest.mark.parametrize("text", ["a" * 200_000, " \n" * 50_000, "日本語" * 30_000])
def test_very_long_runs_equal_the_libraries(text):
    from incidentmart.llm.alignment import aligner

    x = aligner(A, B).align([text])
    left, right = libraries()
    assert x.a.ids.tolist() == left.encode(" " + text, add_special_tokens=False).ids
    assert x.b.ids.tolist() == right.encode(text)
    assert x.a.end[-1] == x.b.end[-1] == len(text.encode()) + 1

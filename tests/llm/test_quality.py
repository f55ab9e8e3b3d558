from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from incidentmart.llm.quality import bin_low, count_texts, quality_filter

from cases import LONG, ODD, empty, odd, words


def brute(text):
    w = words(text)
    t = text or ""
    wins = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if wins[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if words(x)]
    return [len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "é日", "\n", " ", "#", "a b a b a b", "\x0b", "\xa0"]), max_size=40).map(" ".join)), max_size=6))
def test_counts(texts):
    got = count_texts([None if t is None else t.encode() for t in texts])
    assert [list(map(int, x)) for x in zip(*got)] == [brute(t) for t in texts]


def test_bins_are_close(spark):
    for r in spark.range(0, 100000, 37).selectExpr("id", f"{bin_low('id')} AS low").collect():
        assert r.low <= r.id <= r.low + max(0, r.low // 32)


def test_rows(spark):
    got = quality_filter(odd(spark).selectExpr("*", "1 AS kept", "2 AS n_Words")).collect()
    assert sorted([r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] for r in got) == sorted(brute(t) for _, t, *_ in ODD)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert brute(LONG)[0] == 40_000
    assert quality_filter(empty(spark)).count() == 0


def test_adapts_to_the_group(spark):
    plain = [(i, " ".join(f"w{(i * 7 + k) % 91}" for k in range(60)), "en", "web") for i in range(200)]
    code = [(1000 + i, " ".join(f"a{(i * 3 + k) % 89} #{k}" for k in range(40)), "en", "code") for i in range(200)]
    junk = [(5000, " ".join(f"#$%{k}" for k in range(60)), "en", "web")]
    got = {r.doc_id: r.kept for r in quality_filter(spark.createDataFrame(plain + code + junk, "doc_id long, text string, lang string, source string")).collect()}
    assert got.pop(5000) is False and all(got.values())


def _group():
    return [(i, " ".join(f"w{(i * 7 + k) % 91}x" for k in range(60)), "en", "web") for i in range(200)]


OUTSIDE = {
    "word_length above": " ".join(f"{'long' * 9}{k}" for k in range(40)),
    "word_length below": " ".join("abcdefghijklmnopqrstuvwxyz"),
    "symbol_rate": " ".join(f"w{k}##" for k in range(60)),
    "line_rate": "\n".join(f"same\nw{k}a w{k}b w{k}c w{k}d w{k}e" for k in range(12)),
    "repeat_rate": " ".join([s := " ".join(f"r{k}x" for k in range(9)), *[f"w{k}y" for k in range(82)], s]),
}


def test_every_fence_can_reject(spark):
    rows = _group() + [(1000 + k, text, "en", "web") for k, text in enumerate(OUTSIDE.values())]
    got = {r.doc_id: r for r in quality_filter(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    for k, name in enumerate(OUTSIDE):
        r = got.pop(1000 + k)
        assert not r.base_failed and not r.kept, name
        rate = {"word_length": 100 * r.word_chars // r.n_words, "symbol_rate": 10000 * r.n_symbols // r.word_chars,
                "line_rate": 10000 * r.n_dup_lines // r.n_words, "repeat_rate": 10000 * r.n_repeat_words // r.n_words}
        crossed = [f"{x} above" for x in rate if rate[x] > r[f"max_{x}"]] + ["word_length below"] * (rate["word_length"] < r["min_word_length"])
        assert crossed == [name if " " in name else f"{name} above"]
    assert all(r.kept for r in got.values())


def test_one_row_is_inside_its_fences(spark):
    texts = [t for t in OUTSIDE.values()] + [" ".join([s := " ".join(f"r{k}" for k in range(10)), *[f"w{k}" for k in range(80)], s])]
    rows = [(k, t, "en", f"s{k}") for k, t in enumerate(texts)]
    assert all(r.kept for r in quality_filter(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect())

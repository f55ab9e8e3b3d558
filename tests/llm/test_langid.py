import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from incidentmart.llm import langid
from incidentmart.llm.langid import LanguageModel, fit_languages, grams, identify_language
from incidentmart.llm.queries import op1_language_id

from cases import empty, odd


def symbols(text):
    out, gap = [], True
    for c in text:
        if c.isalpha():
            out.append(c.lower())
            gap = False
        elif not gap:
            out.append(" ")
            gap = True
    return out if gap else [*out, " "]


def slow_model(texts, vocabulary):
    """Interpolated Kneser-Ney of order 4, straight from the definition."""
    tops = Counter()
    for t in texts:
        s = [" "] * 3 + symbols(t)
        tops.update(tuple(s[i - 3:i + 1]) for i in range(3, len(s)))
    levels = [tops]
    for _ in range(3):
        levels.insert(0, Counter(g[1:] for g in levels[0]))

    def prob(g):
        n = levels[len(g) - 1]
        ones, twos = (sum(c == k for c in n.values()) for k in (1, 2))
        cut = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        heads = {k: c for k, c in n.items() if k[:-1] == g[:-1]}
        low = prob(g[1:]) if len(g) > 1 else 1.0 / vocabulary
        if not heads:
            return low
        return max(n.get(g, 0) - cut, 0) / sum(heads.values()) + cut * len(heads) / sum(heads.values()) * low

    return prob


def test_model_is_kneser_ney():
    data = {"x": ["the cat sat", "the hat! a cat"], "y": ["der hut", "die katze sass da"]}
    counts = {k: np.unique(grams(v)[0], return_counts=True) for k, v in data.items()}
    model = LanguageModel.train(counts)
    size = len(set(" ".join(sum(data.values(), [])).replace("!", " "))) + 1
    for i, (lang, texts) in enumerate(sorted(data.items())):
        slow = slow_model(texts, size)
        for text in ["the cat", "das hat", "zzz qq", "a", "katze, hut"]:
            s = [" "] * 3 + symbols(text)
            exp = -sum(math.log(slow(tuple(s[k - 3:k + 1]))) for k in range(3, len(s))) / (len(s) - 3)
            assert model.entropies([text])[0][0, i] == pytest.approx(exp, rel=1e-4)


def test_grams_do_not_cross_texts():
    together, alone = grams(["ab c", "", "!!", "d", "xyz"]), [grams([t]) for t in ["ab c", "", "!!", "d", "xyz"]]
    assert (together[0] == np.concatenate([a[0] for a in alone])).all()
    assert list(together[1]) == [int(a[1][0]) for a in alone] == [5, 0, 0, 2, 4]


def test_held_out_accuracy(spark):
    rows = op1_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.99
    assert np.mean([r.rejected for r in rows]) < 0.005 and all(0 <= r.score <= 1 for r in rows)


def test_rejects_foreign_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit_languages(docs)
    noise = "qxz vkj wqx zzx jjq xkcd qqv wvx " * 20
    got = identify_language(spark.createDataFrame([(1, noise), (2, "Ελληνικά κείμενα για δοκιμή " * 10)], "doc_id long, text string"), model).collect()
    assert all(r.rejected for r in got)


def test_odd_rows(spark):
    docs = odd(spark).selectExpr("*", "1 AS Score", "2 AS lang_pred")
    model = fit_languages(docs.filter("lang IS NOT NULL"))
    got = identify_language(docs, model).collect()
    assert len(got) == 11
    for r in got:
        none = r.text is None or not any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == none and (not none or (r.rejected and r.score == 0))
    again = identify_language(docs, model).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))


def test_nothing_to_learn(spark):
    model = fit_languages(empty(spark))
    assert model.langs == [] and identify_language(empty(spark), model).count() == 0
    assert {(r.lang_pred, r.rejected) for r in identify_language(odd(spark), model).collect()} == {("und", True)}


def test_every_gram_counts(spark):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcdefghijklmnopqrst "), 30_000)) for _ in range(40)] + ["wuvy zyx"]    # 1.2 million symbols, the last grams once
    model = fit_languages(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3))
    whole = LanguageModel.train({"x": np.unique(grams(texts)[0], return_counts=True)})
    assert [len(g) for t in model.tables for g in t.grams] == [len(g) for t in whole.tables for g in t.grams]
    assert np.array_equal(model.entropies(texts[-2:])[0], whole.entropies(texts[-2:])[0])


def test_limits_from_every_row(spark):
    rare = "(pmod(xxhash64(cast(id AS string)), 1000000) > 900000 AND id < 200)"
    docs = spark.range(60_000).selectExpr("id AS doc_id", f"CASE WHEN {rare} THEN 'z' ELSE 'x' END AS lang",
                                          f"CASE WHEN {rare} THEN concat('ωδη ρκ ', id) ELSE concat('some words ', translate(cast(id % 977 AS string), '0123456789', 'abcdefghij')) END AS text")
    marks = spark.createDataFrame([(-1, "m", "\u0301\u0302 \u0301")], "doc_id long, lang string, text string")        # grams, but no letter
    docs = docs.unionByName(marks)
    model = fit_languages(docs)
    assert model.langs == ["m", "x", "z"] and np.isfinite(model.limits).all()
    rows, pool = docs.collect(), []
    for i, lang in list(enumerate(model.langs))[1:]:
        h, n, _ = model.entropies([r.text for r in rows if r.lang == lang])
        excess = np.sort(h[:, i] - 4 / np.sqrt(n))
        pool.extend(excess)
        assert 0 <= model.limits[i] - excess[math.ceil(0.999 * len(excess)) - 1] < 1 / 1024
    assert 0 <= model.limits[0] - sorted(pool)[math.ceil(0.999 * len(pool)) - 1] < 1 / 1024
    noise = spark.createDataFrame([(1, "ηηηη ωωωω κκκκ ρρρρ " * 20)], "doc_id long, text string")
    assert [(r.lang_pred, r.rejected) for r in identify_language(noise, model).collect()] == [("z", True)]


def test_many_languages_and_a_label_without_letters(spark, monkeypatch):
    rows = [(100 * k + i, " ".join("".join(chr(0x4E00 + 7 * k + int(x)) for x in np.random.default_rng(100 * k + i).integers(0, 7, 6)) for _ in range(20)), f"l{k:02d}")
            for k in range(70) for i in range(3)] + [(-1, None, "none"), (-2, "12 !", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_languages(docs)
    assert len(model.tables) > 1 and model.langs == [f"l{k:02d}" for k in range(70)]
    assert all(r.lang_pred == (r.lang if r.lang != "none" else "und") for r in identify_language(docs, model).collect())
    monkeypatch.setattr(langid, "COLUMNS", 1000)
    one = LanguageModel.train({x: np.unique(grams([t for _, t, lang in rows if lang == x])[0], return_counts=True) for x in model.langs})
    assert len(one.tables) == 1
    np.testing.assert_allclose(model.entropies([t or "" for _, t, _ in rows])[0], one.entropies([t or "" for _, t, _ in rows])[0], rtol=1e-5)


def test_tables_are_bounded():
    sizes = {f"l{k:03d}": 1 << 21 for k in range(20)} | {"m": 1 << 26}
    dealt = list(langid.packed(sizes))
    assert sum(dealt, []) == sorted(sizes) and dealt[-1] == ["m"]
    assert all(len(d) == 1 or (len(d) <= langid.COLUMNS and sum(sizes[x] for x in d) * len(d) <= langid.CELLS) for d in dealt)

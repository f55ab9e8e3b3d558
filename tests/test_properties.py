"""Property tests: exact rounding and text cleaning against plain Python."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from incidentmart.functions import clean_text, exact_ratio

TOKENS = {"", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
          "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"}


def py_round(a, b, scale, mult):
    if b == 0:
        return None
    q = Decimal(a * mult) / Decimal(b)
    return q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


def py_clean(v):
    if v is None or v in TOKENS:
        return "Sin especificar"
    s = v.strip()
    return s or "Sin especificar"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(0, 10**7)),
                min_size=1, max_size=300))
def test_exact_ratio_matches_decimal_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    for scale, mult in ((4, 1), (2, 100)):
        got = [r[0] for r in df.select(exact_ratio("a", "b", scale, mult)).collect()]
        want = [py_round(a, b, scale, mult) for a, b in pairs]
        assert [None if g is None else Decimal(g) for g in got] == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from(sorted(TOKENS)),
                          st.text(alphabet=" \tab\xa0\u2003\u3000\x1fNAxy", max_size=6)),
                min_size=1, max_size=200))
def test_clean_text_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(clean_text("v")).collect()]
    assert got == [py_clean(v) for v in values]

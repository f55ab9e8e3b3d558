"""Quality rules with thresholds that adapt to each language and source.

Rule inputs are integers per document.  For every (language, source) group each
input is summarised by a mergeable quantile sketch: counts on a fixed scale of
bins (exact below 64, then 32 bins per power of two, so a quantile is within
1/32 of its value).  Counts add up, so partial sketches merge in any order and
reruns agree.  A group's fences come from its own quantiles; every document is
joined with the fences of its group and judged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import own_names, stage, without
from .words import U, Words, mix, slices, small

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
OUT = [*COUNTS, "base_failed", "kept"]
# Rule inputs in parts of 10,000 (word length: hundredths of a character).
INPUTS = {
    "word_length": "100 * word_chars div greatest(n_words, 1)",
    "symbol_rate": "10000 * n_symbols div greatest(word_chars, 1)",
    "line_rate": "10000 * n_dup_lines div greatest(n_words, 1)",
    "repeat_rate": "10000 * n_repeat_words div greatest(n_words, 1)",
}
# A fence stands REACH times the spread (median to the 10 % or 90 % quantile)
# from the median; a spread counts as at least SLACK, so that a group whose
# documents are all alike does not reject the first that differs.
REACH = 8
SLACK = {"word_length": 50, "symbol_rate": 50, "line_rate": 50, "repeat_rate": 250}
UPPER = list(INPUTS)
LOWER = ["word_length"]
# Where the values end that a document which passes the base rules can have:
# no word is shorter than one character, and the base rules end the repeat rate
# at 20 %.  A fence stands at most three quarters of the way from the median to
# the end, so that every fence can be crossed whatever the spread.
END = {"word_length": 1 << 40, "symbol_rate": 10_000, "line_rate": 10_000, "repeat_rate": 2_000}
START = 100

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
WIDTH = 5


def repeated_words(w: Words) -> np.ndarray:
    """Per text: words inside a window of five words that the text holds twice or more."""
    starts, h = w.windows(WIDTH)
    if not len(starts):
        return np.zeros(len(w.texts), np.int64)
    owner = w.owner()
    key = h ^ mix(owner[starts].astype(U) + U(1))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(w.hashes) + 1, np.int64)
    np.add.at(edge, starts[twice], 1)
    np.add.at(edge, starts[twice] + WIDTH, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(w.texts))


def _lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def count_texts(texts: list[bytes | None]) -> list[np.ndarray]:
    """The five counts of each text, in the order of ``COUNTS``."""
    parts = [[np.zeros(0, np.int64)] for _ in COUNTS]
    for i, j in slices(texts):
        w = Words(texts[i:j])
        letters = ((w.bytes & 0xC0) != 0x80) & ~_SPACE[w.bytes]
        lines = np.fromiter(map(_lines, w.texts), np.int64, len(w.texts))
        for part, values in zip(parts, (w.counts(), w.per_text(letters), w.per_text(_SYMBOL[w.bytes]), lines, repeated_words(w))):
            part.append(values)
    return [np.concatenate(p).astype(np.int64) for p in parts]


@own_names
def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus the five counts; null text counts as empty."""
    keep = without(docs, [text_col, *OUT])
    kept = keep.columns
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("binary").alias("__text"))
    schema = T.StructType([*keep.schema.fields, *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            made = count_texts(b.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *map(pa.array, made)], names=[*kept, *COUNTS])

    return rows.mapInArrow(run, schema)


def bin_low(v: str) -> str:
    """SQL: the smallest value of the bin that ``v`` falls in (itself below 64)."""
    return f"CASE WHEN {v} < 64 THEN {v} ELSE shiftleft(shiftright({v}, length(bin({v})) - 6), length(bin({v})) - 6) END"


def sketch(measured: DataFrame, group: list[str]) -> DataFrame:
    """Mergeable sketch: (group, input, bin, n) over the documents that pass the base rules."""
    values = F.array(*[F.struct(F.lit(k).alias("rule"), F.expr(v).alias("v")) for k, v in INPUTS.items()])
    long = measured.filter("NOT base_failed").select(*group, F.explode(values).alias("x")).select(*group, "x.rule", "x.v")
    return long.groupBy(*group, "rule", F.expr(bin_low("v")).alias("low")).agg(F.count(F.lit(1)).alias("n"))


def fences(sketches: DataFrame, group: list[str]) -> DataFrame:
    """One row per group: the lower and upper fence of every rule.

    The windows run over the bins of one group and rule: at most a few hundred
    rows each, whatever the number of documents.
    """
    by = ", ".join([*[f"`{g}`" for g in group], "rule"])
    sums = sketches.selectExpr("*", f"sum(n) OVER (PARTITION BY {by} ORDER BY low) AS upto", f"sum(n) OVER (PARTITION BY {by}) AS total")

    def quantile(percent: int) -> Column:
        return F.min(F.when(100 * F.col("upto") >= percent * F.col("total"), F.col("low")))

    q = sums.groupBy(*group, "rule").agg(quantile(10).alias("q10"), quantile(50).alias("q50"), quantile(90).alias("q90"))
    slack = F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv])[F.col("rule")]
    end = F.create_map(*[F.lit(x) for kv in END.items() for x in kv])[F.col("rule")]
    below = F.least(REACH * F.greatest(F.col("q50") - F.col("q10"), slack), F.expr(f"3 * (q50 - {START}) div 4"))
    above = F.least(REACH * F.greatest(F.col("q90") - F.col("q50"), slack), F.floor(3 * (end - F.col("q50")) / 4))
    # a value may lie up to 1/32 above the start of its bin
    q = q.withColumns({"lower": F.col("q50") - below, "upper": F.col("q50") + F.greatest(above, F.expr("q50 div 32"))})
    of = lambda c, rule: F.max(F.when(F.col("rule") == rule, F.col(c))).cast("long")
    return q.groupBy(*group).agg(*[of("lower", r).alias(f"min_{r}") for r in LOWER], *[of("upper", r).alias(f"max_{r}") for r in UPPER])


@own_names
def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` (without its text) plus the counts, ``base_failed, kept`` and the fences of its group.

    ``base_failed``: fewer than 10 words, or more than 20 % of the words repeat
    in five-word windows.  ``kept``: not ``base_failed`` and inside every fence
    of its (language, source) group.

    * A null language or source is a group of its own; null text counts as empty.
    * One row alone is its own median and inside its fences; the spread has a
      floor, so that a few rows that are alike do not reject the next.
    * An empty table gives an empty result; an input column named like an
      output column is replaced, any other comes back as it was.
    """
    base = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    names = [f"min_{r}" for r in LOWER] + [f"max_{r}" for r in UPPER]
    measured = stage(measure(without(docs, names), text_col).withColumn("base_failed", base), "quality-rows")
    group = [lang_col, source_col]
    limits = stage(fences(sketch(measured, group), group).withColumnsRenamed({lang_col: "__lang", source_col: "__source"}), "quality-fences")
    judged = measured.join(limits, measured[lang_col].eqNullSafe(limits["__lang"]) & measured[source_col].eqNullSafe(limits["__source"]), "left")
    inside = F.lit(True)
    for r in LOWER:
        inside = inside & (F.expr(INPUTS[r]) >= F.col(f"min_{r}"))
    for r in UPPER:
        inside = inside & (F.expr(INPUTS[r]) <= F.col(f"max_{r}"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True))).drop("__lang", "__source")

"""Language identification with character language models.

Per language an interpolated Kneser-Ney model over four-character grams is
counted by Spark from the labelled rows.  Grams are 48-bit hashes (12 bits per
folded character) kept in sorted arrays with the probabilities of up to 16 languages
beside them, so one binary search serves them all.  A text gets the
language with the lowest cross-entropy per symbol; a text that even its best
language explains badly is rejected, by a limit calibrated per language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import own_names, stage, without
from .words import U, mix, small

ORDER = 4
BITS = 12
CHARS = 1 << 19                  # characters worked on at once
PENDING = 1 << 19                # grams a counting task holds before it hands them on
# Languages beside one another in a table: so many, and so many cells of its
# longest order; a language alone may have more.  Further languages take further tables.
COLUMNS = 16
CELLS = 1 << 24
UNKNOWN = "und"
OUT = ["lang_pred", "score", "cross_entropy", "n_symbols", "rejected"]
# Rejection: cross-entropy above the calibrated limit plus SPREAD / sqrt(symbols)
# plus MARGIN nats; the limit is the quantile of REACH thousandths over the
# language's labelled rows, counted in bins of 1 / FINE nats so that partial
# counts merge in any order.
REACH, MARGIN, SPREAD, FINE = 999, 0.3, 4.0, 1024

_TABLES: list[np.ndarray] = []


def _mask(order: int) -> np.ndarray:
    return U((1 << (BITS * order)) - 1)


def fold_tables() -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each code point (0: no letter or mark), and whether it is a letter.

    Letters are lower-cased; code points below 4,096 stand for themselves, the
    others are hashed into the same 12 bits.
    """
    if not _TABLES:
        symbol, letter = np.zeros(0x110000, np.uint16), np.zeros(0x110000, bool)
        every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
        marked = regex.findall(r"[\p{L}\p{M}]", every)
        low = np.array([ord(c.lower()[0]) for c in marked])
        symbol[[ord(c) for c in marked]] = np.where(low < 4096, low, 1 + (mix(low.astype(U)) % U(4095)).astype(np.int64))
        for m in regex.finditer(r"\p{L}+", every):
            letter[[ord(c) for c in m[0]]] = True
        _TABLES.extend([symbol, letter])
    return _TABLES[0], _TABLES[1]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed grams of all symbols of ``texts`` in order, symbols per text, letters per text.

    A text's symbols are its letters, with one boundary symbol for each run of
    other characters and one at the end; the context before the start is
    boundaries.  Null or letterless texts have none.
    """
    symbol, letter = fold_tables()
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    s = symbol[points]
    kept = np.flatnonzero((s != 0) | np.concatenate(([False], s[:-1] != 0)))
    upto = np.searchsorted(kept, ends)
    n = np.diff(np.concatenate(([0], upto)))
    starts = (upto - n)[n > 0]
    a = s[kept].astype(U)
    key = a.copy()
    for back in range(1, ORDER):
        b = np.zeros_like(a)
        b[back:] = a[:-back]
        for i in range(back):
            at = starts + i
            b[at[at < len(b)]] = 0
        key |= b << U(BITS * back)
    letters = np.add.reduceat(letter[points].astype(np.int64), np.concatenate(([0], ends[:-1]))) if texts else np.zeros(0, np.int64)
    return key, n, letters


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHARS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def count_grams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) over the rows with a language; each task merges its counts before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, n = _merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n)],
                                                 names=["lang", "gram", "n"])
            held.clear()

        for b in small(batches):
            by: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(lang, []).append(text or "")
            for lang, texts in by.items():
                for i, j in _chunks(texts):
                    got = np.unique(grams(texts[i:j])[0], return_counts=True)
                    held.setdefault(lang, []).append(got)
                    size += len(got[0])
            if size > PENDING:
                for lang, parts in held.items():
                    held[lang] = [_merged(parts)]
                size = sum(len(p[0][0]) for p in held.values())
                if size > PENDING // 2:
                    yield from flush()
                    size = 0
        yield from flush()

    rows = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    part = rows.mapInArrow(run, "lang string, gram long, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


@dataclass
class LanguageTable:
    """Some languages: sorted gram hashes per order with log probabilities of every language, and log back-off weights per context."""

    langs: list[str]
    grams: list[np.ndarray] = field(default_factory=list)       # by order - 1
    logs: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    backoffs: list[np.ndarray] = field(default_factory=list)
    floor: np.ndarray | None = None                             # log probability of an unseen symbol

    @staticmethod
    def train(counts: dict[str, tuple[np.ndarray, np.ndarray]], symbols: int) -> LanguageTable:
        """Interpolated Kneser-Ney from the sorted top-order grams and counts of each language."""
        langs = sorted(counts)
        model = LanguageTable(langs)
        levels = []         # per order from 1: per language (keys, counts); lower orders count distinct left neighbours
        for lang in langs:
            keys, n = counts[lang]
            per = [(keys, n.astype(np.float64))]
            for order in range(ORDER - 1, 0, -1):
                k, c = np.unique(per[0][0] & _mask(order), return_counts=True)
                per.insert(0, (k, c.astype(np.float64)))
            levels.append(per)
        lower = None
        for order in range(1, ORDER + 1):
            table = np.unique(np.concatenate([p[order - 1][0] for p in levels]))
            context = np.unique(table >> U(BITS)) if order > 1 else np.zeros(1, U)
            of = np.searchsorted(context, table >> U(BITS)) if order > 1 else np.zeros(len(table), np.int64)
            prob, back = np.zeros((len(table), len(langs))), np.ones((len(context), len(langs)))
            for i, per in enumerate(levels):
                keys, n = per[order - 1]
                ones, twos = (n == 1).sum(), (n == 2).sum()
                cut = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
                at = np.searchsorted(table, keys)
                total = np.bincount(of[at], n, len(context))
                kinds = np.bincount(of[at], minlength=len(context))
                seen = total > 0
                back[seen, i] = cut * kinds[seen] / total[seen]
                prob[at, i] = np.maximum(n - cut, 0) / total[of[at]]
            below = np.full((len(table), len(langs)), 1.0 / symbols) if order == 1 else lower[np.searchsorted(model.grams[-1], table & _mask(order - 1))]
            prob += back[of] * below
            if order == 1:
                model.floor = np.log(back[0] / symbols).astype(np.float32)
            lower = prob
            model.grams.append(table)
            model.logs.append(np.log(prob).astype(np.float32))
            model.contexts.append(context)
            model.backoffs.append(np.log(back).astype(np.float32))
        return model

    def log_prob(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Natural log of the probability of each gram's last symbol after the others, per language."""
        at, hit = _find(self.grams[order - 1], keys)
        out = self.logs[order - 1][at]
        if not hit.all():
            miss = np.flatnonzero(~hit)
            k = keys[miss]
            if order == 1:
                out[miss] = self.floor
            else:
                rest = self.log_prob(k & _mask(order - 1), order - 1)
                c, known = _find(self.contexts[order - 1], k >> U(BITS))
                rest[known] += self.backoffs[order - 1][c[known]]
                out[miss] = rest
        return out


def packed(sizes: dict[str, int]) -> Iterator[list[str]]:
    """Languages, with the number of their grams, dealt in order into tables of bounded size."""
    held, grams_held = [], 0
    for lang in sorted(sizes):
        if held and (len(held) == COLUMNS or (grams_held + sizes[lang]) * (len(held) + 1) > CELLS):
            yield held
            held, grams_held = [], 0
        held.append(lang)
        grams_held += sizes[lang]
    if held:
        yield held


@dataclass
class LanguageModel:
    """Tables of all languages, in the order of ``langs``, and a rejection limit per language."""

    langs: list[str]
    tables: list[LanguageTable] = field(default_factory=list)
    limits: np.ndarray | None = None

    @staticmethod
    def train(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> LanguageModel:
        """Model of the sorted top-order grams and counts of each language, without limits."""
        symbols = len(np.unique(np.concatenate([k & _mask(1) for k, _ in counts.values()]))) + 1 if counts else 1
        return LanguageModel.of(LanguageTable.train({x: counts[x] for x in some}, symbols) for some in packed({x: len(k) for x, (k, _) in counts.items()}))

    @staticmethod
    def of(tables: Iterable[LanguageTable]) -> LanguageModel:
        tables = list(tables)
        langs = [x for t in tables for x in t.langs]
        return LanguageModel(langs, tables, np.full(len(langs), np.inf))

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per symbol of each text under each language, symbols and letters per text."""
        h, n, letters = [np.zeros((0, len(self.langs)))], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in _chunks(texts):
            keys, size, alpha = grams(texts[i:j])
            sums = np.zeros((j - i, len(self.langs)))
            if len(keys):
                heads = np.concatenate(([0], np.cumsum(size)))[:-1][size > 0]
                sums[size > 0] = np.concatenate([np.add.reduceat(t.log_prob(keys), heads, axis=0, dtype=np.float64) for t in self.tables], axis=1)
            h.append(-sums / np.maximum(size, 1)[:, None])
            n.append(size)
            letters.append(alpha)
        return np.concatenate(h), np.concatenate(n), np.concatenate(letters)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy, symbols and rejection of each text."""
        plain = [t or "" for t in texts]
        if not self.langs or not plain:
            z = np.zeros(len(plain))
            return [UNKNOWN] * len(plain), z, z, z.astype(np.int64), np.ones(len(plain), bool)
        h, n, letters = self.entropies(plain)
        best = np.argmin(h, axis=1)
        low = h[np.arange(len(best)), best]
        score = 1.0 / np.exp(np.minimum(n, 50)[:, None] * (low[:, None] - h)).sum(axis=1)
        none = letters == 0
        rejected = none | (low > self.limits[best] + MARGIN + SPREAD / np.sqrt(np.maximum(n, 1)))
        return ([UNKNOWN if x else self.langs[b] for b, x in zip(best, none)], np.where(none, 0.0, score),
                np.where(none, 0.0, low), n, rejected)


def fit_languages(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Train on every row of ``labelled`` that has a language.

    Counts cover all these rows and every gram of them is stored, so the model
    grows with the distinct grams; the driver fetches one table of languages at a time.
    The rejection limits are quantiles over all of a language's rows with a
    letter; a language without such a row gets the limit of all languages
    together (0 if none has one).  A language whose texts have no gram is not
    learned.  No labelled row gives a model without languages.
    """
    spark = labelled.sparkSession
    counts = stage(count_grams(labelled, text_col, lang_col).sortWithinPartitions("lang", "gram"), "lang-grams")
    sizes = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return LanguageModel([])
    symbols = counts.select(F.col("gram").bitwiseAND(F.lit((1 << BITS) - 1))).distinct().count() + 1

    def learn(some: list[str]) -> LanguageTable:
        got = counts.filter(F.col("lang").isin(some)).select("lang", "gram", "n").toArrow()
        per = {}
        for x in some:
            own = got.filter(pc.equal(got.column("lang"), x))
            gram, n = (np.asarray(own.column(c)) for c in ("gram", "n"))
            order = np.argsort(gram)
            per[x] = (gram[order].astype(U), n[order])
        return LanguageTable.train(per, symbols)

    model = LanguageModel.of(map(learn, packed(sizes)))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        place = {x: i for i, x in enumerate(m.langs)}
        for b in small(batches):
            known = [(place[x], t or "") for x, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if x in place]
            own = np.array([x for x, _ in known], np.int64)
            h, size, letters = m.entropies([t for _, t in known])
            excess = h[np.arange(len(own)), own] - SPREAD / np.sqrt(np.maximum(size, 1))
            ok = letters > 0
            bins = np.ceil(excess[ok] * FINE).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own[ok]), pa.array(bins)], names=["place", "bin"])

    rows = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    bins = stage(rows.mapInArrow(run, "place long, bin long").groupBy("place", "bin").agg(F.count(F.lit(1)).alias("n")), "lang-limits")
    # the windows run over the bins, some thousand a language, whatever the number of rows
    pooled = bins.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit(-1).cast("long").alias("place"), "bin", "n")
    sums = bins.unionByName(pooled).selectExpr("*", "sum(n) OVER (PARTITION BY place ORDER BY bin) AS upto", "sum(n) OVER (PARTITION BY place) AS total")
    found = {r["place"]: r["q"] / FINE for r in sums.filter(f"1000 * upto >= {REACH} * total").groupBy("place").agg(F.min("bin").alias("q")).collect()}
    model.limits = np.array([found.get(i, found.get(-1, 0.0)) for i in range(len(model.langs))])
    return model


@own_names
def identify_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default all) plus ``lang_pred, score, cross_entropy, n_symbols, rejected``.

    Only the text is read for a prediction, and all of it.  ``lang_pred`` is a
    learned language; a text that is null or has no letter gets ``und``, score 0
    and is rejected.  Ties go to the first language by code point.  ``score`` is
    the posterior of the language over at most 50 symbols' worth of evidence.
    An empty table gives an empty result; an input column named like an output
    column is replaced, unless it is the text; any other comes back as it was.
    """
    clash = [c for c in OUT if c.lower() != text_col.lower()]
    keep = without(docs.select(*[F.col(f"`{c}`") for c in columns]) if columns is not None else docs, clash)
    kept = keep.columns
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("__text"))
    schema = T.StructType([*keep.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("cross_entropy", T.DoubleType()), T.StructField("n_symbols", T.LongType()), T.StructField("rejected", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in small(batches):
            lang, score, h, n, rejected = m.predict(b.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(h, pa.float64()),
                                              pa.array(n, pa.int64()), pa.array(rejected, pa.bool_())], names=[*kept, *OUT])

    return rows.mapInArrow(run, schema)

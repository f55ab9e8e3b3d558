"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both tokenizers cut the same bytes, a space and then the text.  Per batch,
``pandas.merge_asof`` keyed by document finds for the start of each token the
token of the other side that covers it.  The union of both directions is the set
of all overlapping pairs: of two tokens that overlap, the one that starts later
(or at the same byte) starts inside the other.  Where tokens of both sides end at
the same byte, the text is cut into groups that cover the same bytes.

Corpus statistics of the pairs need a second look at every document.  Documents
are therefore kept in blocks of a fixed number of text bytes: a block has a list
of its distinct pairs, and each of its documents refers to places in that list.
Only the lists meet in the shuffle, so a pair costs one row per block and not one
per document, and the counts go back to the blocks the same way.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe_count import PRETOKEN, _byte_symbols
from .common import fresh, stage, without
from .words import slices, small

SLICE_BYTES = 1 << 19           # of text that is aligned at once
BLOCK_BYTES = 1 << 21           # of text in a block; a longer text is a block of its own
COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ALIGNED = ["left_ids", "right_ids", "left_group", "right_group", "links"]


class ByteLevel:
    """A byte-level BPE vocabulary in JSON form; strings of special tokens are plain text.

    The merges of such a file stand in the order of the ids, so the rank of a
    byte sequence is its id.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(_byte_symbols())}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte_of.__getitem__, k)): i for k, i in spec["model"]["vocab"].items() if k not in special}
        self.raw = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.raw[i] = b
        self.model = tiktoken.Encoding("left", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.model.encode_to_numpy(" " + t, allowed_special=set(), disallowed_special=()).astype(np.int64) for t in texts]


class PieceModel:
    """A SentencePiece model, which puts the space in front itself; byte pieces stand for one byte."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.raw = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.raw.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode("utf-8"))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


_LOADED: dict[str, ByteLevel | PieceModel] = {}


def vocabulary(path: str) -> ByteLevel | PieceModel:
    """The tokenizer of this worker for a vocabulary file; read once per worker."""
    if path not in _LOADED:
        _LOADED[path] = (PieceModel if path.endswith(".model") else ByteLevel)(path)
    return _LOADED[path]


def _decimal(n: int, end: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The numbers below ``n`` as decimal bytes with ``end`` behind, padded with zero bytes, and their lengths."""
    text = [b"%d%s" % (i, end) for i in range(n)]
    width = max(map(len, text), default=1)
    return np.array(text, f"S{width}").view(np.uint8).reshape(n, width), np.fromiter(map(len, text), np.int64, n)


class Aligner:
    """Both vocabularies and what is looked up per token."""

    def __init__(self, left: str, right: str):
        self.sides = vocabulary(left), vocabulary(right)
        self.sizes = tuple(len(s.raw) for s in self.sides)
        self.lengths = tuple(np.fromiter(map(len, s.raw), np.int64, len(s.raw)) for s in self.sides)
        tables = [_decimal(n, end) for n, ends in zip(self.sizes, ((b",", b"|"), (b",", b";"))) for end in ends]
        width = max(t.shape[1] for t, _ in tables)
        self.digits = np.concatenate([np.pad(t, ((0, 0), (0, width - t.shape[1]))) for t, _ in tables])
        self.digit_len = np.concatenate([n for _, n in tables])

    def align(self, texts: list[str | None]) -> Aligned:
        """The alignment of some texts.

        A text without tokens: null, empty, or one whose token bytes on either
        side are not the space and the text.
        """
        live = [i for i, t in enumerate(texts) if t]
        ids = [side.encode([texts[i] for i in live]) for side in self.sides]
        good = [k for k, i in enumerate(live) if all(
            b"".join(map(side.raw.__getitem__, x[k].tolist())) == b" " + texts[i].encode("utf-8") for side, x in zip(self.sides, ids))]
        docs = np.array([live[k] for k in good], np.int64)
        out = []
        for x, lengths in zip(ids, self.lengths):
            own = [x[k] for k in good]
            flat = np.concatenate([np.zeros(0, np.int64), *own])
            ends = np.cumsum(lengths[flat])
            out.append(Side(flat, np.repeat(docs, list(map(len, own))), ends - lengths[flat], ends))
        a, b = out
        left = pd.DataFrame({"at": a.start, "doc": a.doc, "a": np.arange(len(a.ids))})
        right = pd.DataFrame({"at": b.start, "doc": b.doc, "b": np.arange(len(b.ids))})
        over = pd.merge_asof(left, right, on="at", by="doc")                    # the right token over each left start
        under = pd.merge_asof(right, left, on="at", by="doc")                   # the left token over each right start
        new = a.start[under["a"].to_numpy(np.int64)] != b.start if len(b.ids) else np.zeros(0, bool)
        links = np.concatenate((left["a"].to_numpy(), under["a"].to_numpy(np.int64)[new])), np.concatenate(
            (over["b"].to_numpy(np.int64), right["b"].to_numpy()[new]))
        cut_a, cut_b = np.isin(a.end, b.end, assume_unique=True), np.isin(b.end, a.end, assume_unique=True)
        groups = [np.cumsum(cut) - cut for cut in (cut_a, cut_b)]
        return Aligned(len(texts), a, b, links, cut_a, cut_b, *groups)

    def written(self, x: Aligned) -> list[str]:
        """SHA-256 of each text's groups as ``a1,a2|b1;a3|b2,b3``; '' for a text without tokens."""
        a, b, n = x.a, x.b, len(x.a.ids) + len(x.b.ids)
        place_a = np.arange(len(a.ids)) + np.searchsorted(x.group_b, x.group_a, "left")
        place_b = np.arange(len(b.ids)) + np.searchsorted(x.group_a, x.group_b, "right")
        row, doc = np.empty(n, np.int64), np.empty(n, np.int64)
        row[place_a] = a.ids + np.where(x.cut_a, self.sizes[0], 0)
        row[place_b] = b.ids + np.where(x.cut_b, self.sizes[1], 0) + 2 * self.sizes[0]
        doc[place_a], doc[place_b] = a.doc, b.doc
        padded = self.digits[row].ravel()
        text = padded[padded != 0].tobytes()
        size = np.bincount(doc, self.digit_len[row], x.texts).astype(np.int64) if n else np.zeros(x.texts, np.int64)
        ends = np.cumsum(size)
        return [hashlib.sha256(text[e - s:e - 1]).hexdigest() if s else "" for s, e in zip(size.tolist(), ends.tolist())]


@dataclass
class Side:
    """The tokens of one tokenizer in a slice of texts: ids, index of the text, first byte and end over all texts."""

    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


@dataclass
class Aligned:
    """``links``: all overlapping pairs as places in both sides; ``cut_*``: tokens whose end the other side shares."""

    texts: int
    a: Side
    b: Side
    links: tuple[np.ndarray, np.ndarray]
    cut_a: np.ndarray
    cut_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray

    def per_text(self, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, minlength=self.texts).astype(np.int64)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values, kind))


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(left: str, right: str) -> Aligner:
    """The aligner of this worker for two vocabulary files."""
    if (left, right) not in _ALIGNERS:
        _ALIGNERS[left, right] = Aligner(left, right)
    return _ALIGNERS[left, right]


def align_tokens(docs: DataFrame, left: str, right: str, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` plus its alignment.

    ``left_ids, right_ids``: the tokens of space and text; ``left_group,
    right_group``: for each token the 0-based group that it is in; ``links``:
    array of (left, right), the places of all overlapping tokens, by left, then
    right.  Rows whose text is null, empty, or not given back byte for byte by
    both vocabularies have empty arrays.  Repeated rows are rows of their own;
    an empty table gives an empty result; input columns named like an output
    column are replaced, all others come back unchanged.
    """
    keep = without(docs, ALIGNED)
    names = keep.columns
    (text,) = fresh(names, "whole_text")
    ints = T.ArrayType(T.IntegerType())
    link = T.ArrayType(T.StructType([T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType())]))
    schema = T.StructType([*keep.schema.fields, *(T.StructField(c, ints) for c in ALIGNED[:4]), T.StructField("links", link)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(left, right)
        for batch in small(batches, SLICE_BYTES):
            texts = batch.column(text).to_pylist()
            for i, j in slices(texts, SLICE_BYTES):
                x = both.align(texts[i:j])
                sizes = x.per_text(x.a.doc), x.per_text(x.b.doc)
                first = [np.concatenate(([0], np.cumsum(s)))[:-1] for s in sizes]
                la, lb = x.links
                order = np.lexsort((lb, la))
                la, lb = la[order], lb[order]
                doc = x.a.doc[la]
                base = np.concatenate(([0], np.cumsum(x.per_text(x.a.doc[x.cut_a]))))[:-1]
                pairs = pa.StructArray.from_arrays([pa.array(la - first[0][doc], pa.int32()), pa.array(lb - first[1][doc], pa.int32())], ["left", "right"])
                ends = pa.array(np.concatenate(([0], np.cumsum(x.per_text(doc)))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, j - i) for c in names], _lists(x.a.ids, sizes[0], pa.int32()), _lists(x.b.ids, sizes[1], pa.int32()),
                     _lists(x.group_a - base[x.a.doc], sizes[0], pa.int32()), _lists(x.group_b - base[x.b.doc], sizes[1], pa.int32()),
                     pa.ListArray.from_arrays(ends, pairs)], names=[*names, *ALIGNED])

    return docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").alias(text)).mapInArrow(run, schema)


@dataclass
class Blocked:
    """The documents in blocks (``rows``) and the distinct pairs of each block with the number of its documents that have them (``pairs``)."""

    rows: DataFrame
    pairs: DataFrame
    names: list[str]
    own: list[str]
    n_right: int


def blocks(docs: DataFrame, left: str, right: str, text_col: str, columns: list[str]) -> Blocked:
    """Align every text once and write, per block, the documents (``columns`` of them) and the distinct id pairs."""
    keep = without(docs.select(*[F.col(f"`{c}`") for c in columns]), COUNTS)
    names = keep.columns
    text, block, place, times, pairs, having = own = fresh([*names, *COUNTS], "whole_text", "block", "places", "times", "pairs", "having")
    longs, ints = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    counted = ["n_a", "n_b", "n_groups", "n_links"]
    made = T.StructType([
        *(T.StructField(f.name, f.dataType) for f in keep.schema.fields), T.StructField(block, T.LongType()),
        *(T.StructField(c, T.LongType()) for c in counted), T.StructField("groups_sha256", T.StringType()),
        T.StructField(place, ints), T.StructField(times, ints), T.StructField(pairs, longs), T.StructField(having, ints)])
    n_right = len(vocabulary(right).raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(left, right)
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def emit() -> Iterator[pa.RecordBatch]:
            code = np.concatenate([h[2] for h in held])
            distinct, at, having_ = np.unique(code, return_inverse=True, return_counts=True)
            done = 0
            for rows, sizes, codes, mult in held:
                n, i = rows.num_rows, done
                done += len(codes)
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in names], pa.array(np.full(n, number), pa.int64()), *[rows.column(c) for c in (*counted, "groups_sha256")],
                     _lists(at[i:done], sizes, pa.int32()), _lists(mult, sizes, pa.int32()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))],
                    names=made.names)
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(1, rows.column(c).type) for c in names], pa.array([number], pa.int64()), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()),
                 *[pa.nulls(1, pa.list_(pa.int32()))] * 2, _lists(distinct, np.array([len(distinct)]), pa.int64()), _lists(having_, np.array([len(distinct)]), pa.int32())],
                names=made.names)

        for batch in small(batches, SLICE_BYTES):
            texts = batch.column(text).to_pylist()
            for i, j in slices(texts, SLICE_BYTES):
                x = both.align(texts[i:j])
                la, lb = x.links
                doc = x.a.doc[la]
                key, mult = np.unique(doc * (both.sizes[0] * n_right) + x.a.ids[la] * n_right + x.b.ids[lb], return_counts=True)
                counts = [x.per_text(d) for d in (x.a.doc, x.b.doc, x.a.doc[x.cut_a], doc)]
                rows = pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, j - i) for c in names], *[pa.array(c, pa.int64()) for c in counts], pa.array(both.written(x), pa.string())],
                    names=[*names, *counted, "groups_sha256"])
                held.append((rows, np.bincount(key // (both.sizes[0] * n_right), minlength=j - i), key % (both.sizes[0] * n_right), mult))
                size += sum(len(t or "") for t in texts[i:j])
                if size >= BLOCK_BYTES:
                    yield from emit()
                    held, size, number = [], 0, number + 1
        if held:
            yield from emit()

    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").alias(text))
    kept = stage(rows.mapInArrow(run, made), "aligned")
    return Blocked(kept.filter(F.col(place).isNotNull()).drop(pairs, having), kept.filter(F.col(pairs).isNotNull()).select(block, pairs, having), names, own, n_right)


def pair_counts(b: Blocked) -> DataFrame:
    """(pair, n_docs, best): in how many documents an id pair is linked, and whether no other pair of its left id has more."""
    _, block, _, _, pairs, having = b.own
    each = b.pairs.select(F.explode(F.arrays_zip(F.col(pairs).alias("p"), F.col(having).alias("n"))).alias("x"))
    counts = stage(each.groupBy(F.col("x.p").alias("pair")).agg(F.sum("x.n").alias("n_docs")), "pair-counts")
    left = F.expr(f"pair DIV {b.n_right}")
    most = counts.groupBy(left.alias("left_id")).agg(F.max("n_docs").alias("most"))
    joined = counts.withColumn("of", left).join(most, F.col("of") == F.col("left_id"))
    return joined.select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def linked_ids(docs: DataFrame, left: str, right: str, text_col: str = "text") -> DataFrame:
    """(left_id, right_id, n_docs, best): the id pairs that documents link, a translation table between both vocabularies."""
    b = blocks(docs, left, right, text_col, [])
    return pair_counts(b).select(F.expr(f"pair DIV {b.n_right}").cast("int").alias("left_id"), (F.col("pair") % b.n_right).cast("int").alias("right_id"), "n_docs", "best")


def alignment_counts(docs: DataFrame, left: str, right: str, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all but the text) plus ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``left`` and ``right`` name vocabulary files that every worker can open: a
    byte-level BPE file in JSON form or a SentencePiece model.  ``n_a, n_b``:
    tokens of space and text; ``n_groups``: runs between bytes where tokens of
    both sides end; ``n_links``: overlapping token pairs.  The count of an id
    pair is the number of documents (rows) that link it: ``n_best`` links have
    the highest count of their left id, ties included, and ``count_sum`` sums
    the counts of all links.  ``groups_sha256``: of the ids by group as
    ``a1,a2|b1;a3|b2,b3``.

    Texts that are null, empty, or not given back byte for byte by both sides
    have zeros and ''.  Rows that repeat count as documents each.  An empty table
    gives an empty result; input columns named like an output column are
    replaced.
    """
    b = blocks(docs, left, right, text_col, columns if columns is not None else [c for c in docs.columns if c != text_col])
    names, (_, block, place, times, pairs, _) = b.names, b.own
    known = stage(pair_counts(b), "pair-best")
    listed = b.pairs.select(F.col(block).alias("of"), F.posexplode(pairs).alias("at", "p"))
    back = listed.join(known, F.col("p") == F.col("pair")).select("of", "at", "n_docs", "best")
    fields = {f.name: f for f in b.rows.schema.fields}
    schema = T.StructType([*(fields[c] for c in (*names, "n_a", "n_b", "n_groups", "n_links")), T.StructField("n_best", T.LongType()),
                           T.StructField("count_sum", T.LongType()), fields["groups_sha256"]])

    def run(rows: pa.Table, counts: pa.Table) -> pa.Table:
        at = counts.column("at").to_numpy()
        n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n[at], best[at] = counts.column("n_docs").to_numpy(), counts.column("best").to_numpy()
        sums = []
        for chunk in rows.to_batches():
            p, m = chunk.column(place), chunk.column(times)
            ends = np.concatenate(([0], np.cumsum(np.diff(p.offsets.to_numpy()))))
            p, m = p.flatten().to_numpy(), m.flatten().to_numpy().astype(np.int64)
            sums.append([np.diff(np.concatenate(([0], np.cumsum(m * weight[p])))[ends]) for weight in (best, n)])
        extra = [pa.array(np.concatenate([np.zeros(0, np.int64), *[s[k] for s in sums]]), pa.int64()) for k in (0, 1)]
        kept = [rows.column(c) for c in (*names, "n_a", "n_b", "n_groups", "n_links")]
        return pa.Table.from_arrays([*kept, *extra, rows.column("groups_sha256")], names=schema.names)

    return b.rows.groupBy(block).cogroup(back.groupBy("of")).applyInArrow(run, schema)

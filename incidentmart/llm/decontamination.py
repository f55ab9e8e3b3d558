"""Benchmark decontamination by winnowing.

A window is a run of ``window`` consecutive words.  Of its ``window - gram + 1``
word grams the one with the least hash (the last of equals) is its fingerprint.
Equal windows have equal fingerprints, so any shared span of at least ``window``
words has one in common; neighbouring windows mostly choose the same gram, so a
text has far fewer fingerprints than words.

The fingerprints of the benchmark make a bitmap of bounded size that goes to all
tasks.  Document fingerprints that miss it are done with; a hit is extended to
the windows that chose it, and these are joined with the benchmark's windows on
fingerprint and window.  Only hits are shuffled, and every window of the
benchmark is one row on its side of the join, so no pairs are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import fresh, stage, without
from .words import U, Words, mix, slices, small, stream

OUT = ["n_words", "n_hit", "n_items", "item_ids", "hit_spans"]
BITS_PER_KEY = 32
BUCKET_BITS = 1 << 15           # bits of one built-in bitmap
MAX_BUCKETS = 1 << 15           # 128 MB of bitmaps at most

# Words are runs of ASCII letters, digits and all characters beyond ASCII, without regard to the case of A to Z.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words(texts: list[bytes | None]) -> Words:
    return Words([(t or b"").translate(_TABLE) for t in texts])


def window_hash(w: Words, starts: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each of ``starts``."""
    total = np.zeros(len(starts), U)
    for j, c in enumerate(stream(5, width) | U(1)):
        total += w.hashes[starts + j] * c
    return mix(total)


def winnow(w: Words, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of ``width`` words inside one text: its first word, the
    first word of its least gram, and that gram's hash.

    ``gram`` is taken as ``width`` where it is longer.
    """
    gram = min(gram, width)
    at, hashes = w.windows(gram)
    owner = w.owner()
    n = max(len(w.hashes) - width + 1, 0)
    starts = np.flatnonzero(owner[:n] == owner[width - 1:]) if n else np.zeros(0, np.int64)
    first = np.searchsorted(at, starts)
    best, least = first.copy(), hashes[first]
    for j in range(1, width - gram + 1):
        h = hashes[first + j]
        on = h <= least
        best[on], least[on] = (first + j)[on], h[on]
    return starts, at[best], least


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """(item, length, fingerprint, window): the windows of every benchmark text; a text with fewer words is one window."""
    rows = items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{text_col}`").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            ids, texts = b.column("item").to_pylist(), b.column("text").to_pylist()
            counts = words(texts).counts()
            for length in range(1, window + 1):
                own = np.flatnonzero(counts == length if length < window else counts >= window)
                w = words([texts[i] for i in own])
                starts, _, prints = winnow(w, length, gram)
                if len(starts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[own[k]] for k in w.owner()[starts]]), pa.array(np.full(len(starts), length), pa.int32()),
                         pa.array(prints.view(np.int64)), pa.array(window_hash(w, starts, length).view(np.int64))],
                        names=["item", "length", "fingerprint", "window"])

    return rows.mapInArrow(run, "item string, length int, fingerprint long, window long").distinct()


class Recognizer:
    """Bitmaps that hold every fingerprint of the benchmark: two bits each, ``BITS_PER_KEY`` bits a key up to 128 MB in all.

    Beyond that they fill up and more hits go to the join; the result stays.
    """

    def __init__(self, prints: DataFrame):
        n, self.buckets = prints.count(), 1
        while self.buckets < MAX_BUCKETS and self.buckets * BUCKET_BITS < n * BITS_PER_KEY:
            self.buckets *= 2
        bits = prints.select(F.explode(F.array(*[
            F.shiftrightunsigned("fingerprint", s).bitwiseAND(F.lit(self.buckets * BUCKET_BITS - 1)) for s in (0, 32)])).alias("bit"))
        maps = bits.groupBy(F.shiftrightunsigned("bit", 15).alias("bucket")).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(BUCKET_BITS - 1))).alias("map"))
        self.map = np.zeros(self.buckets * BUCKET_BITS // 8, np.uint8)
        for bucket, found in maps.toLocalIterator():
            self.map[bucket * BUCKET_BITS // 8:(bucket + 1) * BUCKET_BITS // 8] = np.frombuffer(bytes(found), np.uint8)

    def holds(self, prints: np.ndarray) -> np.ndarray:
        on = np.ones(len(prints), bool)
        for s in (0, 32):
            bit = (prints >> U(s)) & U(self.buckets * BUCKET_BITS - 1)
            on &= (self.map[(bit >> U(3)).astype(np.int64)] >> (bit & U(7)).astype(np.uint8)) & 1 == 1
        return on


def document_hits(docs: DataFrame, text_col: str, names: list[str], own: list[str], lengths: list[int], gram: int, known: Recognizer) -> DataFrame:
    """Each row's other columns, its words, and the windows whose fingerprint the benchmark may have."""
    text, hits = own
    shared = docs.sparkSession.sparkContext.broadcast(known)
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").cast("binary").alias(text))
    hit = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("fingerprint", pa.int64()), ("window", pa.int64())])
    schema = T.StructType([*[rows.schema[c] for c in names], T.StructField("n_words", T.LongType()),
                           T.StructField(hits, T.ArrayType(T.StructType([T.StructField(f.name, T.IntegerType() if f.type == pa.int32() else T.LongType()) for f in hit])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in small(batches):
            texts = batch.column(text).to_pylist()
            for i, j in slices(texts):
                w = words(texts[i:j])
                found = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, U), np.zeros(0, U))]
                for length in lengths:
                    starts, grams, prints = winnow(w, length, gram)
                    chosen = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))[:len(grams)])     # each fingerprint once
                    at = np.repeat(known.holds(prints[chosen]), np.diff(np.append(chosen, len(grams))))
                    starts, prints = starts[at], prints[at]
                    found.append((starts, np.full(len(starts), length, np.int32), prints, window_hash(w, starts, length)))
                start, length, prints, windows = map(np.concatenate, zip(*found))
                order = np.argsort(start, kind="stable")
                start, length, prints, windows = start[order], length[order], prints[order], windows[order]
                values = pa.StructArray.from_arrays(
                    [pa.array(start - w.bounds[w.owner()[start]], pa.int32()), pa.array(length), pa.array(prints.view(np.int64)), pa.array(windows.view(np.int64))], fields=list(hit))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, j - i) for c in names], pa.array(w.counts(), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.searchsorted(start, w.bounds), pa.int32()), values)], names=[*names, "n_words", hits])

    return rows.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", item_text_col: str = "text",
                  window: int = 10, gram: int = 6, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all) plus ``n_words, n_hit, n_items, item_ids, hit_spans``.

    Words are runs of digits, ASCII letters without regard to case, and all
    characters beyond ASCII.  A window of an item is ``window`` of its
    consecutive words; an item with fewer words is one window, one without words
    has none.  A document word inside an occurrence of a window is hit:
    ``n_hit`` counts them, ``hit_spans`` lists them as half-open word ranges
    that neither meet nor overlap.  ``item_ids``: the items with an occurring
    window, as text, sorted; ``n_items`` their number.

    Null and empty texts have no words.  Items of the same id are one item, a
    null id is ''.  Rows that repeat are judged alike, each on its own.  Empty
    documents give an empty result, an empty benchmark hits nothing.  Input
    columns named like an output column are replaced, all others come back
    unchanged.  Windows are compared by 64-bit hashes.
    """
    keep = without(docs.select(*[F.col(f"`{c}`") for c in columns]) if columns is not None else docs, OUT)
    names = keep.columns
    text, hits, row, of = fresh([*names, *OUT], "whole_text", "hits", "row_no", "of_row")
    listed = stage(item_windows(items, id_col, item_text_col, window, gram), "item-windows")
    lengths = sorted(r.length for r in listed.select("length").distinct().collect())        # at most ``window`` numbers
    known = Recognizer(listed.select("fingerprint").distinct())
    rows = document_hits(docs, text_col, names, [text, hits], lengths, gram, known)
    rows = stage(rows.withColumn(row, F.monotonically_increasing_id()), "document-hits")

    # windows that the same items have are of one kind: a document meets each kind once, however long the passage is
    kinds = listed.groupBy("fingerprint", "window").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64("item", F.lit(1))).alias("y"))
    kinds = stage(kinds.select(F.col("fingerprint").alias("f"), F.col("window").alias("w"), F.struct("n", "x", "y").alias("kind")), "window-kinds")
    members = listed.join(kinds, (F.col("fingerprint") == F.col("f")) & (F.col("window") == F.col("w"))).select(F.col("kind").alias("of"), "item").distinct()

    each = rows.filter(F.size(hits) > 0).select(F.col(row).alias("r"), F.explode(hits).alias("h")).select("r", "h.*")
    sure = stage(each.join(kinds, (F.col("fingerprint") == F.col("f")) & (F.col("window") == F.col("w"))).select("r", "start", (F.col("start") + F.col("length")).alias("end"), "kind"), "sure-hits")
    order = Window.partitionBy("r").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = sure.withColumn("new", F.coalesce((F.col("start") > before).cast("int"), F.lit(1))).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("r", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy("r").agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("hit_spans"))
    met = sure.select(F.col("r").alias("doc"), "kind").distinct().join(members, F.col("kind") == F.col("of")).select("doc", "item").distinct()
    met = met.groupBy("doc").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item")).alias("item_ids"))
    found = spans.join(met, F.col("r") == F.col("doc")).select(F.col("r").alias(of), "n_hit", "hit_spans", "n_items", "item_ids")
    none = "array<struct<start:int,end:int>>"
    return rows.join(found, F.col(row) == F.col(of), "left").select(
        *[F.col(f"`{c}`") for c in names], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("hit_spans", F.array().cast(none)).alias("hit_spans"))

"""Remove passages that an earlier document already has, found by difference-cover anchors.

A window is 13 consecutive words.  Word positions modulo 7 that lie in the
difference cover {1, 2, 4} carry an anchor: the hash of the 7 words from there.
For any two equal windows there is a shift below 7 that puts both on a cover
position, so they share an aligned anchor; three of seven positions are hashed
and shuffled instead of all.  Anchors seen in one document only are dropped.
Around the rest every window is extended to its 13 words and judged by the
smallest document that has it.

Documents are dealt into groups of bounded size once, and that exchange serves
all three passes over the text.  Between the passes only packed hashes and one
bit per hash move: a group sends, to each hash bucket, its distinct hashes in
order, and gets back one bit for each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_names, without
from .words import U, Words, slices

PERIOD, COVER = 7, (1, 2, 4)
OUT = ["n_words", "n_removed", "kept_text", "removed_spans", "kept_sha256"]
NO_ID = np.iinfo(np.int64).max


def covers(period: int, cover: tuple[int, ...]) -> bool:
    """Whether every difference modulo ``period`` is a difference of two members of ``cover``."""
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


class Group:
    """The documents of one group: words, windows and anchors, always in the same order."""

    def __init__(self, ids: list[int | None], texts: list[bytes | None], width: int):
        self.rank = np.array([NO_ID if i is None else i for i in ids], np.int64)
        self.texts, self.width = [t or b"" for t in texts], width
        parts = [(i, Words(self.texts[i:j])) for i, j in slices(self.texts)]
        self.counts = np.concatenate([w.counts() for _, w in parts]) if parts else np.zeros(0, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.owner = np.repeat(np.arange(len(self.texts)), self.counts)
        self.place = np.arange(len(self.owner)) - np.repeat(self.first[:-1], self.counts)
        self.parts = parts

    def _runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        at, hashes = [np.zeros(0, np.int64)], [np.zeros(0, U)]
        for i, w in self.parts:
            s, h = w.windows(width)
            at.append(s + self.first[i])
            hashes.append(h)
        return np.concatenate(at), np.concatenate(hashes)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every anchor inside some window."""
        at, h = self._runs(self.width - PERIOD + 1)
        on = np.isin(self.place[at] % PERIOD, COVER)
        return at[on], h[on]

    def windows(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of the windows that contain one of the anchors that start at ``hot``."""
        edge = np.zeros(len(self.owner) + 1, np.int64)
        np.add.at(edge, np.maximum(hot - PERIOD + 1, self.first[self.owner[hot]]), 1)
        np.add.at(edge, hot + 1, -1)
        near = np.cumsum(edge[:-1]) > 0
        at, h = self._runs(self.width)
        on = near[at]
        return at[on], h[on]


def by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in the order of (bucket, hash), the buckets they fill, and where each of these starts (and the last ends)."""
    distinct = np.unique(hashes)
    bucket = (distinct >> U(20)) % U(buckets)
    distinct = distinct[np.argsort(bucket, kind="stable")]
    full, starts = np.unique(np.sort(bucket), return_index=True)
    return distinct, full.astype(np.int64), np.append(starts, len(distinct))


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _read_bits(table: pa.Table, kind: int, full: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The bits that came back for each distinct hash; a bucket that sent none has zeros."""
    out = np.zeros(int(starts[-1]), bool)
    for k, b, bits in zip(table.column("kind").to_pylist(), table.column("bucket").to_pylist(), table.column("bits").to_pylist()):
        if k == kind:
            at = int(np.searchsorted(full, b))
            n = int(starts[at + 1] - starts[at])
            out[starts[at]:starts[at + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
    return out


def _lookup(distinct: np.ndarray, flags: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    on = np.sort(distinct[flags])
    if not len(on):
        return np.zeros(len(hashes), bool)
    at = np.searchsorted(on, hashes)
    at[at == len(on)] = 0
    return on[at] == hashes


def _hot_anchors(g: Group, back: pa.Table, buckets: int) -> np.ndarray:
    at, h = g.anchors()
    distinct, full, starts = by_bucket(h, buckets)
    return at[_lookup(distinct, _read_bits(back, 0, full, starts), h)]


def _smallest(g: Group, at: np.ndarray, h: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """For each distinct hash the smallest id of the group that has it."""
    order = np.argsort(distinct)
    low = np.full(len(distinct), NO_ID)
    np.minimum.at(low, order[np.searchsorted(distinct[order], h)], g.rank[g.owner[at]])
    return low


SENT = "bucket int, grp long, kind int, hashes binary, more binary"
BACK = "grp long, kind int, bucket int, bits binary"


def _columns(t: pa.Table) -> tuple[list, list]:
    return t.column("__id").to_pylist(), t.column("__text").to_pylist()


@own_names
def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13,
                   group_bytes: int = 4 << 20, min_buckets: int = 64) -> DataFrame:
    """Every row of ``docs`` plus ``n_words, n_removed, kept_text, removed_spans, kept_sha256``.

    Words are runs of characters other than space and U+0009 to U+000D.  A word
    goes when a window of ``width`` words over it also starts in a row with a
    smaller id.  ``kept_text``: the words that stay, joined by one space;
    ``removed_spans``: half-open word ranges; ``kept_sha256``: of ``kept_text``.

    * Null and empty text has no words; rows shorter than a window keep all.
    * Rows with equal ids are one document for the comparison: neither loses
      words to the other.  Null ids come after all others.
    * An empty table gives an empty result; an input column named like an
      output column is replaced, any other comes back as it was.
    * Hashes have 64 bits; two different windows are taken as equal with a
      chance of about (windows squared) / 2^65.
    """
    if width < PERIOD + 1 or not covers(PERIOD, COVER):
        raise ValueError("the window must be longer than the period")
    docs = without(docs, [c for c in OUT if c.lower() not in (id_col.lower(), text_col.lower())])
    names = docs.columns
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    buckets = max(min_buckets, groups // 4)
    rows = docs.withColumn("__grp", F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit(7)), F.lit(groups))) \
        .withColumn("__id", F.col(f"`{id_col}`").cast("long")).withColumn("__text", F.col(f"`{text_col}`").cast("binary"))

    def send_anchors(t: pa.Table) -> pa.Table:
        grp = t.column("__grp")[0].as_py()
        g = Group(*_columns(t), width)
        at, h = g.anchors()
        distinct, full, starts = by_bucket(h, buckets)
        where = np.argsort(distinct)[np.searchsorted(np.sort(distinct), h)]
        low, high = np.full(len(distinct), NO_ID), np.full(len(distinct), -NO_ID)
        ids = g.rank[g.owner[at]]
        np.minimum.at(low, where, ids)
        np.maximum.at(high, where, ids)
        several = low < high
        return _send(grp, 0, full, starts, lambda i, j: (
            np.ascontiguousarray((distinct[i:j] >> U(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes(), _bits(several[i:j])))

    def _send(grp: int, kind: int, full: np.ndarray, starts: np.ndarray, pack) -> pa.Table:
        packed = [pack(i, j) for i, j in zip(starts[:-1].tolist(), starts[1:].tolist())]
        return pa.table({"bucket": pa.array(full, pa.int32()), "grp": pa.array([grp] * len(full), pa.int64()), "kind": pa.array([kind] * len(full), pa.int32()),
                         "hashes": pa.array([p[0] for p in packed], pa.binary()), "more": pa.array([p[1] for p in packed], pa.binary())})

    def repeated(t: pa.Table) -> pa.Table:
        """Bits: the anchor is in two documents or more."""
        blobs = t.column("hashes").to_pylist()
        parts = []
        for x in blobs:
            raw = np.zeros((len(x) // 6, 8), np.uint8)
            raw[:, :6] = np.frombuffer(x, np.uint8).reshape(-1, 6)
            parts.append(raw.reshape(-1).view("<u8"))
        several = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=len(p)) for m, p in zip(t.column("more").to_pylist(), parts)])
        _, where, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        twice = n > 1
        np.logical_or.at(twice, where, several.astype(bool))
        return _answer(t, parts, twice[where], 0)

    def _answer(t: pa.Table, parts: list, flags: np.ndarray, kind: int) -> pa.Table:
        ends = np.cumsum([len(p) for p in parts])
        each = [flags[e - len(p):e] for e, p in zip(ends, parts)]
        on = [i for i, f in enumerate(each) if f.any()]
        bucket = t.column("bucket")[0].as_py()
        grp = t.column("grp").to_pylist()
        return pa.table({"grp": pa.array([grp[i] for i in on], pa.int64()), "kind": pa.array([kind] * len(on), pa.int32()),
                         "bucket": pa.array([bucket] * len(on), pa.int32()), "bits": pa.array([_bits(each[i]) for i in on], pa.binary())})

    def send_windows(t: pa.Table, back: pa.Table) -> pa.Table:
        if not t.num_rows:
            return pa.table({c: pa.array([], k) for c, k in (("bucket", pa.int32()), ("grp", pa.int64()), ("kind", pa.int32()), ("hashes", pa.binary()), ("more", pa.binary()))})
        g = Group(*_columns(t), width)
        at, h = g.windows(_hot_anchors(g, back, buckets))
        distinct, full, starts = by_bucket(h, buckets)
        low = _smallest(g, at, h, distinct)
        # the bytes of the ids are laid out plane by plane, which the shuffle compresses well
        return _send(t.column("__grp")[0].as_py(), 1, full, starts, lambda i, j: (
            distinct[i:j].tobytes(), np.ascontiguousarray(low[i:j].view(np.uint8).reshape(-1, 8).T).tobytes()))

    def earlier(t: pa.Table) -> pa.Table:
        """Bits: a document before the group's smallest has the window."""
        parts = [np.frombuffer(x, U) for x in t.column("hashes").to_pylist()]
        low = np.concatenate([np.ascontiguousarray(np.frombuffer(m, np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64) for m in t.column("more").to_pylist()])
        keys, where = np.unique(np.concatenate(parts), return_inverse=True)
        least = np.full(len(keys), NO_ID)
        np.minimum.at(least, where, low)
        return _answer(t, parts, least[where] < low, 1)

    out = docs.schema.fields
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in out],
                        "n_words long", "n_removed long", "kept_text string", "removed_spans array<array<long>>", "kept_sha256 string"])

    def remove(t: pa.Table, back: pa.Table) -> pa.Table:
        own = t.select(names)
        if not t.num_rows:
            made = [[], [], [], [], []]
        else:
            g = Group(*_columns(t), width)
            at, h = g.windows(_hot_anchors(g, back, buckets))
            distinct, full, starts = by_bucket(h, buckets)
            low = _smallest(g, at, h, distinct)
            order = np.argsort(distinct)
            where = order[np.searchsorted(distinct[order], h)]
            gone = _read_bits(back, 1, full, starts)[where] | (low[where] < g.rank[g.owner[at]])
            edge = np.zeros(len(g.owner) + 1, np.int64)
            np.add.at(edge, at[gone], 1)
            np.add.at(edge, at[gone] + width, -1)
            made = _kept(g, np.cumsum(edge[:-1]) > 0)
        types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.string()]
        for name, values, kind in zip(OUT, made, types):
            own = own.append_column(name, pa.array(values, kind))
        return own

    def _kept(g: Group, gone: np.ndarray) -> list[list]:
        n_removed, texts, spans, digests = [], [], [], []
        for i, text in enumerate(g.texts):
            cut = gone[g.first[i]:g.first[i + 1]]
            words = text.split()
            k = int(cut.sum())
            body = b" ".join(compress(words, (~cut).tolist()) if k else words)
            n_removed.append(k)
            texts.append(body.decode("utf-8"))
            edges = np.flatnonzero(np.diff(np.concatenate(([False], cut, [False])).astype(np.int8))).reshape(-1, 2) if k else []
            spans.append([list(map(int, e)) for e in edges])
            digests.append(hashlib.sha256(body).hexdigest())
        return [g.counts.tolist(), n_removed, texts, spans, digests]

    by_group = rows.groupBy("__grp")
    hot = by_group.applyInArrow(send_anchors, SENT).groupBy("bucket").applyInArrow(repeated, BACK)
    found = by_group.cogroup(hot.groupBy("grp")).applyInArrow(send_windows, SENT).groupBy("bucket").applyInArrow(earlier, BACK)
    return by_group.cogroup(hot.unionByName(found).groupBy("grp")).applyInArrow(remove, schema)

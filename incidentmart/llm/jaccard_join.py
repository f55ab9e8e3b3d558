"""Similarity join on word shingles by chosen paths.

A text's set is its distinct runs of five words.  As in the published method
the set is embedded into at most ``BINS`` min-hash tokens.  In every run each
text picks the tokens whose seeded hash is below 1 / (threshold * tokens); the
texts that pick a token form a node.  Two texts over the threshold share at
least one picked token per level on average, so a run finds a pair with a known
chance, and runs repeat until the target recall; texts whose nodes need more
splits than these runs allow for take further runs.  Nodes up to ``LIMIT`` texts
are compared by brute force on their sketches.  Larger nodes are compared with
one pivot, whose close relatives are linked to it and leave.  When few others are
left apart from the pivot, they are compared with the whole node; otherwise the
rest is split again on tokens picked under that node.

What the nodes link are candidates, so they are taken loosely and reduced to
components.  Inside each component every pair of sets is compared exactly, in
blocks of bounded size; those counts and links are the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import own_names, stage
from .components import components
from .words import U, Words, give_back, mix, slices, small, stream

BINS = 128
EMPTY = np.uint32(0xFFFFFFFF)
LIMIT = 128                      # texts of a node that are compared with one another
SETTLE = 2048                    # texts apart from a large node's pivot that are compared with the whole node
CHUNK = 4096                     # texts of a large node that they meet in one group
BLOCK = 256                      # sets of a block in the exact comparison
DEPTH = 3                        # picks that the first runs allow for; deeper nodes get further runs
MAX_DEPTH = 20                   # after that the rest is compared block by block
SLACK = 0.18                     # five standard deviations of a sketch's estimate
FILTER_BUCKETS = 1 << 15         # at most 128 MB of bitmaps to recognise members
FILTER_BITS = 1 << 15


def runs_for(recall: float, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold that needs ``depth`` picks is found with that chance."""
    p = 1.0
    for _ in range(depth):
        p = 1.0 - math.exp(-p)
    return math.ceil(math.log(1.0 - recall) / math.log(1.0 - p))


# ---- sets and sketches of many texts at once

def shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of every shingle; a text shorter than ``width`` words is one shingle."""
    owner = w.owner()
    at, h = w.windows(width)
    owners, hashes = [owner[at]], [h]
    n = w.counts()
    for k in range(1, width):
        if (n == k).any():
            at, h = w.windows(k)
            own = owner[at]
            on = n[own] == k
            owners.append(own[on])
            hashes.append(h[on])
    return np.concatenate(owners), np.concatenate(hashes)


def vertex_ids(w: Words) -> np.ndarray:
    """64-bit hash of each text's word sequence (0 without words)."""
    n = w.counts()
    out = np.zeros(len(n), U)
    if len(w.hashes):
        place = np.arange(len(w.hashes)) - np.repeat(w.bounds[:-1], n)
        value = mix(w.hashes + mix(place.astype(U) + U(77)))
        out[n > 0] = mix(np.add.reduceat(value, w.bounds[:-1][n > 0]) + n[n > 0].astype(U))
    return out


def sketches(w: Words, width: int) -> np.ndarray:
    """One-permutation min-hash: the least 32-bit value in each of BINS bins; EMPTY where no shingle falls."""
    owner, h = shingles(w, width)
    h = mix(h ^ U(0x5851F42D4C957F2D))
    out = np.full(len(w.texts) * BINS, EMPTY, np.uint32)
    value = np.minimum((h >> U(32)).astype(np.uint32), EMPTY - np.uint32(1))
    np.minimum.at(out, owner * BINS + (h & U(BINS - 1)).astype(np.int64), value)
    return out.reshape(-1, BINS)


def picked(sketch: np.ndarray, nodes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and child nodes: the tokens that each row picks under its node."""
    full = sketch != EMPTY
    tokens = mix(sketch.astype(U) + (np.arange(BINS, dtype=U) << U(32)))
    draw = mix(tokens ^ mix(nodes)[:, None])
    chance = np.minimum(1.0 / (threshold * np.maximum(full.sum(axis=1), 1)), 1.0)
    limit = np.minimum(chance * 2.0 ** 64, 2.0 ** 64 - 2049).astype(U)
    row, col = np.nonzero(full & (draw <= limit[:, None]))
    return row, mix(tokens[row, col] + mix(nodes[row] ^ U(0x2545F4914F6CDD1D)))


def short(sketch: np.ndarray) -> np.ndarray:
    """One byte per bin for comparing: 0 if empty, else 1 to 255."""
    return np.where(sketch == EMPTY, 0, 1 + sketch % np.uint32(255)).astype(np.uint8)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of row pairs of byte sketches."""
    same = ((a == b) & (a != 0)).sum(axis=1)
    return same / np.maximum(((a | b) != 0).sum(axis=1), 1)


def roots_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index of the component of each of ``n`` items under the links (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, before[i], low)
        np.minimum.at(label, before[j], low)
        label = label[label]
        if (label == before).all():
            break
    return label


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 4096) -> Iterator[pa.Table]:
    """Tables of whole groups out of batches sorted by ``key``; groups are of bounded size."""
    held: list[pa.RecordBatch] = []
    count = 0
    for b in batches:
        held.append(b)
        count += b.num_rows
        if count < rows:
            continue
        t = pa.Table.from_batches(held)
        keys = np.asarray(t.column(key))
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield t.slice(0, cut)
        held, count = t.slice(cut).to_batches(), t.num_rows - cut
    if count:
        yield pa.Table.from_batches(held)
    give_back()


def _matrix(column: pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int64) if x.dtype != U else x.view(np.int64))


# ---- the Spark job

def describe(docs: DataFrame, id_col: str, text_col: str, width: int, threshold: float, runs: int) -> DataFrame:
    """(id, v, n_words, sketch, nodes): per row its vertex, min-hash sketch and the nodes it picks in all runs."""
    seeds = stream(11, runs)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts = b.column("t").to_pylist()
            for i, j in slices(texts):
                w = Words(texts[i:j])
                sketch, n = sketches(w, width), w.counts()
                nodes: list[list] = [[] for _ in range(j - i)]
                for s in seeds:
                    row, child = picked(sketch, np.full(j - i, s, U), threshold)
                    for r, c in zip(row.tolist(), child.view(np.int64).tolist()):
                        nodes[r].append(c)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(i, j - i), _long(vertex_ids(w)), pa.array(n.astype(np.int64)), pa.array([r.tobytes() for r in sketch], pa.binary()),
                     pa.array(nodes, pa.list_(pa.int64()))], names=["id", "v", "n_words", "sketch", "nodes"])

    return rows.mapInArrow(run, f"id {id_type}, v long, n_words long, sketch binary, nodes array<long>")


def living(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct (node, v) of the nodes with two vertices or more, and (node, n)."""
    some = stage(entries.groupBy("node").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).filter("lo < hi").select(F.col("node").alias("k")), "join-living")
    left = stage(entries.join(some, entries["node"] == some["k"], "left_semi").distinct(), "join-entries")
    return left, stage(left.groupBy(F.col("node").alias("k")).agg(F.count(F.lit(1)).alias("n")), "join-nodes")


def compare_small(entries: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links inside nodes of bounded size, one per text at most; ``entries``: (node, v, bytes)."""
    least = threshold - SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "node"):
            node, v, sk = np.asarray(t.column("node")), np.asarray(t.column("v")), _matrix(t.column("bytes"), np.uint8, BINS)
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for d in range(1, len(node)):
                i = np.flatnonzero(node[:-d] == node[d:])
                if not len(i):
                    break
                i = i[estimate(sk[i], sk[i + d]) >= least]
                left.append(i)
                right.append(i + d)
            root = roots_of(len(v), np.concatenate(left), np.concatenate(right))
            on = np.flatnonzero(root != np.arange(len(v)))
            yield pa.RecordBatch.from_arrays([pa.array(v[root[on]]), pa.array(v[on])], names=["a", "b"])

    return entries.repartition("node").sortWithinPartitions("node", "v").mapInArrow(run, "a long, b long")


def compare_pivot(entries: DataFrame, threshold: float) -> DataFrame:
    """(node, v, sketch, pivot, near): similarity of every text of a large node to the node's least text."""
    pivots = stage(entries.groupBy(F.col("node").alias("around")).agg(F.min("v").alias("pivot"), F.min_by("sketch", "v").alias("ps")), "join-pivots")
    rows = entries.join(pivots, entries["node"] == pivots["around"]).select("node", "v", "sketch", "pivot", "ps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = estimate(short(_matrix(b.column("sketch"), np.uint32, BINS)), short(_matrix(b.column("ps"), np.uint32, BINS)))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("node", "v", "sketch", "pivot")] + [pa.array(near)], names=["node", "v", "sketch", "pivot", "near"])

    return rows.mapInArrow(run, "node long, v long, sketch binary, pivot long, near double")


def settle(rest: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links of the few texts of a large node that do not hang on its pivot, with all that are left in it.

    ``rest``: (node, v, sketch, far_off); ``nodes``: (k, n, far) with ``far`` at
    most SETTLE.  The node's texts are dealt into shares of about CHUNK, and the
    far ones go to each share, so a task's group stays bounded however large the
    node is.
    """
    least = threshold - SLACK
    shares = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int")
    one = F.array(F.pmod(F.xxhash64("v", F.lit(5)), shares).cast("int"))
    every = F.sequence(F.lit(0), shares - 1)
    dealt = rest.join(nodes.withColumnRenamed("k", "settled"), F.col("node") == F.col("settled")) \
        .withColumn("share", F.explode(F.when(F.col("far_off"), every).otherwise(one))) \
        .select(F.xxhash64("node", "share").alias("node"), "v", "sketch", "far_off")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "node"):
            node, v, off = np.asarray(t.column("node")), np.asarray(t.column("v")), np.asarray(t.column("far_off"))
            sk = short(_matrix(t.column("sketch"), np.uint32, BINS))
            edges = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1], [True])))
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
                for u in (i + np.flatnonzero(off[i:j])).tolist():
                    hit = i + np.flatnonzero(estimate(sk[i:j], sk[u:u + 1]) >= least)
                    left.append(np.full(len(hit), u))
                    right.append(hit)
            root = roots_of(len(v), np.concatenate(left), np.concatenate(right))
            on = np.flatnonzero(root != np.arange(len(v)))
            yield pa.RecordBatch.from_arrays([pa.array(v[root[on]]), pa.array(v[on])], names=["a", "b"])

    return dealt.repartition("node").sortWithinPartitions("node", "v").mapInArrow(run, "a long, b long")


def split(entries: DataFrame, threshold: float) -> DataFrame:
    """(node, v): the children that each text picks under its node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, child = picked(_matrix(b.column("sketch"), np.uint32, BINS), np.asarray(b.column("node")).view(U), threshold)
            yield pa.RecordBatch.from_arrays([_long(child), pa.array(np.asarray(b.column("v"))[row])], names=["node", "v"])

    return entries.select("node", "v", "sketch").mapInArrow(run, "node long, v long")


def blocks(entries: DataFrame, sizes: DataFrame, size: int) -> DataFrame:
    """Rows of every pair of blocks of a large group: ``node`` becomes the pair; each row meets every other once or more."""
    n = F.ceil(F.col("n") / F.lit(size)).cast("int")
    dealt = entries.join(sizes, entries["node"] == sizes["k"]).withColumn("of", n) \
        .withColumn("own", F.pmod(F.xxhash64("v", F.lit(3)), F.col("of")).cast("int")) \
        .withColumn("other", F.explode(F.expr("sequence(0, of - 1)")))
    pair = F.struct(F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    return dealt.withColumn("pair", pair)


def candidate_links(rows: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(a, b): loose links between vertices, enough of them to connect every pair over the threshold.

    The first runs meet ``recall`` for pairs found within DEPTH picks.  A pair
    that needs more has both its texts in nodes split after that; those texts
    take further runs, until the runs meet ``recall`` at the depth reached.
    """
    entries, sizes = living(rows.filter("n_words > 0").select(F.explode("nodes").alias("node"), "v"))
    active = stage(entries.select(F.col("v").alias("av")).distinct(), "join-active")
    once = rows.groupBy("v").agg(F.first("sketch").alias("sketch"))      # copies are combined before the shuffle
    vertices = stage(shorten(once.join(active, F.col("v") == F.col("av"), "left_semi")), "join-vertices")
    links, picks, deep = follow(entries, sizes, vertices, threshold)
    done = runs_for(recall)
    while deep is not None and done < (need := runs_for(recall, picks)):
        entries, sizes = living(further(vertices, deep, done, need, threshold))
        more, reached, _ = follow(entries, sizes, vertices, threshold)
        links, done, picks = stage(links.unionByName(more).distinct(), "join-links"), need, max(picks, reached)
    return links


def further(vertices: DataFrame, deep: DataFrame, done: int, need: int, threshold: float) -> DataFrame:
    """(node, v): the nodes that the vertices of ``deep`` pick in the runs from ``done`` up to ``need``."""
    seeds = stream(11, need)[done:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sk, v = _matrix(b.column("sketch"), np.uint32, BINS), np.asarray(b.column("v"))
            for s in seeds:
                row, child = picked(sk, np.full(len(sk), s, U), threshold)
                yield pa.RecordBatch.from_arrays([_long(child), pa.array(v[row])], names=["node", "v"])

    again = vertices.select("v", "sketch").join(deep, F.col("v") == F.col("dv"), "left_semi")
    return stage(again.mapInArrow(run, "node long, v long"), "join-further")


def follow(entries: DataFrame, sizes: DataFrame, vertices: DataFrame, threshold: float) -> tuple[DataFrame, int, DataFrame | None]:
    """Links (a, b) of the nodes and all that they split into, the picks that took, and (dv) the vertices still split after DEPTH picks."""
    deep = None
    links = None
    for depth in range(MAX_DEPTH + 1):
        small = entries.join(sizes.filter(F.col("n") <= LIMIT), F.col("node") == F.col("k"), "left_semi")
        full = vertices.select(F.col("v").alias("fv"), "bytes")
        found = compare_small(small.join(full, F.col("v") == F.col("fv")).select("node", "v", "bytes"), threshold)
        large_sizes = stage(sizes.filter(F.col("n") > LIMIT), "join-large")
        links = found if links is None else links.unionByName(found)
        if large_sizes.isEmpty():
            break
        large = entries.join(large_sizes, F.col("node") == F.col("k"), "left_semi")
        if depth == MAX_DEPTH:
            dealt = blocks(large, large_sizes, LIMIT // 2).select(F.xxhash64("node", "pair.lo", "pair.hi").alias("node"), "v").distinct()
            links = links.unionByName(compare_small(dealt.join(full, F.col("v") == F.col("fv")).select("node", "v", "bytes"), threshold))
            break
        wide = vertices.select(F.col("v").alias("fv"), "sketch")
        judged = stage(compare_pivot(stage(large.join(wide, F.col("v") == F.col("fv")).select("node", "v", "sketch"), "join-wide"), threshold), "join-pivoted")
        # what leaves with the pivot is within 1 - threshold + slack of it, so whatever is close to that is linked to the pivot too
        loose = 2 * threshold - 1 - SLACK
        links = links.unionByName(judged.filter((F.col("near") >= loose) & (F.col("v") != F.col("pivot"))).selectExpr("pivot AS a", "v AS b"))
        stays = (F.col("near") < threshold) & (F.col("v") != F.col("pivot"))
        shape = stage(judged.filter(stays).groupBy(F.col("node").alias("k")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("near") < loose).alias("far")), "join-shape")
        rest = judged.filter(stays).select("node", "v", "sketch", (F.col("near") < loose).alias("far_off"))
        # far = 0: all hang on the pivot, the node is one candidate component; few far: only they can add a link; else split
        links = stage(links.unionByName(settle(rest, shape.filter((F.col("far") > 0) & (F.col("far") <= SETTLE)), threshold)).distinct(), "join-links")
        parts = rest.join(shape.filter(F.col("far") > SETTLE), F.col("node") == F.col("k"), "left_semi")
        if depth + 1 == DEPTH:
            deep = stage(parts.select(F.col("v").alias("dv")).distinct(), "join-deep")
            deep = None if deep.isEmpty() else deep
        entries, sizes = living(split(parts, threshold))
    return links, depth + 1, deep


def shorten(vertices: DataFrame) -> DataFrame:
    """(v, sketch, bytes): adds the byte sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sk = short(_matrix(b.column("sketch"), np.uint32, BINS)) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column("v"), b.column("sketch"), pa.array([r.tobytes() for r in sk], pa.binary())], names=["v", "sketch", "bytes"])

    return vertices.mapInArrow(run, "v long, sketch binary, bytes binary")


def member_filter(members: DataFrame, n: int) -> np.ndarray:
    """Bitmaps that recognise the vertices of ``members``; 16 bits each up to 128 MB in all."""
    buckets = 1
    while buckets < FILTER_BUCKETS and buckets * FILTER_BITS < 16 * n:
        buckets *= 2
    spot = members.select(F.pmod(F.col("v"), F.lit(buckets * FILTER_BITS)).alias("p"))
    maps = spot.select(F.shiftright("p", 15).alias("b"), F.col("p").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("bit")) \
        .groupBy("b").agg(F.bitmap_construct_agg("bit").alias("m"))
    out = np.zeros((buckets, FILTER_BITS // 8), np.uint8)
    for r in maps.toLocalIterator():
        out[r["b"]] = np.frombuffer(r["m"], np.uint8)
    return out.reshape(-1)


def member_sets(docs: DataFrame, text_col: str, width: int, members: DataFrame) -> DataFrame:
    """(v, set): distinct sorted shingle hashes of every text that may be a member."""
    known = docs.sparkSession.sparkContext.broadcast(member_filter(members, members.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        for b in small(batches):
            texts = b.column("t").to_pylist()
            for i, j in slices(texts):
                w = Words(texts[i:j])
                v = vertex_ids(w)
                p = (v % U(len(bits) * 8)).astype(np.int64)
                on = np.flatnonzero(((bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1).astype(bool) & (w.counts() > 0))
                _, first = np.unique(v[on], return_index=True)
                on = on[first]
                sub = Words([w.texts[k] for k in on])
                owner, h = shingles(sub, width)
                order = np.lexsort((h, owner))
                owner, h = owner[order], h[order]
                new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.zeros(0, bool)
                owner, h = owner[new], h[new]
                ends = np.searchsorted(owner, np.arange(len(on) + 1))
                yield pa.RecordBatch.from_arrays([_long(v[on]), pa.array([h[ends[k]:ends[k + 1]].tobytes() for k in range(len(on))], pa.binary())], names=["v", "set"])

    return docs.select(F.col(f"`{text_col}`").cast("binary").alias("t")).mapInArrow(run, "v long, set binary") \
        .groupBy("v").agg(F.first("set").alias("set"))


def similar_pairs(sets: list[np.ndarray], threshold: Fraction) -> np.ndarray:
    """Boolean matrix: the pairs of sets whose exact Jaccard similarity is at least the threshold."""
    n = np.array([len(s) for s in sets], np.int64)
    common = np.zeros((len(sets), len(sets)))
    owner = np.repeat(np.arange(len(sets)), n)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    on = count[column] > 1
    owner, column = owner[on], rank[column[on]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = int(rank[-1]) + 1 if len(rank) else 0
    step = max(64, (1 << 21) // max(len(sets), 1))
    for begin in range(0, total, step):
        i, j = np.searchsorted(column, (begin, begin + step))
        hot = np.zeros((len(sets), min(step, total - begin)), np.float32)
        hot[owner[i:j], column[i:j] - begin] = 1
        common += hot @ hot.T
    both = n[:, None] + n[None, :]
    return common * (threshold.numerator + threshold.denominator) >= threshold.numerator * both


def exact_links(docs: DataFrame, text_col: str, width: int, members: DataFrame, threshold: float) -> DataFrame:
    """(v, links, root): per block each vertex's linked rows of other texts, and the least vertex it hangs on.

    ``members``: (v, root, copies).  A component of up to ``BLOCK`` texts is one
    block; a larger one is dealt into blocks that meet pair by pair.
    """
    exact = Fraction(str(threshold))
    sizes = stage(members.groupBy(F.col("root").alias("k")).agg(F.count(F.lit(1)).alias("n")), "join-sizes")
    sets = member_sets(docs, text_col, width, members)
    rows = members.withColumnRenamed("v", "mv").join(sets, F.col("mv") == F.col("v")).select(F.col("root").alias("node"), "v", "copies", "set")
    dealt = blocks(rows, sizes, BLOCK).select(F.xxhash64("node", "pair.lo", "pair.hi").alias("block"), "own", (F.col("pair.lo") < F.col("pair.hi")).alias("cross"), "v", "copies", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "block", 1024):
            block, own, v, copies = (np.asarray(t.column(c)) for c in ("block", "own", "v", "copies"))
            cross = np.asarray(t.column("cross"))
            sets = [np.frombuffer(x, U) for x in t.column("set").to_pylist()]
            edges = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True])))
            links, root = np.zeros(len(v), np.int64), v.copy()
            for i, j in zip(edges[:-1], edges[1:]):
                if j - i < 2:
                    continue
                like = similar_pairs(sets[i:j], exact)
                np.fill_diagonal(like, False)
                if cross[i]:
                    like &= own[i:j, None] != own[None, i:j]
                links[i:j] = like @ copies[i:j]
                a, b = np.nonzero(np.triu(like))
                root[i:j] = v[i:j][roots_of(j - i, a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(links), pa.array(root)], names=["v", "links", "root"])

    return dealt.repartition("block").sortWithinPartitions("block", "v").mapInArrow(run, "v long, links long, root long")


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                       threshold: float = 0.8, recall: float = 0.999) -> tuple[DataFrame, DataFrame]:
    """Rows (id, v) and vertices (v, class_id, n_links, win_v, win_id) of the similarity join.

    Rows with one word sequence are one vertex.  The vertex table has those that
    are linked or have copies; any other row is alone.
    """
    rows = stage(describe(docs, id_col, text_col, width, threshold, runs_for(recall)), "join-rows")
    spread = rows.filter("n_words > 0").groupBy("v").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"))).alias("least"))
    spread = stage(spread, "join-spread")
    loose = components(candidate_links(rows, threshold, recall))
    members = stage(loose.join(spread.select(F.col("v").alias("sv"), "copies"), F.col("v") == F.col("sv")).select("v", "root", "copies"), "join-members")
    exact = stage(exact_links(docs, text_col, width, members, threshold), "join-exact")
    classes = components(exact.selectExpr("root AS a", "v AS b"))
    degree = exact.groupBy(F.col("v").alias("dv")).agg(F.sum("links").alias("links"))
    marked = spread.join(classes.withColumnRenamed("v", "cv"), F.col("v") == F.col("cv"), "left").join(degree, F.col("v") == F.col("dv"), "left") \
        .filter("cv IS NOT NULL OR copies > 1") \
        .select("v", F.coalesce("root", "v").alias("root"), "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    marked = stage(marked, "join-marked")
    best = stage(marked.groupBy(F.col("root").alias("r")).agg(F.min(F.struct("least", "v")).alias("best")), "join-best")
    vertices = marked.join(best, F.col("root") == F.col("r")).select(
        "v", F.col("best.least.id").alias("class_id"), "n_links", F.col("best.v").alias("win_v"))
    return rows.select("id", "v", "n_words"), stage(vertices, "join-vertices-out")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                 threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One row (id, class_id, n_links, kept) per row of ``docs``.

    Rows are linked when the Jaccard similarity of their sets of five-word
    shingles is at least ``threshold``; ``n_links`` counts the other rows linked
    to a row, copies included, and ``class_id`` is the smallest id of the
    connected class.  ``kept``: the row carries the class id and the text of it.

    * Null, empty and wordless texts are alone: class of their own id, no link.
    * A text of fewer words than a shingle is one shingle of all its words.
    * Null ids come last in a class; rows that repeat id and text are one
      document and share ``kept``.
    * An empty table gives an empty result.
    * ``recall`` is the chance, per pair at the threshold, of being found; more
      similar pairs are found more surely.  Sets are compared by 64-bit hashes.
    """
    rows, vertices = similarity_classes(docs, id_col, text_col, width, threshold, recall)
    placed = rows.join(vertices.withColumnRenamed("v", "pv"), (F.col("v") == F.col("pv")) & (F.col("n_words") > 0), "left")
    alone = F.col("pv").isNull()
    return placed.select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | ((F.col("v") == F.col("win_v")) & F.col("id").eqNullSafe(F.col("class_id")))).alias("kept"))


@own_names
def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
             threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """``docs`` with one document of each class of ``jaccard_join``: the one with the smallest id.

    All columns of ``docs`` come back as they were, whatever their names.
    """
    _, vertices = similarity_classes(docs, id_col, text_col, width, threshold, recall)
    names = docs.columns
    rows = docs.withColumn("__t", F.col(f"`{text_col}`").cast("binary"))
    schema = T.StructType([*docs.schema.fields, T.StructField("__v", T.LongType()), T.StructField("__n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts = b.column("__t").to_pylist()
            for i, j in slices(texts):
                w = Words(texts[i:j])
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(i, j - i) for c in names], _long(vertex_ids(w)), pa.array(w.counts().astype(np.int64))],
                                                 names=[*names, "__v", "__n"])

    marked = rows.mapInArrow(run, schema)
    lost = vertices.select(F.col("v").alias("__lv"), F.col("class_id").alias("__win"), F.col("win_v").alias("__wv"))
    mine = (F.col("__v") == F.col("__lv")) & (F.col("__n") > 0) & ~((F.col("__lv") == F.col("__wv")) & F.col(f"`{id_col}`").eqNullSafe(F.col("__win")))
    return marked.join(lost, mine, "left_anti").select(*[F.col(f"`{c}`") for c in names])

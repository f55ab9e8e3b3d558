"""Sampled SentencePiece segmentations: forward filtering, backward sampling.

A text is a lattice of vocabulary pieces.  The forward pass sums the weights of
all segmentations up to each position; the backward pass draws, from the end,
one piece after another in proportion to the weight of all segmentations that
lead to it.  So a segmentation comes up in proportion to the product of its
piece weights, and the draws are hashes of the row key, which makes them
reproducible wherever and whenever the row is encoded.

No piece of the vocabulary runs from a word into the following space or across
a line break, so a text's lattice is a chain of small ones, one per chunk
(spaces and the word after them).  Chunks repeat a lot: a worker keeps the
filtered lattices of short ones in arrays of a fixed size and draws for all
chunks of many texts at once.  When the arrays fill up, the chunks that were
used least go, and the counts of the others are halved.  Draw limits are whole
numbers of 2^-32, so what is kept has no influence on what is drawn.

A vocabulary file may hold merge ranks instead of log probabilities.  The weight
of a piece of rank r is (1 + r) ^ -alpha, a Zipf law on the rank; alpha sharpens
or flattens it.  A character outside the vocabulary becomes its UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, without
from .words import U, give_back, mix, slices, small

ARCS = 5 << 19                   # kept per worker while a task runs: 26 MB in arrays of a fixed size
CHUNKS = 1 << 17                # kept per worker while a task runs: names and places, about 20 MB
SHORT = 64                      # longer chunks are filtered each time they occur, one character after another
LEARN = 1 << 15                 # characters whose lattices are filtered at once
FALLBACK = 1e-6                  # weight of a character's bytes against the rarest piece
SLICE = 1 << 18


ONE = 1 << 32                    # a draw limit of 1


class Lattices:
    """Filtered lattices of many chunks one behind the other.

    A chunk has one node per character; ``first`` is the first arc of each node,
    ``upto`` the greatest 32-bit draw that takes an arc, ``piece`` its piece.
    With sizes given the arrays have them from the start and never grow; with
    ``arcs`` 0 they grow as needed and live for one call.
    """

    GROW = {"upto": "n_arcs", "piece": "n_arcs", "first": "n_nodes", "lengths": "n_chunks", "nodes": "n_chunks", "uses": "n_chunks"}

    def __init__(self, arcs: int, chunks: int):
        self.fixed = arcs > 0
        self.upto, self.piece, self.first = np.zeros(arcs, np.uint32), np.zeros(arcs, np.int32), np.zeros(arcs // 2 + 1, np.int32)
        self.lengths, self.nodes, self.uses = (np.zeros(chunks, np.int32) for _ in range(3))
        self.n_arcs = self.n_chunks = self.n_nodes = 0

    def full(self) -> bool:
        return any(8 * getattr(self, n) > 7 * len(getattr(self, name)) for name, n in self.GROW.items())

    def add(self, first: np.ndarray, upto: np.ndarray, piece: np.ndarray, lengths: np.ndarray) -> int | None:
        """The number of the first of some new chunks, or None where the fixed arrays have no room."""
        a, n, c = self.n_arcs + len(upto), self.n_nodes + len(first), self.n_chunks + len(lengths)
        for name, need in (("upto", a), ("piece", a), ("first", n + 1), ("lengths", c), ("nodes", c), ("uses", c)):
            if need > len(old := getattr(self, name)):
                if self.fixed:
                    return None
                setattr(self, name, np.concatenate((old, np.zeros(max(len(old), need), old.dtype))))
        start, at = self.n_chunks, slice(self.n_chunks, c)
        self.lengths[at], self.nodes[at], self.uses[at] = lengths, self.n_nodes + np.cumsum(lengths) - lengths, 0
        self.first[self.n_nodes:n] = first + self.n_arcs
        self.first[n] = a
        self.upto[self.n_arcs:a], self.piece[self.n_arcs:a] = upto, piece
        self.n_arcs, self.n_nodes, self.n_chunks = a, n, c
        return start

    def shrink(self) -> np.ndarray:
        """Keep the chunks that were used most, up to five eighths of the room; their new numbers, -1 for those that go."""
        n = self.n_chunks
        order = np.argsort(-self.uses[:n], kind="stable")
        nodes, lengths = self.nodes[:n].astype(np.int64), self.lengths[:n].astype(np.int64)
        arcs = self.first[nodes + lengths] - self.first[nodes]
        room = min(int(np.searchsorted(np.cumsum(arcs[order]), 5 * len(self.upto) // 8, side="right")),
                   int(np.searchsorted(np.cumsum(lengths[order]), 5 * len(self.first) // 8, side="right")), 5 * len(self.lengths) // 8)
        stay = np.sort(order[:room])
        number = np.full(n, -1, np.int64)
        number[stay] = np.arange(room)
        arcs, lengths, nodes = arcs[stay], lengths[stay], nodes[stay]
        at = np.repeat(nodes - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))
        begin = self.first[nodes]
        shift = np.cumsum(arcs) - arcs - begin
        first = self.first[at] + np.repeat(shift, lengths)
        from_ = np.repeat(begin - np.cumsum(arcs) + arcs, arcs) + np.arange(int(arcs.sum()))
        upto, piece, uses = self.upto[from_], self.piece[from_], self.uses[stay] // 2
        self.n_arcs = self.n_chunks = self.n_nodes = 0
        self.add(first, upto, piece, lengths)
        self.uses[:room] = uses
        return number

    def draw(self, kind: np.ndarray, key: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """How many pieces each occurrence of a chunk draws; and for each step from the back which occurrences draw what.

        ``span``: characters of each piece; beyond its end, of one character outside the vocabulary.
        """
        live, steps, total = np.arange(len(kind)), [], np.zeros(len(kind), np.int64)
        left, base = self.lengths[kind], self.nodes[kind] - 1
        while len(live):
            at, u = self.first[base + left], (mix(key[live] + U(len(steps))) >> U(32)).astype(np.uint32)
            beyond = np.flatnonzero(u > self.upto[at])
            while len(beyond):
                at[beyond] += 1
                beyond = beyond[u[beyond] > self.upto[at[beyond]]]
            piece = self.piece[at]
            steps.append((live, piece))
            left = left - span[np.minimum(piece, len(span) - 1)]
            on = left > 0
            total[live[~on]] = len(steps)
            live, left, base = live[on], left[on], base[on]
        return total, steps


class Steps:
    """A map from 64-bit keys to numbers as an open table, for many look-ups at once; -1 for an absent key."""

    def __init__(self, of: dict[int, int]):
        size = 1 << (4 * len(of)).bit_length()
        self.shift, self.mask = U(64 - size.bit_length() + 1), size - 1
        self.keys, self.to = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        keys, to = np.fromiter(of, np.int64, len(of)), np.fromiter(of.values(), np.int64, len(of))
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            slot, one = np.unique(at[free], return_index=True)
            self.keys[slot], self.to[slot] = keys[free[one]], to[free[one]]
            rest = np.ones(len(keys), bool)
            rest[free[one]] = False
            keys, to, at = keys[rest], to[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(U) * U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        got = self.keys[at]
        out = np.where(got == keys, self.to[at], -1)
        look = np.flatnonzero((got != keys) & (got >= 0))
        while len(look):
            at[look] = (at[look] + 1) & self.mask
            got = self.keys[at[look]]
            hit = got == keys[look]
            out[look[hit]] = self.to[at[look[hit]]]
            look = look[~hit & (got >= 0)]
        return out


class Numbers(dict):
    """The numbers of the kept chunks; others are numbered downwards from -1 in ``fresh``."""

    fresh: dict[str, int]

    def __missing__(self, chunk: str) -> int:
        return self.fresh.setdefault(chunk, -1 - len(self.fresh))


class Pieces:
    """The pieces of a model file, and sampling and decoding with them."""

    def __init__(self, path: str, alpha: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.weight: dict[str, tuple[int, float]] = {}
        self.raw: list[bytes] = [b""] * self.size
        byte_of = {}
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_of[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace("▁", " ")
                self.weight[text] = (i, (1.0 - min(model.get_score(i), 0.0)) ** -alpha)
                self.raw[i] = text.encode("utf-8")
        if len(byte_of) < 256:
            raise ValueError("the model has no byte pieces, so encoding would lose text")
        self.byte_ids = np.array([byte_of[b] for b in range(256)], np.int32)
        self.longest = max(map(len, self.weight))
        self.fallback = min(w for _, w in self.weight.values()) * FALLBACK
        chain = not any("\n" in p or re.search("[^ ] ", p) for p in self.weight)
        self.chunks = re.compile(r" *[^ \n]+| +|\n" if chain else r"(?s).+").findall
        self._index()
        self._forget()

    def _forget(self) -> None:
        self.known = Numbers()
        self.kept = Lattices(ARCS, CHUNKS)

    def _index(self) -> None:
        """The vocabulary as steps (prefix, next character) -> longer prefix, for walks over many starts at once."""
        place, steps = {"": 0}, {}
        for text in sorted(self.weight):
            for k in range(1, len(text) + 1):
                if (head := text[:k]) not in place:
                    place[head] = len(place)
                    steps[place[head[:-1]] << 21 | ord(head[-1])] = place[head]
        self.walk = Steps(steps)
        self.ends_piece, self.ends_log = np.full(len(place), -1, np.int64), np.zeros(len(place))
        for text, (i, w) in self.weight.items():
            self.ends_piece[place[text]], self.ends_log[place[text]] = i, np.log(w)
        self.span = np.ones(self.size + 1, np.int32)
        self.span[[i for i, _ in self.weight.values()]] = list(map(len, self.weight))

    def arcs(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All arcs of the chunks' lattices by node: first arc of each node, greatest draw, piece; and characters per chunk.

        Node k is the k-th character of all chunks; its arcs are the pieces that
        end there, the longest first.  They share the 32-bit draws in proportion
        to the weight of all segmentations that reach the node by that piece; an
        arc without a draw is left out.
        """
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        close = np.repeat(np.cumsum(lengths), lengths)              # end of the chunk that a character is in
        live, state = np.arange(len(points)), np.zeros(len(points), np.int64)
        starts, spans, ids, logs = [], [], [], []
        for k in range(1, self.longest + 1):
            inside = live + k <= close[live]
            live, state = live[inside], state[inside]
            to = self.walk.find(state << 21 | points[live + k - 1])
            on = to >= 0
            live, state = live[on], to[on]
            ends = self.ends_piece[state] >= 0
            if k == 1:
                single = np.zeros(len(points), bool)
                single[live[ends]] = True
            starts.append(live[ends])
            spans.append(np.full(int(ends.sum()), k))
            ids.append(self.ends_piece[state[ends]])
            logs.append(self.ends_log[state[ends]])
        other = np.flatnonzero(~single)
        starts.append(other)
        spans.append(np.ones(len(other), np.int64))
        ids.append(self.size + points[other])
        logs.append(np.full(len(other), np.log(self.fallback)))
        start, span, piece, weight = map(np.concatenate, (starts, spans, ids, logs))
        node = start + span - 1
        owner = np.repeat(np.arange(len(chunks)), lengths)
        depth = (np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[node]
        order = np.argsort((depth * len(points) + node) * (self.longest + 1) - span)            # the keys are distinct, so any sort gives one order
        source, goal, weight = (start + owner[start])[order], (node + owner[node] + 1)[order], weight[order]
        reach, share = np.zeros(len(points) + len(chunks)), np.empty(len(start))   # one more place per chunk, for its beginning
        edges = np.concatenate(([0], np.cumsum(np.bincount(depth)))).tolist()
        for i, j in zip(edges[:-1], edges[1:]):                     # one character further in every chunk at once
            total, n = reach[source[i:j]] + weight[i:j], goal[i:j]
            heads = np.flatnonzero(np.concatenate(([True], n[1:] != n[:-1])))
            size = np.diff(np.append(heads, j - i))
            top = np.maximum.reduceat(total, heads)
            part = np.exp(total - np.repeat(top, size))
            sums = np.add.reduceat(part, heads)
            share[i:j] = part / np.repeat(sums, size)
            reach[n[heads]] = top + np.log(sums)
        width = np.empty(len(start), np.int64)
        width[order] = share * ONE
        order = np.argsort(node * (self.longest + 1) - span)
        node, limit = node[order], np.cumsum(width[order])
        last = np.concatenate((node[1:] != node[:-1], [True]))
        limit -= np.concatenate(([0], limit[last]))[np.cumsum(last) - last]
        limit[last] = ONE
        wide = np.concatenate(([0], limit[:-1]))
        wide[np.concatenate(([True], last[:-1]))] = 0
        wide = limit > wide
        return np.searchsorted(node[wide], np.arange(len(points))), (limit[wide] - 1).astype(np.uint32), piece[order][wide].astype(np.int32), lengths

    def long_arcs(self, chunk: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What :meth:`arcs` gives, for one chunk, character by character."""
        firsts, uptos, ids, ends = array("q"), array("I"), array("i"), [[] for _ in range(self.longest)]
        reach, n = [0.0], len(chunk)
        for k in range(n):
            heads = [c for c in ends[k % self.longest]]                      # pieces that end behind character k, as (start, id, log weight)
            ends[k % self.longest] = []
            for m in range(1, min(self.longest, n - k) + 1):
                if piece := self.weight.get(chunk[k:k + m]):
                    arc = (k, piece[0], log(piece[1]))
                    (heads if m == 1 else ends[(k + m - 1) % self.longest]).append(arc)
            if not any(s == k for s, _, _ in heads):
                heads.append((k, self.size + ord(chunk[k]), log(self.fallback)))
            heads.sort()
            totals = [reach[s] + w for s, _, w in heads]
            top = max(totals)
            parts = [exp(t - top) for t in totals]
            whole, limit = sum(parts), 0
            reach.append(top + log(whole))
            firsts.append(len(uptos))
            for j, ((_, i, _), part) in enumerate(zip(heads, parts)):
                before, limit = limit, ONE if j == len(heads) - 1 else limit + int(part / whole * ONE)
                if limit > before:
                    uptos.append(limit - 1)
                    ids.append(i)
        return np.array(firsts, np.int64), np.array(uptos, np.uint32), np.array(ids, np.int32), np.array([n], np.int64)

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, Lattices]:
        """Filter new chunks: which of them are kept under what number, and the lattices of the others for this call."""
        number, rest, done = np.full(len(chunks), -1, np.int64), Lattices(0, 0), 0
        short = [i for i, c in enumerate(chunks) if len(c) <= SHORT]
        while done < len(short):
            stop, size = done, 0
            while stop < len(short) and size < LEARN:
                size += len(chunks[short[stop]])
                stop += 1
            own = np.array(short[done:stop])
            made = self.arcs([chunks[i] for i in own])
            if (first := self.kept.add(*made)) is None:
                number[own] = -1 - rest.add(*made) - np.arange(len(own))
            else:
                number[own] = first + np.arange(len(own))
                self.known.update(zip([chunks[i] for i in own], range(first, first + len(own))))
            done = stop
        for i, c in enumerate(chunks):
            if len(c) > SHORT:
                number[i] = -1 - rest.add(*self.long_arcs(c))
        return number, rest

    def sample(self, texts: list[str], seeds: np.ndarray) -> list[np.ndarray]:
        """Piece ids of each text, one sampled segmentation, drawn from its 64-bit seed.

        The text is encoded behind one space, as the format has it; an empty
        text has no pieces.
        """
        if self.kept.full():
            stay = self.kept.shrink()
            self.known = Numbers((c, k) for c, k in zip(self.known, stay[np.fromiter(self.known.values(), np.int64, len(self.known))].tolist()) if k >= 0)
        counts, kinds, number_of = [], [], self.known.__getitem__
        self.known.fresh = fresh = {}
        for t in texts:
            parts = self.chunks(" " + t) if t else []
            counts.append(len(parts))
            kinds += map(number_of, parts)
        n = np.array(counts, np.int64)
        if not kinds:
            return [np.zeros(0, np.int32) for _ in texts]
        kind, rest = np.array(kinds, np.int64), Lattices(0, 0)
        if fresh:
            number, rest = self._learn(list(fresh))
            new = kind < 0
            kind[new] = number[-1 - kind[new]]
        owner = np.repeat(np.arange(len(texts)), n)
        place = np.arange(len(kind)) - np.repeat(np.cumsum(n) - n, n)
        key = mix(mix(seeds)[owner] + mix(place.astype(U)))
        total, drawn = np.zeros(len(kind), np.int64), []
        for lattices, own, numbers in ((self.kept, kind >= 0, kind), (rest, kind < 0, -1 - kind)):
            if len(own := np.flatnonzero(own)):
                total[own], steps = lattices.draw(numbers[own], key[own], self.span)
                drawn.append((own, steps))
                lattices.uses += np.bincount(numbers[own], minlength=len(lattices.uses)).astype(np.int32)
        # pieces came from the back of each chunk: the one drawn at step s is s places from its end
        ends = np.cumsum(total)
        ids = np.empty(int(ends[-1]), np.int64)
        for own, steps in drawn:
            back = ends[own] - 1
            for s, (w, x) in enumerate(steps):
                ids[back[w] - s] = x
        firsts = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n)))]
        out = [ids[a:b] for a, b in zip(firsts[:-1], firsts[1:])]
        return [self._bytes_for_unknown(x) for x in out]

    def _bytes_for_unknown(self, ids: np.ndarray) -> np.ndarray:
        if not (unknown := ids >= self.size).any():
            return ids.astype(np.int32)
        parts, done = [], 0
        for i in np.flatnonzero(unknown):
            parts += [ids[done:i].astype(np.int32), self.byte_ids[list(chr(int(ids[i]) - self.size).encode("utf-8"))]]
            done = i + 1
        return np.concatenate([*parts, ids[done:].astype(np.int32)])

    def decode(self, ids: np.ndarray) -> str:
        """The text that was encoded: the pieces joined, without the leading space."""
        return b"".join(map(self.raw.__getitem__, ids.tolist()))[1:].decode("utf-8")


_LOADED: dict[tuple[str, float], Pieces] = {}


def pieces(path: str, alpha: float) -> Pieces:
    """The pieces of this worker; the file is read once per worker."""
    if (path, alpha) not in _LOADED:
        _LOADED[path, alpha] = Pieces(path, alpha)
    return _LOADED[path, alpha]


def ended(p: Pieces) -> None:
    """At the end of a task a worker gives up what it kept: it may stay idle, beside workers of other stages."""
    p._forget()
    give_back()


def row_seed(key_col: str, seed: int):
    return F.xxhash64(F.coalesce(F.col(f"`{key_col}`").cast("string"), F.lit("")), F.lit(seed))


def encode_sampled(docs: DataFrame, model: str, key_col: str = "doc_id", text_col: str = "text", alpha: float = 1.0, seed: int = 0,
                   columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all) plus ``pieces`` (array<int>): one sampled segmentation of each row's whole text.

    ``model`` names a SentencePiece file that every worker can open.  The draw
    depends on the row key, the text and ``seed`` only: rows that repeat get the
    same pieces.  Null text gives null pieces, empty text none.  A null key
    counts as an empty one.  An empty table gives an empty result; an input
    column named ``pieces`` is replaced.
    """
    keep = without(docs.select(*[F.col(f"`{c}`") for c in columns]) if columns is not None else docs, ["pieces"])
    names = keep.columns
    key, text = fresh([*names, "pieces"], "row_seed", "whole_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in names], row_seed(key_col, seed).alias(key), F.col(f"`{text_col}`").alias(text))
    schema = T.StructType([*keep.schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model, alpha)
        for b in small(batches):
            texts, seeds = b.column(text).to_pylist(), np.asarray(b.column(key)).view(U)
            for i, j in slices(texts, SLICE):
                got = p.sample([t or "" for t in texts[i:j]], seeds[i:j])
                made = pa.array([None if t is None else x for t, x in zip(texts[i:j], got)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(i, j - i) for c in names], made], names=[*names, "pieces"])
        ended(p)

    return rows.mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, model: str, pieces_col: str = "pieces", out_col: str = "text") -> DataFrame:
    """Every row of ``encoded`` plus ``out_col``: the text of its pieces (null for null)."""
    keep = without(encoded, [out_col])
    names = keep.columns
    (ids,) = fresh([*names, out_col], "piece_ids")
    rows = encoded.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{pieces_col}`").alias(ids))
    schema = T.StructType([*keep.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model, 1.0)
        for b in small(batches):
            texts = [None if x is None else p.decode(np.array(x, np.int64)) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, out_col])

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str, key_col: str = "doc_id", text_col: str = "text", alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """(key, n_pieces, pieces_sha256, decoded_sha256, lossless): encode each whole text, decode it, compare.

    ``pieces_sha256`` is over the ids as little-endian 32-bit integers.  Null
    text has 0 pieces, decodes to null (digest null) and counts as lossless.
    """
    rows = docs.select(F.col(f"`{key_col}`").alias("key"), row_seed(key_col, seed).alias("seed"), F.col(f"`{text_col}`").alias("t"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model, alpha)
        for b in small(batches):
            texts, seeds = b.column("t").to_pylist(), np.asarray(b.column("seed")).view(U)
            for i, j in slices(texts, SLICE):
                part = texts[i:j]
                ids = p.sample([t or "" for t in part], seeds[i:j])
                back = [None if t is None else p.decode(x) for t, x in zip(part, ids)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").slice(i, j - i), pa.array([len(x) for x in ids], pa.int64()), pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids]),
                     pa.array([None if t is None else hashlib.sha256(t.encode("utf-8")).hexdigest() for t in back], pa.string()),
                     pa.array([t == x for t, x in zip(part, back)])], names=["key", "n_pieces", "pieces_sha256", "decoded_sha256", "lossless"])
        ended(p)

    return rows.mapInArrow(run, f"key {kind}, n_pieces long, pieces_sha256 string, decoded_sha256 string, lossless boolean").withColumnRenamed("key", key_col)

"""Count byte-level BPE tokens: heap-and-linked-list merging, no ids emitted.

Each pre-token is a linked list of byte symbols with a heap of adjacent pairs by
rank.  The lowest pair is popped and merged until none is left; the count is
the initial symbols minus the merges.  Pre-tokens repeat a lot, so a task keeps
the counts of those it has seen, up to a fixed number.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import own_names, without
from .words import small

# Fixed values of byte-level BPE: the pre-token pattern of the vocabulary's
# format.  White space is spelt out as the Unicode property.
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
            r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CACHED = 1_000_000
CACHED_BYTES = 64               # longer pre-tokens are merged each time they occur
OUT = ["n_bytes", "n_tokens", "over_limit"]


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file:
    printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = {}, 0
    for b in range(256):
        if b in own:
            table[b] = chr(b)
        else:
            table[b], spare = chr(256 + spare), spare + 1
    return [table[b] for b in range(256)]


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges apply to ``symbols``, the lowest rank first, leftmost on ties."""
    n = len(symbols)
    text: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, text[i], text[i + 1]) for i in range(n - 1) if (r := ranks.get((text[i], text[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if j >= n or text[i] != a or text[j] != b:
            continue                                # one side has been merged since
        text[i], text[j] = a + b, None
        after[i] = k = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if (r := ranks.get((text[i], text[k]))) is not None:
                heapq.heappush(heap, (r, i, text[i], text[k]))
        if (h := before[i]) >= 0 and (r := ranks.get((text[h], text[i]))) is not None:
            heapq.heappush(heap, (r, h, text[h], text[i]))
    return merges


class Counter:
    """Token counts by one vocabulary file in the JSON format of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = (tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"])
        self.ranks = {p: i for i, p in enumerate(pairs)}
        self.symbols = _byte_symbols()
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.find = regex.compile(PRETOKEN).findall
        self.seen: dict[str, int] = {}

    def piece(self, token: str) -> int:
        raw = token.encode("utf-8")
        if (n := len(raw)) > 1:
            n -= merge_count([self.symbols[b] for b in raw], self.ranks)
        if len(raw) <= CACHED_BYTES:
            if len(self.seen) >= CACHED:
                self.seen.clear()
            self.seen[token] = n
        return n

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        total, seen = len(parts) - 1, self.seen.get
        for part in parts:
            for token in self.find(part):
                n = seen(token)
                total += self.piece(token) if n is None else n
        return total


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of this worker; the vocabulary is read once per worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


@own_names
def count_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text", limit: int = 1024, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all but the text) plus ``n_bytes, n_tokens, over_limit``.

    ``vocabulary`` names a byte-level BPE file in JSON form that every worker can
    open.  Strings of its special tokens count one token where they stand.  Null
    text counts as empty: 0 bytes, 0 tokens.  Whole texts are counted.  An empty
    table gives an empty result; an input column named like an output column is
    replaced, any other comes back as it was.
    """
    keep = without(docs.select(*[F.col(f"`{c}`") for c in columns]) if columns is not None else docs.drop(text_col), OUT)
    kept = keep.columns
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("__text"))
    schema = T.StructType([*keep.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for b in small(batches):
            texts = [t or "" for t in b.column("__text").to_pylist()]
            n = [c.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in kept], pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], names=[*kept, *OUT])

    return rows.mapInArrow(run, schema)

"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

A row's global number (its position in a total order) is permuted over
``[0, n)`` by a keyed Feistel network on the next even number of bits, with
cycle walking: a value that falls outside ``[0, n)`` is permuted again until it
is inside.  Shard and slot follow from the result alone, so either can be
computed for a single row, and the row at a slot can be computed back.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import number_rows, own_names, stage, without
from .words import U, mix, stream

ROUNDS = 6


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
    mask = U((1 << half) - 1)
    left, right = x >> U(half), x & mask
    for k in keys:
        left, right = right, left ^ (mix(right + k) & mask)
    return (right << U(half)) | left


def permute(rows: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """Image of each row number in ``[0, n)`` under the permutation (``back``: its inverse)."""
    keys = stream(seed, ROUNDS)
    half = _half_bits(n)
    # the last round leaves the halves swapped, so the same network with its keys reversed undoes it
    keys = keys[::-1] if back else keys
    x = _network(np.asarray(rows, dtype=U), half, keys)
    while (far := x >= U(n)).any():
        x[far] = _network(x[far], half, keys)
    return x.astype(np.int64)


def locate(row: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of the row with that global number."""
    p = int(permute(np.array([row]), n, seed)[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """Global number of the row at that shard and slot."""
    return int(permute(np.array([slot * shards + shard]), n, seed, back=True)[0])


@own_names
def shard_rows(docs: DataFrame, order: list[str], shards: int = 8, seed: int = 17) -> DataFrame:
    """Every row of ``docs`` plus ``row_number, shard, slot``.

    ``row_number`` is the row's 0-based position in the total order ``order``
    (nulls first).  Shards get row counts at most one apart, and slots run from
    0 without a gap.  Rows that tie in every order column are alike and take the
    places of their class in any order.  An empty table gives an empty result;
    an input column named like an output column is replaced, unless it is in
    ``order``, which raises ValueError; any other column comes back as it was.
    """
    made = ["row_number", "shard", "slot"]
    if clash := [c for c in order if c.lower() in made]:
        raise ValueError(f"order columns {clash} are also outputs")
    numbered = number_rows(stage(without(docs, made), "shard-rows"), order, "row_number", "shard-order")
    n = max(1, numbered.count())

    @F.pandas_udf("long")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), n, seed))

    return (numbered.withColumn("__p", place("row_number"))
            .withColumn("shard", F.pmod("__p", F.lit(shards)).cast("int"))
            .withColumn("slot", F.floor(F.col("__p") / F.lit(shards)).cast("long")).drop("__p"))

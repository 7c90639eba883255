"""Fixed-size tables (counters, Bloom filters) that every task fills and that are added up block by block."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 16
CellsOf = Callable[[pa.RecordBatch], Iterator[np.ndarray]]


def _summed(df: DataFrame, cells: int, cells_of: CellsOf, flags: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(first cell, block) of the table: how often ``cells_of`` names each cell, or whether it does (``flags``, packed)."""
    block = min(BLOCK, cells)
    read = lambda raw: np.frombuffer(raw, dtype=np.uint8 if flags else np.uint32)

    def rows(found: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for k, part in found:
            yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int64()), "cells": pa.array([part.tobytes()], pa.binary())})

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(cells, dtype=np.uint8 if flags else np.int64)
        for batch in batches:
            for found in cells_of(batch):
                if flags:
                    table[found] = 1
                else:
                    np.add.at(table, found, 1)
        for k in range(0, cells, block):
            part = table[k : k + block]
            if part.any():
                yield from rows(iter([(k, np.packbits(part) if flags else np.minimum(part, 0xFFFFFFFF).astype(np.uint32))]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch["block"].to_pylist(), batch["cells"].to_pylist(), strict=True):
                part = read(raw) if flags else read(raw).astype(np.int64)
                total[k] = part if k not in total else total[k] | part if flags else total[k] + part
        yield from rows((k, part if flags else np.minimum(part, 0xFFFFFFFF).astype(np.uint32)) for k, part in total.items())

    schema = "block long, cells binary"
    sums = df.mapInArrow(fill, schema).repartition("block").mapInArrow(add, schema)
    for row in sums.collect():
        yield row["block"], read(bytes(row["cells"]))


def folded(df: DataFrame, cells: int, cells_of: CellsOf) -> np.ndarray:
    """How often ``cells_of`` names each cell over all batches of ``df``: ``cells`` counters, at most 2**32 - 1.

    Tasks send their counters in blocks; adding up streams over the blocks, so memory is that of the table,
    whatever the number of tasks. The table, whose size does not grow with the input, comes to the driver.
    """
    out = np.zeros(cells, dtype=np.uint32)
    for k, part in _summed(df, cells, cells_of, flags=False):
        out[k : k + len(part)] = part
    return out


@dataclass(frozen=True)
class Bloom:
    """A Bloom filter of ``cells`` bits (a power of two) over 64-bit keys."""

    bits: np.ndarray
    cells: int
    probes: int = 3

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """Which ``keys`` may be among those of the filter; none of those is False."""
        found = np.ones(len(keys), dtype=bool)
        for i in range(self.probes):
            at = np.flatnonzero(found)
            cell = _cell(keys[at], i, self.cells)
            found[at] = (self.bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1
        return found


def _cell(keys: np.ndarray, probe: int, cells: int) -> np.ndarray:
    low, high = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    return ((low + np.uint64(probe) * high) & np.uint64(cells - 1)).astype(np.int64)


def bloom_size(n_keys: int, bits_per_key: int = 16, smallest: int = 1 << 16, largest: int = 1 << 24) -> int:
    """Cells for ``n_keys``, a power of two up to ``largest``; beyond that more keys pass, none is lost."""
    cells = smallest
    while cells < largest and cells < n_keys * bits_per_key:
        cells *= 2
    return cells


def bloom_of(keys: DataFrame, bits_per_key: int = 16) -> Bloom:
    """The filter of the only column of ``keys``, a long: at most 2 MB, whatever the number of keys."""
    name = keys.columns[0]
    empty = Bloom(np.zeros(0, np.uint8), bloom_size(keys.count(), bits_per_key))

    def cells_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        own = batch[name].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        yield from (_cell(own, i, empty.cells) for i in range(empty.probes))

    bits = np.zeros(empty.cells // 8, dtype=np.uint8)
    for k, part in _summed(keys, empty.cells, cells_of, flags=True):
        bits[k // 8 : k // 8 + len(part)] = part
    return Bloom(bits, empty.cells)


def parted(df: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key``, a long, may be in ``keys``; all others, for certain).

    The others need no join with ``keys`` and so no shuffle; the first are to be joined for the exact answer.
    """
    shared = df.sparkSession.sparkContext.broadcast(bloom_of(keys))

    @F.pandas_udf("boolean")
    def may_hold(own: pd.Series) -> pd.Series:
        return pd.Series(shared.value.may_hold(own.to_numpy(dtype=np.int64).view(np.uint64)))

    return df.where(may_hold(key)), df.where(~may_hold(key))

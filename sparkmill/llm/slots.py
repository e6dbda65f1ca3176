"""Small tables of fixed size, from any number of keys, that tasks can carry.

A key falls into one of 2**22 slots.  A slot's byte says something about its keys: that
there is one (``members``), or a rank.  The table is 4 MB whatever the data; it is
gathered as packed slices and only ever spares work: what it lets through is
checked exactly afterwards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.llm.store import give_back

BITS, _SLICE = 22, 12


def table(values: DataFrame) -> np.ndarray:
    """2**22 bytes from rows (slot long, value int), distinct slots, values 0..255."""
    def pack(group: pd.DataFrame) -> pd.DataFrame:  # at most 2**12 rows
        part = np.zeros(1 << _SLICE, dtype=np.uint8)
        part[group["slot"].to_numpy(dtype=np.int64) & ((1 << _SLICE) - 1)] = group["value"].to_numpy(dtype=np.int64)
        return pd.DataFrame({"slice": [int(group["slot"].iloc[0]) >> _SLICE], "packed": [part.tobytes()]})

    out = np.zeros((1 << (BITS - _SLICE), 1 << _SLICE), dtype=np.uint8)
    for r in values.groupBy(F.shiftright("slot", _SLICE).alias("at")).applyInPandas(pack, "slice long, packed binary").collect():
        out[r["slice"]] = np.frombuffer(r["packed"], dtype=np.uint8)
    return out.reshape(-1)


def members(keys: DataFrame) -> np.ndarray:
    """Table of the one long column of ``keys``, whose bits must be spread evenly."""
    slot = F.shiftrightunsigned(keys.columns[0], 64 - BITS)
    return table(keys.select(slot.alias("slot"), F.lit(1).alias("value")).distinct())


def keep(found, key: str, others: bool = False):
    """mapInArrow function: the rows whose long column ``key`` may be a member of the broadcast table
    ``found``, none that is one is lost; or all ``others``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            slot = batch.column(key).to_numpy().view(np.uint64) >> np.uint64(64 - BITS)
            yield batch.filter(pa.array((found.value[slot.astype(np.int64)] > 0) != others))

    return rows


def likely(df: DataFrame, key: str, found: np.ndarray, others: bool = False) -> DataFrame:
    """Rows of ``df`` as ``keep`` gives them."""
    return df.mapInArrow(keep(df.sparkSession.sparkContext.broadcast(found), key, others), df.schema)


def apart(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the rows of ``df`` whose long column ``key`` may be among the one column of ``keys``, all others): no row of
    the second is among them, so only the first needs an exact join."""
    found = members(keys)
    return likely(df, key, found), likely(df, key, found, others=True)

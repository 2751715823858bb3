"""Bitmaps of bounded size: which hashes more than one document holds, which rows a later join needs."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.llm.shared import free_names, in_chunks, ship_code

#: Text behind one list of hashes; the number of lists follows the input.
BUCKET_BYTES = 16 << 20
#: The bitmap has 2**28 bits at most (32 MB).
MOST_BITS = 28
#: Bits of the bitmap that one row brings to the driver, as Spark's function for it has them.
CELL_BITS = 15
#: Hashes that a task gathers before it sends them on.
GATHER = 1_000_000


def pack(values: np.ndarray) -> bytes:
    """Sorted 32-bit values as differences, byte planes one after the other."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def gathered(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def repeated_bitmap(
    rows: DataFrame, text: str, total: int, each: int, hashes_of: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]
) -> tuple[int, bytes]:
    """Bitmap over the leading bits of the hashes that two or more rows hold. ``hashes_of`` gives the hashes of
    a batch of rows and the number of the row of each; ``total`` is the size of all texts in bytes, ``each``
    about how many bytes there are to a hash.

    A bit may be set for a hash that only one row holds (the bitmap fills up as the corpus grows), but is never
    missing for one that two hold, so it may order and preselect, not decide.
    """
    ship_code(rows.sparkSession)
    lists = max(0, (max(1, total) // BUCKET_BYTES).bit_length())
    bits = min(MOST_BITS, max(16, (int(total) // each).bit_length() + 2))

    def send(parts):
        hashes, owner = gathered(parts)
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        group = np.cumsum(new) - 1
        many = np.zeros(group[-1] + 1, bool)
        many[group[1:][~new[1:] & (owner[1:] != owner[:-1])]] = True
        kinds = hashes[new]
        bucket = (kinds >> np.uint64(64 - lists)).astype(np.int64) if lists else np.zeros(len(kinds), np.int64)
        low = (kinds >> np.uint64(32 - lists)).astype(np.uint32)
        own, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], len(bucket))
        once = [pack(np.unique(low[a:z])) for a, z in zip(first, ends, strict=True)]
        twice = [pack(np.unique(low[a:z][many[a:z]])) for a, z in zip(first, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["bucket", "once", "twice"])

    def count(batches):
        parts, held, seen = [], 0, 0
        for batch in in_chunks(batches, text):
            hashes, owner = hashes_of(batch)
            parts.append((hashes, owner + seen))
            seen += batch.num_rows
            held += len(hashes)
            if held >= GATHER:
                yield send(parts)
                parts, held = [], 0
        if held:
            yield send(parts)

    def meet(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        once = np.concatenate([unpack(x) for x in group["once"].to_pylist()] or [np.zeros(0, np.uint32)])
        twice = [unpack(x) for x in group["twice"].to_pylist()]
        once.sort()
        low = np.unique(np.concatenate([once[1:][once[1:] == once[:-1]], *twice]))
        full = (np.uint64(key[0].as_py()) << np.uint64(32)) | low.astype(np.uint64)
        spot = np.unique(full >> np.uint64(32 + lists - bits)) if 32 + lists >= bits else np.unique(full << np.uint64(bits - 32 - lists))
        base = int(spot[0]) // 8 if len(spot) else 0
        end = int(spot[-1]) // 8 + 1 if len(spot) else 0
        cells = np.zeros((end - base) * 8, bool)
        cells[(spot - np.uint64(base * 8)).astype(np.int64)] = True
        packed = np.packbits(cells).tobytes()
        return pa.table({"base": pa.array([base], pa.int64()), "cells": pa.array([packed], pa.binary())})

    found = (
        rows.mapInArrow(count, "bucket long, once binary, twice binary")
        .groupBy("bucket")
        .applyInArrow(meet, "base long, cells binary")
    )
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    for base, cells in found.toLocalIterator():  # a piece of the bitmap for each list
        own = np.frombuffer(bytes(cells), np.uint8)
        bitmap[base : base + len(own)] |= own
    return bits, bitmap.tobytes()


def in_bitmap(hashes: np.ndarray, bits: int, cells: np.ndarray) -> np.ndarray:
    spot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (cells[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8)) & 1 > 0


def among(rows: DataFrame, key: Column, wanted: DataFrame) -> tuple[DataFrame, Broadcast]:
    """The rows whose ``key``, a 64-bit hash, may be in the one column of ``wanted``: none that is gets lost, one in 16 of the
    others passes (more once ``wanted`` outgrows the bitmap). So rows that a later join has no use for are not moved. Also the
    bitmap, to be destroyed when these rows have been written.
    """
    spark = rows.sparkSession
    ship_code(spark)
    bits = min(MOST_BITS, max(CELL_BITS, wanted.count().bit_length() + 4))
    spot = F.shiftrightunsigned(F.col(wanted.columns[0]), 64 - bits)
    spots = wanted.select(F.shiftright(spot, CELL_BITS).alias("cell"), spot.bitwiseAND((1 << CELL_BITS) - 1).alias("bit"))
    # Dealt before they are gathered: a number per wanted row moves, not a bitmap per task.
    cells = spots.repartition("cell").groupBy("cell").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    size = (1 << CELL_BITS) // 8
    for cell, found in cells.toLocalIterator():  # 4 KB a row, 32 MB in all
        bitmap[cell * size : (cell + 1) * size] = np.frombuffer(bytes(found), np.uint8)
    shipped = spark.sparkContext.broadcast(bitmap.tobytes())
    (name,) = free_names(rows, "at_key")

    def pick(batches):
        held = np.frombuffer(shipped.value, np.uint8)
        for batch in batches:
            spot = (batch.column(name).to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            kept = (held[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 > 0
            yield batch.filter(pa.array(kept)).drop_columns([name])

    return rows.withColumn(name, key).mapInArrow(pick, rows.schema), shipped

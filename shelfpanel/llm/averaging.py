"""Training on all rows of a table: shards of it train copies of one model, and Spark averages what the copies changed.

A model's numbers are a matrix of few columns. Each shard hands on the rows of the matrix that it changed, as whole multiples of
1 / ``UNIT``, so that their sums are the same in any order; a row moves by the mean of the changes of the shards that changed it.
A task reads many shards and Spark adds up their changes before the shuffle, so that a round moves one model for each core, not for
each shard.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpanel.llm.common import stored

UNIT = 1 << 30
#: Most shards of a table; larger tables have larger shards.
SHARDS = 256


def dealt(rows: DataFrame, count: int, each: int) -> DataFrame:
    """``rows`` with their ``shard`` (by the hash in column ``mix``), those of a shard in one partition: about ``each`` of ``count`` in one."""
    shards = min(max(count // each, 1), SHARDS)
    rows = rows.withColumn("shard", F.pmod(F.shiftright("mix", 16), F.lit(shards)).cast("int"))
    return rows.repartitionById(shards, F.col("shard"))


def sharded(rows: DataFrame, count: int, each: int, order: list[str]) -> DataFrame:
    """``rows`` stored with their ``shard``, each shard in order."""
    return stored(dealt(rows, count, each).sortWithinPartitions("shard", *order))


def by_core(rows: DataFrame) -> DataFrame:
    """Stored shards in as many tasks as there are cores, each shard in one piece."""
    return rows.coalesce(max(1, rows.sparkSession.sparkContext.defaultParallelism))


def runs_of(batches, size: int):
    """Slices of Arrow batches by their column ``shard`` and of about ``size`` bytes: (shard, slice), slices of a shard in a row."""
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            step = max(1, int(part.num_rows * size / max(1, part.nbytes)))
            for at in range(0, part.num_rows, step):
                yield int(shard[a]), part.slice(at, step)


def flat(arrays: list[np.ndarray], width: int) -> np.ndarray:
    """All numbers of the arrays in rows of ``width``, each array from a row of its own."""
    rows = [np.append(a.ravel(), np.zeros(-a.size % width, a.dtype)).reshape(-1, width) for a in arrays]
    return np.concatenate(rows)


def unflat(table: np.ndarray, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
    """Arrays of the given shapes from ``flat`` rows."""
    out, at = [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        rows = -(-size // table.shape[1])
        out.append(table[at : at + rows].ravel()[:size].reshape(shape).astype(np.float32))
        at += rows
    return out


def schema(width: int) -> str:
    return "place int, " + ", ".join(f"v{k} bigint" for k in range(width))


def changes(before: np.ndarray, after: np.ndarray):
    """The changed rows, as Arrow batches of ``schema``."""
    moved = np.flatnonzero((before != after).any(axis=1)).astype(np.int32)
    for at in range(0, len(moved), 1 << 15):
        own = moved[at : at + (1 << 15)]
        delta = np.rint((after[own].astype(np.float64) - before[own]) * UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own), *[pa.array(delta[:, k]) for k in range(delta.shape[1])]], ["place", *[f"v{k}" for k in range(delta.shape[1])]]
        )


def averaged(found: DataFrame, table: np.ndarray) -> np.ndarray:
    """``table`` with the mean change of each row. What comes to the driver is as large as the model."""
    names = [f"v{k}" for k in range(table.shape[1])]
    means: list[Column] = [(F.sum(c) / F.count(F.lit(1)) / F.lit(float(UNIT))).cast("float").alias(c) for c in names]
    rows = found.groupBy("place").agg(*means).toArrow()
    out, at = table.copy(), rows.column("place").to_numpy()
    for k, c in enumerate(names):
        out[at, k] += rows.column(c).to_numpy()
    return out


def most_frequent(counts: DataFrame, most: int) -> int:
    """The least ``n`` such that at most about ``most`` rows of ``counts`` have it or more, from a histogram; 0 if none has."""
    step = F.floor(F.log2("n") * 8)
    steps = counts.groupBy(step).agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("rows")).orderBy(F.desc("n")).collect()
    least, rows = 0, 0
    for row in steps:  # some 500 at most
        rows += row["rows"]
        if rows > most:
            break
        least = row["n"]
    return least

"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayworks.sources.staging import scratch_path, stage

__all__ = ["free_name", "held_out", "pieces", "row_key", "runs", "scratch_path", "stage", "table", "texts_of"]

PIECE_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: Column | str) -> Column:
    """A third of the ids, by checksum of their digits; never learned from. A null id is not held out."""
    ids = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(ids.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def row_key(id_col: str, text_col: str) -> Column:
    """Names a row by its id and text; rows that share it are equal in both. Never null."""
    return F.concat_ws(":", F.col(id_col).cast("string"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).cast("string"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def pieces(text: pa.Array, limit: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """Slices of a text column of about ``limit`` bytes each, so that working arrays stay small whatever the batch."""
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > limit:
            yield text.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(text):
        yield text.slice(start)


def texts_of(text: pa.Array) -> list[str]:
    """Python strings; a null text is empty."""
    return [t or "" for t in text.to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 1 << 14) -> Iterator[tuple[pa.Table, list[int]]]:
    """Whole groups of a partition sorted by ``keys``, several groups at a time.

    Yields a table and the row numbers at which its groups begin and end; a group that runs over several batches is put
    together first. About ``most`` rows are held, or one group if it is larger.
    """
    held: list[pa.RecordBatch] = []

    def bounds(table: pa.Table) -> list[int]:
        change = np.zeros(max(0, table.num_rows - 1), bool)
        for k in keys:
            column = table.column(k).combine_chunks()
            ahead, behind = column.slice(1), column.slice(0, len(column) - 1)
            differs = pc.fill_null(pc.not_equal(ahead, behind), False)
            half_null = pc.xor(pc.is_null(ahead), pc.is_null(behind))
            change |= pc.or_(differs, half_null).to_numpy(zero_copy_only=False)
        return [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= most:
            table = pa.Table.from_batches(held)
            at = bounds(table)
            if len(at) > 2:
                yield table.slice(0, at[-2]), at[:-1]
                held = table.slice(at[-2]).combine_chunks().to_batches()
                most = max(most, 2 * held[0].num_rows)
            else:
                most *= 2
    if held:
        table = pa.Table.from_batches(held)
        yield table, bounds(table)

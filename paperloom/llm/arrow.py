"""Feeding texts to Python in bounded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

PIECE_BYTES = 4 << 20  # text bytes that one call sees, unless a single text is larger


def pieces(batch: pa.RecordBatch, text: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` text bytes each; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all spans one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def map_texts(
    docs: DataFrame,
    text_col: str,
    carry: list[str] | None,
    fields: list[StructField],
    prepare: Callable[[], Callable[[list], list[pa.Array]]],
    most: int = PIECE_BYTES,
) -> DataFrame:
    """Rows (row struct of ``carry``, then ``fields``) computed from whole texts.

    ``prepare`` runs once per task and returns the function from a list of texts (str or
    None) to one Arrow array per field; it sees about ``most`` bytes at once. ``carry`` None
    keeps all columns.
    """
    columns = docs.columns if carry is None else carry
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col(f"`{text_col}`").alias("text"),
    )
    schema = StructType([packed.schema["row"], *fields])
    names = ["row", *[f.name for f in fields]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            for piece in pieces(batch, "text", most):
                work = work or prepare()
                made = work(piece.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([piece.column("row"), *made], names)

    return packed.mapInArrow(run, schema)

"""Arrow batches inside tasks: cut by size, so that long texts never gather in one batch."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

BATCH_BYTES = 4_000_000


def slices(batch: pa.RecordBatch, column: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``size`` bytes of text each; a longer row stands alone."""
    begin = held = 0
    for row, value in enumerate(batch.column(column)):
        length = value.as_buffer().size if value.is_valid else 0
        if row > begin and held + length > size:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += length
    if batch.num_rows > begin:
        yield batch.slice(begin)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; a null is an empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]

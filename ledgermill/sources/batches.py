"""Arrow output batches of bounded size for scans that run in Python workers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa


class RowBuffer:
    """Collects rows across input files and hands them out as Arrow batches.

    A batch closes at ``max_rows`` rows or ``max_bytes`` of the sizes given with the rows, so many small files share a
    batch and one large file is handed on in pieces.
    """

    def __init__(self, schema: pa.Schema, max_rows: int = 8192, max_bytes: int = 16 << 20):
        self.schema, self.max_rows, self.max_bytes = schema, max_rows, max_bytes
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, size: int = 0) -> None:
        self.rows.append(row)
        self.size += size

    def full(self) -> bool:
        return len(self.rows) >= self.max_rows or self.size >= self.max_bytes

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = list(zip(*self.rows))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, self.schema)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def named_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """``(name, content)`` of each row, one at a time, from batches of two columns."""
    for batch in batches:
        names, contents = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            yield names[i].as_py(), contents[i].as_py()

"""Page-local algorithms over many pages an Arrow batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def _whole_pages(keys: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one page after the other, also of those that batches part."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        marks = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for at in range(len(marks) + 1):
            if at == len(marks) or marks[at] != last:
                if at > start:
                    held.append(table.slice(start, at - start))
                if at < len(marks):
                    if held:
                        yield pa.concat_tables(held)
                    held, start, last = [], at, marks[at]
    if held:
        yield pa.concat_tables(held)


def by_page(rows: DataFrame, keys: list[str], order: list[str], work: Callable[[dict[str, list]], dict[str, list]], schema: str, batch_rows: int = 4_096) -> DataFrame:
    """Applies ``work`` to every page's columns (rows in ``order``) and returns the rows it makes.

    Pages are dealt out by their keys and sorted within partitions, so a task works through
    its pages in a stream; it holds one page at a time, and no pandas frame is made for each.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {f.name: [] for f in arrow}
        for page in _whole_pages(keys, batches):
            made = work(page.to_pydict())
            for name, values in out.items():
                values.extend(made[name])
            if len(next(iter(out.values()))) >= batch_rows:
                yield pa.RecordBatch.from_pydict(out, schema=arrow)
                out = {f.name: [] for f in arrow}
        yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)

"""Identical rows made one with a count, inside the task that reads them.

An aggregation combines before its own exchange, but rows that are dealt by a
key of the jobs' choice (``repartition``) cross the network one by one. Where
copies are many, they are combined first: a task holds a bounded number of rows,
groups them and passes each distinct one on with its count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNT = "__n"
#: Rows that a task holds and groups at once.
HELD_ROWS = 200_000
#: Share of sampled rows that repeat another one from which combining pays.
COPIES_SHARE = 0.1


def combine_copies(df: DataFrame, held_rows: int = HELD_ROWS) -> DataFrame:
    """The distinct rows of each stretch of a task with ``__n``, their number."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def grouped() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).group_by(names).aggregate([([], "count_all")])
            yield from table.select([*names, "count_all"]).rename_columns([*names, COUNT]).to_batches(10_000)
            held.clear()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= held_rows:
                yield from grouped()
        if held:
            yield from grouped()

    fields = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    return df.mapInArrow(run, f"{fields}, {COUNT} bigint")


def many_copies(sample: DataFrame, keys: Sequence[str], share: float = COPIES_SHARE) -> bool:
    """Whether many rows of a (written, small) sample repeat another one of it."""
    per = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows, distinct = per.agg(F.sum("n"), F.count(F.lit(1))).first()
    return bool(rows) and (rows - distinct) / rows >= share

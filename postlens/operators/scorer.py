"""A scorer of the caller's own as a stage: a function of Arrow batches with a declared result.

The function gets the input columns of some rows as a record batch and returns one
array of as many values. All rows and columns stay. Where it fails, the batch is tried
row by row: the rows that fail get a null and the reason, the others their score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

REASON = "_reason"

Scorer = Callable[[pa.RecordBatch], pa.Array]


def scoring(
    function: Scorer, kind: str, out: str, inputs: Sequence[str], rows: int = 1024
) -> Callable[[DataFrame], DataFrame]:
    """A stage that adds ``out`` of the type ``kind`` (as DDL), computed from ``inputs``, and ``REASON`` where it fails.

    The function sees at most ``rows`` rows at a time. The stage works in batch runs and in streams.
    """

    def stage(df: DataFrame) -> DataFrame:
        added = T.StructType.fromDDL(f"`{out}` {kind}, `{REASON}` string")
        kept = [f for f in df.schema.fields if f.name not in added.names]
        schema = T.StructType([*kept, *added.fields])
        arrow = to_arrow_schema(schema)
        type_ = arrow.field(out).type
        earlier = REASON in df.columns

        def one(batch: pa.RecordBatch) -> tuple[pa.Array, list[str | None]]:
            try:
                return checked(function(batch), batch.num_rows), [None] * batch.num_rows
            except Exception as e:  # noqa: BLE001  whatever the caller's function raises is a row's fault
                if batch.num_rows == 1:
                    return pa.nulls(1, type_), [f"{out}:{type(e).__name__}"]
            parts = [one(batch.slice(k, 1)) for k in range(batch.num_rows)]
            return pa.concat_arrays([p[0] for p in parts]), [r for p in parts for r in p[1]]

        def checked(values: pa.Array, n: int) -> pa.Array:
            if isinstance(values, pa.ChunkedArray):
                values = values.combine_chunks()
            if len(values) != n:
                raise ValueError(f"{len(values)} values for {n} rows")
            return values if values.type == type_ else values.cast(type_)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    part = batch.slice(at, rows)
                    values, reasons = one(part.select(list(inputs)))
                    if earlier:
                        reasons = [a or b for a, b in zip(part.column(REASON).to_pylist(), reasons)]
                    columns = [part.column(f.name) for f in kept]
                    yield pa.RecordBatch.from_arrays([*columns, values, pa.array(reasons, pa.string())], schema=arrow)

        return df.mapInArrow(run, schema)

    return stage

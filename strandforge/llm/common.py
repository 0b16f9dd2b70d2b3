"""Small helpers of the operators: Arrow columns as bytes, kernels that keep all other columns, checked names."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def text_array(parts: list[bytes | None]) -> pa.Array:
    """A string column of UTF-8 bytes."""
    return pa.array(parts, pa.binary()).cast(pa.string())


def batch(schema: dict[str, pa.DataType], columns: dict) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[k], t) if not isinstance(columns[k], pa.Array) else columns[k]
                            for k, t in schema.items()], names=list(schema))


def free_name(taken: list[str], name: str) -> str:
    """``name``, or ``name`` with underscores, so that no column of ``taken`` is met whatever its case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def keep_columns(docs: DataFrame, kernel, added: list[T.StructField], extra: list = (), replaced: str | None = None) -> DataFrame:
    """Run ``kernel`` over Arrow batches whose rows are struct(row, *extra) and whose result is (row, *added).

    All columns of ``docs`` travel inside one struct, so that no name of theirs can clash with a working column; columns of
    ``docs`` that bear an added name are dropped in favour of the new one.
    """
    inner = docs.select(F.struct("*").alias("row"), *extra)
    schema = T.StructType([inner.schema["row"], *added])
    out = inner.mapInArrow(kernel, schema)
    names = {f.name.lower() for f in added}
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in names], *[F.col(f.name) for f in added])


def struct_field(column: pa.StructArray, name: str) -> pa.Array:
    at = column.type.get_field_index(name)
    return column.field(at) if not column.null_count else column.flatten()[at]


def with_field(column: pa.StructArray, name: str, values: pa.Array) -> pa.StructArray:
    """``column`` with one field replaced."""
    fields = [column.type.field(i) for i in range(column.type.num_fields)]
    arrays = [values if f.name == name else column.field(i) for i, f in enumerate(fields)]
    return pa.StructArray.from_arrays(arrays, names=[f.name for f in fields])


def runs(starts: np.ndarray, total: int) -> np.ndarray:
    """Lengths of the runs that begin at ``starts``."""
    return np.diff(np.append(starts, total))

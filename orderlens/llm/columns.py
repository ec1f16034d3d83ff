"""Python work on a text column, without a shuffle and in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from orderlens.llm.chunk_table import release_memory

#: Characters of text that are worked on at once.
SLICE_CHARS = 4_000_000

Texts = list[str | None]


def free_name(df: DataFrame, base: str) -> str:
    """A column name that `df` does not have (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def per_text(
    make: Callable[[], Callable[[Texts | pa.Array], dict[str, list]]], fields: str, text: Column, arrays: bool = False
) -> Column:
    """A struct column with `fields` (DDL), computed from a text column.

    `make` runs once per task and returns a function of a list of texts that
    gives a list for each field; with `arrays` it gets them as an Arrow array and may give
    arrays.  The column counts as non-deterministic, so that
    the optimizer never evaluates it a second time inside a filter.
    """
    schema = T.StructType.fromDDL(fields)
    arrow = [pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            parts = [_struct(work(texts), arrow) for texts in (array_slices if arrays else _slices)(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=pa.struct(arrow))
        del work
        release_memory()

    return F.arrow_udf(run, schema).asNondeterministic()(text.cast("string"))


def _struct(columns: dict[str, list], arrow: list[pa.Field]) -> pa.Array:
    arrays = [pa.array(columns[f.name], type=f.type) for f in arrow]
    return pa.StructArray.from_arrays(arrays, fields=arrow)


def _slices(batch: pa.Array) -> Iterator[Texts]:
    """Whole texts, about SLICE_CHARS of them at a time."""
    part, size = [], 0
    for value in batch:
        text = value.as_py()
        part.append(text)
        size += len(text or "")
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def array_slices(batch: pa.Array) -> Iterator[pa.Array]:
    """The same as Arrow arrays, with SLICE_CHARS in bytes."""
    texts = batch.cast(pa.string())
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        seen = ends[at - 1] if at else 0
        after = min(int(np.searchsorted(ends, seen + SLICE_CHARS)) + 1, len(texts))
        yield texts.slice(at, after - at)
        at = after

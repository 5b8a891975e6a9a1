"""Python models: functions that build a table from other tables."""

from __future__ import annotations

import types
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.warehouse import Warehouse


class ModelError(TypeError):
    """A model returned something that is not a table."""


class Context:
    """What a model sees: its inputs, its settings and its own table.

    ``ref`` and ``source`` return lazy DataFrames, so that a model's inputs are
    read by the executors and never loaded whole.
    """

    def __init__(
        self,
        refs: Mapping[str, DataFrame | Callable[[], DataFrame]],
        sources: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None,
        config: Mapping[str, object] | None = None,
        this: str | None = None,
    ):
        self._refs, self._sources = dict(refs), dict(sources or {})
        self.config = types.MappingProxyType(dict(config or {}))
        self.this = this

    def ref(self, name: str) -> DataFrame:
        return _resolve(self._refs, name, "ref")

    def source(self, name: str) -> DataFrame:
        return _resolve(self._sources, name, "source")


def _resolve(inputs: Mapping, name: str, kind: str) -> DataFrame:
    if name not in inputs:
        raise ModelError(f"the model has no {kind} named {name!r}")
    value = inputs[name]
    return value() if callable(value) and not isinstance(value, DataFrame) else value


def run_model(
    model: Callable[[Context, SparkSession], DataFrame],
    context: Context,
    spark: SparkSession,
    warehouse: Warehouse | None = None,
) -> DataFrame:
    """Run a model; with a warehouse, store its result as the table ``context.this``."""
    result = model(context, spark)
    if not isinstance(result, DataFrame):
        raise ModelError(
            f"a model must hand back a Spark DataFrame, and this one gave {type(result)!r}; "
            "arrow_model and pandas_model apply functions on Arrow tables and pandas frames to one"
        )
    if warehouse is None:
        return result
    return warehouse.replace(context.this, result)


def arrow_model(df: DataFrame, fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Run an Arrow function on each batch of rows, inside the executors.

    The function sees some of the rows at a time, so it must work row by row
    or make partial results that are combined afterwards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(pa.Table.from_batches([batch])).combine_chunks().to_batches()

    return df.mapInArrow(run, schema)


def pandas_model(df: DataFrame, fn, schema: str) -> DataFrame:
    """Like :func:`arrow_model` with pandas frames; their index is dropped."""

    def run(frames):
        for frame in frames:
            yield fn(frame).reset_index(drop=True)

    return df.mapInPandas(run, schema)

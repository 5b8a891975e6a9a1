"""Joins: lookups, dimensions, reconciliation, alignment.

No join here carries a broadcast hint. Spark broadcasts a side while its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it
beyond that, splitting hot partitions at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    default: Mapping[str, object] | None = None,
) -> DataFrame:
    """Left join to a dimension, keeping every fact row.

    ``on`` maps fact to dimension columns, ``take`` dimension columns to output
    names, ``default`` output names to the value for rows without a match. The
    same dimension can be joined again under other names.
    """
    default = dict(default or {})
    slim = dimension.select(
        *[F.col(d).alias(f"__on_{i}") for i, d in enumerate(on.values())],
        *[F.col(d).alias(name) for d, name in take.items()],
    )
    condition = None
    for i, f in enumerate(on):
        test = facts[f] == slim[f"__on_{i}"]
        condition = test if condition is None else condition & test
    joined = facts.join(slim, condition, "left").drop(*[f"__on_{i}" for i in range(len(on))])
    for name, value in default.items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return joined


def with_activity(dimension: DataFrame, key: str, measures: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Left join a dimension to fact rollups and fill the gaps with zero.

    ``measures`` maps an output name to an aggregated DataFrame and its key;
    the measure column has the output name. Facts are aggregated before the
    join, so at most one row per key meets the dimension; a rollup that several
    measures come from is joined, and so computed, once.
    """
    rollups: dict[tuple[int, str], tuple[DataFrame, list[str]]] = {}
    for name, (rollup, rollup_key) in measures.items():
        rollups.setdefault((id(rollup), rollup_key), (rollup, []))[1].append(name)
    out = dimension
    for (_, rollup_key), (rollup, names) in rollups.items():
        slim = rollup.select(F.col(rollup_key).alias("__key"), *names)
        out = out.join(slim, out[key] == slim["__key"], "left").drop("__key")
    zero = {name: F.lit(0).cast(rollup.schema[name].dataType) for name, (rollup, _) in measures.items()}
    return out.select(*dimension.columns, *[F.coalesce(F.col(name), zero[name]).alias(name) for name in measures])


def side_by_side(**totals: DataFrame) -> DataFrame:
    """Put one-row results next to each other, columns prefixed by name.

    Each input must be a global aggregate. Every one is a scalar subquery, so
    nothing is paired row by row.
    """
    spark = next(iter(totals.values())).sparkSession
    out = spark.range(1).select()
    for name, df in totals.items():
        packed = df.select(F.struct(*df.columns).alias("packed")).scalar()
        out = out.select("*", packed.alias(f"__{name}"))
    return out.select(
        *[F.col(f"__{name}.{c}").alias(f"{name}_{c}") for name, df in totals.items() for c in df.columns]
    )


def natural(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on all columns the two sides share by name; NULL keys never match."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the two sides share no column")
    return left.join(right, shared)


def align(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Full outer join of two versions of a table on its key.

    The result has the keys, ``old_x`` and ``new_x`` for every column, and the
    flags ``in_old`` and ``in_new``. A NULL in a row that exists can so be told
    from a row that does not.
    """
    a = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in columns], F.lit(True).alias("in_old"))
    b = new.select(*keys, *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("in_new"))
    joined = a.join(b, list(keys), "full_outer")
    return joined.withColumns(
        {"in_old": F.coalesce("in_old", F.lit(False)), "in_new": F.coalesce("in_new", F.lit(False))}
    )


def differs(columns: Sequence[str]) -> Column:
    """True where any aligned column changed; NULL equals NULL."""
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    return out

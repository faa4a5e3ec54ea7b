"""Combining operators: stacking several sources into one schema, and dimension enrichment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StackSpec:
    """One source of a stack: the frame and, per target column, the expression that fills it."""

    df: DataFrame
    columns: dict[str, Column]


def stack_sources(specs: Sequence[StackSpec], order: Sequence[str] | None = None) -> DataFrame:
    """Project each source onto one column list and union them by name (UNION ALL).

    A union is a narrow operation: the output keeps every input partition, nothing shuffles.
    """
    names = list(order) if order is not None else list(specs[0].columns)
    frames = []
    for spec in specs:
        missing = set(names) - set(spec.columns)
        if missing:
            raise ValueError(f"stack source lacks columns {sorted(missing)}")
        frames.append(spec.df.select(*[spec.columns[n].alias(n) for n in names]))
    return reduce(DataFrame.unionByName, frames)


def enrich(df: DataFrame, dim: DataFrame, on, how: str = "left", check_unique: bool = True) -> DataFrame:
    """Join a dimension onto a fact frame.

    ``on`` is a column name, a list of names (USING join) or a join condition. No broadcast
    hint is forced: the planner broadcasts a side whose estimated size (file statistics) is
    under ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-plans from the measured size
    of the materialised shuffle stage; larger dimensions stay a sort-merge join with AQE
    skew splitting. With column names, the dimension must have one row per key, so that the join
    cannot fan the fact rows out: a second row of a key fails the query when it runs
    (``check_unique=False`` allows it). The check shares the exchange of the join.
    """
    keys = [on] if isinstance(on, str) else on
    if check_unique and isinstance(keys, (list, tuple)) and all(isinstance(k, str) for k in keys):
        n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        said = F.raise_error(F.concat(F.lit(f"dimension key {list(keys)} is not unique: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])))
        rest = [c for c in dim.columns if c not in keys]
        dim = (dim.where(known).withColumn("_n", n)
               .select(*keys, *[F.when(F.col("_n") == 1, F.col(c)).otherwise(said.cast(dim.schema[c].dataType)).alias(c) for c in rest]))
    return df.join(dim, on, how)

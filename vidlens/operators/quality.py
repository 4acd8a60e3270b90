"""Row constraints as data checks (Q1, Q2).

A constraint is a named boolean column. As in a SQL ``CHECK``, a row fails
only when the predicate is false; NULL passes. ``constraint_report`` counts
failures of every constraint in one aggregation; ``split_rejected`` tags each
row with the names of the constraints it fails.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def constraint_report(df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """Q1: one row per constraint: ``constraint``, ``violations``, ``checked``."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(~pred).alias(f"_v{i}") for i, pred in enumerate(constraints.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("constraint"), F.col(f"_v{i}").alias("violations"))
                     for i, name in enumerate(constraints)])
    return counts.select(F.explode(rows).alias("_c"), "_rows").select(
        "_c.constraint", "_c.violations", F.col("_rows").alias("checked"))


def failed_names(constraints: Mapping[str, Column]) -> Column:
    """Comma list of the constraints a row fails ('' when it passes all)."""
    return F.concat_ws(",", *[F.when(~pred, F.lit(name)) for name, pred in constraints.items()])


def split_rejected(df: DataFrame, constraints: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Q2: (valid rows, rejected rows with a ``rejected_reasons`` column)."""
    tagged = df.withColumn("rejected_reasons", failed_names(constraints))
    return (tagged.filter(F.col("rejected_reasons") == "").drop("rejected_reasons"),
            tagged.filter(F.col("rejected_reasons") != ""))


def enforce(df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """Refuse a batch before writing: raise naming every failing constraint."""
    bad = [r for r in constraint_report(df, constraints).collect() if r["violations"]]
    if bad:
        detail = ", ".join(f"{r['constraint']}={r['violations']}" for r in bad)
        raise ValueError(f"constraint violations: {detail}")
    return df

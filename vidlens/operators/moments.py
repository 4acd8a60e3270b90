"""Count, mean, deviation and correlation as states that add up over runs.

A state is one row a group: the count of rows that have every column, each
column's base and mean above it, its sum of squared differences, and each pair's
sum of products of differences. The base is the frame's least value, so that
large values with small differences (view counts near 1e15) lose no digits;
states are merged about a base, too. Spark's central-moment aggregates make a
state in one pass over the rows, behind one for the least values.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def state(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """The groups' states: group..., n, base_x, mean_x (above it), m2_x, c_x_y. Rows with a NULL among the columns are left out."""
    rows = df.where(" and ".join(f"`{c}` is not null" for c in columns)).select(*group, *[F.col(c).cast("double").alias(c) for c in columns])
    least = rows.agg(*[F.min(c).alias(c) for c in columns])
    rows = rows.select(*group, *[least.select(c).scalar().alias(f"base_{c}") for c in columns], *columns)
    rows = rows.select(*group, *[f"base_{c}" for c in columns], *[(F.col(c) - F.col(f"base_{c}")).alias(c) for c in columns])
    n = F.count(F.lit(1))
    aggregates = [n.alias("n"), *[F.min(f"base_{c}").alias(f"base_{c}") for c in columns]]
    aggregates += [F.avg(c).alias(f"mean_{c}") for c in columns]
    aggregates += [(F.var_pop(c) * n).alias(f"m2_{c}") for c in columns]
    aggregates += [(F.covar_pop(x, y) * n).alias(f"c_{x}_{y}") for x, y in combinations(columns, 2)]
    return rows.groupBy(*group).agg(*aggregates).where("n > 0")


def merge(states: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """One state a group from any number of them, in any order."""
    near = states.groupBy(*group).agg(*[F.min(f"base_{c}").alias(f"_r_{c}") for c in columns])
    if group:
        pair = states.alias("s").join(near.alias("r"), [F.col(f"s.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group])
        pair = pair.select("s.*", *[f"r._r_{c}" for c in columns])
    else:
        pair = states.select("*", *[near.select(f"_r_{c}").scalar().alias(f"_r_{c}") for c in columns])
    off = {c: F.col(f"base_{c}") - F.col(f"_r_{c}") + F.col(f"mean_{c}") for c in columns}
    n = F.col("n")
    sums = [F.sum("n").alias("n"), *[F.first(f"_r_{c}").alias(f"_r_{c}") for c in columns],
            *[F.sum(n * off[c]).alias(f"_d_{c}") for c in columns],
            *[F.sum(F.col(f"m2_{c}") + n * off[c] * off[c]).alias(f"_q_{c}") for c in columns],
            *[F.sum(F.col(f"c_{x}_{y}") + n * off[x] * off[y]).alias(f"_q_{x}_{y}") for x, y in combinations(columns, 2)]]
    total = pair.groupBy(*group).agg(*sums).where("n > 0")

    def d(c: str) -> Column:
        return F.col(f"_d_{c}")

    return total.select(
        *group, "n", *[F.col(f"_r_{c}").alias(f"base_{c}") for c in columns], *[(d(c) / n).alias(f"mean_{c}") for c in columns],
        *[F.greatest(F.col(f"_q_{c}") - d(c) * d(c) / n, F.lit(0.0)).alias(f"m2_{c}") for c in columns],
        *[(F.col(f"_q_{x}_{y}") - d(x) * d(y) / n).alias(f"c_{x}_{y}") for x, y in combinations(columns, 2)])


def mean(c: str) -> Column:
    return F.col(f"base_{c}") + F.col(f"mean_{c}")


def stddev_samp(c: str) -> Column:
    """NULL for one row."""
    return F.when(F.col("n") > 1, F.sqrt(F.col(f"m2_{c}") / (F.col("n") - 1)))


def covar_samp(x: str, y: str) -> Column:
    return F.when(F.col("n") > 1, F.col(f"c_{x}_{y}") / (F.col("n") - 1))


def corr(x: str, y: str) -> Column:
    """NULL where a column does not vary."""
    return F.try_divide(F.col(f"c_{x}_{y}"), F.sqrt(F.col(f"m2_{x}")) * F.sqrt(F.col(f"m2_{y}")))

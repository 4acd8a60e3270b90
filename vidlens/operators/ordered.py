"""Positions of values in an order, per group, without one task per group.

``rank() OVER (PARTITION BY g ORDER BY v)`` and exact ``percentile_disc``
both need to know how many rows of a group sort before a value. A
plain window sends a whole group to one task and ``percentile_disc`` keeps
every distinct value in one buffer; neither survives a group that holds a
third of all rows. Here the work is split three ways:

1. ``(g, v) -> n`` counts, aggregated map-side first: ties collapse, so a
   single value repeated a billion times is one row;
2. per group, ``buckets - 1`` split points from ``percentile_approx`` (a
   bounded-size sketch) cut the distinct values into buckets of about equal
   size; equal values always share a bucket;
3. per-bucket totals give each bucket's offset (a window over at most
   ``buckets`` rows per group), and a window over ``(g, bucket)`` gives the
   count before each value inside its bucket.

``before = offset(bucket) + before-in-bucket`` is exact: the sketch only
decides the bucket sizes, never the answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 64
#: Distinct values that one bucket, and so one task, may hold.
VALUES_PER_BUCKET = 1_000_000
#: More split points than this are searched in a loop, not in generated code.
UNROLLED_SPLITS = 255


def buckets_for(distinct: int | None) -> int:
    """Buckets for a group of so many distinct values."""
    return max(DEFAULT_BUCKETS, -(-(distinct or 0) // VALUES_PER_BUCKET))


def bucket_count(df: DataFrame, value: str, group: Sequence[str] = ()) -> int:
    """``buckets_for`` the largest group of ``df``: one pass over two columns, one number back."""
    sizes = df.groupBy(*group).agg(F.approx_count_distinct(value).alias("_d"))
    return buckets_for(sizes.agg(F.max("_d")).first()[0])


def _group_key(group: Sequence[str]):
    return F.struct(*[F.col(c) for c in group]) if group else F.lit(0)


def bucket_of(v, splits, n: int, descending: bool):
    """Bucket of ``v`` among ``n`` ascending split points, as a binary search
    unrolled into a ``when`` tree (code-generated, log2(n) comparisons):
    ascending -> number of splits < v; descending -> number of splits > v.
    Equal values always get the same bucket."""
    if n > UNROLLED_SPLITS:
        def passed(x):
            return (x <= v) if descending else (x < v)

        steps = F.array(*[F.lit(1 << i) for i in range(n.bit_length() - 1, -1, -1)])
        below = F.aggregate(steps, F.lit(0), lambda pos, step: F.when(
            (pos + step <= n) & passed(F.get(splits, pos + step - 1)), pos + step).otherwise(pos))
        return (F.lit(n) - below) if descending else below

    def lower(lo, hi):      # count of splits < v, knowing it lies in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(splits[mid] < v, lower(mid + 1, hi)).otherwise(lower(lo, mid))

    def upper(lo, hi):      # count of splits <= v
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(splits[mid] <= v, upper(mid + 1, hi)).otherwise(upper(lo, mid))

    return (F.lit(n) - upper(0, n)) if descending else lower(0, n)


def value_positions(df: DataFrame, value: str, group: Sequence[str] = (), descending: bool = False,
                    buckets: int | None = None) -> DataFrame:
    """One row per distinct ``(group..., value)``: ``_n`` rows with it,
    ``_before`` rows of the group strictly earlier (order by ``value``,
    ascending or descending, NULLs last) and ``_gsize`` rows in the group.
    The number of buckets is taken from the data unless given."""
    group = list(group)
    buckets = buckets or bucket_count(df, value, group)
    counts = (df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
                .withColumn("_gk", _group_key(group)))
    splits = counts.groupBy("_gk").agg(split_points(value, buckets).alias("_splits"))
    if group:
        # one row per group; AQE broadcasts it when the measured size allows
        with_splits = counts.join(splits, "_gk", "left")
    else:
        # one global row: attached as a scalar subquery (computed once, no join)
        with_splits = counts.withColumn("_splits", splits.select("_splits").scalar())
    return (positions_in_buckets(with_splits, value, descending, buckets)
            .select("_gk", *group, value, "_n", "_before", "_gsize"))


def split_points(value: str, buckets: int):
    """The aggregate that cuts a group's values (NULLs left out) into buckets."""
    return F.percentile_approx(value, [i / buckets for i in range(1, buckets)], max(10_000, 4 * buckets))


def positions_in_buckets(with_splits: DataFrame, value: str, descending: bool, buckets: int) -> DataFrame:
    """Adds ``_before`` and ``_gsize`` to rows of ``_gk``, distinct ``value``, ``_n`` and the
    group's ``_splits``; other columns stay."""
    v = F.col(value)
    bucketed = with_splits.withColumn(
        "_b", F.when(v.isNull(), F.lit(buckets))
               .otherwise(bucket_of(v, F.col("_splits"), buckets - 1, descending))).drop("_splits")

    totals = bucketed.groupBy("_gk", "_b").agg(F.sum("_n").alias("_bn"))
    offsets = (totals
               .withColumn("_off", F.coalesce(F.sum("_bn").over(
                   Window.partitionBy("_gk").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn("_gsize", F.sum("_bn").over(Window.partitionBy("_gk")))
               .drop("_bn"))
    order = v.desc_nulls_last() if descending else v.asc_nulls_last()
    inside = bucketed.withColumn(
        "_inb", F.coalesce(F.sum("_n").over(
            Window.partitionBy("_gk", "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)))
    return (inside.join(offsets, ["_gk", "_b"])
                  .withColumn("_before", F.col("_off") + F.col("_inb")).drop("_off", "_inb", "_b"))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                    group: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """``percentile_disc``: per group, the value at 1-based position
    ``ceil(p * N)`` of the non-NULL values in ascending order. One row per
    group (one row in all when ``group`` is empty, NULLs for an empty input).

    A selection, not a sort: split points from the sketch cut the values into
    buckets; bucket totals (at most ``buckets`` rows per group) locate the
    bucket holding each target position; only those buckets' distinct values
    (ties collapsed map-side) are ordered exactly. The number of buckets is
    taken from the data unless given.
    """
    group = list(group)
    buckets = buckets or bucket_count(df, value, group)
    v = F.col(value)
    base = df.where(v.isNotNull()).select(*group, value).withColumn("_gk", _group_key(group))
    splits = base.groupBy("_gk").agg(split_points(value, buckets).alias("_splits"))
    if group:
        with_splits = base.join(splits, "_gk", "left")   # one row per group; AQE broadcasts when small
    else:
        with_splits = base.withColumn("_splits", splits.select("_splits").scalar())
    bucketed = with_splits.select("_gk", *group, value,
                                  bucket_of(v, F.col("_splits"), buckets - 1, False).alias("_b"))
    return select_quantiles(bucketed, value, probs, names, group)


def select_quantiles(bucketed: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                     group: Sequence[str] = ()) -> DataFrame:
    """The quantiles of rows that have their group key ``_gk`` and bucket ``_b``."""
    v = F.col(value)
    # distinct values per bucket with their counts: ties collapse map-side
    per_value = bucketed.groupBy("_gk", *group, "_b", value).agg(F.count(F.lit(1)).alias("_n"))
    totals = per_value.groupBy("_gk", "_b").agg(F.sum("_n").alias("_bn"))
    by_bucket = Window.partitionBy("_gk").orderBy("_b")
    located = (totals
               .withColumn("_off", F.coalesce(F.sum("_bn").over(
                   by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn("_gsize", F.sum("_bn").over(Window.partitionBy("_gk")))
               .select("_gk", "_b", "_off", "_bn", F.explode(F.array(*[
                   F.struct(F.lit(n).alias("_q"),
                            F.greatest(F.ceil(F.col("_gsize") * F.lit(p)), F.lit(1)).alias("_t"))
                   for p, n in zip(probs, names)])).alias("_target"))
               .where((F.col("_off") < F.col("_target._t")) & (F.col("_target._t") <= F.col("_off") + F.col("_bn")))
               .select("_gk", "_b", F.col("_target._q").alias("_q"), (F.col("_target._t") - F.col("_off")).alias("_tin")))
    # exact order only inside the located buckets
    wanted = per_value.join(located.select("_gk", "_b").distinct(), ["_gk", "_b"], "left_semi")
    inside = wanted.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_gk", "_b").orderBy(v).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    hits = (inside.join(located, ["_gk", "_b"])
                  .where((F.col("_before") < F.col("_tin")) & (F.col("_tin") <= F.col("_before") + F.col("_n"))))
    return hits.groupBy(*group).agg(*[F.max(F.when(F.col("_q") == n, v)).alias(n) for n in names])


def approx_quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                     group: Sequence[str] = (), relative_error: float = 0.01) -> DataFrame:
    """The reference's ``approxQuantile`` semantics in-plan (bounded sketch);
    an error of 0 means exact at any size."""
    if relative_error <= 0:
        return exact_quantiles(df, value, probs, names, group)
    acc = max(1, int(round(1.0 / relative_error)))
    q = F.percentile_approx(value, list(probs), acc)
    out = df.groupBy(*group).agg(q.alias("_q"))
    return out.select(*group, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])

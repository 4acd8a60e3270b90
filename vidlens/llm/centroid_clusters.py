"""Centroid clustering over Hilbert-ordered zone maps (operator 12).

Vectors become integers. A Hilbert curve through their leading principal
directions (from counts, sums and products of all vectors) gives each a place;
a range shuffle on it puts near vectors side by side, and each run of ``block``
of them is one row of a written table with the least and greatest value of
every component. A round reads the blocks: from a block's box it bounds how
much nearer its vectors can be to one centroid than to another, leaves out
centroids that some other beats everywhere in the box, and compares the
block's vectors with the rest in whole numbers. Partial sums leave a task,
one for each centroid and component; centroids (at most ``k``) pass through
the driver. All arithmetic behind a decision is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm.common import materialize, table

SCALE = 256
#: Components are held within this; their distances are far beyond a long.
BOUND = 10**18
#: Up to this magnitude a squared distance of 64 components stays within a long.
SMALL = 1 << 27
#: Up to this magnitude sums of products of 64 components are whole in double precision.
EXACT_PRODUCTS = 1 << 22
DIRECTIONS, BITS = 8, 7
LONG = 2**63


def kept(dim: int):
    """Exactly ``dim`` components, none null or non-finite."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) == dim) & F.coalesce(~bad, F.lit(False))


def integers(vectors: pa.Array, dim: int) -> np.ndarray:
    """floor(256 * x) of each component, as rows of longs."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * SCALE), -BOUND, BOUND).astype(np.int64)


def exact(x: np.ndarray) -> np.ndarray:
    """Python whole numbers where longs might overflow, else the longs."""
    return x if not x.size or max(-int(x.min()), int(x.max())) <= SMALL else x.astype(object)


def hilbert_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of non-negative ``bits``-bit cells.

    The coordinates are turned into the curve's transposed form bit plane by bit
    plane (invert or exchange the low bits by the plane's bit, then Gray code),
    and the planes are interleaved into one number; columns times bits must stay
    below 64.
    """
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    for plane in range(bits - 1, 0, -1):
        low = (1 << plane) - 1
        for i in range(n):
            up = (x[i] >> plane & 1).astype(bool)
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for plane in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> plane & 1, (1 << plane) - 1, 0)
    x ^= turn
    place = np.zeros_like(x[0])
    for plane in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | (x[i] >> plane & 1)
    return place


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest, ties included, to some point of the box.

    A centroid is left out where another is strictly nearer at every corner, and
    so everywhere: the difference of two squared distances is linear in the point.
    """
    low, high, c = exact(low), exact(high), exact(centroids)
    if object in (low.dtype, high.dtype, c.dtype):
        low, high, c = low.astype(object), high.astype(object), c.astype(object)
    gap = np.maximum(np.maximum(low - c, c - high), 0)
    far = np.maximum(abs(c - low), abs(c - high))
    alive = np.flatnonzero((gap * gap).sum(1) <= (far * far).sum(1).min())
    middle = (low + high) // 2
    to_middle = ((c[alive] - middle) ** 2).sum(1)
    for j in alive[np.argsort(to_middle, kind="stable")][:4]:
        if j not in alive:
            continue
        step = c[alive] - c[j]      # d(x, j) - d(x, other) = 2 x.step + |c_j|^2 - |c_other|^2
        most = 2 * np.maximum(step * low, step * high).sum(1) + (c[j] * c[j]).sum() - (c[alive] * c[alive]).sum(1)
        alive = alive[(most >= 0) | (alive == j)]
    return alive


def nearest(vectors: np.ndarray, centroids: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid among ``alive``, least number on ties; squared distance) of each vector."""
    v, c = exact(vectors), exact(centroids[alive])
    if object in (v.dtype, c.dtype):
        v, c = v.astype(object), c.astype(object)
        distance = np.array([[((x - y) ** 2).sum() for y in c] for x in v], dtype=object).reshape(len(v), len(c))
    elif max(abs(v).max(initial=0), abs(c).max(initial=0)) <= EXACT_PRODUCTS:
        a, b = v.astype(np.float64), c.astype(np.float64)
        distance = ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    else:
        distance = np.stack([np.einsum("nd,nd->n", v - y, v - y) for y in c], axis=1)
    at = distance.argmin(1)     # the first least one; ``alive`` ascends
    return alive[at], distance[np.arange(len(v)), at]


def directions(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, leading principal directions, scale along each) of the integer vectors, from all rows."""
    def moments(batches):
        n, s, p = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            v = integers(batch.column("embedding"), dim).astype(np.float64)
            n, s, p = n + len(v), s + v.sum(0), p + v.T @ v
        if n:
            yield pa.RecordBatch.from_pydict({"at": np.arange(1 + dim + dim * dim, dtype=np.int32), "x": np.concatenate([[n], s, p.ravel()])})

    total = rows.mapInArrow(moments, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).toPandas()
    x = total.sort_values("at")["x"].to_numpy()     # 1 + dim + dim * dim numbers
    if not len(x):
        return np.zeros(dim), np.zeros((dim, 1)), np.ones(1)
    mean = x[1:dim + 1] / x[0]
    spread = x[dim + 1:].reshape(dim, dim) / x[0] - np.outer(mean, mean)
    size, axes = np.linalg.eigh(np.nan_to_num(spread))
    lead = np.argsort(-size)[:DIRECTIONS]
    return mean, axes[:, lead], np.sqrt(np.maximum(size[lead], 1.0))


def zone_maps(rows: DataFrame, dim: int, block: int) -> DataFrame:
    """A written table with one row a block: ids, vectors (longs, row by row), low and high."""
    mean, axes, scale = directions(rows, dim)

    def place(batches):
        for batch in batches:
            v = integers(batch.column("embedding"), dim)
            if not len(v):
                continue
            along = (v - mean) @ axes / scale
            # Three standard deviations either way fill the cells; what lies beyond goes to the outer ones.
            cells = np.clip(np.floor((along + 3) / 6 * (1 << BITS)), 0, (1 << BITS) - 1).astype(np.int64)
            yield batch.append_column("place", pa.array(hilbert_places(cells, BITS)))

    fields = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, embedding {rows.schema['embedding'].dataType.simpleString()}"
    # Equal vectors share a place; the row's own number lets the range shuffle cut between them.
    placed = rows.mapInArrow(place, fields + ", place long").withColumn("row", F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartitionByRange(parts, "place", "row").sortWithinPartitions("place", "row")

    def cut(batches):
        ids, vectors = [], np.empty((0, dim), np.int64)

        def boxed(ids, v):
            return pa.RecordBatch.from_pydict({
                "ids": pa.array([ids], pa.list_(pa.int64())), "vectors": [v.astype("<i8").tobytes()],
                "low": pa.array([v.min(0)], pa.list_(pa.int64())), "high": pa.array([v.max(0)], pa.list_(pa.int64()))})

        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            vectors = np.concatenate([vectors, integers(batch.column("embedding"), dim)])
            while len(ids) >= block:
                yield boxed(ids[:block], vectors[:block])
                ids, vectors = ids[block:], vectors[block:]
        if ids:
            yield boxed(ids, vectors)

    return materialize(placed.mapInArrow(cut, "ids array<long>, vectors binary, low array<long>, high array<long>"),
                       "cluster-blocks")


def assigned(batches, centroids: np.ndarray):
    """(ids, vectors, clusters, distances) of each block."""
    dim = centroids.shape[1]
    for batch in batches:
        for r in batch.to_pylist():
            v = np.frombuffer(r["vectors"], "<i8").reshape(-1, dim)
            alive = candidates(np.array(r["low"]), np.array(r["high"]), centroids)
            yield r["ids"], v, *nearest(v, centroids, alive)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: componentwise floor of the mean; empty ones stay."""
    k, dim = centroids.shape

    def partial(batches):
        sums, counts = np.zeros((k, dim), dtype=object), np.zeros(k, dtype=np.int64)
        for _, v, cluster, _ in assigned(batches, centroids):
            v = exact(v)
            for j in np.unique(cluster):
                own = v[cluster == j]
                sums[j] += own.sum(0).astype(object)
                counts[j] += len(own)
        at = np.flatnonzero(counts)
        if len(at):
            flat = [int(x) for x in sums[at].ravel()]
            yield pa.RecordBatch.from_pydict({
                "cluster": np.repeat(at, dim).astype(np.int32), "at": np.tile(np.arange(dim, dtype=np.int32), len(at)),
                "n": np.repeat(counts[at], dim),        # a sum is high * 2^32 + low
                "high": pa.array([x >> 32 for x in flat], pa.int64()), "low": pa.array([x & 0xFFFFFFFF for x in flat], pa.int64())})

    sums = (blocks.mapInArrow(partial, "cluster int, at int, n long, high long, low long").groupBy("cluster", "at")
            .agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")))
    out = centroids.copy()
    for r in sums.collect():     # at most k * dim rows
        out[r["cluster"], r["at"]] = ((r["high"] << 32) + r["low"]) // r["n"]
    return out


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dim: int = 64, block: int = 128) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    Kept are vectors of exactly ``dim`` components, none null or non-finite;
    others have no row. Component x counts as floor(256 * x), held within
    +-10^18. The first centroids are the ``k`` kept vectors with the smallest
    SHA-256 of ``seed:vec_id``, fewer where there are fewer; rows under one id
    by their components, a null id last. Ties go to the smaller centroid.
    Distances and inertias beyond a long are null. Repeated rows each count and
    come out. Columns besides vec_id and embedding are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(kept(dim))
    first = (rows.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
             .orderBy(F.col("hash").asc_nulls_last(), F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)))
             .limit(k).select("embedding").toArrow())       # at most k rows
    if not first.num_rows:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    centroids = integers(first.column("embedding").combine_chunks(), dim)
    blocks = zone_maps(rows, dim, block)
    for _ in range(rounds):
        centroids = moved(blocks, centroids)

    def last(batches):
        for ids, _, c, d in assigned(batches, centroids):
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array(ids, pa.int64()), "cluster": c.astype(np.int32),
                "distance": pa.array([x if x < LONG else None for x in d.tolist()], pa.int64())})

    out = materialize(blocks.mapInArrow(last, "vec_id long, cluster int, distance long"), "clusters")
    # A null distance makes the sums that hold it null, as these are beyond a long too.
    sums = (out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"),
                                       F.count(F.when(F.col("distance").isNull(), 1)).alias("beyond")).collect())
    inertia = {r["cluster"]: None if r["beyond"] or r["s"] is None else int(r["s"]) for r in sums}    # at most k rows
    whole = None if None in inertia.values() else sum(inertia.values())
    known = [(j, s if s is not None and s < LONG else None, whole if whole is not None and whole < LONG else None,
              hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, s in inertia.items()]
    clusters = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(clusters), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                                             "centroid_sha256")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def oracle_sql(k: int = 40, rounds: int = 5, seed: int = 2, dim: int = 64) -> str:
    """The same clustering as one SQL query, each round spelled out."""
    square = "list_sum(list_transform(range(1, {d} + 1), lambda i: (v.v[i] - c.c[i]) * (v.v[i] - c.c[i])))".format(d=dim)
    near = ("select v.vec_id, v.v, arg_min(c.j, (struct_pack(d := {q}, j := c.j))) as j, min({q}) as d "
            "from v cross join c{r} c group by v.vec_id, v.v, v.row").replace("{q}", square)
    ctes = [f"""v as materialized (select vec_id, row_number() over () as row,
  list_transform(embedding, lambda x: floor({SCALE} * x::double)::hugeint) as v from embeddings
  where len(embedding) = {dim} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
            f"""c0 as materialized (select (row_number() over (order by sha256('{seed}:' || vec_id), v) - 1)::int as j, v as c
  from v order by sha256('{seed}:' || vec_id), v limit {k})"""]
    for r in range(rounds):
        ctes += [f"a{r} as materialized ({near.replace('{r}', str(r))})",
                 f"""s{r} as materialized (select j, list(m order by i) as c from (select j, i,
  (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as m
  from (select j, unnest(v) as x, unnest(range({dim})) as i from a{r}) group by j, i) group by j)""",
                 f"c{r + 1} as materialized (select c.j, coalesce(s.c, c.c) as c from c{r} c left join s{r} s using (j))"]
    ctes.append(f"a{rounds} as materialized ({near.replace('{r}', str(rounds))})")
    return "with " + ",\n".join(ctes) + f"""
select a.vec_id, a.j::int as cluster, a.d::bigint as distance, (sum(a.d) over (partition by a.j))::bigint as cluster_inertia,
  (sum(a.d) over ())::bigint as inertia, sha256(array_to_string(list_transform(c.c, lambda x: x::varchar), ',')) as centroid_sha256
from a{rounds} a join c{rounds} c using (j)"""

"""Embedding near-dedup with small-world graphs per shard (operator 9).

Equal vectors of a label are one class; the classes of a label are dealt over
shards of bounded size, and each shard gets a graph. Every shard's classes
query every shard of their label. The beam starts narrow; queries are compared
in full until ``audit`` of them have a link other than to themselves, or none
is left, and the beam doubles until the graph has found these links. Links
found, the audit's included, are verified by cosine in double precision and
joined to components.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm.common import connected_components, materialize, table
from vidlens.llm.hnsw import Graph

SHARD = 8192


def usable():
    """A vector that can link: no null or non-finite component, not zero."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()
            & F.coalesce(~bad, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))


def shard_links(ids_a, vec_a, size_a, ids_b, vec_b, size_b, least: float, beam: int, audit: int, target: float):
    """Links between two shards' classes (or within one, when they are the same).

    Returns {class: linked vectors} and edges of a spanning forest over the links.
    """
    same = ids_a is ids_b
    unit_a = vec_a / np.linalg.norm(vec_a, axis=1, keepdims=True)
    unit_b = unit_a if same else vec_b / np.linalg.norm(vec_b, axis=1, keepdims=True)
    slack = 1e-4  # the graph works in single precision
    a, b = _found(unit_a, unit_b, least - slack, beam, audit, target, same)
    if not same:
        b2, a2 = _found(unit_b, unit_a, least - slack, beam, audit, target, same)
        a, b = np.concatenate([a, a2]), np.concatenate([b, b2])
    pairs = np.unique(np.stack([np.concatenate([a, b]), np.concatenate([b, a])] if same else [a, b], 1), axis=0)
    a, b = pairs[:, 0], pairs[:, 1]
    if same:
        a, b = a[a != b], b[a != b]
    ok = np.concatenate([np.einsum("nd,nd->n", unit_a[a[i:i + 65536]], unit_b[b[i:i + 65536]]) >= least
                         for i in range(0, len(a), 65536)]) if len(a) else np.zeros(0, bool)
    a, b = a[ok], b[ok]
    links = [(ids_a, np.bincount(a, weights=size_b[b], minlength=len(ids_a)))]
    if not same:
        links.append((ids_b, np.bincount(b, weights=size_a[a], minlength=len(ids_b))))
    return links, forest(ids_a[a], ids_b[b])


def _found(queries, nodes, least, beam, audit, target, same):
    q, v = queries.astype(np.float32), nodes.astype(np.float32)
    graph = Graph.build(v)
    own, node = audited(q, v, least, audit, same)
    want = own * len(v) + node
    n_links = np.bincount(own, minlength=len(q))
    some = n_links > 0
    while True:
        a, b = graph.within(q, least, beam)
        known = some[a]
        hit = np.isin(want, a[known] * len(v) + b[known])
        n_hit = np.bincount(own[hit], minlength=len(q))
        # Of all links, and of each query's links on average, so that a few queries with many do not decide alone.
        if beam >= len(v) or not len(own) or (hit.mean() >= target and (n_hit[some] / n_links[some]).mean() >= target):
            return np.concatenate([a, own[~hit]]), np.concatenate([b, node[~hit]])
        beam *= 2


def audited(q, v, least, audit: int, same: bool, block: int = 256):
    """(queries, nodes) of the links of the queries compared in full, self matches left out.

    Queries are drawn until ``audit`` of them have a link, or all are compared.
    """
    order = np.random.default_rng(len(q)).permutation(len(q))
    own, node, with_links, at = [], [], 0, 0
    while at < len(order) and with_links < audit:
        ids = order[at:at + block]
        r, c = np.nonzero(q[ids] @ v.T >= least)
        r = ids[r]
        if same:
            other = r != c
            r, c = r[other], c[other]
        own.append(r)
        node.append(c)
        with_links += len(np.unique(r))
        at += len(ids)
    return np.concatenate([*own, np.empty(0, np.int64)]), np.concatenate([*node, np.empty(0, np.int64)])


def forest(a, b):
    """Edges that join the same nodes as all pairs (a, b) do."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def near_duplicates(vectors: DataFrame, least: float = 0.98, shard: int = SHARD, beam: int = 32, audit: int = 256,
                    target: float = 0.99) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors link when their labels are equal and not null and their cosine is
    ``least`` or more; n_links counts the linked rows, equal vectors included.
    Vectors that are null or empty, zero, hold a null or non-finite component,
    have no label or no id link with nothing and are their own component;
    vectors of different length do not link. One row out per row in.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("ok", usable()).withColumn("dim", F.size("embedding"))
    good = rows.where("ok")
    keys = ["label", "dim", "embedding"]
    classes = materialize(good.groupBy(*keys).agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vector-classes")
    per_label = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).alias("shards"))
    dealt = classes.join(per_label, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        return pd.DataFrame({"label": [pdf["label"].iloc[0]], "dim": [pdf["dim"].iloc[0]], "shard": [pdf["shard"].iloc[0]],
                             "reps": [pdf["rep"].to_numpy()], "sizes": [pdf["n"].to_numpy()],
                             "vectors": [np.stack(pdf["embedding"].to_list()).tobytes()]})

    shards = materialize(dealt.groupBy("label", "dim", "shard").applyInPandas(
        pack, "label string, dim int, shard long, reps array<long>, sizes array<long>, vectors binary"), "vector-shards")
    left = shards.select("label", "dim", *[F.col(c).alias(f"{c}_a") for c in ("shard", "reps", "sizes", "vectors")])
    right = shards.select("label", "dim", *[F.col(c).alias(f"{c}_b") for c in ("shard", "reps", "sizes", "vectors")])
    pairs = left.join(right, ["label", "dim"]).where("shard_a <= shard_b")
    # A task for each pair of shards, whichever label it has.
    pairs = pairs.repartition(F.xxhash64("label", "dim", "shard_a", "shard_b"))

    def link(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                a = (np.asarray(r.reps_a), np.frombuffer(r.vectors_a).reshape(-1, r.dim), np.asarray(r.sizes_a))
                b = a if r.shard_a == r.shard_b else (
                    np.asarray(r.reps_b), np.frombuffer(r.vectors_b).reshape(-1, r.dim), np.asarray(r.sizes_b))
                links, edges = shard_links(*a, *b, least, beam, audit, target)
                for ids, count in links:
                    at = np.flatnonzero(count)
                    yield pd.DataFrame({"src": ids[at], "dst": -1, "n": count[at].astype(np.int64), "edge": False})
                yield pd.DataFrame(edges, columns=["src", "dst"]).assign(n=0, edge=True).astype({"src": "int64", "dst": "int64"})

    found = materialize(pairs.mapInPandas(link, "src long, dst long, n long, edge boolean"), "vector-links")
    linked = found.where("not edge").groupBy(F.col("src").alias("rep")).agg(F.sum("n").alias("linked"))
    components = connected_components(found.where("edge").select("src", "dst")).withColumnRenamed("node", "rep")
    known = (classes.join(linked, "rep", "left").join(components, "rep", "left")
             .select(*keys, "n", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("component", "rep").alias("component")))
    out = good.join(known, keys).select(
        "vec_id", (F.col("n") - 1 + F.col("linked")).cast("long").alias("n_links"), F.col("component").alias("component_id"),
        (F.col("vec_id") == F.col("component")).alias("kept"))
    alone = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(alone)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings),
good as (select * from v where vec_id is not null and label is not null and e is not null and len(e) > 0
  and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and list_max(list_transform(e, lambda x: abs(x))) > 0),
unit as (select vec_id, label, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) as u from good),
links as (select a.vec_id as src, b.vec_id as dst from unit a join unit b on a.label = b.label and a.vec_id <> b.vec_id
  and len(a.u) = len(b.u) where list_inner_product(a.u, b.u) >= 0.98),
reach as (select vec_id as src, vec_id as dst from v union select r.src, l.dst from reach r join links l on r.dst = l.src),
comp as (select src, min(dst) as component_id from reach group by src),
n as (select src, count(*) as n from links group by src)
select v.vec_id, coalesce(n.n, 0)::bigint as n_links, c.component_id, v.vec_id = c.component_id as kept
from v join comp c on c.src = v.vec_id left join n on n.src = v.vec_id"""

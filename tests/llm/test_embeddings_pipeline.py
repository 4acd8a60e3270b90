import numpy as np
import pytest

from vidlens.llm import embedding_dedup, registry
from vidlens.llm.common import prepare
from vidlens.llm.hnsw import Graph


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def test_graph_recall():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(1500, 24)).astype(np.float32)
    v[500:900] = v[:400] + 0.05 * rng.normal(size=(400, 24))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    a, b = Graph.build(v).within(v, 0.95, 32)
    true = set(zip(*np.nonzero(v @ v.T >= 0.95)))
    assert len(true & set(zip(a, b))) >= 0.97 * len(true)


@pytest.mark.parametrize("shard", [60, 8192])
def test_near_duplicates_equal_brute_force(spark, shard):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 16))
    v[100:160] = v[40] + 0.02 * rng.normal(size=(60, 16))
    v[200:240] = v[199]
    rows = [(i, x.tolist(), i % 3 if i < 100 or i >= 240 else 1) for i, x in enumerate(v)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, v[199].tolist(), None),
             (904, [None] + [1.0] * 15, 1), (905, [], 1), (None, v[199].tolist(), 1), (199, v[199].tolist(), 1), (906, [1.0] * 4, 1)]
    df = spark.createDataFrame([(*r, 5, 5) for r in rows], "vec_id long, embedding array<double>, label int, rep int, n int")
    got = sorted(tuple(map(str, r)) for r in embedding_dedup.near_duplicates(df, shard=shard).collect())
    good = [(i, np.array(x), k) for i, x, k in rows if i is not None and k is not None and x and None not in x
            and np.isfinite(x).all() and np.any(x)]
    link = {}
    for n, (_, x, k) in enumerate(good):
        link[n] = [m for m, (_, y, q) in enumerate(good) if m != n and k == q and len(x) == len(y)
                   and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98]
    want = [(i, 0, i, True) for i, x, k in rows if not any(i == g[0] for g in good)]
    for n, (i, _, _) in enumerate(good):
        seen, todo = {n}, [n]
        while todo:
            todo += [m for m in link[todo.pop()] if m not in seen and not seen.add(m)]
        c = min(good[m][0] for m in seen)
        want.append((i, len(link[n]), c, i == c))
    assert got == sorted(tuple(map(str, r)) for r in want)
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


class Blind:
    """A graph that a narrow beam leads to self matches only, a wide one to everything."""

    def __init__(self, unit):
        self.unit = unit

    @staticmethod
    def build(unit):
        return Blind(unit)

    def within(self, q, least, beam):
        if beam >= 128:
            return np.nonzero(q @ self.unit.T >= least)
        return np.nonzero(q @ self.unit.T >= 1 - 1e-6)


@pytest.mark.parametrize("apart", [False, True])
def test_audit_notices_rare_links(monkeypatch, apart):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(3000, 16))
    copies = v[[5, 1700]] + 0.01 * rng.normal(size=(2, 16))
    ids, ones = np.arange(3002), np.ones(3002, dtype=int)
    # Copies in another shard, or in the same one.
    a = (ids[:3000], v, ones[:3000]) if apart else (ids, np.vstack([v, copies]), ones)
    b = (ids[-900:], np.vstack([rng.normal(size=(898, 16)), copies]), ones[:900]) if apart else a
    monkeypatch.setattr(embedding_dedup, "Graph", Blind)
    _, edges = embedding_dedup.shard_links(*a, *b, 0.98, 32, 256, 0.99)
    assert {(5, 3000), (1700, 3001)} <= {(min(e), max(e)) for e in edges}


def test_audit_leaves_out_self_matches_and_goes_on_to_links():
    v = np.eye(600, dtype=np.float32)
    v[599] = v[0]
    own, node = embedding_dedup.audited(v, v, 0.98, 256, True)
    assert sorted(zip(own.tolist(), node.tolist())) == [(0, 599), (599, 0)]
    every = np.ones((2000, 4), dtype=np.float32) / 2
    own, _ = embedding_dedup.audited(every, every, 0.98, 256, True)
    assert len(np.unique(own)) == 256


def test_pipeline_decisions(spark, odd, none, tmp_path):
    import corpus_pipeline as C
    item = " ".join(f"q{i}" for i in range(30))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    more = spark.createDataFrame([(80, f"They said {item} and left."), (81, 'This has token = "0123456789abcdef" in it.')], "doc_id long, text string")
    docs = odd.unionByName(more, allowMissingColumns=True)
    seen = []
    for name, stage in C.STAGES:
        out = C.materialize(stage(spark, docs, str(tmp_path)), f"test-{name}")
        if name != C.STAGES[-1][0]:
            assert out.columns == docs.columns
            seen.append({(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()})
        docs = out
    ids = [{i for i, _ in s} for s in seen]
    assert ids[0] >= {0, 10, 11, 16, 80, 81, None} and not ids[0] & {12, 13, 14, 17}
    # Fifteen shingles of which twelve are shared: exactly 0.8.
    assert 0 in ids[1] and not ids[1] & {10, 11} and 80 in ids[1] and 80 not in ids[2]
    assert dict(seen[3])[81] == 'This has [secret]" in it.' and ids[3] == ids[2]
    assert {r["doc_id"] for r in docs.collect()} == ids[3]
    for _, stage in C.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_queries_equal_duckdb(spark, name):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.sql(registry.ORACLE[name]).df()
    got = registry.QUERIES[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert sorted(map(str, got[cols].itertuples(index=False, name=None))) == sorted(
        map(str, want[cols].astype(got[cols].dtypes.to_dict()).itertuples(index=False, name=None)))

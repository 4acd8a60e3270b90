"""Operators 11 to 13 against tiktoken, DuckDB and brute force written from their contracts."""
import hashlib
import itertools
import random
import re
import unicodedata
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from vidlens.llm import byte_bpe, centroid_clusters, conversation_repair
from vidlens.llm.common import prepare

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# ---- 11: byte-level BPE --------------------------------------------------------------

@pytest.fixture(scope="module")
def tik():
    import tiktoken
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(tik, rows):
    out = []
    for i, text in rows:
        ids = tik.encode_ordinary(text or "")
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha((text or "").encode())))
    return Counter(out)


def test_bpe_query_equals_tiktoken(spark, tik):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Counter(tuple(r) for r in byte_bpe.op11_byte_bpe(spark, SF).collect())
    assert got == expected(tik, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_bpe_on_odd_rows_and_none(odd, none, tik):
    rows = byte_bpe.encode(odd).collect()
    want = Counter((r["doc_id"], tuple(tik.encode_ordinary(r["text"] or ""))) for r in odd.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == want
    assert byte_bpe.encode(none).collect() == []


def test_bpe_on_every_code_point_and_on_repeats(tik):
    code = byte_bpe.encoder(*byte_bpe.default_files(None, None))
    # All assigned code points, all that this Python does not know yet below U+30000, and some of the rest.
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (
        unicodedata.category(chr(c)) != "Co" if c < 0x30000 else c % 97 == 0)]
    texts = [" ".join(f"a{chr(c)}b {chr(c)}1" for c in points[i:i + 16]) for i in range(0, len(points), 16)]
    rng = random.Random(5)
    tokens = list(byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    texts += ["".join(rng.choice("ab-= \n'.s") for _ in range(rng.randint(1, 5))) * rng.randint(1, 50) for _ in range(5000)]
    texts += [b"".join(rng.choices(tokens, k=8)).decode("utf-8", "ignore") for _ in range(5000)]
    texts += [c * n for c in "a-= \né。" for n in (1, 2, 3, 7, 64, 129, 1000)]
    got = code.encode(texts)
    wrong = [t for t, ids in zip(texts, got, strict=True) if ids.tolist() != tik.encode_ordinary(t)]
    assert wrong == []
    # Cutting long texts and forgetting matches changes nothing.
    small = byte_bpe.Encoder(*byte_bpe.default_files(None, None), memo=50)
    part = texts[-200:]
    for ids, again in zip(got[-200:], small.encode(part, size=16), strict=True):
        assert ids.tolist() == again.tolist()


def test_bpe_offsets_and_split_characters(spark, tik):
    texts = ["naïve 🙂🙂 𝛑 x", "日本語のテキスト", "", None, "plain text", "🜚"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    names = byte_bpe.encoder(*byte_bpe.default_files(None, None)).names
    split = False
    for r in byte_bpe.encode(docs, with_offsets=True).collect():
        text = texts[r["doc_id"]] or ""
        data, at = text.encode(), 0
        for i, start, first, last in zip(r["ids"], r["byte_starts"], r["char_starts"], r["char_ends"], strict=True):
            assert start == at and data[start:start + len(names[i])] == names[i]
            at += len(names[i])
            assert names[i] in text[first:last].encode()
            assert names[i] not in text[first + 1:last].encode() and names[i] not in text[first:last - 1].encode()
            split |= len(text[first:last].encode()) > len(names[i])
        assert at == len(data)
        assert "".join(byte_bpe.decode_stream(r["ids"], names)) == text
    assert split
    ids = tik.encode_ordinary("🜚")
    assert list(byte_bpe.decode_stream(ids, names))[:-1] == [""] * (len(ids) - 1)
    assert "".join(byte_bpe.decode_stream(ids[:1], names)) == "�"
    with pytest.raises(ValueError, match="60000"):
        byte_bpe.decode_ids([60000], names)


def test_bpe_decodes_columns(spark):
    docs = spark.createDataFrame([(1, "é 🙂 ab"), (2, None), (3, "")], "doc_id int, text string")
    ids = byte_bpe.encode(docs)
    got = {r["doc_id"]: (bytes(r["b"]), r["t"]) for r in ids.select(
        "doc_id", byte_bpe.decoded(F.col("ids")).alias("b"), byte_bpe.decoded_text(F.col("ids")).alias("t")).collect()}
    assert got == {1: ("é 🙂 ab".encode(), "é 🙂 ab"), 2: (b"", ""), 3: (b"", "")}
    assert ids.select(byte_bpe.decoded(F.lit(None).cast("array<int>")).alias("b")).first()["b"] is None


# ---- 12: centroid clustering ------------------------------------------------------------

def by_brute_force(rows, k, rounds, dim, seed=2):
    kept = [(i, [int(np.floor(float(np.float32(x)) * 256)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: ("~" if r[0] is None else sha(f"{seed}:{r[0]}"), r[1]))[:k]
    c = [v for _, v in first]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, z)), j) for j, z in enumerate(c)) for _, v in kept]

    for _ in range(rounds):
        a = assign()
        for j in range(len(c)):
            own = [v for (_, v), (_, m) in zip(kept, a) if m == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own)]
    a = assign()
    total = sum(d for d, _ in a)
    each = Counter()
    for d, j in a:
        each[j] += d

    def long(x):
        return x if x < 2**63 else None
    return Counter((i, j, long(d), long(each[j]), long(total), sha(",".join(map(str, c[j])))) for (i, _), (d, j) in zip(kept, a))


def clustered(df, **options):
    return Counter(tuple(r) for r in centroid_clusters.cluster(df, **options).collect())


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.05).tolist()) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 600)]                                   # a third of all rows are equal
    rows += [(7, rows[7][1]), (7, rows[9][1]), (None, rows[3][1]), (600, [0.5] * 8), (601, [-0.5] * 8)]   # repeated and null ids
    rows += [(700, None), (701, [1.0] * 7), (702, []), (703, [None] + [0.0] * 7), (704, [float("nan")] * 8), (705, [float("inf")] * 8)]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, cluster int, place int, at int")
    for k, rounds in ((10, 4), (3, 0)):
        assert clustered(df, k=k, rounds=rounds, dim=8, block=16) == by_brute_force(rows, k, rounds, 8)
    assert clustered(df.where("vec_id < 4"), k=10, rounds=2, dim=8) == by_brute_force([r for r in rows if r[0] is not None and r[0] < 4], 10, 2, 8)
    assert clustered(df.where("false"), dim=8) == Counter()
    assert clustered(df.where("vec_id >= 700"), dim=8) == Counter()


def test_clusters_of_large_components_stay_exact(spark):
    rows = [(i, [float(i % 5) * 1e6, -1e6 * i, 0.1]) for i in range(40)] + [(100, [1e30, 0.0, 0.0]), (101, [3e5, 3e5, -3e5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = clustered(df.where("vec_id <> 100"), k=4, rounds=3, dim=3, block=4)
    assert got == by_brute_force([r for r in rows if r[0] != 100], 4, 3, 3)
    assert len(list(centroid_clusters.cluster(df, k=4, rounds=3, dim=3, block=4).collect())) == len(rows)


def test_clusters_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = Counter(con.execute(centroid_clusters.oracle_sql()).fetchall())
    assert Counter(tuple(r) for r in centroid_clusters.op12_centroid_clusters(spark, SF).collect()) == want


def test_hilbert_places_are_a_continuous_walk():
    for n, bits in ((2, 3), (3, 2), (4, 2), (5, 1)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        place = centroid_clusters.hilbert_places(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        walk = cells[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_boxes_never_lose_the_nearest_and_do_prune():
    rng = np.random.default_rng(8)
    c = rng.integers(-200, 200, (40, 6))
    counts = []
    for _ in range(300):
        v = c[rng.integers(40)] + rng.integers(-12, 13, (30, 6))
        alive = centroid_clusters.candidates(v.min(0), v.max(0), c)
        counts.append(len(alive))
        d = ((v[:, None] - c) ** 2).sum(2)
        assert set(np.nonzero(d == d.min(1)[:, None])[1]) <= set(alive)
    assert np.mean(counts) < 4


# ---- 13: conversation repair ------------------------------------------------------------

BLANK = " \t\n\x0b\x0c\r"


def all_edits(rows):
    """The least (cost, audit) over every sequence of edits; rows: (initial, must be deleted, truncated)."""
    bound, out = 2 * len(rows), []

    def go(i, cost, audit, roles):
        if cost > bound:
            return
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            out.append((cost, audit))
        for r in "ua":
            go(i, cost + 5, audit + "I", roles + r)
        if i < len(rows):
            initial, forced, truncated = rows[i]
            go(i + 1, cost + 2, audit + "D", roles)
            if not forced:
                go(i + 1, cost + 5 * truncated, audit + "K", roles + (initial or "?"))
                for r in "ua":
                    go(i + 1, cost + 1 + 5 * truncated, audit + "R", roles + r)

    go(0, 0, "", "")
    return min(out)


def search(rows):
    s = conversation_repair.Search()
    for r in rows:
        s.row(*r)
    return s.finish()


def test_search_equals_all_edit_sequences():
    rng = random.Random(6)
    for _ in range(1500):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.random() < 0.15, rng.random() < 0.2) for _ in range(rng.randint(0, 5))]
        assert search(rows) == all_edits(rows), rows


def test_search_holds_only_what_is_open():
    s = conversation_repair.Search()
    for i in range(30_000):
        s.row("ua"[i % 2], i % 97 == 0, i % 89 == 0)
        assert sum(len({id(r): r for x in s.survivors.values() for r in x[3]}) for _ in (0,)) <= 8
        assert sum(len(r.edits) for r in {id(r): r for x in s.survivors.values() for r in x[3]}.values()) < 64


def test_search_is_linear_where_nothing_coalesces():
    import time
    start = time.monotonic()
    cost, audit = search([("u", False, False)] * 50_000)
    assert time.monotonic() - start < 30 and cost == 25_000 and len(audit) == 50_000


def conversation(rows):
    """The contract's columns from rows after damage, in order: (turn, role, text)."""
    seen, flags = set(), []
    for _, role, text in rows:
        core = text.rstrip(BLANK)
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((role, text))
        flags.append(fault)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1], b[1][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(rows, rows[1:]))
    cost, audit = all_edits([(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, flags)])
    lines, state, at = [], "", 0
    for edit in audit:
        new = "assistant" if state == "u" else "user"
        if edit == "I":
            lines.append(f"{new}:")
        else:
            _, role, text = rows[at]
            at += 1
            if edit == "D":
                continue
            new = role if edit == "K" else new
            lines.append(f"{new}:{text}")
        state = new[0]
    return (gaps, flags.count("blank"), flags.count("duplicate"), flags.count("truncated"), illegal, cost, audit, sha("\n".join(lines)))


def damaged(rows):
    """{conv_id: rows in order} of raw (conv_id, turn, role, text) rows."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (2 if kind == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {c: sorted(r, key=key) for c, r in out.items()}


FIELDS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(df):
    return Counter(tuple(r) for r in conversation_repair.repair(conversation_repair.damage(df)).select(*FIELDS).collect())


def test_repair_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = Counter((c, *conversation(r)) for c, r in damaged(rows).items())
    got = Counter(tuple(r) for r in conversation_repair.op13_conversation_repair(spark, SF).select(*FIELDS).collect())
    assert got == want and len(want) >= 20


def test_repair_of_odd_rows(spark):
    rng = random.Random(9)
    rows = []
    for conv in range(150):
        for _ in range(rng.randint(1, 5)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(["user", "assistant", "system", "tool", "", None, "User"]),
                         rng.choice(["Yes.", "No", "", " \n", None, "Same text.", "Same text!\x0b ", "é?"])))
    rows += [(None, 1, "user", "x."), (None, 2, "assistant", "y."), (500, None, None, None)]
    rows += [rows[5]] * 3                                       # repeated rows
    rows += [(600, 3, "user", "word " * 50_000 + "."), (600, 4, "assistant", "ok.")]
    drop = next(c for c in range(1000, 9000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows.append((drop, 1, "user", "gone."))
    df = spark.createDataFrame([(*r, "x", True, 7) for r in rows],
                               "conv_id long, turn long, role string, text string, audit string, seen boolean, copies int")
    want = {c: conversation(r) for c, r in damaged(rows).items()}
    got = repaired(df)
    assert got == Counter((c, *w) for c, w in want.items())
    assert want[drop] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert repaired(df.where("false")) == Counter()


def test_repaired_rows_are_well_formed(spark):
    rows = conversation_repair.damage(spark.read.parquet(f"{SF}/conversations.parquet"))
    edits = conversation_repair.find_edits(rows)
    out = conversation_repair.repaired(rows, edits).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r["conv_id"], r["place"])):
        by.setdefault(r["conv_id"], []).append(r)
    found = {r["conv_id"]: r["repaired_sha256"] for r in conversation_repair.hashes(rows, edits).collect()}
    for conv, lines in by.items():
        assert re.fullmatch(r"s?(ua)+", "".join(r["role"][0] for r in lines))
        assert found[conv] == sha("\n".join(f"{r['role']}:{r['text']}" for r in lines))
    assert all(found[c] == sha("") for c in found.keys() - by.keys())


def test_a_long_conversation(spark):
    n = 4000
    df = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                               F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                               F.concat(F.lit("Turn "), F.col("id"), F.lit(".")).alias("text"), F.lit(1).alias("copies"))
    r = conversation_repair.repair(df).first()
    want = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:Turn {i}." for i in range(n))
    assert (r["cost"], r["audit"], r["repaired_sha256"]) == (0, "K" * n, sha(want))

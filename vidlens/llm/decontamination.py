"""Benchmark decontamination by SimHash windows (operator 4).

Where a text shares a word shingle with the benchmark, the item lengths that
hold the shingle give item-sized windows around it; windows without a shared
shingle have similarity 0 and need no fingerprint. Every window gets the
64-bit SimHash of its words. Fingerprints are cut into five blocks; two within
14 bits of each other are within 2 bits in some block, so an index of all
block values up to 2 bits from each item's finds every item of the window's
size within that radius. Candidates are verified by the exact weighted Jaccard
similarity of their shingles. DataFrame functions only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm.common import materialize, table

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
BLOCK_RADIUS = 2
RADIUS = len(BLOCKS) * (BLOCK_RADIUS + 1) - 1
NOT_WORD = r"[^\p{L}\p{N}]+"
BROADCAST_ROWS = 2_000_000


def words(text):
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def let(value, use):
    """use(value) with the value computed once: inside a lambda a plain expression is computed for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingles(w, k: int = SHINGLE):
    """Hashes of all k-word shingles in order; none with fewer words."""
    def of(w):
        last = F.size(w) - k
        at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))

    return let(w, of)


def simhash(w):
    """The 64-bit SimHash of an array of words, each occurrence counted; a tied bit is 0."""
    def of(hashes):
        def bit(b):
            votes = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1)).cast("int") * 2 - 1)
            return F.when(votes > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(bit(b)))

    return let(F.transform(w, lambda x: F.xxhash64(x)), of)


def block(fingerprint, at: int, bits: int):
    return F.shiftrightunsigned(fingerprint, at).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def masks(bits: int, radius: int = BLOCK_RADIUS) -> list[int]:
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _near_values(i: int, at: int, bits: int):
    """The block's number with every value up to the block radius from the item's."""
    own = block(F.col("item_print"), at, bits)
    return F.transform(F.array(*map(F.lit, masks(bits))), lambda m: F.struct(F.lit(i).alias("i"), own.bitwiseXOR(m).alias("v")))


def item_table(benchmark: DataFrame, k: int = SHINGLE) -> DataFrame:
    """item_id, n, item_words, shingle list of the items with at least one shingle."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") >= k)
    return items.select("item_id", F.size("w").alias("n"), "w", shingles(F.col("w"), k).alias("sh"))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, k: int = SHINGLE) -> DataFrame:
    """doc_id, item_id, start_word, n_words, similarity: for each document and item the best window.

    Shingles weigh ln(1 + items / items that hold it), those of no item as if
    one held it. Of equally similar windows the earliest counts. Items and
    documents with fewer than k words, null and empty ones match nothing. A
    document shorter than an item is one window. Rows that repeat an id and
    its text count as one document; a null id is kept as null.
    """
    items = materialize(item_table(benchmark, k), "bench-items")
    # First occurrence of each distinct shingle of each item, and the shingle's weight.
    places = items.select("item_id", "n", F.posexplode("sh").alias("q", "s"))
    df = places.select("item_id", "s").distinct().groupBy("s").agg(F.count("*").alias("df"))
    n_items = items.count()
    weights = df.select("s", F.log1p(F.lit(float(n_items)) / F.col("df")).alias("weight"))
    single = F.log1p(F.lit(float(n_items)))
    offsets = places.select("s", "q", "n").distinct()
    small = offsets.count() <= BROADCAST_ROWS

    base = docs.where("text is not null").select(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    spread = base.select("doc_id", "text_key", F.posexplode(shingles(words(F.col("text")), k)).alias("p", "s"))
    hits = spread.join(F.broadcast(offsets) if small else offsets, "s")
    starts = hits.select("doc_id", "text_key", F.greatest(F.col("p") - F.col("q"), F.lit(0)).alias("start"), "n").distinct()
    per_doc = starts.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "n")).alias("windows"))
    hit_docs = materialize(per_doc, "bench-hits")
    with_words = base.alias("b").join(
        hit_docs.alias("h"), F.col("b.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("b.text_key") == F.col("h.text_key")))
    windows = with_words.select("b.doc_id", "b.text_key", words(F.col("b.text")).alias("w"), F.explode("h.windows").alias("at"))
    # A window that would run past the end is moved back to end there.
    begin = F.greatest(F.least(F.col("at.start"), F.size("w") - F.col("at.n")), F.lit(0))
    windows = windows.select("doc_id", begin.alias("start"), F.col("at.n").alias("n"), F.slice("w", begin + 1, F.col("at.n")).alias("w"))
    windows = windows.withColumn("print", simhash(F.col("w"))).withColumn("sh", F.array_distinct(shingles(F.col("w"), k)))
    windows = materialize(windows.distinct(), "bench-windows")

    prints = items.select("item_id", "n", simhash(F.col("w")).alias("item_print"))
    near = F.flatten(F.array(*[_near_values(i, at, bits) for i, (at, bits) in enumerate(BLOCKS)]))
    index = prints.select("item_id", "n", "item_print", F.explode(near).alias("x")).select("item_id", "n", "item_print", "x.*")
    probes = windows.select("doc_id", "start", "n", "print", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), block(F.col("print"), at, bits).alias("v")) for i, (at, bits) in enumerate(BLOCKS)])).alias("x"))
    probes = probes.select("doc_id", "start", "n", "print", "x.*")
    candidates = (probes.join(index, ["n", "i", "v"])
                  .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
                  .select("doc_id", "start", "n", "print", "item_id").distinct())

    # Exact similarity: the weights of both sides and of what they share.
    item_sets = items.select("item_id", F.array_distinct("sh").alias("item_sh"))
    pairs = candidates.alias("c").join(windows.alias("w"), F.col("c.doc_id").eqNullSafe(F.col("w.doc_id")) & (
        F.col("c.start") == F.col("w.start")) & (F.col("c.n") == F.col("w.n")) & (F.col("c.print") == F.col("w.print")))
    pairs = pairs.select("c.doc_id", "c.item_id", "c.start", F.size("w.w").alias("n_words"), "w.sh").join(item_sets, "item_id")
    both = pairs.select("doc_id", "item_id", "start", "n_words", F.xxhash64("sh").alias("window_key"), F.explode(
        F.transform(F.array_union("sh", "item_sh"), lambda s: F.struct(
            s.alias("s"), F.array_contains(F.col("sh"), s).alias("a"), F.array_contains(F.col("item_sh"), s).alias("b")))).alias("x"))
    weighed = both.select("doc_id", "item_id", "start", "n_words", "window_key", F.col("x.s").alias("s"), "x.a", "x.b").join(
        F.broadcast(weights) if small else weights, "s", "left").withColumn("weight", F.coalesce("weight", single))
    scored = weighed.groupBy("doc_id", "item_id", "start", "n_words", "window_key").agg(
        (F.sum(F.when(F.col("a") & F.col("b"), F.col("weight")).otherwise(0.0)) / F.sum("weight")).alias("similarity"))
    scored = scored.withColumn("similarity", F.round("similarity", 9))
    best = scored.where(F.col("similarity") >= similarity).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("m"))
    return best.select("doc_id", "item_id", (-F.col("m.back")).alias("start_word"), F.col("m.n_words").alias("n_words"),
                       F.col("m.similarity").alias("similarity"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The same windows in DuckDB, each compared with every item of its size that shares a shingle.
ORACLE = r"""
with d as (select distinct doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from documents where text is not null),
b as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from benchmark where text is not null),
bs as (select item_id, len(w) as n, q, array_to_string(w[q + 1:q + 5], ' ') as s from b, unnest(range(0, len(w) - 4)) as t(q)),
wt as (select s, ln(1 + (select count(distinct item_id) from bs) / count(distinct item_id)) as weight from bs group by s),
ds as (select doc_id, w, p, array_to_string(w[p + 1:p + 5], ' ') as s from d, unnest(range(0, len(w) - 4)) as t(p)),
win as (select distinct ds.doc_id, greatest(least(greatest(p - q, 0), len(ds.w) - n), 0) as start, n, ds.w from ds join bs on ds.s = bs.s),
ws as (select distinct doc_id, start, n, least(n, len(w) - start) as n_words, array_to_string(w[start + i + 1:start + i + 5], ' ') as s
  from win, unnest(range(0, least(n, len(w) - start) - 4)) as t(i)),
wsum as (select doc_id, start, n, any_value(n_words) as n_words, sum(coalesce(weight, ln(1 + (select count(distinct item_id) from bs)))) as total
  from ws left join wt using (s) group by doc_id, start, n),
bsum as (select item_id, n, sum(weight) as total from (select distinct item_id, n, s from bs) join wt using (s) group by item_id, n),
shared as (select ws.doc_id, ws.start, ws.n, x.item_id, sum(weight) as both_w from ws
  join (select distinct item_id, n, s from bs) x on x.s = ws.s and x.n = ws.n join wt on wt.s = ws.s group by all),
sim as (select h.doc_id, h.item_id, h.start, wsum.n_words, round(both_w / (wsum.total + bsum.total - both_w), 9) as similarity
  from shared h join wsum on wsum.doc_id = h.doc_id and wsum.start = h.start and wsum.n = h.n join bsum on bsum.item_id = h.item_id)
select doc_id, item_id, arg_max(start, (similarity, -start))::int as start_word, arg_max(n_words, (similarity, -start))::int as n_words,
  max(similarity) as similarity from sim where similarity >= 0.8 group by doc_id, item_id"""

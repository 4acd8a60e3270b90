"""Substring dedup by unit hashing (operator 6).

A text falls into units: a run of characters up to and with the next line
feeds or sentence marks. Units are normalised (A-Z lowered, white space
collapsed) and hashed to 128 bits; of each digest the occurrence with the
smallest (doc_id, start) over the whole table stays. Other occurrences that
stand together in a text form a run, and a run with enough words is removed.
Every removed stretch is reported with its offsets in the original text.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vidlens.llm.common import materialize, table

UNIT = re.compile(r"[^\n.!?]+[\n.!?]*|[\n.!?]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER_TO_LOWER = {u: u + 32 for u in range(65, 91)}
LAST = (1 << 63) - 1
#: A digest with more than this part of all units is joined by broadcast.
FREQUENT = 1000


def units(text: str):
    """(place, start, end, words, digest halves) of each unit with a word; offsets in code points.

    Units without a word take no place, so they do not part their neighbours.
    """
    place = -1
    for m in UNIT.finditer(text):
        words = WORD.findall(m.group())
        if words:
            place += 1
            d = hashlib.blake2b(" ".join(words).translate(UPPER_TO_LOWER).encode("utf-8", "surrogatepass"), digest_size=16).digest()
            yield place, m.start(), m.end(), len(words), int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


UNIT_SCHEMA = "doc_id long, text_key long, place int, start long, end long, words int, d1 long, d2 long"


def unit_table(docs: DataFrame, batch: int = 50_000) -> DataFrame:
    def split(batches):
        rows = []
        for pdf in batches:
            for doc_id, key, text in zip(pdf["doc_id"], pdf["text_key"], pdf["text"], strict=True):
                for u in units(text):
                    rows.append((doc_id, key, *u))
                    if len(rows) >= batch:
                        yield frame(rows)
                        rows = []
        if rows:
            yield frame(rows)

    def frame(rows):
        out = pd.DataFrame(rows, columns=["doc_id", "text_key", "place", "start", "end", "words", "d1", "d2"])
        return out.astype({"doc_id": "Int64"})

    texts = docs.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return texts.mapInPandas(split, UNIT_SCHEMA)


def repeated_runs(docs: DataFrame, min_words: int = 25, min_unit_words: int = 4, keyed: bool = False) -> DataFrame:
    """Stretches to remove: doc_id, start, end, n_units, n_words, first_doc_id.

    Only units of at least ``min_unit_words`` words count towards
    ``min_words``, so that chance repeats of very short sentences remove
    nothing by themselves. first_doc_id is the smallest document that keeps
    one of the run's units. Null and empty texts have no units. A null id
    ranks last. Rows that repeat an id and its text count as one document. With
    ``keyed``, text_key tells apart the texts of one id, for ``remove_runs``.
    """
    u = materialize(unit_table(docs), "dedup-units")
    rank = F.coalesce("doc_id", F.lit(LAST))
    kept = (u.groupBy("d1", "d2").agg(F.min(F.struct(rank.alias("rank"), "start")).alias("kept"), F.count("*").alias("n"))
            .where("n > 1"))
    # At most FREQUENT digests can each hold that share of all units: their rows
    # meet a broadcast of that many rows, and no digest's units meet in one task.
    share = u.count() / FREQUENT
    often = F.broadcast(kept.where(F.col("n") > share).drop("n"))
    seldom = kept.where(F.col("n") <= share).drop("n")
    again = u.join(often, ["d1", "d2"]).unionByName(
        u.join(often, ["d1", "d2"], "left_anti").join(seldom, ["d1", "d2"]))
    again = again.where(F.struct(rank.alias("rank"), "start") > F.col("kept"))
    # Units that follow one another share the difference of place and rank; a group is at most one document.
    w = Window.partitionBy("doc_id", "text_key").orderBy("place")
    again = again.dropDuplicates(["doc_id", "text_key", "place"])
    runs = again.withColumn("run", F.col("place") - F.row_number().over(w))
    return (runs.groupBy("doc_id", "text_key", "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_units"),
                 F.sum("words").cast("long").alias("n_words"),
                 F.sum(F.when(F.col("words") >= min_unit_words, F.col("words")).otherwise(0)).alias("long_words"),
                 F.min("kept.rank").alias("first_doc_id"))
            .where(F.col("long_words") >= min_words)
            .select("doc_id", "start", "end", "n_units", "n_words", "first_doc_id", *["text_key"] * keyed))


def remove_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """docs with the runs cut from ``text``; other columns and rows stay. Runs are those of ``repeated_runs``;
    where an id may stand for different texts, ``keyed`` ones, as each is cut from its own text alone."""
    keyed = "text_key" in runs.columns
    keys = [F.col("doc_id").alias("__cut_id"), *[F.col("text_key").alias("__cut_key")] * keyed]
    cuts = runs.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("__cuts"))
    mine = F.col("doc_id").eqNullSafe(F.col("__cut_id"))
    mine = mine & (F.xxhash64("text") == F.col("__cut_key")) if keyed else mine

    @F.pandas_udf("string")
    def cut(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        def one(t, spans):
            if t is None or spans is None:
                return t
            out, at = [], 0
            for s in spans:
                out.append(t[at:s["start"]])
                at = max(at, s["end"])
            return "".join(out) + t[at:]
        return pd.Series([one(t, c) for t, c in zip(texts, cuts, strict=True)], dtype=object)

    joined = docs.join(cuts, mine, "left")
    return joined.withColumn("text", cut("text", "__cuts")).select(*docs.columns)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_runs(table(spark, sf_dir, "documents"))


def oracle_sql(min_words: int = 25, min_unit_words: int = 4) -> str:
    return rf"""
with parts as (select distinct doc_id, hash(text) as text_key, regexp_extract_all(text, '[^\n.!?]+[\n.!?]*|[\n.!?]+') as p from documents where text is not null),
u as (select doc_id, text_key, unnest(range(0, len(p))) as place, unnest(p) as unit from parts),
s as (select *, sum(length(unit)) over (partition by doc_id, text_key order by place) as "end",
  regexp_extract_all(unit, '[^\x20\x09-\x0D]+') as w from u),
n as (select doc_id, text_key, row_number() over (partition by doc_id, text_key order by place) as place, ("end" - length(unit))::bigint as start, "end"::bigint as "end", len(w) as words,
  translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from s where len(w) > 0),
k as (select *, first_value(doc_id) over (partition by norm order by doc_id, start) as kept_doc,
  row_number() over (partition by norm order by doc_id, start) as occurrence from n),
again as (select *, place - row_number() over (partition by doc_id, text_key order by place) as run from k where occurrence > 1)
select doc_id, min(start) as start, max("end") as "end", count(*) as n_units, sum(words)::bigint as n_words, min(kept_doc) as first_doc_id
from again group by doc_id, text_key, run
having sum(case when words >= {min_unit_words} then words else 0 end) >= {min_words}"""

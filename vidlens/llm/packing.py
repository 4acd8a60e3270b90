"""Best-fit packing by linear grouping (operator 1).

Lengths are at most the capacity, so the plan is made on the histogram of
lengths, which has as many entries however large the corpus. Large lengths are
sorted and cut into groups of equal cardinality; each is rounded up to its
group's largest, and configurations of these few sizes are chosen, each the
fullest that holds the largest size left, as often as the counts allow. The
groups' actual pieces then take the slots, by rank, and the space that they
leave is filled with the small lengths, longest first, each into the least
space that takes it. Only histograms and the plan pass through the driver;
ranks, slots and offsets are computed for all pieces in Spark.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vidlens.llm.common import materialize, table
from vidlens.llm.lm_scoring import slices
from vidlens.llm.words import word_spans

CAPACITY = 2048
GROUPS = 512
MARKS = b".,;:!?"


class WordMemo:
    """Token ids of words, by the words' hashes, so that a word is encoded once while the memo holds it."""

    def __init__(self, tokenizer_file: str, size: int = 1_500_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.size = size
        self.clear()

    def clear(self):
        self.keys, self.begin, self.count = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def lookup(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray):
        """(first id, number of ids) of every word; the ids are in ``self.ids``."""
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        known = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        if not known.all():
            if len(self.keys) + int((~known).sum()) > self.size and len(self.keys):
                self.clear()
                known[:] = False
            new = np.flatnonzero(~known)
            raw = data.tobytes()
            ids = self.encode([raw[starts[i]:ends[i]].decode() for i in first[new].tolist()])
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            begin = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, np.fromiter((x for y in ids for x in y), np.uint32, int(count.sum()))])
            keys = np.concatenate([self.keys, distinct[new]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.begin, self.count = np.concatenate([self.begin, begin])[order], np.concatenate([self.count, count])[order]
            at = np.searchsorted(self.keys, distinct)
        return self.begin[at][inverse], self.count[at][inverse]


_MEMOS: dict[str, WordMemo] = {}


def token_ids(texts: pa.Array, memo: WordMemo) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, first id of each text and the total at the end), as the tokenizer gives them.

    White space separates the tokenizer's words and its merges stay within
    them, so words are encoded by themselves; so are marks behind a letter.
    Texts with the start of a special token's name are encoded whole: case
    matters there. Upper case A-Z needs no word of its own, as the tokenizer
    lowers it.
    """
    special = np.asarray(pa.compute.fill_null(pa.compute.match_substring(texts, "<|"), False))
    plain = texts
    if special.any():
        plain = pa.compute.if_else(pa.array(special), pa.scalar("", texts.type), texts)
    hashes, starts, ends, first, data = word_spans(plain, MARKS)
    if len(hashes) == 0 and not special.any():
        return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    begin, count = memo.lookup(hashes, starts, ends, data)
    total = np.concatenate([[0], np.cumsum(count)])
    out = memo.ids[np.repeat(begin - total[:-1], count) + np.arange(total[-1])]
    bounds = total[first]
    if special.any():
        parts, sizes = [], []
        for i in range(len(texts)):
            part = np.array(memo.encode([texts[i].as_py()])[0], np.uint32) if special[i] else out[bounds[i]:bounds[i + 1]]
            parts.append(part)
            sizes.append(len(part))
        out, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])
    return out, bounds


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, chunk long, row long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer_file: str | None = None,
           vocabulary: str = "word_bpe_49k.json", end_id: int = 0) -> DataFrame:
    """The pieces of every row's ids, an end id behind each document.

    A null or empty text has the end id alone. Only documents longer than the
    capacity are cut. ``chunk`` and ``row`` name the task and the piece's place in it.
    """
    def cut(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer_file
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(vocabulary)
        memo = _MEMOS.setdefault(path, WordMemo(path))
        chunk, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch):
                ids, bounds = token_ids(part["text"], memo)
                docs_, piece, start, length, crc = [], [], [], [], []
                for i, doc_id in enumerate(part["doc_id"].to_pylist()):
                    own = np.append(ids[bounds[i]:bounds[i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, at in enumerate(range(0, len(own), capacity)):
                        one = own[at:at + capacity]
                        docs_.append(doc_id)
                        piece.append(k)
                        start.append(at)
                        length.append(len(one))
                        crc.append(zlib.crc32(one.tobytes()))
                n = len(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs_, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(n, chunk, np.int64)),
                     pa.array(np.arange(row, row + n))], ["doc_id", "piece", "start", "length", "ids_crc32", "chunk", "row"])
                row += n

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(cut, PIECE_SCHEMA)


def ranked(df: DataFrame, key: str) -> DataFrame:
    """df, which has chunk and row, with ``rank``: a number from 0 among the rows of equal key, without gaps.

    Rows are numbered within their chunk; only one row a chunk and key is
    summed over the chunks, so a key with most rows stays spread.
    """
    counts = df.groupBy(key, "chunk").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "chunk", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    nth = F.row_number().over(Window.partitionBy(key, "chunk").orderBy("row")) - 1
    return (df.withColumn("__nth", nth).join(offsets, [key, "chunk"])
            .withColumn("rank", (F.col("__nth") + F.col("__before")).cast("long")).drop("__nth", "__before"))


def histogram(df: DataFrame, col: str, capacity: int) -> np.ndarray:
    """Rows by value of ``col``, from 0 to the capacity."""
    out = np.zeros(capacity + 1, dtype=np.int64)
    for r in df.groupBy(col).agg(F.count("*").alias("n")).collect():
        out[r[col]] = r["n"]
    return out


def group_lengths(hist: np.ndarray, small: int, groups: int):
    """Groups of equal cardinality of the lengths above ``small``, in descending order.

    Returns the rounded size and the count of each group and, by length, the
    rank that its first piece has in that order.
    """
    lengths = np.arange(len(hist) - 1, small, -1)
    counts = hist[lengths]
    first = np.zeros(len(hist), dtype=np.int64)
    first[lengths] = np.cumsum(counts) - counts
    n = int(counts.sum())
    bounds = np.unique(np.linspace(0, n, min(groups, n) + 1).astype(np.int64)) if n else np.zeros(1, np.int64)
    ends = np.cumsum(counts)
    sizes = lengths[np.searchsorted(ends, bounds[:-1], side="right")]
    return sizes, np.diff(bounds), first


def fullest(sizes: np.ndarray, left: np.ndarray, must: int, capacity: int) -> dict[int, int]:
    """The fullest configuration that holds size ``must`` once and keeps within the counts left."""
    room = int(capacity - sizes[must])
    by = np.full(room + 1, -1, dtype=np.int64)  # the last size used to reach each fill
    reached = np.zeros(room + 1, dtype=bool)
    reached[0] = True
    for g in range(must, len(sizes)):
        s = int(sizes[g])
        copies = min(int(left[g]) - (g == must), room // s) if s <= room else 0
        for _ in range(copies):
            new = np.flatnonzero(reached[:room + 1 - s] & ~reached[s:]) + s
            if not len(new):
                break
            # A fill gains its first way only, so walking back never uses a size too often.
            reached[new] = True
            by[new] = g
        if reached[room]:
            break
    fill = int(np.flatnonzero(reached)[-1])
    out = {must: 1}
    while fill > 0:
        g = int(by[fill])
        out[g] = out.get(g, 0) + 1
        fill -= int(sizes[g])
    return out


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """(configuration, bins of it) pairs that use up all counts."""
    left, out = counts.copy(), []
    while True:
        some = np.flatnonzero(left > 0)
        if not len(some):
            return out
        config = fullest(sizes, left, int(some[0]), capacity)
        times = max(1, min(int(left[g]) // k for g, k in config.items()))
        config = {g: min(k, int(left[g])) for g, k in config.items()}
        for g, k in config.items():
            left[g] -= k * times
        out.append((config, times))


def fill_small(space: np.ndarray, small: np.ndarray, capacity: int):
    """Small lengths, longest first, each into the least space that takes it; else into new bins.

    ``space`` counts the bins by the space they have left. Returns cohorts of
    bins with equal history, (space at first or -1 for new bins, first rank in
    that class, bins, {length: copies a bin}).
    """
    by_space: dict[int, list] = {r: [[r, 0, int(n), {}]] for r, n in enumerate(space) if n}
    new_bins = 0
    for length in range(len(small) - 1, 0, -1):
        left = int(small[length])
        r = length
        while left and r <= capacity:
            if not by_space.get(r):
                r += 1
                continue
            cohort = by_space[r].pop()
            copies = max(1, min(r // length, left // cohort[2]))
            if left < cohort[2]:
                by_space[r].append([cohort[0], cohort[1] + left, cohort[2] - left, dict(cohort[3])])
                cohort[2] = left
            cohort[3][length] = cohort[3].get(length, 0) + copies
            left -= copies * cohort[2]
            by_space.setdefault(r - copies * length, []).append(cohort)
            r = length
        if left:
            per = capacity // length
            for bins, copies in ((left // per, per), (1, left % per)):
                if bins and copies:
                    by_space.setdefault(capacity - copies * length, []).append([-1, new_bins, bins, {length: copies}])
                    new_bins += bins
    return [c for cs in by_space.values() for c in cs if c[3] or c[0] == -1], new_bins


def slot_lookup(entries, keys: np.ndarray, ranks: np.ndarray):
    """For each (key, rank): the entry that holds the rank and the bin within it.

    ``entries[key]`` lists (entry, copies a bin, bins); ranks run through the entries in order.
    """
    entry, bin_ = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for key in np.unique(keys):
        rows = np.flatnonzero(keys == key)
        which, copies, bins = (np.array(x, dtype=np.int64) for x in zip(*entries[int(key)], strict=True))
        ends = np.cumsum(copies * bins)
        k = np.searchsorted(ends, ranks[rows], side="right")
        inside = ranks[rows] - (ends[k] - copies[k] * bins[k])
        entry[rows], bin_[rows] = which[k], inside // copies[k]
    return entry, bin_


def pack(rows: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, small: int | None = None) -> DataFrame:
    """rows, which have a ``length`` of 1 to the capacity, with sequence_id and offset.

    ``small`` is the largest length that fills gaps instead of taking part in
    the configurations. Equal lengths are interchangeable; rows take slots by
    their place in the written table. An empty table gives an empty table.
    Sequence numbers are unique but may have gaps.
    """
    small = capacity // 8 if small is None else small
    hist = histogram(rows, "length", capacity)
    sizes, counts, first = group_lengths(hist, small, groups)
    plan = configurations(sizes, counts, capacity)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    bases = np.concatenate([[0], np.cumsum([times for _, times in plan])]).astype(np.int64)
    slots: dict[int, list] = {}
    for k, (config, times) in enumerate(plan):
        for g, copies in config.items():
            slots.setdefault(g, []).append((k, copies, times))

    @F.pandas_udf("long")
    def large_bin(length: pd.Series, rank: pd.Series) -> pd.Series:
        order = first[length.to_numpy()] + rank.to_numpy()
        group = np.searchsorted(bounds, order, side="right") - 1
        k, b = slot_lookup(slots, group, order - bounds[group])
        return pd.Series(bases[k] + b)

    names = [c for c in rows.columns if c not in ("chunk", "row")]
    all_ranked = ranked(rows, "length")
    large = materialize(all_ranked.where(F.col("length") > small).select(
        *names, large_bin("length", "rank").alias("sequence_id")), "pack-large")

    bins = large.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("space"))
    bins = materialize(bins.select("sequence_id", "space", F.spark_partition_id().cast("long").alias("chunk"),
                                   F.monotonically_increasing_id().alias("row")), "pack-bins")
    space = histogram(bins, "space", capacity)
    cohorts, _ = fill_small(space, np.where(np.arange(capacity + 1) <= small, hist, 0), capacity)
    entries: dict[int, list] = {}
    for k, (_, _, n, content) in enumerate(cohorts):
        for length, copies in content.items():
            entries.setdefault(length, []).append((k, copies, n))
    origin = np.array([c[0] for c in cohorts] or [0], np.int64)
    begin = np.array([c[1] for c in cohorts] or [0], np.int64)

    @F.pandas_udf("space long, rank long")
    def small_bin(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        k, b = slot_lookup(entries, length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"space": origin[k], "rank": begin[k] + b})

    little = all_ranked.where(F.col("length") <= small).select(*names, small_bin("length", "rank").alias("to"))
    little = little.select(*names, F.col("to.space").alias("__space"), F.col("to.rank").alias("__rank"))
    at = ranked(bins, "space").select(F.col("space").alias("__space"), F.col("rank").alias("__rank"), "sequence_id")
    into_old = little.where("__space >= 0").join(at, ["__space", "__rank"]).select(*names, "sequence_id")
    into_new = little.where("__space < 0").select(*names, (F.col("__rank") + int(bases[-1])).alias("sequence_id"))
    placed = large.unionByName(into_old).unionByName(into_new)
    # One sequence is at most ``capacity`` rows.
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *names).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, **tokenizer) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row.

    Repeated and null ids are documents of their own.
    """
    cut = materialize(pieces(docs, capacity, **tokenizer), "pack-pieces")
    return pack(cut, capacity, groups).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))

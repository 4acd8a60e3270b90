"""Language-model scores from an Elias-Fano n-gram trie (operator 10).

The model is a bigram model with Dirichlet smoothing,
P(w | v) = (c(v, w) + m P(w)) / (c(v) + m) with P(w) = (c(w) + 1) / (N + V + 1).
Its logarithm is a sum of three parts, log m P(w), -log (c(v) + m), and for
bigrams that were seen a gain log (1 + c(v, w) / (m P(w))), so each part can be
computed wherever its counts lie.

Texts are dealt to slices. A slice's distinct bigrams go to shards by predicted
word; a shard counts those of training rows, lays a trie over the counts,
queries it for every bigram it was sent and answers the slice with a count for
each word and a gain for each bigram, and the slice sums them over its rows. A
word frequent enough to fill a shard by itself is dealt by word and
predecessor, over all shards, and its count travels with the job. The trie's
levels are flat arrays that can be mapped from a file: sorted words, pointers
to their predecessors as an Elias-Fano sequence, predecessors relative to their
word, and quantised gains.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm.common import crc_mod, table
from vidlens.llm.words import mix, word_hashes

# No word has these hashes but by chance of 2**-64.
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
PRIOR = 128.0
SHARD_TOKENS = 1_500_000
SLICE_BYTES = 8 << 20
MAX_HOT = 1_000_000


class EliasFano:
    """A non-decreasing sequence of integers: low bits in an array, high parts in unary."""

    def __init__(self, low: np.ndarray, bits: int, unary: np.ndarray, n: int):
        self.low, self.bits, self.unary, self.n = low, bits, unary, n
        zeros = np.flatnonzero(np.unpackbits(unary, bitorder="little") == 0)
        # first[h]: number of elements whose high part is below h
        self.first = np.concatenate([[0], zeros - np.arange(len(zeros))])

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        width = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        bits = next(b for b in (8, 16, 32) if width <= b or b == 32)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(bits)).astype(np.int64)
        buckets = (universe >> bits) + 1
        ones = np.zeros(n + buckets, dtype=np.uint8)
        ones[high + np.arange(n)] = 1
        low = (values & np.uint64((1 << bits) - 1)).astype(f"<u{bits // 8}")
        unary = np.packbits(ones, bitorder="little")
        # Pad with ones: a padding zero would look like a bucket.
        if len(ones) % 8:
            unary[-1] |= np.uint8((0xFF << (len(ones) % 8)) & 0xFF)
        return EliasFano(low, bits, unary, n)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        high = np.searchsorted(self.first, i, side="right") - 1
        return (high.astype(np.uint64) << np.uint64(self.bits)) | self.low[i].astype(np.uint64)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first element at least x, for each x; n where there is none."""
        high = (x >> np.uint64(self.bits)).astype(np.int64)
        low = (x & np.uint64((1 << self.bits) - 1)).astype(self.low.dtype)
        last = len(self.first) - 1
        lo = self.first[np.minimum(high, last)]
        hi = self.first[np.minimum(high + 1, last)]
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.low[mid] < low[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)


class Trie:
    """Words, their predecessors and quantised gains, in one buffer.

    ``pointers[i]`` is the first predecessor of word i; predecessors are 32-bit
    ids relative to their word, made monotone by the word's rank on top.
    """

    PARTS = (("words", "<u8"), ("pointer_low", None), ("pointer_unary", "u1"), ("child_low", None),
             ("child_unary", "u1"), ("codes", "u1"), ("book", "<f4"))

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts
        self.words, self.codes, self.book = parts["words"], parts["codes"], parts["book"]
        self.pointers = self._sequence("pointer")
        self.children = self._sequence("child")

    def _sequence(self, name):
        low = self.parts[f"{name}_low"]
        return EliasFano(low, low.dtype.itemsize * 8, self.parts[f"{name}_unary"], len(low))

    @staticmethod
    def build(words: np.ndarray, word_rank: np.ndarray, context: np.ndarray, gain: np.ndarray) -> Trie:
        """Distinct sorted words; for each seen bigram, in order, its word's rank, 32-bit context and gain."""
        pointers = EliasFano.encode(np.searchsorted(word_rank, np.arange(len(words) + 1)), len(context) + 1)
        key = (word_rank.astype(np.uint64) << np.uint64(32)) | context.astype(np.uint64)
        children = EliasFano.encode(key, max(1, len(words)) << 32)
        codes, book = quantise(gain)
        return Trie({"words": words.astype("<u8"), "pointer_low": pointers.low, "pointer_unary": pointers.unary,
                     "child_low": children.low, "child_unary": children.unary, "codes": codes, "book": book})

    def to_bytes(self) -> bytes:
        arrays = [np.ascontiguousarray(self.parts[name]) for name, _ in self.PARTS]
        head = np.array([x for a in arrays for x in (a.dtype.itemsize, len(a))], dtype="<i8").tobytes()
        return head + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)

    @staticmethod
    def from_buffer(buf) -> Trie:
        """A view of the buffer (bytes or a mapped file); nothing is copied."""
        head = np.frombuffer(buf, dtype="<i8", count=2 * len(Trie.PARTS)).reshape(-1, 2)
        at, parts = head.nbytes, {}
        for (name, kind), (size, n) in zip(Trie.PARTS, head.tolist(), strict=True):
            parts[name] = np.frombuffer(buf, dtype=kind or f"<u{size}", count=n, offset=at)
            at += size * n + (-size * n) % 8
        return Trie(parts)

    def gain(self, word_rank: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Gains of (word, context) pairs, 0 for those not in the trie."""
        begin, end = self.pointers[word_rank].astype(np.int64), self.pointers[word_rank + 1].astype(np.int64)
        x = (word_rank.astype(np.uint64) << np.uint64(32)) | context.astype(np.uint64)
        at = self.children.successor(x)
        inside = (at >= begin) & (at < end)
        out = np.zeros(len(x))
        hit = np.flatnonzero(inside)
        hit = hit[self.children[at[hit]] == x[hit]]
        out[hit] = self.book[self.codes[at[hit]]]
        return out


def quantise(values: np.ndarray, size: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """One-byte codes and their book: the values themselves when few, else means of equally full bins."""
    distinct, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    if len(distinct) <= size:
        return inverse.astype(np.uint8), distinct.astype("<f4")
    bins = np.minimum((np.cumsum(counts) - counts) * size // len(values), size - 1)
    weight = np.bincount(bins, weights=counts, minlength=size)
    book = np.bincount(bins, weights=counts * distinct, minlength=size) / np.maximum(weight, 1)
    return bins[inverse].astype(np.uint8), book.astype("<f4")


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES):
    """The batch in pieces of about ``size`` text bytes; a longer text is a piece of its own."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch["text"]), 0))
    at = 0
    total = np.cumsum(lengths)
    while at < len(lengths):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + size, side="right")))
        yield batch.slice(at, end - at)
        at = end


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, predecessor, row) of all tokens; every text ends with END."""
    hashes, first = word_hashes(texts)
    n = len(texts)
    row = np.repeat(np.arange(n), np.diff(first) + 1)
    ends = first[1:] + np.arange(n)
    cur = np.empty(len(hashes) + n, dtype=np.uint64)
    is_end = np.zeros(len(cur), dtype=bool)
    is_end[ends] = True
    cur[is_end] = END
    cur[~is_end] = hashes
    prev = np.empty_like(cur)
    if n:
        prev[1:] = cur[:-1]
        prev[first[:-1] + np.arange(n)] = START
    return cur, prev, row


def count_words(batches):
    """Distinct tokens of each slice: hash, occurrences, occurrences in training rows."""
    for batch in batches:
        for part in slices(batch):
            cur, _, row = tokens(part["text"])
            train = np.asarray(part["train"]).astype(np.int64)[row]
            h, inverse = np.unique(cur, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(np.bincount(inverse, minlength=len(h))),
                 pa.array(np.bincount(inverse, weights=train, minlength=len(h)).astype(np.int64))], ["h", "n", "n_train"])


class Slice:
    """The distinct (token, predecessor) pairs of one slice's texts, ordered by shard, token and predecessor.

    Made alike wherever the slice's texts are, in whatever order: its pairs go to
    the shards in this order and their answers come back in it.
    """

    def __init__(self, texts, shards: int, hot: np.ndarray):
        cur, prev, self.row = tokens(texts)
        low = (mix(prev) & np.uint64(0xFFFFFFFF))
        route = mix(cur)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, cur), len(hot) - 1)
            route = np.where(hot[at] == cur, mix(route ^ low), route)
        shard = (((route >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)
        del prev, route
        order = np.lexsort((low, cur, shard))
        cur, low, shard = cur[order], low[order], shard[order]
        new_word = np.append(True, (cur[1:] != cur[:-1]) | (shard[1:] != shard[:-1]))[:len(cur)]
        new_pair = new_word | np.append(True, low[1:] != low[:-1])[:len(cur)]
        self.pair_of = np.empty(len(cur), dtype=np.int32)
        self.pair_of[order] = np.cumsum(new_pair, dtype=np.int32) - 1
        at = np.flatnonzero(new_pair)
        self.shard, self.context = shard[at], low[at].astype("<u4")
        first = new_word[at]
        self.word_of = np.cumsum(first, dtype=np.int32) - 1
        self.word_at = np.flatnonzero(first)
        self.words = cur[at][self.word_at]

    def messages(self, train: np.ndarray):
        """(shard, its words, pairs and their occurrences in training rows) for every shard of the slice."""
        seen = np.bincount(self.pair_of, weights=train[self.row], minlength=len(self.shard)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.append(True, self.shard[1:] != self.shard[:-1])), len(self.shard))
        words = np.searchsorted(self.word_at, cuts)
        for a, b, wa, wb in zip(cuts[:-1], cuts[1:], words[:-1], words[1:], strict=True):
            yield int(self.shard[a]), to_blob(self.words[wa:wb].astype("<u8"), narrow(self.word_at[wa:wb] - a),
                                              self.context[a:b], narrow(seen[a:b]))


def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the least width that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))).newbyteorder("<"))


def to_blob(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.kind), a.dtype.itemsize, len(a)))], "<i4")
    return head.tobytes() + b"".join(a.tobytes() for a in arrays)


def from_blob(blob) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, "<i4", 1)[0])
    at, out = 4 + 12 * n, []
    for kind, size, length in np.frombuffer(blob, "<i4", 3 * n, 4).reshape(-1, 3).tolist():
        out.append(np.frombuffer(blob, f"<{chr(kind)}{size}", length, at))
        at += out[-1].nbytes
    return out


def score_shard(blobs, n_train: int, vocabulary: int, hot: np.ndarray, hot_counts: np.ndarray, prior: float):
    """The answers to one shard's messages: their words' counts in training rows and their pairs' gains."""
    parts = [from_blob(b) for b in blobs]
    n_words, n_pairs = [len(p[0]) for p in parts], [len(p[2]) for p in parts]
    cur = np.concatenate([np.repeat(p[0], np.diff(np.append(p[1].astype(np.int64), len(p[2])))) for p in parts])
    context, times = np.concatenate([p[2] for p in parts]), np.concatenate([p[3].astype(np.int64) for p in parts])
    order = np.lexsort((context, cur))
    cur, context, times = cur[order], context[order], times[order]
    new_word = np.append(True, cur[1:] != cur[:-1])
    new_pair = new_word | np.append(True, context[1:] != context[:-1])
    word_at, pair_at = np.flatnonzero(new_word), np.flatnonzero(new_pair)
    words = cur[word_at]
    word_of = (np.cumsum(new_word, dtype=np.int32) - 1)[pair_at]
    del cur
    count = np.add.reduceat(times, word_at)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        count = np.where(hot[at] == words, hot_counts[at], count)
    p = (count + 1.0) / (n_train + vocabulary + 1.0)
    pair_count, context = np.add.reduceat(times, pair_at), context[pair_at]
    seen = np.flatnonzero(pair_count > 0)
    gain = np.log10(1.0 + pair_count[seen] / (prior * p[word_of[seen]]))
    trie = Trie.from_buffer(Trie.build(words, word_of[seen], context[seen], gain).to_bytes())
    gains = np.empty(len(order), dtype="<f4")
    gains[order] = trie.gain(np.searchsorted(trie.words, words)[word_of], context)[np.cumsum(new_pair, dtype=np.int32) - 1]
    for part, end, n in zip(parts, np.cumsum(n_pairs), n_pairs, strict=True):
        book, code = np.unique(gains[end - n:end], return_inverse=True)
        yield to_blob(narrow(count[np.searchsorted(words, part[0])]), book, narrow(code))


def score_rows(part: Slice, blobs, n_rows: int, n_train: int, vocabulary: int, n_docs: int, prior: float):
    """Sums for each of a slice's rows, from the shards' answers in the order of the shards."""
    answers = [from_blob(b) for b in blobs]
    count = np.concatenate([a[0].astype(np.int64) for a in answers])
    gain = np.concatenate([a[1][a[2]] for a in answers]).astype(np.float64)
    if len(count) != len(part.words) or len(gain) != len(part.shard):
        raise RuntimeError("a slice and the answers to it differ")
    p = (count + 1.0) / (n_train + vocabulary + 1.0)
    as_context = np.where(part.words == END, -np.log10(n_docs + prior), -np.log10(count + prior))
    word_score = np.log10(p * prior) + as_context
    word = part.word_of[part.pair_of]
    return {"n_tokens": np.bincount(part.row, minlength=n_rows),
            "n_known": np.bincount(part.row, weights=(count > 0)[word], minlength=n_rows).astype(np.int64),
            "base_score": np.bincount(part.row, weights=np.log10(p)[word], minlength=n_rows),
            "score": np.bincount(part.row, weights=word_score[word] + gain[part.pair_of], minlength=n_rows)}


def lm_scores(docs: DataFrame, held_out, prior: float = PRIOR, shard_tokens: int = SHARD_TOKENS,
              slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from rows that are not held out; a row with a null id is not held
    out. Null and empty texts consist of the end token alone. One row out per
    row in. With no training rows all counts are 0. Seen bigrams are told apart
    by their word and 32 bits of their context.

    Rows are dealt to slices of about ``slice_bytes`` of text; a slice's distinct
    pairs go to the shards and are answered with a count a word and a gain a
    pair, so that what is moved follows the slices' pairs, however many shards
    a document's words lie on.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       (~F.coalesce(held_out, F.lit(False))).alias("train"))
    words = (rows.select("text", "train").mapInArrow(count_words, "h long, n long, n_train long")
             .groupBy("h").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train")))
    end = F.lit(int(END))
    got = words.agg(F.sum("n"), F.sum("n_train"), F.count_if(F.col("n_train") > 0),
                    F.max(F.when(F.col("h") == end, F.col("n_train"))),
                    F.count_if(F.col("n") >= shard_tokens),
                    F.collect_list(F.when(F.col("n") >= shard_tokens, F.struct("h", "n_train")))).first()
    n_all, n_train, vocabulary, n_docs, n_hot, hot_rows = (x or 0 for x in got)
    if n_hot > MAX_HOT:
        raise ValueError(f"{n_hot} words fill a shard of {shard_tokens} tokens each; give a larger shard_tokens")
    hot_rows = sorted((np.uint64(r["h"] % (1 << 64)), r["n_train"]) for r in hot_rows or [])
    hot = np.array([h for h, _ in hot_rows], dtype=np.uint64)
    hot_counts = np.array([c for _, c in hot_rows], dtype=np.int64)
    shards = max(1, -(-n_all // shard_tokens))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A token has at least a byte to be held with, so that empty texts fill slices too.
    n_slices = max(1, -(-(n_bytes + n_all) // slice_bytes))

    def run_deal(group: pa.Table) -> pa.Table:
        train = np.asarray(group["train"]).astype(np.int64)
        out = list(Slice(group["text"], shards, hot).messages(train))
        return pa.table({"shard": pa.array([s for s, _ in out], pa.int32()),
                         "slice": pa.array([group["slice"][0].as_py()] * len(out), pa.int64()),
                         "message": pa.array([m for _, m in out], pa.binary())})

    def run_score(group: pa.Table) -> pa.Table:
        out = list(score_shard([m.as_buffer() for m in group["message"]], n_train, vocabulary, hot, hot_counts, prior))
        return pa.table({"shard": group["shard"], "slice": group["slice"], "answer": pa.array(out, pa.binary())})

    def run_finish(group: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("shard")
        sums = score_rows(Slice(group["text"], shards, hot), [a.as_buffer() for a in answers["answer"]], len(group),
                          n_train, vocabulary, n_docs, prior)
        return pa.table({"doc_id": group["doc_id"], "held_out": pa.compute.invert(group["train"]),
                         "n_tokens": sums["n_tokens"], "n_known": sums["n_known"],
                         "train_tokens": np.full(len(group), n_train, dtype=np.int64),
                         "base_score": sums["base_score"], "score": sums["score"]})

    # The input part keeps copies of one row, whatever their number, from meeting in one slice.
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(n_slices)))
    messages = sliced.groupBy("slice").applyInArrow(run_deal, "shard int, slice long, message binary")
    answers = messages.groupBy("shard").applyInArrow(run_score, "shard int, slice long, answer binary")
    return sliced.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        run_finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                    "base_score double, score double")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)

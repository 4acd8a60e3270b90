"""Language identification with hyperdimensional profiles (operator 5).

Each letter has a random vector of +1/-1 drawn from its code point. The vector
of an n-gram binds (multiplies) its letters' vectors, each rotated by its
place in the n-gram; a text's profile bundles (adds) the vectors of its
n-grams, and a language's prototype bundles the unit profiles of its training
texts. A text gets the language whose prototype has the largest cosine.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm.common import crc_mod, table

DIM = 512
N = 3
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


@functools.lru_cache(maxsize=8192)
def letter_vector(code: int, place: int = 0, dim: int = DIM) -> np.ndarray:
    """The random vector of a code point, rotated by its place from an n-gram's end."""
    bits = np.random.Generator(np.random.Philox(key=code + 1)).integers(0, 2, dim, dtype=np.int8)
    return np.roll((2 * bits - 1).astype(np.int8), place)


def ngram_vector(codes, dim: int = DIM) -> np.ndarray:
    v = letter_vector(codes[-1], 0, dim)
    for place in range(1, len(codes)):
        v = v * letter_vector(codes[-1 - place], place, dim)
    return v


def ngram_counts(text: str, n: int = N, chunk: int = 1 << 18):
    """(distinct n-grams as keys of 21 bits a code point, counts) over lower-cased letters;
    a run of anything else stands as one space. None when there is no letter.
    Long texts are counted in chunks that overlap by n - 1 characters."""
    letters, total, carry, any_letter = _is_letter(), {}, np.empty(0, np.int64), False
    for at in range(0, len(text), chunk):
        codes = np.frombuffer(text[at:at + chunk].lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
        is_letter = letters[codes]
        any_letter = any_letter or bool(is_letter.any())
        codes = np.concatenate([carry if at else np.array([32]), np.where(is_letter, codes, 32)])
        if at + chunk >= len(text):
            codes = np.append(codes, 32)
        word = codes != 32
        word[0] = True
        word[1:] |= codes[:-1] != 32
        codes = codes[word]
        carry = codes[-(n - 1):] if len(codes) >= n - 1 else codes
        if len(codes) >= n:
            key = codes[:len(codes) - n + 1].copy()
            for i in range(1, n):
                key = (key << 21) | codes[i:len(codes) - n + 1 + i]
            key.sort()
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            grams, counts = key[first], np.diff(np.append(first, len(key)))
            if not total and at + chunk >= len(text):
                return (grams, counts) if any_letter else (None, None)
            for g, c in zip(grams.tolist(), counts.tolist(), strict=True):
                total[g] = total.get(g, 0) + c
    if not any_letter or not total:
        return None, None
    keys = np.sort(np.fromiter(total, np.int64, len(total)))
    return keys, np.array([total[k] for k in keys.tolist()])


class Profiler:
    """Profiles of texts; keeps a bounded table of n-gram vectors."""

    def __init__(self, dim: int = DIM, n: int = N, size: int = 16384):
        self.dim, self.n, self.size = dim, n, size
        self.table = np.empty((size, dim), dtype=np.float32)
        self.keys, self.slots = np.empty(0, np.int64), np.empty(0, np.int64)

    def vectors(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of sorted distinct n-gram keys, at most ``size`` of them."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if known.all():
            return self.table[self.slots[at]]
        new = keys[~known]
        if len(self.keys) + len(new) > self.size:
            self.keys, self.slots, new = self.keys[:0], self.slots[:0], keys
        first = len(self.keys)
        for i, key in enumerate(new.tolist()):
            self.table[first + i] = ngram_vector([(key >> (21 * j)) & 0x1FFFFF for j in reversed(range(self.n))], self.dim)
        merged = np.concatenate([self.keys, new])
        order = np.argsort(merged, kind="stable")
        self.keys = merged[order]
        self.slots = np.concatenate([self.slots, np.arange(first, first + len(new))])[order]
        return self.table[self.slots[np.searchsorted(self.keys, keys)]]

    def profile(self, text: str) -> np.ndarray | None:
        keys, counts = ngram_counts(text, self.n)
        if counts is None:
            return None
        v = np.zeros(self.dim, dtype=np.float32)
        for at in range(0, len(keys), 2048):
            v += counts[at:at + 2048].astype(np.float32) @ self.vectors(keys[at:at + 2048])
        norm = np.linalg.norm(v)
        return v / norm if norm > 0 else None


def learn(docs: DataFrame, label: str = "lang", per_label: int = 3000, dim: int = DIM, n: int = N,
          max_labels: int = 4096) -> tuple[list[str], np.ndarray]:
    """(labels, unit prototypes) from rows with non-null text and label.

    ``per_label`` bounds the expected number of training rows of a label: a
    label with more takes those whose hash falls under its share. The model is
    labels x dim numbers; more than ``max_labels`` labels are refused.
    """
    rows = docs.select("doc_id", "text", F.col(label).alias("label")).where("text is not null and label is not null")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).limit(max_labels + 1).collect()}
    if len(sizes) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    if not sizes:
        return [], np.zeros((0, dim), dtype=np.float32)
    share = F.create_map(*[x for k, c in sizes.items() for x in (F.lit(k), F.lit(min(1.0, per_label / c)))])
    picked = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share[F.col("label")] * (1 << 30))

    def bundle(batches):
        profiler, sums = Profiler(dim, n), {}
        for pdf in batches:
            for lab, text in zip(pdf["label"], pdf["text"], strict=True):
                p = profiler.profile(text)
                if p is not None:
                    sums[lab] = sums.get(lab, 0) + p.astype(np.float64)
        for lab, v in sums.items():
            yield pd.DataFrame({"label": lab, "i": np.arange(dim), "v": v})

    sums = picked.select("label", "text").mapInPandas(bundle, "label string, i int, v double")
    got = sums.groupBy("label", "i").agg(F.sum("v").alias("v")).toPandas().sort_values(["label", "i"])
    labels = sorted(got["label"].unique())
    protos = got["v"].to_numpy().reshape(len(labels), dim)
    norms = np.linalg.norm(protos, axis=1, keepdims=True)
    return labels, (protos / np.where(norms > 0, norms, 1)).astype(np.float32)


def judge(docs: DataFrame, labels: list[str], protos: np.ndarray, n: int = N) -> DataFrame:
    """docs with ``__lang`` (lang_pred, score) added: the nearest prototype and its cosine, 0 at least.

    ``und`` with score 0 for a null text, a text without letters, and for all
    texts when no label was learned. Of equal cosines the first label in order wins.
    """
    @F.pandas_udf("lang_pred string, score double")
    def classify(s: pd.Series) -> pd.DataFrame:
        profiler, out = Profiler(protos.shape[1], n), []
        for text in s:
            p = profiler.profile(text) if text and labels else None
            if p is None:
                out.append((UNKNOWN, 0.0))
                continue
            cos = protos @ p
            k = int(np.argmax(cos))
            out.append((labels[k], float(min(1.0, max(0.0, cos[k])))))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return docs.withColumn("__lang", classify("text"))


def language_id(docs: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learning from rows that are not held out.

    A row with a null id is not held out. One row out per row in.
    """
    base = docs.select("doc_id", "text", "lang").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    labels, protos = learn(base.where(~F.col("held_out")))
    return (judge(base.select("doc_id", "held_out", "text"), labels, protos)
            .select("doc_id", "held_out", "__lang.lang_pred", "__lang.score"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"), crc_mod("doc_id", 4) == 2)

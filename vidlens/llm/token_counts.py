"""Token counts by the whole-token shortcut (operator 7).

The vocabulary never merges a character with a following word mark, so a text
falls apart before each run of word marks into units that the merges cannot
join; ``prove`` checks this on the vocabulary and refuses it otherwise. Of
the vocabulary's strings it also finds those that alone encode as one token.
A unit among these counts one without a merge; the rest go to the tokenizer's
own merges, once per distinct unit while a bounded memo holds it.
"""

from __future__ import annotations

import functools
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm.common import table

MARK = "▁"
UNITS = re.compile(f"{MARK}+[^{MARK}]*")


def load(model_file: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model_file)


@functools.lru_cache(maxsize=4)
def prove(model_file: str):
    """(tokenizer, vocabulary strings proven to encode alone as one token).

    Raises ValueError when a piece has a word mark after another character, or
    is matched ahead of the merges: then units would not be independent.
    """
    sp = load(model_file)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    normal = [p for i, p in enumerate(pieces)
              if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) or sp.is_byte(i))]
    if any(MARK in p.lstrip(MARK) for p in normal):
        raise ValueError("the vocabulary joins word marks to preceding characters")
    if sp.encode("a a") != sp.encode("a") * 2 or sp.encode("a▁a") != sp.encode("a a"):
        raise ValueError("the model does not put a word mark before every word")
    marked = [p for p in normal if p.startswith(MARK) and p != MARK]
    whole = {p for p, ids in zip(marked, sp.encode([p[1:] for p in marked], num_threads=1), strict=True) if len(ids) == 1}
    if sp.piece_to_id(MARK) != sp.unk_id():
        whole.add(MARK)
    return sp, frozenset(whole)


def count_tokens(texts, model_file: str, memo: dict, memo_size: int = 300_000, chunk: int = 1 << 20) -> list[int]:
    """Tokens of each text; ``memo`` keeps counts of units that needed merges."""
    sp, whole = prove(model_file)
    out = []
    for text in texts:
        if not text:
            out.append(0)
            continue
        marked = MARK + text.replace(" ", MARK)
        total, units = 0, Counter()
        for m in re.finditer(UNITS, marked) if len(marked) > chunk else ():
            units[m.group()] += 1
        for unit, n in (units or Counter(UNITS.findall(marked))).items():
            if unit in whole:
                total += n
                continue
            k = memo.get(unit)
            if k is None:
                k = len(sp.encode(unit[1:]))
                if len(unit) <= 64:
                    if len(memo) >= memo_size:
                        memo.clear()
                    memo[unit] = k
            total += n * k
        out.append(total)
    return out


def n_tokens(text: Column, model_file: str | None = None, vocabulary: str = "piece_bpe_32k.model") -> Column:
    """Token count of a text column as a long; null and empty texts count 0."""
    @F.pandas_udf("long")
    def count(s: pd.Series) -> pd.Series:
        import public_tokenizers
        return pd.Series(count_tokens(s, model_file or public_tokenizers.path(vocabulary), _MEMO), dtype="int64")
    return count(text)


_MEMO: dict[str, int] = {}


def token_counts(docs: DataFrame, limit: int = 4096, model_file: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    One row out per row in, repeated or null ids included; null and empty
    texts have 0 bytes and 0 tokens. Long texts are counted whole.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select("doc_id", text.alias("text"))
            .select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                    n_tokens(F.col("text"), model_file).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))

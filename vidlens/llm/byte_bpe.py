"""Byte-level BPE encoding and decoding with the tokenizers library (operator 11).

Ranked byte strings become a ``tokenizers`` BPE model over byte characters:
each byte is written as one printable character, and every way to cut a ranked
string into two ranked strings is a merge, in the order of the whole string's
rank. The text is split by the pattern, each match is encoded separately, and
a match that is itself ranked is one token. Texts are encoded over Arrow
batches, a bounded number of bytes at a time; longer texts are cut where a
white space follows another character, which no match of the pattern spans.
A match is encoded once while a bounded memo holds it. Matches are found by
``regex``, but by the library's own splitter in texts with characters that
Python's tables don't know yet, as the two may class these differently.

Decoding maps token characters back to bytes. A token may hold a part of a
character; offsets then name the whole character, and text comes from the
bytes of the whole sequence (or, in a stream, once the character is complete).
"""

from __future__ import annotations

import base64
import codecs
import functools
import gc
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm.common import table
from vidlens.llm.words import released

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text encoded at once; a single match of the pattern may be longer.
PART = 1 << 20

IDS_SCHEMA = "doc_id {id}, ids array<int>"
OFFSETS_SCHEMA = IDS_SCHEMA + ", byte_starts array<long>, char_starts array<long>, char_ends array<long>"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str):
    """(tokenizer, bytes of each id). Raises ValueError where a byte has no rank."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    ranks = read_ranks(path)
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte needs a rank")
    shown = byte_characters()
    text_of = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        merges += [(text_of[token[:i]], text_of[token[i:]]) for i in range(1, len(token))
                   if token[:i] in ranks and token[i:] in ranks]
    tokenizer = Tokenizer(models.BPE(vocab={text_of[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    byte_of = {c: b for b, c in enumerate(shown)}
    table = [b""] * (max(ranks.values()) + 1)
    for text, i in tokenizer.get_vocab(with_added_tokens=False).items():
        table[i] = bytes(byte_of[c] for c in text)
    return tokenizer, table


def default_files(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers
    return path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN


def parts(text: str, size: int = PART):
    """The text in parts of about ``size`` characters, each begun by a white space behind another character."""
    at = 0
    while len(text) - at > size:
        cut = re.compile(r"(?<=\S)\s").search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


class Encoder:
    """Encodes texts; keeps the ids of up to ``memo`` distinct matches of the pattern."""

    def __init__(self, path: str, pattern: str, memo: int = 400_000):
        import regex
        self.tokenizer, self.names = load(path, pattern)
        self.lengths = np.array([len(t) for t in self.names], dtype=np.int64)
        self.find, self.unknown, self.memo = regex.compile(pattern).findall, unknown_characters(), memo
        self.shown = dict(enumerate(byte_characters()))
        self.forget()

    def forget(self):
        self.number: dict[str, int] = {}        # match -> its place in ``firsts``
        self.firsts, self.ids = np.zeros(1, np.int64), np.empty(0, np.int32)

    def matches(self, text: str) -> list[str]:
        if text.isascii() or not self.unknown[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return self.find(text)
        return [m for m, _ in self.tokenizer.pre_tokenizer[0].pre_tokenize_str(text)]

    def learn(self, matches: list[str]) -> None:
        shown = (m.encode().decode("latin-1").translate(self.shown) for m in matches)
        ids = [[t.id for t in self.tokenizer.model.tokenize(m)] for m in shown]
        self.number.update(zip(matches, range(len(self.firsts) - 1, len(self.firsts) - 1 + len(matches))))
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) + self.firsts[-1]
        self.firsts = np.concatenate([self.firsts, ends])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]) - len(self.ids))])

    def encode(self, texts: list[str], size: int = PART) -> list[np.ndarray]:
        """The ids of each text, ``size`` characters or one part at a time."""
        collecting = gc.isenabled()
        gc.disable()        # many short-lived lists, no cycles
        try:
            return self._encode(texts, size)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str], size: int) -> list[np.ndarray]:
        out, waiting, total = [[] for _ in texts], [], 0

        def flush():
            if len(self.number) > self.memo:
                self.forget()
            matches = [m for _, found in waiting for m in found]
            number = list(map(self.number.get, matches))
            new = dict.fromkeys(m for m, k in zip(matches, number) if k is None) if None in number else ()
            if new:
                self.learn(list(new))
                number = list(map(self.number.get, matches))
            at = np.array(number, dtype=np.int64)
            first, n = self.firsts[at], self.firsts[at + 1] - self.firsts[at]
            ends = np.concatenate([[0], np.cumsum(n)])
            ids = self.ids[np.repeat(first - ends[:-1], n) + np.arange(ends[-1])]
            begin = 0
            for i, found in waiting:
                out[i].append(ids[ends[begin]:ends[begin + len(found)]])
                begin += len(found)

        for i, text in enumerate(texts):
            for part in parts(text, size) if text else ():
                waiting.append((i, self.matches(part)))
                total += len(part)
                if total >= size:
                    flush()
                    waiting, total = [], 0
        if waiting:
            flush()
        return [np.concatenate(x) if x else np.empty(0, np.int32) for x in out]


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@functools.lru_cache(maxsize=1)
def unknown_characters() -> np.ndarray:
    """For each code point, whether Python's Unicode tables leave it unassigned."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


def offsets(data: bytes, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, first character, character after the last) of each token of a text's UTF-8 bytes."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    leads = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # character number of each byte, from 1
    if not len(ids):
        return starts, starts, ends
    return starts, leads[starts] - 1, leads[ends - 1]


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, with_offsets: bool = False) -> DataFrame:
    """doc_id and ids of every row; with ``with_offsets`` also where each token stands.

    byte_starts count the text's UTF-8 bytes; char_starts and char_ends are the
    characters that a token touches, so two tokens that share a character both
    name it. One row out per row in, repeated or null ids included; null and
    empty texts have no ids. Whole texts are encoded, long ones in parts. Other
    columns are not read.
    """
    path, pattern = default_files(path, pattern)

    def run(batches):
        code = encoder(path, pattern)

        def listed(arrays, kind):
            at = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
            flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
            return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, kind))

        for batch in sized(batches, 8 * PART):
            texts = batch.column("text").to_pylist()
            ids = code.encode([t or "" for t in texts])
            columns = [batch.column("doc_id"), listed(ids, pa.int32())]
            if with_offsets:
                where = [offsets((t or "").encode(), i, code.lengths) for t, i in zip(texts, ids, strict=True)]
                columns += [listed([w[k] for w in where], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "byte_starts", "char_starts", "char_ends"][:len(columns)])

    schema = (OFFSETS_SCHEMA if with_offsets else IDS_SCHEMA).format(id=docs.schema["doc_id"].dataType.simpleString())
    return docs.select("doc_id", "text").mapInArrow(lambda b: released(run(b)), schema)


def sized(batches, size: int):
    """The batches in slices of about ``size`` bytes of text, one row at least."""
    for batch in batches:
        n = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(n.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + size, side="right")))
            yield batch.slice(at, end - at)
            at = end


def decode_ids(ids, names: list[bytes]) -> bytes:
    """The bytes of a token sequence; an id outside the vocabulary is an error that names it."""
    try:
        return b"".join(map(names.__getitem__, ids))
    except IndexError:
        raise ValueError(f"ids {sorted({int(i) for i in ids if i >= len(names)})[:5]} are not in the vocabulary") from None


def decode_stream(ids, names: list[bytes]):
    """The text of each token in turn; a character split over tokens comes with its last one.

    Bytes that form no character come as U+FFFD, at the end also those of an unfinished one.
    """
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for i in ids:
        yield decoder.decode(decode_ids([i], names))
    rest = decoder.decode(b"", final=True)
    if rest:
        yield rest


def listed_ids(lists: pa.Array):
    """The ids of each list, None for a null one."""
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    at = 0
    for n in pa.compute.list_value_length(lists).to_pylist():
        yield None if n is None else ids[at:at + n].tolist()
        at += n or 0


def decoded(ids: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """The bytes of a column of ids; null where it is null."""
    path, pattern = default_files(path, pattern)

    @F.arrow_udf("binary")
    def decode(lists: pa.Array) -> pa.Array:
        _, names = load(path, pattern)
        return pa.array([None if x is None else decode_ids(x, names) for x in listed_ids(lists)], pa.binary())

    return decode(ids)


def decoded_text(ids: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """The text of a column of ids, U+FFFD for bytes that form no character."""
    path, pattern = default_files(path, pattern)

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        _, names = load(path, pattern)
        return pa.array([None if x is None else decode_ids(x, names).decode("utf-8", "replace")
                         for x in listed_ids(lists)], pa.string())

    return decode(ids)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    rows = encode(table(spark, sf_dir, "documents"))
    rows = rows.select("*", decoded(F.col("ids")).alias("bytes"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))

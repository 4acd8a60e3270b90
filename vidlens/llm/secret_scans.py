"""Secret scans with structural confirmation (operator 8).

Three patterns give the base findings. Beyond them, base64 and hex runs and
dotted tokens are candidates only: each is decoded and reported when its
content has the structure it should have. A key is DER whose nested lengths
fill their parents exactly and whose members are those of a private key
encoding, or the OpenSSH container whose length-prefixed fields fill it; a
signed token's header and payload are JSON objects, the header naming an
algorithm.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm.common import table

# The base patterns and the least lengths of a finding.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "token", "pem", "key")

#: A line end or blank as string literals write it, with any number of backslashes; a slash may be written with some, too.
ESCAPED = r"\\+(?:[nrt]|u000[9aAdD])"
PEM_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*PRIVATE KEY)-----")
PEM_BODY = re.compile(rf"(?:[A-Za-z0-9+/=\s:,.\"'-]|{ESCAPED}|\\+[/\s\"'])*+")
B64_RUN = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
# Base64 in lines: a first line that may begin DER or the OpenSSH container, further lines, and what parts them.
FIRST_LINE = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\[nrt])|(?<=u000[9aAdD]))(?:M(?:[A-Za-z0-9+/]|\\+/){15,}|b3BlbnNzaC1r)")
LINE = re.compile(r"(?:[A-Za-z0-9+/]|\\+/)+")
BREAK = re.compile(rf"(?:\s|{ESCAPED}|\\+(?=[\s\"'])|[\"',]|(?<=[\s\"'])\+(?=[\s\"']))+")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")

SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06
#: A key in lines has no more bytes than two DER length bytes can tell.
LONGEST_KEY = 4 + 0xFFFF
SSH_MAGIC = b"openssh-key-v1\0"


def tlv(buf: bytes, pos: int, end: int):
    """(tag, content start, content end) of the DER item at pos, or None unless it ends within ``end``."""
    if pos + 2 > end:
        return None
    tag, size, at = buf[pos], buf[pos + 1], pos + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end or buf[at] == 0:
            return None
        size = int.from_bytes(buf[at:at + n], "big")
        at += n
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= end else None


def members(buf: bytes, start: int, end: int):
    """The items that exactly fill start..end, or None."""
    out = []
    while start < end:
        item = tlv(buf, start, end)
        if item is None or len(out) > 16:
            return None
        out.append(item)
        start = item[2]
    return out


def is_der_key(buf: bytes) -> bool:
    """A private key as PKCS#1, SEC1, DSA, PKCS#8 or encrypted PKCS#8."""
    top = tlv(buf, 0, len(buf))
    if top is None or top[0] != SEQUENCE or top[2] != len(buf):
        return False
    parts = members(buf, top[1], top[2])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    if tags[0] == INTEGER and parts[0][2] - parts[0][1] == 1 and buf[parts[0][1]] <= 1:
        if len(tags) in (6, 9) and set(tags) == {INTEGER}:
            return all(p[2] > p[1] for p in parts)
        if tags[1:2] == [OCTETS] and set(tags[2:]) <= {0xA0, 0xA1} and 16 <= parts[1][2] - parts[1][1] <= 66:
            return True
        if tags[1:3] == [SEQUENCE, OCTETS] and set(tags[3:]) <= {0xA0, 0xA1, 0x81}:
            return starts_with_oid(buf, parts[1])
    return tags == [SEQUENCE, OCTETS] and starts_with_oid(buf, parts[0]) and parts[1][2] - parts[1][1] >= 32


def starts_with_oid(buf: bytes, item) -> bool:
    inner = members(buf, item[1], item[2])
    return bool(inner) and inner[0][0] == OID and inner[0][2] > inner[0][1]


def openssh_size(buf) -> int | None:
    """Bytes of the OpenSSH container at the start of ``buf`` by its lengths, or None at the first impossible one."""
    pos = len(SSH_MAGIC)
    if buf[:pos] != SSH_MAGIC:
        return None

    def number() -> int | None:
        nonlocal pos
        raw = buf[pos:pos + 4]
        pos += 4
        value = int.from_bytes(raw, "big")
        return value if len(raw) == 4 and value <= LONGEST_KEY else None

    def skip(times: int) -> bool:
        nonlocal pos
        for _ in range(times):
            size = number()
            if size is None or pos + size > LONGEST_KEY:
                return False
            pos += size
        return True

    if not skip(3) or not (keys := number()) or keys > 64 or not skip(keys + 1):
        return None
    return pos


def is_openssh_key(buf) -> bool:
    return openssh_size(buf) == len(buf)


def is_key(buf: bytes) -> bool:
    return is_der_key(buf) or is_openssh_key(buf)


def from_base64(s: str, url: bool = False):
    s = s.rstrip("=")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def der_size(buf) -> int | None:
    """Bytes of the DER key at the start of ``buf`` by its first length, or None where no key begins so."""
    head = buf[:12]
    if len(head) < 12 or head[0] != SEQUENCE:
        return None
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    if n > 2 or head[1] == 0x80 or head[2 + n] not in (INTEGER, SEQUENCE):
        return None
    if head[2 + n] == INTEGER and (head[3 + n] != 1 or head[4 + n] > 1):
        return None
    return 2 + n + (int.from_bytes(head[2:2 + n], "big") if n else head[1])


class Lines:
    """Base64 that goes on over lines from ``start``, read as far as it is asked for.

    ``begins`` are the places in the text and in the joined base64 where each line begins.
    """

    def __init__(self, text: str, start: int):
        self.text, self.start, self.at, self.end, self.ended = text, start, start, start, False
        self.begins, self.offsets, self.stops, self.parts, self.n = [], [], [], [], 0
        self.joined = ""

    def reach(self, n: int) -> None:
        """Read until ``n`` characters are there or the lines end; somewhat more, so that few reads do."""
        if self.n >= n or self.ended:
            return
        n = max(n, self.n + max(4096, self.n // 2))
        while self.n < n and not self.ended:
            m = LINE.match(self.text, self.at)
            if m is None:
                self.ended = True
                break
            part = re.sub(r"\\+", "", m[0])
            self.begins.append(self.at)
            self.offsets.append(self.n)
            self.parts.append(part)
            self.n += len(part)
            self.end = self.at = m.end()
            self.stops.append(self.end)
            gap = BREAK.match(self.text, self.at)
            if gap is None:
                self.ended = True
            else:
                self.at = gap.end()
        self.joined = self.joined + "".join(self.parts)
        self.parts = []

    def offset(self, place: int) -> int:
        """The joined base64's place for a place in the text that a line read so far holds."""
        i = bisect.bisect_right(self.begins, place) - 1
        return self.offsets[i] + len(re.sub(r"\\+", "", self.text[self.begins[i]:place]))

    def stop(self, n: int) -> int | None:
        """Where in the text the line ends that ends with the n-th character, or None if none does."""
        i = bisect.bisect_left(self.offsets, n) - 1
        ends = self.offsets[i + 1] if i + 1 < len(self.offsets) else self.n
        return self.stops[i] if i >= 0 and ends == n else None


class Decoded:
    """Bytes of joined base64 from ``offset`` on, decoded where they are looked at."""

    def __init__(self, lines: Lines, offset: int, size: int | None = None):
        self.lines, self.offset, self.size = lines, offset, size

    def __len__(self):
        return self.size

    def __getitem__(self, key):
        if isinstance(key, int):
            return self[key:key + 1][0]
        a, b = key.start or 0, key.stop
        first, last = self.offset + a // 3 * 4, self.offset + -(-b // 3) * 4
        self.lines.reach(last)
        chars = self.lines.joined[first:last]
        raw = from_base64(chars[:len(chars) - (len(chars) % 4 == 1)]) or b""
        return raw[a % 3:a % 3 + b - a]


def key_in_lines(lines: Lines, offset: int) -> int | None:
    """End of the key whose base64 begins at ``offset`` of the joined lines, or None. Only the bytes that
    hold lengths and tags are decoded, and no line is read beyond the size that these tell."""
    buf = Decoded(lines, offset)
    size = der_size(buf) if buf[:1] == b"\x30" else openssh_size(buf)
    if size is None:
        return None
    need = offset + (4 * size + 2) // 3
    lines.reach(need)
    end = lines.stop(need)
    if end is None or not is_key(Decoded(lines, offset, size)):
        return None
    return re.compile("={0,2}").match(lines.text, end).end()


def pem_bodies(text: str):
    """(start, body, end) from each BEGIN line to the first END line of its label, not past the next BEGIN."""
    begin = None
    for m in PEM_MARK.finditer(text):
        if m[1] == "BEGIN":
            begin = m
        elif begin is not None and begin[2] == m[2]:
            if PEM_BODY.fullmatch(text, begin.end(), m.start()):
                yield begin.start(), text[begin.end():m.start()], m.end()
            begin = None


def pem_body(body: str) -> str:
    """The base64 of a PEM body, without line ends as they are written, quotes of joined literals and header lines."""
    body = re.sub(r"\\+(?=[/\s\"'])", "", re.sub(ESCAPED, "\n", body))
    body = re.sub(r"(?<=[\s\"'])\+(?=[\s\"'])|[\"',]", "", body) if re.search("[\"']", body) else body
    return "".join("" if ":" in line else "".join(line.split()) for line in body.splitlines())


def is_signed_token(header: str, payload: str) -> bool:
    def obj(part):
        raw = from_base64(part, url=True)
        if not raw or raw[:1] != b"{":
            return None
        try:
            return json.loads(raw)
        except (ValueError, RecursionError):
            return None

    h = obj(header)
    return isinstance(h, dict) and isinstance(h.get("alg"), str) and isinstance(obj(payload), dict)


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all findings in code points, by start, then kind as in KINDS."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if "=" in text or ":" in text else []
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "." in text:
        found += [("token", *m.span()) for m in TOKEN.finditer(text) if m[1].startswith("e") and is_signed_token(m[1], m[2])]
    if "-----BEGIN " in text:
        for start, body, end in pem_bodies(text):
            raw = from_base64(pem_body(body)) or b""
            if is_key(raw) or "Proc-Type" in body and len(raw) >= 64:
                found.append(("pem", start, end))
    for run, decode in ((B64_RUN, from_base64), (HEX_RUN, bytes.fromhex)):
        for m in run.finditer(text):
            if is_key(decode(m[0]) or b""):
                found.append(("key", *m.span()))
    known = sorted((a, b) for k, a, b in found if k in ("pem", "key"))
    at, reach, lines = 0, 0, None     # ``reach``: the furthest end of a finding that begins no later
    for m in FIRST_LINE.finditer(text):
        while at < len(known) and known[at][0] <= m.start():
            reach, at = max(reach, known[at][1]), at + 1
        if m.start() < reach:
            continue
        if lines is None or m.start() >= lines.end:
            lines = Lines(text, m.start())
            offset = 0
        else:
            offset = lines.offset(m.start())
        if end := key_in_lines(lines, offset):
            found.append(("key", m.start(), end))
            reach = max(reach, end)
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans, an array of (kind, start, end), of every row.

    One row out per row in, repeated and null ids included; a null or empty
    text has no spans. Texts are searched whole.
    """
    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def scan(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [{"kind": k, "start": a, "end": b} for k, a, b in spans(t)] if t else [])

    return docs.select("doc_id", scan("text").alias("spans"))


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """docs with every span of ``find_secrets`` replaced by the mask; overlapping spans by one.

    Rows, order of columns and texts without a span stay; n_chars, where
    there is such a column, becomes the new length of changed texts.
    """
    @F.pandas_udf("string")
    def clean(s: pd.Series) -> pd.Series:
        def one(t):
            out, at = [], 0
            for _, start, end in spans(t) if t else ():
                if start >= at:
                    out += [t[at:start], mask]
                at = max(at, end)
            return "".join(out) + t[at:] if out else t
        return s.map(one)

    changed = docs.withColumn("__clean", clean("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(F.col("__clean") != F.col("text"), F.char_length("__clean").cast(kind))
                                     .otherwise(F.col("n_chars")))
    return changed.withColumn("text", F.col("__clean")).select(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_secrets`` rows."""
    def line(a):
        return F.concat_ws(",", F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda x: x["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(table(spark, sf_dir, "documents")))

"""One large CSV file with line feeds inside quotes, read in many tasks.

Spark's multi-line reader takes a file whole, as nothing says at a byte whether
it lies inside quotes. Here a file is read as physical lines, split by bytes as
any text is. A line can begin in two ways only, at a record's start or inside
quotes, so a block of lines is a function of two states. A first pass finds
these functions, one row a block; composed in file order they give the state at
each block's start, and a second pass cuts the blocks into records. A record
over a block's end is put together from its pieces, at most two a block. Rows are
then parsed by Spark's CSV rules.

Where no file can be split (compressed ones), every block is a whole file and begins
outside quotes: there is no first pass, and no record over a block's end. Lines whose
quotes all close are records as they are and are not looked at one by one.

The list of blocks passes through the driver, as the list of splits does.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields up to the line's end or to an opened quote that the line does not close. Text behind a closing
# quote belongs to the field, up to the next comma; a quote inside an unquoted field is a character.
_FIELDS = r'(?:(?:"(?:[^"]|"")*+"(?!")[^,]*+|(?!")[^,]*+),)*+'
_OPEN = re.compile(_FIELDS + r'"(?:[^"]|"")*+\Z', re.S)
_CLOSED = re.compile(r'(?:[^"]|"")*+"(?!")[^,]*+(?:,(.*))?\Z', re.S)


# A line of which every quoted field closes at its end, without a quote inside; begun outside quotes, it ends there.
_SIMPLE = r'\A(?:(?:[^",][^,]*|"[^"]*")?,)*(?:[^",][^,]*|"[^"]*")?\z'


def ends_open(line: str, inside: bool) -> bool:
    """Whether a line leaves its last field's quotes open, begun at a record's start or ``inside`` quotes."""
    if '"' not in line:
        return inside
    if inside:
        m = _CLOSED.match(line)
        if m is None:
            return True
        if m[1] is None:
            return False
        line = m[1]
    return _OPEN.match(line) is not None


def _blocks(batches):
    """(file, block, lines) of a task's rows; a task may have several blocks, each in order."""
    file = block = None
    lines: list[str] = []
    for batch in batches:
        for f, b, line in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (f, b) != (file, block):
                if lines:
                    yield file, block, lines, True
                file, block, lines = f, b, []
            lines.append(line)
        # Long blocks come in parts, so that a task holds one batch of lines.
        if lines:
            yield file, block, lines, False
            lines = []


def _functions(batches):
    """One row a block: for each state before it, the state after it and whether a record ends in it."""
    state: dict[tuple[str, int], list] = {}
    for file, block, lines, _ in _blocks(batches):
        outside, inside, ends_outside, ends_inside = state.get((file, block), (False, True, False, False))
        for line in lines:
            same = outside == inside
            outside = ends_open(line, outside)
            inside = outside if same else ends_open(line, inside)
            ends_outside, ends_inside = ends_outside or not outside, ends_inside or not inside
        state[file, block] = outside, inside, ends_outside, ends_inside
    if state:
        columns = zip(*((*k, *v) for k, v in state.items()), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int64(), *[pa.bool_()] * 4], strict=True)],
                                         names=["file", "block", "outside", "inside", "ends_outside", "ends_inside"])


def starts(functions) -> dict[tuple[str, int], bool]:
    """The state at each block's start: whether it lies inside quotes."""
    out, file, state = {}, None, False
    for f, block, outside, inside, *_ in sorted(functions):
        if f != file:
            file, state = f, False
        out[f, block] = state
        state = inside if state else outside
    return out


HEADER = -1


def pieces_of_records(functions) -> list[tuple[str, int, int, int]]:
    """(file, block, piece, record) of the pieces at blocks' ends; a record is named by the block it began in."""
    inside_at, out, file, record = starts(functions), [], None, None
    for f, block, outside, inside, ends_outside, ends_inside in sorted(functions):
        if f != file:
            file, record = f, None
        began = inside_at[f, block]
        if began:
            out.append((f, block, CLOSES if ends_inside else RUNS_ON, record))
            if not ends_inside:
                continue
            record = None
        if inside if began else outside:
            record = HEADER if block == 0 and not ends_outside else block
            out.append((f, block, OPENS, record))
    return out


WHOLE, CLOSES, OPENS, RUNS_ON = range(4)
#: Fewer simple lines than this go with the records around them.
SHORT = 256


def _stretches(batches):
    """(file, block, lines, simple) of a task's rows, in order: stretches of simple lines (``_SIMPLE``) and of others."""
    for batch in batches:
        files, blocks, lines = (batch.column(i) for i in range(3))
        simple = pc.match_substring_regex(lines, _SIMPLE).to_numpy(zero_copy_only=False)
        place = files.dictionary_encode().indices.to_numpy(), blocks.to_numpy()
        new = simple[1:] != simple[:-1]
        for x in place:
            new |= x[1:] != x[:-1]
        ends = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows] if batch.num_rows else []
        for at, end in zip(ends, ends[1:], strict=False):
            yield files[at].as_py(), blocks[at].as_py(), lines.slice(at, end - at), bool(simple[at])


def _cut(inside_at: dict[tuple[str, int], bool] | None):
    """Rows (file, block, piece, text): whole records but the header, and the pieces at blocks' ends. Without
    ``inside_at`` a block is a whole file, and what is left open at its end is a record, too."""
    def run(batches):
        out: list[tuple] = []
        pending: list[str] = []
        place, inside, piece, header = None, False, WHOLE, False

        def close():
            if pending:
                if inside_at is not None:
                    out.append((*place, RUNS_ON if piece == CLOSES else OPENS, "\n".join(pending)))
                elif not header:
                    out.append((*place, WHOLE, "\n".join(pending)))
                pending.clear()

        for file, block, lines, simple in _stretches(batches):
            if (file, block) != place:
                close()
                place, header = (file, block), block == 0
                inside = inside_at[file, block] if inside_at is not None else False
                piece = CLOSES if inside else WHOLE
            if simple and not inside:
                if header:
                    lines, header = lines.slice(1), False
                if len(lines) < SHORT:
                    out += [(file, block, WHOLE, line) for line in lines.to_pylist()]
                else:
                    if out:
                        yield _batch(out)
                        out.clear()
                    yield _whole(file, block, lines)
                lines = lines.slice(0, 0)
            for line in lines.to_pylist():
                pending.append(line)
                inside = ends_open(line, inside)
                if not inside:
                    if not header:
                        out.append((file, block, piece, "\n".join(pending)))
                    pending.clear()
                    piece, header = WHOLE, False
            if len(out) >= 4096:
                yield _batch(out)
                out.clear()
        close()
        if out:
            yield _batch(out)

    return run


def _whole(file: str, block: int, lines: pa.Array) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays([pa.repeat(file, n), pa.repeat(pa.scalar(block, pa.int64()), n),
                                       pa.repeat(pa.scalar(WHOLE, pa.int32()), n), lines], names=["file", "block", "piece", "text"])


def _batch(rows) -> pa.RecordBatch:
    file, block, piece, text = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict({"file": file, "block": pa.array(block, pa.int64()), "piece": pa.array(piece, pa.int32()), "text": text})


def splittable(spark: SparkSession, files: DataFrame):
    """Whether Spark may read a file in several blocks, for the kinds of names among the files."""
    jvm = spark._jvm
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    split = jvm.java.lang.Class.forName("org.apache.hadoop.io.compress.SplittableCompressionCodec")
    for end in {f.rsplit("/", 1)[-1].rpartition(".")[2] for f in files.inputFiles()}:
        codec = codecs.getCodec(jvm.org.apache.hadoop.fs.Path(f"name.{end}" if end else "name"))
        yield codec is None or split.isInstance(codec)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file and text of every record of the CSV files under ``path`` but their headers."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.regexp_replace("value", "\r$", "").alias("line")))
    if not any(splittable(spark, lines)):
        return lines.mapInArrow(_cut(None), "file string, block long, piece int, text string").select("file", "text")
    schema = "file string, block long, outside boolean, inside boolean, ends_outside boolean, ends_inside boolean"
    functions = [tuple(r) for r in lines.mapInArrow(_functions, schema).collect()]
    cut = lines.mapInArrow(_cut(starts(functions)), "file string, block long, piece int, text string")
    whole = cut.where(F.col("piece") == WHOLE).select("file", "text")
    records = spark.createDataFrame(pieces_of_records(functions), "file string, block long, piece int, record long")
    split = (cut.where(F.col("piece") != WHOLE).join(records, ["file", "block", "piece"]).where(F.col("record") != HEADER)
             .groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("p"))
             .select("file", F.concat_ws("\n", F.col("p.text")).alias("text")))
    return whole.unionByName(split)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The files' rows by ``schema``, a bad cell NULL, and ``_source_file``; equal to Spark's multi-line
    reader's with header and '"' escape. Line ends may be CRLF; a carriage return at the end of a line inside
    quotes goes. Compressed files are one block."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("text", fields, {"escape": '"', "mode": "PERMISSIVE"})
    rows = read_records(spark, path).where(F.col("text") != "").select(parsed.alias("row"), F.col("file").alias("_source_file"))
    return rows.select("row.*", "_source_file")

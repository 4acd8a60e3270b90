"""Conversation structure repair by a survivor-coalescence Viterbi search (operator 13).

The rows of a conversation pass in order through the states of ``(s?(ua)+)?``:
nothing yet, after a system row, after a user row, after an assistant row. Each
state keeps one survivor, the cheapest edits that reach it; a survivor that can
no longer win is dropped. The survivors' edits are the leaves of a backpointer
tree with reference counts: a branch that no survivor needs goes, and what all
survivors share is emitted at once, so only the part still open is held (a node
is a whole unbranched run of edits, one byte each). Equal costs are decided by
the whole open suffixes: survivors carry their rank among each other, which
every row extends by its own edit, so that a suffix is never walked again.

Two passes: faults and the search read rows without their texts; the edits
found are sorted ahead of the conversation's rows, which a second task applies
and hashes as they stream by. No task holds a conversation, only its edits.
One conversation is one task in each pass, as its hash is one sequence; equal
rows under one turn are counted before the first shuffle.
"""

from __future__ import annotations

import hashlib
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vidlens.llm.common import arrow_rows, materialize, table

#: What a text may hold without having anything in it.
BLANKS = " \t\n\x0b\x0c\r"
#: Characters of role and text that order rows of one turn before their digest does.
HEAD = 32
#: Rows sent to Python at once where they hold texts.
ROWS = 256
LONG = 2**63 - 1

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5      # costs
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a kept role's initial leads from each state, and the role that may follow each state.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FOLLOW = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class Run:
    """A node of the tree: edits without a branch, and how many survivors' paths hold it."""

    __slots__ = ("edits", "users")

    def __init__(self, edits: bytes):
        self.edits, self.users = bytearray(edits), 1


class Search:
    """The cheapest edits of one conversation, row by row.

    ``survivors`` has for each state its cost, its rank among the survivors before
    inserts, the inserts since, and its path: the tree's runs from the root on.
    """

    def __init__(self):
        self.emitted = bytearray()
        self.survivors = {START: (0, 0, 0, [])}
        self._insert()

    def row(self, initial: str, must_delete: bool, truncated: bool, times: int = 1) -> None:
        """``times`` equal rows; more than one only where they must be deleted."""
        best: dict[int, tuple] = {}

        def offer(state, cost, key, origin, edits):
            if state not in best or (cost, key) < best[state][:2]:
                best[state] = (cost, key, origin, edits)

        keep, extra = NEXT.get(initial, {}), TRUNCATED if truncated else 0
        for state, (cost, rank, inserts, _) in self.survivors.items():
            # Two survivors of one rank differ by the inserts behind it, so these and the edit decide.
            tail = b"I" * inserts
            offer(state, cost + DELETE * times, (rank, tail + b"D"), state, b"D" * times)
            if not must_delete:
                if state in keep:
                    offer(keep[state], cost + KEEP + extra, (rank, tail + b"K"), state, b"K")
                offer(FOLLOW[state], cost + REROLE + extra, (rank, tail + b"R"), state, b"R")
        order = {key: i for i, key in enumerate(sorted(b[1] for b in best.values()))}
        self._grow({s: (cost, order[key], 0, origin, edits) for s, (cost, key, origin, edits) in best.items()})
        self._insert()

    def _insert(self) -> None:
        """Rows may be inserted before the next; then survivors that cannot win go."""
        found = {s: (cost, rank, inserts, s, b"") for s, (cost, rank, inserts, _) in self.survivors.items()}
        queue = list(found)
        while queue:
            cost, rank, inserts, origin, edits = found[(state := queue.pop())]
            to, new = FOLLOW[state], (cost + INSERT, rank, inserts + 1)
            if to not in found or new < found[to][:3]:
                found[to] = (*new, origin, edits + b"I")
                queue.append(to)
        key = {s: x[:3] for s, x in found.items()}
        # Whatever follows a system row may follow an assistant row or nothing; nothing differs from an
        # assistant row only in that a system row may be kept, where deleting it costs two more.
        if SYSTEM in key and (key[ASSISTANT] < key[SYSTEM] or START in key and key[START] < key[SYSTEM]):
            del found[SYSTEM]
        if START in key and key[ASSISTANT][0] + DELETE < key[START][0]:
            del found[START]
        self._grow(found)

    def _grow(self, chosen: dict) -> None:
        """The chosen survivors' paths: each extends the path of the state it comes from by its edits."""
        uses = dict.fromkeys(self.survivors, 0)
        for *_, origin, _ in chosen.values():
            uses[origin] += 1
        for state, (*_, path) in self.survivors.items():
            for run in path:
                run.users += uses[state] - 1
        out = {}
        for state, (cost, rank, inserts, origin, edits) in chosen.items():
            path = list(self.survivors[origin][3])
            if edits:
                if path and path[-1].users == 1:
                    path[-1].edits += edits
                else:
                    path.append(Run(edits))
            out[state] = (cost, rank, inserts, path)
        self.survivors = out
        self._settle()

    def _settle(self) -> None:
        """A run whose side branches ended takes in the next one; what all survivors share leaves the tree."""
        joined = {}
        for *_, path in self.survivors.values():
            i = 0
            while i + 1 < len(path):
                run, after = path[i], path[i + 1]
                if run.users != after.users:
                    i += 1
                    continue
                if id(after) not in joined:
                    joined[id(after)] = after       # kept, so that no other run gets its id
                    run.edits += after.edits
                del path[i + 1]
        while all(path and path[0].users == len(self.survivors) for *_, path in self.survivors.values()):
            self.emitted += next(iter(self.survivors.values()))[3][0].edits
            for *_, path in self.survivors.values():
                del path[0]

    def finish(self) -> tuple[int, str]:
        """(cost, edits) of the least path to an accepting state."""
        cost, _, _, path = min((self.survivors[s] for s in (START, ASSISTANT) if s in self.survivors), key=itemgetter(0, 1, 2))
        return cost, b"".join([bytes(self.emitted), *(bytes(run.edits) for run in path)]).decode()


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the contract's damage by crc32(``conv_id:turn``) mod 20.

    A null id or turn counts as one space in that name and stays null; a null role
    or text becomes one space. ``copies`` is 0 for a dropped row, 2 for a repeated one.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def placed(rows: DataFrame) -> DataFrame:
    """Rows with the columns that order them under one turn: heads of role and text, then a digest of both."""
    digest = F.unhex(F.sha2(F.concat(F.sha2("role", 256), F.col("text")), 256))
    return (rows.withColumn("role_head", F.left("role", F.lit(HEAD))).withColumn("text_head", F.left("text", F.lit(HEAD)))
            .withColumn("digest", F.substring(digest, 1, 16)))


def find_edits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation.

    ``rows``: conv_id, turn, role and text without nulls in the last two, and
    copies (how often the row stands there; a conversation with none has zeros
    and an empty audit). Rows go by turn, nulls first, those of one turn by role
    and text (their first 32 characters, then a digest). A null conv_id is a
    conversation of its own. An empty role, or one that starts with none of s, u
    and a, cannot be kept. Other columns are not read. Gaps stop at the greatest long.
    """
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    thin = placed(rows.select("conv_id", "turn", "role", "text", "copies")).select(
        "conv_id", "turn", "role_head", "text_head", "digest", F.left("role", F.lit(1)).alias("initial"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"), "copies")
    keys = [c for c in thin.columns if c != "copies"]
    # Equal rows under one turn stand side by side: counted before they are sent.
    thin = thin.groupBy(*keys).agg(F.sum("copies").alias("copies"))
    earlier = Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first())
    seen = F.coalesce(F.lag(F.lit(True)).over(earlier), F.lit(False))
    # Rows that are not there must not count as seen.
    there = thin.where("copies > 0").withColumn("seen", seen)
    gone = thin.where("copies = 0").withColumn("seen", F.lit(False))
    ready = (there.unionByName(gone).repartition("conv_id")
             .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role_head", "text_head", "digest"))
    ready = ready.select("conv_id", "turn", "initial", "blank", "truncated", "copies", "seen")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return ready.mapInArrow(_search, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, "
                                     "cost long, audit string")


def _id_types(rows: DataFrame) -> tuple[str, pa.DataType]:
    kind = rows.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def _streamed(batches):
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)


def _search(batches):
    out, schema = [], None

    def checked():
        nonlocal schema
        for batch in batches:
            schema = schema or pa.schema([batch.schema.field(0), *(pa.field(c, pa.int64()) for c in (
                "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), pa.field("audit", pa.string())])
            yield batch

    held = 0
    for conv, rows in groupby(_streamed(checked()), key=itemgetter(0)):
        out.append(_conversation(conv, rows))
        held += len(out[-1]["audit"]) + 100
        if held > 1 << 20:
            yield pa.RecordBatch.from_pylist(out, schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _conversation(conv, rows) -> dict:
    search = Search()
    n = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    before = lowest = highest = None
    turns = 0
    for _, turn, initial, blank, truncated, copies, seen in rows:
        if not copies:
            continue
        if turn is not None and turn != highest:        # turns ascend
            lowest, highest, turns = turn if lowest is None else lowest, turn, turns + 1
        n["illegal"] += (before is not None and (before, initial) not in LEGAL) + copies - 1
        before = initial
        if blank:
            n["blank"] += copies
            search.row(initial, True, False, copies)
            continue
        first = 0 if seen else 1
        n["duplicate"] += copies - first
        n["truncated"] += truncated and first
        # A duplicate is deleted whatever its end.
        if first:
            search.row(initial, False, truncated)
        if copies > first:
            search.row(initial, True, False, copies - first)
    cost, audit = search.finish()
    return {"conv_id": conv, **n, "gaps": 0 if lowest is None else min(highest - lowest + 1 - turns, LONG), "cost": cost, "audit": audit}


def _apply(audit: str, rows):
    """(role, text) of the repaired conversation; ``rows`` gives (role, text, copies) in order."""
    state, at = START, 0

    def inserted():
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            state, at = FOLLOW[state], at + 1
            yield ROLE[state], ""

    for role, text, copies in rows:
        for _ in range(copies):
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "R":
                state = FOLLOW[state]
                yield ROLE[state], text
            elif edit == "K":
                state = NEXT[role[0]][state]
                yield role, text
    yield from inserted()


def _edited(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Each conversation's edits ahead of its rows, in order, one task a conversation."""
    body = placed(rows.where("copies > 0").select("conv_id", "turn", "role", "text", "copies")).withColumn("audit", F.lit(None).cast("string"))
    head = edits.select("conv_id", "audit")
    both = head.unionByName(body, allowMissingColumns=True)
    return (both.repartition("conv_id")
            .sortWithinPartitions("conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role_head", "text_head", "digest")
            .select("conv_id", "audit", "role", "text", "copies"))


def _conversations(batches):
    """(conv_id, repaired (role, text) pairs), the pairs to be read before the next."""
    for conv, rows in groupby(_streamed(batches), key=itemgetter(0)):
        yield conv, _apply(next(rows)[1], (r[2:] for r in rows))


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text: the rows of every conversation after its edits."""
    kind, id_type = _id_types(rows)

    def run(batches):
        out = []
        for conv, pairs in _conversations(batches):
            for place, (role, text) in enumerate(pairs):
                out.append((conv, place, role, text))
                if len(out) >= ROWS:
                    yield as_batch(out)
                    out = []
        if out:
            yield as_batch(out)

    def as_batch(out):
        conv, place, role, text = zip(*out, strict=True)
        return pa.RecordBatch.from_pydict({"conv_id": pa.array(conv, id_type), "place": pa.array(place, pa.int64()),
                                           "role": pa.array(role, pa.string()), "text": pa.array(text, pa.string())})

    with arrow_rows(rows.sparkSession, ROWS):
        return materialize(_edited(rows, edits).mapInArrow(run, f"conv_id {kind}, place long, role string, text string"), "repaired")


def hashes(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of the repaired rows' ``role:text``, joined by line feeds; one row a conversation."""
    kind, id_type = _id_types(rows)

    def run(batches):
        convs, digests = [], []
        for conv, pairs in _conversations(batches):
            h = hashlib.sha256()
            for place, (role, text) in enumerate(pairs):
                h.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            convs.append(conv)
            digests.append(h.hexdigest())
            if len(convs) >= 4096:
                yield pa.RecordBatch.from_pydict({"conv_id": pa.array(convs, id_type), "repaired_sha256": digests})
                convs, digests = [], []
        if convs:
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array(convs, id_type), "repaired_sha256": digests})

    with arrow_rows(rows.sparkSession, ROWS):
        return materialize(_edited(rows, edits).mapInArrow(run, f"conv_id {kind}, repaired_sha256 string"), "repaired-hashes")


def repair(rows: DataFrame) -> DataFrame:
    """Every conversation's faults, edits and the hash of its repaired rows; see ``find_edits``."""
    edits = materialize(find_edits(rows), "conversation-edits")
    found = hashes(rows, edits).withColumnRenamed("conv_id", "__conv")
    return edits.join(found, edits["conv_id"].eqNullSafe(F.col("__conv"))).drop("__conv")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations")))

"""Conversation structure repair: the cheapest edits that make a legal conversation.

A legal conversation is empty, or an optional system turn and then pairs of a
user and an assistant turn; of a role only its first character counts. Each
turn's first fault is ``blank`` (no character beyond white space), ``duplicate``
(role and text seen earlier in the conversation) or ``truncated`` (its last such
character does not end a sentence). Edits: K keeps a turn (0), R gives it the
role user or assistant (1), D deletes it (2; blank and duplicate ones must go),
I inserts an empty user or assistant turn (5); a truncated turn that stays costs
5 more. Of the cheapest edits the string of their letters that is least in
ASCII order is taken, so the result is unique.

Secondary-sorted streaming: rows are repartitioned by conversation and sorted by
turn; duplicates are marked on the same partitioning. A task then reads its
conversations as a stream of Arrow batches and carries, per conversation, four
states (nothing yet, system, user, assistant came last), each with its least
cost and the rank of its letters among the four. Ranks are enough: two different
strings of edits of the same turns, both ending with an edit of a turn, differ
in a letter before either ends. A turn leaves 24 bits: for each state the state
before, the inserts and the edit.

A conversation beyond ``HELD_BYTES`` or ``HELD_ROWS`` is not held: its back
pointers go out in chunks of ``CHUNK`` turns to the shared folder, a second stream
reads the chunks backwards and turns them into edits, and a third one sends the
turns again past their edits, a chunk at a time. So a task holds a bounded number
of turns however long a conversation is. A digest of a conversation is sequential
by nature; it is the one thing that keeps such a conversation in one task.

Null role or text reads as one space. Null ids are one conversation, null turns
come first; rows of the same turn are ordered by role and text, and repeated rows
count as duplicates. Rows marked ``gone`` only say that the conversation exists:
it has a report, with zeros if nothing is left. Empty tables give empty results;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import materialize

HELD_ROWS, HELD_BYTES, CHUNK = 100_000, 16 << 20, 1 << 16
BATCH = 2048
SPACE = "\t\n\x0b\x0c\r "

START, SYSTEM, USER, ASSISTANT = range(4)
#: letters in front of a turn: state before, state after, how many turns are inserted (a loop is never cheapest)
_INSERTS = [(q, q, 0) for q in range(4)] + [(START, USER, 1), (SYSTEM, USER, 1), (USER, ASSISTANT, 1), (ASSISTANT, USER, 1), (START, ASSISTANT, 2), (SYSTEM, ASSISTANT, 2)]
#: inserts that end a conversation, by state
_ENDING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
_EDITS = "DKR"
MUST_GO = 0  # class of a turn; others: 1 + 2 * initial + truncated
_INITIAL = {"s": 0, "u": 1, "a": 2}


def turn_class(role: str, fault: int) -> int:
    return MUST_GO if fault in (1, 2) else 1 + 2 * _INITIAL.get(role[:1], 3) + (fault == 3)


def _wanted(state: int) -> int:
    """What an inserted turn, or one of new role, is after this state."""
    return ASSISTANT if state == USER else USER


def _moves(kind: int) -> list[tuple[int, int, int, str, int]]:
    """(before, after, cost, letters, code) of every way to pass a turn of this class."""
    out = []
    for q, mid, ins in _INSERTS:
        ways = [("D", mid, 2)]
        if kind != MUST_GO:
            initial, stays = (kind - 1) // 2, 5 * ((kind - 1) % 2)
            if (initial, mid) in ((0, START), (1, START), (1, SYSTEM), (1, ASSISTANT), (2, USER)):
                ways.append(("K", SYSTEM + initial, stays))
            ways.append(("R", _wanted(mid), 1 + stays))
        out += [(q, to, 5 * ins + cost, "I" * ins + edit, q | ins << 2 | _EDITS.index(edit) << 4) for edit, to, cost in ways]
    return sorted(out, key=lambda m: (m[2], m[3]))


_MOVES = [_moves(k) for k in range(9)]


class Forward:
    """Cost and rank of the four states after the turns so far, and their back pointers."""

    def __init__(self):
        self.now: list[tuple[int, int] | None] = [(0, 0), None, None, None]  # (cost, rank of the letters)
        self.pointers = array("I")

    def step(self, kind: int) -> None:
        best: list[tuple | None] = [None] * 4
        for q, to, cost, letters, code in _MOVES[kind]:
            if (here := self.now[q]) is not None:
                way = (here[0] + cost, here[1], letters, code)
                if best[to] is None or way < best[to]:
                    best[to] = way
        order = sorted(w[1:3] for w in best if w)
        self.now = [w and (w[0], order.index(w[1:3])) for w in best]
        self.pointers.append(sum((w[3] if w else 0) << 6 * q for q, w in enumerate(best)))

    def end(self) -> tuple[int, int]:
        """(cost, last state)."""
        cost, _, state = min((w[0] + 5 * _ENDING[q], w[1], q) for q, w in enumerate(self.now) if w)
        return cost, state


def trace(pointers: Iterable[int], state: int) -> tuple[bytearray, int]:
    """Edits (a byte a turn: inserts before it, letter) of turns read backwards from ``state``, and the state before them."""
    out = bytearray()
    for p in reversed(pointers):
        code = p >> 6 * state & 63
        out.append(code >> 2)
        state = code & 3
    out.reverse()
    return out, state


def _solve(kinds: bytes) -> tuple[int, bytes, int]:
    """(cost, edits, inserts at the end) of a conversation."""
    f = Forward()
    for k in kinds:
        f.step(k)
    cost, state = f.end()
    return cost, bytes(trace(f.pointers, state)[0]), _ENDING[state]


@lru_cache(maxsize=1 << 14)
def _solve_short(kinds: bytes) -> tuple[int, bytes, int]:
    return _solve(kinds)


# ---- what comes out ------------------------------------------------------------------


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"


class Report:
    """Counts over the turns of one conversation."""

    def __init__(self):
        self.faults, self.illegal = [0, 0, 0, 0], 0
        self.least = self.last_turn = None
        self.distinct, self.initial = 0, None

    def add(self, turn: int | None, role: str, fault: int) -> None:
        self.faults[fault] += 1
        if turn is not None and turn != self.last_turn:
            self.least = turn if self.least is None else self.least
            self.last_turn, self.distinct = turn, self.distinct + 1
        if self.initial is not None and (self.initial, role[:1]) not in (("s", "u"), ("u", "a"), ("a", "u")):
            self.illegal += 1
        self.initial = role[:1]

    def values(self, cost: int) -> list[int]:
        gaps = 0 if self.least is None else self.last_turn - self.least + 1 - self.distinct
        return [gaps, *self.faults[1:], self.illegal, cost]


class Digests:
    """A row per conversation: its report, audit and the hash of the repaired text."""

    schema = REPORT + ", audit string, repaired_sha256 string"

    def __init__(self):
        self.rows: list[tuple] = []

    def begin(self, conv) -> None:
        self.conv, self.audit, self.sha, self.any = conv, [], hashlib.sha256(), False

    def turn(self, letter: str, turn, role: str, text: str) -> None:
        self.audit.append(letter)
        if letter != "D":
            self.sha.update(("\n" * self.any + f"{role}:{text}").encode())
            self.any = True

    def end(self, report: list[int]) -> None:
        self.rows.append((self.conv, *report, "".join(self.audit), self.sha.hexdigest()))


class Turns:
    """A row per edit, in order: what was done, and the turn as it is now (deleted ones as they were)."""

    schema = "position bigint, edit string, turn bigint, role string, text string"

    def __init__(self):
        self.rows: list[tuple] = []

    def begin(self, conv) -> None:
        self.conv, self.at = conv, 0

    def turn(self, letter: str, turn, role: str, text: str) -> None:
        self.rows.append((self.conv, self.at, letter, turn, role, text))
        self.at += 1

    def end(self, report: list[int]) -> None:
        pass


class Writer:
    """Turns and their edits to output rows."""

    def __init__(self, out):
        self.out = out

    def begin(self, conv) -> None:
        self.state = START
        self.out.begin(conv)

    def inserts(self, n: int) -> None:
        for _ in range(n):
            self.state = _wanted(self.state)
            self.out.turn("I", None, "user" if self.state == USER else "assistant", "")

    def turn(self, edit: int, kind: int, turn, role: str, text: str) -> None:
        self.inserts(edit & 3)
        letter = _EDITS[edit >> 2]
        if letter == "K":
            self.state = SYSTEM + (kind - 1) // 2
        elif letter == "R":
            self.state = _wanted(self.state)
            role = "user" if self.state == USER else "assistant"
        self.out.turn(letter, turn, role, text)

    def end(self, inserts: int, report: list[int]) -> None:
        self.inserts(inserts)
        self.out.end(report)


# ---- the streams ----------------------------------------------------------------------


SPILL = "chunk bigint, pointers binary, turn_ bigint, role_ string, text_ string, report array<bigint>"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], names=schema.names)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple]]:
    for whole in batches:
        for i in range(0, whole.num_rows, BATCH):
            yield zip(*(c.to_pylist() for c in whole.slice(i, BATCH).columns))


class Conversation:
    """One conversation on its way through the first stream."""

    def __init__(self, conv, limits: tuple[int, int, int]):
        self.held_rows, self.held_bytes, self.chunk = limits
        self.conv, self.report, self.rows, self.kinds, self.size = conv, Report(), [], bytearray(), 0
        self.forward: Forward | None = None  # of a conversation that is not held
        self.keys: list[tuple] = []  # the first turn of each chunk that is not out yet
        self.n = self.out = 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        self.report.add(turn, role, fault)
        kind = turn_class(role, fault)
        if self.n % self.chunk == 0:
            self.keys.append((turn, role, text))
        self.n += 1
        if self.forward is not None:
            self.forward.step(kind)
            return
        self.rows.append((turn, role, text))
        self.kinds.append(kind)
        self.size += len(text)
        if self.size > self.held_bytes or len(self.rows) > self.held_rows:
            self.forward = Forward()
            for k in self.kinds:
                self.forward.step(k)
            self.rows, self.kinds = [], bytearray()

    def spilled(self, all: bool) -> Iterator[tuple]:
        """Rows of back pointers: whole chunks, at the end the rest and the report."""
        p = self.forward.pointers
        while len(p) >= self.chunk or all and p:
            yield self.conv, self.out, p[: self.chunk].tobytes(), *self.keys.pop(0), None
            del p[: self.chunk]
            self.out += 1
        if all:
            cost, state = self.forward.end()
            yield self.conv, self.out, None, None, None, None, [*self.report.values(cost), state]


def _schemas(conv: T.DataType, *parts: str) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = T.StructType([T.StructField("conv", conv), *(f for p in parts for f in T._parse_datatype_string(p).fields)])
    return kind, to_arrow_schema(kind)


def _repair(sorted_rows: DataFrame, out_type) -> DataFrame:
    """First stream: results of held conversations, back pointers of the others (``chunk`` not null)."""
    kind, schema = _schemas(sorted_rows.schema["conv"].dataType, out_type.schema, SPILL)
    limits = HELD_ROWS, HELD_BYTES, CHUNK  # as they are here, not in a worker
    no_spill, no_out = (None,) * 6, (None,) * (len(schema) - 7)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = out_type()
        writer, now, spills = Writer(out), None, []

        def finish(c: Conversation) -> None:
            if c.forward is not None:
                spills.extend(c.spilled(True))
                return
            cost, edits, last = (_solve_short if len(c.kinds) <= 64 else _solve)(bytes(c.kinds))
            writer.begin(c.conv)
            for edit, k, row in zip(edits, c.kinds, c.rows):
                writer.turn(edit, k, *row)
            writer.end(last, c.report.values(cost))

        def ready() -> pa.RecordBatch:
            rows = [(*r, *no_spill) for r in out.rows] + [(r[0], *no_out, *r[1:]) for r in spills]
            out.rows, spills[:] = [], []
            return _batch(rows, schema)

        for rows in _read(batches):
            for conv, turn, role, text, fault, gone in rows:
                if now is None or conv != now.conv:
                    if now is not None:
                        finish(now)
                    now = Conversation(conv, limits)
                if not gone:
                    now.add(turn, role, text, fault)
            if now is not None and now.forward is not None:
                spills.extend(now.spilled(False))
            if out.rows or spills:
                yield ready()
        if now is not None:
            finish(now)
            yield ready()

    return sorted_rows.mapInArrow(run, kind)


def _edits(spilled: DataFrame) -> DataFrame:
    """Second stream: back pointers, last chunk first, to edits; the report goes with the first chunk."""
    kind, schema = _schemas(spilled.schema["conv"].dataType, SPILL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, report = START, None
        for rows in _read(batches):
            done = []
            for conv, chunk, pointers, turn, role, text, end in rows:
                if end is not None:
                    *report, state = end
                    report = [*report, _ENDING[state]]
                    continue
                p = array("I")
                p.frombytes(pointers)
                edits, state = trace(p, state)
                done.append((conv, chunk, bytes(edits), turn, role, text, report if chunk == 0 else None))
            yield _batch(done, schema)

    return spilled.repartition("conv").sortWithinPartitions(F.col("conv"), F.col("chunk").desc()).mapInArrow(run, kind)


def _replay(sorted_rows: DataFrame, out_type) -> DataFrame:
    """Third stream: turns of long conversations past their edits, which come before the turns of their chunk."""
    kind, schema = _schemas(sorted_rows.schema["conv"].dataType, out_type.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = out_type()
        writer, report, edits, at, begun, now = Writer(out), None, [], 0, False, None
        for rows in _read(batches):
            for conv, turn, role, text, fault, chunk, codes, told in rows:
                if not begun or conv != now:
                    if begun:
                        writer.end(report[-1], report[:-1])
                    now, begun, edits, at = conv, True, [], 0
                    writer.begin(conv)
                if codes is not None:
                    edits.append(codes)
                    report = told or report
                    continue
                writer.turn(edits[0][at], turn_class(role, fault), turn, role, text)
                at += 1
                if at == len(edits[0]):
                    edits.pop(0)
                    at = 0
            if out.rows:
                yield _batch(out.rows, schema)
                out.rows = []
        if begun:
            writer.end(report[-1], report[:-1])
            yield _batch(out.rows, schema)

    return sorted_rows.mapInArrow(run, kind)


def _marked(rows: DataFrame, conv: str, turn: str, role: str, text: str, gone: str | None) -> DataFrame:
    """(conv, turn, role, text, fault, gone, nth), partitioned by conversation."""
    slim = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"), (F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)).alias("gone"),
    )
    same = Window.partitionBy("conv", "role", "text", "gone").orderBy("turn")
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    fault = F.when(last == "", 1).when(F.col("nth") > 1, 2).when(~last.isin(".", "!", "?"), 3).otherwise(0)
    return slim.repartition("conv").withColumn("nth", F.row_number().over(same)).withColumn("fault", fault)


_ORDER = ("conv", "turn", "role", "text", "nth")


def _run(rows: DataFrame, out_type, conv: str, turn: str, role: str, text: str, gone: str | None) -> DataFrame:
    marked = _marked(rows, conv, turn, role, text, gone)
    first = materialize(_repair(marked.sortWithinPartitions(*_ORDER).select("conv", "turn", "role", "text", "fault", "gone"), out_type), "conversation-repair")
    own = [f.name for f in T._parse_datatype_string(out_type.schema).fields]
    done, spilled = first.where("chunk IS NULL").select("conv", *own), first.where("chunk IS NOT NULL").select("conv", *(f.name for f in T._parse_datatype_string(SPILL).fields))
    if spilled.limit(1).count():
        edits = materialize(_edits(spilled), "conversation-edits").select("conv", F.col("turn_").alias("turn"), F.col("role_").alias("role"), F.col("text_").alias("text"), F.lit(0).alias("fault"), F.lit(0).alias("nth"), "chunk", F.col("pointers").alias("codes"), F.col("report").alias("told"))
        long = edits.where("chunk = 0").select(F.col("conv").alias("long_conv"))
        again = marked.where("NOT gone").join(long, F.col("conv").eqNullSafe(F.col("long_conv")), "left_semi")
        again = again.select("conv", "turn", "role", "text", "fault", "nth", F.lit(None).cast("bigint").alias("chunk"), F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("array<bigint>").alias("told"))
        both = again.unionByName(edits).repartition("conv").sortWithinPartitions(*_ORDER, "chunk")
        done = done.unionByName(_replay(both.select("conv", "turn", "role", "text", "fault", "chunk", "codes", "told"), out_type))
    return done.withColumnRenamed("conv", conv)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None) -> DataFrame:
    """A row per edit: conversation, position, edit (D, I, K, R), the original turn (null for an inserted one), role, text. Without the D rows it is the repaired table."""
    return _run(rows, Turns, conv, turn, role, text, gone)


def digests(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None) -> DataFrame:
    """A row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit (the letters of its edits), repaired_sha256 (of ``role:text`` lines)."""
    return _run(rows, Digests, conv, turn, role, text, gone)


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a hash of conversation and turn; a dropped row stays as one marked ``gone``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    return rows.select(
        "conv_id", "turn",
        F.when(h == 4, "user").otherwise(space("role")).alias("role"),
        F.when(h == 1, "").when(h == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text")).alias("text"),
        (h == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(h == 3, 2).otherwise(1).cast("int"))).alias("copy"),
    ).drop("copy")

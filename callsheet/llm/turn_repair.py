"""Conversation structure repair: the cheapest edits that give ``(s?(ua)+)?``, by integer weights on a DAG.

Each row is kept (0), given the other role (1) or deleted (2); an empty user
or assistant turn can be inserted anywhere (5). Blank and repeated rows must
go; a truncated row that stays costs 5 more. Among the cheapest repairs the
one whose audit (the edits' initials in order) is least in ASCII is taken.

The nodes are gaps between rows times the role automaton's states. A node's
value is one integer: its high digits are the cost, its low octal digits spell
the audit. Every row owns ``SLOT`` digits, room for the inserts before it and
its own edit, with zeros at the end. A row's edits end with the only letter
that isn't I, so no row's edits begin another's and slots compare as the audits
do; a zero sorts before every letter, so the shorter audit wins at the end.
Two inserts a gap are room enough: a third returns to a state of the gap, 10
dearer. So one minimum of integers decides cost and audit together.

Rows are streamed in order, sorted by Spark, and the digits that all live
nodes share are settled and taken off, so the integers and the kept rows stay
as short as the part still open. Nodes that can't win any more are dropped:
the state after an assistant turn takes every continuation of another state
at no more than ``_REACH`` extra.

Defined results: null roles and texts are one space; rows are taken by turn
(nulls first), then role and text; a conversation's first row of a role and
text is no repeat; a null conv_id is a conversation of its own; roles count by
their first letter, other letters can't be kept; a conversation with no rows
left gives zeros, an empty audit and the hash of an empty string; ``gaps`` beyond
a long are the largest long; an empty table gives no rows; extra columns are
ignored. A conversation's audit is one string, and its hash is taken by one
task: a single conversation must fit a task's time, not its memory.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, ship

NONE, BLANK, DUPLICATE, TRUNCATED, GONE = range(5)
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
STAYS_TRUNCATED = 5
LETTERS = "DIKR"  # in ASCII order: octal digits 1 to 4
SLOT = 3
_BITS = 3 * SLOT
_OWN = {c: i + 1 for i, c in enumerate(LETTERS)}
SETTLE = 32  # rows between looks for settled digits

# the automaton: nothing yet, after system, after user, after assistant
START, SYSTEM, USER, ASSISTANT = range(4)
_SAID = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # by a turn that may be either
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_REACH = {START: COSTS["D"], SYSTEM: 0, USER: COSTS["D"]}


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and gone: the rows with the faults that crc32 of ``conv_id:turn`` deals them."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("deal"))
    deal = F.col("deal")
    return rows.select(
        "conv_id", "turn", F.when(deal == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(deal == 1, "").when(deal == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (deal == 0).alias("gone"), F.explode(F.when(deal == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the row's first fault. ``gone`` rows only tell that their conversation was there.

    A repeat is found within (conversation, role, text), so a hot conversation's
    rows spread by their texts; blank rows need no look and spread by turn.
    """
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    said = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.when(~gone, F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(~gone, F.coalesce(F.col("text").cast("string"), F.lit(" "))).alias("text"), gone.alias("gone"))
    # SQL's trim takes the named characters, here the contract's six blanks
    last: Column = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    said = said.withColumn("last", last)
    idle = F.col("gone") | (F.col("last") == "")
    first = Window.partitionBy("conv_id", "role", "text", "gone", F.when(idle, F.col("turn"))).orderBy(F.asc_nulls_first("turn"))
    fault = F.when(F.col("gone"), GONE).when(F.col("last") == "", BLANK).when(F.col("_nth") > 1, DUPLICATE) \
        .when(~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    return said.withColumn("_nth", F.row_number().over(first)).select(
        "conv_id", "turn", "role", "text", fault.cast("int").alias("fault"))


class Repair:
    """One conversation's cheapest repair. ``push`` takes rows in order; settled turns go to ``emit(edit, role, text)``."""

    def __init__(self, emit: Callable[[str, str, str], None]):
        self.emit, self.audit = emit, []
        self.value: dict[int, int] = {START: 0}
        self.open: deque[tuple[str, str]] = deque()
        self.state = START  # of the settled part

    def _with_inserts(self, width: int) -> Iterator[tuple[int, int, int]]:
        """(state, value, inserts) in this gap, the values with a fresh slot."""
        layer = {s: v << _BITS for s, v in self.value.items()}
        for used in range(SLOT):
            for s, v in layer.items():
                yield s, v, used
            if used + 1 < SLOT:
                weight = (COSTS["I"] << width) + (_OWN["I"] << 3 * (SLOT - 1 - used))
                more: dict[int, int] = {}
                for s, v in layer.items():
                    to = _NEXT[s]
                    more[to] = min(v + weight, more.get(to, v + weight))
                layer = more

    def push(self, role: str, text: str, fault: int) -> None:
        width = _BITS * (len(self.open) + 1)
        extra = STAYS_TRUNCATED if fault == TRUNCATED else 0
        initial, best = role[:1], {}
        for s, v, used in self._with_inserts(width):
            at = 3 * (SLOT - 1 - used)
            edges = [(s, "D", COSTS["D"])]
            if fault not in (BLANK, DUPLICATE):
                edges.append((_NEXT[s], "R", COSTS["R"] + extra))
                if initial in _SAID[s]:
                    edges.append((_SAID[s][initial], "K", COSTS["K"] + extra))
            for to, letter, cost in edges:
                total = v + (cost << width) + (_OWN[letter] << at)
                if to not in best or total < best[to]:
                    best[to] = total
        limit = best[ASSISTANT] >> width if ASSISTANT in best else None
        self.value = {s: v for s, v in best.items() if s == ASSISTANT or limit is None or v >> width <= limit + _REACH[s]}
        self.open.append((role, text))
        if len(self.open) % SETTLE == 0:
            self._settle()

    def _settle(self) -> None:
        """Take off the slots in which all live nodes agree."""
        rows = len(self.open)
        first, *others = self.value.values()
        low = (1 << _BITS * rows) - 1
        differ = 0
        for v in others:
            differ |= (first ^ v) & low
        agreed = rows - -(-differ.bit_length() // _BITS)
        if agreed:
            rest = _BITS * (rows - agreed)
            self._replay(first >> rest & (1 << _BITS * agreed) - 1, agreed)
            keep = (1 << rest) - 1
            self.value = {s: (v >> _BITS * rows) << rest | v & keep for s, v in self.value.items()}

    def _replay(self, digits: int, slots: int) -> None:
        for i in range(slots - 1, -1, -1):
            row = None
            for k in range(SLOT - 1, -1, -1):
                d = digits >> (_BITS * i + 3 * k) & 7
                if not d:
                    continue
                letter = LETTERS[d - 1]
                self.audit.append(letter)
                if letter != "I":
                    row = self.open.popleft()
                if letter == "K":
                    self.state = _SAID[self.state][row[0][:1]]
                    self.emit(letter, *row)
                elif letter != "D":
                    self.state = _NEXT[self.state]
                    self.emit(letter, _NAMES[self.state], row[1] if letter == "R" else "")

    def finish(self) -> tuple[int, str]:
        """Cost and audit of the whole conversation."""
        width = _BITS * (len(self.open) + 1)
        best = min(v for s, v, _ in self._with_inserts(width) if s in (START, ASSISTANT))
        self._replay(best & (1 << width) - 1, len(self.open) + 1)
        return best >> width, "".join(self.audit)


class Conversation:
    """Counts, repair and hash of one conversation, fed row by row."""

    def __init__(self, conv_id: int | None, emit: Callable | None = None):
        self.conv_id, self.hash, self.turns, self.more = conv_id, hashlib.sha256(), 0, emit
        self.low = self.high = self.last_turn = None
        self.distinct = self.illegal = 0
        self.faults = [0] * 5
        self.before: str | None = None
        self.repair = Repair(self._said)

    def _said(self, edit: str, role: str, text: str) -> None:
        self.hash.update(("\n" * (self.turns > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        if self.more:
            self.more(self.conv_id, self.turns, edit, role, text)
        self.turns += 1

    def push(self, turn: int | None, role: str | None, text: str | None, fault: int) -> None:
        if fault == GONE:
            return
        if turn is not None:
            if turn != self.last_turn:
                self.distinct += 1
            self.low, self.high, self.last_turn = turn if self.low is None else self.low, turn, turn
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        self.faults[fault] += 1
        self.repair.push(role, text, fault)

    def result(self) -> dict:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.distinct, 2 ** 63 - 1)
        cost, audit = self.repair.finish()
        return {"conv_id": self.conv_id, "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
                "truncated": self.faults[TRUNCATED], "illegal": self.illegal, "cost": cost, "audit": audit,
                "repaired_sha256": self.hash.hexdigest()}


SUMMARY = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")
TURNS = "conv_id bigint, place bigint, edit string, role string, text string"


def _in_order(rows: DataFrame) -> DataFrame:
    ship(rows.sparkSession)
    return with_faults(rows).repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")


def _walk(batches: Iterator[pa.RecordBatch], emit: Callable | None = None) -> Iterator[dict | None]:
    """The conversations' results, one by one; None after each batch."""
    now: Conversation | None = None
    for b in batches:
        for conv_id, turn, role, text, fault in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now.result()
                now = Conversation(conv_id, emit)
            now.push(turn, role, text, fault)
        yield None
    if now is not None:
        yield now.result()


def summaries(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of its repair and the repaired text's hash."""
    schema = pa.schema([(c, pa.string() if c in ("audit", "repaired_sha256") else pa.int64())
                        for c in (x.split()[0] for x in SUMMARY.split(", "))])

    def run(batches):
        done = []
        for got in _walk(batches):
            if got is not None:
                done.append(got)
            if done and (got is None or len(done) >= 2000):
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return _in_order(rows).mapInArrow(run, SUMMARY)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations, a row per turn: conv_id, place (from 0), the edit that made it, role and text."""
    names = ("conv_id", "place", "edit", "role", "text")

    def run(batches):
        schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), *((c, pa.string()) for c in names[2:])])
        said: list[tuple] = []
        for _ in _walk(batches, lambda *turn: said.append(turn)):
            if said:
                yield pa.RecordBatch.from_pylist([dict(zip(names, t, strict=True)) for t in said], schema)
                said.clear()

    return _in_order(rows).mapInArrow(run, TURNS)

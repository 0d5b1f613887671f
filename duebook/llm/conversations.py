"""Repair of the structure of conversations at the least cost.

A conversation's rows, by turn, become an optional system row and then pairs of user
and assistant rows, or nothing.  Rows are kept, given another role, deleted, or empty
rows are inserted; of several cheapest repairs the one whose edits' initials come
first in ASCII order is made.

Rows are shuffled by conversation and sorted by turn, and Python reads them as a
stream, so a conversation may be of any length:

1. Backwards, without texts.  The dynamic program has four states (what the roles so
   far allow next); it carries the cost from each state to the end across Arrow
   batches and leaves one byte a row, the best edit in each state.  Bytes go to a
   written table in pieces of ``PIECE`` rows, never more than one piece in memory.
2. Forwards, with the pieces sorted before their rows: the state walks through the
   bytes, and each row gets its edit.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, Scratch, has_word

PIECE = 1 << 16  # rows
HEAD = 64  # characters
ENDS = (".", "!", "?")

RETAG, DELETE, INSERT, CUT = 2, 3, 2, 1  # costs; CUT: a truncated row that stays
EDITS = ("Delete", "Insert", "Keep", "Rerole")  # in the order of their initials
FAULTS = (None, "blank", "duplicate", "truncated")
# States: nothing so far, after the system row, after a user row, after an assistant row.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_EXPECTED = (_USER, _USER, _ASSISTANT, _USER)  # by an inserted or renamed row
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_INITIALS = "sua"
_KEPT = ({0: _SYSTEM, 1: _USER}, {1: _USER}, {2: _ASSISTANT}, {1: _USER})  # by initial
_END = (0, 2 * INSERT, INSERT, 0)  # costs after the last row


def backwards(costs: tuple[int, ...], kind: int) -> tuple[int, tuple[int, ...]]:
    """(best edits, costs before the row) from the costs after a row of this kind.

    Edits take two bits a state.  Costs are less their minimum, so few tuples occur.
    """
    initial, fault = kind // 4, FAULTS[kind % 4]
    stays = CUT if fault == "truncated" else 0
    options = []
    for state in range(4):
        row = {0: DELETE + costs[state]}
        if fault not in ("blank", "duplicate"):
            row[3] = RETAG + stays + costs[_EXPECTED[state]]
            if initial in _KEPT[state]:
                row[2] = stays + costs[_KEPT[state][initial]]
        options.append(row)
    best = [min(row.values()) for row in options]
    best[_USER], best[_ASSISTANT] = min(best[_USER], INSERT + best[_ASSISTANT]), min(best[_ASSISTANT], INSERT + best[_USER])
    for state in (_START, _SYSTEM):
        best[state] = min(best[state], INSERT + best[_USER])
    edits = 0
    for state, row in enumerate(options):
        row[1] = INSERT + best[_EXPECTED[state]]
        edits |= min(e for e, cost in row.items() if cost == best[state]) << 2 * state
    return edits, tuple(c - min(best) for c in best)


_KEY = ("turn", "role", "head", "mark")


def _decisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of best edits and faults, in order of turn, from rows in reverse order."""
    known: dict[tuple, tuple[int, tuple[int, ...]]] = {}
    names = ["conv_id", *_KEY, "piece", "edits", "faults"]
    schema = None
    edits, faults, piece, costs, last = bytearray(), bytearray(), 0, _END, None

    def done() -> pa.RecordBatch:
        values = [*last, -piece, bytes(reversed(edits)), bytes(reversed(faults))]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, schema, strict=True)], names)

    for batch in batches:
        schema = [*(batch[c].type for c in names[:5]), pa.int64(), pa.binary(), pa.binary()]
        convs, kinds = batch["conv_id"].to_pylist(), batch["kind"].to_pylist()

        def key(k: int) -> tuple:
            return convs[k], *(batch[c][k].as_py() for c in _KEY)  # noqa: B023

        for k, (conv, kind) in enumerate(zip(convs, kinds, strict=True)):
            if edits:
                before = convs[k - 1] if k else last[0]
                if conv != before or len(edits) >= PIECE:
                    if k:
                        last = key(k - 1)
                    yield done()
                    edits.clear()
                    faults.clear()
                    piece, costs = (0, _END) if conv != before else (piece + 1, costs)
            step = known.get((costs, kind))
            if step is None:
                step = known[costs, kind] = backwards(costs, kind)
            edits.append(step[0])
            faults.append(kind % 4)
            costs = step[1]
        if convs:
            last = key(len(convs) - 1)
    if edits:
        yield done()


class _Walk:
    """Edits of one conversation after another, row by row."""

    def __init__(self):
        self.conv, self.begun, self.state, self.place = None, False, _START, 0
        self.pieces: deque[tuple[bytes, bytes]] = deque()
        self.at = 0

    def row(self, source: int, system: bool, out: list) -> None:
        """Appends (source row or -1, conversation, place, edit, fault, new role) for the
        next row; ``system`` if its role is one that begins a conversation."""
        if self.at == len(self.pieces[0][0]):
            self.pieces.popleft()
            self.at = 0
        edits, faults = self.pieces[0]
        byte, fault = edits[self.at], faults[self.at]
        self.at += 1
        while (edit := byte >> 2 * self.state & 3) == 1:
            self.insert(out)
        role = None
        if edit == 3:
            self.state = _EXPECTED[self.state]
            role = _ROLE[self.state]
        elif edit == 2:
            self.state = _SYSTEM if system else _EXPECTED[self.state]
        self.place += 1
        out.append((source, self.conv, self.place, edit, fault, role))

    def insert(self, out: list) -> None:
        self.state = _EXPECTED[self.state]
        self.place += 1
        out.append((-1, self.conv, self.place, 1, 0, _ROLE[self.state]))

    def end(self, out: list) -> None:
        while self.state in (_SYSTEM, _USER):
            self.insert(out)

    def begin(self, conv) -> None:
        self.conv, self.begun, self.state, self.place, self.at = conv, True, _START, 0, 0
        self.pieces.clear()


_OUT = ("conv_id", "place", "turn", "edit", "fault", "was", "role", "text")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    walk, types = _Walk(), None

    def rows(out: list, batch: pa.RecordBatch | None) -> pa.RecordBatch:
        source, convs, places, edits, faults, roles = (list(x) for x in zip(*out, strict=True))
        at = pa.array([s if s >= 0 else None for s in source], pa.int64())
        if batch is None:
            turn, was, text = (pa.nulls(len(out), t) for t in types[1:])
        else:
            turn, was, text = (pc.take(batch[c], at) for c in ("turn", "role", "text"))
        columns = [
            pa.array(convs, types[0]), pa.array(places, pa.int64()), turn, pa.array([EDITS[e] for e in edits]),
            pa.array([FAULTS[f] for f in faults], pa.string()), was,
            pc.coalesce(pa.array(roles, pa.string()), was.cast(pa.string())), pc.fill_null(text.cast(pa.string()), ""),
        ]
        return pa.RecordBatch.from_arrays(columns, list(_OUT))

    for batch in batches:
        types = [batch[c].type for c in ("conv_id", "turn", "role", "text")]
        out: list = []
        system = pc.starts_with(batch["role"], "s").to_pylist()
        pieces = zip(batch["edits"].to_pylist(), batch["faults"].to_pylist(), strict=True)
        for k, (conv, is_system, (edits, faults)) in enumerate(zip(batch["conv_id"].to_pylist(), system, pieces, strict=True)):
            if not walk.begun or conv != walk.conv:
                walk.end(out)
                walk.begin(conv)
            if edits is not None:
                walk.pieces.append((edits, faults))
            else:
                walk.row(k, is_system, out)
        if out:
            yield rows(out, batch)
    out = []
    walk.end(out)
    if out:
        yield rows(out, None)


def _keyed(rows: DataFrame) -> DataFrame:
    """The four columns of a conversation, and what puts its rows in order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    plain = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"))
    return plain.select("conv_id", "turn", "role", F.substring("text", 1, HEAD).alias("head"), F.unhex(F.md5("text")).alias("mark"), "text")


def _type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _fault(text: Column) -> Column:
    """The place in ``FAULTS`` of a text by itself."""
    ended = F.right(F.rtrim(text, F.lit(SPACE)), F.lit(1)).isin(*ENDS)
    return F.when(~has_word(text), 1).when(~ended, 3).otherwise(0)


def repair(rows: DataFrame) -> DataFrame:
    """The edits of all conversations of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``).

    Gives ``conv_id``, ``place`` (from one), ``turn`` (null where inserted), ``edit``
    (Keep, Rerole, Delete, Insert), ``fault`` (blank, duplicate, truncated or null),
    ``was`` (the role before), ``role`` and ``text``; what is not deleted is the repaired
    conversation.  Rows of a conversation lie together and in order in one partition.

    A row's first fault counts: blank (nothing but ASCII white space), duplicate (role
    and text seen earlier), truncated (does not end in one of ``ENDS``).  The first two
    are always deleted.  Rows of one turn are ordered by role, the text's first ``HEAD``
    characters and its hash; null turns come first.  Null roles and texts count as one
    space; rows without a conversation are one conversation.  A role counts by its first
    letter, and an empty or other one is never kept.  Other columns are not read.  An
    empty table gives none.
    """
    keyed = _keyed(rows)
    facts = keyed.select("conv_id", *_KEY, _fault(F.col("text")).alias("alone")).repartition("conv_id")
    # by conversation already, so this sorts and does not shuffle
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "mark").orderBy("turn"))
    fault = F.when((F.col("alone") != 1) & (seen > 1), 2).otherwise(F.col("alone"))
    initial = F.lit(len(_INITIALS))
    for number, letter in enumerate(_INITIALS):
        initial = F.when(F.col("role").startswith(letter), number).otherwise(initial)
    kinds = facts.select("conv_id", *_KEY, seen.alias("seen"), (initial * 4 + fault).alias("kind"))
    down = kinds.sortWithinPartitions(*(F.desc(c) for c in ("conv_id", *_KEY, "seen"))).drop("seen")
    key = f"conv_id {_type_of(rows, 'conv_id')}, turn {_type_of(rows, 'turn')}, role string, head string, mark binary"
    pieces = Scratch(rows.sparkSession).cut(down.mapInArrow(_decisions, f"{key}, piece long, edits binary, faults binary"))

    both = keyed.withColumn("piece", F.lit(1)).unionByName(pieces, allowMissingColumns=True)
    up = both.repartition("conv_id").sortWithinPartitions("conv_id", *_KEY, "piece")
    out = f"conv_id {_type_of(rows, 'conv_id')}, place long, turn {_type_of(rows, 'turn')}, edit string, fault string, was string, role string, text string"
    return up.drop("head", "mark", "piece").mapInArrow(_edited, out)


class _Tally:
    """Counts of one conversation; memory grows by one letter an edit."""

    def __init__(self):
        self.first = self.last = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.counts = dict.fromkeys(FAULTS, 0)
        self.audit = bytearray()
        self.hash, self.gap = hashlib.sha256(), ""

    def add(self, turn, edit: str, fault: str | None, was: str, role: str, text: str) -> None:
        self.audit += edit[0].encode()
        if edit != "Insert":
            self.counts[fault] += 1
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last = turn
                self.turns += 1
            if self.before is not None and self.before + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = was[:1]
        self.cost += {"Delete": DELETE, "Insert": INSERT, "Keep": 0, "Rerole": RETAG}[edit]
        if edit != "Delete":
            self.cost += CUT if fault == "truncated" else 0
            self.hash.update(f"{self.gap}{role}:{text}".encode())
            self.gap = "\n"

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        faults = (self.counts[f] for f in FAULTS[1:])
        return gaps, *faults, self.illegal, self.cost, self.audit.decode(), self.hash.hexdigest()


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, tally, kind = None, None, None

    def made(done: list) -> pa.RecordBatch:
        names = [c.split()[0] for c in _REPORT.split(", ")]
        columns = [list(x) for x in zip(*done, strict=True)]
        typed = [pa.array(v, pa.string() if c in names[-2:] else pa.int64()) for c, v in zip(names, columns[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *typed], ["conv_id", *names])

    for batch in batches:
        kind, done = batch["conv_id"].type, []
        rows = zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "edit", "fault", "was", "role", "text")), strict=True)
        for now, *row in rows:
            if tally is None or now != conv:
                if tally is not None:
                    done.append((conv, *tally.row()))
                conv, tally = now, _Tally()
            tally.add(*row)
        if done:
            yield made(done)
    if tally is not None:
        yield made([(conv, *tally.row())])


def report(repaired: DataFrame) -> DataFrame:
    """A row for each conversation of a result of :func:`repair`, read as a stream: gaps
    in the turns, faults, adjacent roles that may not follow each other, the cost, the
    initials of the edits, and the SHA-256 of the repaired ``role:text`` lines."""
    return repaired.mapInArrow(_reports, f"conv_id {_type_of(repaired, 'conv_id')}, {_REPORT}")

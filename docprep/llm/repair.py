"""Repair of damaged conversations by Knuth's lightest derivation.

A repaired conversation has the role initials ``(s?(ua)+)?``. Items are (rows
read, state of that pattern), deductions are the edits, and the weight of an
item is its cheapest (cost, audit), where the audit is the edits' initials in
order. The agenda pops items by (cost, rows read, audit): each deduction adds
to the cost or to the rows read, so its conclusion is never lighter than its
premise, and what is popped is final; among derivations of one item, which have read the same
rows, that order is (cost, audit). It ends when the goal item is popped.

Conversations are sorted by range, by conversation and turn, so a
long one is spread over several tasks, and each task reads its rows in blocks of
``BLOCK``, fewer where texts are long, which bounds memory: at the end of a block each of the four states has a
weight, with the digest of the text repaired so far, and what their audits have in
common is settled. What a task sees first and last may go on in its
neighbours: of these conversations it gives, for each state that they may come in with,
the weights of the states they may leave in; those few pieces are put together by
conversation, and only the digest of such a conversation, which by its nature is made in
order, reads its rows again.

Damage and rows: nulls in conversation number, turn, role and text count as one
space where they are hashed or read; order is by turn (nulls first), then role,
then a digest of role and text, which no more than places rows that share a turn. Edge cases: a null
conv_id is a conversation like others; an empty role can't be kept; conversations of
any length, very long texts, repeated rows and empty tables are worked on like
others (an empty table gives none); other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, written

BLOCK = 512
#: Edits' initials and costs; an undeleted row that is truncated adds CUT.
KEEP, REROLE, DELETE, INSERT, CUT = ("K", 0), ("R", 1), ("D", 2), ("I", 5), 5
#: State -> the role that may be inserted or given there; 0 is the start, 1 follows the system, 2 a user, 3 an assistant.
WANTS = {0: "user", 1: "user", 2: "assistant", 3: "user"}
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
#: Faults of a row.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

Row = tuple[str, int]
Start = dict[int, tuple[int, str]]


def lightest(rows: list[Row], starts: Start, final: bool = False) -> dict[int, tuple[int, str, int]]:
    """State after all rows -> its cost, audit and the start it comes from. rows: role initial and fault. final: only the goal's state, one of ENDS."""
    agenda = [(cost, 0, audit, state, state) for state, (cost, audit) in starts.items()]
    heapq.heapify(agenda)
    done, found = set(), {}
    while agenda:
        cost, i, audit, state, start = heapq.heappop(agenda)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows):
            if final and state in ENDS:
                return {state: (cost, audit, start)}
            found[state] = (cost, audit, start)
            if len(found) == 4:
                break
        wanted = AFTER[state, WANTS[state][0]]
        heapq.heappush(agenda, (cost + INSERT[1], i, audit + INSERT[0], wanted, start))
        if i == len(rows):
            continue
        role, fault = rows[i]
        heapq.heappush(agenda, (cost + DELETE[1], i + 1, audit + DELETE[0], state, start))
        if fault in (BLANK, DUPLICATE):
            continue
        more = CUT if fault == TRUNCATED else 0
        kept = AFTER.get((state, role))
        if kept is not None:
            heapq.heappush(agenda, (cost + KEEP[1] + more, i + 1, audit + KEEP[0], kept, start))
        if role != WANTS[state][0]:
            heapq.heappush(agenda, (cost + REROLE[1] + more, i + 1, audit + REROLE[0], wanted, start))
    return found


def repaired(audit: str, state: int, rows: Iterator[tuple[str, str]]) -> Iterator[str]:
    """The pieces of the repaired text that an audit gives, from a state on; rows: role and text, read as they are needed."""
    for edit in audit:
        role, text = (WANTS[state], "") if edit == INSERT[0] else next(rows)
        if edit == DELETE[0]:
            continue
        if edit == REROLE[0]:
            role = WANTS[state]
        yield ("\n" if state else "") + role + ":" + text
        state = AFTER[state, role[0]]


class Course:
    """The weights of the four states after the rows so far, from one state on; with ``hashed`` the digests of their texts too."""

    def __init__(self, start: int, hashed: bool) -> None:
        self.start, self.settled = start, []
        self.at = {start: (0, "", hashlib.sha256() if hashed else None)}

    def feed(self, rows: list[Row], texts: list[tuple[str, str]], final: bool = False) -> None:
        found = lightest(rows, {q: (c, a) for q, (c, a, _) in self.at.items()}, final)
        cost3 = found[3][0] if 3 in found else None
        if cost3 is not None:  # what no cheapest derivation goes through any more: the assistant's state can do the same for less
            found = {q: f for q, f in found.items() if not (q == 0 and f[0] > cost3 + DELETE[1] or q == 1 and f[0] > cost3)}
        common = len(commonprefix([a for _, a, _ in found.values()]))
        self.settled.append(next(iter(found.values()))[1][:common])
        now = {}
        for q, (cost, audit, start) in found.items():
            digest = self.at[start][2]
            if digest is not None:
                digest = digest.copy()
                for piece in repaired(audit[len(self.at[start][1]) :], start, iter(texts)):
                    digest.update(piece.encode())
            now[q] = (cost, audit[common:], digest)
        self.at = now

    def moves(self) -> list[dict]:
        before = "".join(self.settled)
        return [{"start": self.start, "end": q, "cost": c, "audit": before + a} for q, (c, a, _) in self.at.items()]


class Talk:
    """One task's rows of a conversation. known: that it begins here."""

    def __init__(self, conv: int | None, known: bool) -> None:
        self.conv, self.known = conv, known
        self.courses = [Course(0, True)] if known else [Course(q, False) for q in range(4)]
        self.rows: list[Row] = []
        self.texts: list[tuple[str, str]] = []
        self.faults = [0] * 4
        self.n = self.illegal = self.turns = self.size = 0
        self.least = self.most = None
        self.ends: list = []  # first and last (turn, initial)
        self.last = None

    def add(self, turn: int | None, role: str, text: str, digest: str, fault: int) -> None:
        if self.last == (turn, digest) and fault != BLANK:
            fault = DUPLICATE
        initial = role[:1]
        if self.n and self.ends[1][1] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None:
            self.turns += not self.n or self.ends[1][0] != turn
            self.least, self.most = (turn if self.least is None else self.least), turn
        self.ends = [self.ends[0] if self.n else (turn, initial), (turn, initial)]
        self.n, self.last = self.n + 1, (turn, digest)
        self.faults[fault] += 1
        self.rows.append((initial, fault))
        self.texts.append((role, text) if self.known else ("", ""))
        self.size += len(text) if self.known else 0
        if len(self.rows) == BLOCK or self.size > SLICE_BYTES:
            self.flush()

    def flush(self, final: bool = False) -> None:
        if self.rows or final:
            for course in self.courses:
                course.feed(self.rows, self.texts, final)
            self.rows, self.texts, self.size = [], [], 0

    def result(self) -> dict:
        """Of a conversation that is here as a whole."""
        self.flush(final=True)
        ((cost, audit, digest),) = self.courses[0].at.values()
        return self.counts() | {"cost": cost, "audit": "".join(self.courses[0].settled) + audit, "repaired_sha256": digest.hexdigest()}

    def counts(self) -> dict:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return {"conv_id": self.conv, "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED], "illegal": self.illegal}

    def piece(self) -> dict:
        """Of one that may have begun before or go on after."""
        self.flush()
        (first, initial), (last, end) = self.ends or [(None, None)] * 2
        edges = {"n": self.n, "least": self.least, "most": self.most, "turns": self.turns, "first_turn": first, "last_turn": last, "first_role": initial, "last_role": end}
        return self.counts() | {"piece": TaskContext.get().partitionId(), "edges": edges, "moves": [m for c in self.courses for m in c.moves()]}


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_MADE = f"conv_id long, {_COUNTS}, repaired_sha256 string"
_EDGES = [("n", pa.int64()), ("least", pa.int64()), ("most", pa.int64()), ("turns", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("first_role", pa.string()), ("last_role", pa.string())]
_MOVES = [("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]
_SPARK = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string"}
_RAW = f"{_MADE}, piece int, edges struct<{', '.join(f'{n}: {_SPARK[t]}' for n, t in _EDGES)}>, moves array<struct<{', '.join(f'{n}: {_SPARK[t]}' for n, t in _MOVES)}>>"
_TYPES = {"conv_id": pa.int64(), "gaps": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(), "cost": pa.int64(), "audit": pa.string(), "repaired_sha256": pa.string(), "piece": pa.int32(), "edges": pa.struct(_EDGES), "moves": pa.list_(pa.struct(_MOVES))}


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], _TYPES[n]) for n in names], names=names)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone, copies: what becomes of each row, by the hash of its place."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    h = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), h.alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("h") == 0).alias("gone"), F.when(F.col("h") == 3, 2).otherwise(1).alias("copies"))


def with_faults(rows: DataFrame) -> DataFrame:
    """rows, with digest and fault. A copy that follows its original at once is told when rows are in order; only digests of texts that stand more than once are joined."""
    end = F.rtrim("text", F.lit(WHITE))
    rows = rows.withColumn("digest", F.sha2(F.concat("role", F.lit("\n"), "text"), 256))
    place = F.struct(F.col("turn").isNotNull().alias("k"), F.coalesce("turn", F.lit(0)).alias("t"))
    many = rows.where(~F.col("gone")).groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("g")).agg(F.count("*").alias("times"), F.min(place).alias("first")).where("times > 1")
    both = rows.join(many, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("g")), "left")
    fault = F.when(end == "", BLANK).when(F.col("first") < place, DUPLICATE).when(~F.substring(end, -1, 1).rlike("[.!?]"), TRUNCATED).otherwise(SOUND)
    return both.select("conv_id", "turn", "role", "text", "gone", "copies", "digest", fault.alias("fault"))


_ORDER = ["conv_id", "turn", "role", "digest"]


def _talks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, made, talk, first = list(_TYPES), [], None, True
    for batch in batches:
        for conv, turn, role, text, gone, copies, digest, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "copies", "digest", "fault")), strict=True):
            if talk is None or talk.conv != conv:
                if talk is not None:
                    made.append(talk.piece() if first else talk.result())
                    first = False
                talk = Talk(conv, known=not first)
            for _ in range(0 if gone else copies):
                talk.add(turn, role, text, digest, fault)
        if made:
            yield _batch(made, names)
            made = []
    if talk is not None:
        yield _batch([talk.piece()], names)


def _joined(table: pa.Table) -> pa.Table:
    """The pieces of one conversation as one row."""
    pieces = sorted(table.to_pylist(), key=lambda p: p["piece"])
    out = {n: sum(p[n] for p in pieces) for n in ("blank", "duplicate", "truncated", "illegal")}
    at, last, turns, bounds = {0: (0, "")}, None, 0, []
    for p in pieces:
        e, new = p["edges"], {}
        for m in p["moves"]:
            if m["start"] in at:
                cost, audit = at[m["start"]]
                new[m["end"]] = min(new.get(m["end"], (1 << 62, "")), (cost + m["cost"], audit + m["audit"]))
        at = new
        if e["n"]:
            if last:
                out["illegal"] += last["last_role"] + e["first_role"] not in ("su", "ua", "au")
                turns -= last["last_turn"] is not None and last["last_turn"] == e["first_turn"]
            turns, last = turns + e["turns"], e
            bounds += [x for x in (e["least"], e["most"]) if x is not None]
    cost, audit = min(at[q] for q in ENDS if q in at)
    out |= {"conv_id": pieces[0]["conv_id"], "gaps": max(bounds) - min(bounds) + 1 - turns if bounds else 0, "cost": cost, "audit": audit}
    names = [n.split()[0] for n in f"conv_id long, {_COUNTS}".split(", ")]
    return pa.Table.from_batches([_batch([out], names)])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each conversation's after its audit (kind 0), as that first row with the digest of the repaired text."""
    names = [n.split()[0] for n in _MADE.split(", ")]
    head, digest, state, at = None, None, 0, 0

    def edits(until_row: bool, role: str = "", text: str = "") -> None:
        nonlocal state, at
        audit, begun = head["audit"], at
        while at < len(audit) and audit[at] == INSERT[0]:
            at += 1
        at += until_row
        for piece in repaired(audit[begun:at], state, iter([(role, text)])):
            digest.update(piece.encode())
        for edit in audit[begun:at]:
            if edit != DELETE[0]:
                state = AFTER[state, WANTS[state][0] if edit != KEEP[0] else role[0]]

    def ended() -> Iterator[pa.RecordBatch]:
        if head:
            edits(False)
            yield _batch([head | {"repaired_sha256": digest.hexdigest()}], names)

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                yield from ended()
                head, digest, state, at = row, hashlib.sha256(), 0, 0
            else:
                edits(True, row["role"], row["text"])
    yield from ended()


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: a row for each conversation, damaged first."""
    rows = written(with_faults(damaged(conversations)), "turns")
    made = written(rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).mapInArrow(_talks, _RAW), "repairs")
    whole = made.where("moves IS NULL").select(*(n.split()[0] for n in _MADE.split(", ")))
    joined = written(made.where("moves IS NOT NULL").groupBy("conv_id").applyInArrow(_joined, f"conv_id long, {_COUNTS}"), "joined")
    few = F.broadcast(joined.select(F.col("conv_id").alias("c")))  # two conversations for each task at most
    again = rows.where("NOT gone").join(few, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    heads = joined.withColumn("kind", F.lit(0))
    sorted_ = heads.unionByName(again.select("conv_id", "turn", "role", "text", "digest", F.lit(1).alias("kind")), allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return whole.unionByName(sorted_.mapInArrow(_digests, _MADE))

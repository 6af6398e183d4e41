"""Conversation structure repair: cost by dynamic programming, path by prefix doubling.

A conversation is a row of messages; repaired, the initials of its roles read
``(s?(ua)+)?``. Four states tell how far that is: nothing yet, after s, after u, after a.
Edits take a message or put one in: Keep, Rerole, Delete, Insert, and each letter leaves a
state by one arc at most, as only one of u and a can come next.

Conversations are of any length, so they are worked on in segments: messages in order, range
partitioned by (conversation, turn, role, text), at most ``SEGMENT_ROWS`` of them and
``SEGMENT_BYTES`` of text, one row per segment.

1. A segment's cost matrix: from each state at its start to each at its end. Chained from the
   last segment of a conversation to its first, that is the cost still to come at every
   segment's end (min-plus products, one vector passed along a sorted stream).
2. Given that, arcs on cheapest paths are known in every segment by itself. Its nodes (place,
   state) are ranked by the first letter of their least audit, then by the first two, four,
   eight letters: rank and rank behind the doubled pointer make the next rank. The least path
   from each of the four states is read off the pointers, all its steps at once.
3. The states in which segments start follow in one more pass along the stream, and with them
   each segment's part of the audit. Repaired messages are written and hashed in order.

A stored segment is found again by its number, so lost executors cost their own share.

Rules: NULL ids, turns, roles and texts read as one space; a NULL turn comes first. Messages of
one turn come in the order of (role, text). Copies of a message, in any number, are one row
with a count until they are cut into segments. A kept role of no letters adds no initial.
Conversations of which no message is left have zeros and an empty audit. Of an empty table the
result is empty. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join, shuffle_parts
from .common import stored

SEGMENT_ROWS, SEGMENT_BYTES = 512, 16 << 10
#: Segments, and messages, that a task works on at once.
ROWS = 512
#: States; the state after a letter; where an insertion leads.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
_NEVER = 1 << 40
_STEP = {"s": (AFTER_S, -1, -1, -1), "u": (AFTER_U, AFTER_U, -1, AFTER_U), "a": (-1, -1, AFTER_A, -1)}
_NEXT = np.array([AFTER_U, AFTER_U, AFTER_A, AFTER_U])
#: Edits in ASCII order, their letters and costs.
DELETE, INSERT, KEEP, REROLE = range(4)
LETTERS = np.frombuffer(b"DIKR", np.uint8)
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
_SPACE = " \t\n\x0b\x0c\r"
#: Cost still to come behind the last message: nothing, or insertions up to "ua".
_AT_END = np.array([0, 2 * INSERT_COST, INSERT_COST, 0])
_END_AUDIT = ["", "II", "I", ""]
_OPEN_ROLES = ["user", "user", "assistant", "user"]


def damage(conversations: DataFrame) -> DataFrame:
    """(conv, conv_id, turn, role, text, copies): what a checksum of id and turn leaves of a table.

    ``conv`` is the id as text, never NULL.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    rows = conversations.select(
        conversation_key("conv_id").alias("conv"),
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
        kind.alias("_kind"),
    )
    return rows.where("_kind != 0").drop("_kind")


def conversation_key(column: str) -> Column:
    return F.when(F.col(column).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(column).cast("string")))


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct messages with their copies, whether said before, blank, and cut off."""
    stripped = F.rtrim(F.col("text"), F.lit(_SPACE))
    counted = stored(
        rows.groupBy("conv", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
        .withColumn("said", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    )
    order = F.struct(F.col("turn").isNotNull().alias("dated"), "turn")
    first = counted.groupBy("conv", "said").agg(F.min(order)["turn"].alias("first"))
    known = lookup_join(
        counted,
        stored(first),
        on={"conv": "conv", "said": "said"},
        take={"first": "first"},
        spread=["turn"],
        how="inner",
    )
    return known.select(
        "conv",
        "turn",
        "role",
        "text",
        "copies",
        (~F.col("turn").eqNullSafe(F.col("first"))).alias("later"),
        (stripped == "").alias("blank"),
        (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut"),
    )


_SEGMENT = (
    "conv string, seg long, roles array<string>, texts array<string>, gone binary, cut binary, "
    "blank long, duplicate long, truncated long, illegal long, matrix array<long>, "
    "first string, last string, turn_min long, turn_max long, turns long, turn_first long"
)


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


class _Segment:
    """Messages of one conversation, being gathered."""

    def __init__(self, conv: str):
        self.conv, self.roles, self.texts, self.size = conv, [], [], 0
        self.gone, self.cut = bytearray(), bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns: list[int] = []

    def add(self, turn: int | None, role: str, text: str, blank: bool, again: bool, cut: bool) -> None:
        if self.roles:
            self.illegal += not _legal(self.roles[-1][:1], role[:1])
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)
        self.gone.append(blank or again)
        self.cut.append(not blank and not again and cut)
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += self.cut[-1]
        if turn is not None and self.turns[-1:] != [turn]:
            self.turns.append(turn)

    def full(self) -> bool:
        return len(self.roles) >= SEGMENT_ROWS or self.size >= SEGMENT_BYTES


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _cut_into_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages in order -> segments, numbered in order within the partition."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 36
    now: _Segment | None = None
    done: list[_Segment] = []
    for batch in _slices(batches):
        for row in batch.to_pylist():
            for copy in range(row["copies"]):
                if now is None or now.conv != row["conv"] or now.full():
                    if now is not None:
                        done.append(now)
                    now = _Segment(row["conv"])
                    if len(done) >= ROWS:
                        yield _as_batch(done, number)
                        number += len(done)
                        done = []
                now.add(row["turn"], row["role"], row["text"], row["blank"], row["later"] or copy > 0, row["cut"])
    if now is not None:
        yield _as_batch([*done, now], number)


def _as_batch(segments: list[_Segment], number: int) -> pa.RecordBatch:
    graph = _Graph([s.roles for s in segments], [s.gone for s in segments], [s.cut for s in segments])
    columns = {
        "conv": [s.conv for s in segments],
        "seg": [number + k for k in range(len(segments))],
        "roles": [s.roles for s in segments],
        "texts": [s.texts for s in segments],
        "gone": [bytes(s.gone) for s in segments],
        "cut": [bytes(s.cut) for s in segments],
        **{k: [getattr(s, k) for s in segments] for k in ("blank", "duplicate", "truncated", "illegal")},
        "matrix": graph.matrices().reshape(len(segments), 16).tolist(),
        "first": [s.roles[0][:1] for s in segments],
        "last": [s.roles[-1][:1] for s in segments],
        "turn_min": [min(s.turns, default=None) for s in segments],
        "turn_max": [max(s.turns, default=None) for s in segments],
        "turns": [len(s.turns) for s in segments],
        "turn_first": [s.turns[0] if s.turns else None for s in segments],
    }
    kinds = {"roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()), "gone": pa.binary(), "cut": pa.binary(), "matrix": pa.list_(pa.int64())}
    text = ("conv", "first", "last")
    arrays = [pa.array(v, kinds.get(k) or (pa.string() if k in text else pa.int64())) for k, v in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


class _Graph:
    """Nodes (place, state) of some segments and the edits that lead from them.

    The messages of all segments stand in a row, each segment with one place more for its
    end. Node 4 * place + state.
    """

    def __init__(self, roles: list[list[str]], gone: list[bytes], cut: list[bytes]):
        sizes = np.array([len(r) for r in roles], np.int64)
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        n = int(self.ends[-1]) + 1
        nodes = np.arange(4 * n).reshape(n, 4)
        self.cost, self.to = np.full((n, 4, 4), _NEVER), np.zeros((n, 4, 4), np.int64)
        for a, b, own, gone_, cut_ in zip(self.starts, self.ends, roles, gone, cut, strict=True):
            out = np.frombuffer(gone_, np.uint8)[:, None].astype(bool)
            more = np.frombuffer(cut_, np.uint8)[:, None].astype(np.int64) * TRUNCATED_COST
            after = np.array([_step(r[:1]) for r in own])
            self.cost[a:b, :, KEEP] = np.where(out | (after < 0), _NEVER, more)
            self.cost[a:b, :, REROLE] = np.where(out, _NEVER, more + REROLE_COST)
            self.to[a:b, :, KEEP] = nodes[a + 1 : b + 1, :1] + np.maximum(after, 0)
        inner = np.ones(n, bool)
        inner[self.ends] = False
        self.cost[inner, :, DELETE] = DELETE_COST
        self.cost[inner, :, INSERT] = INSERT_COST
        behind = np.minimum(np.arange(n) + 1, n - 1)
        self.to[:, :, DELETE] = nodes[behind]
        self.to[:, :, REROLE] = nodes[behind, :1] + _NEXT
        self.to[:, :, INSERT] = nodes[:, :1] + _NEXT

    def to_end(self, at_end: np.ndarray) -> np.ndarray:
        """Cheapest cost from each node, given that of each segment's four ends.

        ``at_end``: (segments, 4, vectors). Segments advance together, from their ends.
        """
        n, _, wide = len(self.cost), 4, at_end.shape[2]
        least = np.full((n, 4, wide), _NEVER)
        least[self.ends] = at_end
        flat = least.reshape(4 * n, wide)
        place = self.ends.copy()
        live = np.arange(len(place))
        while True:
            place[live] -= 1
            live = live[place[live] >= self.starts[live]]
            if not len(live):
                return least
            at = place[live]
            best = np.full((len(at), 4, wide), _NEVER)
            for edit in (DELETE, KEEP, REROLE):
                best = np.minimum(best, self.cost[at, :, edit, None] + flat[self.to[at, :, edit]])
            for _ in range(2):  # two insertions in a row can be of use, not three
                best = np.minimum(best, best[:, _NEXT] + INSERT_COST)
            least[at] = np.minimum(best, _NEVER)

    def matrices(self) -> np.ndarray:
        """(segment, from, to): the cheapest cost between a segment's two ends."""
        ends = np.where(np.eye(4, dtype=bool), 0, _NEVER)
        return self.to_end(np.broadcast_to(ends, (len(self.ends), 4, 4)))[self.starts]

    def least_audits(self, at_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(letters, lengths) of the least cheapest path from each of the segments' starts."""
        least = self.to_end(at_end[:, :, None])[:, :, 0].reshape(-1)
        cost, to = self.cost.reshape(-1, 4), self.to.reshape(-1, 4)
        optimal = (cost < _NEVER) & (cost + least[to] == least[:, None]) & (least < _NEVER)[:, None]
        # Arc 0 stands for the end: rank 0, its own successor. The arcs of a node have
        # different letters, so one letter tells which of them goes on.
        arcs = np.flatnonzero(optimal)
        number = np.zeros(optimal.size, np.int64)
        number[arcs] = np.arange(1, len(arcs) + 1)
        number = number.reshape(-1, 4)
        first = number[np.arange(len(number)), optimal.argmax(1)]
        edit = np.append(0, arcs % 4)
        jump = np.append(0, first[to.reshape(-1)[arcs]])
        rank = np.append(0, arcs % 4 + 1)
        length = np.minimum(rank, 1)
        jumps = [jump]
        while (length[jump] > 0).any():
            # The next power of two: by this rank, then by the rank behind the pointer.
            rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)[1]
            length, jump = length + length[jump], jump[jump]
            jumps.append(jump)
        own = number[(4 * self.starts[:, None] + np.arange(4)).reshape(-1)]
        chosen = np.where(own > 0, rank[own], len(rank)).argmin(1)
        start = own[np.arange(len(own)), chosen]
        sizes = length[start]
        step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        arc = np.repeat(start, sizes)
        for k, pointers in enumerate(jumps):
            arc = np.where(step >> k & 1, pointers[arc], arc)
        return LETTERS[edit[arc]], sizes


def _step(initial: str) -> tuple[int, ...]:
    if not initial:
        return (NOTHING, AFTER_S, AFTER_U, AFTER_A)
    return _STEP.get(initial, (-1, -1, -1, -1))


def _costs_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments, last first -> the cost still to come at each one's end, and at its start."""
    conv, vector = None, _AT_END
    for batch in batches:
        matrix = np.array(batch.column("matrix").flatten()).reshape(-1, 4, 4)
        behind = np.empty((batch.num_rows, 4), np.int64)
        for k, own in enumerate(batch.column("conv").to_pylist()):
            if own != conv:
                conv, vector = own, _AT_END
            behind[k] = vector
            vector = np.minimum((matrix[k] + vector).min(1), _NEVER)
        yield pa.RecordBatch.from_arrays(
            [batch.column("seg"), pa.array(behind.tolist(), pa.list_(pa.int64()))], ["seg", "behind"]
        )


def _least_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with the cost behind them -> their least audit from each start state."""
    for part in _slices(batches):
        graph = _Graph(*(part.column(c).to_pylist() for c in ("roles", "gone", "cut")))
        behind = np.array(part.column("behind").to_pylist(), np.int64).reshape(-1, 4)
        letters, sizes = graph.least_audits(behind)
        cuts = np.concatenate(([0], np.cumsum(sizes))).tolist()
        text = letters.tobytes().decode()
        audits = [text[i:j] for i, j in zip(cuts[:-1], cuts[1:])]
        grouped = [audits[i : i + 4] for i in range(0, len(audits), 4)]
        yield pa.RecordBatch.from_arrays([part.column("seg"), pa.array(grouped, pa.list_(pa.string()))], ["seg", "audits"])


class _Repaired:
    """One conversation, its segments added in order."""

    def __init__(self, conv: str):
        self.conv, self.state, self.last = conv, NOTHING, None
        self.audit: list[str] = []
        self.cost = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.turn_min = self.turn_max = None
        self.hash, self.any = hashlib.sha256(), False

    def _write(self, role: str, text: str) -> None:
        self.hash.update(("\n" * self.any + f"{role}:{text}").encode())
        self.any = True

    def add(self, row: dict) -> None:
        for k in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, k, getattr(self, k) + row[k])
        if self.last is not None:
            self.illegal += not _legal(self.last, row["first"])
        self.last = row["last"]
        if row["turn_first"] is not None:
            self.turns += row["turns"] - (row["turn_first"] == self.turn_max)
            self.turn_min = row["turn_min"] if self.turn_min is None else self.turn_min
            self.turn_max = row["turn_max"]
        audit, at = row["audits"][self.state], 0
        self.audit.append(audit)
        for letter in audit:
            if letter == "I":
                self._insert()
                continue
            role, text = row["roles"][at], row["texts"][at]
            if letter == "D":
                self.cost += DELETE_COST
            else:
                self.cost += row["cut"][at] * TRUNCATED_COST
                if letter == "R":
                    self.cost += REROLE_COST
                    self._write(_OPEN_ROLES[self.state], text)
                    self.state = int(_NEXT[self.state])
                else:
                    self._write(role, text)
                    self.state = _step(role[:1])[self.state]
            at += 1

    def _insert(self) -> None:
        self.cost += INSERT_COST
        self._write(_OPEN_ROLES[self.state], "")
        self.state = int(_NEXT[self.state])

    def row(self) -> tuple:
        for _ in _END_AUDIT[self.state]:
            self.audit.append("I")
            self._insert()
        gaps = 0 if self.turn_min is None else self.turn_max - self.turn_min + 1 - self.turns
        return (
            self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
            "".join(self.audit), self.hash.hexdigest(),
        )


_RESULT = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order with their least paths -> one row per conversation."""
    now, rows = None, []

    def batch() -> pa.RecordBatch:
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
        names = [c.split()[0] for c in _RESULT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

    for part in _slices(batches):
        for row in part.to_pylist():
            if now is None or now.conv != row["conv"]:
                if now is not None:
                    rows.append(now.row())
                now = _Repaired(row["conv"])
                if len(rows) >= 4096:
                    yield batch()
                    rows = []
            now.add(row)
    if now is not None:
        rows.append(now.row())
    if rows:
        yield batch()


def repair(messages: DataFrame) -> DataFrame:
    """One row per ``conv`` that has messages: gaps, faults, cost, audit, digest of the repaired.

    messages: conv, turn, role, text and copies, as ``damage`` gives them.
    """
    parts = shuffle_parts(messages)
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    in_order = _faults(messages).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    segments = stored(in_order.mapInArrow(_cut_into_segments, _SEGMENT))
    costs = segments.select("conv", "seg", "matrix").repartition(parts, "conv")
    behind = costs.sortWithinPartitions("conv", F.desc("seg")).mapInArrow(_costs_behind, "seg long, behind array<long>")
    open_ = segments.select("seg", "roles", "gone", "cut").join(behind, "seg")
    paths = open_.mapInArrow(_least_paths, "seg long, audits array<string>")
    known = segments.drop("matrix", "gone").join(paths, "seg").repartition(parts, "conv")
    return known.sortWithinPartitions("conv", "seg").mapInArrow(_repair, _RESULT)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The contract's rows: every id of a table, its messages damaged and then repaired."""
    ids = conversations.groupBy(conversation_key("conv_id").alias("conv")).agg(F.first("conv_id").alias("conv_id"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256().hexdigest()
    return ids.join(repair(damage(conversations)), "conv", "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )

"""Conversation repair by a cheapest path through the edit lattice.

A lattice node is ``(rows consumed, state of the role grammar)``; edges delete,
keep or rerole the next row, or insert a turn. Two heaps, one from the start and
one from the ends, grow until no pair of open nodes can lie on a path as cheap as
the cheapest crossing; all crossings of that cost are finished, and the one whose
audits concatenate to the least text wins.

Rows of a conversation stream in order through one task, in segments of bounded
length. Between segments at most four open ends are held, each with its cost, its
audit and the running digest of its repaired turns, so no conversation has to fit
in memory: only its audit does, which is a cell of the result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm.common import small_batches

#: Cost of each edit, and of leaving a truncated row in.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: Rows of one search.
SEGMENT = 256
#: Fixed value: the grammar ``(s?(ua)+)?`` as states nothing, after s, after u, after a.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: State and role of the one turn of user or assistant that may come next.
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
ROLE = {2: "user", 3: "assistant"}
ENDS = (0, 3)
BEFORE = {q: [p for p in NEXT if NEXT[p] == q] for q in NEXT}
KEPT_FROM = {(q, letter): [p for (p, x), r in STEP.items() if (r, x) == (q, letter)] for q in NEXT for letter in "sua"}

_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_LETTER = re.compile("[^\x20\x09-\x0d]")


def row_class(role: str, text: str, repeated: bool) -> tuple[str, str]:
    """First fault of a row and its letter in a pattern.

    ``x`` must go; else the initial of the role (``o`` for one that the grammar
    doesn't know), in upper case where the text is truncated.
    """
    if not _LETTER.search(text):
        return "blank", "x"
    if repeated:
        return "duplicate", "x"
    letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return ("", letter) if text.rstrip(_SPACE)[-1] in ".!?" else ("truncated", letter.upper())


def _onward(pattern: str, i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges out of a node: ``(rows, state, cost, edit)``."""
    yield i, NEXT[q], INSERT, "I"
    if i < len(pattern):
        yield i + 1, q, DELETE, "D"
        letter = pattern[i]
        if letter != "x":
            extra = TRUNCATED if letter.isupper() else 0
            if (to := STEP.get((q, letter.lower()))) is not None:
                yield i + 1, to, extra, "K"
            yield i + 1, NEXT[q], REROLE + extra, "R"


def _back(pattern: str, i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges into a node, by where they come from."""
    for p in BEFORE[q]:
        yield i, p, INSERT, "I"
    if i:
        yield i - 1, q, DELETE, "D"
        letter = pattern[i - 1]
        if letter != "x":
            extra = TRUNCATED if letter.isupper() else 0
            for p in KEPT_FROM.get((q, letter.lower()), ()):
                yield i - 1, p, extra, "K"
            for p in BEFORE[q]:
                yield i - 1, p, REROLE + extra, "R"


@lru_cache(maxsize=50_000)
def cheapest(pattern: str, start: int = 0, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest way from ``start`` through all rows to one of ``ends``; None where there is none.

    Keeping may cost nothing, but moves on by a row: at one cost, nodes are
    settled in the order of their search's direction, so each has its least
    audit by then. Two ways of one cost to one node are never such that one
    audit begins with the other, since the letters fix the cost.
    """
    if max(ends) < 2 and start > max(ends):
        return None
    n = len(pattern)
    ahead, behind = {(0, start): (0, "")}, {(n, q): (0, "") for q in ends}
    # Cost, rows from the own side, state.
    front, rear = [(0, 0, start)], [(0, 0, q) for q in ends]
    settled: tuple[set, set] = (set(), set())
    best: tuple[int, str] | None = None

    def meet(node: tuple[int, int]) -> None:
        nonlocal best
        if node in ahead and node in behind:
            (a, first), (b, last) = ahead[node], behind[node]
            if best is None or a + b <= best[0]:
                whole = (a + b, first + last)
                best = whole if best is None else min(best, whole)

    while front and rear:
        if best is not None and front[0][0] + rear[0][0] > best[0]:
            break
        forward = front[0][0] <= rear[0][0]
        heap, labels, done = (front, ahead, settled[0]) if forward else (rear, behind, settled[1])
        cost, i, q = heapq.heappop(heap)
        node = (i, q) if forward else (n - i, q)
        if node in done:
            continue
        done.add(node)
        audit = labels[node][1]
        meet(node)
        for j, p, more, edit in _onward(pattern, *node) if forward else _back(pattern, *node):
            label = (cost + more, audit + edit if forward else edit + audit)
            other = (j, p)
            if other not in labels or label < labels[other]:
                labels[other] = label
                heapq.heappush(heap, (label[0], j if forward else n - j, p))
                meet(other)
    return best


def replay(audit: str, rows: list[tuple[str, str]], state: int) -> Iterator[tuple[str, str, str]]:
    """``(edit, role, text)`` of the turns that an audit leaves of some rows, from a state of the grammar."""
    taken = iter(rows)
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield edit, ROLE[state], ""
            continue
        role, text = next(taken)
        if edit == "K":
            state = STEP[state, role[:1]]
            yield edit, role, text
        elif edit == "R":
            state = NEXT[state]
            yield edit, ROLE[state], text


class _Conversation:
    """One conversation as its rows come in."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.turns: tuple[int, int, int] | None = None
        self.initial: str | None = None
        self.pattern: list[str] = []
        self.rows: list[tuple[str, str]] = []
        # Open ends by state: cost, audit, digest so far, whether it has turns yet.
        self.open = {0: (0, "", hashlib.sha256(), False)}

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        if len(self.rows) == SEGMENT:
            self._close((0, 1, 2, 3))
        if turn is not None:
            low, high, kinds = self.turns or (turn, None, 0)
            self.turns = (low, turn, kinds + (turn != high))
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = role[:1]
        fault, letter = row_class(role, text, repeated)
        if fault:
            self.counts[fault] += 1
        self.pattern.append(letter)
        self.rows.append((role, text))

    def _close(self, ends: tuple[int, ...]) -> None:
        """Extends the open ends over the rows held; one end for each state, or one for all at the last."""
        pattern, groups = "".join(self.pattern), [ends] if ends == ENDS else [(q,) for q in ends]
        extended = {}
        for group in groups:
            ways = []
            for q, (cost, audit, digest, any_turn) in self.open.items():
                if (way := cheapest(pattern, q, group)) is not None:
                    ways.append((cost + way[0], audit + way[1], q, way[1], digest, any_turn))
            if ways:
                cost, audit, q, own, digest, any_turn = min(ways, key=lambda w: w[:2])
                digest = digest.copy()
                for _, role, text in replay(own, self.rows, q):
                    digest.update((("\n" if any_turn else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                    any_turn = True
                extended[group[0]] = (cost, audit, digest, any_turn)
        # What follows nothing or s alone can follow a after deleting one s at most, so dearer ends lead nowhere.
        if 3 in extended and ends != ENDS:
            least = extended[3][0]
            extended = {q: e for q, e in extended.items() if q > 1 or e[0] <= least + (DELETE if q == 0 else 0)}
        self.open, self.pattern, self.rows = extended, [], []

    def result(self) -> dict:
        self._close(ENDS)
        cost, audit, digest, _ = self.open[0]
        low, high, kinds = self.turns or (0, -1, 0)
        return {
            "conv_id": self.conv_id, "gaps": high - low + 1 - kinds, **self.counts, "cost": cost, "audit": audit,
            "repaired_sha256": digest.hexdigest(),
        }


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped``: rows damaged by the hash of ``conv_id:turn``; nulls are one space there, in roles and in texts.

    Of 20 remainders 0 drops the row (it stays marked, without role and text),
    1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes its
    role user.
    """
    def spelled(name: str):
        return F.coalesce(rows[name].cast("string"), F.lit(" "))

    act = F.pmod(F.crc32(F.concat(spelled("conv_id"), F.lit(":"), spelled("turn")).cast("binary")), F.lit(20))
    text, role = spelled("text"), spelled("role")
    given = rows.select(rows["conv_id"].alias("conv_id"), rows["turn"].alias("turn"), role.alias("role"), text.alias("text"), act.alias("act"))
    return given.withColumn(
        "copy", F.explode(F.when(F.col("act") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    ).select(
        "conv_id", "turn",
        F.when(F.col("act") == 4, "user").when(F.col("act") != 0, F.col("role")).alias("role"),
        F.when(F.col("act") == 1, "").when(F.col("act") == 2, F.regexp_replace("text", "[.!?]", ""))
        .when(F.col("act") != 0, F.col("text")).alias("text"),
        (F.col("act") == 0).alias("dropped"),
    )


def _in_order(rows: DataFrame, dropped_by: str | None) -> DataFrame:
    """Rows of each conversation in one partition, by turn (nulls first), role and text, repeats marked."""
    small_batches(rows.sparkSession)
    dropped = rows[dropped_by] if dropped_by else F.lit(False)
    given = rows.select(
        rows["conv_id"].alias("conv_id"), rows["turn"].cast("long").alias("turn"), dropped.alias("dropped"),
        *[F.when(~dropped, F.coalesce(rows[c].cast("string"), F.lit(" "))).alias(c) for c in ("role", "text")],
    )
    # Both sorts run on the one exchange.
    seen = Window.partitionBy("conv_id", "role", "text").orderBy("turn")
    marked = given.repartition("conv_id").withColumn("repeated", F.row_number().over(seen) > 1)
    return marked.sortWithinPartitions("conv_id", "turn", "role", "text", "repeated")


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(n).to_pylist() for n in names])


def repair(rows: DataFrame, dropped_by: str | None = None) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``rows`` has ``conv_id, turn, role, text``; ``dropped_by`` names a column that
    is true where a row only tells that its conversation exists. Further columns
    are left out. A null role or text is one space, rows of a null ``conv_id`` are one
    conversation, null turns come first and don't count for gaps; rows of one turn
    follow by role and text. A conversation without rows has zeros, an empty audit
    and the digest of an empty text. An empty table gives no row.
    """
    ordered = _in_order(rows, dropped_by)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([
        T.StructField("conv_id", ordered.schema["conv_id"].dataType), *[T.StructField(c, T.LongType()) for c in counts],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Conversation | None = None
        kind = None

        def batch_of(out: list[dict]) -> pa.RecordBatch:
            types = [kind] + [pa.int64()] * len(counts) + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in zip(schema.names, types)], names=schema.names)

        for batch in batches:
            kind, out = batch.schema.field("conv_id").type, []
            for conv_id, turn, role, text, dropped, repeated in _columns(batch, "conv_id", "turn", "role", "text", "dropped", "repeated"):
                if held is None or conv_id != held.conv_id:
                    if held is not None:
                        out.append(held.result())
                    held = _Conversation(conv_id)
                if not dropped:
                    held.add(turn, role, text, repeated)
            if out:
                yield batch_of(out)
        if held is not None:
            yield batch_of([held.result()])

    return ordered.mapInArrow(repaired, schema)


def repaired_turns(rows: DataFrame, repairs: DataFrame, dropped_by: str | None = None) -> DataFrame:
    """The repaired conversations themselves: ``conv_id, place, edit, role, text``, places from 0 without a gap.

    ``repairs`` has the ``conv_id`` and ``audit`` of :func:`repair` over the same
    rows. Each conversation's audit comes before its rows in the stream, so
    nothing but the audit is held.
    """
    ordered = _in_order(rows, dropped_by).filter(~F.col("dropped"))
    both = ordered.select("conv_id", "turn", "role", "text", F.lit(None).cast("string").alias("audit")).unionByName(
        repairs.select("conv_id", "audit"), allowMissingColumns=True
    )
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "text")
    schema = T.StructType([
        T.StructField("conv_id", ordered.schema["conv_id"].dataType), T.StructField("place", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")],
    ])

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, 0, 0

        def inserted(conv_id) -> Iterator[tuple]:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                state, at = NEXT[state], at + 1
                yield conv_id, place, "I", ROLE[state], ""
                place += 1

        for batch in batches:
            out = []
            for conv_id, role, text, new in _columns(batch, "conv_id", "role", "text", "audit"):
                if new is not None:
                    audit, at, state, place = new, 0, 0, 0
                    out += inserted(conv_id)
                    continue
                for edit, own_role, own_text in replay(audit[at], [(role, text)], state):
                    state = STEP[state, role[:1]] if edit == "K" else NEXT[state]
                    out.append((conv_id, place, edit, own_role, own_text))
                    place += 1
                at += 1
                out += inserted(conv_id)
            if out:
                types = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=schema.names)

    return both.mapInArrow(turns, schema)

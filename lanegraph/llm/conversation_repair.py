"""Repair of conversation structure by the cheapest edits.

A conversation is right when the initials of its roles read ``(s?(ua)+)?``.
The edit lattice of a conversation has a node for every number of rows read
and state of that pattern; its edges are the edits:

    K keep 0 | R rerole to user or assistant 3 | D delete 4 | I insert 3

Blank and duplicate rows have to be deleted; a truncated row that stays adds 3.
Two Dijkstra searches, one from the start and one from the accepted ends, run
until their heads together cost more than the best meeting, so that every
crossing of equal cost has been seen; of the cheapest paths the one with the
ASCII-least string of initials ("audit") wins.

Labels carry (cost, audit).  Two paths of equal cost to one node never have
audits of which one begins the other (the rest would be inserts, which cost),
so the least audit of a node stays least however the path goes on, and long
conversations can be searched in segments of ``SEGMENT`` rows whose labels are
handed on.

Shape of the job: rows are reduced to (turn, role, digest, fault) and brought
together by conversation, in order, in one shuffle; a task streams over them
and keeps two bytes a row of the conversation it is in.  A second shuffle
brings the texts behind their audit, where they are streamed through SHA-256.
A digest of a conversation is one sequential chain, so a conversation is one
stream, but never held as a whole.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches
from .shingles import trimmed

START, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTED = (START, AFTER_A)
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
SEGMENT = 256

#: Spaces of the contract: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"


# ------------------------------------------------------------------ edit lattice

def _spoken(state: int) -> int:
    """State after the next user or assistant row that the pattern allows."""
    return AFTER_A if state == AFTER_U else AFTER_U


def _kept(state: int, initial: str) -> int | None:
    """State after a row kept as it is, None where the pattern forbids it."""
    if initial == "s":
        return AFTER_S if state == START else None
    if initial == "u":
        return None if state == AFTER_U else AFTER_U
    if initial == "a":
        return AFTER_A if state == AFTER_U else None
    return None


def _row_edits(initial: str, fault: int) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, edit) of every edit of a row."""
    out = [(q, q, 4, "D") for q in range(4)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = 3 if fault == TRUNCATED else 0
    for q in range(4):
        to = _kept(q, initial)
        if to is not None:
            out.append((q, to, extra, "K"))
        out.append((q, _spoken(q), 3 + extra, "R"))
    return out


_INSERTS = [(q, _spoken(q), 3, "I") for q in range(4)]
_FROM = {(i, f): [[(b, c, e) for a, b, c, e in _row_edits(i, f) if a == q] for q in range(4)] for i in "suax" for f in range(4)}
_INTO = {(i, f): [[(a, c, e) for a, b, c, e in _row_edits(i, f) if b == q] for q in range(4)] for i in "suax" for f in range(4)}


def meet(rows: list[tuple[str, int]], starts: dict[int, tuple[int, str]], ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cheapest (cost, audit) from the labelled ``starts`` before the first row
    to one of ``ends`` after the last one.

    Heads are ordered by cost, then by rows read: edges without cost always
    read a row, so a node's equal-cost labels are all known when it is settled.
    """
    n = len(rows)
    ahead = {(0, q): label for q, label in starts.items()}
    back = {(n, q): (0, "") for q in ends}
    heap_a = [(c, 0, s, q) for q, (c, s) in starts.items()]
    heap_b = [(0, 0, "", q) for q in ends]
    heapq.heapify(heap_a)
    heapq.heapify(heap_b)
    done_a, done_b = set(), set()
    best = min((ahead[v][0] + back[v][0] for v in ahead if v in back), default=None)
    while heap_a and heap_b and (best is None or heap_a[0][0] + heap_b[0][0] <= best):
        if heap_a[0][0] <= heap_b[0][0]:
            cost, i, audit, q = heapq.heappop(heap_a)
            if (i, q) in done_a:
                continue
            done_a.add((i, q))
            steps = [(i, to, c, e) for a, to, c, e in _INSERTS if a == q]
            if i < n:
                steps += [(i + 1, to, c, e) for to, c, e in _FROM[rows[i]][q]]
            for j, to, c, e in steps:
                label = (cost + c, audit + e)
                if (j, to) not in done_a and ((j, to) not in ahead or label < ahead[j, to]):
                    ahead[j, to] = label
                    heapq.heappush(heap_a, (label[0], j, label[1], to))
                    if (j, to) in back and (best is None or label[0] + back[j, to][0] < best):
                        best = label[0] + back[j, to][0]
        else:
            cost, left, audit, q = heapq.heappop(heap_b)
            i = n - left
            if (i, q) in done_b:
                continue
            done_b.add((i, q))
            steps = [(i, a, c, e) for a, to, c, e in _INSERTS if to == q]
            if i:
                steps += [(i - 1, a, c, e) for a, c, e in _INTO[rows[i - 1]][q]]
            for j, a, c, e in steps:
                label = (cost + c, e + audit)
                if (j, a) not in done_b and ((j, a) not in back or label < back[j, a]):
                    back[j, a] = label
                    heapq.heappush(heap_b, (label[0], n - j, label[1], a))
                    if (j, a) in ahead and (best is None or label[0] + ahead[j, a][0] < best):
                        best = label[0] + ahead[j, a][0]
    return min(((ahead[v][0] + back[v][0], ahead[v][1] + back[v][1]) for v in ahead if v in back), default=None)


def cheapest(initials: str, faults: bytes, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, audit) of a whole conversation.

    Labels are carried from segment to segment; what all of their audits begin
    with is settled and put aside, so labels stay short.
    """
    settled: list[str] = []
    labels = {START: (0, "")}
    n = len(initials)
    for at in range(0, max(n, 1), segment):
        rows = list(zip(initials[at:at + segment], faults[at:at + segment]))
        if at + segment >= n:
            cost, audit = meet(rows, labels, ACCEPTED)
            return cost, "".join(settled) + audit
        found = {q: meet(rows, labels, (q,)) for q in range(4)}
        common = os.path.commonprefix([s for label in found.values() if label for s in label[1:]])
        settled.append(common)
        labels = {q: (label[0], label[1][len(common):]) for q, label in found.items() if label}
    raise AssertionError("a conversation has at least one segment")


# ------------------------------------------------------------------ damage and faults

def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, gone): rows damaged by crc32(``conv_id:turn``) % 20.

    0 drops the row (it stays as a mark, ``gone``), 1 empties its text, 2
    removes its ``.!?``, 3 repeats it, 4 sets its role to user.  Nulls are one
    space in the key, the role and the text; the turn itself stays null.
    """
    c = conversations
    key = F.concat(F.coalesce(c[conv_col].cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(c[turn_col].cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = (F.coalesce(c[x].cast("string"), F.lit(" ")) for x in (role_col, text_col))
    return c.select(
        c[conv_col].alias("conv_id"), F.when(kind != 0, c[turn_col].cast("long")).alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def as_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, gone) without damage; null roles and texts are one space."""
    c = conversations
    return c.select(c[conv_col].alias("conv_id"), c[turn_col].cast("long").alias("turn"),
                    *(F.coalesce(c[x].cast("string"), F.lit(" ")).alias(y) for x, y in ((role_col, "role"), (text_col, "text"))),
                    F.lit(False).alias("gone"))


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("x")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the digest by which equal texts and ties are told."""
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _order(*first):
    return [*first, F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("digest").asc_nulls_first()]


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _audits(batches: Iterator[pa.RecordBatch], kind: pa.DataType, segment: int) -> Iterator[pa.RecordBatch]:
    """A report per conversation from its rows in order."""
    memo: dict = {}
    at, open_ = None, False

    def close() -> tuple:
        ini, fault = initials.decode(), bytes(faults)
        key = (ini, fault)
        if key not in memo:
            found = cheapest(ini, fault, segment)
            if len(ini) > 64 or len(memo) >= 20_000:
                return at, found
            memo[key] = found
        return at, memo[key]

    def report() -> dict:
        conv, (cost, audit) = close()
        ini = initials.decode()
        gaps = (high - low + 1 - turns) if turns else 0
        return {"conv_id": conv, "gaps": (gaps + (1 << 63)) % (1 << 64) - (1 << 63), "blank": faults.count(BLANK),
                "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
                "illegal": max(0, len(ini) - 1) - sum(a + b in ("su", "ua", "au") for a, b in zip(ini, ini[1:])),
                "cost": cost, "audit": audit}

    schema = pa.schema([("conv_id", kind), *((c, pa.int64()) for c in REPORT), ("audit", pa.string())])
    for batch in batches:
        out = []
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "copies")]
        for conv, turn, initial, fault, copies in zip(*cols):
            if not open_ or conv != at:
                if open_:
                    out.append(report())
                at, open_, initials, faults = conv, True, bytearray(), bytearray()
                low = high = last = None
                turns = 0
            if not copies:                                   # all of these rows were dropped
                continue
            if turn is not None:
                low = turn if low is None else low
                turns += turn != last
                high = last = turn
            initials += initial.encode() * copies
            faults.append(fault)
            faults += bytes([BLANK if fault == BLANK else DUPLICATE]) * (copies - 1)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if open_:
        yield pa.RecordBatch.from_pylist([report()], schema)


def audits(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit per
    conversation of ``rows`` (conv_id, turn, role, text, gone).

    Rows go by turn, null turns first; of equal turns by role, then by the
    SHA-256 of the text, so equal rows are neighbours.
    """
    small_batches(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType
    body = F.translate("text", SPACES, "")
    last = F.right(body, F.lit(1))
    fault = F.when(F.length(body) == 0, BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    live = ~F.col("gone")
    slim = (_keyed(rows).select("conv_id", *(F.when(live, F.col(c)).alias(c) for c in ("turn", "role", "digest")),
                                F.when(live, fault).alias("fault"), live.cast("long").alias("live"))
            .repartition("conv_id")
            .groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("live").alias("copies")))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())) > 1
    slim = (slim.withColumn("fault", F.when(again & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault")))
            .withColumn("initial", _initial(F.col("role")))
            .sortWithinPartitions(*_order("conv_id"))
            .select("conv_id", "turn", "initial", "fault", "copies"))

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        yield from _audits(_chain(first, batches), first.schema.field("conv_id").type, segment)
    return slim.mapInArrow(trimmed(run), f"conv_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in REPORT) + ", audit string")


def _chain(first, rest):
    yield first
    yield from rest


# ------------------------------------------------------------------ repaired rows

def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list, Iterator]]:
    """(conv_id, report, edits) per conversation; edits yields (edit, role,
    text) of the repaired rows and has to be read before the next one."""
    cols = ["conv_id", *REPORT, "audit", "role", "text"]

    def flat():
        for b in batches:
            yield from zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in cols))

    stream = flat()
    head = next(stream, None)
    while head is not None:
        conv, audit = head[0], head[1 + len(REPORT)]
        behind: list = []

        def rows(audit=audit, behind=behind):
            said = sum(e != "D" for e in audit)
            due = "user"
            for e in audit:
                role = text = None
                if e != "I":
                    *_, role, text = next(stream)
                if e == "D":
                    continue
                if said % 2:                                  # an odd number begins with the system's row
                    said += 1
                    yield e, role, text
                    continue
                yield e, role if e == "K" else due, "" if e == "I" else text
                due = "assistant" if due == "user" else "user"
        yield conv, list(head[1:2 + len(REPORT)]), rows()
        head = next(stream, None)


def _behind_audits(rows: DataFrame, segment: int) -> DataFrame:
    """Audits and live rows, every conversation's audit first and its rows in order."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    reports = audits(rows, segment).select("conv_id", *REPORT, "audit", F.lit(0).alias("place"), F.lit(None).cast("long").alias("turn"),
                                           *(F.lit(None).cast("string").alias(c) for c in ("role", "text")),
                                           F.lit(None).cast("binary").alias("digest"))
    texts = _keyed(rows.where(~F.col("gone"))).select(
        F.col("conv_id").cast(kind), *(F.lit(None).cast("long").alias(c) for c in REPORT), F.lit(None).cast("string").alias("audit"),
        F.lit(1).alias("place"), "turn", "role", "text", "digest")
    return (reports.unionByName(texts).repartition("conv_id").sortWithinPartitions(*_order("conv_id", "place"))
            .select("conv_id", *REPORT, "audit", "role", "text"))


def reports(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``audits`` with repaired_sha256: SHA-256 of the repaired ``role:text``
    rows, joined by line feeds.

    A conversation without live rows has zeros, an empty audit and the digest
    of the empty string; an empty table gives no rows.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([first.schema.field("conv_id"), *((c, pa.int64()) for c in REPORT), ("audit", pa.string()),
                            ("repaired_sha256", pa.string())])
        out = []
        for conv, report, edits in _repaired(_chain(first, batches)):
            digest, joint = hashlib.sha256(), b""
            for _, role, text in edits:
                digest.update(joint + f"{role}:".encode())
                digest.update(text.encode())
                joint = b"\n"
            out.append(dict(zip(schema.names, [conv, *report, digest.hexdigest()])))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return _behind_audits(rows, segment).mapInArrow(
        trimmed(run), f"conv_id {kind}, " + ", ".join(f"{c} long" for c in REPORT) + ", audit string, repaired_sha256 string")


def repaired(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit, role, text."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([first.schema.field("conv_id"), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                            ("text", pa.string())])
        out, held = [], 0
        for conv, _, edits in _repaired(_chain(first, batches)):
            for place, (edit, role, text) in enumerate(edits):
                out.append(dict(zip(schema.names, [conv, place, edit, role, text])))
                held += len(text) + 50
                if held > 1 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return _behind_audits(rows, segment).mapInArrow(trimmed(run), f"conv_id {kind}, place long, edit string, role string, text string")

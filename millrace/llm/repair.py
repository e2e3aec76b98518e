"""Conversations brought into the order system, user, assistant, ... by the cheapest edits.

Rows are dealt out by conversation and sorted, the last turn first, so that a conversation passes
through its task as a stream. For each row and each state of the order that may precede it, the
cost of the rest is known when the row arrives; its edit for each of the four states is kept in
two bits. When the first turn has passed, the edits are read back from the first turn on. Rows
wait for that in memory, and beyond a bound in a scratch file of the task; costs are kept as
differences only. So one conversation may have any number of rows, and a lost task runs again.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import prepare

# Costs of the edits, initials of the roles in order.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
EDITS = "DIKR"
#: Characters of one conversation that wait in memory, rows in a batch that is given out.
WAITING, GIVEN = 8 << 20, 512

# States: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_ASSISTANT, "u"): _USER, (_USER, "a"): _ASSISTANT}
#: Where an inserted or renamed row leads to, and its role.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
#: What is left to pay after the last row, from each state.
_END = (0, 2 * INSERT, INSERT, 0)
_LEGAL = {"su", "ua", "au"}


def _step(rest: tuple[int, ...], initial: str, fault: str | None) -> tuple[tuple[int, ...], int]:
    """Costs before a row from those behind it, and its edits: two bits for each state."""
    best = []
    for state in range(4):
        options = [(DELETE + rest[state], "D")]
        if fault not in ("blank", "duplicate"):
            extra = TRUNCATED if fault == "truncated" else 0
            if (state, initial) in _AFTER:
                options.append((extra + rest[_AFTER[state, initial]], "K"))
            options.append((extra + REROLE + rest[_NEXT[state]], "R"))
        best.append(min(options))
    # equal costs differ in their first letter, so the smaller letter makes the smaller list of edits
    for state in (_USER, _ASSISTANT, _START, _SYSTEM):
        cost, _ = best[_NEXT[state]]
        best[state] = min(best[state], (cost + INSERT, "I"))
    return tuple(c for c, _ in best), sum(EDITS.index(e) << 2 * state for state, (_, e) in enumerate(best))


class _Waiting:
    """Chunks of one conversation, given back from the last one on."""

    def __init__(self, limit: int):
        self.limit, self.size, self.rows, self.file, self.starts = limit, 0, [], None, []

    def add(self, row: tuple, size: int) -> None:
        self.rows.append(row)
        self.size += size + 64
        if self.size > self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            self.starts.append(self.file.tell())
            pickle.dump(self.rows, self.file, pickle.HIGHEST_PROTOCOL)
            self.size, self.rows = 0, []

    def reversed(self) -> Iterator[tuple]:
        yield from reversed(self.rows)
        for start in reversed(self.starts):
            self.file.seek(start)
            yield from reversed(pickle.load(self.file))

    def close(self) -> None:
        if self.file:
            self.file.close()


class _Conversation:
    """One conversation on its way through a task, from its last row to its first."""

    def __init__(self, name: str | None, steps: dict, limit: int):
        self.name, self.steps, self.rest, self.waiting = name, steps, _END, _Waiting(limit)

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        initial = role[:1]
        least = min(self.rest)
        key = (tuple(c - least for c in self.rest), initial if initial in "sua" else "", fault)
        if key not in self.steps:
            self.steps[key] = _step(*key)
        self.rest, edits = self.steps[key]
        self.waiting.add((turn, role, text, fault, edits), len(text) + len(role))

    def edits(self) -> Iterator[tuple]:
        """``edit, turn, role, text, fault, cost, illegal`` of each edit, from the first row on."""
        state, before = _START, None
        for turn, role, text, fault, edits in self.waiting.reversed():
            illegal = before is not None and before + role[:1] not in _LEGAL
            before = role[:1]
            while True:
                edit = EDITS[edits >> 2 * state & 3]
                if edit != "I":
                    break
                state = _NEXT[state]
                yield edit, None, _ROLE[state], "", None, INSERT, False
            extra = TRUNCATED if fault == "truncated" and edit != "D" else 0
            if edit == "D":
                cost = DELETE
            elif edit == "R":
                state, cost = _NEXT[state], REROLE + extra
                role = _ROLE[state]
            else:
                state, cost = _AFTER[state, role[:1]], extra
            yield edit, turn, role, text, fault, cost, illegal
        while state in (_SYSTEM, _USER):
            state = _NEXT[state]
            yield "I", None, _ROLE[state], "", None, INSERT, False
        self.waiting.close()


def faults(text: Column, seen: Column) -> Column:
    """``blank``, ``duplicate`` or ``truncated``, the first that holds; null for a sound row."""
    last = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return F.when(last == "", "blank").when(seen, "duplicate").when(~last.isin(".", "!", "?"), "truncated")


def edits(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None, waiting: int = WAITING) -> DataFrame:
    """``conv, at, edit, turn, role, text, fault, cost, illegal``: all edits of each conversation, in order.

    Without its deleted rows (``edit = 'D'``) this is the repaired conversation; the letters of
    ``edit`` are its audit. Each edit is ``K``eep, ``R``erole, ``D``elete or ``I``nsert, and the
    cheapest list of them is taken, of equal ones the least in ASCII. ``fault`` is what was wrong
    with the row, ``illegal`` says that its role may not follow that of the row before.

    Rows go by turn, null turns first; those of one turn by role, text. Null roles and texts are
    one space. Roles count by their first letter; a role without one is never kept. ``conv`` is the
    conversation as text; rows without one are a conversation of their own. A conversation none of
    whose rows is ``present`` gives one row, whose edit is null. An empty table gives an empty
    result; other columns are left out.
    """
    prepare(df.sparkSession)
    space, here = F.lit(" "), F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = df.select(
        F.col(conv_col).cast("string").alias("conv"),
        here.alias("here"),
        F.when(here, F.col(turn_col).cast("long")).alias("turn"),
        F.when(here, F.coalesce(F.col(role_col), space)).otherwise("").alias("role"),
        F.when(here, F.coalesce(F.col(text_col), space)).otherwise("").alias("text"),
    ).repartition("conv")
    equal = Window.partitionBy("conv", "here", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.select("*", F.row_number().over(equal).alias("time"))
    rows = rows.select("conv", "here", F.col("turn").isNotNull().alias("placed"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", "time", faults(F.col("text"), F.col("time") > 1).alias("fault"))
    order = [F.desc(c) for c in ("conv", "here", "placed", "turn", "role", "text", "time")]
    steps: dict = {}

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv", "at", "edit", "turn", "role", "text", "fault", "cost", "illegal"]
        now, out, size = None, [], 0

        def given() -> pd.DataFrame:
            frame = pd.DataFrame(out, columns=names, dtype=object)
            out.clear()
            return frame

        def finished(conversation: _Conversation) -> Iterator[pd.DataFrame]:
            nonlocal size
            at = -1
            for at, edit in enumerate(conversation.edits()):
                out.append((conversation.name, at, *edit))
                size += len(edit[3])
                if len(out) >= GIVEN or size > waiting:
                    size = 0
                    yield given()
            if at < 0:
                out.append((conversation.name, 0, None, None, None, None, None, 0, False))

        for batch in batches:
            for conv, here, placed, turn, role, text, fault in zip(batch.conv, batch.here, batch.placed, batch.turn, batch.role, batch.text, batch.fault, strict=True):
                conv, fault = (None if v is None or v != v else v for v in (conv, fault))
                if now is None or now.name != conv:
                    if now is not None:
                        yield from finished(now)
                    now = _Conversation(conv, steps, waiting)
                if here:
                    now.add(int(turn) if placed else None, role, text, fault)
        if now is not None:
            yield from finished(now)
        if out:
            yield given()

    schema = "conv string, at long, edit string, turn long, role string, text string, fault string, cost long, illegal boolean"
    return rows.sortWithinPartitions(*order).drop("time").mapInPandas(stream, schema)


def digests(found: DataFrame) -> DataFrame:
    """One row a conversation of what ``edits`` returned, which lists each conversation in one piece.

    ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.
    """

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, count, out = None, None, []

        def started(conv: str | None) -> dict:
            return {"conv": conv, "turns": 0, "low": None, "high": None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "kept": 0}

        def row(c: dict) -> tuple:
            gaps = c["high"] - c["low"] + 1 - c["turns"] if c["turns"] else 0
            return (c["conv"], gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], c["cost"], "".join(c["audit"]), c["sha"].hexdigest())

        names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        for batch in batches:
            for conv, at, edit, turn, role, text, fault, cost, illegal in zip(batch.conv, batch["at"], batch.edit, batch.turn, batch.role, batch.text, batch.fault, batch.cost, batch.illegal, strict=True):
                if at == 0:
                    if count is not None:
                        out.append(row(count))
                    count = started(None if conv is None or conv != conv else conv)
                if edit is None or edit != edit:
                    continue
                count["audit"].append(edit)
                count["cost"] += int(cost)
                count["illegal"] += bool(illegal)
                if fault in ("blank", "duplicate", "truncated"):
                    count[fault] += 1
                if turn is not None and turn == turn:
                    turn = int(turn)
                    if count["high"] != turn:
                        count["turns"] += 1
                    count["low"] = turn if count["low"] is None else count["low"]
                    count["high"] = turn
                if edit != "D":
                    count["sha"].update((("\n" if count["kept"] else "") + role + ":" + text).encode())
                    count["kept"] += 1
            if out:
                yield pd.DataFrame(out, columns=names)
                out.clear()
        if count is not None:
            yield pd.DataFrame([row(count)], columns=names)

    # as text: pandas makes floating numbers of whole ones beside nulls
    found = found.withColumn("turn", F.col("turn").cast("string"))
    return found.mapInPandas(stream, "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, present``: rows with faults planted by crc32 of ``conversation:turn``, modulo 20.

    0 drops the row (it stays, not ``present``), 1 empties its text, 2 takes its ``.!?`` away, 3
    repeats it, 4 makes its role user. Nulls, in the hashed text too, are one space; null
    conversations and turns stay null.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    rows = df.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"), (F.crc32(name) % 20).alias("fault")
    )
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") != 0).alias("present"), F.explode(times).alias("_")).drop("_")


def repair_digests(df: DataFrame) -> DataFrame:
    """The damaged conversations of ``df``, repaired: one row for each ``conv_id`` of ``df``."""
    kind = df.schema["conv_id"].dataType
    found = digests(edits(damaged(df), present=F.col("present")))
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *[c for c in found.columns if c != "conv"])

"""Repair of conversation structure: weighted CYK interval parsing.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.
The cheapest edits that make it so are found by parsing the rows with a repair
grammar in Chomsky normal form.  Its symbols are <p q>, "these rows, after their
edits, lead from state p to state q", over the states nothing, system, user
and assistant:

- a symbol derives one row by keeping it, giving it another role or deleting it;
- <p q> derives nothing at the cost of inserted turns (the insertion closure);
- <p q> -> <p r> <r q> joins two adjacent spans.

A span's cell holds for each symbol the least (cost, audit), where the audit is
the edits' initials.  Two audits of one symbol, span and cost are never prefixes
of each other (the longer one would pay for an insert more), so the least is
kept under joining.  As these symbols are closed under joining, every split of a
span gives the same cell.  Cells are therefore joined bottom-up by span length,
two halves a span, instead of over all splits.

On Spark, repeated rows are counted before anything else, and rows are dealt by
ranges of (conversation, turn, role, text), so that a long conversation spreads
over many tasks.  A task parses the spans it holds.  Conversations that lie
inside one span are finished there; the others' cells (no texts) meet by
conversation, are joined in the same way, and hand every span its edits.  The
digest of a repaired conversation is taken while its spans stream past.

Defined results: a null role or text is one space; rows with equal turns are
ordered by role and text, null turns come first; a null conversation id is a
conversation; an empty role has no initial and cannot be kept; an empty table
gives an empty result; other columns are ignored, whatever their names.  One
conversation's audit has to fit one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from zoneflow.session import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
WHITE = " \t\n\x0b\x0c\r"
SPAN_ROWS, SPAN_CHARS = 512, 1 << 20

# a cell: for each state p the entries (q, cost, audit)
Cell = tuple[tuple[tuple[int, int, str], ...], ...]


def turn_after(state: int) -> int:
    """The state that a user or assistant turn leads to, if it is to fit after ``state``."""
    return ASSISTANT if state == USER else USER


def _least(entries: list[tuple[int, int, int, str]]) -> Cell:
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for p, q, cost, audit in entries:
        if (p, q) not in best or (cost, audit) < best[p, q]:
            best[p, q] = (cost, audit)
    return tuple(tuple((q, *best[p, q]) for q in range(4) if (p, q) in best) for p in range(4))


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans."""
    return _least([(p, q, c + d, a + b) for p in range(4) for r, c, a in left[p] for q, d, b in right[r]])


def _closure() -> Cell:
    one = _least([(p, p, 0, "") for p in range(4)] + [(p, turn_after(p), INSERT, "I") for p in range(4)])
    while (two := join(one, one)) != one:
        one = two
    return one


CLOSURE = _closure()


@lru_cache(maxsize=64)
def row_cell(code: str) -> Cell:
    """The cell of one row: ``d`` has to go; else its initial (``o``: any other), as a capital if the row is truncated."""
    entries = [(p, p, DELETE, "D") for p in range(4)]
    if code != "d":
        extra = TRUNCATED if code.isupper() else 0
        initial = code.lower()
        for p in range(4):
            q = turn_after(p)
            entries.append((p, q, REROLE + extra, "R"))
            if initial == "ua"[q - USER]:
                entries.append((p, q, KEEP + extra, "K"))
        if initial == "s":
            entries.append((NOTHING, SYSTEM, KEEP + extra, "K"))
    return join(_least(entries), CLOSURE)


@lru_cache(maxsize=1 << 15)
def _short(codes: str) -> Cell:
    half = len(codes) // 2
    return join(_short(codes[:half]), _short(codes[half:])) if half else row_cell(codes)


def levels(cells: list[Cell]) -> list[list[Cell]]:
    """Cells of spans of 1, 2, 4, ... of the given ones; the last level has the whole."""
    out = [cells]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([join(*below[i : i + 2]) if i + 1 < len(below) else below[i] for i in range(0, len(below), 2)])
    return out


def span_cell(codes: str) -> Cell:
    """The cell of a span of rows."""
    return levels([_short(codes[i : i + 8]) for i in range(0, len(codes), 8)])[-1][0]


def accepted(cell: Cell) -> tuple[int, int, str]:
    """(end state, cost, audit) of the cheapest repair of a whole conversation, with inserts before its first row."""
    ends = join(CLOSURE, cell)[NOTHING]
    cost, audit, end = min((cost, audit, q) for q, cost, audit in ends if q in (NOTHING, ASSISTANT))
    return end, cost, audit


def spans_of_repair(cells: list[Cell]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of the cheapest repair, and each span's first state and audit."""
    tree = levels([join(CLOSURE, cells[0]), *cells[1:]])
    cost, audit, end = min((c, a, q) for q, c, a in tree[-1][0][NOTHING] if q in (NOTHING, ASSISTANT))
    wanted = [(NOTHING, end, cost, audit)]
    for level in reversed(tree[:-1]):
        below = []
        for i, (p, q, cost_of, text) in enumerate(wanted):
            if 2 * i + 1 == len(level):
                below.append((p, q, cost_of, text))
                continue
            a, b = level[2 * i], level[2 * i + 1]
            # the same choice as in join(): the audit names it
            r, c, x = next((r, c, x) for r, c, x in a[p] if text.startswith(x) and (q, cost_of - c, text[len(x) :]) in b[r])
            below += [(p, r, c, x), (r, q, cost_of - c, text[len(x) :])]
        wanted = below
    return cost, [(p, text) for p, _, _, text in wanted]


def replay(state: int, audit: str, rows: list[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) of a span whose edits are ``audit``."""
    given = iter(rows)
    for edit in audit:
        role, text = (None, "") if edit == "I" else next(given)
        if edit == "D":
            continue
        if edit == "K" and role[:1] == "s":
            state = SYSTEM
        else:
            state = turn_after(state)
            role = role if edit == "K" else ("user", "assistant")[state - USER]
        yield role, text


def _as_column(cell: Cell) -> list[dict]:
    return [{"p": p, "q": q, "cost": c, "audit": a} for p in range(4) for q, c, a in cell[p]]


def _as_cell(column: list[dict]) -> Cell:
    return _least([(e["p"], e["q"], e["cost"], e["audit"]) for e in column])


COUNTS = ("blank", "duplicate", "truncated", "illegal")


def equal_rows(code: str, copies: int) -> Iterator[tuple[str, int]]:
    """A row that occurs several times, as (code, rows) steps: all but the first repeat it."""
    if copies and code != "d":
        yield code, 1
        copies -= 1
    while copies:
        yield "d", min(copies, SPAN_ROWS)
        copies -= min(copies, SPAN_ROWS)


class Span:
    """Consecutive rows of a conversation, and what is counted in them."""

    def __init__(self, conv):
        self.conv, self.rows, self.codes, self.chars = conv, [], [], 0
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first = self.last = None
        self.turns, self.low, self.high = 0, None, None

    def add(self, turn, role: str, text: str, code: str, blank: bool, copies: int) -> None:
        """Appends equal rows; more than one at a time only if they have to go (code ``d``)."""
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.counts["illegal"] += copies - 1
        self.last = initial
        self.codes.append(code * copies)
        if code == "d":  # nothing of such rows is needed any more
            self.counts["blank" if blank else "duplicate"] += copies
            self.rows += [("", "")] * copies
        else:
            self.counts["truncated"] += code.isupper()
            self.rows.append((role, text))
            self.chars += len(role) + len(text)
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def record(self, part: int, number: int, closed: bool) -> dict:
        codes = "".join(self.codes)
        out = {"part": part, "no": number, "conv": self.conv, "rows": [{"role": r, "text": t} for r, t in self.rows], "first": self.first, "last": self.last, "turns": self.turns, "low": self.low, "high": self.high}
        out |= self.counts
        cell = span_cell(codes) if codes else CLOSURE
        if closed:
            _, cost, audit = accepted(cell)
            return out | {"cost": cost, "audit": audit, "state": NOTHING, "slice": audit, "cell": None}
        return out | {"cost": None, "audit": None, "state": None, "slice": None, "cell": _as_column(cell)}


def join_counts(spans: list[dict]) -> dict:
    """Counts of a conversation from those of its spans, in order."""
    total = {c: sum(s[c] for s in spans) for c in COUNTS} | {"turns": 0, "low": None, "high": None}
    last = None
    for s in spans:
        if s["first"] is not None:
            if last is not None and last + s["first"] not in ("su", "ua", "au"):
                total["illegal"] += 1
            last = s["last"]
        if s["low"] is not None:
            total["turns"] += s["turns"] - (total["high"] == s["low"])
            total["low"] = s["low"] if total["low"] is None else total["low"]
            total["high"] = s["high"]
    return total


_STATS = "turns long, low long, high long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_CELL = "cell array<struct<p: int, q: int, cost: long, audit: string>>"


def judged(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text and copies with code and blank: each distinct row once, and what is wrong with it."""
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumn("digest", F.sha2("text", 256)).withColumn("end", F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1))
    present = rows.where("copies > 0")
    # texts that a role says in several turns; the turn of the first
    firsts = present.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select(F.col("conv").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest"), "first")
    same = F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    rows = rows.join(firsts, same, "left")
    blank = F.col("end") == ""
    repeated = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(blank | repeated, "d").when(F.col("end").isin(".", "!", "?"), initial).otherwise(F.upper(initial))
    return rows.select("conv", "turn", "role", "text", "copies", code.alias("code"), blank.alias("blank"))


def spans(rows: DataFrame) -> DataFrame:
    """Spans of the conversations in ``rows`` (conv, turn, role, text, copies), written to the shared folder; those that hold a whole conversation are repaired."""
    key = ["conv", "turn", "role", "text"]
    dealt = judged(rows).repartitionByRange(*key).sortWithinPartitions(*key)
    id_type = rows.schema["conv"].dataType.simpleString()
    schema = f"part int, no long, conv {id_type}, rows array<struct<role: string, text: string>>, first string, last string, {_STATS}, state int, slice string, {_CELL}"

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, span, out = TaskContext.get().partitionId(), 0, None, []
        begins, opening = True, True  # whether the span begins its conversation here, and the task
        held = 0
        for batch in batches:
            for conv, turn, role, text, copies, code, blank in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "copies", "code", "blank")), strict=True):
                if span is not None and conv != span.conv:
                    out.append(span.record(part, number, closed=begins and not opening))
                    held, number, span, begins, opening = held + span.chars, number + 1, None, True, False
                span = span or Span(conv)
                for code_of, n in equal_rows(code, copies):
                    if span.rows and (len(span.rows) + n > SPAN_ROWS or span.chars + len(text) > SPAN_CHARS):
                        out.append(span.record(part, number, closed=False))
                        held, number, span, begins = held + span.chars, number + 1, Span(conv), False
                    span.add(turn, role, text, code_of, blank, n)
                if held > 4 << 20 or len(out) > 2000:
                    yield _batch(out, arrow)
                    out, held = [], 0
        if span is not None:
            out.append(span.record(part, number, closed=False))  # it may go on in the next task
        if out:
            yield _batch(out, arrow)

    arrow = _arrow(rows, schema)
    return materialize(rows.sparkSession, dealt.mapInArrow(parsed, schema), "repair-spans")


def _arrow(frame: DataFrame, schema: str) -> pa.Schema:
    return to_arrow_schema(frame.sparkSession.createDataFrame([], schema).schema)


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def repaired_spans(rows: DataFrame) -> DataFrame:
    """Every span with its first state and its edits (slice); a conversation's counts, cost and audit stand in its first span."""
    found = spans(rows)
    schema = f"part int, no long, {_STATS}, state int, slice string"
    arrow = _arrow(rows, schema)
    parts = found.where("cell is not null")

    def joined(group: pa.Table) -> pa.Table:
        held = sorted(group.to_pylist(), key=lambda r: (r["part"], r["no"]))
        cost, edits = spans_of_repair([_as_cell(r["cell"]) for r in held])
        out = [{"part": r["part"], "no": r["no"], "state": state, "slice": text} for r, (state, text) in zip(held, edits, strict=True)]
        out[0] |= join_counts(held) | {"cost": cost, "audit": "".join(text for _, text in edits)}
        return pa.Table.from_pylist(out, arrow)

    edits = parts.drop("rows").groupBy("conv").applyInArrow(joined, schema)
    opened = parts.select("part", "no", "conv", "rows").join(edits, ["part", "no"])
    columns = ["conv", "part", "no", "rows", *(c.split()[0] for c in _STATS.split(", ")), "state", "slice"]
    # spans of one conversation stream past one task in order
    opened = opened.select(*columns).repartition("conv").sortWithinPartitions("conv", "part", "no")
    closed = found.where("cell is null").select(*columns)
    return closed.unionByName(opened)


def repaired_turns(edited: DataFrame) -> DataFrame:
    """conv, part, no, place, role and text of the repaired conversations' turns; (part, no, place) is their order."""
    id_type = edited.schema["conv"].dataType.simpleString()
    schema = f"conv {id_type}, part int, no long, place int, role string, text string"
    arrow = _arrow(edited, schema)

    def replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                turns = replay(r["state"], r["slice"], [(x["role"], x["text"]) for x in r["rows"]])
                yield _batch([{"conv": r["conv"], "part": r["part"], "no": r["no"], "place": i, "role": role, "text": text} for i, (role, text) in enumerate(turns)], arrow)

    return edited.mapInArrow(replayed, schema)


def digests(edited: DataFrame) -> DataFrame:
    """One row a conversation: conv, its counts, cost, audit, and the SHA-256 of its repaired ``role:text`` lines."""
    id_type = edited.schema["conv"].dataType.simpleString()
    schema = f"conv {id_type}, {_STATS}, repaired_sha256 string"
    arrow = _arrow(edited, schema)
    names = [c.split()[0] for c in _STATS.split(", ")]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats, digest, lines, out = None, None, 0, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["audit"] is not None:  # the first span of a conversation
                    if stats is not None:
                        out.append(stats | {"repaired_sha256": digest.hexdigest()})
                    stats, digest, lines = {"conv": r["conv"], **{c: r[c] for c in names}}, hashlib.sha256(), 0
                for role, text in replay(r["state"], r["slice"], [(x["role"], x["text"]) for x in r["rows"]]):
                    digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            if out:
                yield _batch(out, arrow)
                out = []
        if stats is not None:
            yield _batch([stats | {"repaired_sha256": digest.hexdigest()}], arrow)

    return edited.mapInArrow(hashed, schema)


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text and copies after damage by crc32(``conv:turn``) mod 20: 0 drops a row (no copies), 1 empties its
    text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes it the user's."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(or_space(conv), F.lit(":"), or_space(turn)).cast("binary")) % 20
    said: Column = F.when(hit <= 1, "").when(hit == 2, F.translate(or_space(text), ".!?", "")).otherwise(or_space(text))
    by: Column = F.when(hit == 0, "").when(hit == 4, "user").otherwise(or_space(role))
    copies = F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).cast("long")
    return turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), by.alias("role"), said.alias("text"), copies.alias("copies"))


def repair(rows: DataFrame) -> DataFrame:
    """One row a conversation of ``rows`` (conv, turn, role, text, copies): gaps, the rows' faults, cost, audit and digest of the repair.

    A row without copies counts for nothing but the existence of its conversation.
    """
    out = digests(repaired_spans(rows))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    return out.select("conv", gaps, *COUNTS, "cost", "audit", "repaired_sha256")

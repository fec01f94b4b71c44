"""Repair of conversation structure: the cheapest edits that make roles alternate, by a dynamic program that streams over each conversation."""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import written

#: Costs of the edits; a truncated row that stays costs TRUNCATED more.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Letters of the edits in ASCII order, which settles ties: Delete, Insert, Keep, Rerole.
EDITS = "DIKR"
#: Places of the pattern (s?(ua)+)?: nothing yet, after s, after u, after a. By place: what a rerole or an insert says, and where it leads.
SAYS, NEXT = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
#: Where keeping a role with this initial leads (initials: 0 s, 1 u, 2 a, 3 other); other pairs are not allowed.
KEEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
#: Costs from each place when no rows are left: only "nothing yet" and "after a" may end.
END = (0, 2 * INSERT, INSERT, 0)
#: First faults of a row.
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: Back pointers of a conversation that stay in memory (two bytes each); more go to an anonymous file of the task.
SPILL_ROWS = 1 << 20
REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_REPORT_NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
_BATCH = 4096
_STEPS: dict[tuple, tuple] = {}


def _step(after: tuple[int, ...], kind: int) -> tuple[tuple[int, ...], int, int]:
    """Costs before a row from the costs after it, less their minimum; that minimum; and the letter to take at each place, two bits each.

    ``kind`` is 4 * first fault + initial. Costs are kept as differences, which are small, so few steps differ and all are remembered.
    """
    if (after, kind) not in _STEPS:
        fault, initial = divmod(kind, 4)
        moves = []
        for place in range(4):
            options = {"D": DELETE + after[place]}
            if fault in (SOUND, CUT):
                extra = TRUNCATED if fault == CUT else 0
                options["R"] = REROLE + extra + after[NEXT[place]]
                if (place, initial) in KEEP:
                    options["K"] = extra + after[KEEP[place, initial]]
            moves.append(options)
        base = [min(m.values()) for m in moves]
        # At most two inserts stand in a row: a third would only return to a place passed before.
        costs = [min(base[p], INSERT + base[NEXT[p]], 2 * INSERT + base[NEXT[NEXT[p]]]) for p in range(4)]
        back = 0
        for p, options in enumerate(moves):
            options["I"] = INSERT + costs[NEXT[p]]
            back |= EDITS.index(min(e for e, c in options.items() if c == costs[p])) << (2 * p)
        least = min(costs)
        _STEPS[after, kind] = tuple(c - least for c in costs), least, back
    return _STEPS[after, kind]


class _Backward:
    """One conversation, fed from its last row to its first; ``finish`` returns its report."""

    def __init__(self) -> None:
        self.costs, self.cost = END, 0
        self.pointers, self.spilled, self.n_spilled = array("H"), None, 0
        self.faults, self.illegal, self.following = [0, 0, 0, 0], 0, None
        self.last = self.first = self.seen = None
        self.turns = 0

    def add(self, turn: int | None, kind: int) -> None:
        self.costs, least, back = _step(self.costs, kind)
        self.cost += least
        fault, initial = divmod(kind, 4)
        self.pointers.append(back | initial << 8)
        if len(self.pointers) == SPILL_ROWS:
            self.spilled = self.spilled or tempfile.TemporaryFile()
            self.pointers.tofile(self.spilled)
            self.n_spilled += 1
            self.pointers = array("H")
        self.faults[fault] += 1
        if self.following is not None and (initial, self.following) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.following = initial
        if turn is not None:
            self.last = turn if self.last is None else self.last
            self.first = turn
            if turn != self.seen:
                self.turns, self.seen = self.turns + 1, turn

    def _from_the_first(self) -> Iterator[int]:
        yield from reversed(self.pointers)
        for k in range(self.n_spilled - 1, -1, -1):
            self.spilled.seek(k * SPILL_ROWS * self.pointers.itemsize)
            block = array("H")
            block.fromfile(self.spilled, SPILL_ROWS)
            yield from reversed(block)

    def finish(self) -> tuple:
        audit, place = bytearray(), 0
        for pointer in self._from_the_first():
            while True:
                edit = (pointer >> (2 * place)) & 3
                audit += EDITS[edit].encode()
                if edit == 0:
                    break
                place = KEEP[place, pointer >> 8] if edit == 2 else NEXT[place]
                if edit != 1:
                    break
        audit += b"I" * (END[place] // INSERT)
        if self.spilled:
            self.spilled.close()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return gaps, *self.faults[1:], self.illegal, self.cost + self.costs[0], audit.decode()


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    out = rows.select(F.col(conv_col).alias("_conv"), F.col(turn_col).cast("bigint").alias("_turn"), filled(role_col).alias("_role"), filled(text_col).alias("_text"))
    return out.withColumn("_digest", F.unhex(F.md5("_text")))


def _kinds(rows: DataFrame) -> DataFrame:
    """What the dynamic program needs of a row: (_conv, _turn, _role, _digest, _copy, _kind). No text is moved for it."""
    end = F.right(F.expr(r"trim(TRAILING ' \t\n\u000b\f\r' FROM _text)"), F.lit(1))
    narrow = rows.select("_conv", "_turn", "_role", "_digest", (~F.col("_text").rlike(r"[^\x20\x09-\x0D]")).alias("_blank"), (~end.isin(".", "!", "?")).alias("_cut"))
    copy = F.row_number().over(Window.partitionBy("_conv", "_role", "_digest").orderBy(F.asc_nulls_first("_turn")))
    fault = F.when(F.col("_blank"), BLANK).when(F.col("_copy") > 1, DUPLICATE).when(F.col("_cut"), CUT).otherwise(SOUND)
    return narrow.withColumn("_copy", copy).select("_conv", "_turn", "_role", "_digest", "_copy", (4 * fault + _initial(F.col("_role"))).cast("int").alias("_kind"))


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation of ``rows``: id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    Edits make the initials of the roles fit ``(s?(ua)+)?``: Keep costs nothing, Rerole to user or assistant 3, Delete 4, Insert of an empty user or
    assistant row 3; blank rows and those whose role and text occurred before must go; a row whose last character is none of ``.!?`` costs 3 if it stays.
    ``audit`` is the cheapest edits' initials in order, of equal costs the least in ASCII. ``blank``, ``duplicate``, ``truncated`` count rows by their first
    fault, ``illegal`` adjacent initials other than su, ua, au, ``gaps`` the numbers missing between the least and the largest turn.

    Rows are dealt out by conversation and sorted by turn, from the last to the first, so that one pass leaves a back pointer of two bytes a row: the
    state crosses Arrow batches, and the pointers of a giant conversation go to an anonymous file of the task. What is moved is a byte of faults, the
    turn, the role and a digest of the text.

    Order: turn, nulls first, then role, then MD5 of the text, so repeated rows stand together and ties are settled. Null roles and texts are
    empty, so the row is blank or of no known role; null conversations are one conversation. Other columns are not read.
    """
    kind = rows.schema[conv_col].dataType.simpleString()
    ordered = _kinds(_rows(rows, conv_col, turn_col, role_col, text_col)).repartition("_conv").sortWithinPartitions("_conv", F.desc_nulls_last("_turn"), F.desc("_role"), F.desc("_digest"), F.desc("_copy")).select("_conv", "_turn", "_kind")

    def run(batches):
        now, state, done = None, None, []

        def pack():
            convs, reports = zip(*done, strict=True)
            columns = [pa.array(convs, id_type)] + [pa.array(c, pa.string() if n == "audit" else pa.int64()) for n, c in zip(_REPORT_NAMES, zip(*reports, strict=True), strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["_conv", *_REPORT_NAMES])

        for batch in batches:
            id_type = batch.schema.field(0).type
            size = 0
            for conv, turn, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, state.finish()))
                        size += len(done[-1][1][-1])
                        if len(done) == _BATCH or size > 1 << 22:
                            size = 0
                            yield pack()
                    now, state = conv, _Backward()
                state.add(turn, k)
        if state is not None:
            done.append((now, state.finish()))
            yield pack()

    return ordered.mapInArrow(run, f"_conv {kind}, {REPORT}").withColumnRenamed("_conv", conv_col)


def repaired_rows(rows: DataFrame, reports: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows that are left, in order of conversation and place in each partition: id, place (from 0), edit (K, R or I), role, text.

    ``reports`` is ``repair_conversations`` of the same rows (written, best, as it is read once more). A conversation's audit is dealt to the task that
    holds its rows and sorts before them; the rows stream past it. A conversation is whole in one partition.
    """
    kind = rows.schema[conv_col].dataType.simpleString()
    shaped = _rows(rows, conv_col, turn_col, role_col, text_col).select("_conv", F.lit(1).alias("_part"), "_turn", "_role", "_text", "_digest")
    none = F.lit(None)
    audits = reports.select(F.col(conv_col).alias("_conv"), F.lit(0).alias("_part"), none.cast("bigint").alias("_turn"), none.cast("string").alias("_role"), F.col("audit").alias("_text"), none.cast("binary").alias("_digest"))
    ordered = shaped.unionByName(audits).repartition("_conv").sortWithinPartitions("_conv", "_part", F.asc_nulls_first("_turn"), "_role", "_digest").select("_conv", "_part", "_role", "_text")

    def run(batches):
        audit, at, place, out = "", 0, 0, 0
        found: list[tuple] = []

        def inserts(conv):
            nonlocal at, place, out
            while at < len(audit) and audit[at] == "I":
                found.append((conv, out, "I", SAYS[place], ""))
                at, out, place = at + 1, out + 1, NEXT[place]

        def pack():
            columns = list(zip(*found, strict=True))
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.string()) for c in columns[2:])], ["_conv", "place", "edit", "role", "text"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            size = 0
            for conv, part, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part == 0:
                    audit, at, place, out = text, 0, 0, 0
                else:
                    edit = audit[at]
                    at += 1
                    if edit == "K":
                        place = KEEP[place, "sua".find(role[:1])]
                        found.append((conv, out, edit, role, text))
                    elif edit == "R":
                        found.append((conv, out, edit, SAYS[place], text))
                        place = NEXT[place]
                    out += edit != "D"
                    size += len(text)
                inserts(conv)
                if len(found) >= _BATCH or (found and size > 1 << 20):
                    size = 0
                    yield pack()
            if found:
                yield pack()

    return ordered.mapInArrow(run, f"_conv {kind}, place bigint, edit string, role string, text string").withColumnRenamed("_conv", conv_col)


def repaired_digests(repaired: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(id, repaired_sha256) of the lines ``role:text`` of ``repaired_rows``, as they stream by: SHA-256 takes them one after the other."""
    kind = repaired.schema[conv_col].dataType.simpleString()

    def run(batches):
        now, digest, done = None, None, []

        def pack():
            convs, digests = zip(*done, strict=True)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(convs, id_type), pa.array(digests, pa.string())], [conv_col, "repaired_sha256"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv, place, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place == 0:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if len(done) >= _BATCH:
                yield pack()
        if digest is not None:
            done.append((now, digest.hexdigest()))
        if done:
            yield pack()

    return repaired.select(conv_col, "place", "role", "text").mapInArrow(run, f"`{conv_col}` {kind}, repaired_sha256 string")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Reports, as a table in the shared folder, and the repaired rows."""
    reports = written(repair_conversations(rows, conv_col, turn_col, role_col, text_col), "conversation-repairs")
    return reports, repaired_rows(rows, reports, conv_col, turn_col, role_col, text_col)

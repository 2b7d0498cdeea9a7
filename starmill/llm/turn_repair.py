"""Conversation structure repair: cheapest edits by Four-Russians block tables.

Every turn is a symbol: the class of its role's initial (s, u, a, other) and its first fault (blank,
duplicate, truncated). The turns' edits (Keep, Rerole, Delete, Insert) must lead through an automaton of
four states, for the role initials ``(s?(ua)+)?``.

1. Order. Turns get their position through ranges (``operators.scans``), without their texts.
   Duplicates are turns behind the first one of the same conversation, role and text.
2. Tables. The cost to go from each state, less the least of the four, is a normalised vector; few
   exist, since any two states lie a few edits apart. For every vector and every block of ``BLOCK``
   symbols a table holds the vector before the block and what is added.
3. Blocks. A conversation's vectors at block borders come by lookup from the last block to the first.
   Then blocks are expanded backward into the vectors at their turns, and the way through them takes
   the least letter of a cheapest continuation, so ties give the ASCII-least audit.
4. Chunks. A conversation above ``CHUNK`` turns is several rows. Each chunk maps vectors to vectors
   and, its end known, states to states; these maps, one small row per chunk, are chained per
   conversation, and the chunks are expanded in parallel.

Turns of equal position in time are ordered by role, then by the SHA-256 of their text. Defined results:
null roles and texts count as one space; null turns come first; turns without ``conv_id`` are one
conversation. Repeated rows are duplicates. Empty and very long texts are turns like others. Empty tables
give empty results. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from starmill.llm.common import free_names, named, ordered_sha256, same
from starmill.llm.exact_dedup import located
from starmill.operators.scans import running
from starmill.session import stored

BLOCK = 4
CHUNK = 1 << 12
JOINED = 32
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 40
# Symbols: the role's class plus 4 if truncated; one for turns that must go; one that changes nothing.
GONE, NOTHING, SYMBOLS = 8, 9, 10
TRUNCATED, BLANK, DUPLICATE = 1, 2, 3
# Neighbouring classes su, ua and au, as four times the first plus the second.
LEGAL = (1, 6, 9)


@dataclass(frozen=True)
class Edits:
    """Costs of the edits, and the tables that follow from them."""

    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self) -> None:
        if min(self.keep, self.truncated) < 0 or min(self.rerole, self.delete, self.insert) < 1:
            raise ValueError("changes must cost something, and nothing may cost less than zero")

    # What an inserted turn, or a turn of class s, u or a, leads to from each state.
    AFTER_INSERT = (USER, USER, ASSISTANT, USER)
    AFTER = ((SYSTEM, -1, -1, -1), (USER, USER, -1, USER), (-1, -1, ASSISTANT, -1), (-1,) * 4)

    def moves(self, symbol: int, state: int) -> list[tuple[str, int, int]]:
        """(letter, next state, cost) of a turn, in the letters' order."""
        found = [("D", state, self.delete)]
        if symbol != GONE:
            extra = self.truncated if symbol >= 4 else 0
            kept = self.AFTER[symbol % 4][state]
            if kept >= 0:
                found.append(("K", kept, self.keep + extra))
            found.append(("R", self.AFTER_INSERT[state], self.rerole + extra))
        return found

    def _with_inserts(self, costs: list[int]) -> tuple[int, ...]:
        for _ in range(3):
            costs = [min(c, self.insert + costs[t]) for c, t in zip(costs, self.AFTER_INSERT)]
        return tuple(costs)

    def before(self, after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
        """Costs to go before a turn from those after it."""
        if symbol == NOTHING:
            return after
        return self._with_inserts(
            [min(c + after[t] for _, t, c in self.moves(symbol, q)) for q in range(4)]
        )

    @cached_property
    def end(self) -> tuple[int, ...]:
        return self._with_inserts([0, FAR, FAR, 0])


class Tables:
    """Normalised vectors, their steps by symbol and by block, and the letters of each step."""

    def __init__(self, edits: Edits) -> None:
        self.edits = edits
        self.vectors = [edits.end]
        self.number = {edits.end: 0}
        to, add = [], []
        for vector in self.vectors:  # grows while it is read
            steps = [edits.before(vector, symbol) for symbol in range(SYMBOLS)]
            add.append([min(s) for s in steps])
            to.append([self._numbered(tuple(c - min(s) for c in s)) for s in steps])
        self.step, self.added = np.array(to), np.array(add)
        block = np.arange(SYMBOLS**BLOCK)
        self.block_step = np.repeat(np.arange(len(to))[:, None], len(block), axis=1)
        for place in range(BLOCK):  # the last symbol is the lowest digit and comes first
            self.block_step = self.step[self.block_step, block // SYMBOLS**place % SYMBOLS]
        self.known: dict[tuple[int, int, int], tuple[str, str, str | None, int, int]] = {}

    def _numbered(self, vector: tuple[int, ...]) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]

    def blocks(self, symbols: np.ndarray) -> np.ndarray:
        """Block numbers; the last block is filled up with symbols that change nothing."""
        full = np.full(-(-len(symbols) // BLOCK) * BLOCK, NOTHING)
        full[:len(symbols)] = symbols
        return full.reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)

    def function(self, symbols: np.ndarray) -> np.ndarray:
        """The vector before the symbols for every vector after them."""
        found = np.arange(len(self.vectors))
        for block in self.blocks(symbols)[::-1]:
            found = self.block_step[found, block]
        return found

    def inserts(self, state: int, cost: tuple[int, ...]) -> tuple[list[int], int]:
        """The states that cheapest insertions lead through, with these costs to go."""
        passed = []
        while cost[state] == self.edits.insert + cost[self.edits.AFTER_INSERT[state]]:
            state = self.edits.AFTER_INSERT[state]
            passed.append(state)
        return passed, state

    def act(self, after: int, symbol: int, state: int) -> tuple[str, str, str | None, int, int]:
        """Letters, inserted lines, new role ("" is the old one, null is none), next state and cost."""
        key = (after, symbol, state)
        if key not in self.known:
            costs = self.vectors[after]
            whole = self.edits.before(costs, symbol)
            passed: list[int] = []
            while True:
                tight = [(letter, t) for letter, t, c in self.edits.moves(symbol, state)
                         if c + costs[t] == whole[state]]
                if tight and tight[0][0] == "D":
                    break
                target = self.edits.AFTER_INSERT[state]
                if whole[state] != self.edits.insert + whole[target]:
                    break
                state = target
                passed.append(state)
            letter, target = tight[0]
            role = {"D": None, "K": "", "R": _ROLES.get(target)}[letter]
            paid = next(c for x, t, c in self.edits.moves(symbol, state) if x == letter)
            self.known[key] = (
                "I" * len(passed) + letter, _lines(passed), role, target,
                paid + self.edits.insert * len(passed),
            )
        return self.known[key]

    def trace(self, symbols: np.ndarray, end: int, state: int) -> tuple[list[tuple], int]:
        """Every turn's ``act``, and the state after the last."""
        blocks = self.blocks(symbols)
        borders = [end]
        for block in blocks[::-1]:
            borders.append(int(self.block_step[borders[-1], block]))
        borders.reverse()
        acts = []
        for i in range(len(blocks)):
            inside = symbols[i * BLOCK:(i + 1) * BLOCK].tolist()
            after = [borders[i + 1]]
            for symbol in inside[:0:-1]:
                after.append(int(self.step[after[-1], symbol]))
            for symbol, vector in zip(inside, reversed(after)):
                acts.append(self.act(vector, symbol, state))
                state = acts[-1][3]
        return acts, state


_ROLES = {USER: "user", ASSISTANT: "assistant"}


def _lines(states: list[int]) -> str:
    return "\n".join(f"{_ROLES[s]}:" for s in states)


def turn_rows(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` without null texts and roles, with each row's place in its file."""
    file, row = free_names(turns, "repair_file", "repair_row")
    source = located(turns, file, row)
    return source.select(
        *[named(source, c).alias(c) for c in ("conv_id", "turn")],
        *[F.coalesce(named(source, c), F.lit(" ")).alias(c) for c in ("role", "text")],
        named(source, file).alias("file"),
        named(source, row).alias("row"),
        F.lit(0).alias("copy"),
    )


def damage(rows: DataFrame) -> DataFrame:
    """``turn_rows`` with planted faults, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the turn, 1 empties its text, 2 removes its sentence ends, 3 repeats it and 4 makes it
    the user's.
    """
    first, second = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    coded = rows.withColumn(
        "code", F.crc32(F.concat(first, F.lit(":"), second).cast("binary")) % 20
    ).filter("code <> 0")
    return coded.withColumns({
        "role": F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")),
        "text": F.when(F.col("code") == 1, F.lit(""))
        .when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")),
        "copy": F.explode(F.expr("IF(code = 3, array(0, 1), array(0))")),
    }).drop("code")


def _marked(rows: DataFrame) -> DataFrame:
    """Every turn's position in its conversation, and its class plus four times its fault."""
    placed = running(
        rows.select(
            "conv_id", "turn", "role", "file", "row", "copy",
            F.unhex(F.sha2("text", 256)).alias("content"),
            (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
            (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
        ),
        ["conv_id"], ["turn", "role", "content", "file", "row", "copy"], {"pos": F.lit(1)},
    )
    repeated = placed.groupBy("conv_id", "role", "content").agg(
        F.min("pos").alias("first"), F.count("*").alias("times")
    ).filter("times > 1")
    kind = F.expr(
        "CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END"
    )
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.coalesce(F.col("pos") > F.col("first"), F.lit(False)), DUPLICATE)
        .when(F.col("cut"), TRUNCATED)
        .otherwise(0)
    )
    found = same(placed, repeated, ["conv_id", "role", "content"])
    return stored(
        found.select(
            "conv_id", "turn", "pos", "file", "row", "copy", fault.alias("fault"),
            (kind + 4 * fault).cast("tinyint").alias("code"),
        ),
        "repair-marked",
    )


def _symbols(codes: np.ndarray) -> np.ndarray:
    """Symbols of classes with their faults."""
    return np.where(codes >= 8, GONE, codes)


def _arrow(chunks: DataFrame, made, names: list[str], fields: str) -> DataFrame:
    """The columns ``names`` and those that ``made(batch row as a dict)`` gives, per row."""
    kept = chunks.select(*names).schema
    added = chunks.sparkSession.createDataFrame([], fields).schema
    schema = to_arrow_schema(StructType([*kept.fields, *added.fields]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = made()
        for batch in batches:
            rows = [{**{n: r[n] for n in names}, **work(r)} for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return chunks.mapInArrow(run, StructType([*kept.fields, *added.fields]))


def _chained(rows: DataFrame, start: int, backward: bool, value: str, name: str) -> DataFrame:
    """``conv_id, chunk, name``: what the chunks' maps ``value`` lead to, from the end or from the start.

    One small row per chunk of ``CHUNK`` turns is all that a task reads of a conversation.
    """
    kind = rows.schema["conv_id"]
    schema = StructType([kind, StructField("chunk", LongType()), StructField(name, IntegerType())])

    def run(table: pa.Table) -> pa.Table:
        order = sorted(zip(table["chunk"].to_pylist(), table[value].to_pylist()), reverse=backward)
        state, states = start, []
        for _, steps in order:
            states.append(state)
            state = steps[state]
        return pa.table(
            [pa.array([table["conv_id"][0].as_py()] * len(order), table["conv_id"].type),
             pa.array([c for c, _ in order], pa.int64()), pa.array(states, pa.int32())],
            ["conv_id", "chunk", name],
        )

    return rows.groupBy("conv_id").applyInArrow(run, schema)


def _chunk_states(chunks: DataFrame, edits: Edits) -> DataFrame:
    """``conv_id, chunk, end, entry, last`` for conversations of several chunks."""
    last = chunks.groupBy("conv_id").agg(F.max("chunk").alias("last")).filter("last > 0")
    long = stored(same(chunks, last, ["conv_id"], "inner"), "repair-long")

    def functions():
        tables = Tables(edits)
        return lambda r: {"steps": tables.function(_symbols(np.array(r["codes"]))).tolist()}

    def exits():
        tables = Tables(edits)
        return lambda r: {"exits": [
            tables.trace(_symbols(np.array(r["codes"])), r["end"], q)[1] for q in range(4)
        ]}

    steps = _arrow(long, functions, ["conv_id", "chunk"], "steps array<int>")
    ends = stored(_chained(steps, 0, True, "steps", "end"), "repair-ends")
    place = ["conv_id", "chunk"]
    left = _arrow(same(long, ends, place, "inner"), exits, place, "exits array<int>")
    entries = _chained(left, START, False, "exits", "entry")
    return same(
        same(long.select(*place, (F.col("chunk") == F.col("last")).alias("last")), ends, place, "inner"),
        entries, place, "inner",
    )


def _traced(marked: DataFrame, edits: Edits) -> DataFrame:
    """Per chunk its audit, cost and illegal pairs, and what becomes of its turns."""
    chunks = stored(
        marked.groupBy("conv_id", F.expr(f"(pos - 1) div {CHUNK}").alias("chunk")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("codes")
        ).select("conv_id", "chunk", F.col("codes.code").alias("codes")),
        "repair-chunks",
    )
    states = _chunk_states(chunks, edits)

    def trace():
        tables = Tables(edits)

        def work(r: dict) -> dict:
            codes = np.array(r["codes"])
            end = 0 if r["end"] is None else r["end"]
            acts, state = tables.trace(_symbols(codes), end, r["entry"] or START)
            audit, cost = "".join(a[0] for a in acts), sum(a[4] for a in acts)
            lines = [{"before": a[1], "role": a[2]} for a in acts]
            if r["last"] is not False:
                passed, _ = tables.inserts(state, edits.end)
                audit += "I" * len(passed)
                cost += edits.insert * len(passed)
                lines.append({"before": _lines(passed), "role": None})
            kinds = codes % 4
            pairs = kinds[:-1] * 4 + kinds[1:]
            return {
                "audit": audit, "cost": cost, "illegal": int((~np.isin(pairs, LEGAL)).sum()),
                "first": int(kinds[0]), "final": int(kinds[-1]), "lines": lines,
            }

        return work

    return stored(
        _arrow(
            same(chunks, states, ["conv_id", "chunk"]), trace, ["conv_id", "chunk"],
            "audit string, cost long, illegal long, first int, final int,"
            " lines array<struct<before: string, role: string>>",
        ),
        "repair-traced",
    )


def _repaired_lines(rows: DataFrame, marked: DataFrame, traced: DataFrame) -> DataFrame:
    """``conv_id, pos, line``: the repaired conversations' lines, inserted ones before their turn's."""
    lines = traced.select(
        "conv_id", F.posexplode("lines").alias("at", "act"), "chunk"
    ).select(
        "conv_id", (F.col("chunk") * CHUNK + F.col("at") + 1).alias("pos"),
        F.col("act.before").alias("before"), F.col("act.role").alias("new_role"),
    ).filter("before <> '' OR new_role IS NOT NULL")
    turns = same(lines, marked.select("conv_id", "pos", "file", "row", "copy"), ["conv_id", "pos"])
    texts = rows.select("file", "row", "copy", "role", "text")
    return turns.join(texts, ["file", "row", "copy"], "left").select(
        "conv_id", "pos",
        F.concat_ws(
            "\n", F.expr("nullif(before, '')"),
            F.when(
                F.col("new_role").isNotNull(),
                F.concat(F.expr("coalesce(nullif(new_role, ''), role)"), F.lit(":"), F.col("text")),
            ),
        ).alias("line"),
    )


def repaired_lines(rows: DataFrame, edits: Edits = Edits()) -> DataFrame:
    """``conv_id, pos, line``: every line ``role:text`` of the repaired ``turn_rows``."""
    marked = _marked(rows)
    return _repaired_lines(rows, marked, _traced(marked, edits))


def repairs(rows: DataFrame, edits: Edits = Edits()) -> DataFrame:
    """Per conversation of ``turn_rows``: its faults, cheapest edits and the repaired text's digest."""
    marked = _marked(rows)
    traced = _traced(marked, edits)
    turn = F.col("turn").cast("decimal(20)")
    faults = marked.groupBy("conv_id").agg(
        F.coalesce(
            (F.max(turn) - F.min(turn) + 1 - F.countDistinct("turn")).try_cast("long"), F.lit(0)
        ).alias("gaps"),
        *[F.count_if(F.col("fault") == code).alias(name)
          for name, code in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))],
    )
    borders = (
        "filter(zip_with(slice(chunks, 1, size(chunks) - 1), slice(chunks, 2, size(chunks) - 1),"
        f" (a, b) -> a.final * 4 + b.first), pair -> pair NOT IN {LEGAL})"
    )
    audits = traced.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "audit", "first", "final"))).alias("chunks"),
        F.sum("illegal").alias("inside"), F.sum("cost").alias("cost"),
    ).select(
        "conv_id", (F.col("inside") + F.expr(f"size({borders})")).alias("illegal"), "cost",
        F.array_join("chunks.audit", "").alias("audit"),
    )
    parts = _repaired_lines(rows, marked, traced).groupBy(
        "conv_id", F.expr(f"pos div {JOINED}").alias("part")
    ).agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines")).select(
        "conv_id", "part", F.array_join("lines.line", "\n").alias("piece")
    )
    digests = ordered_sha256(parts, ["conv_id"], "part", "piece", "\n", "repaired_sha256")
    return same(same(faults, audits, ["conv_id"]), digests, ["conv_id"])


def damaged_repairs(turns: DataFrame, edits: Edits = Edits()) -> DataFrame:
    """``repairs`` of the damaged turns, for every conversation there was before the damage."""
    rows = damage(turn_rows(turns))
    before = turns.select(named(turns, "conv_id").alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return same(before, repairs(rows, edits), ["conv_id"]).select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )

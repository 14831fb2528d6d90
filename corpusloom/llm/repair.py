"""Structure repair of conversations: least-cost edits by a checkpointed dynamic program."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ranking import in_places
from corpusloom.session import stage

# Costs of edits, and what counts as blank and as the end of a sentence.
DELETE, RELABEL, INSERT, TRUNCATED = 2, 1, 5, 5
BLANKS, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")
INITIALS = "sua"  # others are the fourth kind

# Roles are to spell (s?(ua)+)?. States: nothing yet, after system, after user, after assistant.
STATES = range(4)
#: The role that an insertion or relabelling gives in a state, and where it leads.
GIVES, LEADS = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
AFTER = {"s": 1, "u": 2, "a": 3}  # the state after a kept row, by its initial
ACCEPTING = (0, 3)
SHORTEST_BLOCK = 64

# A row's code is 4 * fault + kind of its initial.
SOUND, CUT, BLANK, REPEATED = range(4)


def keeps(state: int, initial: str) -> bool:
    return initial == GIVES[state][0] or (state == 0 and initial == "s")


class Program:
    """Costs to go, by state, row by row from the end; a vector's steps are kept by what is left after its least entry is taken out."""

    def __init__(self) -> None:
        self.steps: dict[tuple[int, tuple], tuple] = {}
        self.moves: dict[tuple[int, tuple, int], tuple[str, int]] = {}

    @staticmethod
    def _options(code: int, after: tuple, state: int) -> list[tuple[float, str, int]]:
        """(cost to go, letter, next state) of deleting, keeping or relabelling the row, letters ascending."""
        fault, kind = divmod(code, 4)
        out = [(DELETE + after[state], "D", state)]
        if fault in (SOUND, CUT):
            extra, initial = TRUNCATED * (fault == CUT), INITIALS[kind:kind + 1]
            if initial and keeps(state, initial):
                out.append((extra + after[AFTER[initial]], "K", AFTER[initial]))
            out.append((RELABEL + extra + after[LEADS[state]], "R", LEADS[state]))
        return out

    @staticmethod
    def inserted(costs: list[float]) -> tuple:
        """Costs with insertions first; three rounds reach every state."""
        for _ in range(3):
            costs = [min(c, INSERT + costs[LEADS[s]]) for s, c in enumerate(costs)]
        return tuple(costs)

    def before(self, code: int, after: tuple) -> tuple:
        least = min(after)
        key = (code, tuple(c - least for c in after))
        if key not in self.steps:
            self.steps[key] = self.inserted([min(self._options(code, key[1], s))[0] for s in STATES])
        return tuple(c + least for c in self.steps[key])

    def move(self, code: int, after: tuple, state: int) -> tuple[str, int]:
        """The least letters of a cheapest way over the row, and the state behind it."""
        least = min(after)
        key = (code, tuple(c - least for c in after), state)
        if key not in self.moves:
            costs, letters = self.before(code, key[1]), ""
            while True:
                tight = {letter: to for cost, letter, to in self._options(code, key[1], state) if cost == costs[state]}
                if INSERT + costs[LEADS[state]] == costs[state]:
                    tight["I"] = LEADS[state]
                letter = min(tight)
                letters, state = letters + letter, tight[letter]
                if letter != "I":
                    break
            self.moves[key] = letters, state
        return self.moves[key]


#: Costs to go after the last row.
FINISH = Program.inserted([0 if s in ACCEPTING else math.inf for s in STATES])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * len(schema), schema, strict=True)], schema=schema)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _out(held, schema)
            held = []
    if held:
        yield _out(held, schema)


def _summaries(schema: pa.Schema) -> Callable:
    def summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Codes of a block in order, its faults, and its costs between states as a min-plus matrix."""
        program = Program()

        def made() -> Iterator[tuple]:
            for row in _rows(batches):
                firsts, codes, counts = set(row["firsts"]), bytearray(), [0, 0, 0, 0]
                ordered = sorted(zip(row["places"], row["codes"], strict=True))
                for place, code in ordered:
                    if code // 4 != BLANK and place not in firsts:
                        code = 4 * REPEATED + code % 4
                    counts[code // 4] += 1
                    codes.append(code)
                kinds = [c % 4 for c in codes]
                illegal = sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(kinds, kinds[1:], strict=False))
                matrix = []
                for end in STATES:
                    costs = tuple(0 if s == end else math.inf for s in STATES)
                    for code in reversed(codes):
                        costs = program.before(code, costs)
                    matrix.append(list(costs))
                yield (row["conv"], row["block"], ordered[0][0], bytes(codes), matrix, counts[BLANK], counts[REPEATED], counts[CUT], illegal)
        yield from _in_batches(made(), schema)
    return summarise


def _checkpoints(schema: pa.Schema) -> Callable:
    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Costs to go behind each block, from a conversation's last block to its first."""
        def made() -> Iterator[tuple]:
            conv, costs, begun = None, FINISH, False
            for row in _rows(batches):
                if not begun or row["conv"] != conv:
                    conv, costs, begun = row["conv"], FINISH, True
                yield conv, row["block"], list(costs)
                costs = tuple(min(m[s] + costs[end] for end, m in enumerate(row["matrix"])) for s in STATES)
        yield from _in_batches(made(), schema)
    return check


def _walks(schema: pa.Schema) -> Callable:
    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's cost vectors anew from its checkpoint, and the least tight edits from each state it may be entered in."""
        program = Program()

        def made() -> Iterator[tuple]:
            for row in _rows(batches):
                codes, vectors = row["line"], [tuple(row["costs"])]
                for code in reversed(codes):
                    vectors.append(program.before(code, vectors[-1]))
                vectors.reverse()
                audits, ends, costs = [], [], []
                for entry in STATES:
                    state, letters = entry, []
                    for code, after in zip(codes, vectors[1:], strict=True):
                        some, state = program.move(code, after, state)
                        letters.append(some)
                    audits.append("".join(letters))
                    ends.append(state)
                    costs.append(int(vectors[0][entry] - vectors[-1][state]))
                yield (row["conv"], row["first"], audits, ends, costs, [row["blank"], row["duplicate"], row["truncated"], row["illegal"], codes[0] % 4, codes[-1] % 4])
        yield from _in_batches(made(), schema)
    return walk


class _Conversation:
    """What is known of the conversation at hand while its blocks and rows pass in order."""

    def __init__(self, conv: object) -> None:
        self.conv, self.state, self.cost, self.audit = conv, 0, 0, []
        self.sums, self.last, self.letters, self.at = [0, 0, 0, 0], None, "", 0
        self.hash, self.lines = hashlib.sha256(), 0

    def block(self, row: dict) -> None:
        self.letters, self.at = row["audits"][self.state], 0
        self.cost += row["costs"][self.state]
        self.audit.append(self.letters)
        *found, first, last = row["found"]
        self.sums = [a + b for a, b in zip(self.sums, found, strict=True)]
        if self.last is not None:
            self.sums[3] += (self.last, first) not in ((0, 1), (1, 2), (2, 1))
        self.last = last

    def _say(self, role: str, text: str) -> tuple[str, str]:
        self.hash.update((f"\n{role}:{text}" if self.lines else f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1
        return role, text

    def _insert(self) -> tuple[str, str]:
        said = self._say(GIVES[self.state], "")
        self.state = LEADS[self.state]
        return said

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """The repaired rows that a row leads to: inserted ones, then itself unless it is deleted."""
        while self.letters[self.at] == "I":
            self.at += 1
            yield self._insert()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            yield self._say(role, text)
            self.state = AFTER[role[0]]
        elif letter == "R":
            yield self._say(GIVES[self.state], text)
            self.state = LEADS[self.state]

    def end(self) -> Iterator[tuple[str, str]]:
        while self.state not in ACCEPTING:
            self.cost += INSERT
            self.audit.append("I")
            yield self._insert()

    def summary(self) -> tuple:
        return (self.conv, *self.sums, self.cost, "".join(self.audit), self.hash.hexdigest())


def _emits(schema: pa.Schema, turns: bool) -> Callable:
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            at: _Conversation | None = None

            def said(rows: Iterator[tuple[str, str]]) -> Iterator[tuple]:
                for nth, (role, text) in enumerate(rows, at.lines):
                    if turns:
                        yield at.conv, nth, role, text

            for row in _rows(batches):
                if at is None or row["conv"] != at.conv:
                    if at is not None:
                        yield from said(at.end())
                        if not turns:
                            yield at.summary()
                    at = _Conversation(row["conv"])
                if row["audits"] is not None:
                    at.block(row)
                else:
                    yield from said(at.turn(row["role"], row["text"]))
            if at is not None:
                yield from said(at.end())
                if not turns:
                    yield at.summary()
        yield from _in_batches(made(), schema)
    return emit


def faulty(text: Column) -> Column:
    """A row's own fault: blank, or cut before the end of a sentence."""
    shown = F.rtrim(text, F.lit(BLANKS))
    return F.when(shown == "", BLANK).when(F.substring(shown, -1, 1).isin(*ENDS), SOUND).otherwise(CUT)


class Repair:
    """Least-cost repair of every conversation of ``(conv, turn, role, text)``.

    Rows are taken by turn, nulls first, then role and text. A row's first fault counts: blank; role and text seen earlier; cut. Kept rows cost nothing,
    relabelling to user or assistant 1, deleting 2 (blank and repeated rows have to go), inserting an empty user or assistant row 5,
    and a cut row that stays 5; the roles left are to spell ``(s?(ua)+)?``, and of the cheapest edits those with the least
    letters (D, I, K, R) are taken. Null roles and texts are one blank; a null conversation id is a conversation; an empty table
    gives no rows; other columns are not read.

    Rows lie in ranges of (conversation, turn); a block is what a conversation has in an aligned stretch of about the square root of
    the longest conversation. Tasks reduce blocks to 4 x 4 cost matrices, one pass from the last block to the first leaves costs to go at
    block ends only, and tasks recompute a block's vectors from there and walk it. So no task holds more than a block; what
    passes through one task for a long conversation are its matrices, and in the end its rows, since a digest is taken in order.
    """

    def __init__(self, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> None:
        self.conv = conv
        role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text))
        rows = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), role.alias("role"), text.alias("text"))
        self.rows = in_places(rows, *(F.col(c).asc_nulls_first() for c in rows.columns))
        self.key = rows.schema["conv"].dataType.simpleString()

    def _block_size(self) -> int:
        longest = self.rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
        return 1 << max(math.ceil(math.log2(SHORTEST_BLOCK)), math.ceil(math.log2(math.sqrt(longest))))

    def _walked(self) -> DataFrame:
        wide = self._block_size()
        kind = reduce(lambda other, i: F.when(F.startswith("role", F.lit(INITIALS[i])), i).otherwise(other), range(3), F.lit(3))
        block = F.floor(F.col("place") / wide).alias("block")
        said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
        coded = self.rows.select("conv", "place", (4 * faulty(F.col("text")) + kind).alias("code"), F.lit(None).cast("bigint").alias("first"))
        firsts = self.rows.groupBy("conv", said.alias("said")).agg(F.min("place").alias("place"))
        firsts = firsts.select("conv", "place", F.lit(None).cast("int").alias("code"), F.col("place").alias("first"))
        row = F.when(F.col("code").isNotNull(), F.struct("place", "code"))
        blocks = (coded.unionByName(firsts).groupBy("conv", block).agg(F.collect_list(row).alias("rows"), F.collect_list("first").alias("firsts"))
                  .select("conv", "block", F.col("rows.place").alias("places"), F.col("rows.code").alias("codes"), "firsts"))

        def made(df: DataFrame, work: Callable, fields: str) -> DataFrame:
            kind = df.sparkSession.createDataFrame([], f"conv {self.key}, {fields}")
            return df.mapInArrow(work(kind.toArrow().schema), kind.schema)

        counts = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
        blocks = stage(made(blocks, _summaries, f"block bigint, first bigint, line binary, matrix array<array<double>>, {counts}"), "blocks")
        backward = blocks.select("conv", "block", "matrix").repartition("conv").sortWithinPartitions("conv", F.desc("block"))
        checkpoints = made(backward, _checkpoints, "block bigint, costs array<double>")
        same = blocks["conv"].eqNullSafe(checkpoints["conv"]) & (blocks["block"] == checkpoints["block"])
        met = blocks.join(checkpoints, same).select(blocks["conv"], "first", "line", "costs", *[c.split()[0] for c in counts.split(", ")])
        return stage(made(met, _walks, "place bigint, audits array<string>, ends array<int>, costs array<bigint>, found array<bigint>"), "walks")

    def _emitted(self, fields: str, turns: bool) -> DataFrame:
        steps = self._walked().select("conv", "place", F.lit(0).alias("kind"), "audits", "costs", "found", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
        lines = self.rows.select("conv", "place", F.lit(1).alias("kind"), "role", "text")
        met = steps.unionByName(lines, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "place", "kind")
        made = met.sparkSession.createDataFrame([], f"conv {self.key}, {fields}")
        return met.mapInArrow(_emits(made.toArrow().schema, turns), made.schema).withColumnRenamed("conv", self.conv)

    def turns(self) -> DataFrame:
        """``(conv, nth, role, text)``: the repaired conversations."""
        return self._emitted("nth bigint, role string, text string", True)

    def summary(self) -> DataFrame:
        """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation with a row."""
        done = self._emitted("blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string", False)
        span = F.max("turn") - F.min("turn") + 1 - F.count("turn")  # over distinct turns
        gaps = self.rows.select(F.col("conv").alias("_conv"), "turn").distinct().groupBy("_conv").agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"))
        return done.join(gaps, F.col(self.conv).eqNullSafe(F.col("_conv"))).drop("_conv")


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with faults laid in by a checksum of (conv_id, turn): rows lost, emptied, cut, said twice, given to the user."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20).alias("fate")
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fate).filter("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")

"""Audit and cheapest repair of damaged conversations, by auction shortest paths.

A conversation is repaired by keeping, reroling, deleting and inserting rows until its role initials read ``(s?(ua)+)?``.
The edits are the arcs of a lattice of (rows read, roles written so far); arc costs are small integers.

1. Rows. Equal rows of a turn collapse to one run with a count. A second aggregation finds the first turn of each (role,
   text), which tells duplicates; a range sort by (conversation, turn, role, text digest) deals even one conversation of a
   third of all rows over many tasks. Texts take no part in this: a row is one byte, its initial and its fault.
2. Auction. Rows are cut into blocks. In a block the auction algorithm keeps a price for each node and one path: the path is
   extended along the arc whose cost and end price equal its last node's price, else that price is raised to the least of
   these sums and the path contracts. Prices start at what blank, duplicate and truncated rows cost in any repair, and never
   exceed the distance to the end.
3. Long conversations. Each block's auctions between all states at its ends give a 4 x 4 table of costs. The tables are
   folded from the last block to the first, one small row each, into the prices at each block's end; blocks are then traced
   on their own from each state, and the first state of each block picks its trace. Of arcs that are equally tight the
   one of the least letter is taken, so the path is the ASCII-least of the cheapest.
4. Digest. A hash over a whole repaired conversation has to be taken in order, so here, and only here, the rows of one
   conversation are read by one task, one row at a time in a sorted stream. It holds the edit string, which is a result cell.

Defined cases: a null conv_id or turn is one space in the damage key, a null role or text is one space. Rows without a
conv_id are one conversation. Rows of one turn are taken by role, then by the text's MD5, and a repeated row stands beside
its copy. An initial other than s, u and a (an empty role has none) is illegal beside any other and cannot be kept.
``gaps`` beyond a long is held at its end. A conversation that loses all its rows has zeros, an empty audit and the hash of
the empty text. Columns other than conv_id, turn, role and text are not read. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.session import written

#: Rows of a block; traces and tables of costs remembered by a task (a block's bytes and a few numbers each).
BLOCK = 32
REMEMBERED = 1 << 14

BLANKS = " \t\n\x0b\x0c\r"
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)
#: What is written so far: nothing, a system turn, up to a user turn, up to an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEPT, DELETE, INSERT, REROLE, CUT = 0, 3, 2, 2, 1
#: The role that may come next, and the prices of the states behind the last row: inserted turns complete the pattern.
NEXT = (USER, USER, ASSISTANT, USER)
END = (0, 4, 2, 0)
ENDING = ("", "II", "I", "")
UNREACHABLE = 1 << 60


def _arcs(code: int, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """Edits (letter, rows read, state, cost) that a state allows before and at a row, in ASCII order of their letters.

    A code is the role's initial (0 to 2 for s, u, a, else 3) and 4 times the fault.
    """
    initial, fault = code % 4, code // 4
    after = NEXT[state]
    out = [("D", 1, state, DELETE), ("I", 0, after, INSERT)]
    if fault in (FINE, TRUNCATED):
        cut = CUT if fault == TRUNCATED else 0
        kept = initial + 1
        if kept == after or (kept == SYSTEM and state == NOTHING):
            out.append(("K", 1, kept, KEPT + cut))
        out.append(("R", 1, after, REROLE + cut))
    return tuple(out)


ARCS = [[_arcs(code, state) for state in range(4)] for code in range(16)]
#: What any repair pays for a row of each code.
FORCED = [(0, CUT, DELETE, DELETE)[code // 4] for code in range(16)]


class Auction:
    """Shortest paths from states before a block's rows to its end, where leaving in a state costs its exit price."""

    def __init__(self, codes: bytes, exits: tuple[int, ...]):
        self.codes, self.exits = codes, exits
        n = len(codes)
        rest = [min(exits)] * (n + 1)
        for i in range(n - 1, -1, -1):
            rest[i] = rest[i + 1] + FORCED[codes[i]]
        # states from which no exit can be reached: nothing leads back to the earlier states
        dead = [all(exits[s] >= UNREACHABLE for s in ahead) for ahead in (range(4), (1, 2, 3), (2, 3), (2, 3))]
        self.prices = [[UNREACHABLE if dead[s] else rest[i] for s in range(4)] for i in range(n + 1)]

    def run(self, start: int) -> tuple[int, str, int]:
        """Cost, edits and last state of the ASCII-least of the cheapest paths; the cost is UNREACHABLE if there is none."""
        prices, codes, n = self.prices, self.codes, len(self.codes)
        path, letters = [(0, start)], []
        while True:
            i, state = path[-1]
            own = prices[i]
            if i == n:
                best, arc = self.exits[state], None
            else:
                best, arc = UNREACHABLE, None
                for option in ARCS[codes[i]][state]:
                    sum_ = option[3] + prices[i + option[1]][option[2]]
                    if sum_ < best:
                        best, arc = sum_, option
            if own[state] >= UNREACHABLE or best >= UNREACHABLE:
                own[state] = UNREACHABLE
                if len(path) == 1:
                    return UNREACHABLE, "", start
                path.pop(), letters.pop()
            elif own[state] < best:  # contraction
                own[state] = best
                if len(path) > 1:
                    path.pop(), letters.pop()
            elif i == n:
                return prices[0][start], "".join(letters), state
            else:  # extension along the least of the tight arcs
                letters.append(arc[0])
                path.append((i + arc[1], arc[2]))


@functools.lru_cache(REMEMBERED)
def traces(codes: bytes, exits: tuple[int, ...], starts: tuple[int, ...]) -> list[tuple[int, str, int]]:
    auction = Auction(codes, exits)
    return [auction.run(s) for s in starts]


@functools.lru_cache(REMEMBERED)
def costs(codes: bytes) -> list[int]:
    """Costs of a block from each state before it to each state behind it, row by row."""
    out = [[UNREACHABLE] * 4 for _ in range(4)]
    for end in range(4):
        auction = Auction(codes, tuple(0 if s == end else UNREACHABLE for s in range(4)))
        for start in range(4):
            out[start][end] = auction.run(start)[0]
    return sum(out, [])


def _or_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text, copies``: a fixed share of rows dropped, emptied, cut, repeated or given the role user."""
    fate = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn")).cast("binary")) % 20
    rows = conversations.select(
        _or_space("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), _or_space("role").alias("role"),
        _or_space("text").alias("text"), fate.alias("fate"),
    ).where(F.col("fate") != 0)
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select(
        "conv", "turn", role.alias("role"), text.alias("text"), F.when(F.col("fate") == 3, 2).otherwise(1).alias("copies")
    )


def _runs(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one: ``conv, turn, role, digest, copies, initial, fault, fresh``; fresh if first of its text."""
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    marked = rows.select("conv", "turn", "role", F.md5("text").alias("digest"), fault.alias("fault"), F.col("copies").cast("long"))
    runs = written(
        marked.groupBy("conv", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.max("fault").alias("fault")),
        "conversation-runs",
    )
    first = written(
        runs.where(F.col("fault") != BLANK).groupBy("conv", "role", "digest")
        .agg(F.count("*").alias("turns"), F.max(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("first"))
        .where("turns > 1"),
        "conversation-repeats",
    )
    fresh = F.when(F.col("turns").isNull(), True).when(F.col("unnumbered"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first"))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return runs.join(first, ["conv", "role", "digest"], "left").select(
        "conv", "turn", "role", "digest", "copies", initial.alias("initial"), "fault", fresh.alias("fresh")
    )


def _order() -> list[Column]:
    return [F.col("turn").isNotNull(), F.col("turn"), F.col("role"), F.col("digest")]


BLOCKS = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("block", pa.int64()), ("whole", pa.bool_()), ("codes", pa.binary())])
BLOCKS_DDL = "conv string, part int, block long, whole boolean, codes binary"
FLUSH = 4096


def cut_blocks(size: int):
    """Cutter of sorted runs into blocks of ``size`` codes. A conversation is whole if its one block cannot go on in a neighbouring task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out: list[dict] = []
        conv, codes, block, leading = None, bytearray(), 0, True

        def close(whole: bool) -> None:
            nonlocal block
            out.append({"conv": conv, "part": part, "block": block, "whole": whole and block == 0, "codes": bytes(codes)})
            block += 1
            codes.clear()

        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("conv", "copies", "initial", "fault", "fresh"))
            for name, copies, initial, fault, fresh in zip(*columns):
                if name != conv:
                    if codes:
                        close(not leading)
                    leading = conv is None
                    conv, block = name, 0
                    if len(out) >= FLUSH:
                        yield pa.RecordBatch.from_pylist(out, schema=BLOCKS)
                        out = []
                if fault != BLANK and fresh:
                    codes.append(initial + 4 * fault)
                    copies -= 1
                    if len(codes) == size:
                        close(False)
                code = bytes([initial + 4 * (BLANK if fault == BLANK else DUPLICATE)])
                while copies:
                    taken = min(copies, size - len(codes))
                    codes += code * taken
                    copies -= taken
                    if len(codes) == size:
                        close(False)
                    if len(out) >= FLUSH:
                        yield pa.RecordBatch.from_pylist(out, schema=BLOCKS)
                        out = []
        if codes:
            close(False)
        yield pa.RecordBatch.from_pylist(out, schema=BLOCKS)

    return run


def _with_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.append_column("costs", pa.array([costs(c) for c in batch.column("codes").to_pylist()], pa.list_(pa.int64())))


def _exit_prices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prices behind each block, folded over a conversation's blocks from the last to the first."""
    conv, prices = None, END
    for batch in batches:
        found = []
        for name, table in zip(batch.column("conv").to_pylist(), batch.column("costs").to_pylist()):
            if name != conv:
                conv, prices = name, END
            found.append(list(prices))
            prices = tuple(min(table[4 * s + e] + prices[e] for e in range(4)) for s in range(4))
        yield batch.drop_columns(["costs"]).append_column("exits", pa.array(found, pa.list_(pa.int64())))


TRACED = "conv string, part int, block long, codes binary, cost long, pieces array<string>, ends array<int>"
TRACED_SCHEMA = pa.schema([
    ("conv", pa.string()), ("part", pa.int32()), ("block", pa.int64()), ("codes", pa.binary()), ("cost", pa.int64()),
    ("pieces", pa.list_(pa.string())), ("ends", pa.list_(pa.int32())),
])


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of each block from each state before it, and the states they end in; a whole conversation begins with nothing."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            exits = tuple(row["exits"] or END)
            base = min(exits)
            found = traces(row["codes"], tuple(e - base for e in exits), (0,) if row["whole"] else (0, 1, 2, 3))
            out.append({
                "conv": row["conv"], "part": row["part"], "block": row["block"], "codes": row["codes"], "cost": found[0][0] + base,
                "pieces": [p for _, p, _ in found], "ends": [e for _, _, e in found],
            })
        yield pa.RecordBatch.from_pylist(out, schema=TRACED_SCHEMA)


class Repair:
    """One conversation: its blocks' edits first, then its rows in order."""

    def __init__(self, conv: str):
        self.conv, self.pieces, self.state, self.cost = conv, [], NOTHING, None
        self.faults, self.illegal, self.last = [0] * 4, 0, None
        self.audit, self.at, self.written, self.hash, self.lines = "", 0, NOTHING, hashlib.sha256(), 0

    def block(self, codes: bytes, cost: int, pieces: list[str], ends: list[int]) -> None:
        self.cost = cost if self.cost is None else self.cost
        self.pieces.append(pieces[self.state])
        self.state = ends[self.state]
        for code in codes:
            self.faults[code // 4] += 1
            initial = code % 4
            if self.last is not None and (self.last, initial) not in ((0, 1), (1, 2), (2, 1)):
                self.illegal += 1
            self.last = initial

    def complete(self) -> None:
        """All blocks are known."""
        if self.pieces:
            self.audit = "".join(self.pieces) + ENDING[self.state]
            self.pieces = []

    def _line(self, role: str, text: str) -> None:
        if self.lines:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.lines += 1

    def _turn(self, text: str) -> None:
        self.written = NEXT[self.written]
        self._line("user" if self.written == USER else "assistant", text)

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._turn("")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._line(role, text)
            self.written = SYSTEM if role.startswith("s") else NEXT[self.written]
        elif edit == "R":
            self._turn(text)

    def result(self) -> dict:
        self.complete()
        self._insertions()
        if self.at != len(self.audit):
            raise ValueError(f"edits of conversation {self.conv} do not fit its rows")
        return {
            "conv": self.conv, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED],
            "illegal": self.illegal, "cost": self.cost, "audit": self.audit, "repaired_sha256": self.hash.hexdigest(),
        }


REPAIRED = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
REPAIRED_SCHEMA = pa.schema([
    ("conv", pa.string()), *((n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", pa.string()), ("repaired_sha256", pa.string()),
])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks and rows of conversations to one result each."""
    current: Repair | None = None
    for batch in batches:
        out = []
        columns = [batch.column(n) for n in ("conv", "copies", "role", "text", "codes", "cost", "pieces", "ends")]
        for i in range(batch.num_rows):
            conv, copies, role, text, codes, cost, pieces, ends = (c[i].as_py() for c in columns)
            if current is None or conv != current.conv:
                if current is not None:
                    out.append(current.result())
                current = Repair(conv)
            if codes is not None:
                current.block(codes, cost, pieces, ends)
            else:
                current.complete()
                for _ in range(copies):
                    current.row(role, text)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=REPAIRED_SCHEMA)
    if current is not None:
        yield pa.RecordBatch.from_pylist([current.result()], schema=REPAIRED_SCHEMA)


def _gaps(rows: DataFrame) -> DataFrame:
    """Turn numbers missing between a conversation's first and last."""
    turns = rows.select("conv", "turn").distinct().groupBy("conv").agg(
        F.max("turn").cast("decimal(38,0)").alias("high"), F.min("turn").cast("decimal(38,0)").alias("low"), F.count("turn").alias("n")
    )
    missing = F.col("high") - F.col("low") + 1 - F.col("n")
    return turns.select("conv", F.least(F.coalesce(missing, F.lit(0)), F.lit(2**63 - 1)).cast("long").alias("gaps"))


def repaired(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation."""
    rows = damaged(conversations)
    runs = _runs(rows)
    placed = runs.repartitionByRange("conv", *_order()).sortWithinPartitions("conv", *_order())
    blocks = written(placed.mapInArrow(cut_blocks(BLOCK), BLOCKS_DDL), "conversation-blocks")
    tables = blocks.where("not whole").mapInArrow(_with_costs, f"{BLOCKS_DDL}, costs array<long>")
    backwards = tables.repartition("conv").sortWithinPartitions("conv", F.desc("part"), F.desc("block"))
    priced = backwards.mapInArrow(_exit_prices, f"{BLOCKS_DDL}, exits array<long>")
    whole = blocks.where("whole").withColumn("exits", F.lit(None).cast("array<long>"))
    edits = written(priced.repartition("conv", "part", "block").unionByName(whole).mapInArrow(_traced, TRACED), "conversation-edits")

    stream = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("digest"), "copies", "text").unionByName(
        edits.withColumn("kind", F.lit(0)), allowMissingColumns=True
    )
    sorted_ = stream.repartition("conv").sortWithinPartitions("conv", "kind", "part", "block", *_order())
    found = sorted_.mapInArrow(_repaired, REPAIRED)
    names = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = names.withColumn("conv", _or_space("conv_id")).join(_gaps(rows), "conv", "left").join(found, "conv", "left")
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")
    )

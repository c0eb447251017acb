"""Repair of conversation structure: faults, cheapest edits and the repaired turns.

Rows are sorted by conversation and turn over range partitions, so that a conversation
of any length is spread over tasks. A task walks its rows in order and cuts them into
pieces of at most ``PIECE_ROWS`` rows or ``PIECE_BYTES`` of text. A conversation that
lies within a partition and is one piece is repaired there and then, by the block
tables (``blocktables``). The others, two at most for each partition and the long ones,
are put together from their pieces by joins and by groups of one short row a piece:

1. the first occurrence of each role and text among the pieces of a conversation;
2. for each piece what it does to every cost vector, then, along the conversation, the
   vector before each piece;
3. for each piece what it does to every set of marked states, then, along the
   conversation from its end, the marked states behind each piece, and from its begin
   the state before it;
4. the letters of each piece, expanded with these, and the repaired turns;
5. a digest along the pieces in order, which keeps one piece in memory and the letters
   of one conversation (they are one value of the result).

Edits: Keep costs 0, Rerole 2, Delete 3, Insert 2; a truncated row that stays costs 1 more;
blank and duplicate rows are deleted.

Defined results: null roles and texts are one space, a null turn sorts first, and the
rows without a conversation form one of their own. Rows of one turn go by role, then by
a hash of role and text; equal rows are adjacent, all but the first duplicates. An empty
role has no initial that could be kept. A conversation without rows has zeros, empty
letters and the digest of the empty text; an empty table gives an empty result. Gaps
beyond the range of long count as its largest value. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import blocktables, scratch

PIECE_ROWS = 4096
PIECE_BYTES = 4 << 20
#: White space of the contract, and what ends a whole text: fixed values.
SPACE = " \t\n\x0b\x0c\r"
ENDINGS = (".", "!", "?")
LEGAL = {"su", "ua", "au"}

PIECE = (
    "conv_id long, part int, seq int, whole boolean, low long, high long, turns long, illegal long, head string, "
    "tail string, blank long, duplicate long, truncated long, cost long, audit string, roles array<string>, "
    "texts array<string>, keys array<binary>"
)
REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the stated damage; a dropped row stays as a mark of its conversation."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    dealt = rows.select(
        "conv_id",
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.crc32(name.cast("binary")) % 20).alias("deal"),
    )
    text = F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.regexp_replace("text", "[.!?]", ""))
    return dealt.select(
        "conv_id",
        "turn",
        F.when(F.col("deal") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("deal") != 0, text.otherwise(F.col("text"))).alias("text"),
        (F.col("deal") == 0).alias("dropped"),
        F.explode(F.when(F.col("deal") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """Rows over range partitions in the order of their conversation; equal rows may lie in several partitions."""
    keyed = rows.withColumns(
        {
            "_role": F.substring("role", 1, 32),
            "_hash": F.xxhash64("role", "text"),
            "_id": F.monotonically_increasing_id(),
        }
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "_role", "_hash", "_id")]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "dropped")


def fault_symbols(roles: list[str], texts: list[str], first: list[bool]) -> tuple[np.ndarray, list[int]]:
    """The symbol of each row, and how many rows are blank, duplicate and truncated."""
    symbols, counts = bytearray(), [0, 0, 0]
    for role, text, new in zip(roles, texts, first):
        body = text.rstrip(SPACE)
        fault = 0 if not body else 1 if not new else 2 if not body.endswith(ENDINGS) else 3
        if fault < 3:
            counts[fault] += 1
        symbols.append(blocktables.symbol(role, fault < 2, fault == 2))
    return np.frombuffer(bytes(symbols), np.uint8), counts


def row_key(role: str, text: str) -> bytes:
    """Equal for equal role and text."""
    given = role.encode()
    return hashlib.blake2b(b"%d:" % len(given) + given + text.encode(), digest_size=16).digest()


@dataclass
class Piece:
    """Rows of one conversation that a task has read in a row."""

    conv_id: int | None
    seq: int
    edge: bool

    def __post_init__(self):
        self.turns, self.roles, self.texts, self.size = [], [], [], 0

    def add(self, turn, role, text) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)

    def full(self) -> bool:
        return len(self.turns) >= PIECE_ROWS or self.size >= PIECE_BYTES

    def row(self, part: int) -> dict:
        """The piece for the table of pieces, repaired if the conversation is no longer than it."""
        known = [t for t in self.turns if t is not None]
        initials = [r[:1] for r in self.roles]
        row = {
            "conv_id": self.conv_id,
            "part": part,
            "seq": self.seq,
            "whole": not self.edge,
            "low": known[0] if known else None,
            "high": known[-1] if known else None,
            "turns": len(set(known)),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "head": initials[0] if initials else None,
            "tail": initials[-1] if initials else None,
        }
        keys = [row_key(r, t) for r, t in zip(self.roles, self.texts)]
        if self.edge:
            return row | {"roles": self.roles, "texts": self.texts, "keys": keys}
        seen: set[bytes] = set()
        first = [not (k in seen or seen.add(k)) for k in keys]
        symbols, counts = fault_symbols(self.roles, self.texts, first)
        cost, letters, after = blocktables.tables().solve(symbols)
        repaired = rebuilt(letters, after, self.roles, self.texts, blocktables.START)
        return row | dict(zip(("blank", "duplicate", "truncated"), counts)) | {
            "cost": cost,
            "audit": "".join(letters) + after,
            "roles": [r for r, _ in repaired],
            "texts": [t for _, t in repaired],
        }


def rebuilt(letters: list[str], after: str, roles: list[str], texts: list[str], state: int) -> list[tuple[str, str]]:
    """The repaired turns of a piece."""
    out = []
    for given, role, text in zip(letters, roles, texts):
        turns, state = blocktables.apply(given, state, role, text)
        out += turns
    return out + blocktables.apply(after, state)[0]


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _schema(spark: SparkSession, ddl: str) -> pa.Schema:
    """The Arrow schema of a table described as Spark does."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def _emitted(rows: Iterator[tuple[dict, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows with their sizes, as batches of about ``PIECE_BYTES``."""
    held, size = [], 0
    for row, more in rows:
        held.append(row)
        size += more + 200
        if size >= PIECE_BYTES:
            yield _arrow(held, schema)
            held, size = [], 0
    if held:
        yield _arrow(held, schema)


def cut(rows: DataFrame) -> DataFrame:
    """The table of pieces of rows in order, written in the shared folder."""
    schema = _schema(rows.sparkSession, PIECE)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        part, piece, seq = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            for conv_id, turn, role, text, dropped in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if piece is None or conv_id != piece.conv_id:
                    if piece is not None:
                        yield piece.row(part), piece.size
                        seq += 1
                    piece = Piece(conv_id, seq, edge=seq == 0)
                elif piece.full():
                    piece.edge = True
                    yield piece.row(part), piece.size
                    seq += 1
                    piece = Piece(conv_id, seq, edge=True)
                if not dropped:
                    piece.add(turn, role, text)
        if piece is not None:
            piece.edge = True
            yield piece.row(part), piece.size

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _emitted(pieces(batches), schema)

    return scratch.materialise(rows.mapInArrow(task, PIECE), "conversation-pieces")


def first_rows(pieces: DataFrame) -> DataFrame:
    """Per piece (part, seq) the positions of rows whose role and text no earlier row of the conversation has."""
    rows = pieces.select("conv_id", "part", "seq", F.posexplode("keys").alias("pos", "key"))
    first = rows.groupBy("conv_id", "key").agg(F.min(F.struct("part", "seq", "pos")).alias("at"))
    return first.groupBy("at.part", "at.seq").agg(F.collect_list("at.pos").alias("fresh"))


TRANSFER = (
    "conv_id long, part int, seq int, symbols binary, blank long, duplicate long, truncated long, "
    "behind binary, rise binary"
)


def transfers(pieces: DataFrame) -> DataFrame:
    """Per piece its symbols and what it does to every cost vector, as a table of short rows."""
    schema = _schema(pieces.sparkSession, TRANSFER)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        tables = blocktables.tables()
        for batch in batches:
            for row in batch.to_pylist():
                fresh = set(row["fresh"] or [])
                first = [i in fresh for i in range(len(row["roles"]))]
                symbols, counts = fault_symbols(row["roles"], row["texts"], first)
                behind, rise = tables.transfers(symbols)
                done = {k: row[k] for k in ("conv_id", "part", "seq")}
                done |= dict(zip(("blank", "duplicate", "truncated"), counts))
                done |= {"symbols": symbols.tobytes(), "behind": behind.astype("<i4").tobytes()}
                yield done | {"rise": rise.astype("<i8").tobytes()}, len(symbols)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _emitted(rows(batches), schema)

    joined = pieces.select("conv_id", "part", "seq", "roles", "texts").join(first_rows(pieces), ["part", "seq"], "left")
    return scratch.materialise(joined.mapInArrow(task, TRANSFER), "conversation-transfers")


ENTRY = "conv_id long, part int, seq int, vector int, last boolean, cost long"


def entry_vectors(table: DataFrame) -> DataFrame:
    """The cost vector before each piece; the last piece also gets the conversation's cost."""
    schema = _schema(table.sparkSession, ENTRY)

    def along(group: pa.Table) -> pa.Table:
        tables, vector, total, rows = blocktables.tables(), 0, 0, []
        for row in group.sort_by([("part", "ascending"), ("seq", "ascending")]).to_pylist():
            rows.append({k: row[k] for k in ("conv_id", "part", "seq")} | {"vector": vector, "last": False, "cost": 0})
            total += int(np.frombuffer(row["rise"], "<i8")[vector])
            vector = int(np.frombuffer(row["behind"], "<i4")[vector])
        rows[-1] |= {"last": True, "cost": total + tables.end(vector)[0]}
        return pa.Table.from_pylist(rows, schema)

    short = table.select("conv_id", "part", "seq", "behind", "rise")
    return short.groupBy("conv_id").applyInArrow(along, ENTRY)


MARKS = "conv_id long, part int, seq int, vector int, last boolean, cost long, symbols binary, mask int, maps binary"


def mark_maps(table: DataFrame) -> DataFrame:
    """Per piece what it makes of each set of marked states: those before it, and where each of them leads."""
    schema = _schema(table.sparkSession, MARKS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        tables, states = blocktables.tables(), range(blocktables.STATES)
        for batch in batches:
            for row in batch.to_pylist():
                symbols = np.frombuffer(row["symbols"], np.uint8)
                vectors = tables.expand(symbols, row["vector"])
                _, behind, _ = tables.forward(symbols, row["vector"])
                maps = bytearray()
                for mask in range(1 << blocktables.STATES):
                    marks = tables.marks(symbols, vectors, mask)
                    leads = [tables.trace(symbols, vectors, marks, s)[1] if marks[0] >> s & 1 else 0 for s in states]
                    maps += bytes([marks[0], *leads])
                yield row | {"mask": tables.end(behind)[1], "maps": bytes(maps)}, len(symbols)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _emitted(rows(batches), schema)

    known = entry_vectors(table).drop("conv_id")
    joined = table.select("conv_id", "part", "seq", "symbols").join(known, ["part", "seq"])
    columns = ["conv_id", "part", "seq", "vector", "last", "cost", "symbols"]
    return scratch.materialise(joined.select(*columns).mapInArrow(task, MARKS), "conversation-marks")


PLACE = "conv_id long, part int, seq int, mask int, state int"


def places(table: DataFrame) -> DataFrame:
    """Per piece the marked states behind it and the state before it, along each conversation."""
    schema = _schema(table.sparkSession, PLACE)
    width = 1 + blocktables.STATES

    def along(group: pa.Table) -> pa.Table:
        rows = group.sort_by([("part", "ascending"), ("seq", "ascending")]).to_pylist()
        mask = rows[-1]["mask"]
        for row in reversed(rows):
            row["mask"] = mask
            mask = row["maps"][mask * width]
        state = blocktables.START
        for row in rows:
            row["state"] = state
            state = row["maps"][row["mask"] * width + 1 + state]
        return pa.Table.from_pylist([{k: row[k] for k in schema.names} for row in rows], schema)

    return table.select("conv_id", "part", "seq", "mask", "maps").groupBy("conv_id").applyInArrow(along, PLACE)


def pieced(pieces: DataFrame) -> DataFrame:
    """The pieces of conversations that several make up, repaired; whole conversations' columns, per piece."""
    table = transfers(pieces)
    marked = mark_maps(table)
    schema = _schema(pieces.sparkSession, PIECE)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        tables = blocktables.tables()
        for batch in batches:
            for row in batch.to_pylist():
                symbols = np.frombuffer(row["symbols"], np.uint8)
                vectors = tables.expand(symbols, row["vector"])
                marks = tables.marks(symbols, vectors, row["mask"])
                letters, state = tables.trace(symbols, vectors, marks, row["state"])
                after = tables.finish(tables.forward(symbols, row["vector"])[1], state) if row["last"] else ""
                turns = rebuilt(letters, after, row["roles"], row["texts"], row["state"])
                done = {"audit": "".join(letters) + after, "whole": False, "keys": None}
                done |= {"roles": [r for r, _ in turns], "texts": [t for _, t in turns]}
                yield {k: (row | done)[k] for k in schema.names}, sum(len(t) for _, t in turns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _emitted(rows(batches), schema)

    at, counts = ["part", "seq"], ["blank", "duplicate", "truncated"]
    joined = (
        pieces.drop(*counts, "cost", "audit", "keys", "whole")
        .join(table.select(*at, *counts), at)
        .join(marked.select(*at, "vector", "last", "cost", "symbols"), at)
        .join(places(marked).select(*at, "mask", "state"), at)
    )
    return scratch.materialise(joined.mapInArrow(task, PIECE), "conversation-repaired")


def gaps_of(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, 2**63 - 1)


def along_pieces(pieces: DataFrame) -> DataFrame:
    """The report of conversations of several pieces, from their repaired pieces in order."""
    schema = _schema(pieces.sparkSession, REPORT)

    def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        held = None
        for batch in batches:
            for row in batch.to_pylist():
                if held is None or held["conv_id"] != row["conv_id"]:
                    if held is not None:
                        yield closed(held), 0
                    held = {"conv_id": row["conv_id"], "low": None, "high": None, "turns": 0, "tail": None, "audit": []}
                    held |= dict.fromkeys(("illegal", "blank", "duplicate", "truncated", "cost"), 0)
                    held |= {"digest": hashlib.sha256(), "lines": 0}
                together(held, row)
        if held is not None:
            yield closed(held), 0

    def together(held: dict, row: dict) -> None:
        held["turns"] += row["turns"] - (row["low"] is not None and row["low"] == held["high"])
        held["low"] = row["low"] if held["low"] is None else held["low"]
        held["high"] = held["high"] if row["high"] is None else row["high"]
        if row["head"] is not None:
            held["illegal"] += held["tail"] is not None and held["tail"] + row["head"] not in LEGAL
            held["tail"] = row["tail"]
        for name in ("illegal", "blank", "duplicate", "truncated", "cost"):
            held[name] += row[name]
        held["audit"].append(row["audit"])
        for role, text in zip(row["roles"], row["texts"]):
            held["digest"].update(("\n" * (held["lines"] > 0) + f"{role}:{text}").encode())
            held["lines"] += 1

    def closed(held: dict) -> dict:
        done = {k: held[k] for k in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")}
        done |= {"gaps": gaps_of(held["low"], held["high"], held["turns"]), "audit": "".join(held["audit"])}
        return done | {"repaired_sha256": held["digest"].hexdigest()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _emitted(reports(batches), schema)

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return ordered.mapInArrow(task, REPORT)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A report per conversation, and the table of repaired pieces (see ``repaired_turns``).

    ``rows`` has conv_id, turn, role, text and dropped; dropped rows only say that their conversation exists.
    """
    pieces = cut(in_order(rows))
    whole, several = pieces.where("whole"), pieced(pieces.where("not whole"))
    lines = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
    span = F.col("high").cast("decimal(38,0)") - F.col("low") + 1 - F.col("turns")
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    done = whole.select(
        "conv_id",
        F.when(F.col("low").isNull(), 0).otherwise(F.least(span, most)).cast("long").alias("gaps"),
        *["blank", "duplicate", "truncated", "illegal", "cost", "audit"],
        F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256"),
    )
    return done.unionByName(along_pieces(several)), whole.unionByName(several)


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, the place of a turn as (part, seq, pos), role and text."""
    turns = F.arrays_zip("roles", "texts")
    rows = pieces.select("conv_id", "part", "seq", F.posexplode(turns).alias("pos", "turn"))
    return rows.select("conv_id", "part", "seq", "pos", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of every conversation after the stated damage."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repair(damaged(rows))[0]

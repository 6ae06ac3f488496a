r"""Conversation structure repair: the cheapest edits that make roles alternate, with an audit.

Each row of a conversation may be kept (K), given the role of a user or an assistant (R)
or deleted (D), and empty turns may be inserted (I), so that the roles' initials read
``(s?(ua)+)?``. Blank rows and copies of an earlier row must go. The audit is the string of
edits; of the cheapest ones it is the first in ASCII order. It comes from a persistent
audit DP (``trails``): edits share their beginnings as linked nodes with ancestors at
powers of two and rolling hashes, ties are decided at their longest common prefix, and
prefixes of equal hash are compared.

The DP is cut: rows are sorted in ranges, each task works out its rows in chunks, as a
table of costs and edits from each state the chunk may begin in to each it may end in, and
the chunks' tables follow one another in the DP of the whole. So a conversation with a
third of all rows is the work of many tasks, and a task holds one chunk. Only what is
sequential by nature, the order of the chunks and the digest of the repaired turns, is a
stream over one conversation, which holds its audit and one batch of rows.

Defined results: a null role or text is one space; rows of one turn (null is first) go by
a digest of role and text, equal rows one behind the other, so all but one are
duplicates; a role without a first letter s, u or a cannot be kept as it is; texts of any
length are digested and trimmed in their row; a conversation of which nothing is left has
an empty audit; a null conversation id is a conversation; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from martlane.llm.common import small_batches, written
from martlane.llm.trails import PRIME, STATES, START, Edits, applied

CHUNK_ROWS = 4096
SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
OUT_ROWS, OUT_CHARS = 1000, 4_000_000  # of a batch that a task gives out
LEGAL = ("su", "ua", "au")

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_NUMBER, _STRING = pa.int64(), pa.string()
_STEP = pa.struct([("start", _NUMBER), ("end", _NUMBER), ("cost", _NUMBER), ("audit", _STRING)])
KEPT = pa.schema([("conv_id", _NUMBER), ("place", _NUMBER), ("role", _STRING), ("text", _STRING)])
AUDITS = pa.schema([("conv_id", _NUMBER), *[(c, _NUMBER) for c in COUNTS], ("audit", _STRING)])
REPORT = AUDITS.append(pa.field("repaired_sha256", _STRING))
CHUNKS = pa.schema(
    [
        *[(c, _NUMBER) for c in ("conv_id", "chunk", "rows", "blank", "duplicate", "truncated", "illegal")],
        *[(c, _STRING) for c in ("first", "last")],
        *[(c, _NUMBER) for c in ("least", "most", "turns")],
        ("steps", pa.list_(_STEP)),
    ]
)


def _spark(schema: pa.Schema) -> StructType:
    return from_arrow_schema(schema)


def entries(conversations: DataFrame, times: Column | None = None) -> DataFrame:
    """Equal rows of one turn as one, with how often they are there and what is wrong with them."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(1) if times is None else times).cast("long").alias("times"),
    )
    both = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    equal = rows.groupBy("conv_id", "turn", F.sha2(both, 256).alias("print"))
    merged = equal.agg(
        F.first("role").alias("role"), F.first("text").alias("text"), F.sum("times").alias("times")
    )
    trimmed = F.rtrim("text", F.lit(SPACES))
    return merged.withColumn("blank", trimmed == "").withColumn(
        "cut", ~F.right(trimmed, F.lit(1)).isin(*ENDS)
    )


def _with_copies(rows: DataFrame) -> DataFrame:
    """Entries with ``copy``: whether an earlier turn of the conversation says the same."""
    spoken = rows.filter("times > 0 and not blank").groupBy("conv_id", "print")
    often = spoken.agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n"))
    often = often.filter("n > 1").alias("o")
    met = F.col("r.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("r.print") == F.col("o.print"))
    later = F.col("o.n").isNotNull() & ~F.col("r.turn").eqNullSafe(F.col("o.first.turn"))
    return rows.alias("r").join(often, met, "left").select("r.*", later.alias("copy"))


def _batches(rows: Iterable[tuple], schema: pa.Schema, sized: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size; ``sized`` is the column with the longest values."""

    def batch(held: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[sized])
        if len(held) == OUT_ROWS or size > OUT_CHARS:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _chunk(rows: list[tuple], starts: tuple[int, ...], prime: int) -> tuple:
    """The counts of a chunk, the initials and turns at its ends, and its table of edits."""
    n = blank = duplicate = truncated = illegal = turns = 0
    first = last = least = most = None
    every = [(start, Edits(start, prime)) for start in starts]
    for _, turn, initial, times, is_blank, cut, copy in rows:
        if not times:
            continue
        if turn is not None and turn != most:
            least, most, turns = (turn if least is None else least), turn, turns + 1
        illegal += times - (last is None or last + initial in LEGAL)
        first, last, n = (initial if first is None else first), initial, n + times
        forced = times if is_blank or copy else times - 1
        blank += times if is_blank else 0
        duplicate += 0 if is_blank else forced
        truncated += forced < times and cut
        for _, edits in every:
            if forced < times:
                edits.row(initial, cut)
            edits.delete(forced)
    steps = [(start, *step) for start, edits in every for step in edits.steps()]
    return n, blank, duplicate, truncated, illegal, first, last, least, most, turns, steps


def _chunker(chunk_rows: int, prime: int):
    """Chunks of sorted entries. Only a task's first conversation can have begun in an earlier range."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            number = TaskContext.get().partitionId() << 33
            for k, (conv, rows) in enumerate(groupby(_flat(batches), key=lambda r: r[0])):
                starts, held = (STATES if k == 0 else (START,)), []
                for row in rows:
                    if len(held) == chunk_rows:
                        yield conv, number, *_chunk(held, starts, prime)
                        number, starts, held = number + 1, STATES, []
                    held.append(row)
                yield conv, number, *_chunk(held, starts, prime)
                number += 1

        return _batches(found(), CHUNKS, -1)

    return chunks


def _whole(rows: Iterable[tuple], prime: int) -> tuple:
    """The counts, cost and audit of a conversation from its chunks in order."""
    edits = Edits(START, prime)
    total = [0, 0, 0, 0]
    last = least = most = None
    turns = 0
    for _, _, n, blank, duplicate, truncated, illegal, first, end, low, high, own, steps in rows:
        if not n:
            continue
        illegal += last is not None and last + first not in LEGAL
        total = [a + b for a, b in zip(total, (blank, duplicate, truncated, illegal), strict=True)]
        last = end
        if low is not None:
            turns += own - (low == most)
            least, most = (low if least is None else least), high
        table: dict[int, list] = {}
        for step in steps:
            table.setdefault(step["start"], []).append((step["end"], step["cost"], step["audit"]))
        edits.follow(table)
    gaps = 0 if least is None else most - least + 1 - turns
    return gaps, *total, *edits.cheapest()


def _joiner(prime: int):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = groupby(_flat(batches), key=lambda r: r[0])
        return _batches(((conv, *_whole(rows, prime)) for conv, rows in groups), AUDITS, -1)

    return join


def audits(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, prime: int = PRIME) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of written entries."""
    conv = F.col("conv_id").asc_nulls_first()
    order = [conv, F.col("turn").asc_nulls_first(), F.col("print").asc()]
    narrow = _with_copies(rows.drop("text")).select(
        *("conv_id", "turn", "print", F.left("role", F.lit(1)).alias("initial")),
        *("times", "blank", "cut", "copy"),
    )
    in_order = narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("print")
    chunks = written(in_order.mapInArrow(_chunker(chunk_rows, prime), _spark(CHUNKS)), "repair-chunks")
    dealt = chunks.repartition("conv_id").sortWithinPartitions(conv, "chunk")
    return dealt.mapInArrow(_joiner(prime), _spark(AUDITS))


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit row, then its entries in order."""
    heads = found.withColumnRenamed("audit", "text").withColumn("is_row", F.lit(0))
    lines = rows.select("conv_id", "turn", "print", "role", "text", "times").withColumn("is_row", F.lit(1))
    both = heads.unionByName(lines, allowMissingColumns=True).repartition("conv_id")
    both = both.sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "is_row", F.col("turn").asc_nulls_first(), "print"
    )
    return both.select("conv_id", "role", "text", "times", *COUNTS)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, counts, audit, its repaired turns), one after another."""
    for conv, rows in groupby(_flat(batches), key=lambda r: r[0]):
        _, _, audit, _, *counts = next(rows)
        yield conv, counts, audit, applied(audit, ((r[1], r[2], r[3]) for r in rows))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def turns() -> Iterator[tuple]:
        for conv, _, _, said in _conversations(batches):
            for place, (role, text) in enumerate(said):
                yield conv, place, role, text

    return _batches(turns(), KEPT, -1)


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def reports() -> Iterator[tuple]:
        for conv, counts, audit, said in _conversations(batches):
            digest = hashlib.sha256()
            for place, (role, text) in enumerate(said):
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            yield conv, *counts, audit, digest.hexdigest()

    return _batches(reports(), REPORT, -2)


def _prepared(conversations: DataFrame, times: Column | None, chunk_rows: int, prime: int) -> DataFrame:
    small_batches(conversations.sparkSession)
    rows = written(entries(conversations, times), "repair-entries")
    return _with_audits(rows, audits(rows, chunk_rows, prime))


def repaired(
    conversations: DataFrame,
    times: Column | None = None,
    chunk_rows: int = CHUNK_ROWS,
    prime: int = PRIME,
) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), role and text.

    ``times`` says how often each row stands there, one behind the other; 0 leaves it out.
    """
    return _prepared(conversations, times, chunk_rows, prime).mapInArrow(_repaired, _spark(KEPT))


def report(
    conversations: DataFrame,
    times: Column | None = None,
    chunk_rows: int = CHUNK_ROWS,
    prime: int = PRIME,
) -> DataFrame:
    """Per conversation what was wrong, the cheapest cost, the audit and a digest of what is left."""
    return _prepared(conversations, times, chunk_rows, prime).mapInArrow(_reported, _spark(REPORT))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the CRC-32 of conv_id and turn; ``times`` is 0, 1 or 2."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(known("text"), ".!?", ""))
    gone = kind == 0
    return conversations.select(
        *("conv_id", "turn"),
        F.when(gone, "").when(kind == 4, "user").otherwise(known("role")).alias("role"),
        F.when(gone, "").otherwise(text.otherwise(known("text"))).alias("text"),
        F.when(gone, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )

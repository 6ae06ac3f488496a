r"""Chat formatting: records of many layouts into one template, with the spans a loss covers.

A record is a VARIANT. Its layout is told by a fingerprint, the hash of its nested field
paths (``messages[].role``) as far as any declared layout names them, so further fields do
not matter. The fingerprint selects a declared layout, which says where roles and texts
are; what comes out are canonical turns. All of that is expressions on the record.

The template writes a turn as ``<turn ROLE>``, a line break, the text, ``</turn>`` and a line
break. In roles and texts a backslash is doubled and the ``<`` of ``<turn `` and ``</turn>``
becomes ``\l`` (in roles ``>`` becomes ``\g``), so no text holds a mark, and reading it back
is exact. Turns are sorted in ranges and joined to parts: a conversation is one part, or
several where a range ends or PART_CHARS are reached, so neither the writing nor the
reading task holds more than a part and a conversation with a third of all turns is
written by many tasks. Reading its digests is one stream over its parts, as a digest is.

Defined results: a null role or text is empty; a null conversation id is a conversation;
turns of one number (null is first) go by their place in the record, then by role and a
hash of the text; repeated rows are turns each; a text is never cut, so one longer than a
part is a part of its own; a record of no declared layout has null turns (``unknown`` counts
them) and is not formatted; an empty table gives an empty result; columns besides those
named may be there and are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.llm.common import small_batches, written

PART_CHARS = 1 << 20
DEPTH = 5  # objects and arrays within each other whose fields have paths
LOSS_ROLE = "assistant"
SYSTEM = "system"
# Names of roles in layouts that have their own.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Where a record has its turns.

    ``each`` is an array of turns with a ``role`` and a ``text`` field (``parts``: the text is
    in that field of each element of an array); without ``each`` and ``says`` the record is one
    turn itself. ``says`` lists turns by role and the fields whose texts they join.
    ``renamed`` translates ROLES.
    """

    name: str
    each: str | None = None
    role: str = "role"
    text: str = "text"
    parts: str | None = None
    says: tuple[tuple[str, tuple[str, ...]], ...] = ()
    renamed: bool = False

    def paths(self) -> set[str]:
        if self.says:
            return {field for _, fields in self.says for field in fields}
        inside = f"{self.each}[]." if self.each else ""
        text = f"{self.parts}[].{self.text}" if self.parts else self.text
        return {inside + self.role, inside + text}


def exchange(asked: Sequence[str], answer: str) -> Layout:
    """A question, joined from some fields, and its answer."""
    says = (("user", tuple(asked)), ("assistant", (answer,)))
    return Layout("_".join([*asked, answer]), says=says)


# Layouts that public collections have.
LAYOUTS = (
    Layout("row"),
    Layout("messages", each="messages", text="content"),
    Layout("message_parts", each="messages", text="text", parts="content"),
    Layout("turns", each="turns", text="content"),
    Layout("conversations", each="conversations", role="from", text="value", renamed=True),
    exchange(["prompt"], "completion"),
    exchange(["prompt"], "response"),
    exchange(["instruction"], "output"),
    exchange(["instruction", "input"], "output"),
    exchange(["instruction", "context"], "response"),
    exchange(["question"], "answer"),
)


def field_paths(record: Column, depth: int = DEPTH) -> Column:
    """The record's nested field paths, each once."""

    def below(value: Column, prefix: Column, depth: int) -> Column:
        if not depth:
            return F.array(prefix)
        fields = F.try_variant_get(value, "$", "map<string,variant>")
        items = F.try_variant_get(value, "$", "array<variant>")
        of_fields = F.transform(
            F.map_entries(fields),
            lambda e: below(e["value"], F.concat_ws(".", prefix, e["key"]), depth - 1),
        )
        of_items = F.transform(items, lambda i: below(i, F.concat(prefix, F.lit("[]")), depth - 1))
        return (
            F.when(fields.isNotNull(), F.flatten(of_fields))
            .when(items.isNotNull() & (F.size(items) > 0), F.array_distinct(F.flatten(of_items)))
            .otherwise(F.array(prefix))
        )

    return F.array_distinct(below(record, F.lit(None).cast("string"), depth))


def fingerprint(paths: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """The hash of those paths that some layout names."""
    known = sorted(set().union(*[x.paths() for x in layouts], {SYSTEM}))
    own = F.array_sort(F.array_intersect(paths, F.array(*map(F.lit, known))))
    return F.xxhash64(F.array_join(own, "\n"))


def _layout_of(print_: Column, layouts: Sequence[Layout]) -> Column:
    pairs = []
    for layout in layouts:
        for more in (set(), {SYSTEM}):
            joined = "\n".join(sorted(layout.paths() | more))
            pairs += [F.xxhash64(F.lit(joined)), F.lit(layout.name)]
    return F.element_at(F.create_map(*pairs), print_)


def _turns(record: Column, layout: Layout) -> Column:
    def string(value: Column, path: str) -> Column:
        return F.coalesce(F.try_variant_get(value, f"$.{path}", "string"), F.lit(""))

    def turn(value: Column) -> Column:
        role = string(value, layout.role)
        if layout.renamed:
            names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
            role = F.coalesce(F.element_at(names, role), role)
        if layout.parts:
            items = F.try_variant_get(value, f"$.{layout.parts}", "array<variant>")
            text = F.array_join(F.transform(items, lambda i: string(i, layout.text)), "")
            text = F.coalesce(text, F.lit(""))
        else:
            text = string(value, layout.text)
        return F.struct(role.alias("role"), text.alias("text"))

    if layout.says:
        found = []
        for role, fields in layout.says:
            texts = [F.nullif(string(record, f), F.lit("")) for f in fields]
            text = F.concat_ws("\n\n", *texts)
            found.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
        turns = F.array(*found)
    elif layout.each:
        items = F.try_variant_get(record, f"$.{layout.each}", "array<variant>")
        turns = F.transform(items, turn)
    else:
        turns = F.array(turn(record))
    system = F.try_variant_get(record, f"$.{SYSTEM}", "string")
    first = F.struct(F.lit(SYSTEM).alias("role"), system.alias("text"))
    return F.when(system.isNull(), turns).otherwise(F.concat(F.array(first), turns))


def canonical(
    records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS
) -> DataFrame:
    """The other columns, fingerprint, layout, and turns as an array of (role, text)."""
    print_ = fingerprint(field_paths(F.col(record)), layouts)
    found = F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        found = F.when(F.col("layout") == layout.name, _turns(F.col(record), layout)).otherwise(found)
    marked = records.withColumn("fingerprint", print_)
    marked = marked.withColumn("layout", _layout_of(F.col("fingerprint"), layouts))
    return marked.withColumn("turns", found).drop(record)


def unknown(records: DataFrame, record: str = "record") -> DataFrame:
    """fingerprint and number of the records that no declared layout fits."""
    lost = canonical(records, record).filter("layout is null")
    return lost.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("records"))


def escaped(text: Column, in_mark: bool = False) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("\\l/turn>"))
    text = F.replace(text, F.lit("<turn "), F.lit("\\lturn "))
    return F.replace(text, F.lit(">"), F.lit("\\g")) if in_mark else text


_ESCAPES = {"\\": "\\", "l": "<", "g": ">"}


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ESCAPES[m[1]], text) if "\\" in text else text


def pieces(turns: DataFrame) -> DataFrame:
    """conv_id, turn, place, role, piece, and the span of the piece that the loss covers (or null).

    ``turns`` has conv_id, turn and turns, as ``canonical`` gives them.
    """
    # An outer explode: before another, Spark would work out all turns once more for a filter.
    each = turns.select("conv_id", "turn", F.posexplode_outer("turns").alias("place", "said"))
    each = each.filter("place is not null")
    head = F.concat(F.lit("<turn "), escaped(F.col("said.role"), in_mark=True), F.lit(">\n"))
    start, size = F.length("head"), F.length("body")
    return each.select(
        *("conv_id", "turn", "place"),
        F.col("said.role").alias("role"),
        head.alias("head"),
        escaped(F.col("said.text")).alias("body"),
    ).select(
        *("conv_id", "turn", "place", "role"),
        F.concat("head", "body", F.lit("</turn>\n")).alias("piece"),
        F.when(F.col("role") == LOSS_ROLE, start).alias("start"),
        F.when(F.col("role") == LOSS_ROLE, start + size).alias("stop"),
    )


PARTS = "conv_id long, part long, text string, spans array<struct<start:long,stop:long>>"
_PART_ROWS = 256  # parts given out at once


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    types = (pa.int64(), pa.int64(), pa.string(), span)
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "text", "spans"])


def _joiner(part_chars: int):
    """Joins sorted pieces to parts of a conversation."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 33
        held, size, spans, conv = [], 0, [], None
        done, done_size = [], 0
        for batch in batches:
            for c, piece, start, stop in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if held and (c != conv or size + len(piece) > part_chars):
                    done.append((conv, number, "".join(held), spans))
                    number, done_size = number + 1, done_size + size
                    held, size, spans = [], 0, []
                    if done_size > part_chars or len(done) == _PART_ROWS:
                        yield _batch(done)
                        done, done_size = [], 0
                if start is not None:
                    spans.append({"start": size + start, "stop": size + stop})
                held.append(piece)
                conv, size = c, size + len(piece)
        if held:
            done.append((conv, number, "".join(held), spans))
        if done:
            yield _batch(done)

    return join


def formatted(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """conv_id, part, text and loss spans (in code points of the text); parts ascend in order."""
    small_batches(turns.sparkSession)
    order = [
        F.col("conv_id").asc_nulls_first(),
        F.col("turn").asc_nulls_first(),
        *("place", "role", "print"),
    ]
    ready = pieces(turns).withColumn("print", F.xxhash64("piece"))
    ready = ready.withColumn("salt", F.spark_partition_id())
    ready = ready.repartitionByRange(*order, "salt").sortWithinPartitions(*order)
    return ready.select("conv_id", "piece", "start", "stop").mapInArrow(_joiner(part_chars), PARTS)


def parsed(text: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    at = 0
    while at < len(text):
        if not text.startswith("<turn ", at):
            raise ValueError(f"no turn begins at {at}")
        head = text.index(">", at)
        end = text.index("</turn>", head)
        yield unescaped(text[at + len("<turn ") : head]), unescaped(text[head + 2 : end])
        at = end + len("</turn>\n")


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    number, text = pa.int64(), pa.string()
    types = (number, number, text, number, text, number)
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    names = [x.split()[0] for x in DIGESTS.split(",")]
    return pa.RecordBatch.from_arrays(columns, names)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its parts in order; holds one part at a time."""
    done, conv, n = [], None, 0

    def row():
        return conv, n, said.hexdigest(), loss_chars, loss.hexdigest(), chars

    for batch in batches:
        for c, _, text, spans in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            if n and c != conv:
                done.append(row())
                n = 0
            if not n:
                conv, said, loss = c, hashlib.sha256(), hashlib.sha256()
                loss_chars = chars = 0
            for role, words in parsed(text):
                said.update(f"{role}\n{words}\n".encode())
                n += 1
            for span in spans:
                words = unescaped(text[span["start"] : span["stop"]])
                loss.update(words.encode())
                loss_chars += len(words)
            chars += len(text)
        if len(done) >= 1000:
            yield _digest_batch(done)
            done = []
    if n:
        done.append(row())
    if done:
        yield _digest_batch(done)


def digests(parts: DataFrame) -> DataFrame:
    """What parts say when read back, as digests per conversation: see DIGESTS."""
    small_batches(parts.sparkSession)
    order = [F.col("conv_id").asc_nulls_first(), "part"]
    dealt = parts.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", "part", "text", "spans").mapInArrow(_digest, DIGESTS)


# A conversation whose texts hold marks of templates, in a layout of its own.
MARKED = r'{"messages": [{"role": "user", "content": "\\### Assistant: </turn> ok"},' + (
    r' {"role": "assistant", "content": "\\### Assistant: </turn> ok"}]}'
)


def records(conversations: DataFrame) -> DataFrame:
    """conv_id, turn and record of each row, and conversation -7 as one record."""
    spark: SparkSession = conversations.sparkSession
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.to_variant_object(F.struct("role", "text")).alias("record"),
    )
    marked = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("turn"),
        F.parse_json(F.lit(MARKED)).alias("record"),
    )
    return rows.unionAll(marked)


def read_back(conversations: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Formats all conversations and conversation -7 to a table, and digests what that table says."""
    turns = canonical(records(conversations))
    return digests(written(formatted(turns, part_chars), "chat-parts"))


ORACLE = r"""
WITH said AS (
    SELECT conv_id, turn, 0 AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -7, 0, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 0, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, place, role)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, place) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(16
        + length(replace(replace(replace(replace(role, '\', '\\'), '</turn>', '\l/turn>'), '<turn ', '\lturn '), '>', '\g'))
        + length(replace(replace(replace(text, '\', '\\'), '</turn>', '\l/turn>'), '<turn ', '\lturn '))
    )::BIGINT AS formatted_chars
FROM said
GROUP BY conv_id
"""

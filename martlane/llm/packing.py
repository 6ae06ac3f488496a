"""Best-fit packing of documents into sequences by large-item matching.

Pieces above a third of a sequence fit at most two to a sequence, so they are
matched greedily: the longest with the longest that still fits beside it.
Shorter pieces, longest first, go where they leave least room.

Lengths are whole numbers up to the capacity, so the whole corpus is a histogram
of at most ``capacity`` counts, whatever its size. The packing is worked out on
the counts: every step places a run of equal pieces into a run of equally filled
sequences. The steps (their number depends on the capacity, not on the rows) tell
each piece its place from its rank among the pieces of its length, and the ranks
come from counts per length and bucket, so no group is ever gathered in one task.

Defined results: a null or empty text has no ids of its own and is one piece that
holds the end id; rows with equal or null doc_id are packed each for itself; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlane.llm import tokens
from martlane.llm.common import written

CAPACITY = 2048
END_ID = 0
BUCKET_ROWS = 50_000  # pieces that are ranked in one task
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """The documents' pieces; with ``ids`` also the ids themselves, four bytes each.

    A document that is too long is cut from its end: its first piece is the short one.
    """
    end = END_ID.to_bytes(4, "little")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokens.encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc, own in zip(batch["doc_id"], encoder.ids(batch["text"]), strict=True):
                coded = own + end
                n = len(coded) // 4
                start = 0
                for piece in range(-(-n // capacity)):
                    stop = n - capacity * (-(-n // capacity) - 1 - piece)
                    part = coded[4 * start : 4 * stop]
                    rows.append((doc, piece, start, stop - start, zlib.crc32(part), part))
                    start = stop
            columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            frame = pd.DataFrame(rows, columns=columns)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame if ids else frame.drop(columns="ids")

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return texts.mapInPandas(pieces, PIECES + ", ids binary" * ids)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Steps (length, first rank, first sequence, pieces a sequence, offset) and the number of
    sequences, for so many pieces of each length."""
    steps: list[tuple[int, int, int, int, int]] = []
    left = dict(counts)
    rank = dict.fromkeys(counts, 0)
    gaps: list[int] = []
    rooms: dict[int, list[tuple[int, int]]] = {}
    n_bins = 0

    def put(length: int, pieces: int, first: int, each: int, offset: int) -> None:
        steps.append((length, rank[length], first, each, offset))
        rank[length] += pieces
        left[length] -= pieces

    def room(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in rooms:
                rooms[gap] = []
                insort(gaps, gap)
            rooms[gap].append((first, n))

    large = sorted(x for x in counts if 3 * x > capacity)
    for a in reversed(large):
        while left[a]:
            at = bisect_left(large, min(a, capacity - a) + 1) - 1
            while at >= 0 and (not left[large[at]] or large[at] == a and left[a] < 2):
                at -= 1
            if at < 0:
                n, gap = left[a], capacity - a
                put(a, n, n_bins, 1, 0)
            else:
                b = large[at]
                n, gap = left[a] // 2 if a == b else min(left[a], left[b]), capacity - a - b
                put(a, n, n_bins, 1, 0)
                put(b, n, n_bins, 1, a)
            room(gap, n_bins, n)
            n_bins += n
    for s in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        while left[s]:
            at = bisect_left(gaps, s)
            if at == len(gaps):
                n = -(-left[s] // (capacity // s))
                gap, first = capacity, n_bins
                n_bins += n
            else:
                gap = gaps[at]
                first, n = rooms[gap].pop()
                if not rooms[gap]:
                    del rooms[gap]
                    gaps.pop(at)
            each = gap // s
            full = min(n, left[s] // each)
            if full:
                put(s, full * each, first, each, capacity - gap)
                room(gap - each * s, first, full)
            if full < n and 0 < left[s] < each:
                rest = left[s]
                put(s, rest, first + full, rest, capacity - gap)
                room(gap - rest * s, first + full, 1)
                full += 1
            room(gap, first + full, n - full)
    table = np.array(sorted(steps), dtype=np.int64).reshape(-1, 5)
    return table, n_bins


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (a written table with a ``length``) with sequence_id and offset."""
    count = pieces.count()
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(-(-count // BUCKET_ROWS) or 1))
    dealt = pieces.withColumn("bucket", bucket)
    each = written(
        dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "pack-counts"
    )
    counts = {
        row["length"]: row["n"]
        for row in each.groupBy("length").agg(F.sum("n").alias("n")).collect()  # <= capacity rows
    }
    steps, _ = plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("bucket")
    starts = each.select("length", "bucket", (F.sum("n").over(before) - F.col("n")).alias("first"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", *pieces.columns[2:5])
    ranked = (
        dealt.withColumn("place", F.row_number().over(order))
        .join(starts, ["length", "bucket"])
        .withColumn("rank", F.col("first") + F.col("place") - 1)
    )
    lengths, ranks = steps[:, 0], steps[:, 1]
    low = np.searchsorted(lengths, np.arange(capacity + 2))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, own = length.to_numpy(), rank.to_numpy()
        # Steps are sorted by (length, first rank): one search in a joint key finds each step.
        span = max(int(own.max(initial=0)), int(ranks.max(initial=0))) + 1
        at = np.searchsorted(lengths * span + ranks, size * span + own, side="right") - 1
        assert (low[size] <= at).all()
        step = steps[at]
        nth = own - step[:, 1]
        return pd.DataFrame(
            {
                "sequence_id": step[:, 2] + nth // step[:, 3],
                "offset": step[:, 4] + nth % step[:, 3] * size,
            }
        )

    return ranked.withColumn("at", place("length", "rank")).select(
        *pieces.columns, "at.sequence_id", "at.offset"
    )


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return placed(written(cut(docs, vocabulary, capacity), "pack-pieces"), capacity)

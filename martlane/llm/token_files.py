"""Token ids of a corpus as files of Simple-8b words, in ascending doc_id order.

The documents are dealt by ranges of doc_id, each range is encoded and coded by
one task and becomes one shard. A file row is a block of whole documents: their
ids and lengths, the coded ids, and where each stretch of them begins. Spark
writes and reads the rows, so a lost executor's shard is simply written again.

Defined results: a null or empty text has the end id only; rows with equal
doc_id stay rows of their own, ordered by their text's fingerprint; null ids come
first; an empty table gives files without blocks; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlane.llm import simple8b, tokens
from martlane.llm.common import parts

END_ID = 2
BLOCK_IDS = 65_536  # a block is closed once it holds so many ids
BLOCKS = (
    "shard int, block int, first long, n_ids long, doc_ids array<long>, nulls int, "
    "lengths array<long>, stretches array<long>, words binary"
)
DIGESTS = "shard int, doc_id long, place long, n_tokens long, ids_crc32 long"


def write(docs: DataFrame, vocabulary: str, path: str) -> None:
    """Encodes every whole text, appends the end id, and writes the coded shards."""
    end = END_ID.to_bytes(4, "little")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokens.encoder(vocabulary)
        shard, block, first = 0, 0, 0
        ids: list[int] = []
        nulls = 0  # documents without an id; they come first of all
        coded: list[bytes] = []
        held = 0

        def closed() -> pd.DataFrame:
            words, stretches = simple8b.encode(np.frombuffer(b"".join(coded), "<u4"))
            row = {
                **{"shard": shard, "block": block, "first": first, "n_ids": held // 4},
                **{"doc_ids": ids, "nulls": nulls, "lengths": [len(x) // 4 for x in coded]},
                **{"stretches": stretches, "words": words.astype("<u8").tobytes()},
            }
            return pd.DataFrame([row])

        for batch in batches:
            for doc, known, at, own in zip(
                *(batch["doc_id"], batch["known"], batch["shard"], encoder.ids(batch["text"])),
                strict=True,
            ):
                shard = at
                ids.append(doc)
                nulls += not known
                coded.append(own + end)
                held += len(own) + 4
                if held >= 4 * BLOCK_IDS:
                    yield closed()
                    first += held // 4
                    block, ids, coded, held, nulls = block + 1, [], [], 0, 0
        if ids:
            yield closed()

    n = parts(docs.sparkSession)
    ordered = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        )
        .repartitionByRange(n, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .select(
            F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
            F.col("doc_id").isNotNull().alias("known"),
            *("text", F.spark_partition_id().alias("shard")),
        )
    )
    ordered.mapInPandas(blocks, BLOCKS).write.parquet(path)


def _ids(row) -> np.ndarray:
    words = np.frombuffer(row.words, "<u8").astype(np.uint64)
    return simple8b.decode(words, np.asarray(row.stretches), int(row.n_ids))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, as the files have them."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids = _ids(row).astype("<u4").tobytes()
                lengths = np.asarray(row.lengths)
                place = np.cumsum(lengths) - lengths
                crcs = [
                    zlib.crc32(ids[4 * a : 4 * (a + n)])
                    for a, n in zip(place, lengths, strict=True)
                ]
                docs = pd.array(row.doc_ids, "Int64")
                docs[: row.nulls] = pd.NA
                yield pd.DataFrame(
                    {
                        **{"shard": row.shard, "doc_id": docs, "place": row.first + place},
                        **{"n_tokens": lengths, "ids_crc32": crcs},
                    }
                )

    blocks = spark.read.schema(BLOCKS).parquet(path)
    # One row per shard, far fewer than documents.
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return (
        blocks.mapInPandas(digests, DIGESTS)
        .join(bases, "shard")
        .select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
    )

"""Cross-entropy difference of matched n-gram models.

A target model is counted from chosen documents, a background model from all of
them. Both share one vocabulary, one list of word pairs and one smoothing, and the target
counts are added to a few counts' worth of the background's shares, so the
difference of their losses on a document, per word, says how much more it is like
the target than like the rest, and nothing of how rare its words are.

The vocabulary are all words that occur twice or more in the documents, the pairs all
those of neighbouring words that do. What occurs once stands in the scored document only
and counts as unknown.

1. Texts are put together to chunks of CHUNK_BYTES, a written table.
2. Each chunk counts its words and pairs and sends its distinct ones, packed, to
   ranges of their numbers. There are as many ranges as keep one at about RANGE_WORDS
   words of text, so a common word is one number of each chunk and no range grows.
3. A range adds up what all chunks sent and answers each with the totals of its numbers.
4. Each chunk meets its answers and scores its documents. Nothing but three sums of all
   ranges passes the driver.

Defined results: a null or empty text, or one without words, has no losses and
score 0; rows with equal doc_id are scored each for itself; a document is a target
if its id is among the targets' (nulls are not); without targets the two models are
one and all scores are 0; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import documents, parts, side, written
from martlane.llm.hashed_words import mixed, runs, words

CHUNK_BYTES = 5_000_000  # text that is counted together
RANGE_WORDS = 4_000_000  # words of text whose numbers a range gets, on average
PRIOR_WORDS = 1000.0  # words' worth of background shares that the target counts start from
PRIOR_PAIRS = 10.0  # the same after each word
KEPT = 0.5  # weight of the pair's own share beside the word's
KEY_BYTES = 6  # of a number, besides the bits that say its range
WORD_BIT = 16  # set in the numbers of words and not in those of pairs; among the bits that are sent
CHUNKS = "n_words long, ids binary, nulls binary, targets binary, sizes binary, texts binary"
COUNTS = "part int, chunk long, keys binary, n binary, n_target binary"
ANSWERS = (
    "chunk long, part int, n binary, n_target binary, n_known long, known long, known_target long"
)
RESULT = (
    "doc_id long, n_words long, background_loss double, target_loss double, score double, "
    "is_target boolean"
)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * np.uint64(0x9E6C63D0876A9A47) + right)


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, the sum of each one's counts, and the place of every key."""
    order = np.argsort(keys, kind="stable")
    own = keys[order]
    new = np.concatenate([[True], own[1:] != own[:-1]])
    first = np.flatnonzero(new)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return (own[first], *(np.add.reduceat(x[order], first) for x in counts), place)


def packed_keys(keys: np.ndarray, bits: int) -> bytes:
    """The bytes below the range bits, one plane after the other (sorted ones pack well)."""
    rest = (keys << np.uint64(bits)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return rest[:, :KEY_BYTES].T.tobytes()


def unpacked_keys(data: bytes) -> np.ndarray:
    own = np.frombuffer(data, np.uint8).reshape(KEY_BYTES, -1)
    out = np.zeros((own.shape[1], 8), np.uint8)
    out[:, :KEY_BYTES] = own.T
    return out.view(">u8").ravel().astype(np.uint64)


def packed_counts(n: np.ndarray) -> bytes:
    """One byte for each count; those of 255 and more follow whole, and how many these are."""
    large = n >= 255
    low = np.where(large, 255, n).astype(np.uint8)
    return low.tobytes() + n[large].astype("<i8").tobytes() + int(large.sum()).to_bytes(8, "little")


def unpacked_counts(data: bytes) -> np.ndarray:
    n_large = int.from_bytes(data[-8:], "little")
    size = len(data) - 8 - 8 * n_large
    n = np.frombuffer(data, np.uint8, size).astype(np.int64)
    n[n == 255] = np.frombuffer(data, "<i8", n_large, size)
    return n


def _chunks(texts: DataFrame) -> DataFrame:
    """The texts (doc_id, missing, bytes, target) in chunks, as a written table with a number for
    each."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        room = CHUNK_BYTES

        def flush() -> pd.DataFrame:
            ids, nulls, targets, texts = zip(*held, strict=True)
            row = (
                *(sum(len(x.split()) for x in texts), np.array(ids, np.int64).tobytes()),
                *(np.array(nulls, bool).tobytes(), np.array(targets, bool).tobytes()),
                np.array([len(x) for x in texts], np.int64).tobytes(),
                pa.compress(b"".join(texts), "zstd", asbytes=True),
            )
            return pd.DataFrame([row], columns=[c.split()[0] for c in CHUNKS.split(", ")])

        for batch in batches:
            for row in batch[["doc_id", "missing", "target", "bytes"]].itertuples(index=False, name=None):
                held.append(row)
                room -= len(row[-1]) + 32
                if room <= 0:
                    yield flush()
                    held, room = [], CHUNK_BYTES
        if held:
            yield flush()

    numbered = texts.mapInPandas(rows, CHUNKS).withColumn("chunk", F.monotonically_increasing_id())
    return written(numbered, "lm-chunks")


class Chunk:
    """A chunk's words and pairs: their numbers, documents, and which words begin one."""

    def __init__(self, row):
        self.nulls = np.frombuffer(row.nulls, bool)
        self.ids = np.frombuffer(row.ids, np.int64)
        self.targets = np.frombuffer(row.targets, bool)
        sizes = np.frombuffer(row.sizes, np.int64)
        data = pa.decompress(row.texts, int(sizes.sum()), "zstd", asbytes=True)
        stops = np.cumsum(sizes)
        texts = [data[a:b] for a, b in zip((stops - sizes).tolist(), stops.tolist(), strict=True)]
        found = [words(run) for run in runs(texts)]
        own = np.concatenate([x for x, _ in found])
        self.n_words = np.concatenate([np.diff(cuts) for _, cuts in found])
        self.of = np.repeat(np.arange(len(texts)), self.n_words)
        self.begins = np.ones(len(own), bool)
        self.begins[1:] = self.of[1:] != self.of[:-1]
        self.after = np.flatnonzero(~self.begins)
        pairs = pair_keys(own[self.after - 1], own[self.after])
        is_word = np.uint64(1 << WORD_BIT)
        self.keys = np.concatenate([own | is_word, pairs & ~is_word])

    def marks(self) -> np.ndarray:
        """Whether each number's document is a target."""
        marks = self.targets[self.of]
        return np.concatenate([marks, marks[self.after]]).astype(np.int32)

    def losses(self, n: np.ndarray, n_target: np.ndarray, totals: tuple) -> list[np.ndarray]:
        """Of the background and of the target model, word by word, from all numbers' totals;
        unknown words and pairs, with totals of 0, are as likely in both."""
        n_known, known, known_target = totals
        size = len(self.of)
        n, n_target = n.astype(np.float64), n_target.astype(np.float64)
        unknown = n[:size] == 0
        single = (n[:size] + 1) / (known + n_known + 1)
        target = (n_target[:size] + PRIOR_WORDS * single) / (known_target + PRIOR_WORDS)
        share, target_share = np.zeros(size), np.zeros(size)
        left = self.after - 1
        background = np.minimum(n[size:] / np.maximum(n[left], 1), 1)
        share[self.after] = background
        mixed_in = (n_target[size:] + PRIOR_PAIRS * background) / (n_target[left] + PRIOR_PAIRS)
        target_share[self.after] = np.minimum(mixed_in, 1)
        models = [(single, share), (np.where(unknown, single, target), target_share)]
        return [-np.log(KEPT * np.where(unknown, 0, s) + (1 - KEPT) * x) for x, s in models]


def _counted(chunks: DataFrame, bits: int) -> DataFrame:
    """The distinct numbers of each chunk, with their counts, by range."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                chunk = Chunk(row)
                if not len(chunk.keys):
                    continue
                keys, n, n_target, _ = _summed(
                    chunk.keys, np.ones(len(chunk.keys), np.int32), chunk.marks()
                )
                cuts = _cuts(keys, bits)
                out = [
                    (
                        *(p, row.chunk, packed_keys(keys[a:b], bits)),
                        *(packed_counts(n[a:b]), packed_counts(n_target[a:b])),
                    )
                    for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                    if a < b
                ]
                yield pd.DataFrame(out, columns=["part", "chunk", "keys", "n", "n_target"])

    return chunks.mapInPandas(rows, COUNTS)


def _cuts(keys: np.ndarray, bits: int) -> list[int]:
    """Where the ranges begin in sorted keys, and the end."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return [0, *np.searchsorted(keys, edges).tolist(), len(keys)]


def _answers(counts: DataFrame, bits: int, partitions: int) -> DataFrame:
    """The totals of each chunk's numbers, range by range; 0 for numbers that occur once. The
    first answer of a range has the number and the counts of its known words."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []

        def out() -> pd.DataFrame:
            own = [unpacked_keys(x[1]) for x in held]
            keys = np.concatenate(own)
            n, n_target = (
                np.concatenate([unpacked_counts(x[c]) for x in held]) for c in (2, 3)
            )
            distinct, n, n_target, place = _summed(keys, n, n_target)
            n_target = np.where(n > 1, n_target, 0)
            n = np.where(n > 1, n, 0)
            is_word = (distinct >> np.uint64(WORD_BIT + bits)) & np.uint64(1)
            known = (n > 0) & is_word.astype(bool)
            sums = (int(known.sum()), int(n[known].sum()), int(n_target[known].sum()))
            stops = np.cumsum([len(x) for x in own])
            found = []
            for k, (x, stop) in enumerate(zip(held, stops.tolist(), strict=True)):
                at = place[stop - len(own[k]) : stop]
                both = (packed_counts(n[at]), packed_counts(n_target[at]))
                found.append((x[0], now, *both, *(sums if k == 0 else (0, 0, 0))))
            return pd.DataFrame(found, columns=[c.split()[0] for c in ANSWERS.split(", ")])

        for batch in batches:
            for part, *row in batch.itertuples(index=False, name=None):
                if part != now and held:
                    yield out()
                    held = []
                now = part
                held.append(row)
        if held:
            yield out()

    dealt = counts.repartition(partitions, "part").sortWithinPartitions("part")
    return written(dealt.mapInPandas(rows, ANSWERS), "lm-answers")


def score(docs: DataFrame, targets: DataFrame):
    """doc_id, n_words, background_loss, target_loss, score (their difference, higher: more like
    the target) and is_target; losses are per word."""
    ids = written(
        targets.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct(),
        "lm-targets",
    )
    marked = documents(docs).join(
        side(ids).withColumn("marked", F.lit(True)), "doc_id", "left"
    ).select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.isnull("doc_id").alias("missing"),
        "bytes", F.coalesce("marked", F.lit(False)).alias("target"),
    )
    chunks = _chunks(marked)
    n_words = chunks.agg(F.sum("n_words")).first()[0] or 0
    partitions = parts(docs.sparkSession)
    bits = max(4, (max(4 * partitions, n_words // RANGE_WORDS) - 1).bit_length())
    answers = _answers(_counted(chunks, bits), bits, partitions)
    sums = answers.agg(*(F.sum(c) for c in ("n_known", "known", "known_target"))).first()
    totals = tuple(x or 0 for x in sums)

    def scored(own: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk(next(own.itertuples(index=False)))
        # Ranges follow one another as the sorted numbers do.
        answered = answered.sort_values("part")
        found = []
        if len(chunk.keys):
            place = _summed(chunk.keys)[-1]
            n, n_target = (
                np.concatenate([unpacked_counts(x) for x in answered[c]])[place]
                for c in ("n", "n_target")
            )
            found = chunk.losses(n, n_target, totals)
        size = len(chunk.ids)
        sums = [np.bincount(chunk.of, x, size) for x in found] or [np.zeros(size)] * 2
        background, target = (x / np.maximum(chunk.n_words, 1) for x in sums)
        return pd.DataFrame(
            {
                "doc_id": pd.arrays.IntegerArray(chunk.ids.copy(), chunk.nulls.copy()),
                **{"n_words": chunk.n_words, "background_loss": background},
                **{"target_loss": target, "score": background - target},
                "is_target": chunk.targets,
            }
        )

    return (
        chunks.groupBy("chunk")
        .cogroup(answers.select("chunk", "part", "n", "n_target").groupBy("chunk"))
        .applyInPandas(scored, RESULT)
    )

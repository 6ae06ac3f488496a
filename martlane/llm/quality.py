"""Quality classifier on random-indexing word vectors.

Every word, and every word shape (its length and case, or the kind of sign it is),
has a sparse random index vector. The context vector of a word is the sum of the
index vectors of the words beside all its occurrences in all documents; words
share a bounded number of rows by hash. Context vectors, centred and set to unit
length, are averaged over a document's words. A network of two layers, trained
with numpy on a bounded number of labelled documents, turns the average into a
probability, and a temperature fitted on labelled documents that it has not seen
makes the probability an honest one.

Defined results: a null or empty text has the zero vector and gets the score the
network gives to that; rows with equal doc_id are scored each for itself; labels
that are null are left out, several of one document count by their mean; without
both labels every score is the share of 1 among the labels (0.5 without any); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import documents
from martlane.llm.hashed_words import mixed, powers, prefix_sums, runs

DIMS = 64
MARKS = 2  # entries of an index vector that are not zero
WORD_ROWS = 8192
SHAPE_ROWS = 64
ROWS = WORD_ROWS + SHAPE_ROWS
SLICES = 16  # of the table of context vectors, each summed by one task
HIDDEN = 32
EPOCHS = 60
MOST_LABELLED = 20_000  # labelled documents that the network is fitted on
CALIBRATING = 0.2  # share of them that fit the temperature instead
THRESHOLD = 0.7
SEED = 7

# Kinds of bytes: white space, letters, digits, signs, line ends.
_KIND = np.array(
    [
        4 if c == 10 else 0 if c in b" \t\r\x0b\x0c"
        else 1 if c >= 128 or chr(c).isalpha() else 2 if 48 <= c <= 57 else 3
        for c in range(256)
    ],
    np.uint8,
)


def _index() -> tuple[np.ndarray, np.ndarray]:
    """Columns and signs of the index vectors."""
    draw = np.random.default_rng(SEED)
    columns = draw.integers(0, DIMS, (ROWS, MARKS))
    return columns, draw.choice([-1.0, 1.0], (ROWS, MARKS))


def signs(run: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the words and of their shapes, and where each text's words begin (and the end)."""
    data = np.frombuffer(b" ".join(run) + b" ", np.uint8)
    kind = _KIND[data]
    edges = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts = np.concatenate([[0], edges])
    ends = np.concatenate([edges, [len(data)]])
    kept = kind[starts] != 0
    starts, ends = starts[kept], ends[kept]
    sums = prefix_sums(data)
    _, down = powers(len(data))
    words = mixed((sums[ends] - sums[starts]) * down[starts])
    repeated = np.zeros(len(words), bool)
    repeated[2:] = (words[2:] == words[:-2]) | (words[2:] == words[1:-1])
    repeated[1:2] = words[1:2] == words[:1]
    upper = (data >= 65) & (data <= 90)
    caps = np.concatenate([[0], np.cumsum(upper)])
    n_caps = caps[ends] - caps[starts]
    length = np.minimum(np.log2(ends - starts + 1).astype(np.int64), 4)
    case = np.where(n_caps == 0, 0, np.where(n_caps * 2 > ends - starts, 2, 1))
    shape = ((kind[starts].astype(np.int64) - 1) * 5 + length) * 3 + case
    shape = np.where(repeated, SHAPE_ROWS - 1, shape % (SHAPE_ROWS - 1))
    offsets = np.concatenate([[0], np.cumsum([len(x) + 1 for x in run])])
    rows = (words % np.uint64(WORD_ROWS)).astype(np.int64)
    return rows, WORD_ROWS + shape, np.searchsorted(starts, offsets)


def context_vectors(texts: DataFrame) -> np.ndarray:
    """The context vectors of all rows, from every document: ROWS x DIMS, centred, unit length."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns, sign = _index()
        table = np.zeros(ROWS * DIMS)
        seen = np.zeros(ROWS)
        for batch in batches:
            for run in runs(batch["bytes"]):
                words, shapes, cuts = signs(run)
                inner = np.ones(len(words), bool)
                inner[cuts[1:-1][cuts[1:-1] < len(words)]] = False  # first words have none before
                for kinds in (words, shapes):
                    seen += np.bincount(kinds, minlength=ROWS)
                    for others in (words, shapes):
                        for a, b in ((kinds[1:], others[:-1]), (kinds[:-1], others[1:])):
                            a, b = a[inner[1:]], b[inner[1:]]
                            for k in range(MARKS):
                                np.add.at(table, a * DIMS + columns[b, k], sign[b, k])
        own = np.concatenate([table.reshape(ROWS, DIMS), seen[:, None]], axis=1)
        each = ROWS // SLICES
        yield pd.DataFrame(
            {
                "slice": range(SLICES),
                "sums": [own[i * each : (i + 1) * each].tobytes() for i in range(SLICES)],
            }
        )

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, data in zip(batch["slice"], batch["sums"], strict=True):
                held[at] = held.get(at, 0) + np.frombuffer(data)
        yield pd.DataFrame({"slice": list(held), "sums": [x.tobytes() for x in held.values()]})

    found = (
        texts.select("bytes").mapInPandas(summed, "slice int, sums binary")
        .repartition(SLICES, "slice").mapInPandas(totals, "slice int, sums binary")
        .collect()  # SLICES rows, ROWS x (DIMS + 1) numbers whatever the corpus
    )
    if not found:
        return np.zeros((ROWS, DIMS), np.float32)
    whole = np.concatenate([np.frombuffer(x["sums"]) for x in sorted(found)]).reshape(ROWS, -1)
    sums, seen = whole[:, :-1], whole[:, -1:]
    vectors = sums / np.maximum(seen, 1)
    centred = np.where(seen > 0, vectors - sums.sum(0) / max(seen.sum(), 1), 0)
    long = np.linalg.norm(centred, axis=1, keepdims=True)
    return (centred / np.where(long > 0, long, 1)).astype(np.float32)


def pooled(texts, vectors: np.ndarray) -> np.ndarray:
    """Mean context vector of each text's words, and of their shapes."""
    found = []
    for run in runs(texts):
        words, shapes, cuts = signs(run)
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        n = np.maximum(np.diff(cuts), 1)[:, None]
        sums = [np.stack([vectors[rows[a:b]].sum(0) for a, b in spans]) for rows in (words, shapes)]
        found.append(np.concatenate(sums, axis=1) / n)
    return np.concatenate(found) if found else np.zeros((0, 2 * DIMS))


class Network:
    """Two layers and a temperature."""

    def __init__(self, mean, scale, first, first_bias, second, second_bias, heat=1.0):
        self.mean, self.scale = mean, scale
        self.layers = [first, first_bias, second, second_bias]
        self.heat = heat

    def logits(self, x: np.ndarray) -> np.ndarray:
        first, first_bias, second, second_bias = self.layers
        return np.tanh((x - self.mean) / self.scale @ first + first_bias) @ second + second_bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.heat, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Trained on most rows, its temperature fitted on the others."""
    n, dims = x.shape
    if not n or y.min() == y.max():
        share = float(y.mean()) if n else 0.5
        logit = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        zero = np.zeros((dims, 1))
        return Network(np.zeros(dims), np.ones(dims), zero, np.zeros(1), np.zeros(1), logit)
    draw = np.random.default_rng(SEED)
    order = draw.permutation(n)
    held, train = order[: int(n * CALIBRATING)], order[int(n * CALIBRATING) :]
    scale = x[train].std(0)
    net = Network(
        *(x[train].mean(0), np.where(scale > 1e-9, scale, 1.0)),
        *(draw.normal(0, dims**-0.5, (dims, HIDDEN)), np.zeros(HIDDEN)),
        *(draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)),
    )
    z = (x - net.mean) / net.scale
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in net.layers]
    step = 0
    for epoch in range(EPOCHS):
        rows = draw.permutation(train)
        for batch in np.array_split(rows, max(1, len(rows) // 64)):
            first, first_bias, second, second_bias = net.layers
            hidden = np.tanh(z[batch] @ first + first_bias)
            p = 1 / (1 + np.exp(-np.clip(hidden @ second + second_bias, -30, 30)))
            off = (p - y[batch]) / len(batch)
            back = off[:, None] * second * (1 - hidden**2)
            slopes = [z[batch].T @ back + 1e-4 * first, back.sum(0), hidden.T @ off, off.sum()]
            step += 1
            rate = 3e-3 * (1 - epoch / EPOCHS) + 1e-5
            for i, slope in enumerate(slopes):
                m, v = moments[i]
                m += 0.1 * (slope - m)
                v += 0.001 * (np.square(slope) - v)
                fair = (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                net.layers[i] = net.layers[i] - rate * fair
    if len(held):
        logits, heats = net.logits(x[held]), np.geomspace(0.25, 8, 60)
        side = np.where(y[held] > 0.5, 1, -1)
        net.heat = float(min(heats, key=lambda t: np.logaddexp(0, -side * logits / t).mean()))
    return net


def _held_out(doc_id: str):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2


def _probability(docs: DataFrame, labels: DataFrame, label: str, most: int):
    """The trained score as a function of a column of whole texts."""
    texts = documents(docs)
    vectors = context_vectors(texts)
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.avg(F.col(label).cast("double")).alias("label"))
        .filter(~_held_out("doc_id"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = pooled(batch["bytes"], vectors)
            yield batch[["doc_id", "label"]].assign(x=list(x))

    # At most ``most`` rows, by the limit above.
    taught = texts.join(F.broadcast(known), "doc_id").mapInPandas(
        features, "doc_id long, label double, x array<double>"
    )
    rows = taught.toPandas().sort_values("doc_id", kind="stable")
    x = np.array(rows["x"].tolist()).reshape(len(rows), 2 * DIMS)
    net = fit(x, (rows["label"].to_numpy() >= 0.5).astype(float))

    @F.pandas_udf("double")
    def probability(text: pd.Series) -> pd.Series:
        return pd.Series(net.probability(pooled(text, vectors)))

    return lambda column: probability(F.coalesce(column, F.lit("")).cast("binary"))


def score(
    docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED
) -> DataFrame:
    """doc_id, held_out, score and predicted; one row per document, over its whole text.

    ``labels`` has doc_id and 0/1 in the column ``label``; rows that are held out teach nothing.
    """
    probability = _probability(docs, labels, label, most)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(_held_out("doc_id"), F.lit(False)).alias("held_out"),
        probability(F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(
    docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED
) -> DataFrame:
    """The documents that the classifier predicts to be good, with all their columns."""
    return docs.filter(_probability(docs, labels, label, most)(F.col("text")) >= THRESHOLD)

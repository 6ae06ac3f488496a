"""Removal of repeated substrings, with suffix arrays.

A byte goes when it lies in a string of LENGTH bytes that also starts in a document
with a smaller doc_id. All strings of that length are judged:

1. Every window of LENGTH bytes has an anchor, the piece of PIECE bytes in it with
   the least hash; equal windows have equal anchors. The windows of one anchor are a
   context. Tasks send a number for each anchor and one for its whole context, dealt
   by the anchor.
2. A context that also stands in an earlier document is covered. A context that is
   alone, but whose anchor also stands in other contexts, is open: it may begin or end
   a repetition. All others repeat nothing.
3. The bytes of open contexts meet by anchor, a few dozen bytes each. Windows that no
   other document has are put aside by hash; the rest, with the earliest contexts
   they may repeat, are sorted by suffix array in blocks of bounded size, and what
   is equal there over LENGTH bytes in an earlier document is covered. An anchor
   with more than GATHER bytes of contexts is a crowd: its contexts are dealt to groups
   of about that size, which learn from each other by hash which windows an earlier
   document has in another group, and get one copy of each such window.
4. Covered stretches meet their documents' texts. Up to BROADCAST_ROWS documents that may repeat
   something, or that do, other texts are not moved; above that, texts are moved twice:
   to the numbers of their contexts and to what is cut from them.

Defined results: a null text is empty; texts shorter than LENGTH repeat nothing;
documents with equal doc_id do not repeat one another; one without doc_id stays as it
is and is no source; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import documents, few, parts, side, written
from martlane.llm.hashed_words import mixed, powers, prefix_sums, runs
from martlane.llm.suffix_groups import suffix_array

LENGTH = 50
PIECE = 20
RUN_BYTES = 250_000
SEND_ANCHORS = 2_000_000  # anchors a task holds before it sends them
BLOCK = 32_768  # bytes that are sorted at once
GATHER = 1 << 20  # bytes of contexts that are compared by hash at once, about
_PLACE = np.uint64((1 << 28) - 1)
_LOW = np.uint64((1 << 40) - 1)


class Anchors:
    """The anchors of a run of texts: text, first window, last window, and their numbers."""

    def __init__(self, run: list[bytes]):
        data = np.frombuffer(b"".join(run), np.uint8)
        sizes = np.array([len(x) for x in run])
        self.begins = np.cumsum(sizes) - sizes
        empty = np.empty(0, np.int64)
        self.text = self.first = self.last = empty
        self.anchor = self.context = empty.astype(np.uint64)
        n = len(data) - LENGTH + 1
        if n <= 0:
            return
        sums = prefix_sums(data)
        _, down = powers(len(data))
        pieces = mixed((sums[PIECE:] - sums[:-PIECE]) * down[: len(data) - PIECE + 1])
        least = (pieces & ~_PLACE) | np.arange(len(pieces), dtype=np.uint64)
        span, width = 1, LENGTH - PIECE + 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: n], least[width - span : width - span + n])
        text = np.repeat(np.arange(len(run)), sizes)[:n]
        inside = np.flatnonzero(np.arange(n) + LENGTH <= (self.begins + sizes)[text])
        if not len(inside):
            return
        place = (least[inside] & _PLACE).astype(np.int64)
        of = text[inside]
        new = np.ones(len(inside), bool)
        new[1:] = (place[1:] != place[:-1]) | (of[1:] != of[:-1])
        at = np.flatnonzero(new)
        self.text = of[at]
        self.first = inside[at]
        self.last = inside[np.append(at[1:], len(inside)) - 1]
        self.anchor = pieces[place[at]]
        whole = (sums[self.last + LENGTH] - sums[self.first]) * down[self.first]
        self.context = mixed(whole + (place[at] - self.first).astype(np.uint64)) & _LOW

    def keys(self) -> np.ndarray:
        """One number for anchor and context."""
        return mixed((self.anchor >> np.uint64(24)) * np.uint64(0x9E6C63D0876A9A47) + self.context)


def _packed(numbers: np.ndarray) -> bytes:
    """The lower five bytes of each number."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    own = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(own), 8), np.uint8)
    out[:, :5] = own
    return out.view("<u8").ravel().astype(np.uint64)


def _flags(texts: DataFrame) -> DataFrame:
    """doc_id with the keys of its covered and of its open contexts; one row per document."""
    n = parts(texts.sparkSession)

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0

        def flush() -> pd.DataFrame:
            docs, anchors, contexts = (np.concatenate(x) for x in zip(*held, strict=True))
            deal = (anchors & np.uint64(0xFFFFFF)) % np.uint64(n)
            if n <= 1 << 16:
                deal = deal.astype(np.uint16)  # is sorted by counting
            order = np.argsort(deal, kind="stable")
            cuts = np.searchsorted(deal[order], np.arange(n + 1))
            rows = []
            for k in range(n):
                own = order[cuts[k] : cuts[k + 1]]
                if len(own):
                    ids = docs[own]
                    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
                    rows.append(
                        (
                            *(k, ids[starts].tobytes()),
                            np.diff(np.append(starts, len(ids))).astype("<u4").tobytes(),
                            _packed(anchors[own] >> np.uint64(24)),
                            _packed(contexts[own]),
                        )
                    )
            return pd.DataFrame(rows, columns=["part", "docs", "counts", "anchors", "contexts"])

        for batch in batches:
            ids = batch["doc_id"].to_numpy(np.int64)
            done = 0
            for run in runs(batch["bytes"], RUN_BYTES):
                found = Anchors(run)
                held.append((ids[done + found.text], found.anchor, found.context))
                done += len(run)
                size += len(found.text)
                if size >= SEND_ANCHORS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []

        def out() -> pd.DataFrame:
            docs = np.concatenate(
                [np.repeat(np.frombuffer(d, np.int64), np.frombuffer(c, "<u4")) for d, c, _, _ in held]
            )
            anchors = np.concatenate([_unpacked(x[2]) for x in held])
            contexts = np.concatenate([_unpacked(x[3]) for x in held])
            order = np.lexsort((contexts, anchors))
            docs, anchors, contexts = docs[order], anchors[order], contexts[order]
            new_anchor = np.ones(len(docs), bool)
            new_anchor[1:] = anchors[1:] != anchors[:-1]
            new_context = new_anchor.copy()
            new_context[1:] |= contexts[1:] != contexts[:-1]
            own_context = np.cumsum(new_context) - 1
            own_anchor = np.cumsum(new_anchor) - 1
            first_doc = np.minimum.reduceat(docs, np.flatnonzero(new_context))[own_context]
            least = np.minimum.reduceat(docs, np.flatnonzero(new_anchor))[own_anchor]
            most = np.maximum.reduceat(docs, np.flatnonzero(new_anchor))[own_anchor]
            n_contexts = np.bincount(own_anchor, new_context)[own_anchor]
            covered = docs > first_doc
            is_open = ~covered & (n_contexts > 1) & (least < most)
            kept = np.flatnonzero(covered | is_open)
            keys = mixed(anchors[kept] * np.uint64(0x9E6C63D0876A9A47) + contexts[kept])
            ids, opened = docs[kept], is_open[kept]
            deal = mixed(ids.view(np.uint64)) % np.uint64(n)
            rows = [
                (k, ids[own].tobytes(), keys[own].tobytes(), opened[own].tobytes())
                for k in np.unique(deal)
                if len(own := np.flatnonzero(deal == k))
            ]
            return pd.DataFrame(rows, columns=["part", "docs", "keys", "opened"])

        for batch in batches:
            for row in batch.itertuples(index=False, name=None):
                if row[0] != now and held:
                    yield out()
                    held = []
                now = row[0]
                held.append(row[1:])
        if held:
            yield out()

    def by_document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []

        def out() -> pd.DataFrame:
            kinds = (np.int64, np.uint64, np.bool_)
            ids, keys, opened = (
                np.concatenate([np.frombuffer(x[c], kind) for x in held])
                for c, kind in enumerate(kinds)
            )
            order = np.argsort(ids, kind="stable")
            ids, keys, opened = ids[order], keys[order], opened[order]
            cuts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1], [True]]))
            rows = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own, of = keys[a:b], opened[a:b]
                rows.append((ids[a], own[~of].tobytes(), own[of].tobytes()))
            return pd.DataFrame(rows, columns=["doc_id", "covered", "open"])

        for batch in batches:
            for row in batch.itertuples(index=False, name=None):
                if row[0] != now and held:
                    yield out()
                    held = []
                now = row[0]
                held.append(row[1:])
        if held:
            yield out()

    return (
        texts.filter("doc_id is not null")
        .mapInPandas(sent, "part int, docs binary, counts binary, anchors binary, contexts binary")
        .repartition(n, "part")
        .sortWithinPartitions("part")
        .mapInPandas(judged, "part int, docs binary, keys binary, opened binary")
        .repartition(n, "part")
        .sortWithinPartitions("part")
        .mapInPandas(by_document, "doc_id long, covered binary, open binary")
    )


def merged(spans: np.ndarray) -> np.ndarray:
    """Rows of (start, stop) without overlaps, in order; touching ones are one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.stack([spans[first, 0], np.maximum.reduceat(spans[:, 1], first)], axis=1)


def _among(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which keys are among some; np.isin is slow on the few of one text."""
    if not len(some):
        return np.zeros(len(keys), bool)
    some = np.sort(some)
    return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys


def _marked(flagged: DataFrame) -> DataFrame:
    """doc_id, print, spans of the covered contexts, and the open contexts."""

    def marks(run: list[bytes], flags: list[tuple]) -> Iterator[tuple]:
        found = Anchors(run)
        keys = found.keys()
        cuts = np.searchsorted(found.text, np.arange(len(run) + 1))
        for k, (doc, number, covered, opened) in enumerate(flags):
            own = slice(cuts[k], cuts[k + 1])
            first, last = found.first[own] - found.begins[k], found.last[own] - found.begins[k]
            is_covered = _among(keys[own], np.frombuffer(covered, np.uint64))
            is_open = _among(keys[own], np.frombuffer(opened, np.uint64)) & ~is_covered
            spans = np.stack([first[is_covered], last[is_covered] + LENGTH], axis=1)
            at, text = np.flatnonzero(is_open), run[k]
            anchors = (found.anchor[own][at] >> np.uint64(1)).astype(np.int64)
            ends = zip(first[at].tolist(), last[at].tolist(), strict=True)
            contexts = [text[a : b + LENGTH] for a, b in ends]
            yield doc, number, merged(spans).astype("<i8").tobytes(), anchors, first[at], contexts

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "print", "spans", "anchors", "starts", "contexts"]
        for batch in batches:
            flags = batch[["doc_id", "print", "covered", "open"]].itertuples(index=False, name=None)
            out = []
            for run in runs(batch["bytes"], RUN_BYTES):
                out += marks(run, [next(flags) for _ in run])
            yield pd.DataFrame(out, columns=columns)

    return flagged.mapInPandas(
        rows,
        "doc_id long, print long, spans binary, anchors array<long>, "
        "starts array<long>, contexts array<binary>",
    )


def _sorted_block(block: dict[bytes, list[tuple[int, int, int]]]) -> list[tuple[int, int, int, int]]:
    """Windows of the block's strings, each with its places (doc_id, print, place), that an earlier
    document has too: doc_id, print, start and stop of each stretch.

    Equal strings are sorted once. A place whose string an earlier document has is covered whole.
    """
    least = np.array([min(places)[0] for places in block.values()])
    text = np.concatenate(
        [x for s in block for x in (np.frombuffer(s, np.uint8).astype(np.int16) + 1, [0])]
    )
    windows = np.array([len(s) - LENGTH + 1 for s in block])
    sizes = np.array([len(s) + 1 for s in block])
    begins = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(block)), sizes)
    within = np.arange(len(text)) - begins[of]
    order = np.array(suffix_array(text.tolist()))
    order = order[within[order] < windows[of[order]]]
    rows = text[order[:, None] + np.arange(LENGTH)]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])
    docs = least[of[order]]
    earliest = np.minimum.reduceat(docs, np.flatnonzero(new))[np.cumsum(new) - 1]
    hits = np.sort(order[docs > earliest])
    spans: dict[int, list[tuple[int, int]]] = {}
    if len(hits):
        cut = np.concatenate([[True], (np.diff(hits) > 1) | (of[hits[1:]] != of[hits[:-1]])])
        starts = hits[cut]
        stops = hits[np.append(np.flatnonzero(cut)[1:], len(hits)) - 1] + LENGTH
        for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
            spans.setdefault(int(of[a]), []).append((a - int(begins[of[a]]), b - int(begins[of[a]])))
    found = []
    for k, ((s, places), first) in enumerate(zip(block.items(), least.tolist(), strict=True)):
        for doc, number, place in places:
            own = [(0, len(s))] if doc > first else spans.get(k, [])
            found += [(doc, number, place + a, place + b) for a, b in own]
    return found


def _windows(run: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the strings: which string, where in it, and a hash."""
    data = np.frombuffer(b"".join(run), np.uint8)
    sizes = np.array([len(s) for s in run])
    begins = np.cumsum(sizes) - sizes
    counts = sizes - LENGTH + 1
    of = np.repeat(np.arange(len(run)), counts)
    within = np.arange(len(of)) - (np.cumsum(counts) - counts)[of]
    at = begins[of] + within
    sums = prefix_sums(data)
    _, down = powers(len(data))
    return of, within, mixed((sums[at + LENGTH] - sums[at]) * down[at])


def repeats(contexts: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """doc_id, print, start and stop of what the contexts (doc_id, print, place, bytes) repeat of
    one another."""
    of, within, hashes = _windows([s for *_, s in contexts])
    docs = np.array([d for d, *_ in contexts])[of]
    order = np.lexsort((docs, hashes))
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    first = order[new][np.cumsum(new) - 1]  # the earliest window like each
    later = docs[order] > docs[first]
    queries, sources = order[later], first[later]
    if not len(queries):
        return []
    # Windows in the order of their contexts; each brings the earliest one like it along.
    by_context = np.argsort(queries, kind="stable")
    queries, sources = queries[by_context], sources[by_context]
    cut = np.flatnonzero(np.concatenate([[True], of[queries[1:]] != of[queries[:-1]]]))
    found: list[tuple[int, int, int, int]] = []
    block: dict[int, list[int]] = {}
    size = 0

    def flush() -> None:
        pieces: dict[bytes, list[tuple[int, int, int]]] = {}
        for c, (a, b) in block.items():
            doc, number, place, s = contexts[c]
            pieces.setdefault(s[a : b + LENGTH], []).append((doc, number, place + a))
        found.extend(_sorted_block(pieces))

    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(queries)], strict=True):
        wanted = np.concatenate([queries[a:b], sources[a:b]])
        for c, w in zip(of[wanted].tolist(), within[wanted].tolist(), strict=True):
            if c not in block:
                block[c] = [w, w]
                size += LENGTH
            elif w < block[c][0]:
                block[c][0] = w
            elif w > block[c][1]:
                block[c][1] = w
        if size >= BLOCK:
            flush()
            block, size = {}, 0
    if block:
        flush()
    return found


STRETCH = ["doc_id", "print", "start", "stop"]


def _met(contexts: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, size = None, [], 0
        out: list[tuple[int, int, int, int]] = []
        for batch in batches:
            for anchor, doc, number, start, data in batch.itertuples(index=False, name=None):
                if anchor != now:
                    now = anchor
                    if size >= GATHER:
                        out += repeats(held)
                        held, size = [], 0
                held.append((doc, number, start, data))
                size += len(data)
            yield pd.DataFrame(out, columns=STRETCH, dtype="int64")
            out = []
        if held:
            out = repeats(held)
        yield pd.DataFrame(out, columns=STRETCH, dtype="int64")

    n = parts(contexts.sparkSession)
    return (
        contexts.repartition(n, "anchor")
        .sortWithinPartitions("anchor", "doc_id")
        .mapInPandas(rows, ", ".join(f"{c} long" for c in STRETCH))
    )


def _met_in_crowds(contexts: DataFrame, crowds: DataFrame) -> DataFrame:
    """What _met finds, for the anchors in crowds (anchor, size): no task holds a whole anchor."""
    group = ["anchor", "salt"]
    place = F.xxhash64("doc_id", "print", "starts")
    n_groups = F.ceil(F.col("size") / GATHER).cast("long")
    members = written(
        contexts.join(side(crowds), "anchor")
        .select(*contexts.columns, F.pmod(place, n_groups).alias("salt"))
        .dropDuplicates(["anchor", "doc_id", "print", "starts"]),
        "substring-crowd",
    )

    def first_of(own: pd.DataFrame) -> tuple[np.ndarray, ...]:
        """Of each distinct window hash, doc_id, string and place where it is earliest."""
        of, within, hashes = _windows(own["contexts"].tolist())
        docs = own["doc_id"].to_numpy(np.int64)[of]
        order = np.lexsort((docs, hashes))
        first = order[np.append(True, hashes[order[1:]] != hashes[order[:-1]])]
        return hashes[first].view(np.int64), docs[first], of[first], within[first]

    def distinct(own: pd.DataFrame) -> pd.DataFrame:
        hashes, docs, _, _ = first_of(own)
        found = pd.DataFrame({"hash": hashes, "doc_id": docs})
        return found.assign(anchor=own["anchor"].iloc[0], salt=own["salt"].iloc[0])

    windows = written(
        members.groupBy(group).applyInPandas(
            distinct, "anchor long, salt long, hash long, doc_id long"
        ),
        "substring-windows",
    )
    # A hash has one row of a group at most; the earliest one's group gives copies to the others.
    shared = (
        windows.groupBy("anchor", "hash")
        .agg(F.min(F.struct("doc_id", "salt")).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("anchor", "first.salt", "hash")
    )

    def copied(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        hashes, docs, of, within = first_of(own)
        texts = own["contexts"].tolist()
        at = np.flatnonzero(np.isin(hashes, asked["hash"].to_numpy(np.int64)))
        copies = [texts[of[k]][within[k] : within[k] + LENGTH] for k in at]
        found = pd.DataFrame({"hash": hashes[at], "source": docs[at], "window": copies})
        return found.assign(anchor=own["anchor"].iloc[0])

    sources = (
        members.groupBy(group)
        .cogroup(shared.groupBy(group))
        .applyInPandas(copied, "anchor long, hash long, source long, window binary")
    )
    wanted = (
        windows.join(sources, ["anchor", "hash"])
        .filter("source < doc_id")
        .select("anchor", "salt", "source", "window")
    )

    def rows(own: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        held = list(own[["doc_id", "print", "starts", "contexts"]].itertuples(index=False, name=None))
        # A copy is of the earliest document that has the window, so nothing is found in it.
        held += [(doc, 0, 0, x) for doc, x in zip(given["source"], given["window"], strict=True)]
        return pd.DataFrame(repeats(held), columns=STRETCH, dtype="int64")

    return (
        members.groupBy(group)
        .cogroup(wanted.groupBy(group))
        .applyInPandas(rows, ", ".join(f"{c} long" for c in STRETCH))
    )


def _stretches(contexts: DataFrame) -> DataFrame:
    """Stretches of the open contexts that an earlier document has too."""
    crowds = written(
        contexts.groupBy("anchor")
        .agg(F.sum(F.octet_length("contexts")).alias("size"))
        .filter(F.col("size") > GATHER),
        "substring-crowds",
    )
    if crowds.isEmpty():
        return _met(contexts)
    few = contexts.join(side(crowds.select("anchor")), "anchor", "left_anti")
    return _met(few).unionAll(_met_in_crowds(contexts, crowds))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


OWN = ["doc_id", "print"]  # stretches are places of one text: rows of one doc_id may have several


def _judged(docs: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """The ids of documents that may repeat something, if they are few; and of their texts doc_id,
    print, spans and more (stretches to remove), which is written."""
    texts = documents(docs, F.xxhash64("text").alias("print"))
    flags = written(_flags(texts.drop("print")), "substring-flags")
    ids = flags.select("doc_id") if few(flags) else None
    if ids is not None:
        texts = texts.join(F.broadcast(ids), "doc_id", "left_semi")
    marked = written(_marked(texts.join(flags, "doc_id")), "substring-marked")
    contexts = marked.select(
        "doc_id", "print", F.explode(F.arrays_zip("anchors", "starts", "contexts")).alias("x")
    ).select(F.col("x.anchors").alias("anchor"), "doc_id", "print", "x.starts", "x.contexts")
    stretches = F.collect_list(F.array("start", "stop")).alias("more")
    more = _stretches(contexts).groupBy(OWN).agg(stretches)
    covered = marked.select(*OWN, "spans").dropDuplicates(OWN)
    return ids, written(covered.join(more, OWN, "left"), "substring-cuts")


def _cut(text: bytes, spans: bytes, more) -> tuple[bytes, np.ndarray]:
    own = [np.frombuffer(spans, "<i8").reshape(-1, 2)]
    if more is not None:
        own += [np.asarray(x).reshape(1, 2) for x in more]
    gone = merged(np.concatenate(own))
    edges = [0, *gone.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), gone


def _with_cuts(
    texts: DataFrame, cuts: DataFrame, ids: DataFrame | None
) -> tuple[DataFrame | None, DataFrame]:
    """Rows of which nothing goes, if they can be told apart without moving them; and the others
    with spans and more, null where nothing is known of a text."""
    some = cuts.filter("octet_length(spans) > 0 or more is not null")
    if ids is None or not few(some):
        return None, texts.join(cuts, OWN, "left")
    keys = F.broadcast(some.select(OWN))
    return texts.join(keys, OWN, "left_anti"), texts.join(keys, OWN, "left_semi").join(some, OWN)


DIGESTS = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256; one row per document."""

    @F.pandas_udf(DIGESTS)
    def judged(texts: pd.Series, spans: pd.Series, more: pd.Series) -> pd.DataFrame:
        rows = []
        for text, own, others in zip(texts, spans, more, strict=True):
            left, gone = _cut(text, own or b"", others)
            rows.append((len(text), len(text) - len(left), len(gone), hashlib.sha256(left).hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    ids, cuts = _judged(docs)
    texts = documents(docs, F.xxhash64("text").alias("print"))
    others, touched = _with_cuts(texts, cuts, ids)
    found = touched.select("doc_id", judged("bytes", "spans", "more").alias("found"))
    found = found.select("doc_id", "found.*")
    if others is None:
        return found
    untouched = others.select(
        "doc_id",
        F.octet_length("bytes").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2("bytes", 256).alias("kept_sha256"),
    )
    return untouched.unionAll(found)


def removed(docs: DataFrame) -> DataFrame:
    """The documents without what they repeat: all columns, with the new text and n_chars.

    Pieces of characters that a cut leaves behind go too. A null text of a document that
    repeats nothing stays null.
    """

    @F.pandas_udf("string")
    def kept(texts: pd.Series, spans: pd.Series, more: pd.Series) -> pd.Series:
        rows = []
        for text, own, others in zip(texts, spans, more, strict=True):
            rows.append(None if text is None else _cut(text, own, others)[0].decode("utf-8", "ignore"))
        return pd.Series(rows)

    def renewed(text: Column) -> Column:
        new = F.col("row").withField("text", text)
        return new.withField("n_chars", F.char_length(text).cast("long"))

    ids, cuts = _judged(docs)
    # The row is one column, so that no name of its own meets one of these.
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("print"),
    )
    whole = F.coalesce("row.text", F.lit(""))
    others, touched = _with_cuts(rows, cuts, ids)
    # Only what is cut goes to Python.
    cut = (F.octet_length("spans") > 0) | F.col("more").isNotNull()
    left = kept(F.when(cut, whole.cast("binary")), "spans", "more").alias("kept")
    new = F.when(F.col("spans").isNotNull(), renewed(F.coalesce(F.col("kept"), whole)))
    new = touched.select("row", "spans", left).select(new.otherwise(F.col("row")).alias("row"))
    if others is not None:
        flagged = F.broadcast(ids.withColumn("flagged", F.lit(True)))
        known = others.join(flagged, "doc_id", "left")
        old = known.select(F.when(F.col("flagged"), renewed(whole)).otherwise(F.col("row")).alias("row"))
        new = old.unionAll(new)
    return new.select("row.*")

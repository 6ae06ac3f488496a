"""Each operator on small tables against brute force, with all the odd rows at once."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from brute_force import components, covered, near, shingles
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martlane.llm import (
    ann,
    common,
    jaccard,
    licenses,
    lm,
    mixing,
    near_vectors,
    packing,
    quality,
    substrings,
    token_files,
    tokens,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bytes int, class string"


def sentences(draw, n, top=60):
    return " ".join(f"w{draw.randint(1, top)}" for _ in range(n))


def odd_texts():
    """Copies, near copies, shared passages, short, empty, null, long and repeated texts."""
    draw = random.Random(4)
    base = [sentences(draw, 120, 5000) for _ in range(12)]
    shared = sentences(draw, 40, 5000)
    texts = []
    for text in base:
        words = text.split()
        texts.append(text)
        for changes in (1, 3, 9):
            own = list(words)
            for _ in range(changes):
                own[draw.randrange(len(own))] = f"x{draw.randint(1, 9)}"
            texts.append(" ".join(own))
    texts += [t[:300] + " " + shared + " " + t[300:] for t in base[:6]]
    texts += [base[0], base[0], base[1].upper(), None, "", " \n ", "one", "one two", "One  two"]
    texts += ["é" * 60, "é" * 40 + "z" + "é" * 60, "ab" * 400, "\x00" * 120, shared]
    texts += [sentences(draw, 9000, 200), sentences(draw, 9000, 200)]
    texts += ["MIT License. under the mit license and Apache License, Version 2.0 cc-by-nc"]
    draw.shuffle(texts)
    return texts


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(6)
    texts = odd_texts()
    ids = draw.sample(range(10_000), len(texts))
    sources = ["a", "b", "B", "", "é", None, "long"]
    return [
        (i, t, "en", sources[k % 7], None if t is None else len(t), k, "c")
        for k, (i, t) in enumerate(zip(ids, texts, strict=True))
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def nulls(spark):
    """Rows without ids and rows that are there twice."""
    text = "some words that are long enough to be removed when they come again here"
    rows = [(None, text), (None, text), (5, text), (5, text), (5, "other"), (None, None), (7, text)]
    return spark.createDataFrame(
        [(i, t, "en", None, 1, 0, "c") for i, t in rows], DOCS
    )


@pytest.mark.parametrize(
    ("size", "percent", "frequent", "long", "block"), [(3, 90, 1 << 18, 48, 512), (5, 80, 20, 2, 3)]
)
def test_jaccard(docs, rows, size, percent, frequent, long, block, monkeypatch):
    monkeypatch.setattr(jaccard, "LONG", long)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FIELD_BYTES", 100 * block)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "SEEN", 2)
    monkeypatch.setattr(jaccard, "PORTION", 2)
    sets = {r[0]: shingles(r[1], size) for r in rows}
    want = components(sets, near(sets, percent))
    got = jaccard.join(docs, size, percent).collect()
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(got) == len(rows)


def test_jaccard_ranges_grow_with_the_texts(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "RANGE_BYTES", 3_000)
    texts = jaccard.documents(docs)
    size = sum(len((r[1] or "").encode()) for r in rows)
    assert jaccard._ranges(texts, 4) == -(-size // 3_000) > 4
    assert jaccard._ranges(texts.unionAll(texts), 4) == -(-2 * size // 3_000)
    assert jaccard._ranges(texts.limit(0), 4) == 4
    sets = {r[0]: shingles(r[1], 3) for r in rows}
    got = {r.doc_id: r.component_id for r in jaccard.join(docs, 3, 90).collect()}
    assert got == components(sets, near(sets, 90))


def test_jaccard_lists_go_to_their_place_once(spark):
    rows = [(k, c, 9, k, 9) for k in (1, 2, 3) for c in range(k, k + 3)]
    lists = spark.createDataFrame(rows, "key long, class long, n long, head long, head_n long")
    roots = spark.createDataFrame([(2, 1), (3, 1), (1, 1)], "node long, root long")
    opened = jaccard._open(lists, roots)
    by_key = re.compile(r"Exchange hashpartitioning\(key#\d+L?, ")
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    assert len(by_key.findall(plan(opened))) == 1
    assert len(by_key.findall(plan(jaccard._stars(opened, 90)))) == 1
    assert not by_key.findall(plan(jaccard._first_stars(lists, 90)))
    got = sorted((r.key, r["class"], r.root, r.members) for r in opened.collect())
    assert got == [(2, 2, 1, 3), (2, 3, 1, 3), (2, 4, 4, 3)] + [
        (3, 3, 1, 3), (3, 4, 4, 3), (3, 5, 5, 3),
    ]


def test_jaccard_lists_hold_only_sets_of_like_size(spark):
    """Texts that share a beginning but not their size are in no list; none is sent anywhere."""
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words[:n]) for n in (20, 40, 90, 200, 400, 396)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lists = jaccard._shared(jaccard.documents(docs), np.empty(0, np.uint64), 3, 90).collect()
    assert {(r.n, r.head_n) for r in lists} in ({(398, 398), (394, 398)}, {(398, 394), (394, 394)})
    assert [r.component_id for r in jaccard.join(docs, 3, 90).orderBy("doc_id").collect()] == [
        0, 1, 2, 3, 4, 4,
    ]


def test_jaccard_parities_stay_where_few_are_asked_for(spark):
    draw = np.random.default_rng(2)
    sets = draw.integers(0, 2**63, (500, 200), dtype=np.uint64)
    rows = [(k, 200, bytearray(jaccard.parity(x, 64))) for k, x in enumerate(sets)]
    parities = spark.createDataFrame(rows, "class long, n long, parity binary")
    pairs = spark.createDataFrame([(1, 2), (1, 1)], "u long, v long")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        likely = jaccard._likely(pairs, parities, 90)
        plan = likely._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\(class#", plan)
        assert [tuple(r) for r in likely.collect()] == [(1, 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_jaccard_of_more_rows_than_are_broadcast(spark, docs, rows, monkeypatch):
    """Then parities are worked out where the texts are read, and no texts are shuffled for them."""
    sizes = [*range(1, 3_000), 10**5, 10**6]
    bucket = F.floor(F.log(F.col("n").cast("double")) / jaccard._step(90)) + 1
    frame = spark.createDataFrame([(n,) for n in sizes], "n long").withColumn("above", bucket)
    for n, words in frame.select("n", jaccard._words("above", 90)).collect():
        assert words <= jaccard.words_above(n, 90) <= 2 * words
    shuffled = []
    keep = jaccard.written

    def seen(found, purpose):
        if purpose == "jaccard-parities":
            shuffled.append(found._jdf.queryExecution().executedPlan().toString())
        return keep(found, purpose)

    monkeypatch.setattr(jaccard, "written", seen)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    sets = {r[0]: shingles(r[1], 3) for r in rows}
    got = {r.doc_id: r.component_id for r in jaccard.join(docs, 3, 90).collect()}
    assert got == components(sets, near(sets, 90))
    # Below the join by place there are parities, not texts.
    plan = shuffled[0]
    assert re.search(r"Join.*\n(.*\n)*.*MapInPandas of_all", plan)
    assert not re.search(r"MapInPandas rows", plan)


def test_jaccard_blocks_hold_what_may_be_near(spark):
    draw = np.random.default_rng(1)
    first, other = draw.integers(0, 2**63, (2, 200), dtype=np.uint64)
    near = np.concatenate([first[:-2], other[:2]])
    bucket = int(np.log(200) / jaccard._step(90))
    rows = [(c, 200, c, 1, bucket, 1, 0, 77) for c in (1, 2, 3)]
    placed = spark.createDataFrame(
        rows,
        "class long, n long, now long, root long, bucket long, fields long, field long, own long",
    )
    rows = [(k + 1, 200, bytearray(jaccard.parity(x, 64))) for k, x in enumerate((first, other, near))]
    parities = spark.createDataFrame(rows, "class long, n long, parity binary")
    got = jaccard._visits(placed, parities, 90).collect()
    assert sorted((r["class"], r["first"], r.role) for r in got) == [(1, 77, 1), (3, 77, 0)]


def test_jaccard_keeps_one_of_each_group(docs, rows, nulls, nothing):
    sets = {r[0]: shingles(r[1], 5) for r in rows}
    roots = components(sets, near(sets, 80))
    kept = jaccard.kept(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))
    left = jaccard.kept(nulls).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in left if r.text) == [
        (False, 5, "other"),
        (False, 5, nulls.first().text),
    ]
    assert jaccard.kept(nothing).count() == 0


@pytest.mark.parametrize("block", [200, 32_768])
def test_substrings(docs, rows, block, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", block)
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    gone = covered(texts)
    got = substrings.digests(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        b, g = texts[r.doc_id], gone[r.doc_id]
        kept = bytes(np.frombuffer(b, np.uint8)[~g])
        runs = int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum())
        want = (len(b), int(g.sum()), runs, hashlib.sha256(kept).hexdigest())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want
    assert sum(g.sum() for g in gone.values()) > 0


def test_substrings_leave_texts(docs, rows, nulls, nothing):
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    gone = covered(texts)
    left = substrings.removed(docs)
    assert left.columns == docs.columns
    for r in left.collect():
        kept = bytes(np.frombuffer(texts[r.doc_id], np.uint8)[~gone[r.doc_id]])
        if gone[r.doc_id].any():
            assert r.text == kept.decode("utf-8", "ignore")
            assert r.n_chars == len(r.text)
        else:
            assert (r.text or "").encode() == kept
    text = nulls.first().text
    got = sorted(
        ((r.doc_id, r.text) for r in substrings.removed(nulls).collect()), key=lambda x: str(x)
    )
    assert got == sorted(
        [(None, text)] * 2 + [(5, text)] * 2 + [(5, "other"), (None, None), (7, "")],
        key=lambda x: str(x),
    )
    assert substrings.digests(nothing).count() == 0


def ends_of_a_passage(draw, n):
    """Texts that share a passage's beginning, middle or end, after and before their own words."""
    passage = sentences(draw, 60, 5000)
    own = lambda: sentences(draw, draw.randint(1, 9), 5000)
    texts = []
    for _ in range(n):
        a = draw.randint(0, 3) * 40
        texts.append(f"{own()} {passage[a : a + 70 + draw.randint(0, 2) * 31]} {own()}")
    return texts


def test_substrings_of_texts_with_one_id(spark):
    """Two long texts under one doc_id repeat an earlier one at different places."""
    draw = random.Random(2)
    texts = ends_of_a_passage(draw, 3)
    first, one, two = texts[0], "x" * 7 + " " + texts[1], sentences(draw, 30, 5000) + " " + texts[2]
    rows = [(1, first), (2, one), (2, two), (3, one)]
    docs = spark.createDataFrame([(i, t, "en", None, len(t), 0, "c") for i, t in rows], DOCS)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in substrings.digests(docs).collect())
    want = []
    for i, text in rows:
        # What other rows of the id repeat or hold does not count.
        texts = {k: t.encode() for k, (j, t) in enumerate(rows) if j < i} | {9: text.encode()}
        gone = covered(texts)[9]
        kept = bytes(np.frombuffer(text.encode(), np.uint8)[~gone])
        want.append((i, len(text), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)
    assert [n > 0 for _, _, n, _ in want] == [False, True, True, True]


def test_substrings_of_a_crowd(spark, monkeypatch):
    """Hundreds of texts hold the edges of one passage: no group has all contexts of an anchor."""
    texts = dict(enumerate(t.encode() for t in ends_of_a_passage(random.Random(3), 400)))
    whole, gather = substrings.repeats, 1_000

    def bounded(contexts):
        assert sum(len(s) for *_, s in contexts) <= 4 * gather
        return whole(contexts)

    monkeypatch.setattr(substrings, "GATHER", gather)
    monkeypatch.setattr(substrings, "repeats", bounded)
    rows = [(i, t.decode(), "en", None, len(t), 0, "c") for i, t in texts.items()]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    gone = covered(texts)
    for r in substrings.digests(docs).collect():
        kept = bytes(np.frombuffer(texts[r.doc_id], np.uint8)[~gone[r.doc_id]])
        assert r.n_removed == gone[r.doc_id].sum()
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("gather", [1, 200])
def test_substrings_in_crowds_only(docs, rows, gather, monkeypatch):
    monkeypatch.setattr(substrings, "GATHER", gather)
    test_substrings(docs, rows, 32_768, monkeypatch)


def test_mixing(docs, rows, nulls, nothing):
    got = mixing.mix(docs, shard_rows=8, left_shards=2).collect()
    assert len(got) == len(rows)
    size = {r[0]: len((r[1] or "").encode().split()) for r in rows}
    of = {r[0]: r[3] for r in rows}
    sizes = {}
    for i, n in size.items():
        sizes[of[i]] = sizes.get(of[i], 0) + n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: 2 * sizes[s] if s in full else rest * weight[s] / free for s in order}
        more = {s for s in order if target[s] > 2 * sizes[s]}
        if not more:
            break
        full |= more
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[of[r.doc_id]])
        assert r.target == pytest.approx(target[of[r.doc_id]])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[of[r.doc_id]] += r.taken
    for s in order:
        largest = max(n for i, n in size.items() if of[i] == s)
        assert abs(taken[s] - target[s]) <= largest
    key = lambda rows: sorted((r.doc_id, r.taken) for r in rows)
    assert key(got) == key(mixing.mix(docs.repartition(5), shard_rows=8, left_shards=2).collect())
    mixed = mixing.mix(docs)
    took = mixing.take(docs, mixed)
    assert took.columns == docs.columns
    assert took.count() == sum(r.copies for r in mixed.collect())
    again = mixing.mix(nulls)
    assert mixing.take(nulls, again).count() == sum(r.copies for r in again.collect())
    assert mixing.mix(nothing).count() == 0


def test_packing(docs, rows, nulls, nothing):
    content = tokens.public(tokens.BYTE_BPE)
    library = Tokenizer.from_str(content)
    got = packing.pack(docs, content, capacity=128).collect()
    want = {}
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [0]
        n = -(-len(ids) // 128)
        starts = [0, *range(len(ids) - 128 * (n - 1), len(ids), 128)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            want[r[0], piece] = (a, b - a, crc)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    whole = sum(length for _, length, _ in want.values())
    assert len({r.sequence_id for r in got}) <= 1.1 * whole / 128 + 1
    for frame in (got, packing.pack(nulls, content, 128).collect()):
        sequences = {}
        for r in frame:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for own in sequences.values():
            filled = 0
            for offset, length in sorted(own):
                assert offset == filled
                filled += length
            assert filled <= 128
    assert packing.pack(nothing, content).count() == 0


def test_token_files(spark, docs, rows, nulls, nothing, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 300)
    content = tokens.public(tokens.WORD_BPE)
    library = Tokenizer.from_str(content)
    path = str(tmp_path / "files")
    token_files.write(docs, content, path)
    start, want = 0, []
    for i, text in sorted((r[0], r[1] or "") for r in rows):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_files.read(spark, path).collect())) == want
    token_files.write(nulls, content, str(tmp_path / "nulls"))
    ids = [r.doc_id for r in token_files.read(spark, str(tmp_path / "nulls")).orderBy("start").collect()]
    assert ids == [None, None, None, 5, 5, 5, 7]
    token_files.write(nothing, content, str(tmp_path / "nothing"))
    assert token_files.read(spark, str(tmp_path / "nothing")).count() == 0


def test_licenses(docs, rows, nulls, nothing):
    rules = licenses.rules()
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(docs).collect()}
    want = {r[0]: licenses.scan_text((r[1] or "").encode(), rules) for r in rows}
    assert got == want
    assert licenses.scan(nulls).count() == 7
    assert licenses.scan(nothing).count() == 0


def test_quality(spark, docs, rows, nulls, nothing):
    junk = spark.createDataFrame(
        [(20_000 + k, "$$ " * (k % 7 + 3) + "w1 %% w2 %%" * 9, "en", "a", 1, 0, "c") for k in range(120)]
        + [(30_000 + k, sentences(random.Random(k), 60), "en", "a", 1, 0, "c") for k in range(240)],
        DOCS,
    )
    labels = [(20_000 + k, 0) for k in range(120)] + [(30_000 + k, 1) for k in range(240)]
    labels = spark.createDataFrame(
        [*labels, (None, 1), (30_000, None)], "doc_id long, quality int"
    )
    table = docs.unionAll(junk)
    got = {r.doc_id: r for r in quality.score(table, labels).collect()}
    assert len(got) == len(rows) + 360
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
    right = [(got[i].predicted == 1) == (i >= 30_000) for i in got if i >= 20_000 and got[i].held_out]
    assert sum(right) >= 0.97 * len(right)
    kept = quality.accepted(table, labels)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    # Other labels of held-out rows change nothing.
    flipped = labels.selectExpr(
        "doc_id", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2, 1 - quality, quality)"
        " as quality"
    )
    again = {r.doc_id: r.score for r in quality.score(table, flipped).collect()}
    assert again == pytest.approx({i: r.score for i, r in got.items()}, abs=1e-6)
    assert quality.score(nulls, labels).count() == 7
    assert quality.score(nothing, labels).count() == 0
    assert {r.score for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}


def test_language_models(spark, docs, rows, nulls, nothing):
    like = sentences(random.Random(8), 200, 20)
    table = docs.unionAll(
        spark.createDataFrame(
            [(40_000 + k, like, "en", "a", 1, 0, "c") for k in range(3)]
            + [(50_000 + k, sentences(random.Random(k), 300, 4000), "en", "a", 1, 0, "c") for k in range(9)],
            DOCS,
        )
    )
    targets = spark.createDataFrame([(40_000,), (None,), (40_001,), (40_001,)], "doc_id long")
    got = {r.doc_id: r for r in lm.score(table, targets).collect()}
    assert len(got) == len(rows) + 12
    assert got[40_002].score > max(got[50_000 + k].score for k in range(9)) + 0.5
    assert [got[40_000 + k].is_target for k in range(3)] == [True, True, False]
    for r in rows:
        assert got[r[0]].n_words == len((r[1] or "").encode().split())
        if not got[r[0]].n_words:
            assert got[r[0]].score == 0
    # The models against plain counts.
    counts, pairs, n = {}, {}, 0
    for r in table.collect():
        words = (r.text or "").encode().lower().split()
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        for p in zip(words, words[1:], strict=False):
            pairs[p] = pairs.get(p, 0) + 1
    known = {w: c for w, c in counts.items() if c > 1}
    pairs = {p: c for p, c in pairs.items() if c > 1 and p[0] in known and p[1] in known}
    n, size = sum(known.values()), len(known) + 1
    words, loss = like.encode().split(), 0.0
    for k, w in enumerate(words):
        share = pairs.get((words[k - 1], w), 0) / known[words[k - 1]] if k else 0
        loss -= np.log(0.5 * min(share, 1) + 0.5 * (known.get(w, 0) + 1) / (n + size))
    assert got[40_000].background_loss == pytest.approx(loss / len(words))
    assert lm.score(nulls, targets).count() == 7
    assert lm.score(nothing, targets).count() == 0
    assert max(abs(r.score) for r in lm.score(docs, targets.limit(0)).collect()) < 1e-12


def test_language_models_keep_every_count(spark, monkeypatch):
    """More words and pairs than any list of fixed size, in many chunks and ranges."""
    monkeypatch.setattr(lm, "CHUNK_BYTES", 200_000)
    monkeypatch.setattr(lm, "RANGE_WORDS", 5_000)
    size, left, right = 70_000, "common", "usual"
    texts = {k: " ".join(f"v{j}" for j in range(k * 700, k * 700 + 700)) for k in range(size // 700)}
    texts |= {1000 + k: t for k, t in texts.items()}
    texts |= {2000 + k: f"{left} {right} " * 300 for k in range(3)} | {3000: "once v1 v2"}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    targets = spark.createDataFrame([(k,) for k in range(10)], "doc_id long")
    got = {r.doc_id: r for r in lm.score(table, targets).collect()}
    assert len(got) == len(texts)
    n, n_pairs, single, target_n = {}, {}, {}, {}
    target_pairs = {}
    for i, text in texts.items():
        own = text.split()
        for w in own:
            n[w] = n.get(w, 0) + 1
            target_n[w] = target_n.get(w, 0) + (i < 10)
        for p in zip(own, own[1:], strict=False):
            n_pairs[p] = n_pairs.get(p, 0) + 1
            target_pairs[p] = target_pairs.get(p, 0) + (i < 10)
    n = {w: c for w, c in n.items() if c > 1}
    whole, whole_target = sum(n.values()), sum(target_n[w] for w in n)
    assert len(n) == size + 2
    for w in [*n, None]:
        share = (n.get(w, 0) + 1) / (whole + len(n) + 1)
        known = (target_n.get(w, 0) + 1000 * share) / (whole_target + 1000)
        single[w] = (share, known if w else share)
    for i in (0, 5, 99, 1005, 2000, 3000):
        losses, before = np.zeros(2), None
        for w in texts[i].split():
            share = target = 0
            if before in n and w in n and n_pairs[before, w] > 1:
                share = min(n_pairs[before, w] / n[before], 1)
                target = min((target_pairs[before, w] + 10 * share) / (target_n[before] + 10), 1)
            losses -= np.log([0.5 * s + 0.5 * x for s, x in zip((share, target), single.get(w, single[None]), strict=True)])
            before = w
        losses /= len(texts[i].split())
        assert (got[i].background_loss, got[i].target_loss) == pytest.approx(tuple(losses))
        assert got[i].is_target == (i < 10)


VECTORS = "vec_id long, embedding array<float>, label int, rank int, cell string"


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(40, 16))
    rows = []
    for k in range(900):
        x = base[k % 40] + draw.normal(size=16) * (0.05 if k % 3 else 0.9)
        rows.append((k, [float(v) for v in np.float32(x)], k % 4, 0, "c"))
    same = rows[7][1]
    rows += [(1000 + k, same, 3, 0, "c") for k in range(30)]
    rows += [
        (2000, None, 1, 0, "c"), (2020, [], 1, 0, "c"), (2040, [0.0] * 16, 1, 0, "c"),
        (2060, [float("nan")] * 16, 1, 0, "c"), (2080, [None] + [1.0] * 15, 1, 0, "c"),
        (2100, [float("inf")] * 16, 1, 0, "c"), (2120, same, None, 0, "c"),
    ]
    return rows, spark.createDataFrame(rows, VECTORS).repartition(3)


def usable(rows):
    good = [r for r in rows if r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    return good, np.array([r[1] for r in good], float)


def test_search(spark, vectors):
    rows, frame = vectors
    good, x = usable(rows)
    ids = np.array([r[0] for r in good])
    got = {}
    for r in ann.search(frame, frame.filter("vec_id % 20 = 0"), k=20).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == {i for i in ids if i % 20 == 0}
    found = 0
    for i, own in got.items():
        own.sort(key=lambda r: r.rank)
        at = list(ids).index(i)
        scores = (x[at] * x).sum(1)
        others = sorted((-s, j) for s, j in zip(scores, ids, strict=True) if j != i)[:20]
        assert [r.rank for r in own] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        for r in own:
            assert r.score == pytest.approx(scores[list(ids).index(r.vec_id)], abs=1e-9)
        found += len({j for _, j in others} & {r.vec_id for r in own})
    assert found >= 0.9 * 20 * len(got)
    empty = frame.limit(0)
    assert ann.search(empty, empty).count() == 0
    few = frame.filter("vec_id < 5")
    assert ann.search(few, few).count() == 20


def test_near_vectors(vectors, monkeypatch):
    rows, frame = vectors
    good, x = usable([r for r in rows if r[2] is not None])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in good])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    ids = [r[0] for r in good]
    pairs = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked), strict=True)]
    want = components([r[0] for r in rows], pairs)
    for portion in (near_vectors.PORTION_ROWS, 16):
        links = near_vectors.link(frame, portion_rows=portion).groupBy("vec_id").sum("links").collect()
        assert sum(r[1] for r in links) >= 0.99 * linked.sum()
    got = {r.vec_id: r for r in near_vectors.near_duplicates(frame).collect()}
    assert set(got) == {r[0] for r in rows}
    true = dict(zip(ids, linked.sum(1).tolist(), strict=True))
    assert all(r.n_links <= true.get(i, 0) for i, r in got.items())
    assert sum(r.n_links for r in got.values()) >= 0.99 * linked.sum()
    assert sum(want[i] == r.component_id for i, r in got.items()) >= 0.99 * len(want)
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert near_vectors.near_duplicates(frame.limit(0)).count() == 0

"""The parts that need no Spark: coding, suffix arrays, packing plans, flights, rules, words."""

import itertools
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from martlane.llm import (
    hashed_words,
    jaccard,
    licenses,
    mixing,
    near_vectors,
    packing,
    quality,
    simple8b,
    tokens,
)
from martlane.llm.common import kept_by_worker
from martlane.llm.suffix_groups import suffix_array


@pytest.mark.parametrize("seed", range(60))
def test_simple8b_round_trip(seed):
    draw = np.random.default_rng(seed)
    n = int(draw.choice([0, 1, 5, 1023, 1024, 1025, 5000]))
    if seed % 2:  # of all widths, so with escapes
        values = draw.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        values >>= draw.integers(0, 64, n).astype(np.uint64)
    else:
        values = draw.integers(0, int(draw.choice([1, 2, 100, 50_000])), n).astype(np.uint64)
    words, firsts = simple8b.encode(values)
    assert (simple8b.decode(words, firsts, n) == values).all()


def test_simple8b_packs_small_numbers_densely():
    words, _ = simple8b.encode(np.ones(1024, np.uint64))
    assert len(words) == -(-1024 // 60)


def test_suffix_array_orders_all_suffixes():
    for seed in range(1500):
        draw = random.Random(seed)
        text = []
        for _ in range(draw.randint(1, 4)):
            top = draw.choice([1, 2, 3, 200])
            text += [draw.randint(1, top) for _ in range(draw.randint(0, 14))] + [0]
        order = suffix_array(text)
        assert sorted(order) == list(range(len(text)))
        suffixes = [text[i : text.index(0, i)] for i in order]
        assert suffixes == sorted(suffixes)


@pytest.mark.parametrize("seed", range(30))
def test_packing_plan_places_each_piece_once(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 100, 2048])
    sizes = [draw.randint(1, capacity), draw.randint(1, max(1, capacity // 4)), capacity]
    counts = Counter(draw.choice(sizes) for _ in range(draw.choice([0, 1, 5, 300])))
    steps, n = packing.plan(dict(counts), capacity)
    bins = {}
    for length, count in counts.items():
        own = [s for s in steps if s[0] == length]
        for rank in range(count):
            _, first, sequence, each, offset = [s for s in own if s[1] <= rank][-1]
            at = sequence + (rank - first) // each
            bins.setdefault(at, []).append((offset + (rank - first) % each * length, length))
    assert sorted(bins) == list(range(n))
    for own in bins.values():
        filled = 0
        for offset, length in sorted(own):
            assert offset == filled
            filled += length
        assert filled <= capacity


def test_flight_keeps_words_and_rows():
    draw = random.Random(3)
    sizes = [draw.randint(0, 900) for _ in range(4000)]
    probs = [0.37] * len(sizes)
    words, rows = sum(sizes) * 0.37, len(sizes) * 0.37
    mixing._fly(sizes, probs, draw, balance_rows=True)
    assert sum(1 for p in probs if 0 < p < 1) <= 2
    assert abs(sum(probs) - rows) < 1e-3
    assert abs(sum(s * p for s, p in zip(sizes, probs, strict=True)) - words) < 1e-2


WEIRD = [
    "", "  ", " a", "a ", "a  b", "a\n\nb", "a \n b", "　x y", "it's 's  's", "a\x1cb \x1c c",
    "x ́y", "ΑΣ ΑΣ.", "1 22 333", "<|endoftext|> hi", "a  <|endoftext|> b<|endoftext|>c", "x  <|ENDOFTEXT|>  y", "İstanbul İ", "H̱ ẖ", "dog, cat.",
    "<|startoftext|>", "a <|startoftext|", "a" * 5000, "\x00 \x00",
]


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_ids_are_those_of_the_whole_text(name):
    content = tokens.public(name)
    library = Tokenizer.from_str(content)
    draw = random.Random(1)
    signs = list(" \n\t\r'sabé́.,1  　\x1c\x85ß<|>")
    texts = WEIRD + ["".join(draw.choices(signs, k=draw.randint(0, 14))) for _ in range(3000)]
    texts += [a + "<|endoftext|>" + b for a, b in zip(texts[30:330], texts[330:630], strict=True)]
    for text, ids in zip(texts, tokens.Encoder(content).ids(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_chunks_asked_together_are_those_asked_alone(name, monkeypatch):
    encoder = tokens.Encoder(tokens.public(name))
    chunks = ["", " a", "b", "", "\n", " <|endoftext", "|>", "<|", "<|startoftext|", "é ", " 12,"]
    for size in (1, 2, 5, 100):
        monkeypatch.setattr(tokens, "TOGETHER", size)
        assert encoder._asked_together(chunks) == encoder._asked(chunks)
    assert encoder._asked_together([""]) == [b""]
    assert encoder._asked_together([]) == []


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_words_with_signs_are_made_of_known_pieces(name, monkeypatch):
    content = tokens.public(name)
    library = Tokenizer.from_str(content)
    draw = random.Random(2)
    letters = list("abst'12Éßœǅĳ×÷İıȿɀΣ") + ["e\u0301", "\u0303", "ſ"]
    words = ["".join(draw.choices(letters, k=draw.randint(1, 4))) for _ in range(2000)]
    texts = [w + "".join(draw.choices("!,.%'|_-", k=draw.randint(0, 3))) for w in words]
    texts += [" ".join(texts[k : k + 20]) for k in range(0, 2000, 20)]
    for text, ids in zip(texts, tokens.Encoder(content).ids(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
    encoder = tokens.Encoder(content)
    list(encoder.ids(["dog café a,%%% a!! a**"]))
    asked = []
    ask = encoder._asked
    monkeypatch.setattr(encoder, "_asked", lambda texts: asked.extend(texts) or ask(texts))
    list(encoder.ids(["dog,%%% café!! Dog** dog!! dogs"]))
    assert not asked


def test_simple8b_takes_the_fullest_words():
    draw = np.random.default_rng(4)
    for n, stretch in ((1, 7), (63, 64), (1000, 100), (1024, 1024), (3000, 1024)):
        for low in (0, 30, 55):
            values = draw.integers(0, 2**64, n, dtype=np.uint64)
            values >>= draw.integers(low, 64, n).astype(np.uint64)
            words, firsts = simple8b.encode(values, stretch)
            wanted, begins = [], []
            for at in range(0, n, stretch):
                begins.append(sum(wanted))
                rest = values[at : at + stretch].tolist()
                while rest:
                    fits = (c for c, bits in simple8b.LAYOUTS if not max(rest[:c]) >> bits)
                    count = next(fits, 0)
                    wanted.append(1 if count else 2)
                    rest = rest[count or 1 :]
            assert len(words) == sum(wanted) and firsts.tolist() == begins
            assert (simple8b.decode(words, firsts, n, stretch) == values).all()


def test_a_worker_holds_one_thing(monkeypatch):
    monkeypatch.delitem(sys.modules, "_martlane_worker", raising=False)
    made = []
    for name in ("a", "a", "b", "b", "a"):
        assert kept_by_worker(name, lambda name=name: made.append(name) or name) == name
    assert made == ["a", "b", "a"]


def test_ids_do_not_depend_on_what_is_kept(monkeypatch):
    content = tokens.public(tokens.WORD_BPE)
    texts = ["one two, three.", "two three four, four."] * 3
    want = list(tokens.Encoder(content).ids(texts))
    monkeypatch.setattr(tokens, "CHUNKS_KEPT", 0)
    monkeypatch.setattr(tokens, "RUN", 10)
    assert list(tokens.Encoder(content).ids(texts)) == want


def test_shingles_are_counted_like_tuples():
    for text in [b"", b" \t", b"a", b"a b", b"A B\tc d\x0bC D", b"a b c d c d e c d e"]:
        words = text.lower().split()
        want = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
        want = want if len(words) >= 3 else {tuple(words)} - {()}
        found = list(hashed_words.shingle_sets([b"q w", text, b""], 3))
        assert [len(x) for x in found] == [1, len(want), 0]


@pytest.mark.parametrize("percent", [80, 90])
def test_near_sets_share_a_key(percent):
    """For any choice of frequent shingles, at sizes around the borders of the schemes."""
    draw = np.random.default_rng(5)
    for trial in range(300):
        n = int(draw.choice([1, 5, 60, 127, 128, 142, 160, 400]))
        a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        both = int(np.ceil(len(a) * percent / 100))
        b = np.unique(np.concatenate([draw.permutation(a)[:both], a[:0]]))
        pool = draw.permutation(a)[: draw.integers(0, len(a) + 1)]
        frequent = np.sort(pool)
        assert 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b))
        shared = np.intersect1d(
            jaccard.keys(a, frequent, percent), jaccard.keys(b, frequent, percent)
        )
        assert len(shared), (trial, n, len(frequent))


@pytest.mark.parametrize("percent", [80, 90])
def test_lists_are_cut_only_between_sets_that_cannot_be_near(percent):
    draw = np.random.default_rng(7)
    n_of = draw.integers(1, 400, 300)
    every = draw.integers(0, 60, 2_000).astype(np.uint64)
    numbers = draw.integers(0, 300, 2_000)
    classes = np.column_stack([numbers, n_of[numbers]])
    got_keys, got = jaccard.by_size(every, classes, percent)
    lists = {}
    for key, (c, n) in zip(got_keys.tolist(), got.tolist(), strict=True):
        assert n == n_of[c]
        lists.setdefault(key, []).append(c)
    members = {}
    for key, c in zip(every.tolist(), numbers.tolist(), strict=True):
        members.setdefault(key, set()).add(c)
    together = {}
    for key, own in lists.items():
        assert own == sorted(set(own)) and len(own) > 1
        for a, b in itertools.combinations(own, 2):
            together[key % 2, a, b] = together.get((key % 2, a, b), 0) + 1
    near = {}
    for key, own in members.items():
        for a, b in itertools.combinations(sorted(own), 2):
            if 100 * min(n_of[a], n_of[b]) >= percent * max(n_of[a], n_of[b]):
                near[key % 2, a, b] = near.get((key % 2, a, b), 0) + 1
    # As many lists of each kind as keys have both of a pair that can be near.
    assert near and all(together[pair] == n for pair, n in near.items())
    assert len(lists) > len(members)
    pairs = np.array([[1, 10], [2, 99], [3, 50], [3, 50]])
    alone = jaccard.by_size(np.array([4, 4, 6, 6], np.uint64), pairs, percent)
    assert [len(x) for x in alone] == [0, 0]
    assert [len(x) for x in jaccard.by_size(every[:0], classes[:0], percent)] == [0, 0]


def test_packed_numbers_come_back():
    for numbers in ([], [0], [1, 255, 256, 70_000, 2**32 - 1]):
        assert jaccard.unpacked(jaccard.packed(np.array(numbers, np.int64))).tolist() == numbers


@pytest.mark.parametrize("percent", [80, 90])
def test_parities_leave_no_near_set_out(percent):
    """Sets at and around the threshold; parities of any length, folded ones too."""
    draw = np.random.default_rng(6)
    kept = 0
    for trial in range(400):
        n = int(draw.choice([1, 2, 30, 400, 3_000]))
        a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        share = draw.integers(percent - 12, 101) / 100
        b = draw.permutation(a)[: max(1, int(np.ceil(len(a) * share)))]
        b = np.unique(np.concatenate([b, draw.integers(0, 2**63, trial % 3).astype(np.uint64)]))
        both, n, m = len(np.intersect1d(a, b)), len(a), len(b)
        words = 1 << int(draw.integers(0, 8))
        wide = jaccard.parity(a, 2 * words)
        assert np.array_equal(jaccard.folded(wide, words), jaccard.parity(a, words))
        differ = np.bitwise_count(jaccard.folded(wide, words) ^ jaccard.parity(b, words)).sum()
        assert differ <= n + m - 2 * both
        near = 100 * both >= percent * (n + m - both)
        may = bool(jaccard.may_be_near(np.array([int(differ)]), np.array([n]), m, percent)[0])
        assert may or not near
        kept += may
    assert kept < 400


def brute_base(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = "".join(c if c >= "\x80" or c.isascii() and c.isalnum() else " " for c in words).split()
    found = []
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                found.append((i, label))
    return len(words), found


@pytest.mark.parametrize(
    "text",
    [
        "", "Under the MIT-License.", "under the mit licenses", "CC-BY-NC cc by nc",
        "é Apache License, Version 2.0 x under  the\nMIT license", "sub apache license version 2",
    ],
)
def test_base_phrases(text):
    rules = licenses.rules()
    n_words, found = brute_base(text)
    got = licenses.scan_text(text.encode(), rules)
    starts = [i for i, _ in found]
    assert got[:4] == (n_words, len(found), min(starts, default=None), max(starts, default=None))
    assert got[4] == ",".join(sorted({x for _, x in found}))
    assert {x for _, x in found} <= set(got[5].split(",")) if found else True
    assert 0 <= got[6] <= 1


def test_rules_resolve_overlaps():
    rules = licenses.rules()
    assert len(rules) > 300
    label = lambda text: licenses.scan_text(text, rules)[5]
    assert label(b"released under the BSD 3-Clause License") == "bsd-3-clause"
    assert label(b"GNU General Public License v3 license") == "gpl-3"
    assert label(b"the limit of the committee") == ""


def texts_of(tree):
    """A text for every way through a parsed expression (one digit stands for all)."""
    found = [""]
    for kind, value in tree:
        kind = str(kind)
        if kind == "LITERAL":
            own = [chr(value)]
        elif kind == "IN":
            own = [chr(v) if str(k) == "LITERAL" else "4" for k, v in value]
        elif kind == "BRANCH":
            own = [x for branch in value[1] for x in texts_of(branch)]
        elif kind == "MAX_REPEAT":
            assert value[:2] == (0, 1)
            own = ["", *texts_of(value[2])]
        elif kind == "SUBPATTERN":
            own = texts_of(value[-1])
        else:
            assert kind in ("ASSERT", "ASSERT_NOT"), kind
            own = [""]
        found = [a + b for a in found for b in own]
    return found


def test_prefilter_passes_all_that_rules_match(monkeypatch):
    rules = licenses.rules()
    for keywords, pattern, *_ in rules:
        for text in texts_of(re._parser.parse(pattern.pattern.decode())):
            line = f" {text} ".encode()
            assert pattern.search(line)
            assert any(k in line for k in keywords), (keywords, line)
            assert any(word in line for word in licenses.SPEAKS), line
    texts = [
        f"x {form} y".replace("{name}", name).encode()
        for _, _, names in licenses.NAMES
        for name in texts_of(re._parser.parse(names))
        for form in ("{name} license", "released under the {name}", "{name}")
    ]
    got = [licenses.scan_text(text, rules) for text in texts]
    monkeypatch.setattr(licenses, "SPEAKS", (b" ",))
    whole = [((b" ",), *rule[1:]) for rule in rules]
    assert got == [licenses.scan_text(text, whole) for text in texts]


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("0BSD License", "0bsd"), ("licensed under FreeBSD", "bsd-2-clause"),
        ("the Expat license", "mit"), ("MIT No Attribution License", "mit-0"),
        ("BSD Zero Clause", "0bsd"), ("by-nc-nd 4.0", "cc-by-nc-nd"), ("Creative Commons", "cc"),
        ("Creative Commons Attribution-Non-Commercial 4.0", "cc-by-nc"),
    ],
)
def test_names_in_other_words(text, label):
    assert licenses.scan_text(text.encode(), licenses.rules())[5] == label


def test_least_count_keeps_the_wanted_recall():
    assert near_vectors.least_count(40, 9.0, 0.995) == 40
    assert near_vectors.least_count(40, 1.6, 0.995) < 36


def test_network_learns_and_is_calibrated():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, 6))
    y = (draw.random(3000) < 1 / (1 + np.exp(-3 * x[:, 0] * np.sign(x[:, 1])))).astype(float)
    net = quality.fit(x[:2000], y[:2000])
    p = net.probability(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.75
    assert abs(p.mean() - y[2000:].mean()) < 0.06
    assert quality.fit(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]
    assert quality.fit(x[:9], np.ones(9)).probability(x[:2]).min() > 0.9

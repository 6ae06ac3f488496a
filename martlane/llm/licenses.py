"""License scan by ordered signature rules.

A text becomes its lower-case words with one space between them. A keyword
prefilter decides which rules are worth trying: a rule is tried only where its
license's keyword occurs beside a word that speaks of licenses, and no rule can match
without one of its keywords and one of these words. Each rule is a
regular expression with a label, a priority and a weight; the rules are the
license names in each of the forms in which texts refer to them. What they find
are intervals of words. They are taken by priority, then length, then place; one
that lies inside an interval already taken is suppressed, so "BSD 3-Clause
License" is not also "BSD license".

The base phrases are looked for separately, all their places count, and their
labels always stay.

Defined results: a null or empty text has no words, no labels (empty strings),
null places and score 0; rows with equal doc_id are scanned each for itself; a text of
any length is scanned whole, in time about in proportion to its length; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from martlane.llm.common import documents, kept_by_worker

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, n_detections long"
)

# The base phrases, in words, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label, keywords, and pattern of the name in lower-case words. Each alternative of
# the pattern has one of the keywords (between bars) in it, from the beginning of a word.
NAMES = [
    ("mit", "mit|expat", r"(?:mit|expat)(?: x11)?"),
    ("mit-0", "mit 0|mit no attribution", r"mit 0|mit no attribution"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: licen[sc]e)?(?: version)? 1 1"),
    ("apache-2", "apache", r"apache(?: software)?(?: licen[sc]e)?(?: version| v)? 2(?: 0)?"),
    ("apache", "apache", r"apache(?: software)?"),
    ("bsd-2-clause", "bsd|freebsd", r"(?:bsd 2 clause|simplified bsd|freebsd)"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|new bsd|modified bsd|revised bsd)"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|original bsd)"),
    ("0bsd", "bsd|0bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)"),
    ("bsd", "bsd", r"bsd"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl(?: version| v)? ?2(?: 0)?"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl(?: version| v)? ?3(?: 0)?"),
    ("gpl-2", "general public", r"(?:gnu )?general public licen[sc]e(?: version| v) ?2(?: 0)?"),
    ("gpl-3", "general public", r"(?:gnu )?general public licen[sc]e(?: version| v) ?3(?: 0)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("gpl", "general public", r"gnu general public"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl(?: version| v)? ?2 1"),
    ("lgpl-3", "lgpl", r"(?:gnu )?lgpl(?: version| v)? ?3(?: 0)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public"),
    ("agpl-3", "agpl", r"(?:gnu )?agpl(?: version| v)? ?3(?: 0)?"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("agpl", "affero", r"(?:gnu )?affero general public"),
    ("mpl-1.1", "mozilla", r"mozilla public(?: licen[sc]e)?(?: version| v)? 1 1"),
    ("mpl-2", "mozilla", r"mozilla public(?: licen[sc]e)?(?: version| v)? 2(?: 0)?"),
    ("mpl-2", "mpl", r"mpl(?: version| v)? ?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public"),
    ("epl-1", "eclipse", r"eclipse public(?: licen[sc]e)?(?: version| v)? 1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public(?: licen[sc]e)?(?: version| v)? 2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public"),
    ("cddl", "cddl", r"cddl(?: 1 [01])?"),
    ("cddl", "development and distribution", r"common development and distribution"),
    ("cpl", "common public", r"common public"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("boost", "boost", r"boost(?: software)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("artistic-2", "artistic", r"artistic(?: licen[sc]e)?(?: version| v)? 2(?: 0)?"),
    ("artistic", "artistic", r"artistic"),
    ("python", "python", r"python(?: software foundation)?"),
    ("postgresql", "postgresql", r"postgresql"),
    ("openssl", "openssl", r"openssl"),
    ("ofl", "open font", r"(?:sil )?open font"),
    ("eupl", "eupl", r"eupl(?: 1 [12])?"),
    ("eupl", "european union public", r"european union public"),
    ("odbl", "database", r"open(?: data commons)?(?: open)? database"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "nc nd", r"(?:cc )?by nc nd(?: \d 0)?"),
    ("cc-by-nc-sa", "nc sa", r"(?:cc )?by nc sa(?: \d 0)?"),
    ("cc-by-nc", "by nc", r"cc by nc(?: \d 0)?"),
    ("cc-by-sa", "by sa", r"cc by sa(?: \d 0)?"),
    ("cc-by-nd", "by nd", r"cc by nd(?: \d 0)?"),
    ("cc-by", "cc by", r"cc by(?: \d 0)?"),
    (
        "cc-by-nc-sa",
        "noncommercial",
        r"creative commons attribution noncommercial share ?alike(?: \d 0)?",
    ),
    (
        "cc-by-nc",
        "noncommercial|non commercial",
        r"creative commons attribution non ?commercial(?: \d 0)?",
    ),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike(?: \d 0)?"),
    ("cc-by", "creative", r"creative commons attribution(?: \d 0)?"),
    ("cc", "creative", r"creative commons"),
    ("proprietary", "proprietary", r"proprietary"),
    ("public-domain", "public domain", r"public domain"),
]

# Forms in which a text refers to a license: pattern, priority, weight.
FORMS = [
    (r"spdx licen[sc]e identifier {name}", 60, 1.0),
    (
        r"(?:licen[sc]ed|released|distributed|published|available|provided|made available) under"
        r" (?:the )?(?:terms of )?(?:the )?{name}(?: licen[sc]e)?",
        50,
        0.95,
    ),
    (r"(?:subject to|governed by|covered by) (?:the )?{name}(?: licen[sc]e)?", 40, 0.9),
    (r"under (?:the )?{name} licen[sc]e", 35, 0.9),
    (r"(?:see|read|view) (?:the )?{name} licen[sc]e", 30, 0.8),
    (r"{name} licen[sc]e", 20, 0.7),
    (r"licen[sc]e (?:is )?{name}", 10, 0.6),
]
# Names that say enough alone.
ALONE = re.compile(r"^(?:cc|cc0|wtfpl|unlicense|0bsd)")
# Every form, and every name that says enough alone, has one of these in it.
SPEAKS = (
    *(b"licen", b"under", b"subject to", b"governed", b"covered", b"cc", b"wtfpl", b"0bsd"),
    *(b"by nc", b"creative commons", b"zero clause"),
)

_LOWER_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def rules() -> list[tuple[tuple[bytes, ...], re.Pattern, str, int, float]]:
    """Keywords, expression, label, priority, weight: every name in every form."""
    made = []
    for label, keywords, name in NAMES:
        begun = tuple(f" {keyword}".encode() for keyword in keywords.split("|"))
        forms = FORMS + [(r"{name}", 5, 0.5)] * bool(ALONE.match(label))
        for form, priority, weight in forms:
            whole = rf"(?<= )(?:{form.replace('{name}', f'(?:{name})')})(?= )"
            made.append((begun, re.compile(whole.encode()), label, priority, weight))
    return made


def words(text: bytes) -> list[bytes]:
    return text.translate(_LOWER_WORDS).split()


def _before(line: bytes, starts: list[int]) -> list[int]:
    """How many spaces come before each place."""
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    return np.searchsorted(spaces, starts).tolist()


def _base(line: bytes) -> list[tuple[int, str]]:
    found = []
    for phrase, label in BASE.items():
        whole, starts = b" " + phrase.encode() + b" ", []
        at = line.find(whole)
        while at >= 0:
            starts.append(at)
            at = line.find(whole, at + 1)
        if starts:
            found += [(first, label) for first in _before(line, starts)]
    return found


def detections(line: bytes, all_rules: list) -> list[tuple[int, int, str, float]]:
    """Intervals (first word, word after the last, label, weight) that none of more rank contains."""
    if not any(word in line for word in SPEAKS):
        return []
    present = {}
    found = []
    for keywords, pattern, label, priority, weight in all_rules:
        if keywords not in present:
            present[keywords] = any(keyword in line for keyword in keywords)
        if not present[keywords]:
            continue
        met = [(match.start(), match[0].count(b" ")) for match in pattern.finditer(line)]
        if not met:
            continue
        # The words before a match, from the places of all spaces.
        for before, (_, size) in zip(_before(line, [at for at, _ in met]), met, strict=True):
            first, after = before - 1, before + size
            found.append((-priority, first - after, first, after, label, weight))
    return _outermost(sorted(found))


def _outermost(found: list[tuple]) -> list[tuple[int, int, str, float]]:
    """The intervals that none before them contains.

    Of those kept, only intervals that none of the others contains are looked at: sorted by
    their begin they are sorted by their end, so the last one that begins in time decides.
    """
    kept: list[tuple[int, int, str, float]] = []
    begins: list[int] = []
    ends: list[int] = []
    for _, _, first, after, label, weight in found:
        at = bisect_right(begins, first)
        if at and ends[at - 1] >= after:
            continue
        kept.append((first, after, label, weight))
        low, high = bisect_left(begins, first), bisect_right(ends, after)
        begins[low:high], ends[low:high] = [first], [after]
    return kept


def scan_text(text: bytes, all_rules: list) -> tuple:
    own = words(text)
    line = b" " + b" ".join(own) + b" "
    base = _base(line)
    found = detections(line, all_rules)
    starts = [at for at, _ in base]
    base_labels = {label for _, label in base}
    labels = base_labels | {label for _, _, label, _ in found}
    score = max([x[3] for x in found] + [1.0] * bool(base), default=0.0)
    return (
        *(len(own), len(base), min(starts, default=None), max(starts, default=None)),
        *(",".join(sorted(base_labels)), ",".join(sorted(labels)), score, len(found)),
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per document, over its whole text."""
    columns = [part.split()[0] for part in RESULT.split(", ")]

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_rules = kept_by_worker("license_rules", rules)
        for batch in batches:
            found = [scan_text(text, all_rules) for text in batch["bytes"]]
            out = pd.DataFrame(found, columns=columns[1:])
            for name in ("first_word", "last_word"):
                out[name] = out[name].astype("Int64")
            out.insert(0, "doc_id", batch["doc_id"])
            yield out

    return documents(docs).mapInPandas(scanned, RESULT)

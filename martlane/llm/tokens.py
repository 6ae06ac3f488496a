"""Token ids of whole texts by the tokenizers library, a word at a time.

Both vocabularies split a text at white space before anything else, so a text's
ids are its chunks' ids in a row, and a chunk's are those of the word and of the signs
after it. Pieces repeat, texts do not: each task asks the library once per new piece of a
run; chunks become numbers, and ids are gathered by these. A piece of letters
only goes to the library's model at once, others through all of the library, many of
them together, a special token between them. The piece store is Arrow arrays of
bounded size; when it is full, further new pieces are encoded without being kept. The ids are
those of encoding the whole text at once, whatever the store holds. The library cuts a
text at its special tokens before anything else; a text that holds one is encoded whole.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from string import punctuation

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from martlane.llm.common import kept_by_worker

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
CHUNKS_KEPT = 500_000
RUN = 4_000_000  # characters whose new chunks are encoded in one call
LONGEST_KEPT = 64  # characters of a piece worth keeping
TOGETHER = 1000  # new chunks that are one text for the library

# White space as the library's patterns have it (Python's \s has more).
_SPACE = r"\t-\r \x85\xa0  -     　"
# Letters that are one character in every normal form and whose lower case is one too.
_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-įı-ȿ]+")
# Bytes as the models' characters: those without a sign of their own come after 255.
_SIGNLESS = [*range(33), *range(127, 161), 173]
_BYTES = {byte: 256 + k for k, byte in enumerate(_SIGNLESS)}
# Coarser than the byte-level pattern, with cuts at the same places around white space:
# a space goes with the chunk it precedes, the rest of a run of white space is its own.
_BYTE_CHUNKS = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def vocabulary(path: str) -> str:
    """A tokenizer file's content, to be sent with the job."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def public(name: str) -> str:
    return vocabulary(public_tokenizers.path(name))


def _pieces(chunks: pa.LargeStringArray) -> pa.LargeStringArray:
    """Two pieces of each chunk, which is their ids in a row: up to its last letter, and the signs
    after that, as no token holds a letter and the sign after it. Others are their first piece."""
    n = len(chunks)
    _, offsets, data = chunks.buffers()
    ends = np.frombuffer(offsets, np.int64)[chunks.offset :][: n + 1] if n else np.zeros(1, np.int64)
    size = int(ends[-1])
    text = np.zeros(size + 2, np.uint8)
    if size:
        text[2:] = np.frombuffer(data, np.uint8)[:size]
    stems = pc.binary_length(pc.utf8_rtrim(chunks, characters=punctuation))
    cut = ends[:-1] + stems.to_numpy(zero_copy_only=False)
    before, last = text[cut], text[cut + 1]
    letter = (last | 0x20) - np.uint8(ord("a")) < 26
    # As in _WORD: C3 to C8 begin the letters from 0xC0 to 0x23F, but for the signs × and ÷ and İ.
    other = (before >= 0xC3) & (before <= 0xC8) & (last >= 0x80) & (last < 0xC0)
    other &= ~((before == 0xC3) & ((last == 0x97) | (last == 0xB7)))
    other &= ~((before == 0xC4) & (last == 0xB0))
    cuts = (cut > ends[:-1]) & (letter | other)
    both = np.empty(2 * n + 1, np.int64)
    both[::2] = ends
    both[1::2] = np.where(cuts, cut, ends[1:])
    return pa.LargeStringArray.from_buffers(2 * n, pa.py_buffer(both), data)


def _spread(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray):
    """The stretches of the data in the given order, in a row."""
    n = sizes[which]
    after = np.cumsum(n)
    at = np.repeat(starts[which] - after + n, n)
    at += np.arange(len(at))
    return data[at]


class Encoder:
    """ids(texts): each text's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.byte_level = '"use_regex":true' in re.sub(r"\s", "", content[:4000])
        # The store: pieces, their ids in a row, and how many each has.
        self.pieces = pa.array([], pa.large_string())
        self.data, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)

    def _chunks(self, texts: list[str]) -> pa.LargeListArray:
        if self.byte_level:
            kind = pa.large_list(pa.large_string())
            return pa.array([_BYTE_CHUNKS.findall(x) for x in texts], kind)
        texts = [(x.lower() if x.isascii() else x).replace("\n", " ") for x in texts]
        return pc.split_pattern(pa.array(texts, pa.large_string()), " ")

    def ids(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order; texts are worked through in runs of bounded size."""
        run: list[str] = []
        size = 0
        for text in texts:
            if self._marked(text):
                yield from self._joined(run)
                run, size = [], 0
                yield self._asked([text])[0]
                continue
            run.append(text)
            size += len(text)
            if size >= RUN:
                yield from self._joined(run)
                run, size = [], 0
        yield from self._joined(run)

    def _marked(self, text: str) -> bool:
        """Whether the text, or what its chunks are made of, holds a special token."""
        lower = text.lower()
        return any(mark in text or mark in lower for mark in self.special)

    def _asked(self, texts: list[str]) -> list[bytes]:
        encoded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in encoded]

    def _asked_together(self, chunks: list[str]) -> list[bytes]:
        """As ``_asked``, for chunks without special tokens: many in one text, a special token,
        at which the library cuts a text before all else, between them."""
        if not self.special:
            return self._asked(chunks)
        mark, found = self.special[0], []
        between = self.library.token_to_id(mark)
        for at in range(0, len(chunks), TOGETHER):
            some = chunks[at : at + TOGETHER]
            ids = np.frombuffer(self._asked([mark.join(some)])[0], np.uint32)
            cuts = np.flatnonzero(ids == between)
            if len(cuts) != len(some) - 1:  # a token that takes white space beside it along
                found += self._asked(some)
                continue
            data, ends = ids.tobytes(), (4 * cuts).tolist()
            starts = [0, *(x + 4 for x in ends)]
            found += [data[a:b] for a, b in zip(starts, [*ends, len(data)], strict=True)]
        return found

    def _joined(self, run: list[str]) -> Iterator[bytes]:
        chunks = self._chunks(run)
        ends = chunks.offsets.to_numpy().tolist()
        coded = chunks.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        # A chunk's ids are those of its two pieces.
        pieces = _pieces(coded.dictionary).dictionary_encode()
        at = pieces.indices.to_numpy()
        data, starts, sizes = self._known(pieces.dictionary)
        data = _spread(data, starts, sizes, at)
        sizes = sizes[at].reshape(-1, 2).sum(axis=1)
        starts = np.cumsum(sizes) - sizes
        for a, b in zip(ends, ends[1:], strict=False):
            yield _spread(data, starts, sizes, which[a:b]).tobytes()

    def _known(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each piece begin and how many; new ones are kept while there
        is room."""
        found = pc.index_in(pieces, value_set=self.pieces)
        missed = pieces.filter(found.is_null())
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        own = self._new(missed.to_pylist())
        n_kept = len(self.sizes)
        at[at < 0] = n_kept + np.arange(len(own))
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        sizes = np.concatenate([self.sizes, sizes])
        data = np.concatenate([self.data, np.frombuffer(b"".join(own), np.uint32)])
        starts = np.cumsum(sizes) - sizes
        if n_kept < CHUNKS_KEPT:
            short = pc.less_equal(pc.utf8_length(missed), LONGEST_KEPT)
            kept = n_kept + np.flatnonzero(short.to_numpy(zero_copy_only=False))
            self.pieces = pa.concat_arrays([self.pieces, missed.filter(short)])
            self.data = np.concatenate([self.data, _spread(data, starts, sizes, kept)])
            self.sizes = np.concatenate([self.sizes, sizes[kept]])
        return data, starts[at], sizes[at]

    def _new(self, pieces: list[str]) -> list[bytes]:
        found = [self._word(x) if _WORD.fullmatch(x) else None for x in pieces]
        whole = [k for k, ids in enumerate(found) if ids is None]
        asked = self._asked_together([pieces[k] for k in whole])
        for k, ids in zip(whole, asked, strict=True):
            found[k] = ids
        return found

    def _word(self, word: str) -> bytes:
        """The ids of letters (with a space before them, if the vocabulary has such words): one
        piece for the library's model, so its other steps are passed over."""
        if not self.byte_level:
            word = word.lower()
        if not word.isalpha() or not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTES)
        return array("I", [x.id for x in self.library.model.tokenize(word)]).tobytes()


def encoder(content: str) -> Encoder:
    return kept_by_worker(f"encoder_{zlib.crc32(content.encode())}", lambda: Encoder(content))

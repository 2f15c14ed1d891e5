"""The tokenizers library's ids of whole texts, with each distinct unit of a step encoded once.

A text is cut where an ASCII white-space character follows another character,
and where ASCII punctuation follows an ASCII letter or digit.  Neither
tokenizer's pattern has a match over such a place, and neither looks back, so
the ids of a text are those of its units one after the other.  White
space outside ASCII (and the separators 0x1C-0x1F) next to ASCII white space
would form one run with it; a text that has any is one unit.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa

from .common import buffer_of
from .spans import LOWER, WHITE

#: Distinct units of each of two generations that a worker remembers; a full younger one becomes the older.
REMEMBERED = 500_000
#: Units that one call of the library encodes, with an added token between them (which the library splits a text at), and the longest of them in bytes.
TOGETHER = 200
LONG = 4096
#: Letters below are in composed form, and letters in any version of Unicode; a unit of such goes to the library's model straight.
BEYOND = "\u0250"
OTHER_WHITE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\xef\xbb\xbf")


def byte_names() -> list[str]:
    """The character that stands for each byte in the vocabularies: printable Latin-1 itself, others from U+0100 on."""
    names, more = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            names.append(chr(b))
        else:
            names.append(chr(256 + more))
            more += 1
    return names


def load(file: str):
    """The library's tokenizer of a file, without its own threads, truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(file)
    made.no_truncation()
    made.no_padding()
    return made


ALNUM, PUNCT = np.zeros(256, bool), np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _after_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where ASCII punctuation follows an ASCII letter or digit: a place that no match spans.

    There is none in texts with what may be an added token, which would be cut.
    """
    cut = np.zeros(len(data), bool)
    if len(data):
        cut[1:] = PUNCT[data[1:]] & ALNUM[data[:-1]]
        for at in np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)).tolist():
            d = int(np.searchsorted(offsets, at, "right")) - 1
            cut[offsets[d] : offsets[d + 1]] = False
    return cut


def units_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units (leading white space and what follows it) of null-free texts, as an Arrow binary array, and each text's bounds."""
    data, offsets = buffer_of(texts)
    white = WHITE[data]
    cut = _after_words(data, offsets)
    cut[1:] |= white[1:] & ~white[:-1]
    whole = {int(np.searchsorted(offsets, m.start(), "right")) - 1 for m in OTHER_WHITE.finditer(data)} if len(data) else ()
    for d in whole:
        cut[offsets[d] : offsets[d + 1]] = False
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    at = np.flatnonzero(cut)
    ends = np.append(at, len(data)).astype(np.int32)
    units = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    return units, np.searchsorted(at, offsets)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """As :func:`units_of` for a tokenizer that lower-cases and drops white space.

    A-Z are lower-cased here already, so that fewer words are distinct, except
    before a character that could compose with them, and in a step that holds
    what may become an added token.
    """
    data, offsets = buffer_of(texts)
    if len(data) and not ((data[:-1] == 0x3C) & (data[1:] == 0x7C)).any():
        data = np.where(np.append(data[1:], 0) < 0x80, LOWER[data], data)
    white = WHITE[data]
    cut = _after_words(data, offsets)
    cut[1:] |= white[:-1]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    cut &= ~white
    at = np.flatnonzero(cut)
    held = ~white
    place = np.cumsum(held) - 1
    ends = np.append(place[at], int(held.sum())).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data[held])]), np.searchsorted(at, offsets)


def spread(flat: np.ndarray, lengths: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the pieces ``index`` of ``flat``, whose pieces have ``lengths``; also the cumulated lengths."""
    starts = np.cumsum(lengths) - lengths
    own = lengths[index]
    upto = np.zeros(len(index) + 1, np.int64)
    np.cumsum(own, out=upto[1:])
    kind = np.int32 if max(len(flat), int(upto[-1])) < 1 << 31 else np.int64
    at = np.repeat((starts[index] - upto[:-1]).astype(kind), own)
    at += np.arange(upto[-1], dtype=kind)
    return flat[at], upto


class Encoder:
    """Ids of texts by the library."""

    def __init__(self, file: str, words_only: bool, remembered: int = REMEMBERED):
        self.remembered, self.words_only = remembered, words_only
        self.library, self.cut, self.known = load(file), words_of if words_only else units_of, {}
        self.older: dict[bytes, bytes] = {}
        self.model, self.shown = self.library.model, dict(enumerate(byte_names()))
        self.between = max(self.library.get_added_tokens_decoder().items())[1].content.encode()
        self.between_id = self.library.token_to_id(self.between.decode())

    def lookup(self, units: list[bytes]) -> list[bytes]:
        """Each distinct unit's ids as little-endian 32-bit integers."""
        known = self.known
        missing = [u for u in units if u not in known]
        if missing:
            if len(known) > self.remembered:
                self.older, self.known = known, {}
                known, missing = self.known, units
            older = self.older
            known.update((u, older[u]) for u in missing if u in older)
            missing = [u for u in missing if u not in known]
            tokenize, shown, fit = self.model.tokenize, self.shown, self._is_plain
            for u in missing:
                if fit(u):
                    ids = [t.id for t in tokenize(u.decode("latin-1").translate(shown))]
                    known[u] = struct.pack(f"<{len(ids)}I", *ids)
            missing = [u for u in missing if u not in known]
            short = [u for u in missing if len(u) <= LONG and b"<|" not in u]
            for at in range(0, len(short), TOGETHER):
                some = short[at : at + TOGETHER]
                ids = np.array(self._ids(self.between.join(some)), "<u4")
                cuts, raw = np.flatnonzero(ids == self.between_id) * 4, ids.tobytes()
                known.update((u, raw[a:z]) for u, a, z in zip(some, [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(raw)], strict=True))
            known.update((u, np.array(self._ids(u), "<u4").tobytes()) for u in missing if u not in known)
        return [known[u] for u in units]

    def _is_plain(self, unit: bytes) -> bool:
        """Letters below U+0250 alone (behind a space at most, or in lower case): normaliser and pattern leave them whole."""
        if unit.isascii():
            return unit.isalpha() and unit.islower() if self.words_only else unit[unit[:1] == b" " :].isalpha()
        text = unit.decode()
        if self.words_only:
            return text.isalpha() and max(text) < BEYOND and text == text.lower()
        text = text[text[0] == " " :]
        return text.isalpha() and max(text) < BEYOND

    def _ids(self, text: bytes) -> list[int]:
        return self.library.encode(text.decode(), add_special_tokens=False).ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts as one array and each text's bounds in it."""
        units, bounds = self.cut(texts)
        if not len(units):
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        coded = units.dictionary_encode()
        pieces = self.lookup(coded.dictionary.to_pylist())
        lengths = np.array([len(p) for p in pieces], np.int64) // 4
        ids, upto = spread(np.frombuffer(b"".join(pieces), "<u4"), lengths, coded.indices.to_numpy())
        return ids, upto[bounds]


_ENCODERS: dict[tuple[str, bool, int], Encoder] = {}


def encoder(file: str, words_only: bool, remembered: int = REMEMBERED) -> Encoder:
    """This process's encoder of a file."""
    key = file, words_only, remembered
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and bounds with ``end`` after each text's ids."""
    return np.insert(ids, bounds[1:], end), bounds + np.arange(len(bounds))

"""Encoding by pieces that a byte-level pre-tokenizer never joins.

The vocabularies' pattern ends a match before white space that follows anything
else, between letters and a following ASCII character that is no letter, and
between ASCII punctuation (apostrophes aside) and a following letter. Pieces cut
at such places can be encoded on their own, so each worker encodes a piece once
with the tokenizers library and reuses its ids. Texts repeat words; the cache is
bounded and only saves time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# White space as Unicode has it, and Latin letters; both may be smaller than the
# pattern's own classes, never larger, except for white space, which is equal.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTER = "A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u024f"
_SIGN = "!-&(-/:-@\\[-`{-~"
PIECE = re.compile(
    f"[{_SPACE}]*[{_LETTER}]+(?=[!-/0-9:-@\\[-`{{-~{_SPACE}]|\\Z)"
    f"|[{_SPACE}]*[{_SIGN}]+(?=[{_LETTER}{_SPACE}]|\\Z)"
    f"|[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
CACHE = 300_000
HELD = 500_000
_SLICE = 1 << 20
LONG = 64


class PieceCache:
    """Values of pieces, made in batches by ``make`` (a list of pieces to a list of values)."""

    def __init__(self, make: Callable[[list[str]], Iterable], limit: int = CACHE):
        self.make, self.limit, self.known = make, limit, {}

    def of(self, texts: list[str]) -> list[list]:
        """For each text the values of its pieces, in order."""
        cut = [PIECE.findall(t) for t in texts]
        every = set().union(*cut)
        new = list(every.difference(self.known))
        if len(self.known) + len(new) > self.limit:
            self.known, new = {}, list(every)
        known = self.known
        if new:
            known.update(zip(new, self.make(new)))
        out = [list(map(known.__getitem__, pieces)) for pieces in cut]
        for p in new:
            if len(p) > LONG:
                del known[p]
        if len(known) > self.limit:
            self.known = {}
        return out


def by_size(texts: Iterable[str | None], chars: int = 1 << 18) -> Iterable[list[str]]:
    """The texts (null as empty) in lists of about ``chars`` characters, at least one text each."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


# Kinds of bytes: blank, other white space, ASCII letter or last byte of a Latin one, digit,
# sign, apostrophe, first byte of a Latin letter of two bytes, all others.
_OTHER, _BLANK, _WHITE, _ALPHA, _DIGIT, _PUNCT, _QUOTE, _LEAD = range(8)
_KIND = bytearray(256)
for _kind, _held in ((_BLANK, b" "), (_WHITE, b"\t\n\x0b\x0c\r"), (_DIGIT, b"0123456789"), (_QUOTE, b"'"), (_LEAD, range(0xC3, 0xC9)),
                     (_ALPHA, (*range(65, 91), *range(97, 123))), (_PUNCT, b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')):
    for _byte in _held:
        _KIND[_byte] = _kind
# Whether a match always ends between two bytes, the kind of the first times 16 plus that of the second.
_CUT = bytearray(256)
for _kind, _after in ((_ALPHA, (_BLANK, _WHITE, _DIGIT, _PUNCT, _QUOTE)), (_DIGIT, (_BLANK, _WHITE, _ALPHA, _PUNCT, _QUOTE, _LEAD)),
                      (_PUNCT, (_BLANK, _WHITE, _ALPHA, _DIGIT, _LEAD)), (_QUOTE, (_BLANK, _WHITE, _DIGIT)),
                      (_WHITE, (_ALPHA, _DIGIT, _PUNCT, _QUOTE, _LEAD))):
    for _byte in _after:
        _CUT[_kind * 16 + _byte] = 1
_KIND, _CUT = bytes(_KIND), bytes(_CUT)
# Pieces that are one match of the pattern, whatever stands beside them.
SINGLE = f"\\A ?(?:[A-Za-zÀ-ÖØ-öø-ɏ]+|[{_SIGN}]+|[0-9]+)\\z"
_BYTE_SIGNS = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
_BYTE_SIGNS |= {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _BYTE_SIGNS)}


def cut_marks(data: bytes) -> np.ndarray:
    """For each byte of UTF-8 text, whether a match of the pattern always ends before it; all at once."""
    kinds = np.frombuffer(bytearray(data.translate(_KIND)), np.uint8)
    lead = np.flatnonzero(kinds[:-1] == _LEAD)
    raw = np.frombuffer(data, np.uint8)
    letter = (raw[lead] != 0xC3) | (raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)  # not the signs of multiplication and division
    kinds[lead + 1] = np.where(letter, _ALPHA, _OTHER)
    kinds[lead[~letter]] = _OTHER
    marks = np.zeros(len(data), bool)
    if len(data):
        marks[1:] = np.frombuffer((kinds[:-1] << 4 | kinds[1:]).tobytes().translate(_CUT), bool)
        # White space before a match goes elsewhere if more of it stands before; alone it is a match.
        white = np.flatnonzero(kinds[:-1] == _WHITE)
        marks[white + 1] &= marks[white]
    return marks


class TokenIds:
    """Ids of whole texts by a byte-level tokenizer, whose model sees each different piece once while it is held.

    Different pieces of many texts are found with one Arrow dictionary; what is
    held is bounded and only saves time.
    """

    def __init__(self, model: str, limit: int = HELD):
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True
        given = json.loads(model)
        # The model may be asked for pieces that are one match, if nothing else changes them before it.
        self.direct = given.get("normalizer") is None and all(t["special"] for t in given.get("added_tokens", ())) and \
            {k: (given.get("pre_tokenizer") or {}).get(k) for k in ("type", "add_prefix_space", "use_regex")} == \
            {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.limit = limit
        self.known = pa.array([], pa.large_string())
        self.ids, self.offsets = np.empty(0, np.uint32), np.zeros(1, np.int64)  # those of a piece end where the next one's start
        self.met = np.empty(0, np.int64)

    def of(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none), each closed by ``end``, one text after the other, and the number of each text's ids."""
        texts = texts.cast(pa.large_string()).fill_null("")
        bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        size = int(bounds[-1] - bounds[0])
        data = texts.buffers()[2].slice(int(bounds[0]), size) if size else pa.py_buffer(b"")
        bounds = bounds - bounds[0]
        # Some bytes at a time take little memory; a cut missed between them only makes a piece longer.
        marks = np.concatenate([cut_marks(data.slice(at, min(_SLICE, size - at)).to_pybytes()) for at in range(0, size + 1, _SLICE)])
        marks[bounds[:-1][bounds[:-1] < size]] = True
        starts = np.flatnonzero(marks)
        entry = self._entries(pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, size)), data))
        # Pieces take their ids, an end after each text that of one more entry.
        lists = pa.LargeListArray.from_arrays(np.append(self.offsets, len(self.ids) + 1), np.append(self.ids, np.uint32(end)))
        last = np.searchsorted(starts, bounds[1:])
        chosen = lists.take(pa.array(np.insert(entry, last, len(self.known))))
        if len(self.known) > self.limit:
            self._forget()
        pa.default_memory_pool().release_unused()
        return chosen.flatten().to_numpy(), np.diff(np.asarray(chosen.offsets)[last + np.arange(1, len(last) + 1)], prepend=0)

    def _entries(self, pieces: pa.Array) -> np.ndarray:
        if not len(pieces):
            return np.empty(0, np.int32)
        # The pieces held stand first, so each keeps its number; new ones follow.
        coded, held = pieces.dictionary_encode(), len(self.known)
        both = pa.chunked_array([self.known, coded.dictionary]).dictionary_encode().chunk(int(held > 0))
        entry, self.known = np.asarray(both.indices).take(np.asarray(coded.indices)), both.dictionary
        if len(self.known) > held:
            ids, sizes = self._encode(self.known[held:])
            self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(np.array(sizes, np.int64))))
            self.ids = np.concatenate((self.ids, np.array(ids, np.uint32)))
        self.met = np.bincount(entry, minlength=len(self.known)) + np.pad(self.met, (0, len(self.known) - held))
        return entry

    def _forget(self) -> None:
        """Keep the pieces met most often, at most half of the limit; none that is long."""
        least = max(2, int(np.partition(self.met, -(self.limit // 2))[-(self.limit // 2)]) + 1)
        keep = (self.met >= least) & (np.asarray(pc.binary_length(self.known)) <= LONG)
        sizes = np.diff(self.offsets)
        self.ids, self.offsets = self.ids[np.repeat(keep, sizes)], np.concatenate(([0], np.cumsum(sizes[keep])))
        self.known, self.met = self.known.filter(pa.array(keep)), self.met[keep] // 2

    def _encode(self, pieces: pa.Array) -> tuple[list[int], list[int]]:
        """Ids of all pieces, and the number of each one's."""
        single = np.asarray(pc.match_substring_regex(pieces, SINGLE)) & self.direct
        texts, tokenize = pieces.to_numpy(zero_copy_only=False).tolist(), self.tokenizer.model.tokenize
        rest = iter(self.tokenizer.encode_batch_fast([texts[i] for i in np.flatnonzero(~single).tolist()], add_special_tokens=False))
        ids, sizes = [], []
        for text, one in zip(texts, single.tolist()):
            if one:
                signs = text.replace(" ", "Ġ") if text.isascii() else text.encode().decode("latin-1").translate(_BYTE_SIGNS)
                own = [t.id for t in tokenize(signs)]
            else:
                own = next(rest).ids
            ids += own
            sizes.append(len(own))
        return ids, sizes


_HELD: dict[str, TokenIds] = {}


def token_ids(model: str) -> TokenIds:
    """What this worker holds for a tokenizer, kept for its next tasks; one tokenizer at a time."""
    if model not in _HELD:
        _HELD.clear()
        _HELD[model] = TokenIds(model)
    return _HELD[model]

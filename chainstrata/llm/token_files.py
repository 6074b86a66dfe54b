"""Token files: document ids coded by an adaptive context-mixing range coder.

A file is a table of frames; a frame holds the ids of whole, consecutive documents
in blocks. Every block starts from an empty model, has its own checksum and decodes
on its own. It begins with its different ids, in order; what follows speaks of
symbols, an id's number among those. Three predictors work inside a block: the
symbol that followed the last two when they last occurred (order 2), the same for
the last one (order 1), and the frequencies so far (order 0). For each state of
confidence of the first two, the block learns how often either is right; these
mixed chances, and the order-0 frequencies for all other symbols, drive a range
coder with 64-bit range and 32-bit output. The coder uses whole numbers only, and
the model's few divisions and products in double precision are cut to whole
numbers, so that any machine decodes what another has coded.

Many blocks are coded side by side: step t of all blocks is one set of numpy calls.
Frequencies are refreshed on a fixed schedule of positions, the predictors at every symbol.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from chainstrata.llm.chunks import token_ids
from chainstrata.llm.columns import shuffle_width
from chainstrata.session import materialized, scratch_path

BLOCK = 4096          # ids in a block at most
FRAME = 1 << 21       # ids after which a frame is closed
LANES = 512           # blocks coded side by side
WIDE = 2048           # blocks decoded side by side, of several frames
REFRESH = (128, 512, 1024, 2048, 3072)
EVENT_BITS, ID_BITS = 12, 12
BITS = EVENT_BITS + ID_BITS
_SLOTS = 4096         # contexts of order 1 and of order 2 in a block
_STATES = 32
IDS = 1 << 28         # ids must be smaller, as their gaps take at most four times 7 bits
_TABLE = 1 << 20      # ids below are numbered by a table, others by sorting
_CHUNK = 16           # steps whose chances the encoder looks up at once
_FULL, _LEAST, _WORD = np.uint64((1 << 64) - 1), np.uint64(1 << 32), np.uint64(32)
_SHIFT, _TOP = np.uint64(BITS), np.uint64((1 << BITS) - 1)


class _Model:
    """Guesses of many blocks, moved symbol by symbol.

    A context's slot holds the symbol that followed it last, times 4, plus how often
    in a row that was right (0 to 3); an empty slot holds -4.
    """

    def __init__(self, lanes: int, kind: type = np.int32):
        self.row, self.state_row = np.arange(lanes) * _SLOTS, np.arange(lanes) * _STATES
        self.slots1 = np.full(lanes * _SLOTS, -4, kind)
        self.slots2 = np.full(lanes * _SLOTS, -4, kind)
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)

    def predict(self, n: int) -> tuple[np.ndarray, ...]:
        """Contexts, their slots' contents, both guesses and the confidence state of the first ``n`` blocks."""
        at1, at2 = _slots(self.last[:n], self.before[:n])
        at1 += self.row[:n]
        at2 += self.row[:n]
        held1, held2 = self.slots1.take(at1), self.slots2.take(at2)
        guess1, guess2 = held1 >> 2, held2 >> 2
        state = ((held2 & 3) << 3) + ((held1 & 3) << 1) + (guess1 == guess2) + self.state_row[:n]
        return at1, at2, held1, held2, guess1, guess2, state

    def learn(self, ids: np.ndarray, event: np.ndarray, at1, at2, held1, held2, guess1, guess2, state) -> None:
        same = ids.astype(held1.dtype)
        fresh = same << 2
        surest = fresh | 3
        self.slots1[at1] = np.where(guess1 == same, np.minimum(held1 + 1, surest), fresh)
        self.slots2[at2] = np.where(event == 0, np.minimum(held2 + 1, surest), fresh)
        self.before, self.last = self.last, ids


def _slots(last: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the contexts of order 1 and order 2, from the last symbol and the one before."""
    return last & (_SLOTS - 1), (last * 2531 + before) & (_SLOTS - 1)


def _guesses(slots: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each position's slot holds when all symbols are known: the one that followed last (-1: none) and its confidence.

    One row a block. Positions sorted by slot, then place, stand next to the one
    that wrote their slot before; three neighbours tell a confidence of at most 3.
    """
    order = np.argsort(slots.astype(np.uint16), axis=1, kind="stable")
    order += (np.arange(len(ids)) * ids.shape[1])[:, None]
    order = order.ravel()
    slot, value = slots.ravel().take(order), ids.ravel().take(order)
    met = np.empty(len(order), bool)
    met[1:] = slot[1:] == slot[:-1]
    met[::ids.shape[1]] = False
    guess = np.full(len(order), -1, ids.dtype)
    np.copyto(guess[1:], value[:-1], where=met[1:])
    right = met & (guess == value)
    sure = np.zeros(len(order), np.int8)
    run = right[:-1]
    for back in range(1, 4):  # right once, twice and three times in a row before
        sure[back:] += run
        run = run[1:] & right[:-1 - back]
    sure *= met
    out = np.empty_like(guess), np.empty_like(sure)
    for placed, found in zip(out, (guess, sure)):
        placed[order] = found
    return out[0].reshape(ids.shape), out[1].reshape(ids.shape)


def _events(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State of confidence and event (0: order 2 is right, 1: order 1, 2: neither) of every position, one row a block."""
    state, event = np.empty(ids.shape, np.int8), np.empty(ids.shape, np.int8)
    for at in range(0, len(ids), 16):  # a few blocks at a time stay in the processor's cache
        part = ids[at:at + 16]
        last, before = np.zeros(part.shape, np.int64), np.zeros(part.shape, np.int64)
        last[:, 1:], before[:, 2:] = part[:, :-1], part[:, :-2]
        slot1, slot2 = _slots(last, before)
        (guess1, sure1), (guess2, sure2) = _guesses(slot1, part), _guesses(slot2, part)
        state[at:at + 16] = (sure2 << 3) + (sure1 << 1) + (guess1 == guess2)
        event[at:at + 16] = np.where(guess2 == part, 0, 2 - (guess1 == part))
    return state, event


class _Chances:
    """What blocks learn on the fixed schedule: chances of the guesses, and frequencies of symbols.

    Symbols of all blocks stand one after the other, those of a block from ``first`` on.
    """

    def __init__(self, sizes: np.ndarray):
        # How often order 2 was right, else order 1, else neither, by state of confidence.
        self.seen = np.ones(3 * len(sizes) * _STATES, np.int64)
        self.sizes, self.first = sizes, np.cumsum(sizes) - sizes
        self.symbol = np.concatenate([np.arange(n, dtype=np.uint16) for n in sizes.tolist()])
        self.share = np.ones(len(self.symbol))  # a half for each, in halves
        self._cut()

    def refresh(self, symbols: np.ndarray, marks: np.ndarray) -> None:
        """Take a span's symbols (as places among all) and its states with their events (state * 3 + event)."""
        self.share += 2 * np.bincount(symbols, minlength=len(self.share))
        self.seen += np.bincount(marks, minlength=len(self.seen))
        self._cut()

    def _cut(self) -> None:
        """Each symbol has at least one of the 2^12 shares, and by frequency of the rest.

        One multiplication in double precision, cut to a whole number, is the same on any machine.
        """
        seen = self.seen.reshape(-1, 3)
        free, total = (1 << EVENT_BITS) - 3, seen.sum(1)
        cut1 = 1 + seen[:, 0] * free // total
        self.cuts = (cut1 << 16 | cut1 + 1 + seen[:, 1] * free // total).astype(np.int32)
        scale = ((1 << ID_BITS) - self.sizes) / np.add.reduceat(self.share, self.first)
        self.width = (self.share * np.repeat(scale, self.sizes)).astype(np.int32)
        self.width += 1
        left = (1 << ID_BITS) - np.add.reduceat(self.width, self.first)
        self.width += self.symbol < np.repeat(left.astype(np.uint16), self.sizes)
        start = np.cumsum(self.width, dtype=np.int32)
        start -= self.width
        # a block's shares are 2^12 in all, so what is left over counts within the block
        self.spans = (start & (1 << ID_BITS) - 1) << 16 | self.width

    def places(self) -> np.ndarray:
        """For all blocks, one after the other: the symbol that each of the 2^12 shares belongs to."""
        return np.repeat(self.symbol, self.width)


def _blocks_by_length(lengths: list[int]) -> list[int]:
    return sorted(range(len(lengths)), key=lambda i: -lengths[i])


def _alive(lengths: np.ndarray) -> list[int]:
    """Number of blocks, longest first, that still have an id at each step."""
    return np.searchsorted(-lengths, -np.arange(lengths[0]), side="left").tolist()


def _steps(longest: int) -> Iterator[tuple[int, int]]:
    """Spans of positions between refreshes."""
    cuts = [0, *[r for r in REFRESH if r < longest], longest]
    return zip(cuts, cuts[1:])


class _Numbers:
    """Numbers the different ids of a block in order."""

    def __init__(self, top: int):
        self.held, self.number = (np.zeros(top, bool), np.empty(top, np.int32)) if top <= _TABLE else (None, None)

    def of(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The different ids, and each position's number among them."""
        if self.held is None:
            return np.unique(block, return_inverse=True)
        block = block.astype(np.int64, copy=False)
        self.held[block] = True
        values = np.flatnonzero(self.held)
        self.held[values] = False
        self.number[values] = np.arange(len(values), dtype=np.int32)
        return values, self.number.take(block)


def _write_ids(values: list[np.ndarray]) -> list[bytes]:
    """Of each block: the number of its different ids, that of the bytes to come, and the gaps between ids, 7 bits a byte."""
    gaps = np.concatenate([np.diff(v, prepend=-1) for v in values]) - 1
    parts = np.arange(4)[:1 + max(int(gaps.max()).bit_length() - 1, 0) // 7] * 7
    long = (gaps[:, None] >> parts[1:]) > 0
    kept = np.concatenate((np.ones((len(gaps), 1), bool), long), axis=1)
    more = np.concatenate((long, np.zeros((len(gaps), 1), bool)), axis=1)
    out = ((gaps[:, None] >> parts & 127) | more << 7).astype(np.uint8)[kept]
    sizes = np.array(list(map(len, values)))
    used = np.add.reduceat(kept.sum(1), np.cumsum(sizes) - sizes)
    ends = np.cumsum(used)
    heads = np.stack((sizes, used), 1).astype("<u2")
    return [heads[i].tobytes() + out[ends[i] - used[i]:ends[i]].tobytes() for i in range(len(values))]


def _read_ids(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Numbers of different ids, those ids of all blocks, and the rest of each code; ValueError if they cannot be."""
    heads = np.array([np.frombuffer(c[:4].ljust(4, b"\0"), "<u2") for c in codes], np.int64)
    sizes, used = heads[:, 0], heads[:, 1]
    parts = [c[4:4 + n] for c, n in zip(codes, used.tolist())]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    if (sizes < 1).any() or (sizes > BLOCK).any() or (used < sizes).any() or len(raw) != used.sum():
        raise ValueError("a block of token ids is damaged")
    last = raw < 128
    begin = np.cumsum(used) - used
    if (np.add.reduceat(last, begin, dtype=np.int64) != sizes).any() or not last[begin + used - 1].all():
        raise ValueError("a block of token ids is damaged")
    ends = np.flatnonzero(last)
    starts = np.concatenate(([0], ends[:-1] + 1))
    nth = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    if nth.max() > 3:
        raise ValueError("a block of token ids is damaged")
    gaps = np.add.reduceat((raw & 127).astype(np.int64) << 7 * nth, starts) + 1
    sums, first = np.cumsum(gaps), np.cumsum(sizes) - sizes
    return sizes, sums - np.repeat(sums[first] - gaps[first], sizes) - 1, [c[4 + n:] for c, n in zip(codes, used.tolist())]


class _Writer:
    """Range coder: 64-bit range, 32 bits put out at a time; carries run on when it closes."""

    def __init__(self, lanes: int, room: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, _FULL, np.uint64)
        self.words = np.zeros(lanes * room, np.uint64)
        self.used = np.arange(lanes) * room
        self.begin = self.used.copy()

    def put(self, n: int, start: np.ndarray, width: np.ndarray) -> None:
        """Into the first ``n`` blocks."""
        unit, before, used = self.range[:n] >> _SHIFT, self.low[:n], self.used[:n]
        low, span = unit * start, unit * width
        low += before
        over = low < before
        if over.any():
            self.words[used[over] - 1] += np.uint64(1)
        small = span < _LEAST
        self.words[used] = low >> _WORD  # a block that puts nothing out writes over it next time
        used += small
        shift = small * _WORD
        np.left_shift(low, shift, out=before)
        np.left_shift(span, shift, out=self.range[:n])

    def close(self) -> list[bytes]:
        out = []
        for begin, used, low in zip(self.begin.tolist(), self.used.tolist(), self.low.tolist()):
            words = self.words[begin:used + 2].astype(np.int64)
            words[-2:] = low >> 32, low & 0xFFFFFFFF
            for at in np.flatnonzero(words >> 32)[::-1].tolist():
                while words[at] >> 32:
                    words[at] -= 1 << 32
                    words[at - 1] += 1
                    at -= 1
            out.append(words.astype("<u4").tobytes())
        return out


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block's code. Blocks are non-empty arrays of ids below 2^28, at most 4096 of them.

    All ids are known, so guesses, chances and shares of several steps come at
    once; only the range coder goes from id to id.
    """
    if not blocks:
        return []
    top = max(int(b.max()) for b in blocks)
    if top >= IDS or min(int(b.min()) for b in blocks) < 0:
        raise ValueError(f"token ids must be from 0 to {IDS - 1}")
    if max(map(len, blocks)) > BLOCK:
        raise ValueError(f"a block has at most {BLOCK} token ids")
    order = _blocks_by_length(list(map(len, blocks)))
    lengths = np.array([len(blocks[i]) for i in order])
    longest, lanes = int(lengths[0]), len(order)
    symbols, values, numbers = np.zeros((lanes, longest), np.int32), [], _Numbers(top + 1)
    for lane, i in enumerate(order):
        known, symbols[lane, :len(blocks[i])] = numbers.of(blocks[i])
        values.append(known)
    state, event = (x.T.copy() for x in _events(symbols))
    chances, out, alive = _Chances(np.array(list(map(len, values)))), _Writer(lanes, longest + 4), _alive(lengths)
    state_row, symbols = np.arange(lanes) * _STATES, symbols.T + chances.first
    for begin, end in _steps(longest):
        marks = []
        for t in range(begin, end, _CHUNK):
            stop, n = min(t + _CHUNK, end), alive[t]
            at, met, nth = state[t:stop, :n] + state_row[:n], event[t:stop, :n], symbols[t:stop, :n]
            cuts, span = chances.cuts.take(at), chances.spans.take(nth)
            cut1, cut2 = cuts >> 16, cuts & 0xFFFF
            rest, literal, second = (1 << EVENT_BITS) - cut2, met == 2, met == 0
            first = np.where(literal, (cut2 << ID_BITS) + (span >> 16) * rest, np.where(second, 0, cut1 << ID_BITS))
            wide = np.where(literal, (span & 0xFFFF) * rest, np.where(second, cut1, cut2 - cut1) << ID_BITS)
            first, wide = first.astype(np.uint64), wide.astype(np.uint64)
            for step in range(t, stop):
                n = alive[step]
                out.put(n, first[step - t, :n], wide[step - t, :n])
            marks.append((at * 3 + met).ravel() if alive[stop - 1] == alive[t] else np.concatenate(
                [at[s - t, :alive[s]] * 3 + met[s - t, :alive[s]] for s in range(t, stop)]))
        if end < longest:
            chances.refresh(np.concatenate([symbols[t, :alive[t]] for t in range(begin, end)]), np.concatenate(marks))
    result: list[bytes] = [b""] * len(blocks)
    for head, code, i in zip(_write_ids(values), out.close(), order):
        result[i] = head + code
    return result


class _Reader:
    def __init__(self, codes: list[bytes]):
        words = [np.frombuffer(c, "<u4", len(c) // 4) for c in codes]
        room = max(map(len, words)) + 3
        self.words = np.zeros(len(words) * room, np.uint32)
        for lane, w in enumerate(words):
            self.words[lane * room:lane * room + len(w)] = w
        self.used = np.arange(len(words)) * room
        self.code = self.words[self.used].astype(np.uint64) << _WORD | self.words[self.used + 1]
        self.used += 2
        self.last = self.used + room - 3
        self.range = np.full(len(words), _FULL, np.uint64)

    def peek(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        unit = self.range[:n] >> _SHIFT
        target = self.code[:n] // unit
        return np.minimum(target, _TOP, out=target).astype(np.int32), unit

    def take(self, n: int, unit: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        code, span, used = self.code[:n] - unit * start.astype(np.uint64), unit * width.astype(np.uint64), self.used[:n]
        small = span < _LEAST
        shift = small * _WORD
        # A damaged code may ask for more words than there are; its checksum will tell.
        np.minimum(used, self.last[:n], out=used)
        np.left_shift(code, shift, out=code)
        np.bitwise_or(code, self.words.take(used) * small, out=self.code[:n])
        used += small
        np.left_shift(span, shift, out=span)
        np.maximum(span, _LEAST, out=self.range[:n])


def decode_blocks(codes: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """The ids of each block, from its code and its number of ids."""
    if not codes:
        return []
    order = _blocks_by_length(counts)
    lengths, lanes = np.array([counts[i] for i in order]), len(order)
    sizes, values, rest_codes = _read_ids([codes[i] for i in order])
    # symbols are below 2^12, so four times one fits into 16 bits
    chances, model, source, alive = _Chances(sizes), _Model(lanes, np.int16), _Reader(rest_codes), _alive(lengths)
    first, row = chances.first, np.arange(lanes) << ID_BITS
    symbols = np.zeros((lengths[0], lanes), np.int16)
    for begin, end in _steps(int(lengths[0])):
        places, marks, spans = chances.places(), [], chances.spans
        for t in range(begin, end):
            n = alive[t]
            context = model.predict(n)
            guess1, guess2, state = context[4:]
            cuts = chances.cuts.take(state)
            cut1, cut2 = cuts >> 16, cuts & 0xFFFF
            target, unit = source.peek(n)
            chance = target >> ID_BITS
            later, literal = chance >= cut1, chance >= cut2
            rest = (1 << EVENT_BITS) - cut2
            cut2 <<= ID_BITS
            cut1 <<= ID_BITS
            target -= cut2
            inside = (target / rest).astype(np.int64)
            np.maximum(inside, 0, out=inside)
            inside += row[:n]
            now = places.take(inside)
            span = spans.take(now + first[:n])
            source.take(n, unit, np.where(literal, cut2 + (span >> 16) * rest, cut1 * later),
                        np.where(literal, (span & 0xFFFF) * rest, np.where(later, cut2 - cut1, cut1)))
            # a damaged code may trust a guess that is none
            guess = np.where(later, guess1, guess2)
            now = np.where(literal, now.view(np.int16), np.maximum(guess, 0, out=guess))
            symbols[t, :n] = now
            model.learn(now.astype(np.int64), later, *context)
            marks += state * 3 + later + literal,
        if end < int(lengths[0]):
            chances.refresh(np.concatenate([symbols[t, :alive[t]] + first[:alive[t]] for t in range(begin, end)]),
                            np.concatenate(marks))
    ids, values = np.empty((lanes, len(symbols)), np.uint32), values.astype(np.uint32)
    for t in range(0, len(symbols), 64):  # a few steps at a time stay in the processor's cache
        ids[:, t:t + 64] = values.take(symbols[t:t + 64] + first).T
    result: list[np.ndarray] = [np.empty(0, np.uint32)] * len(codes)
    for lane, i in enumerate(order):
        result[i] = ids[lane, :lengths[lane]]
    return result


def pack(ids: np.ndarray) -> tuple[list[bytes], list[int], list[int]]:
    """Codes, numbers of ids and checksums of the blocks of a run of ids."""
    blocks = [ids[at:at + BLOCK] for at in range(0, len(ids), BLOCK)]
    codes = [c for at in range(0, len(blocks), LANES) for c in encode_blocks(blocks[at:at + LANES])]
    return codes, [len(b) for b in blocks], [zlib.crc32(b.astype("<u4")) for b in blocks]


def unpack(codes: list[bytes], counts: list[int], checksums: list[int]) -> np.ndarray:
    """The ids of frames; raises ValueError if a block does not match its checksum."""
    blocks = [b for at in range(0, len(codes), WIDE) for b in decode_blocks(codes[at:at + WIDE], counts[at:at + WIDE])]
    for block, expected in zip(blocks, checksums):
        if zlib.crc32(block.astype("<u4", copy=False)) != expected:
            raise ValueError("a block of token ids does not match its checksum")
    return np.concatenate(blocks) if blocks else np.empty(0, np.uint32)


FRAMES = ("part int, ids_before bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
          "codes array<binary>, block_ids array<int>, checksums array<bigint>")


def _frames(model: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        encode, part, before = token_ids(model), TaskContext.get().partitionId(), 0
        docs, counts, held, size = [], [], [], 0

        def frame() -> pa.RecordBatch:
            codes, blocks, checksums = pack(np.concatenate(held))
            ids = pa.concat_arrays(docs)
            columns = [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.ListArray.from_arrays([0, len(ids)], ids),
                       pa.array([np.concatenate(counts)], pa.list_(pa.int64())), pa.array([codes], pa.list_(pa.binary())),
                       pa.array([blocks], pa.list_(pa.int32())), pa.array([checksums], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["part", "ids_before", "doc_ids", "n_tokens", "codes", "block_ids", "checksums"])

        for doc_ids, texts in _by_bytes(batches):
            ids, n = encode.of(texts, end)
            at, done = 0, 0
            ends = np.cumsum(n)
            while at < len(n):
                # a frame closes with the document that fills it
                stop = min(int(np.searchsorted(ends, done + FRAME - size)) + 1, len(n))
                docs.append(doc_ids[at:stop])
                counts.append(n[at:stop])
                held.append(ids[done:ends[stop - 1]])
                size += int(ends[stop - 1]) - done
                at, done = stop, int(ends[stop - 1])
                if size >= FRAME:
                    yield frame()
                    before += size
                    docs, counts, held, size = [], [], [], 0
        if docs:
            yield frame()
    return run


def _by_bytes(batches: Iterator[pa.RecordBatch], most: int = 1 << 24) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts in runs of about ``most`` bytes, at least one text each."""
    ids, texts, held = [], [], 0
    for batch in batches:
        lengths = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < len(lengths):
            stop = min(int(np.searchsorted(lengths, done + most - held)) + 1, len(lengths))
            ids.append(batch.column(0)[at:stop])
            texts.append(batch.column(1)[at:stop])
            held += int(lengths[stop - 1]) - done
            at, done = stop, int(lengths[stop - 1])
            if held >= most:
                yield pa.concat_arrays(ids), pa.concat_arrays(texts)
                ids, texts, held = [], [], 0
    if ids:
        yield pa.concat_arrays(ids), pa.concat_arrays(texts)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode whole texts (null: empty), each closed by ``end``, and write them in ascending order of id.

    Documents are dealt by ranges of (id, text hash), without id last; a task codes
    its range frame by frame, so memory holds one frame. Spark's committer makes
    the files whole if a task is lost. Strings of special tokens are ordinary text.
    An id of 2^28 or more is an error.
    """
    with open(tokenizer_path, encoding="utf-8") as given:
        model = given.read()
    width = shuffle_width(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ranged = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).repartitionByRange(width, *order)
    ranged.sortWithinPartitions(*order).mapInArrow(_frames(model, end), FRAMES).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks = pc.list_value_length(batch.column("codes")).to_numpy()
        at = 0
        while at < len(blocks):
            # as many whole frames as are decoded side by side, at least one
            stop = at + max(1, int(np.searchsorted(np.cumsum(blocks[at:]), WIDE, side="right")))
            held = {name: batch.column(name)[at:stop] for name in batch.schema.names}
            ids = unpack(*(held[c].flatten().to_pylist() for c in ("codes", "block_ids", "checksums")))
            for row in range(stop - at):
                counts = held["n_tokens"][row].values.to_numpy()
                cuts = np.concatenate(([0], np.cumsum(counts)))
                own, ids = pa.py_buffer(ids[:cuts[-1]].astype("<u4", copy=False)), ids[cuts[-1]:]
                # the cast raises if a frame passes the 2^31 bytes of a binary column
                texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(4 * cuts), own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), held["part"][row].as_py(), np.int32)), held["doc_ids"][row].values,
                     pa.array(cuts[:-1] + held["ids_before"][row].as_py()), pa.array(counts), texts.cast(pa.binary())],
                    ["part", "doc_id", "start_in_part", "n_tokens", "ids"])
            at = stop


def read_tokens(frames: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a token file; ids are little-endian 32-bit.

    ``start`` counts the ids of all documents before. The parts' totals, one row
    per part of the file, are summed in order; documents never meet.
    """
    totals = materialized(frames.groupBy("part").agg(
        F.max(F.col("ids_before") + F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("n")), "parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    docs = frames.mapInArrow(_documents, "part int, doc_id bigint, start_in_part bigint, n_tokens bigint, ids binary")
    # One row per part of the file, so the broadcast is bounded by the shuffle width.
    return docs.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("first") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, tokenizer_path: str, end: int) -> DataFrame:
    """Write the token file of ``docs`` to the shared folder and read it back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path, end)
    return read_tokens(spark.read.parquet(path))

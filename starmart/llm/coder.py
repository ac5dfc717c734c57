"""Token files: an adaptive context-mixing range coder over token ids.

A block of ``BLOCK_IDS`` ids is coded on its own from an empty model, with its own checksum, so any
block can be read alone and a damaged one harms no other. For each id three predictions are mixed:

* order 2 and order 1: the id that last followed the two ids (the one id) before, with a confidence
  of 0 to 3 that grows when it is right. How often a prediction is right is counted for each pair of
  confidences; this is the weight it gets.
* order 0: how often each id has come in this block. Ids that have not come yet escape to their
  class, whose share is the number of different ids of it so far, with equal shares within a class.
  Ids below 16 are classes of their own, then eight classes share each power of two.

Weights are made anew after each window of 64 ids, shares of order 0 after the places in
``_REBUILDS``. A 32-bit range coder turns the mixed probabilities into bytes. All blocks of a segment
are coded in step, one numpy lane each, which gives the same bytes as one after the other.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.ordinals import running_starts
from starmart.llm.tables import batches_of, name, pieces_of, text_bytes
from starmart.llm.tokens import END_ID, default_tokenizer, encoder, release_memory

BLOCK_IDS = 4096
SEGMENT_IDS = 3072 * BLOCK_IDS
PARTITION_BYTES = 24 << 20
MAGIC = b"IDCM\x02"

#: Shares of hits and of order 0 as a whole are in 2^16, shares of its ids and classes among
#: themselves in 2^13, and up to 12 bits within a class are coded in the same step: 28 bits.
_BITS, _SHARE_BITS, _INNER_BITS = 16, 13, 12
_ALL_BITS = _BITS + _INNER_BITS
_TOTAL, _SHARES = 1 << _BITS, 1 << _SHARE_BITS
_LEFT = 1 << 13
_TABLE_BITS = 11
_WINDOW = 64
#: After so many ids (whole windows) the shares of order 0 are made anew from what was counted.
_REBUILDS = (64, 192, 448, 896, 1600, 2624)
_CLASSES = 16 + 28 * 8
#: A block has room for a share of each of its ids and of each class.
_MOST_IDS = _SHARES - _CLASSES
#: Hits of 16 that a prediction of each confidence is taken to have had.
_FIRST_HITS = np.array([2, 6, 10, 13])
_PRESENT_BYTES = 4 << 20
_BATCH_BYTES = 4 << 20


def _computed_classes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power = np.frexp(np.maximum(ids, 1).astype(np.float64))[1].astype(np.int64) - 1
    bits = np.maximum(power - 3, 0)
    number = np.where(ids < 16, ids, 16 + (power - 4) * 8 + ((ids >> bits) & 7))
    return number, np.where(ids < 16, 0, bits)


_TABLED = tuple(column for column in _computed_classes(np.arange(1 << 16)))


def _classes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each id, and how many bits tell it from the others of its class."""
    if ids.max(initial=0) < 1 << 16:
        return _TABLED[0].take(ids), _TABLED[1].take(ids)
    return _computed_classes(ids)


_CLASS_BITS = np.concatenate((np.zeros(16, np.int64), np.repeat(np.arange(1, 29), 8)))
_CLASS_BASE = np.concatenate(
    (np.arange(16), ((np.arange(8) + 8)[None, :] << np.arange(1, 29, dtype=np.int64)[:, None]).ravel())
)


def _distinct_keys(ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of ``lane * top + id``, lanes being rows, and the place of each id in them.

    Where ids are small the keys are marked in a table, some lanes at a time; else they are sorted.
    """
    lanes, length = ids.shape
    if top > 1 << 18:
        keys = ids.astype(np.int64) + np.arange(lanes)[:, None] * top
        found, places = np.unique(keys, return_inverse=True)
        return found, places.reshape(lanes, length)
    step = max(1, _PRESENT_BYTES // top)
    marks, place = np.zeros(step * top, bool), np.empty(step * top, np.int32)
    found, places, before = [], np.empty(ids.shape, np.int32), 0
    for first in range(0, lanes, step):
        mine = ids[first : first + step].astype(np.int64)
        mine += np.arange(len(mine))[:, None] * top
        marks[mine] = True
        used = np.flatnonzero(marks)
        place[used] = np.arange(before, before + len(used))
        places[first : first + step] = place[mine]
        marks[used] = False
        found.append(used + first * top)
        before += len(used)
    return np.concatenate(found), places


class _Shares:
    """Order 0: a slot for each different id of each lane, lane by lane with ids ascending."""

    def __init__(self, lanes: int, lane: np.ndarray, ids: np.ndarray):
        self.lanes, self.lane, self.ids = lanes, lane, ids
        self.class_key = lane * _CLASSES + _classes(ids)[0]

    def make(self, counts: np.ndarray) -> None:
        """New shares; an id that came ``n`` times weighs ``4 n - 2``, one that did not has none."""
        seen = np.flatnonzero(counts)
        lane, weight = self.lane[seen], 4 * counts[seen] - 2
        first = np.searchsorted(lane, np.arange(self.lanes + 1))
        summed = np.concatenate((np.zeros(1, np.int64), np.cumsum(weight)))
        of_ids, self.known = np.diff(summed[first]), np.diff(first)
        new = np.bincount(self.class_key[seen], minlength=self.lanes * _CLASSES).reshape(-1, _CLASSES)
        classes = np.zeros((self.lanes, _CLASSES + 1))
        np.cumsum(1 + 16 * new, axis=1, out=classes[:, 1:])
        total = of_ids + classes[:, -1]
        # A start is the number of slots before it and their part of the spare shares. Quotients of
        # doubles round down like those of whole numbers here, as both sides are below 2^27.
        scale = (_SHARES - _CLASSES - self.known) / 1.0
        weighed = (summed[:-1] - summed[first][lane]) * scale[lane] / total[lane]
        start = np.arange(len(seen)) - first[lane] + weighed.astype(np.int64)
        classes = (classes + of_ids[:, None]) * scale[:, None] / total[:, None]
        classes = classes.astype(np.int64) + self.known[:, None] + np.arange(_CLASSES + 1)
        # The last id of a lane ends where its classes begin.
        stop = np.append(start[1:], 0)
        held = self.known > 0
        stop[first[1:][held] - 1] = classes[held, 0]
        self.start, self.share = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
        self.start[seen], self.share[seen] = start, stop - start
        self.class_start = classes[:, :-1].ravel()
        self.class_share = np.diff(classes, axis=1).ravel()


class _Model:
    """Predictions of orders 2 and 1 for one block in each lane, and how far they are to be trusted."""

    def __init__(self, lanes: int, kind: type):
        self._row = np.arange(lanes, dtype=np.int64) << _TABLE_BITS
        self._tables = [np.zeros(lanes << _TABLE_BITS, kind) for _ in range(2)]
        self._context = np.arange(lanes, dtype=np.int64) * 16
        self._tries2, self._tries1 = (np.full(lanes * 16, 16, np.int64) for _ in range(2))
        self._hits2 = np.tile(np.repeat(_FIRST_HITS, 4), lanes)
        self._hits1 = np.tile(_FIRST_HITS, 4 * lanes)
        self._weights, self._were2, self._were1 = [], [], []
        self._weigh()

    def _weigh(self) -> None:
        self._part2 = 1 + self._hits2 * (_TOTAL - 2 * _LEFT) // self._tries2
        self._part1 = 1 + self._hits1 * (_TOTAL - _LEFT - self._part2) // self._tries1

    def learn(self) -> None:
        """Count the hits of a window, then weigh anew."""
        at = np.concatenate(self._weights)
        hit2, hit1 = np.concatenate(self._were2), np.concatenate(self._were1)
        size = len(self._tries2)
        tried, hits = np.bincount(at, minlength=size), np.bincount(at[hit2], minlength=size)
        self._tries2 += tried
        self._hits2 += hits
        self._tries1 += tried - hits
        self._hits1 += np.bincount(at[hit1 & ~hit2], minlength=size)
        self._weights, self._were2, self._were1 = [], [], []
        self._weigh()

    def contexts(self, last: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the two predictions after the ids ``before`` and ``last``."""
        mask = (1 << _TABLE_BITS) - 1
        return (
            self._row + ((last * 2654435761 + before * 40507 >> 9) & mask),
            self._row + ((last * 40503 >> 4) & mask),
        )

    def predict(self, at2: np.ndarray, at1: np.ndarray) -> None:
        self._at2, self._at1 = at2, at1
        self._entry2, self._entry1 = self._tables[0].take(at2), self._tables[1].take(at1)
        self.guess2, self.guess1 = self._entry2 >> 2, self._entry1 >> 2
        weight = self._context + ((self._entry2 & 3) << 2 | self._entry1 & 3)
        self._weights.append(weight)
        self.share2 = self._part2.take(weight)
        self.known = self.share2 + self._part1.take(weight) * (self.guess1 != self.guess2)
        self.left = _TOTAL - self.known

    def hit_range(self, lanes: np.ndarray, hit2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and share, in all bits, of the prediction that is right in these lanes."""
        second, two = hit2[lanes], self.share2[lanes]
        share = np.where(second, two, self.known[lanes] - two)
        return np.where(second, 0, two) << _INNER_BITS, share << _INNER_BITS

    def update(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """Take the ids that came; ``ids`` are in the kind of number of the tables."""
        self._were2.append(hit2)
        self._were1.append(hit1)
        fresh = ids << 2
        for table, at, entry, hit in (
            (self._tables[0], self._at2, self._entry2, hit2),
            (self._tables[1], self._at1, self._entry1, hit1),
        ):
            # A hit adds trust, a miss takes the place.
            table[at] = np.where(hit, np.minimum(entry + 1, entry | 3), fresh)

    def widen(self) -> None:
        """Make room for any id."""
        self._tables = [table.astype(np.int64) for table in self._tables]


def _kind_for(top: int) -> type:
    """Numbers of the tables: an id and two bits."""
    return np.int32 if top <= 1 << 29 else np.int64


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Coded bytes of each row of ``ids`` (whole numbers from 0 to 2^32 - 1, at most 7,952 a row)."""
    lanes, length = ids.shape
    if length > _MOST_IDS:
        raise ValueError(f"a block has at most {_MOST_IDS} ids")
    if not lanes or not length:
        return [b""] * lanes
    top = int(ids.max()) + 1
    kind = _kind_for(top)
    used_keys, slots = _distinct_keys(ids, top)
    slots = np.ascontiguousarray(slots.T)
    ids = np.ascontiguousarray(ids.T.astype(kind))
    shares = _Shares(lanes, used_keys // top, used_keys % top)
    counts = np.zeros(len(used_keys), np.int64)
    shares.make(counts)
    wide = bool(_classes(np.array([top - 1]))[1][0] > _INNER_BITS)
    model, none = _Model(lanes, kind), np.zeros(lanes, np.int64)
    low, span = none.copy(), np.full(lanes, (1 << 48) - 1, np.int64)
    lane_numbers = np.arange(lanes)

    def row_starts(width: int) -> np.ndarray:
        return np.arange(lanes) * width

    width = length + 64
    out, used = np.zeros(lanes * width, np.int32), row_starts(width)

    def code(start: np.ndarray, share: np.ndarray, total_bits: int | np.ndarray) -> None:
        unit = span >> total_bits
        np.add(low, unit * start, out=low)
        np.multiply(unit, share, out=span)
        full = np.flatnonzero(span < 1 << 32)
        while len(full):
            # A 17th bit of a word is a carry into the word before; it is settled at the end.
            bottom, place, rest = low.take(full), used.take(full), span.take(full) << 16
            out[place] = bottom >> 32
            low[full] = (bottom & 0xFFFFFFFF) << 16
            span[full] = rest
            used[full] = place + 1
            full = full[rest < 1 << 32]

    for step in range(length):
        at = step % _WINDOW
        if at == 0:
            if step in _REBUILDS:
                since = 0 if step == _REBUILDS[0] else _REBUILDS[_REBUILDS.index(step) - 1]
                counts += np.bincount(slots[since:step].ravel(), minlength=len(counts))
                shares.make(counts)
            if step:
                model.learn()
            window = ids[step : step + _WINDOW].astype(np.int64)
            places = slots[step : step + _WINDOW]
            starts, parts = shares.start.take(places), shares.share.take(places)
            inners, low_rests = np.zeros(window.shape, np.int64), np.zeros(window.shape, np.int64)
            escapes = np.nonzero(parts == 0)
            new = window[escapes]
            numbers, new_bits = _classes(new)
            class_at = lane_numbers[escapes[1]] * _CLASSES + numbers
            starts[escapes], parts[escapes] = shares.class_start[class_at], shares.class_share[class_at]
            inners[escapes] = np.minimum(new_bits, _INNER_BITS)
            low_rests[escapes] = new & ((np.int64(1) << inners[escapes]) - 1)
            if wide:
                all_bits = np.zeros(window.shape, np.int64)
                all_bits[escapes] = new_bits
            lasts = ids[max(0, step - 2) : step].astype(np.int64)
            lasts = np.concatenate((np.zeros((2 - len(lasts), lanes), np.int64), lasts, window[:-1]))
            at2, at1 = model.contexts(lasts[1 : 1 + len(window)], lasts[: len(window)])
        model.predict(at2[at], at1[at])
        now = ids[step]
        hit2, hit1 = now == model.guess2, now == model.guess1
        either = hit2 | hit1
        start = model.left * starts[at] >> _SHARE_BITS
        share = model.left * parts[at] >> _SHARE_BITS
        part = (share << _INNER_BITS) >> inners[at]
        start = ((start + model.known) << _INNER_BITS) + part * low_rests[at]
        hits = np.flatnonzero(either)
        start[hits], part[hits] = model.hit_range(hits, hit2)
        code(start, part, _ALL_BITS)
        if wide:
            for shift in range(_INNER_BITS, 30, _INNER_BITS):
                more = np.where(either, 0, np.clip(all_bits[at] - shift, 0, _INNER_BITS))
                code((window[at] >> shift) & ((1 << more) - 1), np.int64(1), more)
        model.update(now, hit2, hit1)
        if step % 16 == 15 and width - int((used - row_starts(width)).max()) < 80:
            more_words = length // 2 + 80
            used += lane_numbers * more_words
            out = np.pad(out.reshape(lanes, width), ((0, 0), (0, more_words))).ravel()
            width += more_words
    for word in (low >> 32, (low >> 16) & 0xFFFF, low & 0xFFFF):
        out[used] = word
        used += 1
    used -= row_starts(width)
    out = out.reshape(lanes, width)
    for place in range(int(used.max()) - 1, 0, -1):
        out[:, place - 1] += out[:, place] >> 16
        out[:, place] &= 0xFFFF
    words = out.astype("<u2")
    return [words[lane, : used[lane]].tobytes() for lane in range(lanes)]


class _Inverse:
    """Order 0 while decoding: the slots of the ids that have come, and which slot holds a place."""

    def __init__(self, lanes: int):
        self.lanes = lanes
        self._keys, self._counts, self._top = np.empty(0, np.int64), np.empty(0, np.int64), 1
        self.rebuild(np.zeros((0, lanes), np.int64))

    def rebuild(self, ids: np.ndarray) -> None:
        """Count ``ids``, a row for each step, and make new shares."""
        lanes, old = self.lanes, self._keys
        top = max(self._top, int(ids.max(initial=0)) + 1)
        if len(ids):
            # Ids of a lane in order, then one of each with its number.
            rows = np.sort(ids.T.astype(_kind_for(top)), axis=1)
            fresh = (rows + np.arange(lanes)[:, None] * top).ravel()
            at = np.flatnonzero(np.concatenate(([True], fresh[1:] != fresh[:-1])))
            old = old // self._top * top + old % self._top
            keys = np.concatenate((old, fresh[at]))
            counts = np.concatenate((self._counts, np.diff(np.append(at, len(fresh)))))
            # Two ascending runs: a stable sort merges them.
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self._keys, self._counts = keys[at], np.add.reduceat(counts, at)
        self._top = top
        lane, seen_ids = self._keys // top, self._keys % top
        shares = _Shares(lanes, lane, seen_ids)
        shares.make(self._counts)
        size = shares.known + _CLASSES
        self.first = np.cumsum(size) - size
        total = int(size.sum())
        at_ids = np.arange(len(lane)) + lane * _CLASSES
        at_classes = ((self.first + shares.known)[:, None] + np.arange(_CLASSES)).ravel()
        share = np.zeros(total, np.int64)
        share[at_ids], share[at_classes] = shares.share, shares.class_share
        # All of a slot in one word: id, bits of a class, start and share less one.
        self.slots = np.zeros(total, np.int64)
        self.slots[at_ids] = seen_ids << 31 | shares.start << 13 | shares.share - 1
        classes = _CLASS_BASE << 31 | _CLASS_BITS << 26
        shared = shares.class_start << 13 | shares.class_share - 1
        self.slots[at_classes] = np.tile(classes, lanes) | shared
        number = (np.arange(total) - np.repeat(self.first, size)).astype(np.uint16)
        self._slot = np.repeat(number, share)
        self._row = np.arange(lanes, dtype=np.int64) << _SHARE_BITS

    def slot_at(self, place: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The slot, in its packed form, whose range holds a place of what is left."""
        inner = ((place + 1) * _SHARES - 1) / left
        inner = np.minimum(inner.astype(np.int64), _SHARES - 1)
        return self.slots.take(self.first + self._slot.take(self._row + inner))


def decode_blocks(blocks: list[bytes], length: int) -> np.ndarray:
    """The ``length`` ids of each block."""
    lanes = len(blocks)
    width = max((len(b) for b in blocks), default=0) // 2 + 8
    words = np.zeros((lanes, width), np.int64)
    for lane, block in enumerate(blocks):
        words[lane, : len(block) // 2] = np.frombuffer(block, "<u2")
    words, row = words.ravel(), np.arange(lanes) * width
    ids = np.zeros((length, lanes), np.int64)
    if not lanes or not length:
        return ids.T
    model, order0, none = _Model(lanes, np.int32), _Inverse(lanes), np.zeros(lanes, np.int64)
    kind = np.int32
    value = words[row] << 32 | words[row + 1] << 16 | words[row + 2]
    span, used = np.full(lanes, (1 << 48) - 1, np.int64), row + 3

    def place(total_bits: int | np.ndarray, last: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unit = span >> total_bits
        # Exact: both are whole numbers below 2^53.
        return unit, np.minimum((value / unit).astype(np.int64), last)

    def take(unit: np.ndarray, start: np.ndarray, share: np.ndarray) -> None:
        np.subtract(value, unit * start, out=value)
        np.multiply(unit, share, out=span)
        more = np.flatnonzero(span < 1 << 32)
        while len(more):
            at, rest = used.take(more), span.take(more) << 16
            value[more] = (value.take(more) << 16) | words.take(at)
            span[more] = rest
            used[more] = at + 1
            more = more[rest < 1 << 32]

    for step in range(length):
        if step % _WINDOW == 0 and step:
            if step in _REBUILDS:
                since = 0 if step == _REBUILDS[0] else _REBUILDS[_REBUILDS.index(step) - 1]
                order0.rebuild(ids[since:step])
            model.learn()
        model.predict(*model.contexts(ids[step - 1] if step else none, ids[step - 2] if step > 1 else none))
        unit, at = place(_ALL_BITS, (1 << _ALL_BITS) - 1)
        near = at >> _INNER_BITS
        hit2, plain = near < model.share2, near >= model.known
        slot = order0.slot_at(np.maximum(near - model.known, 0), model.left)
        first, bits = slot >> 13 & 8191, slot >> 26 & 31
        start = model.left * first >> _SHARE_BITS
        share = model.left * (1 + (slot & 8191)) >> _SHARE_BITS
        inner = np.minimum(bits, _INNER_BITS)
        part = (share << _INNER_BITS) >> inner
        start = (start + model.known) << _INNER_BITS
        # The last of the equal parts of a class also has what cannot be shared evenly.
        rest = np.minimum((at - start) // part, (1 << inner) - 1)
        start += part * rest
        hits = np.flatnonzero(~plain)
        start[hits], part[hits] = model.hit_range(hits, hit2)
        take(unit, start, part)
        if int((bits * plain).max()) > _INNER_BITS:
            for shift in range(_INNER_BITS, 30, _INNER_BITS):
                more = np.where(plain, np.clip(bits - shift, 0, _INNER_BITS), 0)
                unit, at = place(more, (1 << more) - 1)
                take(unit, at, np.int64(1))
                rest = rest | at << shift
        now = (slot >> 31) + rest
        now[hits] = np.where(hit2[hits], model.guess2[hits], model.guess1[hits])
        ids[step] = now
        if kind is np.int32 and int(now.max()) > 1 << 29:
            kind = np.int64
            model.widen()
        # An id that a prediction offers never comes as a plain one.
        model.update(now.astype(kind), hit2, now == model.guess1)
    return ids.T


def pack_segment(keys: np.ndarray, missing: np.ndarray, ids: np.ndarray, stops: np.ndarray) -> bytes:
    """One segment of a token file: header, documents, block directory, blocks.

    Header: magic, ids in a block, blocks, ids, documents (unsigned 32 and 64 bits, little-endian).
    Documents: their keys (64 bits), which keys are null, where each ends, all deflated together.
    Directory: bytes and CRC-32 of every block's coded bytes.
    """
    blocks = -(-len(ids) // BLOCK_IDS)
    padded = np.zeros(blocks * BLOCK_IDS, np.uint32)
    padded[: len(ids)] = ids
    coded = encode_blocks(padded.reshape(blocks, BLOCK_IDS)) if blocks else []
    index = keys.astype("<i8").tobytes() + missing.astype("u1").tobytes() + stops.astype("<u8").tobytes()
    index = zlib.compress(index, 1)
    directory = np.array([(len(b), zlib.crc32(b)) for b in coded], "<u4").tobytes()
    header = struct.pack("<IIQQII", BLOCK_IDS, blocks, len(ids), len(keys), len(index), zlib.crc32(index))
    return b"".join([MAGIC, header, index, directory, *coded])


def _opened(content: bytes) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """(ids in a block, ids, keys, which are null, stops, place, bytes and CRC-32 of each block)."""
    if content[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    at = len(MAGIC)
    block_ids, blocks, n_ids, docs, index_bytes, index_crc = struct.unpack_from("<IIQQII", content, at)
    at += struct.calcsize("<IIQQII")
    index = content[at : at + index_bytes]
    if zlib.crc32(index) != index_crc:
        raise ValueError("the list of documents is damaged")
    index = zlib.decompress(index)
    at += index_bytes
    directory = np.frombuffer(content, "<u4", 2 * blocks, at).reshape(blocks, 2).astype(np.int64)
    at += 8 * blocks
    starts = at + np.cumsum(directory[:, 0]) - directory[:, 0]
    places = list(zip(starts.tolist(), directory[:, 0].tolist(), directory[:, 1].tolist()))
    keys = np.frombuffer(index, "<i8", docs)
    missing = np.frombuffer(index, "u1", docs, 8 * docs).astype(bool)
    stops = np.frombuffer(index, "<u8", docs, 9 * docs).astype(np.int64)
    return block_ids, n_ids, keys, missing, stops, places


def _coded(content: bytes, number: int, place: tuple[int, int, int]) -> bytes:
    at, size, crc = place
    coded = content[at : at + size]
    if zlib.crc32(coded) != crc:
        raise ValueError(f"block {number} is damaged")
    return coded


def unpack_block(content: bytes, number: int) -> np.ndarray:
    """The ids of one block of a segment; the other blocks are neither checked nor decoded."""
    block_ids, n_ids, _, _, _, places = _opened(content)
    ids = decode_blocks([_coded(content, number, places[number])], block_ids)[0]
    return ids[: n_ids - number * block_ids]


def unpack_segment(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, which are null, ids, where each document ends); a damaged block is an error."""
    block_ids, n_ids, keys, missing, stops, places = _opened(content)
    coded = [_coded(content, number, place) for number, place in enumerate(places)]
    ids = decode_blocks(coded, block_ids).ravel()[:n_ids] if coded else np.empty(0, np.int64)
    return keys, missing, ids, stops


def write_token_files(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    partition_bytes: int = PARTITION_BYTES,
) -> None:
    """Write the ids of all documents, id 1 after each, in ascending order of a whole-number id.

    ``path`` becomes a Parquet table with a row for each segment: ``part`` and ``segment`` give the
    order, ``ids`` the number of ids, ``content`` the bytes of ``pack_segment``. A null id comes
    first; equal ids stand in an order of their texts. Nothing is gathered: documents are dealt over
    tasks by ranges of ids, and each task writes its segments one by one.
    """
    encoding = tokenizer or default_tokenizer()
    kind = docs.schema[id_column].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise ValueError(f"ids must be whole numbers, not {kind}")
    chosen = docs.select(name(id_column).cast("long").alias("id"), name(text).alias("text"))
    # Lanes share the cost of a step, so partitions are not smaller than asked for where there are cores.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = pieces_of(text_bytes(chosen, "text"), partition_bytes, cores)
    order = [F.col("id"), F.xxhash64("text"), F.col("text")]
    ranged = chosen.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        n_ids = 0

        def flush() -> pa.RecordBatch:
            keys, missing, ids, sizes = (np.concatenate(column) for column in zip(*held))
            content = pack_segment(keys, missing, ids, np.cumsum(sizes))
            row = {"part": [part], "segment": [segment], "ids": [len(ids)], "content": [content]}
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(row["part"], pa.int64()),
                    "segment": pa.array(row["segment"], pa.int64()),
                    "ids": pa.array(row["ids"], pa.int64()),
                    "content": pa.array(row["content"], pa.binary()),
                }
            )

        for batch in batches:
            for piece in batches_of(batch, "text", _BATCH_BYTES):
                ids, stops = encoder(encoding).encode(piece["text"], END_ID)
                keys = piece["id"]
                missing = np.asarray(keys.is_null())
                held.append((np.asarray(keys.fill_null(0)), missing, ids, np.diff(stops, prepend=0)))
                n_ids += len(ids)
                if n_ids >= SEGMENT_IDS:
                    yield flush()
                    held, n_ids, segment = [], 0, segment + 1
                    release_memory()
        if held:
            yield flush()

    ranged.mapInArrow(write, "part long, segment long, ids long, content binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document from the files, with ``ids`` on demand.

    ``start`` counts the ids of all documents before it. Blocks are checked and decoded on the way.
    """
    files = spark.read.schema("part long, segment long, ids long, content binary").parquet(path)
    width = 1 << 24
    keyed = files.withColumn("key", F.col("part") * width + F.col("segment"))
    starts = running_starts(keyed.select("key", "ids"), "key", "ids", 1024 * width, "before")
    schema = "key long, id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, content in zip(batch["key"].to_pylist(), batch["content"]):
                keys, missing, ids, stops = unpack_segment(content.as_py())
                begins = np.concatenate((np.zeros(1, np.int64), stops))[: len(stops)]
                raw = memoryview(ids.astype("<u4")).cast("B")
                spans = [raw[4 * a : 4 * b] for a, b in zip(begins.tolist(), stops.tolist())]
                columns = {
                    "key": pa.array(np.full(len(keys), key)),
                    "id": pa.array(keys, mask=missing),
                    "start": pa.array(begins),
                    "n_tokens": pa.array(stops - begins),
                    "ids_crc32": pa.array([zlib.crc32(span) for span in spans], pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array([bytes(span) for span in spans], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)
                del keys, missing, ids, stops, raw, spans, columns
                release_memory()

    # A row is a segment of tens of MB: one at a time goes to Python.
    decoded = keyed.select("key", "content").mapInArrow(read, schema)
    joined = decoded.join(starts, "key").withColumn("start", F.col("before") + F.col("start"))
    return joined.drop("key", "before")

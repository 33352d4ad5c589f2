"""Adaptive context-mixing range coder for token ids, many blocks in step.

Ids are cut into blocks that start from the same reset state and carry a CRC of their ids. A block
decodes and checks alone (:func:`read_block`), with nothing but its group's header: the
reset state's id table. All blocks of a group advance together, one id at a time, as numpy lanes; a lane is one block's coder.

*Model.* Order 2 and order 1 predict the id seen last after the same two ids or
the same id in this block, each with a confidence (0-3, up on a hit, reset on a
miss). Order 0 adapts too: the distribution of the block's last ids (up to 2048, taken anew every 1024 ids, and
sooner at its start); an id that is not among them is coded by the reset state's distribution. The mixture
P(id) = w2*[id = order 2] + w1*[id = order 1] + w0*order0(id) + wr*reset(id)
has weights that adapt in each block to what happened under the same pair of
confidences. Only integers enter, so every machine decodes the same.

*Coder.* A carry-less range coder with 64-bit bounds and 16-bit output words: one step codes which part of
the mixture holds the id (the first that does), a second one, if that is a distribution, the id.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import zstandard

BLOCK = 2048           # ids per block
SLOTS = 9              # log2 of the context slots per order and block
RESET_BITS = 18        # frequencies of the reset state add up to 2**18
EPOCHS, EPOCH = (0, 64, 256, 1024), 1024  # order 0 is taken anew at these places of a block, then every EPOCH
RECENT = 2048          # ids that order 0 looks back on, at most
SEEN_CELLS = 1 << 25   # (block, id) cells of an encoder at a time
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
U16, U48 = np.uint64(16), np.uint64(48)
LIMIT = np.uint64(2048)  # total above which a state's weights are halved
STEP = np.uint64(24)   # a weight's step up
LOW16, HALVES, ONES = np.uint64(0xFFFF), np.uint64(0x7FFF7FFF7FFF7FFF), np.uint64(0x0001000100010001)
ID_BITS, ID_MASK = np.uint32(20), np.uint32((1 << 20) - 1)  # a context slot: confidence above the id
ID_STEP, ID_TOP, SHIFT = np.uint32(1 << 20), np.uint32(3 << 20), np.uint32(32 - SLOTS)
STATES = 32            # confidence of order 2, of order 1, and whether both name the same id
GROUP, GROUP_BYTES = "<IIII", 16  # ids, blocks, bytes of the reset state's table, ids per block


def reset_state(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and their frequencies, at least 1 each, adding up to 2**RESET_BITS."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    spare = (1 << RESET_BITS) - len(symbols)
    freq = 1 + counts * spare // len(ids)
    freq[np.argmax(freq)] += (1 << RESET_BITS) - freq.sum()
    return symbols.astype(np.uint32), freq


class _Model:
    """Predictions and mixture weights of all lanes. The four weights of a state (order 2,
    order 1, order 0, reset) share one 64-bit word, 16 bits each; times ONES they are running sums."""

    def __init__(self, lanes: int):
        self.one, self.two = (np.zeros(lanes << SLOTS, np.uint32) for _ in range(2))
        start = [(2 + 10 * (s >> 3)) | (2 + 6 * (s >> 1 & 3) * (1 - (s & 1))) << 16 | 16 << 32 | 16 << 48 for s in range(STATES)]
        self.weights = np.tile(np.array(start, np.uint64), lanes)
        self.base = np.arange(lanes, dtype=np.uint32) << np.uint32(SLOTS)
        self.rows = np.arange(lanes, dtype=np.uint32) * np.uint32(STATES)
        self.last, self.prior = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)

    def predict(self, n: int):
        """Running sums of the weights, and all of them, for the first ``n`` lanes."""
        last, prior, base = self.last[:n], self.prior[:n], self.base[:n]
        self.at1 = (((last * np.uint32(0x9E3779B1)) >> SHIFT) + base).astype(np.intp)
        self.at2 = ((((last * np.uint32(0x85EBCA6B)) ^ (prior * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F) >> SHIFT) + base).astype(np.intp)
        self.e1, self.e2 = self.one.take(self.at1), self.two.take(self.at2)
        self.p1, self.p2 = self.e1 & ID_MASK, self.e2 & ID_MASK
        self.row = ((self.e2 >> ID_BITS) << np.uint32(3)) + ((self.e1 >> ID_BITS) << np.uint32(1)) + (self.p1 == self.p2) + self.rows[:n]
        self.row = self.row.astype(np.intp)
        self.w = self.weights.take(self.row)
        self.sums = self.w * ONES
        self.total = self.sums >> U48
        return self.sums, self.total

    def narrow(self, lo: np.ndarray, r: np.ndarray, part: np.ndarray):
        """Cut the ranges (already divided by the total) down to each lane's part."""
        self.shift = part << np.uint64(4)
        lo += r * (((self.sums << U16) >> self.shift) & LOW16)
        r *= (self.w >> self.shift) & LOW16

    def update(self, ids: np.ndarray):
        n = len(ids)
        w = self.w + (STEP << self.shift)
        over = (self.total > LIMIT).nonzero()[0]
        if len(over):
            w[over] = ((w[over] >> np.uint64(1)) & HALVES) + ONES
        self.weights[self.row] = w
        for table, at, entry, guess in ((self.one, self.at1, self.e1, self.p1), (self.two, self.at2, self.e2, self.p2)):
            table[at] = ids
            hit = (guess == ids).nonzero()[0]
            table[at.take(hit)] = np.minimum(entry.take(hit) + ID_STEP, ids.take(hit) | ID_TOP)
        self.prior[:n] = self.last[:n]
        self.last[:n] = ids


class _Recent:
    """Order 0 of all lanes: each lane's last ids in order, so an id's share is its run of equal ones.
    A number in [0, 2**bits) names a place, the place's run the id."""

    def __init__(self, ids: np.ndarray):
        n = ids.shape[0]
        flat = np.sort(np.ascontiguousarray(ids.T), axis=1).ravel()
        begins = np.ones(len(flat), bool)
        np.not_equal(flat[1:], flat[:-1], out=begins[1:])
        begins[::n] = True
        first = np.flatnonzero(begins)
        self.bits, self.begins, self.id = np.uint64(n.bit_length() - 1), begins, flat.take(first)
        self.lane, self.begin = first >> int(self.bits), (first & (n - 1)).astype(np.uint64)
        self.size = np.diff(first, append=len(flat)).astype(np.uint64)

    def runs(self) -> np.ndarray:
        """The run of every place of every lane."""
        return np.cumsum(self.begins, dtype=np.int32) - 1


def _epochs(block: int):
    """(begin, end, ids to look back on) of a block's stretches with one order 0."""
    at = [*EPOCHS, *range(EPOCHS[-1] + EPOCH, block, EPOCH), block]
    for begin, end in zip(at, at[1:]):
        if begin < block:
            yield begin, min(end, block), min(begin, RECENT)


def _lanes(numbers: np.ndarray, block: int):
    blocks = -(-len(numbers) // block)
    padded = np.zeros(blocks * block, numbers.dtype)
    padded[:len(numbers)] = numbers
    return np.ascontiguousarray(padded.reshape(blocks, block).T), len(numbers) - (blocks - 1) * block


def _settled(low: np.ndarray, rng: np.ndarray):
    """Shift the settled top words out of the bounds; yields the lanes that shift, and
    their words, until none is left. A range that grew too short at a word's
    edge is cut there, so no carry ever runs into words already out."""
    same = (low ^ (low + rng)) < TOP
    at = (same | (rng < BOTTOM)).nonzero()[0]
    same = same.take(at)
    while len(at):
        lo, r = low.take(at), rng.take(at)
        if not same.all():
            r = np.where(same, r, (~lo + np.uint64(1)) & (BOTTOM - np.uint64(1)))
        yield at, lo >> U48
        lo, r = lo << U16, r << U16
        low[at], rng[at] = lo, r
        same = (lo ^ (lo + r)) < TOP
        go = same | (r < BOTTOM)
        at, same = at[go], same[go]


def _encode_lanes(columns: np.ndarray, tail: int, begin: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output words of each lane and their number; the last lane has ``tail`` ids."""
    block, lanes = columns.shape
    model, lane, k = _Model(lanes), np.arange(lanes), len(freq)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, np.uint64(2**64 - 1))
    room = block + 400
    words, cursor = np.zeros((lanes, room), np.uint16), lane * room
    flat = words.reshape(-1)
    run_of, bits = np.zeros(lanes * k, np.int32), np.uint64(RESET_BITS)  # runs of old epochs are told by their lane and id

    for t0, t1, back in _epochs(block):
        now2d = columns[t0:t1]
        if back:
            recent = _Recent(columns[t0 - back:t0])
            run_of[recent.lane * k + recent.id] = np.arange(len(recent.id), dtype=np.int32)
            run = np.minimum(run_of.take(lane * k + now2d), len(recent.id) - 1)
            seen = (recent.id.take(run) == now2d) & (recent.lane.take(run) == lane)
            else_part = np.where(seen, np.uint64(2), np.uint64(3))
        for t in range(t0, t1):
            n = lanes if t < tail else lanes - 1
            if not n:
                break
            if t % 64 == 0 and (cursor - lane * words.shape[1]).max() + 320 > words.shape[1]:  # at most five words an id
                words = np.concatenate([words, np.zeros((lanes, room), np.uint16)], axis=1)
                flat, cursor = words.reshape(-1), cursor + lane * room
            now, lo, r = columns[t, :n], low[:n], rng[:n]
            _, whole = model.predict(n)
            part = np.where(model.p1 == now, np.uint64(1), else_part[t - t0, :n] if back else np.uint64(3))
            part[model.p2 == now] = 0
            r //= whole
            model.narrow(lo, r, part)
            if back:
                rest = (part == 2).nonzero()[0]
                place = run[t - t0].take(rest)
                unit = r.take(rest) >> recent.bits
                lo[rest] += unit * recent.begin.take(place)
                r[rest] = unit * recent.size.take(place)
            rest = (part == 3).nonzero()[0]
            symbol = now.take(rest)
            unit = r.take(rest) >> bits
            lo[rest] += unit * begin.take(symbol)
            r[rest] = unit * freq.take(symbol)
            for at, out in _settled(lo, r):
                to = cursor.take(at)
                flat[to] = out
                cursor[at] = to + 1
            model.update(now)
    for _ in range(4):  # the rest of low
        flat[cursor] = low >> U48
        low <<= U16
        cursor += 1
    return words, cursor - lane * words.shape[1]


def encode_group(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """One group: header, reset state, per block its length and CRC, the blocks' words."""
    ids = np.ascontiguousarray(ids, np.uint32)
    symbols, freq = reset_state(ids)
    table = zstandard.ZstdCompressor().compress(struct.pack("<I", len(symbols)) + symbols.astype("<u4").tobytes() + freq.astype("<u4").tobytes())
    place = np.zeros(int(symbols[-1]) + 1, np.uint32)
    place[symbols] = np.arange(len(symbols))
    begin, freq = (np.cumsum(freq) - freq).astype(np.uint64), freq.astype(np.uint64)
    columns, tail = _lanes(place.take(ids), block)
    lanes = columns.shape[1]
    step, heads, body = max(1, SEEN_CELLS // len(symbols)), [], []
    for at in range(0, lanes, step):
        words, used = _encode_lanes(np.ascontiguousarray(columns[:, at:at + step]), tail if at + step >= lanes else block, begin, freq)
        for lane, n in enumerate(used.tolist()):
            mine = ids[(at + lane) * block:(at + lane + 1) * block]
            heads.append(struct.pack("<II", n, zlib.crc32(mine.astype("<u4").tobytes())))
            body.append(words[lane, :n].astype("<u2").tobytes())
    return b"".join([struct.pack(GROUP, len(ids), lanes, len(table), block), table, *heads, *body])


class _Head:
    """A group's header: sizes, reset state, and each block's words and CRC."""

    def __init__(self, source, head: bytes):
        self.total, self.lanes, n_table, self.block = struct.unpack(GROUP, head)
        table = zstandard.ZstdDecompressor().decompress(source.read(n_table))
        k = struct.unpack("<I", table[:4])[0]
        self.symbols, freq = np.frombuffer(table, "<u4", k, 4), np.frombuffer(table, "<u4", k, 4 + 4 * k).astype(np.int64)
        self.slot = np.repeat(np.arange(k, dtype=np.uint32), freq)  # slot of the reset state to symbol number
        self.begin, self.freq = (np.cumsum(freq) - freq).astype(np.uint64), freq.astype(np.uint64)
        heads = np.frombuffer(source.read(8 * self.lanes), "<u4").reshape(self.lanes, 2)
        self.words, self.crc = heads[:, 0].astype(np.int64), heads[:, 1]
        self.tail = self.total - (self.lanes - 1) * self.block


def _decode_lanes(head: _Head, body: bytes, first: int, lanes: int) -> np.ndarray:
    """Ids of ``lanes`` blocks from number ``first`` on, whose words are ``body``; checked."""
    counts, block = head.words[first:first + lanes], head.block
    width, at = int(counts.max()) + 8, 0
    words = np.zeros((lanes, width), np.uint16)
    for lane, n in enumerate(counts.tolist()):
        words[lane, :n] = np.frombuffer(body, "<u2", n, at)
        at += 2 * n
    tail = head.tail if first + lanes == head.lanes else block
    model, flat, cursor = _Model(lanes), words.reshape(-1), np.arange(lanes) * width + 4
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, np.uint64(2**64 - 1))
    code = words[:, :4].astype(np.uint64) @ np.array([1 << 48, 1 << 32, 1 << 16, 1], np.uint64)
    out = np.zeros((block, lanes), np.uint32)
    bits, last_slot = np.uint64(RESET_BITS), np.uint64((1 << RESET_BITS) - 1)

    for t0, t1, back in _epochs(block):
        if back and t0 < (block if lanes > 1 else tail):
            recent = _Recent(out[t0 - back:t0])
            runs, last_place = recent.runs(), np.uint64(back - 1)
        for t in range(t0, t1):
            n = lanes if t < tail else lanes - 1
            if not n:
                break
            lo, r = low[:n], rng[:n]
            sums, whole = model.predict(n)
            r //= whole
            off = np.minimum((code[:n] - lo) // r, whole - np.uint64(1))
            part = (off >= (sums & LOW16)).astype(np.uint64)
            part += off >= ((sums >> U16) & LOW16)
            part += off >= ((sums >> np.uint64(32)) & LOW16)
            model.narrow(lo, r, part)
            now = np.where(part == 0, model.p2, model.p1)
            if back:
                rest = (part == 2).nonzero()[0]
                unit = r.take(rest) >> recent.bits
                place = np.minimum((code.take(rest) - lo.take(rest)) // unit, last_place).astype(np.int64)
                run = runs.take(rest * back + place)
                lo[rest] += unit * recent.begin.take(run)
                r[rest] = unit * recent.size.take(run)
                now[rest] = recent.id.take(run)
            rest = (part == 3).nonzero()[0]
            unit = r.take(rest) >> bits
            symbol = head.slot.take(np.minimum((code.take(rest) - lo.take(rest)) // unit, last_slot).astype(np.int64))
            lo[rest] += unit * head.begin.take(symbol)
            r[rest] = unit * head.freq.take(symbol)
            now[rest] = symbol
            for at, _ in _settled(lo, r):
                here = cursor.take(at)
                code[at] = code.take(at) << U16 | flat.take(here, mode="clip")  # a damaged block may run on
                cursor[at] = here + 1
            out[t, :n] = now
            model.update(now)
    ids = head.symbols.take(np.minimum(out.T, len(head.symbols) - 1).reshape(-1))[:(lanes - 1) * block + tail]
    for lane in range(lanes):
        if zlib.crc32(ids[lane * block:(lane + 1) * block].astype("<u4").tobytes()) != head.crc[first + lane]:
            raise ValueError(f"block {first + lane} is damaged")
    return ids


def decode_group(source) -> np.ndarray | None:
    """The ids of the next group of a binary file object, None at its end. A block whose
    CRC differs raises ValueError."""
    start = source.read(GROUP_BYTES)
    if not start:
        return None
    head = _Head(source, start)
    return _decode_lanes(head, source.read(2 * int(head.words.sum())), 0, head.lanes)


def read_block(source, number: int) -> np.ndarray:
    """The ids of one block of the group at the place of a seekable file object: the other blocks are neither read nor decoded."""
    head = _Head(source, source.read(GROUP_BYTES))
    if not 0 <= number < head.lanes:
        raise IndexError(f"block {number} of {head.lanes}")
    source.seek(2 * int(head.words[:number].sum()), 1)
    return _decode_lanes(head, source.read(2 * int(head.words[number])), number, 1)

"""Adaptive context-mixing range coder for token ids, many blocks at a time.

The blocks of a call take the same step at the same time, one lane each, so a step is a handful of array operations. They
teach one model, hence it learns from all of them, and they are decoded together as well. Each block has its own bytes.
All arithmetic is on integers, so coder and decoder agree on every machine.

For each id an order-2 and an order-1 context name the id that last followed them. The chance that one of them is right
is mixed from two adaptive estimates: by how often the contexts were right before, and by how the lane's last ids went.
An id that neither names is coded by an adaptive order-0 model, one that this doesn't hold by its 16 bits.
"""

from __future__ import annotations

import numpy as np

ONE = 65536
#: Slots of the order-2 contexts; an order-1 context has its own.
SLOTS_LOG2 = 18
#: The order-0 model is fitted anew after 1, 2, 4, ... steps, and after every so many.
REFIT = 256
#: Symbols of the order-0 model: an id that was named, the ids from 1 on, an id that the model doesn't hold.
NAMED, ESCAPE = 0, ONE + 1
#: What ``ESCAPE`` has at least, of 65536.
LEAST_ESCAPE = 64
#: States of the trust in both names (and whether they are the same), and of a lane's last hits.
TRUSTS, PASTS = 32, 16
#: The chances are fitted anew after so many steps; counts beyond the other, times 256, are cut by a quarter.
RELEARN, MEMORY = 16, 1 << 23
_U32, _U16, _ONE = np.uint64(32), np.uint64(16), np.uint64(1)
_LOW = np.uint64(2**32 - 1)


def _pack(start: np.ndarray, width: np.ndarray) -> np.ndarray:
    return start.astype(np.uint64) << _U32 | width.astype(np.uint64)


class _Order0:
    """Shares of 65536 of the ids that came, in proportion to how often; what is left over is the escape's."""

    def __init__(self) -> None:
        self.counts = np.zeros(ONE, np.int64)
        self.parts = np.zeros(ONE + 2, np.uint64)
        self.parts[NAMED] = ONE
        self.learn(np.zeros(0, np.int32))

    def learn(self, ids: np.ndarray) -> None:
        self.counts += np.bincount(ids.reshape(-1), minlength=ONE)
        scale = ((ONE - LEAST_ESCAPE) << 20) // max(int(self.counts.sum()), 1)
        width = self.counts * scale >> 20
        held = np.flatnonzero(width)
        end = np.cumsum(width[held])
        taken = int(end[-1]) if len(end) else 0
        self.parts[1:] = 0
        self.parts[held + 1] = _pack(end - width[held], width[held])
        self.parts[ESCAPE] = (taken << 32) + ONE - taken
        self.found = np.repeat(np.append(held + 1, ESCAPE).astype(np.int32), np.append(width[held], ONE - taken))

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        of_id = np.where(self.parts[1:ESCAPE] == 0, ESCAPE, np.arange(1, ESCAPE)).astype(np.int32)
        return of_id.take(ids)


class _Chances:
    """Chances that the first and that the second named id is right, of 65536, mixed from two adaptive estimates: by the
    trust in both names and by how a lane's last ids went. A cell of the mix is a pair of these."""

    def __init__(self) -> None:
        # of each row (all, first right, second right): how often, by trust and past; a chance of 1/8 to begin with
        self.by_trust = np.full((3, TRUSTS, 1), 1 << 8, np.int64)
        self.by_past = np.full((3, 1, PASTS), 1 << 8, np.int64)
        self.by_trust[0], self.by_past[0] = 8 << 8, 8 << 8
        self.lean = np.full((2, TRUSTS, PASTS), 128, np.int64)  # weight of the estimate by trust, of 256
        self.mix()

    def mix(self) -> None:
        x = self.x = (self.by_trust[1:] << 16) // self.by_trust[0]
        y = self.y = (self.by_past[1:] << 16) // self.by_past[0]
        p = np.clip(y + ((x - y) * self.lean >> 8), 32, 61440)
        b = np.maximum((p[1] >> 1) * (ONE - p[0]) >> 16, 1)
        b[1::2] = 1  # both names are the same
        edges = np.stack([np.zeros_like(b), p[0], p[0] + b, np.full_like(b, ONE)], axis=2).reshape(-1, 4)
        self.first, self.both = edges[:, 1].astype(np.uint64), edges[:, 2].astype(np.uint64)
        self.parts = _pack(edges[:, :3], np.diff(edges)).reshape(-1)  # by 3 times the cell and what comes

    def learn(self, came: np.ndarray) -> None:
        """What came in some steps: 3 times the cell and 0 if the first name was right, 1 if the second was, else 2."""
        found = np.bincount(came, minlength=3 * TRUSTS * PASTS).reshape(TRUSTS, PASTS, 3)
        came, right = found.sum(axis=2), np.moveaxis(found[:, :, :2], 2, 0)
        off_x, off_y = (np.abs(came * e - (right << 16)) for e in (self.x, self.y))
        self.lean += np.where(came > 0, np.where(off_x < off_y, 248, 8) - self.lean >> 4, 0)
        for counts, axis in ((self.by_trust, 2), (self.by_past, 1)):
            counts[0] += came.sum(axis=axis - 1, keepdims=True) << 8
            counts[1:] += right.sum(axis=axis, keepdims=True) << 8
            old = counts[0] > MEMORY
            counts -= np.where(old, counts >> 2, 0)
        self.mix()


class _Encoder:
    def __init__(self, ids: np.ndarray) -> None:
        lanes, steps = ids.shape
        self.ids = np.ascontiguousarray(ids.T, np.int32)
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
        # a step gives two words at most; what is not reached takes no memory
        self.out = np.zeros((lanes, 2 * steps + 2), np.uint32)
        self.first = np.arange(lanes) * self.out.shape[1]
        self.at = self.first.copy()

    def fitted(self, model: _Order0, step: int, end: int) -> None:
        """Told whenever the order-0 model is fitted: it holds for the steps up to ``end``."""
        self.model, self.begin = model, step
        self.symbols = model.symbols(self.ids[step:end])

    def _emit(self, lane: np.ndarray, word: np.ndarray) -> None:
        at = self.at[lane]
        self.out.reshape(-1)[at] = word
        self.at[lane] = at + 1

    def _renew(self, few: np.ndarray) -> None:
        low, span = self.low[few], self.range[few]
        word = low >> _U32
        astride = ((low + span - _ONE) >> _U32 != word).nonzero()[0]
        if len(astride):
            span[astride] = np.uint64(2**32) - (low[astride] & _LOW)
        self._emit(few, word)
        self.low[few], self.range[few] = low << _U32, span << _U32

    def _which(self, step, r, cell, chances, first, second):
        truth = self.ids[step]
        return truth == first, truth == second

    def _symbol(self, step, r):
        return self.symbols[step - self.begin]

    def _plain(self, step, r, few):
        return self.ids[step][few]

    def _fill(self, value, first, second, hit0, hit1, symbol):
        pass

    def _part(self, r: np.ndarray, parts: np.ndarray) -> np.ndarray:
        r >>= _U16
        self.low += r * (parts >> _U32)
        r *= parts & _LOW
        return r

    def step(self, step: int, cell, chances: _Chances, first, second):
        """Codes an id by the chances of the named ones and the order-0 model. Returns it and which name was right, if any."""
        hit0, hit1 = self._which(step, self.range >> _U16, cell, chances, first, second)
        hit1 = hit1 > hit0
        miss = ~(hit0 | hit1)
        came = cell * 3 + (hit1 + 2 * miss)
        r = self._part(self.range, chances.parts.take(came))
        symbol = self._symbol(step, r >> _U16) * miss
        self.range = r = self._part(r, self.model.parts.take(symbol))
        few = (r <= _LOW).nonzero()[0]
        if len(few):
            self._renew(few)
        value = self.ids[step]
        self._fill(value, first, second, hit0, hit1, symbol)
        few = (symbol == ESCAPE).nonzero()[0]
        if len(few):
            r = self.range[few] >> _U16
            plain = self._plain(step, r, few)
            self.low[few] += r * plain.astype(np.uint64)
            self.range[few] = r
            value[few] = plain
            few = few[r <= _LOW]
            if len(few):
                self._renew(few)
        return value, came, miss

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.at))
        self._emit(every, (self.low >> _U32).astype(np.uint32))
        self._emit(every, (self.low & _LOW).astype(np.uint32))
        return [row[:n].astype("<u4").tobytes() for row, n in zip(self.out, self.at - self.first, strict=True)]


class _Decoder(_Encoder):
    def __init__(self, blocks: list[bytes], length: int) -> None:
        super().__init__(np.zeros((len(blocks), 0), np.int32))
        self.ids = np.zeros((length, len(blocks)), np.int32)
        size = max(len(b) for b in blocks) // 4
        # a block that is cut short reads zeros past its end; its checksum tells
        self.words = np.zeros((len(blocks), size + 2), np.uint32)
        for k, b in enumerate(blocks):
            self.words[k, : len(b) // 4] = np.frombuffer(b[: len(b) // 4 * 4], "<u4")
        self.code = (self.words[:, 0].astype(np.uint64) << _U32) | self.words[:, 1]
        self.at = np.arange(len(blocks)) * (size + 2) + 2
        self.last = (np.arange(len(blocks)) + 1) * (size + 2) - 1

    def fitted(self, model: _Order0, step: int, end: int) -> None:
        self.model = model

    def _emit(self, lane: np.ndarray, word: np.ndarray) -> None:
        at = self.at[lane]
        self.code[lane] = (self.code[lane] << _U32) | self.words.reshape(-1)[at]
        self.at[lane] = np.minimum(at + 1, self.last[lane])

    def _which(self, step, r, cell, chances, first, second):
        off = self.code - self.low
        return off < r * chances.first.take(cell), off < r * chances.both.take(cell)

    def _symbol(self, step, r):
        return self.model.found.take(((self.code - self.low) // r).astype(np.int64), mode="clip")

    def _plain(self, step, r, few):
        return np.minimum((self.code[few] - self.low[few]) // r, np.uint64(ONE - 1)).astype(np.int32)

    def _fill(self, value, first, second, hit0, hit1, symbol):
        # symbols are 0 where an id was named
        value[:] = first * hit0 + second * hit1 + symbol - (symbol > 0)


def _run(coder: _Encoder, lanes: int, steps: int) -> np.ndarray:
    """The model; a coder codes its ids by it, a decoder finds them. Returns the ids."""
    slots = 1 << SLOTS_LOG2
    named = np.zeros(ONE + slots, np.int32)  # by context: the id it names, times 4, and how often in a row it was right
    chances, model, fitted, refit = _Chances(), _Order0(), 0, 0
    past, before, older = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32), np.zeros(lanes, np.int64)
    at, seen = np.zeros((2, lanes), np.int64), []
    out = coder.ids
    for step in range(steps):
        if step == refit:
            model.learn(out[fitted:step])
            fitted, refit = step, step + min(max(step, 1), REFIT)
            coder.fitted(model, step, refit)
        at[0] = before
        hashed = at[0] * 40503
        np.bitwise_and((hashed + older) >> 5, slots - 1, out=at[1])
        at[1] += ONE
        older = at[0] * 60493
        entry = named.take(at)
        trust, name = entry & 3, entry >> 2
        swapped = (name[0] - name[1]) * (trust[0] > trust[1])
        first, second = name[1] + swapped, name[0] - swapped
        cell = (((trust[1] << 2) + trust[0] << 1) + (first == second) << 4) + past
        value, came, miss = coder.step(step, cell, chances, first, second)
        seen.append(came)
        if len(seen) == RELEARN or step < 32:
            chances.learn(np.concatenate(seen))
            seen = []
        past = (past << 1 & PASTS - 1) | ~miss
        right = (name == value).astype(np.int32)
        # lanes in the same context: the last one's entry stays, in coder and decoder alike
        name = value + (name - value) * (trust > 1)
        named[at] = (name << 2) + np.minimum(trust + right >> (right ^ 1), 3)
        before = value
    return out.T


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The bytes of each row of ``ids`` (blocks, ids of a block), values below 65536. They are decoded together again."""
    coder = _Encoder(ids)
    _run(coder, *ids.shape)
    return coder.finish()


def decode_blocks(blocks: list[bytes], length: int) -> np.ndarray:
    """The ids of the blocks of one call of ``encode_blocks``, ``length`` each."""
    if not blocks:
        return np.zeros((0, length), np.int32)
    return _run(_Decoder(blocks, length), len(blocks), length)

"""An adaptive range coder for token ids: order-0 to order-2 predictions, many lanes of a block at a time.

Blocks are independent. A block is cut into lanes of equal length, and numpy codes one id of every lane per
step. The lanes of a block share their predictions, which are worked out anew from all ids so far whenever
those reach the next of ``REBUILD``; in between they stand still.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TFID"
VERSION = 3
HEADER = struct.Struct("<4sBxHIIII")
#: Ids of a lane at least and at most, and lanes that a block should have.
SHORTEST, LONGEST, LANES = 64, 512, 4096
#: Ids of a block after which its predictions are worked out anew.
REBUILD = tuple(1 << k for k in (8, 11, 14, 16, 18, 19))
#: Slots of the order-2 guesses, and bits of a guess that tell its trust.
TWO_BITS, TRUST_BITS = 17, 3
ID_BITS = 20
TOTAL_BITS = 20
PROB_BITS = 16
#: Room that a guess, and what no guess meets, has at least.
FLOOR = 64
#: The interval is at most 2**56 wide and is widened by 16 bits while it is below 2**40.
SHIFT, DIGIT = 40, 16
TOP, START = 1 << SHIFT, 1 << 55
LOW_MASK = TOP - 1
#: Ids whose rooms are looked up at a time by the encoder.
LOOKED_UP = 1 << 16


def _steps(length: int) -> int:
    """Ids per lane of a block; the last lane may hold fewer."""
    return min(LONGEST, max(SHORTEST, -(-length // LANES)), length)


def _rebuilds(lanes: int) -> set[int]:
    """Steps before which the predictions are worked out anew."""
    return {-(-ids // lanes) for ids in REBUILD}


class _Model:
    """Predictions of the lanes of a block: an order-1 and an order-2 guess and order-0 counts.

    A guess is the commonest id behind the last one or two, with a trust of 0 (none) to 7 in its lowest
    bits. By both trusts, chances counted over the ids before tell how often the order-2 guess, or else the
    order-1 guess, is right; the rest of the interval belongs to the order-0 counts, in which a value takes
    room 1, and more in proportion to its count.
    """

    def __init__(self, vocabulary: int):
        self.vocabulary = vocabulary
        self.one = np.full(vocabulary, -1 << TRUST_BITS, np.int32)
        self.two = np.full(1 << TWO_BITS, -1 << TRUST_BITS, np.int32)
        self.done = 0
        trust = np.arange(1 << 2 * TRUST_BITS)
        # Before anything is counted, a trust stands for a share of eight cases.
        self.cases = np.full(len(trust), 8.0)
        self.right = np.stack([(trust >> TRUST_BITS) * 1.0, (trust & 7) * 0.5])
        self._chances()
        self._order_zero(np.zeros(0, np.int64))

    def _chances(self) -> None:
        """Bounds in the interval, for both trusts: order-2 guess, order-1 guess, neither."""
        share = np.rint(self.right / self.cases * (65536 - 4 * FLOOR)).astype(np.int64) + FLOOR
        trust = np.arange(share.shape[1])
        first = np.where(trust >> TRUST_BITS, np.minimum(share[0], 65536 - 2 * FLOOR), 0)
        both = np.where(trust & 7, np.minimum(first + share[1], 65536 - FLOOR), first)
        self.bounds = np.stack([np.zeros_like(first), first, both, np.full_like(first, 65536)], axis=1).reshape(-1)

    def _order_zero(self, ids: np.ndarray) -> None:
        """Start and width of every value, and the value at every place, from the counts."""
        room = (1 << TOTAL_BITS) - self.vocabulary
        if len(ids):
            self.width = 1 + np.bincount(ids, minlength=self.vocabulary) * room // len(ids)
        else:
            self.width = np.full(self.vocabulary, 1 + room // self.vocabulary, np.int64)
        self.start = np.cumsum(self.width) - self.width
        self.place = None

    def values(self) -> np.ndarray:
        """The value at every place."""
        return np.repeat(np.arange(self.vocabulary, dtype=np.int32), self.width)

    @staticmethod
    def slots(last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Order-2 slot of an id pair."""
        return ((last * 40503 + before * 2654435) >> 5) & ((1 << TWO_BITS) - 1)

    @staticmethod
    def _guesses(slots: np.ndarray, ids: np.ndarray, out: np.ndarray) -> None:
        """Put the commonest id of each slot into ``out``, the largest of several."""
        keys = np.sort((slots << ID_BITS | ids).reshape(-1))
        if not len(keys):
            return
        ends = np.flatnonzero(np.append(keys[1:] != keys[:-1], True))
        count, kinds = np.diff(ends, prepend=-1), keys[ends]
        slot = kinds >> ID_BITS
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        best = np.maximum.reduceat(count << ID_BITS | kinds & ((1 << ID_BITS) - 1), first)
        total, count = np.add.reduceat(count, first), best >> ID_BITS
        trust = np.where(total == 1, 1, 2 + np.minimum(5, 6 * count // total))
        out[slot[first]] = (best & ((1 << ID_BITS) - 1)) << TRUST_BITS | trust

    def look_up(self, last: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both guesses behind the ids ``before`` and ``last``, and the place of their bounds."""
        one, two = self.one.take(last), self.two.take(self.slots(last, before))
        return one, two, ((two & 7) << 5 | (one & 7) << 2).astype(np.int64)

    def rebuild(self, rows: np.ndarray) -> None:
        """Take in all ids so far, given as a row per step."""
        upto, lanes = rows.shape
        some = max(1, LOOKED_UP // lanes)
        cases, right = np.zeros_like(self.cases), np.zeros_like(self.right)
        for begin in range(max(2, self.done), upto, some):
            end = min(begin + some, upto)
            now = rows[begin:end].reshape(-1)
            one, two, at = self.look_up(rows[begin - 1 : end - 1].reshape(-1).astype(np.int64), rows[begin - 2 : end - 2].reshape(-1).astype(np.int64))
            right_two = two >> TRUST_BITS == now
            right_one = (one >> TRUST_BITS == now) > right_two
            at >>= 2
            cases += np.bincount(at, minlength=len(cases))
            right[0] += np.bincount(at[right_two], minlength=len(cases))
            right[1] += np.bincount(at[right_one], minlength=len(cases))
        # What was counted with fewer ids known weighs less.
        self.cases, self.right = self.cases / 4 + cases, self.right / 4 + right
        self.done = upto
        self._chances()
        wide = rows.astype(np.int64)
        self._order_zero(wide.reshape(-1))
        self._guesses(wide[:-1], wide[1:], self.one)
        self._guesses(self.slots(wide[1:-1], wide[:-2]), wide[2:], self.two)


def _check(ids: np.ndarray, vocabulary: int) -> None:
    if vocabulary > 1 << ID_BITS - 1:
        raise ValueError("the vocabulary is too large")
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < vocabulary:
        raise ValueError("an id lies outside the vocabulary")


def _encode(ids: np.ndarray, vocabulary: int, steps: int) -> bytes:
    """The digits of each lane behind their counts."""
    lanes = -(-len(ids) // steps)
    padded = np.zeros(steps * lanes, np.uint16 if vocabulary <= 1 << 16 else np.int32)
    padded[: len(ids)] = ids
    # Two rows of zeros stand before the first ids.
    rows = np.zeros((steps + 2, lanes), padded.dtype)
    rows[2:] = padded.reshape(lanes, steps).T
    shortest = len(ids) - (lanes - 1) * steps  # of the last lane
    model, rebuilds = _Model(vocabulary), _rebuilds(lanes)
    low, size = np.zeros(lanes, np.int64), np.full(lanes, START, np.int64)
    digits, put = [], []
    upto = 0
    for t in range(steps):
        if t in rebuilds:
            model.rebuild(rows[2 : t + 2])
        if t == upto or t in rebuilds:
            begin, upto = t, min([steps, t + max(1, LOOKED_UP // lanes), *(x for x in rebuilds if x > t)])
            now = rows[begin + 2 : upto + 2].reshape(-1)
            one, two, at = model.look_up(
                rows[begin + 1 : upto + 1].reshape(-1).astype(np.int64), rows[begin:upto].reshape(-1).astype(np.int64)
            )
            right_two = two >> TRUST_BITS == now
            right_one = one >> TRUST_BITS == now
            at += np.where(right_two, 0, np.where(right_one, 1, 2))
            miss = ~(right_two | right_one)
            start = model.bounds.take(at)
            width = model.bounds.take(at + 1) - start
            inner = np.where(miss, model.start.take(now), 0)
            share = np.where(miss, model.width.take(now), 1 << TOTAL_BITS)
            start, width, inner, share = (x.reshape(upto - begin, lanes) for x in (start, width, inner, share))
        k = t - begin
        unit = size >> PROB_BITS
        low += unit * start[k]
        unit *= width[k]
        unit >>= TOTAL_BITS
        low += unit * inner[k]
        np.multiply(unit, share[k], out=size)
        if t >= shortest:  # the last lane is over
            size[-1], low[-1] = TOP, last_low
        while True:
            small = size < TOP
            if not small.any():
                break
            digits.append((low >> SHIFT).astype(np.int32))
            put.append(small)
            by = small * np.int64(DIGIT)
            low = np.where(small, low & LOW_MASK, low) << by
            size <<= by
        if t + 1 >= shortest:
            last_low = low[-1]
    # A multiple of TOP lies in an interval of at least TOP; what follows its digit is zero.
    low += TOP - 1
    digits.append((low >> SHIFT).astype(np.int32))
    put.append(np.ones(lanes, bool))
    put = np.array(put)
    flat = np.array(digits).T[put.T]
    while True:  # a digit of 2**16 or more carries into the one before it
        carry = flat >> DIGIT
        if not carry.any():
            break
        flat &= 0xFFFF
        flat[:-1] += carry[1:]
    return put.sum(axis=0, dtype="<u4").tobytes() + flat.astype("<u2").tobytes()


def encode_blocks(ids: list[np.ndarray], vocabulary: int = 1 << 16) -> list[bytes]:
    """One self-contained, checksummed byte string per block of ids."""
    out = []
    for block in ids:
        block = np.asarray(block)
        _check(block, vocabulary)
        steps = _steps(len(block))
        body = _encode(block, vocabulary, steps) if steps else b""
        crc = zlib.crc32(np.ascontiguousarray(block, "<u4").tobytes())
        out.append(HEADER.pack(MAGIC, VERSION, steps, vocabulary, len(block), crc, zlib.crc32(body)) + body)
    return out


def _decode(body: bytes, steps: int, vocabulary: int, length: int) -> np.ndarray:
    """The ids of a block, lane behind lane."""
    lanes = -(-length // steps)
    counts = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    flat = np.frombuffer(body, "<u2", offset=4 * lanes)
    room = int(counts.max()) + 5
    table = np.zeros((lanes, room), np.int64)
    table[np.arange(room) < counts[:, None]] = flat
    # 56 bits are looked at: three digits and half of the fourth, so the digits are put half a digit further.
    ahead = (table[:, 0] << SHIFT) | (table[:, 1] << 24) | (table[:, 2] << 8) | (table[:, 3] >> 8)
    table[:, :-1] = (table[:, :-1] & 0xFF) << 8 | table[:, 1:] >> 8
    digits = table.astype(np.uint16).reshape(-1)
    place = np.arange(lanes, dtype=np.int64) * room + 3
    shortest = length - (lanes - 1) * steps
    size = np.full(lanes, START, np.int64)
    model, rebuilds = _Model(vocabulary), _rebuilds(lanes)
    rows = np.zeros((steps, lanes), np.uint16 if vocabulary <= 1 << 16 else np.int32)
    last = before = np.zeros(lanes, np.int64)
    values = None
    for t in range(steps):
        if t in rebuilds:
            values = None
            model.rebuild(rows[:t])
        if values is None:
            values, bounds, inner, share = model.values(), model.bounds, model.start, model.width
        one, two, at = model.look_up(last, before)
        unit = size >> PROB_BITS
        value = ahead // unit
        not_two = value >= bounds.take(at + 1)
        miss = value >= bounds.take(at + 2)
        at += not_two
        at += miss
        start = bounds.take(at)
        ahead -= unit * start
        at += 1
        unit *= bounds.take(at) - start
        unit >>= TOTAL_BITS
        found = values.take(ahead // unit, mode="clip").astype(np.int64)
        ahead -= unit * np.where(miss, inner.take(found), 0)
        np.multiply(unit, np.where(miss, share.take(found), 1 << TOTAL_BITS), out=size)
        now = np.where(miss, found, np.where(not_two, one, two) >> TRUST_BITS)
        if t >= shortest:  # the last lane is over
            now[-1], size[-1], ahead[-1] = 0, TOP, 0
        while True:
            small = size < TOP
            if not small.any():
                break
            by = small * np.int64(DIGIT)
            ahead = ahead << by | digits.take(place) * small
            size <<= by
            place += small
        rows[t] = now
        last, before = now, last
    return rows.T.reshape(-1)[:length]


def decode_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; a damaged block raises."""
    out = []
    for data in blocks:
        magic, version, steps, vocabulary, length, ids_crc, body_crc = HEADER.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a block of token ids")
        body = data[HEADER.size :]
        if zlib.crc32(body) != body_crc:
            raise ValueError("block checksum differs")
        found = _decode(body, steps, vocabulary, length).astype("<u4") if length else np.zeros(0, np.uint32)
        if zlib.crc32(found.tobytes()) != ids_crc:
            raise ValueError("decoded ids fail their checksum")
        out.append(found)
    return out

"""An adaptive context-mixing range coder for blocks of token ids (below 2**16).

A block is coded on its own: models start empty (reset), and a checksum
guards it.  Its ids are cut into lanes (``LANES`` at most, of ``LANE_IDS`` ids at
least), runs that are coded side by side, one id of each run a step, so that
numpy codes many lanes of many blocks at once.  All lanes of a block share and
train the block's models:

- order 2 and order 1 predict the id last seen after the two (one) ids before,
  with a confidence of 0 (nothing seen yet) to 3;
- order 0 has the frequencies of all ids seen in the block so far, and a share
  for an id that wasn't, which then follows in 16 plain bits.

An id's range is its part of the mixture of the three distributions, so it
grows with each model that expects it.  The mixing weights adapt: for each state
of confidence (order 2, order 1, do they agree) the block counts which model was
right.  Predictions learn after each step; weights and frequencies are set anew
from their counts at the steps of ``refresh_steps``, alike in both directions.
The arithmetic coder is a carry-less range coder with 64-bit state and 16-bit
output words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 1024
LANE_IDS = 512
ID_BITS = 16
IDS = 1 << ID_BITS
SLOT_BITS = 16          # order-0 frequencies add up to 1 << SLOT_BITS
SLOTS = 1 << SLOT_BITS
WEIGHT_BITS = 12        # so do the mixing weights of a state
MIX_BITS = SLOT_BITS + WEIGHT_BITS
CONTEXT_BITS = 17       # slots of the order-2 predictions
STATES = 32             # confidence of order 2 (0-3), of order 1 (0-3), same id
REFRESH = 64

U = np.uint64
TOP, BOTTOM = U(1 << 48), U(1 << 32)
ID_MASK = np.uint32(IDS - 1)
SLOT_SHIFT, SLOT_MASK = np.uint32(SLOT_BITS), np.uint32(SLOTS - 1)
ONE, TWO, THREE = (np.uint32(k << ID_BITS) for k in (1, 2, 3))
MAGIC = b"AFR2"
HEAD = struct.Struct("<4sIIII")  # magic, documents, ids, words, crc32 of the rest


def refresh_steps(steps: int) -> set[int]:
    return {1 << k for k in range(REFRESH.bit_length())} | set(range(REFRESH, steps, REFRESH))


class Owners:
    """The block of every lane, and where its rows of each table begin."""

    def __init__(self, block: np.ndarray):
        self.block, self.ids, self.states = block, block << ID_BITS, block * STATES
        self.contexts, self.slots = block << CONTEXT_BITS, block * SLOTS

    def first(self, k: int) -> "Owners":
        out = object.__new__(Owners)
        out.__dict__ = {name: rows[:k] for name, rows in self.__dict__.items()}
        return out


class Models:
    """The models of several blocks; block b owns rows b of every table."""

    def __init__(self, blocks: int):
        # a prediction is its id, with the confidence above the id's bits
        self.order1 = np.zeros(blocks * IDS, np.uint32)
        self.order2 = np.zeros(blocks << CONTEXT_BITS, np.uint32)
        # per state how often order 2, order 1 and neither was right
        self.right = np.ones((blocks * STATES, 3), np.int64)
        self.counts = np.zeros(blocks * IDS, np.uint32)
        # order 0: where each id's slots begin, above their number; new ids have those from ``room`` on
        self.slots = np.zeros(blocks * IDS, np.uint32)
        self.room = np.zeros(blocks, np.uint32)
        self.at_slot = np.zeros(blocks * SLOTS, np.uint16)
        self.seen_states: list[np.ndarray] = []
        self.seen_ids: list[np.ndarray] = []
        self.set_weights()

    def set_weights(self) -> None:
        right = self.right.copy().reshape(-1, STATES, 3)
        right[:, :8, 0] = 0                                   # order 2 has seen nothing
        right.reshape(-1, 4, 4, 2, 3)[:, :, 0, :, 1] = 0      # nor order 1
        right = right.reshape(-1, 3)
        room = (1 << WEIGHT_BITS) - 3
        freq = (right * room // right.sum(1, keepdims=True) + (right > 0)).astype(np.int64)
        freq[:, 2] += (1 << WEIGHT_BITS) - freq.sum(1)
        self.weight2, self.weight1, self.weight0 = (freq[:, k].astype(np.uint32) for k in range(3))
        self.weight2, self.weight1 = self.weight2 << np.uint32(SLOT_BITS), self.weight1 << np.uint32(SLOT_BITS)

    def refresh(self) -> None:
        """New weights and frequencies from all that was coded up to here."""
        if not self.seen_ids:
            return
        found = np.bincount(np.concatenate(self.seen_states), minlength=self.right.size)
        self.right += 4 * found.reshape(self.right.shape)
        self.set_weights()
        fresh = np.bincount(np.concatenate(self.seen_ids), minlength=len(self.counts)).astype(np.uint32)
        for b in range(len(self.room)):
            rows = slice(b * IDS, (b + 1) * IDS)
            coded = int(fresh[rows].sum())
            if not coded:
                continue
            old = np.count_nonzero(self.counts[rows])
            self.counts[rows] += fresh[rows]
            ids = np.flatnonzero(self.counts[rows])
            counts = self.counts[rows][ids].astype(np.int64)
            # about as many new ids are ahead as were new of late, halved
            new = int(np.clip(SLOTS * (len(ids) - old) // (2 * coded), 16, SLOTS // 2))
            if len(ids) > SLOTS // 4:  # the most frequent; the rest are coded as new
                most = np.sort(np.argsort(-counts, kind="stable")[:SLOTS // 4])
                ids, counts = ids[most], counts[most]
            room = SLOTS - new
            freq = counts * (room - len(ids)) // counts.sum() + 1
            freq[freq.argmax()] += room - freq.sum()
            own = np.zeros(IDS, np.int64)
            own[ids] = freq
            self.slots[rows] = (np.cumsum(own) - own) << SLOT_BITS | own
            self.at_slot[b * SLOTS:b * SLOTS + room] = np.repeat(ids.astype(np.uint16), freq)
            self.room[b] = room
        self.seen_states, self.seen_ids = [], []

    def predict(self, own: Owners, last: np.ndarray, second: np.ndarray):
        """Slots of both predictions, the predictions, the state and the weights
        of orders 0, 1 and 2."""
        s1 = own.ids + last
        s2 = own.contexts + ((second * 40503 + last * 10007) & ((1 << CONTEXT_BITS) - 1))
        p1, p2 = self.order1.take(s1), self.order2.take(s2)
        state = own.states + ((p2 >> 16) * 8 + (p1 >> 16) * 2 + ((p1 ^ p2) & ID_MASK == 0))
        return s1, s2, p1, p2, state, self.weight0.take(state), self.weight1.take(state), self.weight2.take(state)

    def part(self, guess, x: np.ndarray, place: np.ndarray):
        """Where the mixture's share of each id begins, and that share; 0 if no
        model knows it.  ``place`` is the id's among all blocks' ids."""
        _, _, p1, p2, _, w0, w1, w2 = guess
        id1, id2 = p1 & ID_MASK, p2 & ID_MASK
        own = self.slots.take(place)
        x = x.astype(np.uint32)
        return w0 * (own >> SLOT_SHIFT) + w1 * (id1 < x) + w2 * (id2 < x), w0 * (own & SLOT_MASK) + w1 * (id1 == x) + w2 * (id2 == x)

    def new_part(self, guess, new: np.ndarray, block: np.ndarray):
        """The same of the share for new ids, in the lanes ``new``."""
        w0, w1, w2 = (w[new] for w in guess[5:])
        low = self.room[block[new]]
        return w0 * low + w1 + w2, w0 * (np.uint32(SLOTS) - low)

    def find(self, guess, v: np.ndarray, own_rows: Owners):
        """The id whose share holds each of ``v``, whether it is a new one (then the
        id is none), where its share begins, and the share."""
        _, _, p1, p2, _, w0, w1, w2 = guess
        id1, id2 = p1 & ID_MASK, p2 & ID_MASK
        base = own_rows.ids
        own1, own2 = self.slots.take(base + id1), self.slots.take(base + id2)
        low1 = w0 * (own1 >> SLOT_SHIFT) + w2 * (id2 < id1)
        low2 = w0 * (own2 >> SLOT_SHIFT) + w1 * (id1 < id2)
        same = id1 == id2
        high1 = low1 + w0 * (own1 & SLOT_MASK) + w1 + w2 * same
        high2 = low2 + w0 * (own2 & SLOT_MASK) + w2 + w1 * same
        # less what the predictions add below v, it is order 0 alone
        point = w1 * (v >= high1) + w2 * (v >= high2)
        slot = (v - point) // w0
        x = self.at_slot.take(own_rows.slots + np.minimum(slot, SLOT_MASK)).astype(np.int64)
        own = self.slots.take(base + x)
        low, share = w0 * (own >> SLOT_SHIFT) + point, w0 * (own & SLOT_MASK)
        new = slot >= self.room.take(own_rows.block)
        for one, its_low, its_high in ((id1, low1, high1), (id2, low2, high2)):
            inside = (v >= its_low) & (v < its_high)
            np.copyto(x, one, where=inside)
            np.copyto(low, its_low, where=inside)
            np.copyto(share, its_high - its_low, where=inside)
            new &= ~inside
        return x, new, low, share

    def learn(self, guess, x: np.ndarray, place: np.ndarray) -> None:
        s1, s2, p1, p2, state = guess[:5]
        x32 = x.astype(np.uint32)
        was = []
        for table, slot, p in ((self.order1, s1, p1), (self.order2, s2, p2)):
            right = (p ^ x32) & ID_MASK == 0
            # right: one more, to 3 (a prediction of nothing becomes one of x);
            # wrong: one less, or else replaced
            table[slot] = np.where(right, np.minimum(p + ONE, x32 | THREE), np.where(p >= TWO, p - ONE, x32 | ONE))
            was.append(right & (p >= ONE))
        self.seen_states.append(state * 3 + np.where(was[1], 0, 2 - was[0]))
        self.seen_ids.append(place)


def lane_table(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start in its block and length of every lane, shape (blocks, LANES)."""
    step = np.maximum(LANE_IDS, -(-sizes // LANES))
    start = np.minimum(np.arange(LANES) * step[:, None], sizes[:, None])
    return start, np.minimum(start + step[:, None], sizes[:, None]) - start


def _active(length: np.ndarray):
    """Lanes by falling length, so that those still busy are always a prefix."""
    order = np.argsort(-length, kind="stable")
    return order, np.sort(length)[::-1]


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The lanes' lengths in words, then their words, of each block."""
    sizes = np.array([len(b) for b in blocks], np.int64)
    start, length = lane_table(sizes)
    ids = np.concatenate([*blocks, np.zeros(1, np.int64)]).astype(np.int64)
    first = (np.cumsum(sizes) - sizes)[:, None] + start
    order, busy = _active(length.ravel())
    owners_of, at = Owners(order // LANES), first.ravel()[order]
    n = len(order)
    low, rng = np.zeros(n, np.uint64), np.full(n, ~U(0))
    last, second = np.zeros(n, np.int64), np.zeros(n, np.int64)
    words: list[np.ndarray] = []   # output words in the order they are made,
    owners: list[np.ndarray] = []  # with the lane of each

    def narrow(who, lanes, cum, freq, shift) -> None:
        # ``who`` are the lanes, as a slice where they are the first ones: no copies
        r = rng[who] >> shift
        lo, width = low[who] + cum * r, freq * r
        while True:
            settled = (lo ^ (lo + width)) < TOP
            again = np.flatnonzero(settled | (width < BOTTOM))
            if not len(again):
                break
            if not len(again) == len(lanes):
                low[who], rng[who] = lo, width
                who = lanes = lanes.take(again)
                lo, width, settled = lo.take(again), width.take(again), settled.take(again)
            width = np.where(settled, width, (~lo + U(1)) & (BOTTOM - U(1)))
            words.append((lo >> U(48)).astype(np.uint16))
            owners.append(lanes)
            lo, width = lo << U(16), width << U(16)
        low[who], rng[who] = lo, width

    models, steps = Models(len(blocks)), int(busy[0]) if n else 0
    refresh = refresh_steps(steps)
    ends = n - np.searchsorted(busy[::-1], np.arange(1, steps + 1))
    everyone = np.arange(n)
    for t in range(steps):
        if t in refresh:
            models.refresh()
        k = ends[t]
        own = owners_of.first(k)
        x = ids.take(at[:k] + t)
        guess = models.predict(own, last[:k], second[:k])
        place = own.ids + x
        low_of, share = models.part(guess, x, place)
        new = np.flatnonzero(share == 0)
        if len(new):
            low_of[new], share[new] = models.new_part(guess, new, own.block)
        narrow(slice(k), everyone[:k], low_of.astype(np.uint64), share.astype(np.uint64), U(MIX_BITS))
        if len(new):
            narrow(new, new, x[new].astype(np.uint64), np.ones(len(new), np.uint64), U(ID_BITS))
        models.learn(guess, x, place)
        second[:k], last[:k] = last[:k], x
    used = everyone[busy > 0]
    end = (low[used] + BOTTOM - U(1)) & ~(BOTTOM - U(1))  # two words that lie in the last range
    for shift in (48, 32):
        words.append((end >> U(shift)).astype(np.uint16))
        owners.append(used)
    made = order[np.concatenate(owners)] if n else np.empty(0, np.int64)
    by_lane = np.argsort(made, kind="stable")
    stream = np.concatenate(words)[by_lane].astype("<u2") if n else np.empty(0, "<u2")
    per_lane = np.bincount(made, minlength=n).reshape(len(blocks), LANES)
    cuts = np.concatenate([[0], np.cumsum(per_lane.sum(1))])
    return [per_lane[b].astype("<u4").tobytes() + stream[cuts[b]:cuts[b + 1]].tobytes() for b in range(len(blocks))]


def decode_blocks(payloads: list[bytes], sizes: np.ndarray) -> list[np.ndarray]:
    """The ids that ``encode_blocks`` was given."""
    sizes = np.asarray(sizes, np.int64)
    start, length = lane_table(sizes)
    per_lane = np.array([np.frombuffer(p, "<u4", LANES) for p in payloads], np.int64).reshape(len(payloads), LANES)
    stream = np.concatenate([*(np.frombuffer(p, "<u2", -1, LANES * 4) for p in payloads), np.zeros(1, np.uint16)]).astype(np.uint64)
    out = np.zeros(int(sizes.sum()), np.int64)
    first = (np.cumsum(sizes) - sizes)[:, None] + start
    order, busy = _active(length.ravel())
    owners_of, at = Owners(order // LANES), first.ravel()[order]
    n = len(order)
    pos = (np.cumsum(per_lane) - per_lane.ravel())[order]
    stop = pos + per_lane.ravel()[order]
    nothing = len(stream) - 1
    code = np.zeros(n, np.uint64)
    for _ in range(4):
        code = code << U(16) | stream[np.where(pos < stop, pos, nothing)]
        pos += 1
    low, rng = np.zeros(n, np.uint64), np.full(n, ~U(0))
    last, second = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def narrow(who, lanes, cum, freq, r) -> None:
        lo, width, c, p = low[who] + cum * r, freq * r, code[who], pos[who]
        while True:
            settled = (lo ^ (lo + width)) < TOP
            again = np.flatnonzero(settled | (width < BOTTOM))
            if not len(again):
                break
            if not len(again) == len(lanes):
                low[who], rng[who], code[who], pos[who] = lo, width, c, p
                who = lanes = lanes.take(again)
                lo, width, settled, c, p = (v.take(again) for v in (lo, width, settled, c, p))
            width = np.where(settled, width, (~lo + U(1)) & (BOTTOM - U(1)))
            c = c << U(16) | stream.take(np.where(p < stop.take(lanes), p, nothing))
            p = p + 1
            lo, width = lo << U(16), width << U(16)
        low[who], rng[who], code[who], pos[who] = lo, width, c, p

    models, steps = Models(len(payloads)), int(busy[0]) if n else 0
    refresh = refresh_steps(steps)
    ends = n - np.searchsorted(busy[::-1], np.arange(1, steps + 1))
    everyone = np.arange(n)
    for t in range(steps):
        if t in refresh:
            models.refresh()
        k = ends[t]
        own = owners_of.first(k)
        guess = models.predict(own, last[:k], second[:k])
        r = rng[:k] >> U(MIX_BITS)
        x, is_new, low_of, share = models.find(guess, np.minimum((code[:k] - low[:k]) // r, U((1 << MIX_BITS) - 1)).astype(np.uint32), own)
        new = np.flatnonzero(is_new)
        if len(new):
            low_of[new], share[new] = models.new_part(guess, new, own.block)
        narrow(slice(k), everyone[:k], low_of.astype(np.uint64), share.astype(np.uint64), r)
        if len(new):
            r = rng[new] >> U(ID_BITS)
            v = np.minimum((code[new] - low[new]) // r, U(IDS - 1))
            narrow(new, new, v, np.ones(len(new), np.uint64), r)
            x[new] = v.astype(np.int64)
        out[at[:k] + t] = x
        models.learn(guess, x, own.ids + x)
        second[:k], last[:k] = last[:k], x
    return np.split(out, np.cumsum(sizes)[:-1])


def pack_blocks(documents: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[bytes]:
    """A byte string per block of (doc_ids, n_tokens, ids); doc_ids are int64."""
    out = []
    for (doc_ids, counts, ids), coded in zip(documents, encode_blocks([d[2] for d in documents])):
        if len(ids) and int(ids.max()) >= IDS:
            raise ValueError(f"ids must be below {IDS}")
        body = (np.asarray(doc_ids, "<i8").tobytes() + np.asarray(counts, "<u4").tobytes()
                + struct.pack("<I", zlib.crc32(np.asarray(ids, "<u4").tobytes())) + coded)
        out.append(HEAD.pack(MAGIC, len(doc_ids), len(ids), len(coded), zlib.crc32(body)) + body)
    return out


def unpack_blocks(blobs: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What ``pack_blocks`` was given; raises if a checksum doesn't hold."""
    heads = []
    for blob in blobs:
        magic, docs, ids, size, crc = HEAD.unpack_from(blob)
        if magic != MAGIC or zlib.crc32(blob[HEAD.size:]) != crc:
            raise ValueError("damaged block")
        at = HEAD.size + 12 * docs + 4
        heads.append((np.frombuffer(blob, "<i8", docs, HEAD.size), np.frombuffer(blob, "<u4", docs, HEAD.size + 8 * docs).astype(np.int64),
                      ids, struct.unpack_from("<I", blob, at - 4)[0], blob[at:at + size]))
    out = []
    for (doc_ids, counts, _, crc, _), ids in zip(heads, decode_blocks([h[4] for h in heads], np.array([h[2] for h in heads]))):
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError("block does not decode to its ids")
        out.append((doc_ids, counts, ids))
    return out

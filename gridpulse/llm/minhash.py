"""SuperMinHash signatures of sets of 64-bit values, and what is made of them.

Each element ranks the registers in a random order of its own: the register it
puts at rank ``j`` is offered the value ``j`` + a random fraction. Since ranks
are a permutation, an element cannot offer small values to all registers or to
none, which lowers the variance of the estimate. A register keeps its least
offer; once a document's registers are all filled at rank ``j`` or before, no
later rank can lower one, and its elements stop early.
"""

from __future__ import annotations

import numpy as np

from gridpulse.llm.tokens import mix

_U64 = np.uint64
_LOW = _U64(0xFFFFFFFF)
_STEP = 0x9E3779B97F4A7C15
_EMPTY = _U64(0xFFFFFFFFFFFFFFFF)


def _draws(values: np.ndarray, rank: int, registers: int) -> tuple[np.ndarray, np.ndarray]:
    """For each element at a rank: a place among those left, and its offer."""
    with np.errstate(over="ignore"):
        x = mix(values + _U64((rank + 1) * _STEP % (1 << 64)))
    place = ((x & _LOW) * _U64(registers - rank)) >> _U64(32)
    return place.astype(np.int64) + rank, (x >> _U64(32)) | _U64(rank << 32)


def superminhash(values: np.ndarray, offsets: np.ndarray, registers: int) -> np.ndarray:
    """Signatures (sets x registers) of the sets ``values[offsets[i]:offsets[i+1]]``.

    An empty set's registers stay at the largest value.
    """
    sets = len(offsets) - 1
    found = np.full(sets * registers, _EMPTY)
    owner = np.repeat(np.arange(sets), np.diff(offsets))
    place, offer = _draws(values, 0, registers)
    np.minimum.at(found, owner * registers + place, offer)

    def unfilled() -> np.ndarray:
        return (found.reshape(sets, registers) == _EMPTY).any(1)

    going = unfilled()[owner]
    values, owner, place = values[going], owner[going], place[going]
    # Each element's order of the registers, as far as drawn (Fisher-Yates).
    order = np.tile(np.arange(registers, dtype=np.uint8), (len(values), 1)).ravel()
    row = np.arange(len(values)) * registers
    order[row + place] = 0
    rank = 1
    while len(values) and rank < registers:
        place, offer = _draws(values, rank, registers)
        chosen = order[row + place]
        order[row + place] = order[row + rank]
        np.minimum.at(found, owner * registers + chosen, offer)
        rank += 1
        going = unfilled()[owner]
        if going.mean() < 0.75:
            order = order.reshape(-1, registers)[going].ravel()
            values, owner = values[going], owner[going]
            row = np.arange(len(values)) * registers
    return found.reshape(sets, registers)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """A hash of each band of a signature (sets x bands), different by band."""
    sets, registers = signatures.shape
    mixed = mix(signatures).reshape(sets, bands, registers // bands)
    key = np.tile(mix(np.arange(1, bands + 1, dtype=_U64)), (sets, 1))
    with np.errstate(over="ignore"):
        for k in range(mixed.shape[2]):
            key = mix(key + mixed[:, :, k])
    return key


def short_signatures(signatures: np.ndarray) -> np.ndarray:
    """A byte of each register, enough to estimate similarity."""
    return (mix(signatures) & _U64(0xFF)).astype(np.uint8)


def set_digests(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set: equal for equal sets."""
    size = np.diff(offsets).astype(_U64)
    out = []
    for salt in (0xA24BAED4963EE407, 0x9FB21C651E98DF25):
        with np.errstate(over="ignore"):
            sums = np.zeros(len(values) + 1, _U64)
            np.cumsum(mix(values ^ _U64(salt)), out=sums[1:])
            out.append(mix(sums[offsets[1:]] - sums[offsets[:-1]] + size))
    return out[0], out[1]

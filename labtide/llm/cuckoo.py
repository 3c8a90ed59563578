"""Cuckoo filter over arrays of 64-bit keys: four fingerprints of 16 bits a bucket, with deletion."""

from __future__ import annotations

import numpy as np

from labtide.llm.words import mix

SLOTS = 4
LOAD = 0.8
ROUNDS = 500


class CuckooFilter:
    """Holds any of its keys for certain, and another key with a probability of about 1 in 8,000.

    Keys must be distinct 64-bit hashes. Removing a key that was never added can remove another one; callers decide from
    an exact table what to remove.
    """

    def __init__(self, table: np.ndarray, live: int = 0):
        self.table, self.live = table, live

    @classmethod
    def for_keys(cls, count: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(count, 1) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes, live: int) -> CuckooFilter:
        return cls(np.frombuffer(data, dtype="<u2").reshape(-1, SLOTS).copy(), live)

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def room(self) -> int:
        """Keys that still fit at the planned load."""
        return int(self.table.size * LOAD) - self.live

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        spread = mix(keys.astype(np.uint64))
        prints = np.maximum(spread >> np.uint64(48), np.uint64(1)).astype(np.uint16)
        first = (spread & np.uint64(len(self.table) - 1)).astype(np.int64)
        return prints, first, self._other(prints, first)

    def _other(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        return buckets ^ (mix(prints.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        held = (self.table[first] == prints[:, None]).any(axis=1)
        return held | (self.table[second] == prints[:, None]).any(axis=1)

    def _fill(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Put as many fingerprints as have a free slot in their bucket; flags of those that were put."""
        order = np.argsort(buckets, kind="stable")
        put = np.zeros(len(prints), dtype=bool)
        starts = np.flatnonzero(np.diff(buckets[order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
        for slot in range(SLOTS):
            turn = order[rank == slot]
            free = (self.table[buckets[turn]] == 0)
            fits = free.any(axis=1)
            turn, free = turn[fits], free[fits]
            self.table[buckets[turn], free.argmax(axis=1)] = prints[turn]
            put[turn] = True
        return put

    def add(self, keys: np.ndarray) -> bool:
        """Add keys; false if there was no place for some, and then the filter must be built anew and larger."""
        if len(keys) > self.room():
            return False
        prints, first, second = self._places(keys)
        left = ~self._fill(prints, first)
        prints, buckets = prints[left], second[left]
        draw = np.random.default_rng(len(keys))
        for _ in range(ROUNDS):
            left = ~self._fill(prints, buckets)
            prints, buckets = prints[left], buckets[left]
            if not len(prints):
                self.live += len(keys)
                return True
            _, turn = np.unique(buckets, return_index=True)
            slot = draw.integers(0, SLOTS, len(turn))
            thrown = self.table[buckets[turn], slot]
            self.table[buckets[turn], slot] = prints[turn]
            prints[turn] = thrown
            buckets[turn] = self._other(thrown, buckets[turn])
        return False

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that were added."""
        prints, first, second = self._places(keys)
        self.live -= len(keys)
        pending = np.arange(len(keys))
        for side in (first, second):
            done = np.zeros(len(keys), dtype=bool)
            again = pending
            while len(again):
                _, turn = np.unique(side[again], return_index=True)
                turn = again[turn]
                held = self.table[side[turn]] == prints[turn, None]
                found = held.any(axis=1)
                self.table[side[turn[found]], held[found].argmax(axis=1)] = 0
                done[turn[found]] = True
                again = np.setdiff1d(again, turn)
            pending = pending[~done[pending]]

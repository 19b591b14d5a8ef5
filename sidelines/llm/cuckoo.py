"""Cuckoo filters over pairs of hashes, in numpy, as layers of tables that never have to be built again to grow."""

from __future__ import annotations

import numpy as np

SLOTS, KICKS, LOAD = 4, 200, 0.8
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mark(k2: np.ndarray) -> np.ndarray:
    """16 bits of the second hash; 0 means an empty slot, so it becomes 1."""
    mark = (k2.view(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
    return np.where(mark == 0, np.uint16(1), mark)


def _step(mark: np.ndarray) -> np.ndarray:
    """What leads from one of a mark's two buckets to the other (before it is cut to the table's size)."""
    return (mark.astype(np.uint64) * _MIX) >> np.uint64(32) | np.uint64(1)


class CuckooFilter:
    """Holds 16-bit marks of keys (two 64-bit hashes each); inserting a key twice holds it twice."""

    def __init__(self, layers: list[np.ndarray] | None = None):
        self.layers = layers or []

    @classmethod
    def from_bytes(cls, layers: list[bytes]) -> CuckooFilter:
        return cls([np.frombuffer(b, "<u2").reshape(-1, SLOTS).copy() for b in layers])

    def to_bytes(self) -> list[bytes]:
        return [table.astype("<u2").tobytes() for table in self.layers]

    @staticmethod
    def _buckets(table: np.ndarray, k1: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        within = np.uint64(len(table) - 1)
        first = (k1.view(np.uint64) >> np.uint64(20)) & within
        return first.astype(np.int64), (first ^ (_step(mark) & within)).astype(np.int64)

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """False: certainly not held. True: most likely held."""
        mark, found = _mark(k2), np.zeros(len(k1), bool)
        for table in self.layers:
            for bucket in self._buckets(table, k1, mark):
                found |= (table[bucket] == mark[:, None]).any(axis=1)
        return found

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Into the last layer while it has room, and into a new one, large enough, for the rest."""
        if self.layers:
            table = self.layers[-1]
            room = max(0, int(LOAD * table.size) - int(np.count_nonzero(table)))
            left = self._fill(table, k1[:room], k2[:room])
            k1, k2 = np.concatenate([left[0], k1[room:]]), np.concatenate([left[1], k2[room:]])
        while len(k1):
            buckets = 1 << max(4, int(np.ceil(np.log2(len(k1) / (SLOTS * LOAD)))))
            if self.layers:  # never smaller than the layer before, so that there are few
                buckets = max(buckets, len(self.layers[-1]))
            self.layers.append(np.zeros((buckets, SLOTS), np.uint16))
            k1, k2 = self._fill(self.layers[-1], k1, k2)

    def _fill(self, table: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All keys that find a free slot in one of their buckets at once, the others by moving marks; returns the rest."""
        mark = _mark(k2)
        both = self._buckets(table, k1, mark)
        left = np.arange(len(k1))
        for bucket in both:
            order = np.argsort(bucket[left], kind="stable")
            at = bucket[left][order]
            begins = np.r_[True, at[1:] != at[:-1]] if len(at) else np.empty(0, bool)
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
            slot = np.count_nonzero(table[at], axis=1) + nth  # slots fill from the left
            fits = slot < SLOTS
            table[at[fits], slot[fits]] = mark[left[order[fits]]]
            left = left[order[~fits]]
        rest = [i for i in left.tolist() if not self._push(table, int(both[0][i]), mark[i])]
        return k1[rest], k2[rest]

    @staticmethod
    def _push(table: np.ndarray, bucket: int, mark: np.uint16) -> bool:
        """Put the mark in its bucket, and what it displaces in that one's other bucket, and so on; all or nothing."""
        within, path = len(table) - 1, []
        for kick in range(KICKS):
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = mark
                return True
            slot = kick % SLOTS
            path.append((bucket, slot, mark))
            mark, table[bucket, slot] = table[bucket, slot], mark
            bucket ^= int(_step(np.asarray(mark))) & within
        for bucket, slot, before in reversed(path):
            mark, table[bucket, slot] = table[bucket, slot], mark
        return False

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Take out one mark for each key; only keys that were inserted may be deleted."""
        mark = _mark(k2)
        left = np.arange(len(k1))
        for table in reversed(self.layers):
            both, missed = self._buckets(table, k1, mark), []
            for i in left.tolist():
                for bucket in (int(both[0][i]), int(both[1][i])):
                    held = np.flatnonzero(table[bucket] == mark[i])
                    if len(held):
                        last = np.count_nonzero(table[bucket]) - 1
                        table[bucket, held[0]], table[bucket, last] = table[bucket, last], 0
                        break
                else:
                    missed.append(i)
            left = np.array(missed, np.int64)
        if len(left):
            raise ValueError(f"{len(left)} keys are not in the filter")

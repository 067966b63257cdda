"""First fit over runs of equal sizes: the sequential core of the bin packing."""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# The code travels with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Ranges of item numbers and the bins their items take turns in.
SLOTS = "lo long, hi long, bins array<int>"
# Bins in the ranges that the fold holds before it hands them on.
SLOT_BATCH = 100_000


class Loads:
    """Bin loads under one capacity: first bin with room, and smallest bin, in log time."""

    def __init__(self, capacity: int, max_bins: int | None):
        self.capacity, self.max_bins = capacity, max_bins
        self.loads: list[int] = []
        self.width = 1
        self.rooms = [-1, -1]  # a tree of maxima over the free room, leaves last; -1 is none
        self.smallest: list[tuple[int, int]] = []  # a heap that may hold outdated loads

    def _room_changed(self, bin_no: int) -> None:
        rooms, at = self.rooms, self.width + bin_no
        rooms[at] = max(-1, self.capacity - self.loads[bin_no])
        while at > 1:
            at >>= 1
            left, right = rooms[2 * at], rooms[2 * at + 1]
            best = left if left >= right else right
            if rooms[at] == best:
                return
            rooms[at] = best

    def _rebuild(self) -> None:
        while self.width < len(self.loads):
            self.width *= 2
        leaves = [max(-1, self.capacity - load) for load in self.loads]
        self.rooms = [-1] * self.width + leaves + [-1] * (self.width - len(leaves))
        for at in range(self.width - 1, 0, -1):
            self.rooms[at] = max(self.rooms[2 * at], self.rooms[2 * at + 1])

    def _load_changed(self, bin_no: int) -> None:
        if self.max_bins is None:
            return  # a new bin can always be opened, so the smallest is never asked for
        heapq.heappush(self.smallest, (self.loads[bin_no], bin_no))
        if len(self.smallest) > 4 * len(self.loads) + 64:
            self.smallest = [(load, b) for b, load in enumerate(self.loads)]
            heapq.heapify(self.smallest)

    def add(self, bin_no: int, amount: int) -> None:
        self.loads[bin_no] += amount
        self._room_changed(bin_no)
        self._load_changed(bin_no)

    def may_open(self) -> int | None:
        """How many bins may still be opened; None: any number."""
        return None if self.max_bins is None else self.max_bins - len(self.loads)

    def open(self, loads: list[int]) -> int:
        """New bins of these loads; returns the first one's number."""
        first = len(self.loads)
        self.loads += loads
        if len(self.loads) > self.width or len(loads) > 64:
            self._rebuild()
        else:
            for bin_no in range(first, len(self.loads)):
                self._room_changed(bin_no)
        for bin_no in range(first, len(self.loads)):
            self._load_changed(bin_no)
        return first

    def first_fit(self, size: int) -> int | None:
        if self.rooms[1] < size:
            return None
        at = 1
        while at < self.width:
            at = 2 * at if self.rooms[2 * at] >= size else 2 * at + 1
        return at - self.width

    def least_loaded(self) -> int:
        while self.loads[self.smallest[0][1]] != self.smallest[0][0]:
            heapq.heappop(self.smallest)
        return self.smallest[0][1]

    def place(self, size: int, n: int) -> Iterator[tuple[int, list[int]]]:
        """Put ``n`` items of one size away; yields (items, bins they take turns in)."""
        while n:
            bin_no, more = self.first_fit(size), self.may_open()
            if bin_no is None and more != 0:
                # No bin has room: as many new ones as the items fill, one after the other.
                each = max(1, self.capacity // size) if size else n
                bins = -(-n // each) if more is None else min(more, -(-n // each))
                taken = min(n, bins * each)
                first = self.open([each * size] * (bins - 1) + [(taken - (bins - 1) * each) * size])
                if each == 1:
                    yield taken, list(range(first, first + bins))
                else:
                    for at in range(bins):
                        yield min(each, taken - at * each), [first + at]
                n -= taken
                continue
            if bin_no is None:
                # No bin has room and none will get any: the rest goes by smallest load.
                if size and n > len(self.loads):
                    yield from self._level(size, n)
                    return
                bin_no = self.least_loaded()
                taken = 1 if size else n
            else:
                taken = min(n, (self.capacity - self.loads[bin_no]) // size) if size else n
            self.add(bin_no, taken * size)
            yield taken, [bin_no]
            n -= taken

    def _level(self, size: int, n: int) -> Iterator[tuple[int, list[int]]]:
        """Many equal items, each to the smallest bin: bins join a round-robin by load."""
        loads = np.array(self.loads, np.int64)
        waiting = np.lexsort((np.arange(len(loads)), loads))
        turn, joined = waiting[:1], 1
        while n:
            steps = n
            if joined < len(waiting):
                joiner = waiting[joined]
                # Turns that come before the next waiting bin is the smallest.
                ahead = (loads[joiner] - loads[turn] - (turn > joiner)) // size + 1
                steps = min(n, int(np.maximum(ahead, 0).sum()))
            if steps:
                yield steps, turn[:steps].tolist()
                rounds, extra = divmod(steps, len(turn))
                loads[turn] += rounds * size
                loads[turn[:extra]] += size
                turn = np.roll(turn, -extra)
                n -= steps
            if joined < len(waiting) and n:
                turn = np.concatenate((waiting[joined : joined + 1], turn))
                joined += 1
        self.loads = loads.tolist()
        self._rebuild()
        self.smallest = [(load, b) for b, load in enumerate(self.loads)]
        heapq.heapify(self.smallest)


def fold_runs(nbins: int | None, capacity: int | None):
    """Batches of runs (_group, _size, _n, _start), in packing order, to slots."""

    def table(slots: list) -> pd.DataFrame:
        return pd.DataFrame(slots, columns=["lo", "hi", "bins"])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, loads = None, None
        for batch in batches:
            slots, held = [], 0
            for label, size, n, start in zip(
                batch["_group"].tolist(), batch["_size"].tolist(), batch["_n"].tolist(), batch["_start"].tolist()
            ):
                if size < 0:
                    raise ValueError(f"a size must not be negative: {size}")
                if loads is None or label != group:
                    # Without a capacity the first, largest, item sets it.
                    group, loads = label, Loads(size if capacity is None else capacity, nbins)
                for taken, bins in loads.place(size, n):
                    for at in range(0, len(bins), SLOT_BATCH) if taken == len(bins) else (0,):
                        part = bins[at : at + SLOT_BATCH] if taken == len(bins) else bins
                        items = len(part) if taken == len(bins) else taken
                        slots.append((start, start + items - 1, part))
                        start += items
                        held += len(part)
                        if held >= SLOT_BATCH:
                            yield table(slots)
                            slots, held = [], 0
            yield table(slots)

    return fold

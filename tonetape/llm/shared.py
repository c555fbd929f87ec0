"""Entries whose key occurs more than once, found in blocks of keys with one shuffle.

Tasks deal their entries into key blocks, packed into a few large rows.  A block holds
one entry of each key; when a second one comes, both are passed on, and all later ones
at once.  Memory follows the number of different keys in a block, however often one of
them occurs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tonetape.llm import words as W
from tonetape.llm.common import frugal

#: Entries in one block, about.
BLOCK = 1 << 19
KINDS = {"long": np.int64, "int": np.int32}


def packed_schema(fields: dict[str, str]) -> str:
    return ", ".join(["block long", *(f"{name} binary" for name in fields)])


def blocks_for(entries: int) -> int:
    return max(1, -(-entries // BLOCK))


def packed(entries: dict[str, np.ndarray], blocks: int) -> pa.RecordBatch:
    """entries, the key first, as one row for each block that has some."""
    names = list(entries)
    block = (W.mixed(entries[names[0]].view(W.U), 5) % W.U(blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(block[order], prepend=-1)), len(block))
    own = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    arrays = [pa.array([block[o[0]] for o in own], pa.int64())]
    arrays += [pa.array([entries[n][o].tobytes() for o in own], pa.binary()) for n in names]
    return pa.RecordBatch.from_arrays(arrays, names=["block", *names])


class Block:
    """The keys met so far, each with its first entry, and whether that is its only one."""

    def __init__(self, kinds: list[type], keys: int):
        self.held, self.alone, self.keys = [np.zeros(0, k) for k in kinds], np.zeros(0, bool), keys
        self.new: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, entries: list[np.ndarray]):
        self.new.append(entries)
        self.waiting += len(entries[0])
        return self.settle() if self.waiting >= max(1 << 18, len(self.alone)) else None

    def settle(self) -> list[np.ndarray] | None:
        """What waits of keys that are now known to be shared, and the entries held for them."""
        if not self.waiting:
            return None
        old = len(self.alone)
        both = [np.concatenate([h, *x]) for h, x in zip(self.held, zip(*self.new))]
        self.new, self.waiting = [], 0
        # The held entry of a key comes before its new ones.
        order = np.lexsort(both[self.keys - 1 :: -1] if self.keys > 1 else both[:1])
        both = [x[order] for x in both]
        held, alone = order < old, np.append(self.alone, np.zeros(len(order) - old, bool))[order]
        differ = np.zeros(max(len(order) - 1, 0), bool)
        for key in both[: self.keys]:
            differ |= key[1:] != key[:-1]
        start = np.flatnonzero(np.append(True, differ))
        count = np.diff(np.append(start, len(order)))
        shared = np.repeat(count > 1, count) | (held & ~alone)
        # New entries of shared keys, and a held one when its key is shared only now.
        give = shared & (~held | alone)
        out = [x[give] for x in both]
        self.held = [x[start] for x in both]
        self.alone = (count == 1) & (alone[start] | ~held[start])
        return out if give.any() else None


def shared_entries(rows: DataFrame, fields: dict[str, str], blocks: int, keys: int = 1) -> DataFrame:
    """The entries of packed rows, one row each, whose key (the first fields) several entries have."""
    names, kinds = list(fields), [KINDS[k] for k in fields.values()]

    def pick(batches):
        # Blocks come one after the other, so only one is held.
        held, own = None, None
        give = lambda got: pa.RecordBatch.from_arrays([pa.array(x) for x in got], names=names)
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                if block != own:
                    if held and (got := held.settle()):
                        yield give(got)
                    held, own = Block(kinds, keys), block
                    pa.default_memory_pool().release_unused()
                # Copies, so that no batch outlives its turn.
                got = held.add([np.frombuffer(batch.column(n)[i].as_buffer(), k).copy() for n, k in zip(names, kinds)])
                if got:
                    yield give(got)
        if held and (got := held.settle()):
            yield give(got)

    schema = ", ".join(f"{n} {k}" for n, k in fields.items())
    return rows.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(frugal(pick), schema)

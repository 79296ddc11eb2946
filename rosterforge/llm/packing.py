"""Problem 9: containers of fixed capacity filled with items of varying length.

Bounded-space online best fit: at most ``OPEN`` containers are open at a time,
found by a bitset keyed by free space, so the container that an item fits best
is one shift and one find-first-set away. If nothing fits and all are open, the
fullest closes first. Only an item larger than the capacity is split: into
pieces of full containers and a rest that is placed like any item.

Items are spread by a hash of their identifier over tasks of about
``TASK_TOKENS`` tokens each and taken in the order of their identifiers, so the
result is the same at every run and when a task is repeated; every task leaves
at most ``OPEN`` containers unfilled per capacity.

Defined results: an item of size NULL or 0 takes no room and goes to the
fullest open container; a capacity that is NULL or below 1 holds nothing and
gives no rows; repeated identifiers are items of their own; an empty table
gives no containers.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Containers open at a time, and tokens that one task packs.
OPEN, TASK_TOKENS = 64, 8_000_000


class BestFit:
    """Open containers of one capacity, in a bitset keyed by free space."""

    def __init__(self, capacity: int, first: int, most: int = OPEN) -> None:
        self.capacity, self.next, self.most = capacity, first, most
        self.free: dict[int, list[int]] = {}
        self.bits, self.n_open = 0, 0

    def _take(self, space: int) -> int:
        bins = self.free[space]
        number = bins.pop()
        if not bins:
            del self.free[space]
            self.bits ^= 1 << space
        self.n_open -= 1
        return number

    def _keep(self, number: int, space: int) -> None:
        if space > 0:
            self.free.setdefault(space, []).append(number)
            self.bits |= 1 << space
            self.n_open += 1

    def _new(self) -> int:
        number = self.next
        self.next += 1
        return number

    def place(self, size: int) -> Iterator[tuple[int, int, int]]:
        """``(container, piece, tokens)`` of each piece of an item."""
        piece = 0
        while size > self.capacity:
            yield self._new(), piece, self.capacity
            size -= self.capacity
            piece += 1
        fitting = self.bits >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.n_open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            number, space = self._new(), self.capacity
        self._keep(number, space - size)
        yield number, piece, size


def pack(sizes: DataFrame, capacities: list[tuple[int, int]], id_col: str = "id", size_col: str = "n_tokens") -> DataFrame:
    """``size_id, container_id, id, piece, n_tokens`` for every capacity ``(size_id, tokens)``."""
    sizes = checkpointed(
        sizes.select(F.col(id_col).alias("id"), F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("n_tokens"))
    )
    total = sizes.agg(F.sum("n_tokens")).first()[0] or 0
    tasks = max(1, -(-total // TASK_TOKENS))
    usable = [(int(i), int(c)) for i, c in capacities if c is not None and c >= 1]

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 40
        fits = [(i, BestFit(c, first)) for i, c in usable]
        for batch in batches:
            out = [
                (size_id, container, item, piece, n)
                for item, size in zip(batch["id"], batch["n_tokens"])
                for size_id, fit in fits
                for container, piece, n in fit.place(int(size))
            ]
            yield pd.DataFrame(out, columns=["size_id", "container_id", "id", "piece", "n_tokens"])

    ordered = sizes.repartition(int(tasks), "id").sortWithinPartitions("id", "n_tokens")
    kind = dict(sizes.dtypes)["id"]
    return ordered.mapInPandas(fill, f"size_id long, container_id long, id {kind}, piece int, n_tokens long")

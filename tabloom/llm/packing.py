"""Packing documents into sequences: dominance reduction, then best fit.

A piece is known to the packing by its length alone, so the instance is a table of at most
``window`` counts whatever the corpus. Martello and Toth's reduction runs on it: for a piece the
sets it could share a sequence with are compared, and where one set provably dominates all the
others (each of the others splits into parts that fit the places of its members) it is fixed, as
often as the counts allow. What remains is packed best-fit decreasing. The result is a short list
of runs, "ranks a to b of length n go to sequences from s at offset o", that every piece looks up
by its exact rank among the pieces of its length.

Defined results: a null text is empty and has the end mark alone. A document longer than the window is
cut into full pieces with the rest in the first one; nothing is dropped. Rows that repeat a
doc_id are documents of their own. An empty table gives no rows. Columns other than those named
are not needed, and pieces keep the columns they come with.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.durable import written
from tabloom.llm.bpe import load
from tabloom.llm.common import fresh, ship
from tabloom.ranking import numbered

_DOCUMENTS_AT_ONCE = 512


class Run(NamedTuple):
    """Ranks from ``rank`` of pieces of ``length``: ``per`` of them into each of ``n`` sequences."""

    length: int
    rank: int
    pieces: int
    per: int
    sequence: int
    offset: int


class _Instance:
    """Pieces left to pack, by length."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c}
        self.sizes = sorted(self.left)
        self.used = Counter()
        self.sequences = 0
        self.runs: list[Run] = []

    def take(self, size: int, pieces: int, per: int, sequence: int, offset: int) -> None:
        self.runs.append(Run(size, self.used[size], pieces, per, sequence, offset))
        self.used[size] += pieces
        self.left[size] -= pieces
        if not self.left[size]:
            del self.left[size]
            self.sizes.remove(size)

    def fix(self, members: tuple[int, ...]) -> None:
        """Put this set into sequences of its own, as often as there are pieces."""
        needs = Counter(members)
        times = min(self.left[size] // n for size, n in needs.items())
        offset = 0
        for size in members:
            self.take(size, times, 1, self.sequences, offset)
            offset += size
        self.sequences += times

    def others(self, without: tuple[int, ...], above: int = 0) -> Iterator[int]:
        """The pieces longer than ``above`` but for some, from the smallest, each as often as it is there."""
        for size in self.sizes[bisect_left(self.sizes, above + 1) :]:
            for _ in range(min(3, self.left[size] - without.count(size))):
                yield size

    def largest(self, room: int, without: tuple[int, ...]) -> int | None:
        """The longest piece that fits."""
        at = bisect_left(self.sizes, room + 1) - 1
        while at >= 0 and self.left[self.sizes[at]] <= without.count(self.sizes[at]):
            at -= 1
        return self.sizes[at] if at >= 0 else None

    def best_pair(self, room: int, without: tuple[int, ...]) -> int:
        """The most that two pieces fill of the room, 0 if no two fit."""
        best, top = 0, len(self.sizes) - 1
        for low, size in enumerate(self.sizes):
            if self.left[size] <= without.count(size):
                continue
            while top >= 0 and size + self.sizes[top] > room:
                top -= 1
            other = top
            while other > low and self.left[self.sizes[other]] <= without.count(self.sizes[other]):
                other -= 1
            if other < low:
                break
            if other > low or self.left[size] - without.count(size) >= 2:
                best = max(best, size + self.sizes[other])
        return best


def _dominant(rest: _Instance, size: int) -> tuple[int, ...] | None:
    """A set with a piece of this size that dominates all others it could be in, if one shows."""
    room = rest.capacity - size
    smallest = [s for s, _ in zip(rest.others((size,)), range(3))]
    if not smallest or smallest[0] > room:
        return (size,)
    top = rest.largest(room, (size,))
    # a perfect fit, or no room for two others: whatever else could come in fits into top's place
    if top == room or len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return (size, top)
    if len(smallest) == 3 and sum(smallest) <= room:
        return None
    # two others at most
    if top >= rest.best_pair(room, (size,)):
        return (size, top)
    second = rest.largest(room - top, (size, top))
    if second is None:
        return None
    # a set this one does not dominate would need two pieces that are both longer than the second
    longer = [s for s, _ in zip(rest.others((size, top, second), second), range(2))]
    if len(longer) < 2 or sum(longer) > room:
        return (size, top, second)
    return None


def reduce_by_dominance(rest: _Instance) -> None:
    changed = True
    while changed:
        changed = False
        for size in reversed(list(rest.sizes)):
            while size in rest.left and (members := _dominant(rest, size)):
                rest.fix(members)
                changed = True


def best_fit(rest: _Instance) -> None:
    """Longest first, each piece into the fullest sequence that has room for it, or else a new one."""
    open_: list[tuple[int, int, int]] = []  # (room, first sequence, sequences) by room
    for size in reversed(list(rest.sizes)):
        while size in rest.left:
            at = bisect_left(open_, (size, -1, -1))
            if at < len(open_):
                room, first, n = open_.pop(at)
            else:
                per = rest.capacity // size
                room, first, n = rest.capacity, rest.sequences, -(-rest.left[size] // per)
                rest.sequences += n
            per = room // size
            full = min(n, rest.left[size] // per)
            if full:
                rest.take(size, full * per, per, first, rest.capacity - room)
                if room - per * size:
                    insort(open_, (room - per * size, first, full))
            elif n:
                per, full = rest.left[size], 1
                rest.take(size, per, per, first, rest.capacity - room)
                insort(open_, (room - per * size, first, 1))
            if n > full:
                insort(open_, (room, first + full, n - full))


def plan(counts: dict[int, int], capacity: int) -> list[Run]:
    """Where the pieces of each length go, given how many there are."""
    rest = _Instance(counts, capacity)
    reduce_by_dominance(rest)
    best_fit(rest)
    return rest.runs


def _cut(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    bpe = load(path)
    names = ["row", "piece", "start", "length", "ids"]
    for batch in batches:
        for at in range(0, batch.num_rows, _DOCUMENTS_AT_ONCE):
            part = batch.slice(at, _DOCUMENTS_AT_ONCE)
            out: tuple[list, ...] = ([], [], [], [], [])
            for row, text in enumerate(part.column(1).to_pylist()):
                ids = np.append(bpe.encode(text or ""), np.uint32(end_id)).astype("<u4")
                first = len(ids) % window or window
                cuts = [0, *range(min(first, len(ids)), len(ids) + 1, window)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    for column, value in zip(out, (row, k, a, b - a, ids[a:b].tobytes()), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            columns[0] = part.column(0).take(columns[0])
            yield pa.RecordBatch.from_arrays(columns, names)


def token_pieces(
    documents: DataFrame, path: str, window: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, piece, start, length and ids (little-endian unsigned 32-bit) of every piece.

    ``path`` is a byte-level BPE tokenizer file, found at the same place on every machine.
    """
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    return (
        documents.select(key, text)
        .mapInArrow(
            lambda batches: _cut(batches, path, window, end_id),
            f"row {kind}, piece int, start bigint, length bigint, ids binary",
        )
        .withColumnRenamed("row", key)
    )


def pack(pieces: DataFrame, window: int = 1024, length: str = "length") -> DataFrame:
    """The pieces with sequence_id and offset, all columns as they were."""
    spark = pieces.sparkSession
    row, rank, lo, hi, run = fresh(pieces, "row", "rank", "lo", "hi", "run")
    stored = written(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    counts = {r[0]: r[1] for r in stored.groupBy(length).count().collect()}
    before, total = {}, 0
    for size in sorted(counts):
        before[size], total = total, total + counts[size]
    runs = [
        (r.length, before[r.length] + r.rank, before[r.length] + r.rank + r.pieces, (r.per, r.sequence, r.offset))
        for r in plan(counts, window)
    ]
    # the runs follow from the counts of at most ``window`` lengths
    table = spark.createDataFrame(
        runs, f"{length} bigint, {lo} bigint, {hi} bigint, {run} struct<per:bigint,sequence:bigint,offset:bigint>"
    )
    ranked = numbered(stored, [length, row], rank)
    nth = F.col(rank) - F.col(lo)
    return (
        ranked.join(F.broadcast(table), length)
        .where((F.col(rank) >= F.col(lo)) & (F.col(rank) < F.col(hi)))
        .select(
            *pieces.columns,
            (F.col(run)["sequence"] + F.floor(nth / F.col(run)["per"])).alias("sequence_id"),
            (F.col(run)["offset"] + (nth % F.col(run)["per"]) * F.col(length)).alias("offset"),
        )
    )

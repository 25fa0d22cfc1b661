"""Packing documents into sequences: shortest pack first over the histogram of lengths.

What fills a window by itself is a sequence of its own. The rests of the documents are known to
the packing by their length alone, so the instance is a histogram of at most ``window`` counts
whatever the corpus. Lengths are placed longest first, all documents of a length at once, each
into the shortest pack that is open and has room, or else into a new one. Packs of equal contents are one
packing pattern with a count, so a placement changes counts and not packs.

As documents may be cut, the packs that stay open are then filled up: the shortest of them are taken
apart, and their tokens run through the gaps of the others. Every sequence is full but for the last tokens
of the corpus, fewer than a window, which become sequences whose sizes are powers of two. So nothing
is padded, and a sequence has one cut or two.

The patterns are joined back by rank: the k-th document of a length is the k-th place that the
patterns have for that length. A placement uses up a length or a pattern, and a gap or a pattern
of those taken apart, so the list of places is bounded by the window (some thousand rows) and not by the corpus.

Defined results: a null text is empty and has the end mark alone. Rows that repeat a key are
documents of their own, a null key is kept as it is. An empty table gives no rows. Columns other than those
named play no part. Sequence numbers are unique, and not without gaps.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.durable import written
from tabloom.llm.bpe import load
from tabloom.llm.common import ship
from tabloom.ranking import numbered

_DOCUMENTS_AT_ONCE = 256
_ID_BYTES = 4


class Part(NamedTuple):
    """The documents of ``length`` from ``rank`` on."""

    length: int
    rank: int


class _Gaps(NamedTuple):
    """``count`` places of ``size`` tokens, one in each sequence from ``sequence`` on, from ``at`` in the stream."""

    at: int
    size: int
    count: int
    sequence: int
    offset: int

    @property
    def end(self) -> int:
        return self.at + self.size * self.count


class Place(NamedTuple):
    """``count`` documents of ``length`` from ``rank`` on, the first of them at ``at`` in a stream of tokens.

    From ``gap_at`` to ``gap_end`` the stream is dealt, ``gap`` tokens each, to the sequences from
    ``sequence`` on, where they go to ``offset``.
    """

    length: int
    rank: int
    count: int
    at: int
    gap_at: int
    gap: int
    sequence: int
    offset: int
    gap_end: int | None = None


class Pattern(NamedTuple):
    """``count`` packs with the same parts; the k-th pack holds the k-th document of every part."""

    count: int
    parts: tuple[Part, ...]

    @property
    def fill(self) -> int:
        return sum(p.length for p in self.parts)

    def split(self, count: int) -> tuple[Pattern, Pattern | None]:
        """The first ``count`` packs, and the others if there are any."""
        if count == self.count:
            return self, None
        rest = tuple(p._replace(rank=p.rank + count) for p in self.parts)
        return Pattern(count, self.parts), Pattern(self.count - count, rest)

    def with_part(self, part: Part) -> Pattern:
        return Pattern(self.count, (*self.parts, part))


class _Shelf:
    """Items by a whole number, found by the nearest one."""

    def __init__(self):
        self.keys: list[int] = []
        self.items: dict[int, list] = {}

    def put(self, key: int, item) -> None:
        if key not in self.items:
            insort(self.keys, key)
            self.items[key] = []
        self.items[key].append(item)

    def take(self, key: int):
        item = self.items[key].pop()
        if not self.items[key]:
            del self.items[key], self.keys[bisect_left(self.keys, key)]
        return item

    def largest(self) -> int:
        return self.keys[-1] if self.keys else 0


def shortest_pack_first(counts: dict[int, int], window: int) -> list[Pattern]:
    """Patterns that hold all documents whole, given how many there are of each length."""
    open_, full = _Shelf(), []

    def put(pattern: Pattern, room: int) -> None:
        if room:
            open_.put(room, pattern)
        else:
            full.append(pattern)

    for length in sorted(counts, reverse=True):
        rank = 0
        while rank < counts[length]:
            left, room = counts[length] - rank, open_.largest()
            if room < length:  # a new pack has the most room until it is full
                each = min(left, window // length)
                count = left // each
                parts = tuple(Part(length, rank + k * count) for k in range(each))
                put(Pattern(count, parts), window - each * length)
                rank += count * each
                continue
            pattern = open_.take(room)
            taken, others = pattern.split(min(left, pattern.count))
            if others:
                open_.put(room, others)
            put(taken.with_part(Part(length, rank)), room - length)
            rank += taken.count
    return full + [pattern for room in open_.keys for pattern in open_.items[room]]


def plan(counts: dict[int, int], window: int) -> tuple[list[Place], int]:
    """Where the documents of each length go, and the number of sequences.

    The longer packs stay as they are, as many as there are full sequences to make. The documents of the
    shorter ones, one behind the other, are a stream of tokens that runs through the gaps of the packs that stay,
    and at last into sequences of as many tokens as there are powers of two in the number of those left.
    """
    patterns = sorted(shortest_pack_first(counts, window), key=lambda p: p.fill, reverse=True)
    kept, rest = divmod(sum(p.count * p.fill for p in patterns), window)
    found: list[Place] = []
    loose: list[tuple[int, Part]] = []
    gaps: list[_Gaps] = []
    sequences = end = 0
    for pattern in patterns:
        stays, goes = min(kept, pattern.count), None
        kept -= stays
        if stays:
            pattern, goes = pattern.split(stays)
            offset = 0
            for part in pattern.parts:
                found.append(Place(part.length, part.rank, stays, 0, 0, part.length, sequences, offset))
                offset += part.length
            if offset < window:
                gaps.append(_Gaps(end, window - offset, stays, sequences, offset))
                end += (window - offset) * stays
            sequences += stays
        else:
            goes = pattern
        loose += [(goes.count, part) for part in goes.parts] if goes else []
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            gaps.append(_Gaps(end, 1 << bit, 1, sequences, 0))
            end += 1 << bit
            sequences += 1
    return found + _streamed(loose, gaps), sequences


def _streamed(loose: list[tuple[int, Part]], gaps: list[_Gaps]) -> list[Place]:
    """The places of documents laid one behind the other along the gaps, both in the order given."""
    found, at, k = [], 0, 0
    for count, part in loose:
        length, end = part.length, at + count * part.length
        while True:
            gap = gaps[k]
            first = max(0, gap.at - at) // length
            last = -(-(min(end, gap.end) - at) // length)
            rank, begin = part.rank + first, at + first * length
            found.append(
                Place(length, rank, last - first, begin, gap.at, gap.size, gap.sequence, gap.offset, gap.end)
            )
            if gap.end > end or k + 1 == len(gaps):
                break
            k += 1
            if gap.end == end:
                break
        at = end
    return found


def _cut(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Windows of a document's ids from its start, the rest of them last."""
    bpe = load(path)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for at in range(0, batch.num_rows, _DOCUMENTS_AT_ONCE):
            part = batch.slice(at, _DOCUMENTS_AT_ONCE)
            origin: list[int] = []
            out: tuple[list, ...] = ([], [], [], [])
            for row, text in enumerate(part.column(1).to_pylist()):
                ids = np.append(bpe.encode(text or ""), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    origin.append(row)
                    for column, value in zip(out, (len(ids), start, len(piece), piece.tobytes()), strict=True):
                        column.append(value)
            columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            keys = part.column(0).take(pa.array(origin, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, *columns], ["key", "doc_tokens", "start", "length", "ids"])


def pack_documents(
    documents: DataFrame,
    path: str,
    window: int = 1024,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    shape: Callable[[Column], Column] = lambda ids: ids,
) -> DataFrame:
    """``key``, start, length, ids, doc_tokens, sequence_id and offset of every piece of every document.

    ``path`` is a byte-level BPE tokenizer file, found at the same place on every machine. ``ids`` are
    little-endian unsigned 32-bit numbers, or what ``shape`` makes of them.
    """
    spark = documents.sparkSession
    ship(spark)
    kind = documents.schema[key].dataType.simpleString()
    whole = F.col("length") == window
    pieces = documents.select(F.col(key).alias("key"), text).mapInArrow(
        lambda batches: _cut(batches, path, window, end_id),
        f"key {kind}, doc_tokens bigint, start bigint, length bigint, ids binary",
    )
    # the ids of a full window are needed no more, those of a rest until it is known where it is cut
    stored = written(
        pieces.select(
            "key",
            "doc_tokens",
            "start",
            "length",
            F.when(whole, shape(F.col("ids"))).alias("shaped"),
            F.when(~whole, F.col("ids")).alias("ids"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "token-pieces",
    )
    rests = stored.where(~whole)
    counts = {r["length"]: r["count"] for r in rests.groupBy("length").count().collect()}  # window - 1 at most
    places, sequences = plan(counts, window)
    before, total = {}, 0
    for size in sorted(counts):
        before[size], total = total, total + counts[size]
    table = spark.createDataFrame(
        [(p.length, before[p.length] + p.rank, *p[2:8], p.gap_end or p.gap * p.count) for p in places],
        ", ".join(f"{c} bigint" for c in "length lo n at gap_at gap sequence offset gap_end".split()),
    )
    ranked = numbered(rests.drop("shaped"), ["length", "row"], "rank")
    placed = ranked.join(F.broadcast(table), "length").where("rank >= lo and rank < lo + n")
    # the part of the document that lies in these gaps, and each gap it meets
    met = placed.withColumn("begin", F.expr("at + (rank - lo) * length")).withColumns(
        {"head": F.greatest("begin", "gap_at"), "tail": F.least(F.col("begin") + F.col("length"), "gap_end")}
    )
    each = met.withColumn(
        "nth", F.explode(F.sequence(F.expr("(head - gap_at) div gap"), F.expr("(tail - 1 - gap_at) div gap")))
    ).withColumn("place", F.expr("gap_at + nth * gap"))
    each = each.withColumns(
        {"head": F.greatest("head", "place"), "tail": F.least("tail", F.col("place") + F.col("gap"))}
    )
    cut, size = F.col("head") - F.col("begin"), F.col("tail") - F.col("head")
    own = F.substring("ids", (cut * _ID_BYTES + 1).cast("int"), (size * _ID_BYTES).cast("int"))
    parts = each.select(
        F.col("key").alias(key),
        (F.col("start") + cut).alias("start"),
        size.alias("length"),
        shape(own).alias("ids"),
        "doc_tokens",
        (F.col("sequence") + F.col("nth")).alias("sequence_id"),
        (F.col("offset") + F.col("head") - F.col("place")).alias("offset"),
    )
    windows = stored.where(whole).select(
        F.col("key").alias(key),
        "start",
        "length",
        F.col("shaped").alias("ids"),
        "doc_tokens",
        (F.lit(sequences).cast("bigint") + F.col("row")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    return windows.unionByName(parts)

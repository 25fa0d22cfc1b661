"""Near duplicates by SimHash, compared exactly in tiles.

A fingerprint has 64 bits: a bit is set if over half the hashes of the text's word shingles
(repeats included) have it. Two fingerprints are linked if they differ in ``radius`` bits or
fewer; the groups are what links connect.

Every two fingerprints within the radius are found. They are laid out in tiles by the population
counts of their bytes: a differing bit changes the count of one byte by at most one, so the
counts of linked fingerprints differ by no more than the radius in all, and tiles further apart
are skipped. The other tile pairs are compared bit by bit with numpy (exclusive or, then a
bit count). A fingerprint meets the tiles on one side of its own only, so each pair of tiles is
compared once, in one shuffle. Equal fingerprints are one to begin with; a tile of more than
``tile_rows`` is cut into parts, each pair of parts being a block of its own, and of a block come
the edges of its spanning forest, never all its pairs.

Defined results: a null text is empty. A text with fewer words than a shingle is one shingle
of what it has, a text without words has the fingerprint 0 and links like any other. Rows
without a doc_id have their fingerprint and group; component_id is the smallest doc_id there
is in the group, and null where there is none. Rows that repeat a doc_id each count. An empty
table gives no rows. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.durable import written
from tabloom.llm.common import ascii_lower, fresh, let, ship, text_of, words_of
from tabloom.llm.components import components

_BYTES = 8
#: Bits per count in a tile's number: counts of 0 to 8 and two steps to either side.
_COUNT_BITS = 4
_LANE = 1024
_SLICE = 1 << 16


def shingle_hashes(text: Column | str, shingle: int = 3) -> Column:
    """XXH64 (seed 42) of every run of ``shingle`` words, repeats included."""
    return let(
        words_of(ascii_lower(text_of(text))),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
        .when(F.size(w) < shingle, F.array(F.xxhash64(F.array_join(w, " "))))
        .otherwise(
            F.transform(
                F.sequence(F.lit(1), F.size(w) - (shingle - 1)),
                lambda i: F.xxhash64(F.concat_ws(" ", *(F.element_at(w, i + k) for k in range(shingle)))),
            )
        ),
    )


def majority(hashes: np.ndarray) -> np.uint64:
    """The bits set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = np.ascontiguousarray(hashes[at : at + _SLICE]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0]


def _majorities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, ends = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
        found = np.array([majority(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64), pa.int64())], ["id", "f"])


def fingerprints(documents: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint) of every row: ``key``, and the 64 bits as a bigint."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    hashed = documents.select(F.col(key).alias("id"), shingle_hashes(text, shingle).alias("hashes"))
    return hashed.mapInArrow(_majorities, f"id {kind}, fingerprint bigint")


def _steps(radius: int) -> list[int]:
    """What to add to a tile's number for its neighbours on one side: one of each two opposite ones."""
    found = set()
    for n in range(1, radius + 1):
        for places in combinations(range(_BYTES), min(n, _BYTES)):
            for change in product(range(-radius, radius + 1), repeat=len(places)):
                if 0 < sum(map(abs, change)) <= radius:
                    found.add(sum(c << (_COUNT_BITS * p) for c, p in zip(change, places, strict=True)))
    return sorted(x for x in found if x > 0)


def _tile(fingerprint: Column, radius: int) -> Column:
    """The population counts of the bytes as one number."""
    total = F.lit(0).cast("bigint")
    for byte in range(_BYTES):
        count = F.bit_count(F.shiftrightunsigned(fingerprint, 8 * byte).bitwiseAND(F.lit(0xFF))) + F.lit(radius)
        total = total + F.shiftleft(count.cast("bigint"), _COUNT_BITS * byte)
    return total


def _stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least node of its component under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


def _linked(homes: np.ndarray, others: np.ndarray | None, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what is linked between the homes and the others, or among the homes."""
    for at in range(0, len(homes if others is None else others), _LANE):
        lane = (homes if others is None else others)[at : at + _LANE]
        near = np.bitwise_count(homes[:, None] ^ lane[None, :]) <= radius
        a, b = np.nonzero(near)
        if others is None:
            keep = a < b + at
            a, b, nodes = a[keep], b[keep] + at, homes
        else:
            b, nodes = b + len(homes), np.concatenate([homes, lane])
        if len(a):
            root = _stars(a, b, len(nodes))
            leaf = np.nonzero(root != np.arange(len(nodes)))[0]
            yield nodes[leaf], nodes[root[leaf]]


def _compare_blocks(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, homes before visitors; only the homes of one block are held."""
    block, homes = None, np.empty(0, np.uint64)
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(3)], axis=1)
        visitor = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
        fp = batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fp)]])
        # a block that begins with a visitor has no homes, unless it goes on from the last batch
        used = ~visitor[starts]
        used[0] = True
        found = []
        for s, e in zip(starts[used], ends[used], strict=True):
            key = tuple(keys[s])
            if key != block:
                block, homes = key, np.empty(0, np.uint64)
            split = s + int(np.count_nonzero(~visitor[s:e]))
            own, guests = fp[s:split], fp[split:e]
            if key[1] == key[2] and len(own):
                if len(homes):
                    found += _linked(homes, own, radius)
                if len(own) > 1:
                    found += _linked(own, None, radius)
            homes = np.concatenate([homes, own]) if len(homes) else own
            if len(homes) and len(guests):
                found += _linked(homes, guests, radius)
        if found:
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def links(nodes: DataFrame, radius: int = 2, tile_rows: int = 4096) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints of ``nodes`` as all links would."""
    if radius > 2:
        raise ValueError("tiles number population counts with two steps to spare")
    ship(nodes.sparkSession)
    tiled = nodes.select("fingerprint", _tile(F.col("fingerprint"), radius).alias("tile"))
    crowded = written(
        tiled.groupBy("tile")
        .count()
        .where(F.col("count") > tile_rows)
        .select("tile", F.ceil(F.col("count") / tile_rows).cast("int").alias("parts")),
        "crowded-tiles",
    )
    steps = F.array(*(F.lit(s).cast("bigint") for s in [0, *_steps(radius)]))
    rows = tiled.select("fingerprint", "tile", F.explode(steps).alias("step")).select(
        "fingerprint", (F.col("tile") + F.col("step")).alias("tile"), (F.col("step") != 0).alias("visitor")
    )
    # a tile's parts: homes are split among them, and met by visitors and by the homes of other parts
    rows = rows.join(crowded, "tile", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    block = lambda i, j, guest: F.struct(i.alias("i"), j.alias("j"), guest.alias("guest"))
    met = F.when(F.col("visitor"), F.transform(every, lambda p: block(p, p, F.lit(True)))).otherwise(
        F.transform(every, lambda p: block(F.least(own, p), F.greatest(own, p), own > p))
    )
    dealt = rows.select("tile", F.explode(met).alias("met"), "fingerprint").select("tile", "met.*", "fingerprint")
    ordered = dealt.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j", "guest")
    return ordered.mapInArrow(lambda batches: _compare_blocks(batches, radius), "a bigint, b bigint")


def near_duplicates(
    documents: DataFrame, radius: int = 2, shingle: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, fingerprint and component_id (the smallest ``key`` of the group) of every row."""
    prints = written(fingerprints(documents, shingle, key, text), "fingerprints")
    nodes = written(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "nodes")
    roots = components(links(nodes, radius)).select(F.col("node").alias("fingerprint"), "root")
    grouped = written(
        nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")), "grouped"
    )
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    verdicts = written(grouped.join(named, "root").select("fingerprint", "component_id"), "groups")
    return prints.join(verdicts, "fingerprint").select(F.col("id").alias(key), "fingerprint", "component_id")


def one_per_group(
    documents: DataFrame, radius: int = 2, shingle: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The document of each group with the smallest ``key``, all columns as they were.

    One row stays of each group: of rows that share the smallest ``key`` the first one as they are stored, and a row
    without a key only where none of the group has one. Rows are numbered once, in a stored copy, and joined by
    their number with those that go.
    """
    row, name = fresh(documents, "row", "name")
    numbered = written(documents.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    order = F.struct(F.col(key).isNull().alias("unnamed"), F.col(key).alias("key"), F.col(row).alias("row"))
    found = near_duplicates(numbered.select(order.alias(name), text), radius, shingle, name, text)
    gone = found.where(F.col(name) != F.col("component_id")).select(F.col(name)["row"].alias(row))
    return numbered.join(written(gone, "gone"), row, "left_anti").select(*documents.columns)

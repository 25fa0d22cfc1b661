"""Ranked lexical search: MaxScore with the joint bounds of term pairs.

The index is a table of blocks, each with whole documents and postings of its own: every term of
its texts with the documents that hold it and how often. For a log of queries the blocks get
impacts, what a term adds to a document's score, and term pairs: the list of the documents that hold both
terms, with the highest sum of their two impacts. The pairs of a log are the neighbours in each query's
order of weights, as a bound is loosest where two heavy terms never meet.

A query runs over a block with the best scores known so far. From its lightest term on, the bound of the first
terms combines their own maxima with the joint maxima of neighbours (or either's own, where that is more),
as pairs and single terms that give the least sum. The lightest terms that together cannot reach the threshold are
not searched: a document that has no others is skipped. The heavier ones are added up for all
documents at once, and what cannot reach the threshold any more with all that is left is dropped before
the next term or pair is looked up. Only a bound below the threshold skips, so that equal scores are seen.

A first share of the blocks, by hash, is searched to have thresholds for the others: what is
sent to be ranked is then a few documents for each query, whatever the corpus. There is no shuffle by term or document,
and each block is a task's own work; the driver sees the terms of a slice of queries and a threshold for each.

Defined results: terms are runs of letters and digits of ASCII and of all other characters, A-Z lower-cased. A null text
has none. Rows that repeat a key are documents of their own, a null key comes after all others at an
equal score. Items that repeat are ranked each by itself; an item without a term that occurs has
no rows. An empty table gives no rows. Columns other than those named play no part.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.durable import written
from tabloom.llm.common import ship
from tabloom.ranking import numbered

_ORDINALS = 1 << 16
_SHARE = 16
_QUERIES_AT_ONCE = 2_000

#: What a score is made of; fixed values.
_SCALE = 1_000_000_000
_FREQUENCY, _LENGTH = 1000, 12
_SLOPE = 25


def _table() -> bytes:
    """Letters and digits as they are, A-Z in lower case, every other ASCII character as a blank."""
    kept = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
    return bytes(b if b in kept else 0x20 for b in bytes(range(0x100)).lower())


_TERMS = _table()


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included. (Other characters than ASCII have no ASCII byte.)"""
    return (text or "").encode().translate(_TERMS).split()


class _Builder:
    """The documents of a block until there are enough of them."""

    def __init__(self):
        self.ids: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.keys: list[pa.Array] = []
        self.lengths: list[int] = []
        self.terms: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str | None) -> None:
        words = terms_of(text)
        held = Counter(words)
        self.lengths.append(len(words))
        self.terms.append(np.fromiter(map(self.ids.__getitem__, held), np.int32, len(held)))
        self.times.append(np.fromiter(held.values(), np.uint32, len(held)))
        self.size += len(text or "")

    def row(self, schema: pa.Schema) -> pa.RecordBatch:
        keys = pa.concat_arrays(self.keys)
        # documents are numbered in the order of their keys, which is the order of equal scores
        order = np.asarray(pc.sort_indices(keys, null_placement="at_end"))
        terms, times = np.concatenate([self.terms[k] for k in order]), np.concatenate([self.times[k] for k in order])
        ordinals = np.repeat(np.arange(len(order)), [len(self.terms[k]) for k in order])
        by_term = np.argsort(terms, kind="stable")
        lengths = np.array(self.lengths, np.int64)[order]
        lists = (
            keys.take(pa.array(order)),
            pa.array(lengths),
            pa.array(list(self.ids), pa.binary()),
            pa.array(np.bincount(terms, minlength=len(self.ids)), pa.int32()),
        )
        columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
        columns += [
            pa.array([ordinals[by_term].astype("<u2").tobytes()], pa.binary()),
            pa.array([times[by_term].astype("<u4").tobytes()], pa.binary()),
            pa.array([int(np.count_nonzero(lengths))], pa.int64()),
            pa.array([int(lengths.sum())], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _index(batches: Iterator[pa.RecordBatch], documents: int, chars: int) -> Iterator[pa.RecordBatch]:
    builder, schema = _Builder(), None
    for batch in batches:
        schema = schema or pa.schema(
            {
                "keys": pa.list_(batch.schema.field(0).type),
                "lengths": pa.list_(pa.int64()),
                "terms": pa.list_(pa.binary()),
                "counts": pa.list_(pa.int32()),
                "ordinals": pa.binary(),
                "times": pa.binary(),
                "documents": pa.int64(),
                "total": pa.int64(),
            }
        )
        start = 0
        for at, text in enumerate(batch.column(1).to_pylist(), 1):
            builder.add(text)
            if len(builder.lengths) >= documents or builder.size >= chars or at == batch.num_rows:
                builder.keys.append(batch.column(0).slice(start, at - start))
                start = at
            if len(builder.lengths) >= documents or builder.size >= chars:
                yield builder.row(schema)
                builder = _Builder()
    if builder.lengths:
        yield builder.row(schema)


class Index(NamedTuple):
    """Blocks of documents with their postings, how many documents have a term, and all terms with repeats."""

    blocks: DataFrame
    documents: int
    total: int


def build_index(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    block_documents: int = 4096,
    block_chars: int = 8 << 20,
) -> Index:
    """Index every document, in blocks that end with the document that reaches a limit."""
    if not 0 < block_documents < _ORDINALS:
        raise ValueError(f"a block has 1 to {_ORDINALS - 1} documents")
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    schema = (
        f"keys array<{kind}>, lengths array<bigint>, terms array<binary>, counts array<int>,"
        " ordinals binary, times binary, documents bigint, total bigint"
    )
    rows = documents.select(key, text).mapInArrow(lambda b: _index(b, block_documents, block_chars), schema)
    blocks = written(rows.withColumn("block", F.monotonically_increasing_id()), "lexical-blocks")
    documents, total = blocks.agg(F.sum("documents"), F.sum("total")).first()
    return Index(blocks, documents or 0, total or 0)


class Log(NamedTuple):
    """The terms of a slice of queries that occur, their weights, the pairs to store, and the queries themselves."""

    terms: list[bytes]
    weights: np.ndarray
    pairs: list[tuple[int, int]]
    #: of each query its number, its terms (by their place above, heaviest first) and how often it has each
    queries: list[tuple[int, np.ndarray, np.ndarray]]
    documents: int
    total: int


def _frequencies(batches: Iterator[pa.RecordBatch], terms: list[bytes]) -> Iterator[pa.RecordBatch]:
    wanted = pa.array(terms, pa.binary())
    for batch in batches:
        for row in range(batch.num_rows):
            place = pc.index_in(wanted, value_set=batch.column("terms")[row].values)
            there = place.is_valid()
            found = np.asarray(batch.column("counts")[row].values)[np.asarray(place.drop_null())]
            numbers = pa.array(np.flatnonzero(there.to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([numbers, pa.array(found, pa.int64())], ["term", "n"])


def read_log(index: Index, texts: list[tuple[int, str | None]]) -> Log:
    """Weigh the terms of some queries (number, text) by how many documents of the index hold them."""
    held = {number: Counter(terms_of(text)) for number, text in texts}
    terms = sorted(set().union(*held.values()))
    counted = index.blocks.select("terms", "counts").mapInArrow(
        lambda b: _frequencies(b, terms), "term bigint, n bigint"
    )
    found = {r[0]: r[1] for r in counted.groupBy("term").agg(F.sum("n")).collect()}  # the log's terms at most
    known = {terms[k]: n for k, n in sorted(found.items())}
    place = {term: k for k, term in enumerate(known)}
    top = 2 * index.documents + 2
    weights = np.array([math.floor(1000 * math.log(top / (2 * n + 1))) for n in known.values()], np.int64)
    queries, pairs = [], set()
    for number, own in held.items():
        chosen = sorted((place[t] for t in own if t in place), key=lambda k: (-weights[k], k))
        times = {place[t]: n for t, n in own.items() if t in place}
        pairs.update((min(x), max(x)) for x in zip(chosen, chosen[1:]))
        if chosen:
            queries.append((number, np.array(chosen), np.array([times[k] for k in chosen], np.int64)))
    return Log(list(known), weights, sorted(pairs), queries, index.documents, index.total)


def _damping(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a document's length takes from its impacts."""
    if int(lengths.max(initial=0)) * _SLOPE * documents < 1 << 62:
        share = lengths * (_SLOPE * documents) // total
    else:
        share = np.array([n * _SLOPE * documents // total for n in lengths.tolist()], np.int64)
    return 100 - _SLOPE + share


def _impacts(batches: Iterator[pa.RecordBatch], log: Log) -> Iterator[pa.RecordBatch]:
    """Blocks with the impacts of the log's terms and the lists of its pairs."""
    wanted = pa.array(log.terms, pa.binary())
    for batch in batches:
        for row in range(batch.num_rows):
            value = lambda name: batch.column(name)[row]  # noqa: E731, B023
            place = pc.index_in(wanted, value_set=value("terms").values)
            terms = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
            if not len(terms):
                continue
            counts = np.asarray(value("counts").values).astype(np.int64)
            starts = np.cumsum(counts) - counts
            place = np.asarray(place.drop_null())
            sizes = counts[place]
            at = np.repeat(starts[place] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            ordinals = np.frombuffer(value("ordinals").as_py(), "<u2")[at]
            times = np.frombuffer(value("times").as_py(), "<u4")[at].astype(np.int64)
            lengths = np.asarray(value("lengths").values)
            damping = _damping(lengths, log.documents, log.total)[ordinals]
            impacts = np.repeat(log.weights[terms], sizes) * (_SCALE * times // (_FREQUENCY * times + _LENGTH * damping))
            ends = np.cumsum(sizes)
            best = np.maximum.reduceat(impacts, ends - sizes)
            held = dict(zip(terms.tolist(), zip((ends - sizes).tolist(), ends.tolist(), strict=True), strict=True))
            joined = list(_joined(log.pairs, held, ordinals, impacts, len(lengths)))
            numbers = [pa.array([x[k] for x in joined], pa.int64()) for k in range(2)]
            lists = [pa.array(terms), pa.array(sizes), pa.array(best), *numbers]
            lists.append(pa.array([len(x[2]) for x in joined], pa.int64()))
            flat = lambda k, kind: np.concatenate([x[k] for x in joined] or [[]]).astype(kind).tobytes()  # noqa: E731, B023
            columns = [
                batch.column("block").slice(row, 1),
                batch.column("keys").slice(row, 1),
                *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists),
                *(pa.array([b], pa.binary()) for b in (ordinals.tobytes(), impacts.astype("<i8").tobytes())),
                *(pa.array([b], pa.binary()) for b in (flat(2, "<u2"), flat(3, "<i8"))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "keys", *_LISTS, *_BITS])


_LISTS = ("terms", "sizes", "best", "pairs", "pair_best", "pair_sizes")
_BITS = ("ordinals", "impacts", "pair_ordinals", "pair_impacts")


def _joined(
    pairs: list[tuple[int, int]], held: dict[int, tuple[int, int]], ordinals: np.ndarray, impacts: np.ndarray, n: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(number of the pair, joint maximum, documents, joint impacts) of the pairs that meet in a document."""
    one, own = -1, np.zeros(n, np.int64)
    for number, (first, second) in enumerate(pairs):
        if first not in held or second not in held:
            continue
        if first != one:
            one = first
            own[:] = 0
            s, e = held[first]
            own[ordinals[s:e]] = impacts[s:e]
        s, e = held[second]
        other = own[ordinals[s:e]]
        both = np.flatnonzero(other)
        if len(both):
            joint = other[both] + impacts[s:e][both]
            yield number, int(joint.max()), ordinals[s:e][both], joint


class Postings(NamedTuple):
    """A list of documents in order, what they get, and the most that one gets."""

    ordinals: np.ndarray
    impacts: np.ndarray
    best: int

    def at(self, documents: np.ndarray) -> np.ndarray:
        """What the given documents get, 0 for those not in the list."""
        place = np.minimum(np.searchsorted(self.ordinals, documents), len(self.ordinals) - 1)
        return np.where(self.ordinals[place] == documents, self.impacts[place], 0)


class Block:
    """A block's lists for the terms and pairs of a log."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        value = lambda name: batch.column(name)[row]
        numbers = lambda name: np.asarray(value(name).values)
        self.keys = value("keys").values
        self.terms = self._lists(
            numbers("terms"), numbers("sizes"), numbers("best"), value("ordinals"), value("impacts")
        )
        self.pairs = self._lists(
            numbers("pairs"), numbers("pair_sizes"), numbers("pair_best"), value("pair_ordinals"), value("pair_impacts")
        )

    @staticmethod
    def _lists(names, sizes, best, ordinals, impacts) -> dict[int, Postings]:
        ordinals, impacts = np.frombuffer(ordinals.as_py(), "<u2"), np.frombuffer(impacts.as_py(), "<i8")
        ends = np.cumsum(sizes).tolist()
        return {
            k: Postings(ordinals[e - n : e], impacts[e - n : e], b)
            for k, n, e, b in zip(names.tolist(), sizes.tolist(), ends, best.tolist(), strict=True)
        }


class Chain(NamedTuple):
    """A query's terms that a block has, lightest first.

    ``reach[i]`` is the most that the first ``i`` of them can add to a document. The ``i``-th is taken together with the one
    before it for that if ``paired[i]``; ``joint[i]`` has the documents that hold both, if there are any.
    """

    parts: list[tuple[Postings, int]]
    reach: list[int]
    paired: list[bool]
    joint: list[Postings | None]


def chain_of(
    block: Block, numbers: dict[tuple[int, int], int], terms: np.ndarray, times: np.ndarray, with_pairs: bool = True
) -> Chain:
    """Combine the bounds: the first ``i`` terms reach what all but the last do and the last alone, or all but
    the last two and those as a pair, whichever is less."""
    chain = Chain([], [0], [], [])
    before = None
    for term, n in zip(reversed(terms.tolist()), reversed(times.tolist())):
        postings = block.terms.get(term)
        if not postings:
            before = None  # pairs are stored for neighbours in the query
            continue
        reach, paired, joint = chain.reach[-1] + postings.best * n, False, None
        if with_pairs and before is not None:
            other, m = chain.parts[-1]
            joint = block.pairs.get(numbers[min(term, before), max(term, before)])
            low = min(n, m)
            both = joint.best * low + postings.best * (n - low) + other.best * (m - low) if joint else 0
            together = chain.reach[-2] + max(postings.best * n, other.best * m, both)
            if together < reach:
                reach, paired = together, True
        chain.parts.append((postings, n))
        chain.reach.append(reach)
        chain.paired.append(paired)
        chain.joint.append(joint)
        before = term
    return chain


def best_in(chain: Chain, n: int, k: int, threshold: int, seen: Counter | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The documents of a block, of ``n``, that may be among the best ``k``, and their scores.

    ``threshold`` is a score that the k best have reached already, or 0. ``seen`` counts what is looked at.
    """
    seen = Counter() if seen is None else seen
    first = sum(r < threshold for r in chain.reach[1:])  # terms that cannot reach it together
    scores = np.zeros(n, np.int64)
    for postings, times in chain.parts[first:]:
        scores[postings.ordinals] += postings.impacts * times
        seen["added"] += len(postings.ordinals)
    left = np.flatnonzero(scores)
    while first:
        left = left[scores[left] + chain.reach[first] >= threshold]
        if not len(left):
            break
        paired, joint = chain.paired[first - 1], chain.joint[first - 1]
        parts = chain.parts[first - 1 - paired : first]
        first -= len(parts)
        single = left
        if paired and joint and all(times == 1 for _, times in parts):
            both = joint.at(left)
            seen["joint"] += len(left)
            scores[left] += both
            # the others hold one of the two at most
            alone = chain.reach[first] + max(postings.best for postings, _ in parts)
            stays = (both > 0) | (scores[left] + alone >= threshold)
            left, both = left[stays], both[stays]
            single = left[both == 0]
        for postings, times in parts if len(single) else ():
            scores[single] += postings.at(single) * times
            seen["looked up"] += len(single)
    left = left[scores[left] >= max(threshold, 1)]
    if len(left) > k:
        # of equal scores the first ones
        left = left[np.lexsort((left, -scores[left]))[:k]]
    return left, scores[left]


def _searched(
    batches: Iterator[pa.RecordBatch], log: Log, k: int, thresholds: dict[int, int], paired: bool
) -> Iterator[pa.RecordBatch]:
    """The best of this task's blocks for each query."""
    numbers = {pair: i for i, pair in enumerate(log.pairs)}
    best: dict[int, pa.Table] = {}
    floor = dict(thresholds)
    for batch in batches:
        for row in range(batch.num_rows):
            block = Block(batch, row)
            for query, terms, times in log.queries:
                chain = chain_of(block, numbers, terms, times, paired)
                found, scores = best_in(chain, len(block.keys), k, floor.get(query, 0))
                if not len(found):
                    continue
                own = pa.table({"key": block.keys.take(pa.array(found)), "score": scores})
                if query in best:
                    own = pa.concat_tables([best[query], own])
                order = pc.sort_indices(
                    own, sort_keys=[("score", "descending"), ("key", "ascending")], null_placement="at_end"
                )
                best[query] = own = own.take(order[:k])
                if own.num_rows == k:
                    floor[query] = max(floor.get(query, 0), own["score"][-1].as_py())
    for query, own in best.items():
        table = own.append_column("query", pa.array([query] * own.num_rows, pa.int64())).combine_chunks()
        yield from table.select(["query", "key", "score"]).to_batches()


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def pair_index(index: Index, log: Log) -> DataFrame:
    """The blocks that hold a term of the log, with impacts and pairs, as a stored table."""
    kind = index.blocks.schema["keys"].dataType.simpleString()
    lists = ", ".join(f"{c} array<bigint>" for c in _LISTS)
    schema = f"block bigint, keys {kind}, {lists}, " + ", ".join(f"{c} binary" for c in _BITS)
    rows = index.blocks.select("block", "keys", "lengths", "terms", "counts", "ordinals", "times")
    return written(rows.mapInArrow(lambda b: _impacts(b, log), schema), "lexical-pairs")


def best_documents(pairs: DataFrame, log: Log, k: int = 20, paired: bool = True) -> DataFrame:
    """(query, key, score, rank) of the best documents of the log's queries; without joint bounds if not ``paired``."""
    kind = pairs.schema["keys"].dataType.elementType.simpleString()

    def over(blocks: DataFrame, thresholds: dict[int, int]) -> DataFrame:
        return blocks.mapInArrow(
            lambda b: _searched(b, log, k, thresholds, paired), f"query bigint, key {kind}, score bigint"
        )

    share = F.pmod(F.xxhash64("block"), F.lit(_SHARE)) == 0
    first = written(_ranked(over(pairs.where(share), {}), k), "lexical-first")
    reached = {r["query"]: r["score"] for r in first.where(F.col("rank") == k).select("query", "score").collect()}
    return _ranked(first.drop("rank").unionByName(over(pairs.where(~share), reached)), k)


def search(
    index: Index, items: DataFrame, k: int = 20, item: str = "item_id", text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``item``, rank, ``key`` and score of the ``k`` best documents of every item.

    Items are taken in slices of a bounded number, each searched in one pass over the index.
    """
    spark = items.sparkSession
    row = F.monotonically_increasing_id().alias("row")
    stored = written(items.select(F.col(item).alias("item"), F.col(text).alias("text"), row), "items")
    ordered = written(numbered(stored, ["row"], "query"), "numbered-items")
    kind = items.schema[item].dataType.simpleString()
    documents = index.blocks.schema["keys"].dataType.elementType.simpleString()
    found = spark.createDataFrame([], f"item {kind}, rank int, key {documents}, score bigint")
    for start in range(0, ordered.count() if index.total else 0, _QUERIES_AT_ONCE):
        part = ordered.where(F.col("query").between(start, start + _QUERIES_AT_ONCE - 1))
        log = read_log(index, [(r["query"], r["text"]) for r in part.select("query", "text").collect()])
        if log.queries:
            ranked = best_documents(pair_index(index, log), log, k)
            names = F.broadcast(part.select("query", "item"))  # a slice at most
            found = found.unionByName(ranked.join(names, "query").select("item", "rank", "key", "score"))
    return found.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")

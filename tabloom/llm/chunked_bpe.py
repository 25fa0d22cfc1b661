"""Byte-level BPE of a corpus in which chunks that documents share are encoded once.

Texts are cut where a rolling hash over the last 32 bytes says so, so that a passage gives the same chunks
wherever it stands. Hashes alone are counted first. A chunk found twice or more is encoded once
for the whole corpus and its ids are joined to all its occurrences; everything else is encoded in
place. A bitmap of 64 bits or more for each shared chunk, 128 MiB at most and the only thing sent to all
executors, tells which documents may hold one: only those are shuffled. A bit that two hashes share costs a lookup,
no more.

Chunks do not respect tokens, so joins are repaired. A chunk's ids are kept from its first to its
last sure cut, a single space between characters that aren't white space: the pre-tokenizer
cuts before it whatever stands around, so on both sides of it the ids of the chunk and those of the
whole text agree. What lies between the last sure cut of one chunk and the first of the next is
encoded again as it stands in the text; where a chunk has none, the window grows into the next.
The result equals encoding the whole text at once, for every text.

Defined results: a null text is empty, an empty text has no ids. Special tokens written out in a text are
special tokens. Rows that repeat a document are each encoded (their chunks once). An empty table
gives no rows. Columns other than key and text play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.durable import written
from tabloom.llm.bpe import ByteBpe, load
from tabloom.llm.common import ship

#: A chunk ends where these bits of the rolling hash are 0: every 1024 bytes on average.
_END = np.uint32(0x3FF << 22)
_LEAST, _MOST = 256, 8192
#: Texts are hashed together up to so many bytes.
_AT_ONCE = 1 << 21
_SURE = re.compile(r"(?<=\S) (?=\S)")
_SEEN = 100_000
#: Bits of the map of shared chunks, 8 to 128 MiB in all, and for each of these.
_LEAST_BITS, _MOST_BITS, _BITS_EACH = 1 << 26, 1 << 30, 64


def _gear() -> np.ndarray:
    """A random number per byte value, from a rule."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], np.uint32)


_GEAR = _gear()


class Finish(NamedTuple):
    """What is returned for a document: column types and a function of its ids."""

    columns: str
    of: Callable[[ByteBpe, np.ndarray], tuple]


def _as_bytes(bpe: ByteBpe, ids: np.ndarray) -> tuple:
    return (ids.astype("<u4").tobytes(),)


def _as_digests(bpe: ByteBpe, ids: np.ndarray) -> tuple:
    listed = ",".join(map(str, ids.tolist()))
    decoded = bpe.decode(ids).encode()
    return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


IDS = Finish("ids binary", _as_bytes)
DIGESTS = Finish("n_tokens bigint, ids_sha256 string, decoded_sha256 string", _as_digests)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """For each byte the hash of it and the 31 before it."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
    return h


def _chunk_ends(data: np.ndarray, ends: np.ndarray) -> list[int]:
    """Where the chunks of one text end. ``ends``: the places after which the hash allows it."""
    size, at, cuts = len(data), 0, []
    k = 0
    while size - at > _LEAST:
        while k < len(ends) and ends[k] < at + _LEAST:
            k += 1
        end = min(int(ends[k]) if k < len(ends) else size, at + _MOST, size)
        while end < size and data[end] & 0xC0 == 0x80:  # not inside a character
            end += 1
        cuts.append(end)
        at = end
    if at < size or not cuts:
        cuts.append(size)
    return cuts


def chunks_of(texts: pa.Array) -> Iterator[tuple[int, bytes, list[tuple[int, int, bytes]]]]:
    """The place of each text, its bytes, and its chunks as (start, end, 128-bit hash)."""
    group, size = [], 0
    for i in range(len(texts) + 1):
        if i < len(texts):
            data = (texts[i].as_py() or "").encode()
            group.append((i, data))
            size += len(data)
        if group and (size >= _AT_ONCE or i == len(texts)):
            joined = np.frombuffer(b"".join(d for _, d in group), np.uint8)
            allowed = np.flatnonzero((rolling_hash(joined) & _END) == 0) + 1 if size else np.empty(0, int)
            first = 0
            for place, data in group:
                own = joined[first : first + len(data)]
                # no cut within _LEAST bytes, so the hash never reaches into the text before
                low, high = np.searchsorted(allowed, [first, first + len(data)])
                found, start = [], 0
                for end in _chunk_ends(own, allowed[low:high] - first) if data else ():
                    found.append((start, end, xxhash.xxh3_128_digest(data[start:end])))
                    start = end
                yield place, data, found
                first += len(data)
            group, size = [], 0


def _slot(chunk: bytes, bits: int) -> int:
    return int.from_bytes(chunk[:8], "little") % bits


def _hashes(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [h for _, _, chunks in chunks_of(batch.column(0)) for _, _, h in chunks]
        slots = [_slot(h, bits) for h in found]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(slots, pa.int64())], ["h", "s"])


def shared_chunks(documents: DataFrame, text: str, bits: int | None = None) -> np.ndarray:
    """A bitmap of ``bits`` bits, a power of 2, with those of the chunks found twice or more.

    By default there are ``_BITS_EACH`` or more for each of these, up to ``_MOST_BITS`` in all: of a hundred chunks that are
    not shared one or two then look as if they were.
    """
    counted = documents.select(text).mapInArrow(lambda b: _hashes(b, _MOST_BITS), "chunk binary, slot bigint")
    shared = written(counted.groupBy("chunk", "slot").count().where("count > 1").select("slot"), "shared-slots")
    if bits is None:
        bits = min(max(_LEAST_BITS, 1 << (_BITS_EACH * shared.count()).bit_length()), _MOST_BITS)
    slot = F.col("slot").bitwiseAND(F.lit(bits - 1))
    words = shared.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("set")
    )
    found = words.toArrow()  # bits / 64 rows at most
    bitmap = np.zeros(bits >> 6, np.int64)
    bitmap[found["word"].to_numpy()] = found["set"].to_numpy()
    return bitmap.view(np.uint64)


def _struct_lists(rows: list[list[tuple[int, int, bytes]]]) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chunk", pa.binary())]))
    return pa.array([[{"start": a, "end": b, "chunk": h} for a, b, h in r] for r in rows], kind)


def _encode_rows(
    batches: Iterator[pa.RecordBatch], path: str, bitmap: np.ndarray, finish: Finish, kinds: list[pa.DataType]
) -> Iterator[pa.RecordBatch]:
    """Each document encoded, or, if it may hold shared chunks, its bytes and what they may be."""
    bpe, bits = load(path), len(bitmap) * 64
    for batch in batches:
        held, refs, done = [], [], []
        for _, data, chunks in chunks_of(batch.column(1)):
            maybe = [c for c in chunks if bitmap[(s := _slot(c[2], bits)) >> 6] >> np.uint64(s & 63) & np.uint64(1)]
            refs.append(maybe)
            held.append(data if maybe else None)
            done.append((None,) * len(kinds) if maybe else finish.of(bpe, bpe.encode(data.decode())))
        columns = [batch.column(0), pa.array(held, pa.binary()), _struct_lists(refs)]
        columns += [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)] if done else []
        if done:
            yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])


def _chunk_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of the documents, each once as far as this task remembers."""
    seen: set[bytes] = set()
    for batch in batches:
        out: tuple[list, list] = ([], [])
        for data, chunks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for c in chunks:
                if c["chunk"] not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(c["chunk"])
                    out[0].append(c["chunk"])
                    out[1].append(data[c["start"] : c["end"]])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in out], ["h", "b"])


def _encode_chunks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """The text up to the first sure cut, the ids from there to the last one, and the text behind it."""
    bpe = load(path)
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [])
        for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = data.decode()
            sure = [m.start() for m in _SURE.finditer(text)]
            first, last = (sure[0], sure[-1]) if sure else (len(text), len(text))
            ids = bpe.encode(text[first:last]).astype("<u4").tobytes() if sure else None
            for column, value in zip(out, (chunk, text[:first], ids, text[last:]), strict=True):
                column.append(value)
        kinds = [pa.binary(), pa.string(), pa.binary(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], list("abcd"))


class _Joiner:
    """One document put together from its text and the ids of its shared chunks."""

    def __init__(self, bpe: ByteBpe, data: bytes):
        self.bpe, self.data, self.at = bpe, data, 0
        self.open = ""  # text from the last sure cut on
        self.parts: list[np.ndarray] = []

    def chunk(self, start: int, end: int, head: str, ids: bytes | None, tail: str) -> None:
        self.open += self.data[self.at : start].decode() + head
        self.at = end
        if ids is not None:
            self.parts += [self.bpe.encode(self.open), np.frombuffer(ids, "<u4")]
            self.open = tail

    def close(self) -> np.ndarray:
        self.open += self.data[self.at :].decode()
        return np.concatenate([*self.parts, self.bpe.encode(self.open)])


def _join_chunks(
    batches: Iterator[pa.RecordBatch], path: str, finish: Finish, kinds: list[pa.DataType]
) -> Iterator[pa.RecordBatch]:
    """Rows sorted by document and place, the document's bytes before its chunks."""
    bpe, row, joiner = load(path), None, None

    def out(rows: list[int], done: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), *columns], [f"c{i}" for i in range(len(kinds) + 1)])

    for batch in batches:
        rows, done = [], []
        for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if values[0] != row:
                if joiner:
                    rows.append(row)
                    done.append(finish.of(bpe, joiner.close()))
                row, joiner = values[0], _Joiner(bpe, values[2])
            else:
                joiner.chunk(*values[3:])
        if rows:
            yield out(rows, done)
    if joiner:
        yield out([row], [finish.of(bpe, joiner.close())])


def encode_documents(
    documents: DataFrame,
    path: str,
    finish: Finish = IDS,
    key: str = "doc_id",
    text: str = "text",
    bits: int | None = None,
) -> DataFrame:
    """``key`` and what ``finish`` makes of the ids of every document (by default the ids, as bytes).

    ``path`` is a tokenizer file found at the same place on every machine.
    """
    spark = documents.sparkSession
    ship(spark)
    bitmap = spark.sparkContext.broadcast(shared_chunks(documents, text, bits))
    fields = spark.createDataFrame([], finish.columns).schema
    kinds = [_ARROW[f.dataType.simpleString()] for f in fields]
    key_type = documents.schema[key].dataType.simpleString()

    encoded = written(
        documents.select(key, text)
        .mapInArrow(
            lambda b: _encode_rows(b, path, bitmap.value, finish, kinds),
            f"id {key_type}, data binary, refs array<struct<start:int,end:int,chunk:binary>>, {finish.columns}",
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "encoded",
    )
    held = encoded.where("data is not null")
    known = written(
        held.select("data", "refs")
        .mapInArrow(_chunk_bytes, "chunk binary, data binary")
        .groupBy("chunk")
        .agg(F.any_value("data").alias("data"))
        .mapInArrow(lambda b: _encode_chunks(b, path), "chunk binary, head string, ids binary, tail string"),
        "chunk-ids",
    )
    # stored tables on both sides, so that adaptive execution can split a chunk with very many occurrences
    places = held.select("row", F.posexplode("refs").alias("n", "ref")).select("row", "n", "ref.*")
    found = places.join(known, "chunk").select(
        "row", "n", F.lit(None).cast("binary").alias("data"), "start", "end", "head", "ids", "tail"
    )
    own = held.select(
        "row",
        F.lit(-1).alias("n"),
        "data",
        *(F.lit(None).cast(t).alias(c) for c, t in (("start", "int"), ("end", "int"), ("head", "string"), ("ids", "binary"), ("tail", "string"))),
    )
    joined = (
        own.unionByName(found)
        .repartition("row")
        .sortWithinPartitions("row", "n")
        .mapInArrow(lambda b: _join_chunks(b, path, finish, kinds), f"row bigint, {finish.columns}")
    )
    names = fields.names
    rest = joined.join(held.select("row", "id"), "row").select("id", *names)
    return encoded.where("data is null").select("id", *names).unionByName(rest).withColumnRenamed("id", key)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def decode(ids: pa.Array, path: str) -> pa.Array:
    """The texts of little-endian unsigned 32-bit ids."""
    bpe = load(path)
    return pa.array([None if i is None else bpe.decode(np.frombuffer(i, "<u4")) for i in ids.to_pylist()], pa.string())


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Add the text of the ids of each row."""
    ship(encoded.sparkSession)
    return encoded.withColumn(out, F.arrow_udf(lambda column: decode(column, path), "string")(ids))

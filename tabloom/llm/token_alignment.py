"""Alignment of two tokenizers over a corpus, with the document counts of linked token pairs.

A text is encoded by a byte-level BPE (A) and by a sentencepiece model (B). Both cut the same bytes,
a blank and the text, into tokens. Two tokens are linked where their bytes overlap, and offsets
where both sides end cut the text into groups.

Counts come from inverted bitmaps. Documents are dealt into blocks and numbered there, and for
each linked pair of ids a block holds bitmaps over its documents, one per bit of the
multiplicity: a document that has the pair linked five times is in the planes 1 and 4. The OR
of a pair's planes are the documents that hold it, the popcounts of the planes, weighted, are its
links. Blocks have different documents, so a pair's bitmaps over all blocks lie side by side, and popcounts
are added up in Spark. A bitmap is compressed to a list of numbers where that is smaller. With the corpus-wide
counts joined to a block's pairs its postings are read the other way, and return to each document the sum
over its links. Texts are read once; what is shuffled is a count for each pair of a block, twice, and the block.

Defined results: a text that is null or empty, or that either tokenizer does not give back byte
for byte (sentencepiece reads U+2581 as a blank), has no tokens, zeros and an empty text of
groups. Special tokens in a text are plain text. Rows that repeat a key are documents of
their own and count each; a null key is kept as it is. An empty table gives no rows. Columns other than
those named play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.durable import written
from tabloom.llm.bpe import ByteBpe, load
from tabloom.llm.common import ship

_BATCH_CHARS = 1 << 20
_ORDINAL_BITS = 16
_BLANK = "▁"  # how sentencepiece writes a blank
_SEPARATORS = (b",", b"|", b";")

_ALIGNERS: dict[tuple[str, str], Aligner] = {}


class Alignment(NamedTuple):
    """Aligned documents, one behind the other. ``*_ends`` has the end of each document in the list named."""

    a: np.ndarray
    b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    link_ends: np.ndarray
    group_ends: np.ndarray
    texts: list[bytes]


def _piece_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        found.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(_BLANK, " ").encode())
    return found


class Aligner:
    """Both tokenizers and what their tokens are as bytes, for Python workers."""

    def __init__(self, a: ByteBpe, b: sentencepiece.SentencePieceProcessor):
        self.a, self.b = a, b
        tokens = a.core.token_byte_values()
        size = 1 + max(a.core.encode_single_token(t) for t in tokens)
        self.a_lengths = np.zeros(size, np.int64)
        for token in tokens:
            self.a_lengths[a.core.encode_single_token(token)] = len(token)
        self.b_bytes = _piece_bytes(b)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)
        # the id and what follows it, as rows of one width: digits of every id with every separator
        self.codes = max(size, len(self.b_bytes))
        shown = [str(i).encode() + end for end in _SEPARATORS for i in range(self.codes)]
        width = max(map(len, shown))
        self.shown = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in shown), np.uint8).reshape(-1, width)
        self.shown_lengths = np.array([len(x) for x in shown], np.int64)

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of both sides, none for a text that either does not give back."""
        none = np.empty(0, np.int64)
        pieces = self.b.encode([t or "" for t in texts], num_threads=1)
        found: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        for text, ids in zip(texts, pieces, strict=True):
            a, b = none, none
            if text:
                whole = b" " + text.encode()
                if b"".join(map(self.b_bytes.__getitem__, ids)) == whole:
                    left = self.a.encode_plain(" " + text).astype(np.int64)
                    # tokens of a byte-level vocabulary can lose nothing, so their length says all
                    if int(self.a_lengths[left].sum()) == len(whole):
                        a, b = left, np.array(ids, np.int64)
            found[0].append(a)
            found[1].append(b)
        return found

    def align(self, texts: list[str | None]) -> Alignment:
        """All texts in one pass: at the end of each both sides end, so that together they are like one text."""
        of_a, of_b = self.encode(texts)
        a, b = np.concatenate(of_a), np.concatenate(of_b)
        a_last, b_last = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        size = int(a_last[-1]) if len(a_last) else 0
        ends = np.zeros(size + 1, np.uint8)
        ends[a_last] = 1
        ends[b_last] += 2
        # a link lies between two ends that follow each other
        at = np.flatnonzero(ends)
        kind = ends[at]
        is_a, is_b, is_both = (kind & 1).astype(bool), (kind & 2).astype(bool), kind == 3
        place = lambda flag: np.cumsum(flag) - flag
        link_a, link_b, group = place(is_a), place(is_b), place(is_both)
        a_ends = np.cumsum([len(x) for x in of_a])
        b_ends = np.cumsum([len(x) for x in of_b])
        document_ends = np.concatenate([[0], a_last])[a_ends]
        link_ends = np.searchsorted(at, document_ends, "right")
        group_ends = np.concatenate([[0], np.cumsum(is_both)])[link_ends]
        texts_of_groups = self._texts(a, b, group[is_a], group[is_b], is_both[is_a], is_both[is_b], a_ends + b_ends)
        return Alignment(a, b, a[link_a], b[link_b], a_ends, b_ends, link_ends, group_ends, texts_of_groups)

    def _texts(self, a, b, a_group, b_group, a_closes, b_closes, ends) -> list[bytes]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3``."""
        groups = int(a_group[-1]) + 1 if len(a_group) else 0
        a_until = np.cumsum(np.bincount(a_group, minlength=groups))
        b_until = np.cumsum(np.bincount(b_group, minlength=groups))
        order = np.empty(len(a) + len(b), np.int64)
        b_before = b_until - np.diff(b_until, prepend=0)
        order[np.arange(len(a)) + b_before[a_group]] = a + a_closes * self.codes
        order[np.arange(len(b)) + a_until[b_group]] = b + b_closes * (2 * self.codes)
        lengths = self.shown_lengths[order]
        digits = self.shown[order][np.arange(self.shown.shape[1]) < lengths[:, None]].tobytes()
        cuts = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], ends])]
        return [digits[s : max(s, e - 1)] for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def aligner(a_path: str, b_path: str) -> Aligner:
    """The tokenizers, read once per worker."""
    if (a_path, b_path) not in _ALIGNERS:
        model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        _ALIGNERS[a_path, b_path] = Aligner(load(a_path), model)
    return _ALIGNERS[a_path, b_path]


class Planes(NamedTuple):
    """Bitmaps of a block: of each pair (by its place) and plane the documents, as numbers or as bits."""

    pair: np.ndarray
    plane: np.ndarray
    size: np.ndarray
    dense: np.ndarray
    bits: bytes


def invert(pairs: np.ndarray, documents: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Planes]:
    """The distinct pairs of links, the documents and links of each, and its planes over ``n`` documents."""
    links = np.sort((pairs << _ORDINAL_BITS) | documents)
    starts = np.flatnonzero(np.diff(links, prepend=-1))
    held, times = links[starts], np.diff(starts, append=len(links))
    pair, document = held >> _ORDINAL_BITS, (held & ((1 << _ORDINAL_BITS) - 1)).astype(np.uint16)
    firsts = np.flatnonzero(np.diff(pair, prepend=-1))
    counts = np.diff(firsts, append=len(pair))
    of_pair = np.repeat(np.arange(len(firsts)), counts)
    width = -(-n // 8)
    found: list[tuple[np.ndarray, ...]] = []
    bits = bytearray()
    for plane in range(int(times.max(initial=0)).bit_length()):
        inside = (times >> plane) & 1 == 1
        owner, member = of_pair[inside], document[inside]
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(begins, append=len(owner))
        dense = sizes * 2 > width
        for k in np.flatnonzero(dense):
            flags = np.zeros(n, np.uint8)
            flags[member[begins[k] : begins[k] + sizes[k]]] = 1
            bits += np.packbits(flags, bitorder="little").tobytes()
        bits += member[~np.repeat(dense, sizes)].astype("<u2").tobytes()
        order = np.argsort(~dense, kind="stable")  # as they are laid down: dense ones first
        found.append((owner[begins][order], np.full(len(order), plane, np.int8), sizes[order], dense[order]))
    columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 4
    links_of = np.add.reduceat(times, firsts) if len(firsts) else firsts
    planes = Planes(columns[0], columns[1].astype(np.int8), columns[2], columns[3].astype(bool), bytes(bits))
    return pair[firsts], counts, links_of, planes


def returned(planes: Planes, scores: np.ndarray, n: int) -> np.ndarray:
    """For each document the sum of its links' scores, given the scores of the pairs (one column each)."""
    total = np.zeros((scores.shape[0], n), np.int64)
    weight = scores[:, planes.pair] << planes.plane.astype(np.int64)
    width, at = -(-n // 8), 0
    for plane in np.unique(planes.plane):
        own = np.flatnonzero(planes.plane == plane)
        dense, listed = own[planes.dense[own]], own[~planes.dense[own]]
        for k in dense:
            flags = np.unpackbits(np.frombuffer(planes.bits, np.uint8, width, at), count=n, bitorder="little")
            total += weight[:, k, None] * flags
            at += width
        sizes = planes.size[listed]
        member = np.frombuffer(planes.bits, "<u2", int(sizes.sum()), at)
        at += 2 * len(member)
        for row, value in zip(total, weight, strict=True):
            np.add.at(row, member, np.repeat(value[listed], sizes))
    return total


class _Block:
    """Documents and links until there are enough of them."""

    def __init__(self, b_size: int):
        self.b_size = b_size
        self.keys: list[pa.Array] = []
        self.documents: list[tuple[np.ndarray, ...]] = []
        self.groups: list[str] = []
        self.links: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = self.n_links = 0

    def add(self, keys: pa.Array, found: Alignment, texts: list[str]) -> None:
        each = lambda ends: np.diff(ends, prepend=0)
        of_document = each(found.link_ends)
        self.keys.append(keys)
        self.documents.append((each(found.a_ends), each(found.b_ends), each(found.group_ends), of_document))
        self.groups += texts
        own = np.repeat(np.arange(self.n, self.n + len(keys)), of_document)
        self.links.append((found.link_a * self.b_size + found.link_b, own))
        self.n += len(keys)
        self.n_links += len(own)

    def row(self, schema: pa.Schema) -> pa.RecordBatch:
        pair, counts, links, planes = invert(*(np.concatenate(x) for x in zip(*self.links, strict=True)), self.n)
        numbers = [np.concatenate(x) for x in zip(*self.documents, strict=True)]
        fields = [pa.concat_arrays(self.keys), *map(pa.array, numbers), pa.array(self.groups, pa.string())]
        documents = pa.StructArray.from_arrays(fields, fields=list(schema.field("docs").type.value_type))
        values = [documents, pair, counts, links, *planes[:4]]
        columns = [
            pa.ListArray.from_arrays(
                pa.array([0, len(v)], pa.int32()),
                v if isinstance(v, pa.Array) else pa.array(v, schema.field(k).type.value_type),
                type=schema.field(k).type,
            )
            for k, v in enumerate(values)
        ]
        return pa.RecordBatch.from_arrays([*columns, pa.array([planes.bits], pa.binary())], schema=schema)


def _block_schema(key: pa.DataType) -> pa.Schema:
    numbers = [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    document = pa.struct([("key", key), *numbers, ("groups", pa.string())])
    columns = {
        "docs": document,
        "pairs": pa.int64(),
        "documents": pa.int64(),
        "links": pa.int64(),
        "entry_pair": pa.int32(),
        "entry_plane": pa.int8(),
        "entry_size": pa.int32(),
        "entry_dense": pa.bool_(),
    }
    return pa.schema([*((n, pa.list_(t)) for n, t in columns.items()), ("bits", pa.binary())])


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """The keys and texts of a batch in slices of about a megabyte."""
    texts, at, size = [], 0, 0
    for text in batch.column(1).to_pylist():
        texts.append(text)
        size += len(text or "")
        if size >= _BATCH_CHARS:
            yield batch.column(0).slice(at, len(texts)), texts
            texts, at, size = [], at + len(texts), 0
    if texts:
        yield batch.column(0).slice(at, len(texts)), texts


def _blocks(
    batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, links: int, digest: bool
) -> Iterator[pa.RecordBatch]:
    tokenizers = aligner(a_path, b_path)
    block = _Block(len(tokenizers.b_bytes))
    schema = None
    for batch in batches:
        schema = schema or _block_schema(batch.schema.field(0).type)
        for keys, texts in _slices(batch):
            if block.n + len(keys) >= 1 << _ORDINAL_BITS:
                yield block.row(schema)
                block = _Block(block.b_size)
            found = tokenizers.align(texts)
            shown = [hashlib.sha256(t).hexdigest() if digest and t else t.decode() for t in found.texts]
            block.add(keys, found, shown)
            if block.n_links >= links:
                yield block.row(schema)
                block = _Block(block.b_size)
    if block.n:
        yield block.row(schema)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's documents with the sums over their links."""
    numbers = lambda row, name: np.asarray(row[name].values)
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at] for name in batch.schema.names}
            documents = row["docs"].values
            if row["scores"].values is None:
                scores = np.zeros((2, 0), np.int64)
            else:
                score = row["scores"].values
                order = np.argsort(np.asarray(score.field("pair")))
                place = np.searchsorted(np.asarray(score.field("pair"))[order], numbers(row, "pairs"))
                best = np.asarray(score.field("best").cast(pa.int64()))
                scores = np.stack([best, np.asarray(score.field("documents"))])[:, order[place]]
            planes = Planes(
                *(numbers(row, f"entry_{name}") for name in ("pair", "plane", "size")),
                row["entry_dense"].values.to_numpy(zero_copy_only=False),
                row["bits"].as_py(),
            )
            n_best, count_sum = returned(planes, scores, len(documents))
            fields = dict(zip((f.name for f in documents.type), documents.flatten(), strict=True))
            fields |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
            yield pa.RecordBatch.from_arrays([fields[n] for n in _COLUMNS], list(_COLUMNS))


_COLUMNS = ("key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


class Corpus(NamedTuple):
    """An aligned corpus: its blocks, and the counts of its linked pairs."""

    blocks: DataFrame
    #: pair, a_id, b_id, documents (that hold it linked), links (in all), best (most documents of its a_id, ties too)
    pairs: DataFrame


def align_corpus(
    documents: DataFrame,
    a_path: str,
    b_path: str,
    key: str = "doc_id",
    text: str = "text",
    digest: bool = False,
    block_links: int = 1 << 22,
) -> Corpus:
    """Align every document and count the linked pairs.

    ``a_path`` is a byte-level BPE file and ``b_path`` a sentencepiece model, found at the same places on every
    machine. ``digest`` keeps the SHA-256 of a document's groups instead of their text.
    """
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    numbers = "n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint"
    schema = (
        f"docs array<struct<key:{kind},{numbers},groups:string>>, pairs array<bigint>, documents array<bigint>,"
        " links array<bigint>, entry_pair array<int>, entry_plane array<tinyint>, entry_size array<int>,"
        " entry_dense array<boolean>, bits binary"
    )
    blocks = written(
        documents.select(key, text)
        .mapInArrow(lambda batches: _blocks(batches, a_path, b_path, block_links, digest), schema)
        .withColumn("block", F.monotonically_increasing_id()),
        "aligned-blocks",
    )
    sums = [F.sum(c).alias(c) for c in ("documents", "links")]
    counted = _by_pair(blocks, "documents", "links").groupBy("pair").agg(*sums)
    a_id = F.floor(F.col("pair") / b_size).alias("a_id")  # with at most as many rows as B has ids
    of_a = Window.partitionBy("a_id")
    pairs = written(
        counted.select("pair", a_id, F.pmod("pair", F.lit(b_size)).alias("b_id"), "documents", "links").withColumn(
            "best", F.col("documents") == F.max("documents").over(of_a)
        ),
        "aligned-pairs",
    )
    return Corpus(blocks, pairs)


def _by_pair(blocks: DataFrame, *columns: str) -> DataFrame:
    """A row for each pair of each block."""
    found = blocks.select("block", F.explode(F.arrays_zip("pairs", *columns)).alias("p"))
    return found.select("block", F.col("p.pairs").alias("pair"), *(f"p.{c}" for c in columns))


def document_alignments(corpus: Corpus, key: str = "doc_id") -> DataFrame:
    """``key``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of every document."""
    kind = corpus.blocks.schema["docs"].dataType.elementType["key"].dataType.simpleString()
    scores = (
        _by_pair(corpus.blocks)
        .join(corpus.pairs.select("pair", "documents", "best"), "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct("pair", "documents", "best")).alias("scores"))  # a block's pairs are bounded
    )
    schema = f"key {kind}, " + ", ".join(f"{c} bigint" for c in _COLUMNS[1:-1]) + ", groups string"
    return corpus.blocks.join(scores, "block", "left").mapInArrow(_scored, schema).withColumnRenamed("key", key)

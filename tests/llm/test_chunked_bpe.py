import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tabloom.llm import chunked_bpe as c

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def wanted(library, rows):
    found = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        listed = ",".join(map(str, ids))
        decoded = library.decode(ids, skip_special_tokens=False)
        found.append((key, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, decoded))))
    return sorted(found, key=str)


def test_odd_documents(odd, library):
    got = [tuple(r) for r in c.encode_documents(odd, PATH, c.DIGESTS).collect()]
    assert sorted(got, key=str) == wanted(library, [(r.doc_id, r.text) for r in odd.collect()])


def test_shared_passages_at_every_kind_of_join(spark, library):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    long = [t for t in docs if len(t) > 4000][:8]
    chance = random.Random(6)
    joins = ["", " ", "  ", "\n", "x", "'s", "é", "🙂", "1", "<|endoftext|>", "a" * 9000, " " * 700, "日本" * 800]
    rows = [(k, "".join([*chance.sample(long, 1), j, *chance.sample(long, 1), j])) for k, j in enumerate(joins * 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert sorted(map(tuple, c.encode_documents(df, PATH, c.DIGESTS).collect()), key=str) == wanted(library, rows)


def test_long_runs_of_white_space(spark, library):
    runs = [" " * 2_000_000, "\n" * 2_000_000, " " * 1_200_000]
    rows = [(k, f"Some text {k}.{run}And more.") for k, run in enumerate(runs)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    assert sorted(map(tuple, c.encode_documents(df, PATH, c.DIGESTS).collect()), key=str) == wanted(library, rows)


def test_any_bitmap_gives_the_same(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, c.encode_documents(df, PATH, c.DIGESTS, bits=64).collect()), key=str) == wanted(library, rows)


def test_the_bitmap_follows_the_number_of_shared_chunks(spark, monkeypatch):
    texts = spark.range(3000).selectExpr("concat('text ', id % 2500) text")
    assert len(c.shared_chunks(texts, "text")) * 64 == 1 << 26
    monkeypatch.setattr(c, "_LEAST_BITS", 64)
    assert len(bitmap := c.shared_chunks(texts, "text")) * 64 == 1 << 15
    assert 480 < int(np.bitwise_count(bitmap).sum()) <= 500
    monkeypatch.setattr(c, "_MOST_BITS", 1024)
    assert len(c.shared_chunks(texts, "text")) * 64 == 1024
    assert len(c.shared_chunks(texts.where("false"), "text")) * 64 == 64


def test_round_trip(odd):
    encoded = c.encode_documents(odd, PATH)
    back = c.decode_documents(encoded, PATH)
    assert sorted(r.text for r in back.collect()) == sorted(r.text or "" for r in odd.collect())


def test_empty_table(none):
    assert c.encode_documents(none, PATH, c.DIGESTS).count() == 0


def test_rolling_hash_sees_32_bytes():
    rng = np.random.default_rng(1)
    tail = rng.integers(0, 256, 32, dtype=np.uint8)
    a, b = (np.concatenate([rng.integers(0, 256, n, dtype=np.uint8), tail]) for n in (50, 77))
    assert c.rolling_hash(a)[-1] == c.rolling_hash(b)[-1]


def test_a_passage_gives_the_same_chunks_wherever_it_stands():
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh é,.\n") for _ in range(20_000))
    texts = [passage, "x" * 777 + passage, passage[300:] + "tail", "é" * 5000 + passage]
    hashes = [{h for *_, h in chunks} for _, _, chunks in c.chunks_of(pa.array(texts))]
    assert all(len(hashes[0] & other) >= len(hashes[0]) - 4 for other in hashes[1:])
    for _, data, chunks in c.chunks_of(pa.array(texts)):
        assert b"".join(data[a:b] for a, b, _ in chunks) == data
        assert all(data[a:b].decode() for a, b, _ in chunks)

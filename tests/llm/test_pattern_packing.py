import random
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabloom.llm import pattern_packing as p

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def plain_shortest_pack_first(lengths, window):
    """Fills of the packs, one document after the other."""
    packs = []
    for n in sorted(lengths, reverse=True):
        packs.sort()
        if packs and packs[0] + n <= window:
            packs[0] += n
        else:
            packs.append(n)
    return sorted(packs)


def some_counts(chance, window):
    return Counter(chance.randint(1, window - 1) for _ in range(chance.randint(1, 200)))


def test_patterns_are_those_of_packs_filled_one_by_one():
    chance = random.Random(1)
    for _ in range(300):
        window = chance.choice([5, 16, 100])
        counts = some_counts(chance, window)
        got = p.shortest_pack_first(dict(counts), window)
        fills = sorted(x.fill for x in got for _ in range(x.count))
        assert fills == plain_shortest_pack_first(counts.elements(), window)


def laid_out(places):
    """(length, rank, start, size, sequence, offset) of every piece."""
    for x in places:
        for k in range(x.count):
            begin = x.at + k * x.length
            at, end = max(begin, x.gap_at), min(begin + x.length, x.gap_end or x.gap * x.count)
            while at < end:
                nth = (at - x.gap_at) // x.gap
                to = min(end, x.gap_at + (nth + 1) * x.gap)
                yield x.length, x.rank + k, at - begin, to - at, x.sequence + nth, x.offset + (at - x.gap_at) % x.gap
                at = to


def test_every_token_has_one_place_and_none_is_padded():
    chance = random.Random(2)
    for _ in range(300):
        window = chance.choice([4, 16, 128])
        counts = some_counts(chance, window)
        places, sequences = p.plan(dict(counts), window)
        tokens, held = Counter(), {}
        for length, rank, start, size, sequence, offset in laid_out(places):
            tokens.update((length, rank, start + k) for k in range(size))
            held.setdefault(sequence, []).append((offset, size))
        assert tokens == Counter((n, rank, k) for n, c in counts.items() for rank in range(c) for k in range(n))
        assert sorted(held) == list(range(sequences))
        short = []
        for parts in held.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at <= window
            if at < window:
                short.append(at)
        assert all(n & (n - 1) == 0 for n in short)
        assert len(short) == len(set(short)) and sum(short) < window


@pytest.mark.parametrize("most", [10**2, 10**5, 10**9])
def test_a_corpus_of_any_size_has_a_short_plan(most):
    chance = random.Random(3)
    counts = {n: chance.randint(1, most) for n in range(1, 1024)}
    places, sequences = p.plan(counts, 1024)
    total = sum(n * c for n, c in counts.items())
    assert sequences == total // 1024 + (total % 1024).bit_count()
    assert len(places) < 6 * 1024


def test_most_short_documents_stay_whole():
    chance = random.Random(4)
    counts = Counter(min(1023, max(1, int(chance.expovariate(1 / 300)))) for _ in range(20_000))
    places, _ = p.plan(dict(counts), 1024)
    assert sum(1 for _ in laid_out(places)) < 1.1 * counts.total()


@pytest.mark.parametrize("window", [16, 1024])
def test_odd_documents(odd, library, window):
    got = p.pack_documents(odd, PATH, window).collect()
    wanted = [library.encode(r.text or "", add_special_tokens=False).ids + [0] for r in odd.collect()]
    keys = Counter(r.doc_id for r in odd.collect())
    total, sequences, whole = 0, {}, Counter()
    for r in got:
        ids = struct.unpack(f"<{r.length}I", r.ids)
        total += len(ids)
        whole[r.doc_id] += r.length / r.doc_tokens
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert any(tuple(w[r.start : r.start + r.length]) == ids and len(w) == r.doc_tokens for w in wanted)
    assert total == sum(map(len, wanted))
    assert {k: round(v) for k, v in whole.items()} == keys
    short = []
    for held in sequences.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        short += [at] if at < window else []
    assert all(n & (n - 1) == 0 for n in short) and sum(short) < window


def test_empty_table(none):
    assert p.pack_documents(none, PATH).count() == 0


def test_other_kinds_of_key_and_a_hot_length(spark, library):
    df = spark.createDataFrame([(f"k{i % 7}", "the same text") for i in range(3000)], "key string, body string")
    got = p.pack_documents(df, PATH, 64, key="key", text="body").collect()
    n = len(library.encode("the same text").ids) + 1
    assert sum(r.length for r in got) == 3000 * n
    assert len({r.sequence_id for r in got}) <= 3000 * n / 64 + 6
    assert {r.doc_tokens for r in got} == {n}


def test_query_against_the_library(spark, library):
    from tabloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = {k: library.encode(t or "", add_special_tokens=False).ids + [0] for k, t in texts.items()}
    got = QUERIES["op11_pattern_packing"](spark, folder).collect()
    ends, sums = {}, Counter()
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        assert r.start == ends.get(r.doc_id, 0)
        ends[r.doc_id] = r.start + r.length
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
        assert r.doc_tokens == len(ids[r.doc_id])
        sums[r.sequence_id] += r.length
    assert ends == {k: len(v) for k, v in ids.items()}
    assert all(n == 1024 or n & (n - 1) == 0 for n in sums.values())
    assert len(sums) <= sum(ends.values()) // 1024 + 10

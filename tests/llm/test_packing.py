import json
import random
import re
import struct
import zlib
from itertools import combinations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabloom.llm import bpe
from tabloom.llm import packing as p
from tabloom.llm.bpe import load

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def filled(runs):
    """(offset, length) of the pieces of each sequence."""
    found = {}
    for r in runs:
        for k in range(r.pieces):
            found.setdefault(r.sequence + k // r.per, []).append((r.offset + k % r.per * r.length, r.length))
    return found


def fewest(sizes, capacity):
    """The least number of sequences, by trying everything."""
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values():
            go(i + 1, [r - sizes[i] * (j == k) for j, r in enumerate(rooms)])
        go(i + 1, [*rooms, capacity - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    go(0, [])
    return best


def test_plans_hold_every_piece_without_gaps():
    chance = random.Random(1)
    for _ in range(200):
        capacity = chance.choice([7, 20, 100])
        counts = {}
        for _ in range(chance.randint(1, 150)):
            size = chance.randint(1, capacity)
            counts[size] = counts.get(size, 0) + chance.choice([1, 1, 4])
        runs, found = p.plan(dict(counts), capacity), {}
        for r in runs:
            found[r.length] = found.get(r.length, 0) + r.pieces
        assert found == counts
        sequences = filled(runs)
        assert sorted(sequences) == list(range(len(sequences)))
        for held in sequences.values():
            at = 0
            for offset, size in sorted(held):
                assert offset == at
                at += size
            assert at <= capacity


def test_what_dominance_fixes_is_in_a_best_packing():
    chance = random.Random(2)
    fixed = 0
    for _ in range(300):
        sizes = [chance.randint(2, 20) for _ in range(chance.randint(2, 8))]
        rest = p._Instance({s: sizes.count(s) for s in sizes}, 20)
        p.reduce_by_dominance(rest)
        left = [s for s, n in rest.left.items() for _ in range(n)]
        fixed += len(sizes) - len(left)
        assert rest.sequences + fewest(left, 20) == fewest(sizes, 20)
    assert fixed > 1000


def test_best_pair():
    chance = random.Random(3)
    for _ in range(300):
        sizes = [chance.randint(1, 15) for _ in range(chance.randint(1, 8))]
        rest = p._Instance({s: sizes.count(s) for s in sizes}, 40)
        without = chance.choice(sizes)
        others = list(sizes)
        others.remove(without)
        room = chance.randint(1, 30)
        wanted = max((a + b for a, b in combinations(others, 2) if a + b <= room), default=0)
        assert rest.best_pair(room, (without,)) == wanted


def pieces_of(library, key, text, window=1024):
    ids = library.encode(text or "", add_special_tokens=False).ids + [2]
    first = len(ids) % window or window
    cuts = [0, *range(first, len(ids) + 1, window)]
    return [(key, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


@pytest.mark.parametrize("window", [16, 1024])
def test_odd_documents(odd, library, window):
    got = p.pack(p.token_pieces(odd, PATH, window), window).collect()
    wanted = [x for r in odd.collect() for x in pieces_of(library, r.doc_id, r.text, window)]
    rows = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got]
    assert sorted(rows, key=str) == sorted(wanted, key=str)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= window
    assert len(sequences) <= 1.1 * sum(r.length for r in got) / window + 1


def test_empty_table(none):
    assert p.pack(p.token_pieces(none, PATH)).count() == 0


def test_pieces_keep_columns_that_clash(spark):
    df = spark.createDataFrame([(3, "a", 1), (4, "b", 2), (3, "c", 3)], "length bigint, row string, rank int")
    got = p.pack(df, window=7)
    assert got.columns == ["length", "row", "rank", "sequence_id", "offset"]
    assert {(r.row, r.rank) for r in got.collect()} == {("a", 1), ("b", 2), ("c", 3)}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_ids_equal_the_library(spark, library, folder):
    bpe = load(PATH)
    for r in spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("text").collect():
        assert bpe.encode(r.text).tolist() == library.encode(r.text, add_special_tokens=False).ids


def test_ids_of_every_kind_of_character(library):
    chance = random.Random(4)
    bpe = load(PATH)
    pools = [range(0x20, 0x7F), range(1, 0x250), range(0x370, 0x600), range(0x2000, 0x2070), range(0x3000, 0x3100), range(0x1F600, 0x1F640)]
    for _ in range(2000):
        pool = chance.choice(pools)
        text = "".join(chr(chance.choice(pool)) for _ in range(chance.randint(0, 40))).replace("~", "<|endoftext|>")
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text).tolist() == ids
        assert bpe.decode(bpe.encode(text)) == library.decode(ids, skip_special_tokens=False)


LONG_RUNS = [" " * 2_000_000, "\n" * 2_000_000, "a" + " \u3000" * 600_000 + "b  c", "\t" * 1_200_000 + "<|endoftext|>" + "\r\n" * 600_000 + "é"]


@pytest.mark.parametrize("text", LONG_RUNS, ids=["blanks", "newlines", "inside", "special"])
def test_long_runs_of_white_space(library, text):
    assert load(PATH).encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


WHITE = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x180E, 0x200A, 0x200B, 0x2028, 0x202F, 0x205F, 0x3000]


@pytest.mark.parametrize("blank", [chr(c) for c in WHITE])
def test_runs_of_every_white_space(library, monkeypatch, blank):
    monkeypatch.setattr(bpe, "_LONG", 2)
    monkeypatch.setattr(bpe, "_RUN", re.compile(bpe._RUN.pattern.replace("{100000,}", "{2,}")))
    for text in (blank * 5, f"a{blank * 5}b", f"{blank * 3}'s {blank}1", f"x{blank * 2}<|endoftext|>{blank * 2} é"):
        assert load(PATH).encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_document_of_white_space_is_packed(spark, library):
    rows = [(k, f"Some text {k}.{run}And more.") for k, run in enumerate([" " * 2_000_000, "\n" * 2_000_000])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in p.pack(p.token_pieces(df, PATH)).collect()]
    assert sorted(got) == sorted(x for key, text in rows for x in pieces_of(library, key, text))


def changed_file(tmp_path, change):
    spec = json.load(open(PATH, encoding="utf-8"))
    change(spec)
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    return str(path)


def swapped(spec):
    """Two merges in the other order: other ids for the same texts."""
    merges = spec["model"]["merges"]
    merges[300], merges[301] = merges[301], merges[300]


def lacking(spec):
    spec["model"]["merges"].pop()


def unknown(spec):
    spec["model"]["merges"][0] = ["no such", "token"]


@pytest.mark.parametrize("change", [swapped, lacking, unknown])
def test_a_file_whose_ids_do_not_follow_its_merges_is_refused(tmp_path, change):
    with pytest.raises(ValueError, match="merges"):
        load(changed_file(tmp_path, change))


def test_merge_loop_by_ids_makes_each_token_as_the_file_does():
    """Each token's own bytes end in the two parts that the file names, by the merges before its own."""
    spec = json.load(open(PATH, encoding="utf-8"))["model"]
    vocabulary, merges = spec["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["merges"]]
    for left, right in merges[::7]:
        limit, parts = vocabulary[left + right], list(left + right)
        while len(parts) > 2:
            found = [(vocabulary.get(a + b, limit), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, k = min(found)
            assert rank < limit
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert parts == [left, right]

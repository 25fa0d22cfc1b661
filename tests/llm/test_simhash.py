import re

import numpy as np
import pytest
import xxhash

from tabloom.llm import simhash as s
from tabloom.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF_DIR = "/root/testdata/sf0.01"


def fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    """(doc_id, fingerprint, least doc_id of the group) of every row."""
    prints = np.array([fingerprint(t) for _, t in rows], np.uint64)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= radius):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    order = lambda x: (x[0] is None, x)
    return sorted(((k, int(p), least.get(root(i))) for i, ((k, _), p) in enumerate(zip(rows, prints))), key=order)


def found(df):
    rows = [(r.doc_id, r.fingerprint & (2**64 - 1), r.component_id) for r in s.near_duplicates(df).collect()]
    return sorted(rows, key=lambda x: (x[0] is None, x))


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == brute(rows)


def test_odd_documents(odd):
    assert found(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_empty_table(none):
    assert s.near_duplicates(none).count() == 0
    assert s.one_per_group(none).count() == 0


def test_one_row_stays_per_group(odd):
    kept = s.one_per_group(odd)
    assert kept.columns == odd.columns
    groups = {c for _, _, c in found(odd)}
    assert {r.doc_id for r in kept.collect()} == groups


def test_near_copies_without_keys_are_one(spark):
    """Rows without a key are of their groups too; keys that repeat are told apart by their texts."""
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(None, long), (None, long + " x"), (None, long), (7, "short text of its own"), (7, long), (9, long)]
    rows += [(None, "nobody has this one"), (None, "nobody has this one"), (7, "short text of its own")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    prints = {r.fingerprint for r in s.fingerprints(df).collect()}
    got = sorted((str(r.doc_id), r.text[:6]) for r in s.one_per_group(df).collect())
    assert len(prints) == 4 and bin(s_print(s, long) ^ s_print(s, long + " x")).count("1") <= 2
    assert got == [("7", "short "), ("7", "word0 "), ("None", "nobody")]


def s_print(module, text):
    words = text.split()
    hashes = [xxhash.xxh64(" ".join(words[i : i + 3]).encode(), 42).intdigest() for i in range(len(words) - 2)]
    return int(module.majority(np.array(hashes, np.uint64).view(np.int64)))


@pytest.mark.parametrize("tile_rows", [3, 50, 4096])
def test_every_link_is_found_whatever_the_tiles(spark, tile_rows):
    """Fingerprints that cluster: a chain of single bits, a ball around one point, and others far away."""
    rng = np.random.default_rng(5)
    far = [int(x) for x in rng.integers(0, 2**63, 60, dtype=np.uint64)]
    ball = [far[0]] + [far[0] ^ (1 << i) ^ (1 << j) for i in range(0, 24) for j in range(i, 24)]
    chain = [far[1]]
    for bit in range(0, 60, 2):
        chain.append(chain[-1] ^ (3 << bit))
    values = sorted({x & (2**64 - 1) for x in far + ball + chain})
    signed = [x - 2**64 if x >= 2**63 else x for x in values]
    nodes = spark.createDataFrame([(x,) for x in signed], "fingerprint bigint").repartition(4)
    parent = {x: x for x in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    array = np.array(values, np.uint64)
    for x in values:
        for y in array[np.bitwise_count(array ^ np.uint64(x)) <= 2]:
            a, b = root(x), root(int(y))
            parent[max(a, b)] = min(a, b)
    wanted = {frozenset(v for v in values if root(v) == r) for r in {root(v) for v in values}}
    edges = s.links(nodes, tile_rows=tile_rows).collect()
    linked = {x: x for x in signed}

    def top(x):
        while linked[x] != x:
            x = linked[x]
        return x

    for e in edges:
        a, b = top(e.a), top(e.b)
        linked[max(a, b)] = min(a, b)
    got = {frozenset(v & (2**64 - 1) for v in signed if top(v) == t) for t in {top(v) for v in signed}}
    assert got == wanted


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(7, 7), (9, 8)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    wanted = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 700)} | {8: 8, 9: 8}
    assert got == wanted


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0

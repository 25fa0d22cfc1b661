import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabloom.llm import pair_search as p

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return [x.translate(LOWER) for x in TERM.findall(text or "")]


def brute(documents, items, k=20):
    """(item, rank, key, score) by scoring every document for every item; keys may be null."""
    read = [(key, Counter(plain_terms(text))) for key, text in documents]
    sizes = [sum(c.values()) for _, c in read]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in read for t in c)
    found = []
    for item, text in items:
        scores = []
        for (key, held), n in zip(read, sizes):
            score = 0
            for term in plain_terms(text):
                if tf := held.get(term):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 25 + (25 * n * n_docs) // total
                    score += w * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score:
                scores.append((-score, key is None, key or 0, key))
        scores.sort(key=lambda s: s[:3])
        found += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(scores[:k], 1)]
    return found


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def frames(spark, documents, items, parts=4):
    return (
        spark.createDataFrame(documents, "doc_id bigint, text string").repartition(parts),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )


def test_terms():
    for text in [None, "", "Ab-cd_E9 x'y", "É é ß İ ñ 日本語 🙂 a b c\x85d", "\x00a\x7fb\x80c", "1,2;3"]:
        assert [t.decode() for t in p.terms_of(text)] == plain_terms(text)


def test_odd_documents(spark, odd):
    texts = ["the quick brown FOX", None, "", "nowhere", "line two one one", "word é 日本語", "text"]
    items = list(zip([0, 1, 2, 3, 4, 0, None], texts))
    documents = [(r.doc_id, r.text) for r in odd.collect()]
    _, asked = frames(spark, [(1, "")], items)
    for limit in (1, 3, 4096):
        got = p.search(p.build_index(odd, block_documents=limit), asked)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert rows_of(got) == sorted(brute(documents, items), key=str)


def random_corpus(chance, n, words=60):
    vocabulary = [f"w{i}" for i in range(words)]
    pick = lambda: vocabulary[min(words - 1, int(chance.expovariate(0.08)))]
    documents = [(i, " ".join(pick() for _ in range(chance.randint(0, 30)))) for i in range(n)]
    # copies are ties, a third of all rows
    documents += [(n + i, documents[7][1]) for i in range(n // 2)]
    items = [(i, " ".join(pick() for _ in range(chance.randint(1, 12)))) for i in range(30)]
    return documents, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_corpora(spark, monkeypatch, seed):
    monkeypatch.setattr(p, "_SHARE", 3)
    documents, items = random_corpus(random.Random(seed), 400)
    frame, asked = frames(spark, documents, items)
    got = p.search(p.build_index(frame, block_documents=25), asked, k=5)
    assert rows_of(got) == sorted(brute(documents, items, 5), key=str)


def test_slices_of_items(spark, monkeypatch):
    monkeypatch.setattr(p, "_QUERIES_AT_ONCE", 7)
    documents, items = random_corpus(random.Random(4), 100)
    frame, asked = frames(spark, documents, items)
    assert rows_of(p.search(p.build_index(frame), asked)) == sorted(brute(documents, items), key=str)


def test_empty_tables(spark, none):
    documents, asked = frames(spark, [(1, "a b")], [(1, "a")])
    assert p.search(p.build_index(none), asked).count() == 0
    assert p.search(p.build_index(documents), asked.where("false")).count() == 0
    blank, _ = frames(spark, [(1, None), (2, "--")], [(1, "a")])
    assert p.search(p.build_index(blank), asked).count() == 0


def test_text_keys_with_ties(spark):
    rows = [(k, "same text") for k in ["b", "é", "a", None, "B", "zz"]] + [("x", "other")]
    index = p.build_index(spark.createDataFrame(rows, "name string, body string"), "name", "body", block_documents=2)
    items = spark.createDataFrame([("q", "same"), ("r", "none")], "item string, text string")
    got = p.search(index, items, k=5, item="item", key="name").collect()
    assert [r.name for r in sorted(got, key=lambda r: r["rank"])] == ["B", "a", "b", "zz", "é"]


def blocks_of(documents, items, limit):
    """A log and its blocks, without Spark."""
    batch = pa.record_batch({"key": pa.array([k for k, _ in documents]), "text": pa.array([t for _, t in documents])})
    built = list(p._index(iter([batch]), limit, 1 << 20))
    held = Counter(t for _, text in documents for t in set(p.terms_of(text)))
    terms = sorted({t for _, text in items for t in p.terms_of(text)} & set(held))
    place = {t: i for i, t in enumerate(terms)}
    n_docs, total = sum(bool(p.terms_of(t)) for _, t in documents), sum(len(p.terms_of(t)) for _, t in documents)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) for t in terms])
    queries, pairs = [], set()
    for number, text in items:
        own = Counter(place[t] for t in p.terms_of(text) if t in place)
        chosen = sorted(own, key=lambda k: (-weights[k], k))
        pairs.update((min(x), max(x)) for x in zip(chosen, chosen[1:]))
        queries.append((number, np.array(chosen, int), np.array([own[k] for k in chosen], np.int64)))
    log = p.Log(terms, weights, sorted(pairs), queries, n_docs, total)
    named = [b.append_column("block", pa.array([i])) for i, b in enumerate(built)]
    return log, [p.Block(b, 0) for b in p._impacts(iter(named), log)]


def test_bounds_hold_and_pairs_make_them_tighter():
    """No document gets more than the bound of any first terms; with pairs less is looked at, for the same result."""
    documents, items = random_corpus(random.Random(6), 600, words=400)
    log, blocks = blocks_of(documents, items, 100)
    numbers = {pair: i for i, pair in enumerate(log.pairs)}
    work, sums = {True: Counter(), False: Counter()}, Counter()
    for _, terms, times in log.queries:
        floor = 0
        for block in blocks:
            for paired in (True, False):
                chain = p.chain_of(block, numbers, terms, times, paired)
                everything = np.zeros(len(block.keys), np.int64)
                for (postings, n), reach in zip(chain.parts, chain.reach[1:]):
                    everything[postings.ordinals] += postings.impacts * n
                    assert everything.max() <= reach
                sums[paired] += sum(chain.reach)
                at, scores = p.best_in(chain, len(block.keys), 3, floor, work[paired])
                best = np.sort(everything)[::-1][:3]
                assert (everything[at] == scores).all()
                assert sorted(scores.tolist(), reverse=True) == [x for x in best if x >= max(floor, 1)]
            floor = max(floor, int(best[-1]))
    assert sums[True] < 0.9 * sums[False]
    assert work[True]["added"] < work[False]["added"]
    assert work[True].total() < work[False].total()


def test_damping_of_lengths_beyond_a_machine_word():
    lengths = np.array([0, 5, 10**6], np.int64)
    documents, total = 10**12, 10**15
    assert p._damping(lengths, documents, total).tolist() == [75 + 25 * n * documents // total for n in lengths.tolist()]

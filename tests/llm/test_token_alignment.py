import base64
import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel

from tabloom.llm import token_alignment as t

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Token bytes of both sides for a text, by the libraries named."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    ranks = {
        int(n): base64.b64decode(token)
        for token, n in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))
    }

    def of_b(i):
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        whole = b" " + (text or "").encode()
        a = [(i, ranks[i]) for i in tokenizer.encode(f" {text or ''}", add_special_tokens=False).ids]
        b = [(i, of_b(i)) for i in model.encode(text or "")]
        same = all(b"".join(x for _, x in side) == whole for side in (a, b))
        return (a, b) if text and same else ([], [])

    return tokens


def brute(rows, tokens):
    """All columns of all rows, from every two tokens that overlap."""
    documents, held = [], Counter()
    for key, text in rows:
        spans = []
        for side in tokens(text):
            at, found = 0, []
            for i, token in side:
                found.append((at, at + len(token), i))
                at += len(token)
            spans.append(found)
        a, b = spans
        links, k = [], 0
        for s, e, i in a:
            while k < len(b) and b[k][1] <= s:
                k += 1
            j = k
            while j < len(b) and b[j][0] < e:
                links.append((i, b[j][2]))
                j += 1
        both = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        short = len(a) < 3000
        groups, low = [], 0
        for end in both if short else []:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= end) for side in spans))
            low = end
        documents.append((key, len(a), len(b), len(both), links, ";".join(groups) if short else None))
        held.update(set(links))
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    sums = lambda links: (len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links))
    return [(*counts, *sums(links), groups) for *counts, links, groups in documents]


def rows_of(df):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in df.collect()]


def same(got, wanted):
    """Equal rows; the groups of very long texts are told by the other columns."""
    assert len(got) == len(wanted)
    numbers = lambda rows: sorted((r[:-1] for r in rows), key=str)
    assert numbers(got) == numbers(wanted)
    shown = {r[-1] for r in got}
    assert all(r[-1] in shown for r in wanted if r[-1] is not None)


ODD = [
    "a ▁ b",
    "▁",
    "<|endoftext|> and <s> and </s> <unk> <0x41>",
    "tab\tnew\nline\r\n  two  blanks   ",
    " starts with a blank",
    "     ",
    "\x00\x01 nul",
    "é ﬁ ① Ａ 　 ​ ﻿",
    "日本語の文章 🙂👍🏽",
]


@pytest.mark.parametrize("links", [1, 500, 1 << 22])
def test_odd_documents(spark, odd, plain, links):
    documents = odd.select("doc_id", "text").unionByName(
        spark.createDataFrame([(100 + i, x) for i, x in enumerate(ODD)], "doc_id bigint, text string")
    )
    corpus = t.align_corpus(documents, A, B, block_links=links)
    same(rows_of(t.document_alignments(corpus)), brute([(r.doc_id, r.text) for r in documents.collect()], plain))


def test_extra_columns_do_not_matter(odd):
    paths = (A, B)
    some = t.document_alignments(t.align_corpus(odd, *paths, digest=True))
    assert some.columns == ["doc_id", *t._COLUMNS[1:]]
    without = t.document_alignments(t.align_corpus(odd.select("doc_id", "text"), *paths, digest=True))
    assert sorted(map(str, some.collect())) == sorted(map(str, without.collect()))


def test_empty_table(none):
    corpus = t.align_corpus(none, A, B)
    assert t.document_alignments(corpus).count() == 0
    assert corpus.pairs.count() == 0


def test_only_texts_without_tokens(spark):
    documents = spark.createDataFrame([("x", None), (None, ""), ("y", "▁")], "doc_id string, text string")
    got = rows_of(t.document_alignments(t.align_corpus(documents, A, B, digest=True)))
    assert sorted(got, key=str) == sorted([(k, 0, 0, 0, 0, 0, 0, "") for k in ("x", None, "y")], key=str)


def test_counts_of_pairs(spark, plain):
    """Documents and links of every pair, one of them a third of all links."""
    texts = ["the cat", "the the the dog", "The the"] * 50 + ["unrelated words of another kind"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    corpus = t.align_corpus(documents, A, B, block_links=64)
    held, links = Counter(), Counter()
    for text in texts:
        a, b = plain(text)
        spans = []
        for side in (a, b):
            ends = np.cumsum([len(x) for _, x in side])
            spans.append([(e - len(x), e, i) for e, (i, x) in zip(ends, side)])
        own = [(i, j) for s, e, i in spans[0] for u, v, j in spans[1] if s < v and u < e]
        held.update(set(own))
        links.update(own)
    got = {(r.a_id, r.b_id): (r.documents, r.links, r.best) for r in corpus.pairs.collect()}
    best = {i: max(n for (k, _), n in held.items() if k == i) for i, _ in held}
    assert got == {x: (held[x], links[x], held[x] == best[x[0]]) for x in held}


def test_planes_give_back_sums():
    """Bitmaps as lists and as bits, over several planes, against a dictionary."""
    chance = random.Random(5)
    for n in (1, 7, 40, 900):
        pairs = np.array([min(60, int(chance.expovariate(0.1))) for _ in range(4000)], np.int64)
        documents = np.array([chance.randrange(n) for _ in pairs], np.int64)
        distinct, counts, links, planes = t.invert(pairs, documents, n)
        held = Counter(zip(pairs.tolist(), documents.tolist()))
        assert distinct.tolist() == sorted(set(pairs.tolist()))
        assert counts.tolist() == [sum(p == x for p, _ in held) for x in distinct.tolist()]
        assert links.tolist() == [sum(c for (p, _), c in held.items() if p == x) for x in distinct.tolist()]
        scores = np.array([[chance.randrange(1000) for _ in distinct] for _ in range(2)], np.int64)
        place = {x: k for k, x in enumerate(distinct.tolist())}
        for row, score in zip(t.returned(planes, scores, n), scores):
            assert row.tolist() == [sum(c * score[place[p]] for (p, d), c in held.items() if d == k) for k in range(n)]


def test_token_bytes_are_those_of_the_files():
    found = t.aligner(A, B)
    vocabulary = json.load(open(A))["model"]["vocab"]
    decoder = ByteLevel()
    for token, i in list(vocabulary.items())[::97]:
        if token != "<|endoftext|>" and "�" not in (shown := decoder.decode([token])):
            assert found.a_lengths[i] == len(shown.encode())
    assert found.b_bytes[3] == b"\0" and found.b_bytes[259] == b"  "


def test_query_against_brute_force(spark, plain):
    from tabloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = QUERIES["op12_pair_bitmaps"](spark, folder).withColumnRenamed("groups_sha256", "groups")
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest() if s else s
    same(rows_of(got), [(*r[:-1], digest(r[-1])) for r in brute(rows, plain)])

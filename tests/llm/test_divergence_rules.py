import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabloom.llm import divergence_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(wins)
    covered = {j for i, w in enumerate(wins) if often[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_odd_documents_against_brute_force(odd):
    for r in q.assess(odd, "found").collect():
        f = r.found
        n_words, chars, symbols, lines, repeats = base(r.text)
        assert (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words) == (n_words, chars, symbols, lines, repeats)
        assert f.base_failed == (n_words < 50 or 100 * repeats > 50 * n_words)
        assert not (f.base_failed and f.kept)


@pytest.mark.parametrize("text", ["a b c a b c", "a b a b a b a", "x " * 9, "a b c d a b c e b c d"])
def test_repeated_windows(spark, text):
    got = spark.createDataFrame([(text,)], "text string").select(q.quality_of("text")["n_repeat_words"]).first()[0]
    assert got == base(text)[4]


def test_rows_keep_their_columns(odd, none):
    assert q.passing(odd).columns == odd.columns
    assert q.passing(none).count() == 0


def test_labels_agree(spark):
    """Of labelled documents that pass the base rules, none of good quality goes and most of the others do."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(
        spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id"
    )
    found = q.assess(docs, "found").where("not found.base_failed").groupBy("label").agg(F.avg(F.col("found.kept").cast("int")))
    shares = dict(found.collect())
    assert shares[1] == 1.0
    assert shares[0] < 0.2


def test_short_texts_are_not_compared(spark):
    text = "ZZZZ QQQQ " * 30
    strict, guarded = q.Limits(least_characters=0, least_words=0), q.Limits(least_characters=10_000, least_words=10_000)
    df = spark.createDataFrame([(" ".join(f"{w}{i}" for i, w in enumerate(text.split())),)], "text string")
    assert not df.select(q.quality_of("text", strict)["kept"]).first()[0]
    assert df.select(q.quality_of("text", guarded)["kept"]).first()[0]

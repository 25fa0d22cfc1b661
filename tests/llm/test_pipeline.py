import os
import re

import pytest

import corpus_pipeline as pipeline
from llm.test_digest_index import digest
from llm.test_divergence_rules import base
from llm.test_packing import PATH, library, pieces_of  # noqa: F401
from llm.test_personal_data import of_base
from llm.test_simhash import brute
from tabloom.durable import shared_folder, workspace

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage returned over the documents, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found.append(docs)
    return found


def test_all_but_the_last_return_the_columns_of_documents(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_rules(steps):
    before, after = texts(steps[0]), texts(steps[1])
    failed = {k for k, t in before.items() if (b := base(t))[0] < 50 or 100 * b[4] > 50 * b[0]}
    assert set(after) <= set(before) - failed
    assert len(after) > 0.9 * (len(before) - len(failed))


def test_exact(steps):
    before, after = texts(steps[1]), texts(steps[2])
    top = {}
    for key, text in before.items():
        top[digest(text)] = max(key, top.get(digest(text), key))
    assert after == {k: before[k] for k in top.values()}


def test_near(steps):
    before, after = texts(steps[2]), texts(steps[3])
    assert set(after) == {component for *_, component in brute(list(before.items()))}


def test_masks(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert before.keys() == after.keys()
    for key, text in before.items():
        if not of_base(text):
            assert after[key] == text or re.search(r"\[(IBAN|SSN|SHORT_CARD|LOCAL_PHONE)\]", after[key])
        else:
            assert not [s for s in of_base(after[key]) if after[key][s[1] : s[2]] in text]


def test_packs(steps, library):  # noqa: F811
    wanted = [x for k, t in texts(steps[4]).items() for x in pieces_of(library, k, t)]
    got = steps[5].collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(wanted)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in held) <= 1024 for held in sequences.values())


def test_odd_documents_pass_through(spark, odd):
    docs = odd
    for _, stage in pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() > 0


def test_run_leaves_what_its_result_is_read_from(spark, steps):
    """The rows of the stages' run by hand; of tables the last stage's alone, and in a workspace none."""
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    got = pipeline.run(spark, SF_DIR)
    columns = [c for c in got.columns if c not in ("sequence_id", "offset")]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, steps[5].select(columns).collect()))
    left = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert left <= {"pieces", "numbered", "pipeline"}
    before = set(os.listdir(folder))
    with workspace(spark):
        assert pipeline.run(spark, SF_DIR).count() > 0
    assert set(os.listdir(folder)) == before


def test_very_long_numbers_pass_through(spark):
    text = " ".join(f"word{i} {'0' * 10_000}{i}.1.1.1" for i in range(20)) + f" {'0' * 1_000_000}1.2.3.4 " + "end " * 3
    docs = spark.createDataFrame([(1, text, "en", "s", len(text))], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF_DIR)
        if name == "mask_personal_data":
            assert docs.first().text.count("[IP]") == 21
    assert docs.count() > 0


def test_empty_table(spark, none):
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, SF_DIR).count() == 0

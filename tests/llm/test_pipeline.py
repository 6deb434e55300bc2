"""Each stage by itself against plain rules, and the whole against its stages."""

from __future__ import annotations

import pytest

import corpus_pipeline
from stratoform.llm import decontaminate, pii, toxicity
from stratoform.llm.decontaminate import words_of_item
from test_jaccard import brute_kept


@pytest.fixture(scope="module")
def folder(sf_dir):
    return sf_dir


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [(None, docs.columns, docs.collect())]
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        function(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs.columns, docs.collect()))
    return out


def ids(step):
    return {r.doc_id for r in step[2]}


def test_stages_and_columns(steps):
    assert [s[0] for s in steps[1:]] == ["toxicity", "near_copies", "decontamination", "personal_data", "mixing"]
    assert all(s[1] == steps[0][1] for s in steps[:-1])
    assert steps[-1][1] == [*steps[0][1], "mix_taken", "mix_parts"]
    for before, after in zip(steps, steps[1:], strict=False):
        assert ids(after) <= ids(before) and len(after[2]) == len(ids(after))


def test_toxicity_keeps_clean_documents(spark, folder, steps):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    gone = ids(steps[0]) - ids(steps[1])
    clean = {d for d, t in labels.items() if t == 0}
    assert len(gone & clean) <= 0.1 * len(clean)


def test_one_document_of_each_group_stays(steps):
    """By comparing all pairs: five-word shingles, similar by 0.8."""
    assert ids(steps[2]) == set(brute_kept([(r.doc_id, r.text) for r in steps[1][2]]))


def test_benchmark_documents_go(spark, folder, steps):
    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = words_of_item(r.text.encode())
        windows |= {tuple(w[i : i + 10]) for i in range(len(w) - 9)} or {tuple(w)}
    for r in steps[2][2]:
        w = words_of_item(r.text.encode())
        hit = any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))
        assert hit == (r.doc_id not in ids(steps[3]))


def test_personal_data_is_replaced(steps):
    before = {r.doc_id: r.text for r in steps[3][2]}
    assert ids(steps[4]) == set(before)
    for r in steps[4][2]:
        assert r.n_chars == len(r.text)
        assert not any(pii.base_spans(r.text)[0])
        if r.text == before[r.doc_id]:
            assert not any(pii.base_spans(r.text))
    assert any(r.text != before[r.doc_id] for r in steps[4][2])


def test_the_mix_takes_word_ranges(steps):
    for r in steps[5][2]:
        size = len(r.text.encode().split())
        assert 0 < r.mix_taken <= 3 * size
        assert sum(p.n * p.times for p in r.mix_parts) == r.mix_taken
        assert all(0 <= p.first and p.first + p.n <= size for p in r.mix_parts)


def test_run_equals_its_stages(spark, folder, steps):
    got = corpus_pipeline.run(spark, folder).collect()
    key = lambda r: (r.doc_id, r.text, r.mix_taken)
    assert sorted(map(key, got)) == sorted(map(key, steps[5][2]))


def test_odd_and_empty_tables(spark, frame, folder):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(1, None), (2, ""), (None, good), (None, None), (3, good + " more"), (3, good + " more"), (4, "x " * 9000), (5, None)]
    for df in (frame(rows), frame([])):
        for _, function in corpus_pipeline.STAGES[:-1]:
            out = function(spark, df, folder)
            assert out.columns == df.columns and out.count() <= df.count()
        assert corpus_pipeline.mix_sources(spark, df, folder).columns[:-2] == df.columns
    assert toxicity.keep_clean(frame(rows), None).count() == len(rows)
    assert decontaminate.decontaminate(frame(rows), spark.read.parquet(f"{folder}/benchmark.parquet")).count() == len(rows)

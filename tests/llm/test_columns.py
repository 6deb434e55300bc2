"""Stages return the columns of their input as they came, whatever their names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratoform.llm import decontaminate, exact, jaccard, mixing, pii, simhash, toxicity

NAMES = ["text_hash", "_first", "_row", "_mix", "mix", "mix_row", "sha", "root", "predicted", "contaminated", "n_words", "size", "place", "doc"]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name in NAMES:
        docs = docs.withColumn(name, F.concat(F.lit(f"own {name} "), F.col("doc_id").cast("string")))
    return docs


def stages(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return {
        "toxicity": lambda d: toxicity.keep_clean(d, None),
        "simhash": simhash.keep_one,
        "jaccard": jaccard.keep_one,
        "exact": exact.keep_one,
        "decontaminate": lambda d: decontaminate.decontaminate(d, benchmark),
        "pii": lambda d: pii.redact(d, pii.train(pii.labelled_windows(d))),
        "mixing": mixing.mix,
    }


@pytest.mark.parametrize("name", ["toxicity", "simhash", "jaccard", "exact", "decontaminate", "pii", "mixing"])
def test_columns_stay(spark, sf_dir, docs, name):
    out = stages(spark, sf_dir)[name](docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[c] == f"own {c} {r.doc_id}" for c in NAMES)


def test_a_mix_of_a_mix_replaces_its_columns(docs):
    once = mixing.mix(docs)
    again = mixing.mix(once)
    assert again.columns == once.columns and again.count() > 0

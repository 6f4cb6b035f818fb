"""The pipeline's stages against plain versions of their decisions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm import langid, mixing, secrets
from tests.llm.test_operators import plain_components, plain_fingerprint
from tests.plans import plan_of


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The input of every stage and the last one's result."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], sf_dir).write.parquet(str(folder / name))
        kept.append(spark.read.parquet(str(folder / name)))
    return kept


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_language_goes_by_the_network(stored):
    docs = stored[0]
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    sure = found.where((F.col("lang_pred") != "und") & (F.col("score") >= langid.MIN_SCORE))
    assert texts(stored[1]).keys() == {r["doc_id"] for r in sure.select("doc_id").collect()}
    assert stored[1].count() > 0.95 * docs.count()


def test_one_document_of_each_group_stays(stored):
    before = texts(stored[1])
    groups = plain_components({i: plain_fingerprint(t) for i, t in before.items()})
    assert texts(stored[2]) == {i: before[i] for i in set(groups.values())}


def test_secrets_are_gone_and_all_rows_stay(stored):
    before, after = texts(stored[2]), texts(stored[3])
    assert before.keys() == after.keys()
    again = secrets.scan(stored[3]).where(F.size("found") > 0)
    assert again.isEmpty()
    had = {r["doc_id"] for r in secrets.scan(stored[2]).where(F.size("found") > 0).collect()}
    assert {i for i in before if before[i] != after[i]} == had


def test_mixture_takes_its_shares(stored):
    shares = {r["doc_id"]: r["taken"] for r in mixing.shares(stored[3]).collect()}
    got: dict[int, int] = {}
    for row in stored[4].collect():
        got[row["doc_id"]] = got.get(row["doc_id"], 0) + len(row["text"].split())
    assert got == {i: n for i, n in shares.items() if n}


def test_packing_holds_every_row(stored):
    firsts = stored[5].where("piece = 0").count()
    assert firsts == stored[4].count()
    assert stored[5].agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 4096


def test_native_operators_use_no_python(spark, sf_dir, stored):
    from earshot.llm.registered import QUERIES

    for frame in (QUERIES["op6_secret_scan"](spark, sf_dir), QUERIES["op7_quality"](spark, sf_dir),
                  corpus_pipeline.secrets(spark, stored[2], sf_dir)):
        assert "Python" not in plan_of(frame) and "Arrow" not in plan_of(frame)


def test_stages_are_the_five_dealt():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "secrets", "mixture", "packing"]

"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm import (
    digest,
    langid,
    lm,
    main_text,
    mixing,
    packing,
    quality,
    repeats,
    secrets,
    simhash,
)

SAME = "the cat sat on the mat and then the cat sat on the other mat " * 3
ROWS = [
    (None, "a text that has no id at all but has words", "en", "s", 40),
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, "word and other " * 20_000, "en", None, 300_000),
    (4, SAME, "en", "s", len(SAME)),
    (4, SAME, "en", "s", len(SAME)),
    (5, SAME, "fr", "t", len(SAME)),
    (6, "été 中文 😀 naïve", "fr", "t", 15),
    (7, " \t\n", "fr", "t", 3),
    (8, "12345 !!!", None, "t", 9),
    (9, "x" * 50_000, "en", "t", 50_000),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def scored(docs):
    rows = lm.marked(docs)
    return lm.scored(rows, lm.learn(rows))


def language(docs):
    return langid.predict(docs.select("doc_id", "text"), langid.fit(docs, steps=5))


OPERATORS = {
    "simhash": simhash.near_duplicates,
    "lm": scored,
    "language": language,
    "digest": digest.compared,
    "secrets": secrets.scan,
    "quality": quality.judged,
    "repeats": repeats.stripped,
    "mixing": mixing.shares,
    "packing": packing.packed_documents,
}
CLASHES = ["row", "key", "size", "rank", "words", "found", "fp", "component_id", "text_hash"]
CLASHES += ["score", "lang_pred", "length", "salt", "host", "start", "place", "Pieces", "round"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def with_clashes(frame):
    return frame.select("*", *[F.lit("x").alias(name) for name in CLASHES])


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(odd, name):
    found = OPERATORS[name](odd).collect()
    pieces = sum(row["piece"] > 0 for row in found) if name == "packing" else 0
    assert len(found) - pieces == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(odd, name):
    assert OPERATORS[name](odd.where("doc_id < 0")).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_change_nothing(odd, name):
    clashing = OPERATORS[name](with_clashes(odd))
    plain = OPERATORS[name](odd)
    assert clashing.columns == plain.columns
    assert sorted(map(str, clashing.collect())) == sorted(map(str, plain.collect()))


def by_id(frame):
    return {row["doc_id"]: row for row in frame.collect()}


def test_defined_results(odd):
    prints = by_id(simhash.near_duplicates(odd))
    assert prints[1]["fp"] == prints[2]["fp"] == prints[7]["fp"] == 0
    assert prints[1]["component_id"] == prints[7]["component_id"] == 1
    assert prints[5]["component_id"] == prints[4]["component_id"] == 4
    assert prints[None]["component_id"] is None

    tongues = by_id(language(odd))
    for i in (1, 2, 7, 8):
        assert (tongues[i]["lang_pred"], tongues[i]["score"]) == ("und", 0.0)

    scores = by_id(scored(odd))
    assert scores[1]["n_tokens"] == scores[2]["n_tokens"] == scores[7]["n_tokens"] == 1

    digests = by_id(digest.compared(odd))
    assert digests[1]["fingerprint"] == digests[2]["fingerprint"]
    assert digests[4]["fingerprint"] == digests[5]["fingerprint"]

    left = by_id(repeats.stripped(odd))
    assert (left[1]["n_bytes"], left[1]["n_removed"]) == (0, 0)
    assert left[5]["n_removed"] == left[5]["n_bytes"] == len(SAME)
    assert left[9]["n_removed"] == 50_000 - 1 and left[9]["n_spans"] == 1

    assert not by_id(quality.judged(odd))[1]["kept"]
    assert by_id(mixing.shares(odd))[1]["taken"] == 0
    assert by_id(packing.packed_documents(odd))[1]["length"] == 1


def test_nothing_to_learn_from(odd):
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language(unlabelled).collect()} == {"und"}
    held = lm.marked(odd).withColumn("held_out", F.lit(True))
    for row in lm.scored(held, lm.learn(held)).collect():
        assert row["train_tokens"] == row["n_known"] == 0
        assert row["score"] == row["base_score"] == 0.0


def test_pages(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, "v", "<p>" + "the word " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = main_text.extracted(pages.withColumn("text", F.lit(1))).collect()
    assert sorted(r["n_chars"] for r in found) == [0, 0, 0, 449_999]
    assert main_text.extracted(pages.where("page_id > 9")).collect() == []


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, odd, sf_dir, name, stage):
    for frame in (odd, with_clashes(odd), odd.where("doc_id < 0")):
        out = stage(spark, frame, sf_dir)
        n = out.count()
        if name != "packing":
            assert out.schema.names == frame.schema.names
            assert [f.dataType for f in out.schema] == [f.dataType for f in frame.schema]
        assert (n == 0) == frame.isEmpty()


def test_one_row_of_a_group_stays(spark, odd, sf_dir):
    stay = corpus_pipeline.near_duplicates(spark, odd, sf_dir).collect()
    assert sorted(r["doc_id"] or -1 for r in stay) == [-1, 1, 3, 4, 6, 8, 9]


def test_groups_of_one_id_or_none_stay_apart(spark, sf_dir):
    cat, dog = "the cat sat on the mat with its hat " * 4, "a dog ran over some hills by night " * 4
    sea, sun = "ships go down to cold seas in winter " * 4, "hot suns rise upon dry lands at noon " * 4
    rows = [(None, cat), (None, cat), (None, dog), (7, sea), (7, sun), (7, sun), (None, sun)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    stay = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    expected = [(None, cat), (None, dog), (7, sea), (7, sun)]
    assert sorted(map(str, stay)) == sorted(f"Row(doc_id={i}, text={t!r})" for i, t in expected)

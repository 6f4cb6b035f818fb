"""Quartile digests from their definition, triplet by triplet."""

from __future__ import annotations

import math

import numpy as np
import pytest

from earshot.llm.digest import digest, likeness, op5_digest, written

M32 = (1 << 32) - 1


def plain_digest(data: bytes) -> str:
    buckets = [0] * 256
    for kind, (second, third) in enumerate(((1, 2), (1, 3), (2, 4))):
        for at in range(len(data) - third):
            code = data[at] + (data[at + second] << 8) + (data[at + third] << 16) + (kind << 24)
            code = code * 0x9E3779B1 & M32
            code ^= code >> 15
            code = code * 0x85EBCA77 & M32
            buckets[(code >> 16) % 256] += 1
    ordered = sorted(buckets)
    quarters = ordered[63], ordered[127], ordered[191]
    codes = [sum(n > q for q in quarters) for n in buckets]
    step = min(255, round(math.log(len(data) + 1) / math.log(1.15)))
    bits = int("".join(f"{c:02b}" for c in codes), 2)
    return f"{step:02x}{bits:0128x}"


def plain_likeness(a: str, b: str) -> float:
    def read(text):
        bits = f"{int(text[2:], 16):0512b}"
        return int(text[:2], 16), [int(bits[i : i + 2], 2) for i in range(0, 512, 2)]

    (length_a, codes_a), (length_b, codes_b) = read(a), read(b)
    apart = min(abs(length_a - length_b), 40)
    apart += sum(abs(x - y) for x, y in zip(codes_a, codes_b, strict=True))
    return 1 - min(apart, 256) / 256


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 5, 100, 4097])
def test_a_digest_is_that_of_the_definition(size):
    rng = np.random.default_rng(size)
    data, other = rng.bytes(size), rng.bytes(size // 2 + 3)
    assert written(digest(data)) == plain_digest(data)
    assert likeness(digest(data), digest(other)) == plain_likeness(
        plain_digest(data), plain_digest(other)
    )


def test_the_query_is_that_of_the_definition(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(25)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = {r["doc_id"]: r for r in op5_digest(spark, str(tmp_path)).collect()}
    ids = sorted(texts)
    for this, following in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, after = texts[this], texts[following]
        gone = len(text) // 4
        changed = text[: len(text) - gone] + after[:gone]
        own, edited = plain_digest(text.encode()), plain_digest(changed.encode())
        assert (found[this]["fingerprint"], found[this]["edited_fingerprint"]) == (own, edited)
        assert found[this]["near_edited"] == plain_likeness(own, edited)
        assert found[this]["near_next"] == plain_likeness(own, plain_digest(after.encode()))

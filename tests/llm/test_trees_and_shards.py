"""Conversation trie, sharding and manifest against plain versions, and their odd rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict
from math import comb

import pytest
from pyspark.sql import functions as F

from earshot.llm import manifest, sharding, trie
from earshot.llm.common import kept
from tests.plans import plan_of


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- 11 --------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {
        c: own.get(c - c % 100, [])[: heads[c]] + ts[heads[c] :] for c, ts in own.items()
    }


def plain_nodes(convs):
    """A row per node, found by walking every conversation's prefixes."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, cs in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(cs) - 1) * len(k[-1][1]) if k else 0
    return sorted(
        (
            min(cs),
            len(k),
            min(members[k[:-1]]) if k else -1,
            len(cs),
            children[k],
            leaves[k],
            saved[k],
            sha(",".join(map(str, sorted(ends[k])))),
        )
        for k, cs in members.items()
    )


def nodes_of(frame):
    return sorted(
        (r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, frame.collect())
    )


def rebuilt_trie(spark, rows, **settings):
    turns = kept(trie.numbered_turns(spark.createDataFrame(rows, TURNS)))
    return trie.prefix_trie(kept(trie.prefixes(*trie.with_shared_heads(turns))), **settings)


def test_trie_of_given_conversations(spark, sf_dir):
    rows = [
        tuple(r)
        for r in spark.read.parquet(f"{sf_dir}/conversations.parquet")
        .select("conv_id", "turn", "role", "text")
        .collect()
    ]
    assert nodes_of(trie.op11_prefix_trie(spark, sf_dir)) == plain_nodes(plain_rebuilt(rows))


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie_of_long_hot_and_odd_conversations(spark, band):
    rows = [(7, i, "user", f"turn {i}") for i in range(60)]  # 7, 8 and 9 share what they can
    rows += [(8, i, "user", f"turn {i}" if i < 40 else "other") for i in range(60)]
    rows += [(9, i, "user", f"turn {i}") for i in range(33)]
    rows += [(c, i, "user", "same 😀") for c in range(200, 260) for i in range(3)]
    rows += [(0, None, None, None), (0, 1, "user", ""), (0, 2, None, "x")]  # a short base
    rows += [(301, 0, "a", "base of this one is missing"), (None, 0, "user", "nobody's")]
    rows += [(5, 1, "user", "again")] * 3 + [(400, 1, "ab", "c"), (401, 1, "a", "bc")]
    rows += [(-3, 0, "user", "below zero"), (10**15, 0, "user", "turn 0")]
    assert nodes_of(rebuilt_trie(spark, rows, band=band)) == plain_nodes(plain_rebuilt_of(rows))


def plain_rebuilt_of(rows):
    """As above, with the remainder of a negative id toward zero, as SQL has it."""
    shifted = plain_rebuilt([r for r in rows if r[0] is None or r[0] >= 0])
    negative = {r[0] for r in rows if r[0] is not None and r[0] < 0}
    base = [(r[2] or "", r[3] or "") for r in rows if r[0] == 0]
    for c in negative:
        h = zlib.crc32(str(c).encode()) % 6
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        shifted[c] = base[:h] + own[h:]
    return shifted


def test_trie_of_nothing(spark):
    assert nodes_of(rebuilt_trie(spark, [])) == []
    assert nodes_of(rebuilt_trie(spark, [(None, 1, "user", "x")])) == []


def test_trie_leaves_conversations_alone_if_asked(spark):
    rows = [(c, i, "user", f"{min(c, 2)}-{i}") for c in range(5) for i in range(4)]
    turns = kept(trie.numbered_turns(spark.createDataFrame(rows, TURNS).withColumn("at", F.lit(9))))
    as_are = trie.as_they_are(turns)
    convs = as_are.select("conv_id", "length").distinct()
    plain = {c: [(r[2], r[3]) for r in rows if r[0] == c] for c in range(5)}
    assert nodes_of(trie.prefix_trie(kept(trie.prefixes(as_are, convs)))) == plain_nodes(plain)


def test_ends_of_many_chunks_are_hashed_in_order(spark):
    ends = spark.range(0, 5000, 1, 7).select(
        F.lit(1).cast("long").alias("depth"),
        F.lit(5).cast("long").alias("ka"),
        (F.col("id") % 2).alias("kb"),
        F.col("id").alias("conv_id"),
    )
    got = {r["kb"]: r["ends_sha256"] for r in trie.end_hashes(ends, chunk=7).collect()}
    assert got == {k: sha(",".join(map(str, range(k, 5000, 2)))) for k in (0, 1)}


# -- 12 --------------------------------------------------------------------------


def slots_are_whole(rows, n, shards, shard="shard", slot="slot"):
    found = defaultdict(list)
    for r in rows:
        found[r[shard]].append(r[slot])
    sizes = [len(found[j]) for j in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in found.values())


def test_sharding_of_given_documents(spark, sf_dir):
    docs = {
        r["doc_id"]: r["text"] or ""
        for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    }
    frame = sharding.op12_sharding(spark, sf_dir)
    assert "Python" not in plan_of(frame) and "Arrow" not in plan_of(frame)
    rows = frame.collect()
    slots_are_whole(rows, len(docs), 8)
    assert {r["doc_id"] for r in rows} == docs.keys()
    for r in rows:
        data = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert r["law"] == "rows" and r["grown_shard"] is None
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.op12_sharding(spark, sf_dir).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}


@pytest.mark.parametrize(
    "total, marked, drawn",
    [(10, 4, 5), (50, 20, 7), (7, 7, 3), (7, 0, 3), (1, 1, 1), (0, 0, 0), (300, 37, 150)],
)
def test_draws_are_hypergeometric(spark, total, marked, drawn):
    n = 4000
    numbers = [F.lit(x).cast("long") for x in (total, marked, drawn)]
    chance = (F.col("id") + 0.5) / n
    got = Counter(
        r[0]
        for r in spark.range(n).select(sharding.hypergeometric(*numbers, chance)).collect()
    )
    for k in range(max(0, drawn + marked - total), min(marked, drawn) + 1):
        want = comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn)
        assert abs(got[k] / n - want) <= 1.5 / n
    assert sum(got.values()) == n


def test_matrix_adds_up_and_is_fair(spark):
    sizes = [100, 0, 3, 1000, 7, 7, 50, 1, 12]
    counts = spark.createDataFrame(list(enumerate(sizes)), "part int, n bigint")
    dealt = {r["part"]: r["dealt"] for r in sharding.communication_matrix(counts, 5).collect()}
    assert [sum(dealt[i]) for i in range(len(sizes))] == sizes
    assert [sum(dealt[i][j] for i in dealt) for j in range(5)] == [236] * 5
    # Over seeds, a cell's mean and spread are those of a random permutation.
    pair = spark.createDataFrame([(0, 20), (1, 30)], "part int, n bigint")
    cells = [
        next(r["dealt"][0] for r in sharding.communication_matrix(pair, 2, seed).collect() if not r["part"])
        for seed in range(20)
    ]
    mean = sum(cells) / 20
    assert abs(mean - 10) < 1.5  # standard deviation 1.75, of the mean 0.39
    assert 0.9 < sum((c - mean) ** 2 for c in cells) / 19 < 8


def test_every_row_may_go_anywhere(spark):
    rows = spark.range(0, 40, 1, 5)
    first = Counter()
    for seed in range(12):
        got = sharding.shuffled(rows, 4, seed).collect()
        slots_are_whole(got, 40, 4)
        first.update(r["id"] for r in got if r["shard"] == 0)
    assert len(first) >= 34  # 120 places; 40 rows expect 3 each
    assert max(first.values()) <= 10


def test_shards_of_few_odd_or_no_rows(spark):
    odd = spark.createDataFrame([(None, None)] * 50 + [(1, "x")], "slot bigint, `a.b` string")
    got = sharding.shuffled(odd, 3).collect()
    slots_are_whole(got, 51, 3, slot="_slot")
    assert Counter((r["slot"], r["a.b"]) for r in got) == {(None, None): 50, (1, "x"): 1}
    assert len(sharding.shuffled(odd.limit(2), 8).collect()) == 2
    assert sharding.shuffled(odd.limit(0), 8).collect() == []
    texts = spark.createDataFrame([(None, None), (2, ""), (2, "é" * 100_000)], "doc_id bigint, text string")
    got = {(r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.sized(texts).collect()}
    assert got == {(None, 1, 0), (2, 1, 0), (2, 200_001, zlib.crc32(("é" * 100_000).encode()))}


# -- 13 --------------------------------------------------------------------------


def plain_leaf(row, low=False):
    told = ""
    for name in manifest.FIELDS:
        value = row[name]
        if value is None:
            told += "-"
            continue
        value = str(value)
        if low and name == "text":
            value = "".join(c.lower() if "A" <= c <= "Z" else c for c in value)
        told += f"{len(value.encode())}:{value}"
    return sha(told)


def plain_climb(leaves):
    """The root and each leaf's path: the digests before and after it, level by level."""
    level, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[i : i + 8] for i in range(0, len(level), 8)]
        for i, path in enumerate(paths):
            run, slot = runs[at[i] // 8], at[i] % 8
            path.append((run[:slot], run[slot + 1 :]))
            at[i] //= 8
        level = [sha("".join(run)) for run in runs]
    return level[0], paths


def plain_manifest(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row["lang"]].append((plain_leaf(row), row))
    langs = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    climbed = {}
    for lang in langs:
        trees[lang].sort(key=lambda t: (t[1]["doc_id"] is not None, t[1]["doc_id"] or 0, t[0]))
        climbed[lang] = plain_climb([leaf for leaf, _ in trees[lang]])
    root, tops = plain_climb([climbed[lang][0] for lang in langs]) if langs else (None, [])
    for lang, top in zip(langs, tops, strict=True):
        for (leaf, row), path in zip(trees[lang], climbed[lang][1], strict=True):
            path = path + top
            hit = row["doc_id"] is not None and not zlib.crc32(str(row["doc_id"]).encode()) % 3
            digest = plain_leaf(row, low=hit)
            for before, after in path:
                digest = sha("".join(before) + digest + "".join(after))
            proof = sha("".join(d for before, after in path for d in before + after))
            yield row["doc_id"], leaf, climbed[lang][0], root, proof, digest, digest == root


def in_order(rows):
    return sorted(rows, key=repr)


def test_manifest_of_given_documents(spark, sf_dir):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = [tuple(r) for r in manifest.op13_manifest(spark, sf_dir).collect()]
    assert in_order(got) == in_order(plain_manifest(docs))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 73])
def test_manifest_of_odd_rows(spark, n):
    odd = [
        (None, "No Id", None, "s", 5),
        (3, None, "en", None, None),
        (3, None, "en", None, None),
        (3, "Same Id", "en", "s", 7),
        (4, "", "", "s", 0),
        (5, "É" * 50_000, "-", "s", 1),
        (6, "lone 😀 Leaf", "=x", "s", 11),
    ]
    rows = [(i, f"Text {i}", "de", f"s{i % 3}", i) for i in range(n)] + odd * (n > 0)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema)
    got = manifest.verified_documents(docs.withColumn("tree", F.lit(1)).withColumn("idx", F.lit("a")))
    want = plain_manifest([r.asDict() for r in docs.collect()])
    assert in_order(map(tuple, got.collect())) == in_order(want)


def test_a_flat_manifest_of_another_fan(spark):
    rows = [{"doc_id": i, "lang": "x", "source": "", "n_chars": i, "text": ""} for i in range(5)]
    leaves = [plain_leaf(r) for r in rows]
    frame = kept(
        spark.createDataFrame([(i, "x", leaf) for i, leaf in enumerate(leaves)], "i int, t string, h string")
        .select("i", "t", F.unhex("h").alias("leaf"))
    )
    got = manifest.manifest(frame, "t", [F.col("i")], fan=2)
    a, b = sha(leaves[0] + leaves[1]), sha(leaves[2] + leaves[3])
    root = sha(sha(a + b) + sha(sha(leaves[4])))
    found = got.select("i", manifest.as_text(F.col("root")).alias("root"),
                       manifest.as_text(manifest.folded(F.col("leaf"), F.col("path"))).alias("up"))
    assert {tuple(r) for r in found.collect()} == {(i, root, root) for i in range(5)}

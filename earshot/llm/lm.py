"""An interpolated modified Kneser-Ney model of word pairs, counted in Spark.

Counts meet in Spark, packed: a task sends one row of sorted keys and counts per shard.
The model is sorted hash arrays in the shared folder, one file per shard and field, which
scoring tasks map into memory.  Words are known by a 64-bit hash; their place in the
sorted hashes of all words is their id, and a pair's key is both ids.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.arrays import (
    local_folder,
    mapped,
    mix,
    places,
    power_of_two,
    range_shard,
    runs,
    texts_in_chunks,
)
from earshot.llm.arrays import store as store_array
from earshot.llm.common import kept, read_documents, remainder
from earshot.workspace import scratch_root

FOLDS = 10
# Text that a task works on at a time, in bytes, and keys that it gathers before it sends them.
CHUNK, GATHERED = 2_000_000, 3_000_000
# A discount below this would leave nothing for what was not seen.
LEAST_DISCOUNT = 0.1
PRIME = 0x9E3779B97F4A7C15
END = np.uint64(0x2545F4914F6CDD1D)  # the hash of the end; no word's but by chance

PACKED = "shard int, keys binary, counts binary"


# -- tokens ------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts in turn, each text's words and its end; and where texts begin.

    A word's hash is a polynomial in its bytes, mixed.
    """
    data = np.frombuffer(b"\n".join([t.lower() for t in texts]) + b"\n", np.uint8)
    space = _SPACE[data]
    begins = np.flatnonzero(~space & np.append(True, space[:-1]))
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    lengths = ends - begins
    firsts = np.cumsum(lengths) - lengths
    letters = data[~space].astype(np.uint64) + np.uint64(1)
    if len(begins):
        power = np.full(int(lengths.max()), PRIME, np.uint64)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        letters *= power[np.arange(len(letters)) - np.repeat(firsts, lengths)]
        words = mix(np.add.reduceat(letters, firsts))
    else:
        words = np.empty(0, np.uint64)
    sizes = np.array([len(t) + 1 for t in texts])
    text_ends = np.cumsum(sizes)
    upto = np.searchsorted(begins, text_ends)  # words up to each text's end
    starts = np.append(0, upto[:-1]) + np.arange(len(texts))
    found = np.full(len(words) + len(texts), END, np.uint64)
    place = np.ones(len(found), bool)
    place[upto + np.arange(len(texts))] = False
    found[place] = words
    return found, starts


# -- counting ------------------------------------------------------------------------


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    if not len(all_keys):
        return all_keys, all_counts
    order = np.argsort(all_keys, kind="stable")
    all_keys, all_counts = all_keys[order], all_counts[order]
    firsts = np.flatnonzero(np.append(True, all_keys[1:] != all_keys[:-1]))
    return all_keys[firsts], np.add.reduceat(all_counts, firsts)


def _counted(parts: Iterator[np.ndarray], shard_of) -> Iterator[pa.RecordBatch]:
    """Count keys over a partition; rows of :data:`PACKED`, keys sorted within each."""
    keys, counts, size = [], [], 0

    def send() -> pa.RecordBatch:
        all_keys, all_counts = _added(keys, counts)
        shards = shard_of(all_keys)
        order = np.argsort(shards, kind="stable")
        all_keys, all_counts, shards = all_keys[order], all_counts[order], shards[order]
        firsts = np.flatnonzero(np.append(True, shards[1:] != shards[:-1]))
        lasts = np.append(firsts[1:], len(shards))
        spans = list(zip(firsts, lasts, strict=True)) if len(shards) else []
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shards[a] for a, _ in spans], pa.int32()),
                pa.array([all_keys[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([all_counts[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
            ],
            ["shard", "keys", "counts"],
        )

    for part in parts:
        found, n = np.unique(part, return_counts=True)
        keys.append(found)
        counts.append(n.astype(np.uint64))
        size += len(found)
        if size >= GATHERED:
            yield send()
            keys, counts, size = [], [], 0
    if keys:
        yield send()


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.frombuffer(k.as_py(), "<u8") for k in table.column("keys")]
    counts = [np.frombuffer(c.as_py(), "<u4").astype(np.uint64) for c in table.column("counts")]
    return _added(keys, counts)


# -- the model -------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Where a model's arrays are, and the few numbers that belong to all of it."""

    folder: str
    shards: int  # a power of two
    first_ids: tuple[int, ...] = ()  # of each shard of words, and their number
    n_tokens: int = 0
    busy: tuple[int, ...] = ()  # words whose pairs are spread over all shards
    discounts: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)  # of pairs seen 0, 1, 2, more times
    word_discounts: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    n_pairs: int = 0
    pair_sizes: tuple[int, ...] = ()  # of each shard of pairs

    def field(self, name: str, shard: int, kind: str) -> np.ndarray:
        """A field of the words of a shard."""
        size = self.first_ids[shard + 1] - self.first_ids[shard]
        return mapped(self.folder, name, shard, kind, size)

    @property
    def n_words(self) -> int:
        return self.first_ids[-1]

    def word_shard(self, hashes: np.ndarray) -> np.ndarray:
        """Shards are ranges, so ids follow the order of hashes."""
        return range_shard(hashes, self.shards)

    def pair_shard(self, keys: np.ndarray) -> np.ndarray:
        """By the first word, so that its pairs stand together; busy words' by the pair."""
        first = keys >> np.uint64(32)
        spread = np.isin(first, np.array(self.busy, np.uint64))
        return (mix(np.where(spread, keys, first)) % np.uint64(self.shards)).astype(np.int64)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes, -1 where a word is not known."""
        found = np.full(len(hashes), -1, np.int64)
        for shard, a, b in runs(self.word_shard(hashes)):
            known = self.field("hash", shard, "<u8")
            at = places(known, hashes[a:b])
            found[a:b] = np.where(at >= 0, at + self.first_ids[shard], -1)
        return found

    def of_words(self, name: str, kind: str, ids: np.ndarray) -> np.ndarray:
        """A field of words by sorted ids."""
        found = np.empty(len(ids), np.dtype(kind).newbyteorder("="))
        shards = np.searchsorted(np.array(self.first_ids), ids, side="right") - 1
        for shard, a, b in runs(shards):
            values = self.field(name, shard, kind)
            found[a:b] = values[ids[a:b] - self.first_ids[shard]]
        return found

    def of_pairs(self, keys: np.ndarray) -> np.ndarray:
        """Training counts of pairs."""
        shards = self.pair_shard(keys)
        order = np.lexsort((keys, shards))
        found = np.zeros(len(keys), np.uint64)
        for shard, a, b in runs(shards[order]):
            some = order[a:b]
            size = self.pair_sizes[shard]
            at = places(mapped(self.folder, "pair", shard, "<u8", size), keys[some])
            counts = mapped(self.folder, "pair_count", shard, "<u8", size)
            found[some[at >= 0]] = counts[at[at >= 0]]
        return found

    def word_chances(self, seen_after: np.ndarray) -> np.ndarray:
        """The lower order: by the number of different words that a word was seen after."""
        left = 1.0
        chances = np.zeros(len(seen_after))
        if self.n_pairs:
            left = self.word_discounts[0]
            less = np.array((0.0, *self.word_discounts[1:]))[np.minimum(seen_after, 3)]
            chances = (seen_after - less) / self.n_pairs
        return chances + left / (self.n_words + 1)


def _discounts(histogram: np.ndarray) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many keys were seen 1, 2, 3 and 4 times."""
    n = [float(x) for x in histogram]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else y for k in (1, 2, 3)]
    return tuple(min(max(d, LEAST_DISCOUNT), k) for k, d in enumerate(found, 1))


def marked(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "text",
    )


def learn(rows: DataFrame, folder: str | None = None) -> Model:
    """Count ``held_out, text`` (null: empty) rows that are not held out, and store the model.

    ``folder`` must be one that driver and executors all have mounted; by default one
    below ``spark.checkpoint.dir``.  Nothing to learn from gives a model that finds all
    texts equally likely for their length.
    """
    spark = rows.sparkSession
    folder = local_folder(folder or scratch_root(spark, "lm"))
    os.makedirs(folder, exist_ok=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = Model(folder, power_of_two(parts))
    rows = rows.where(~F.col("held_out"))
    return _learn_pairs(rows, _learn_words(rows, model))


def _learn_words(rows: DataFrame, model: Model) -> Model:
    def count(batches):
        return _counted(
            (tokens(texts)[0] for _, texts in texts_in_chunks(batches, CHUNK, "doc_id")),
                model.word_shard,
        )

    def store(key, table):
        shard = key[0].as_py()
        hashes, counts = _merged(table)
        store_array(model.folder, "hash", shard, hashes)
        store_array(model.folder, "count", shard, counts)
        return pa.table({"shard": [shard], "n": [len(hashes)], "total": [int(counts.sum())]})

    stored = {  # one row per shard
        row["shard"]: row
        for row in rows.mapInArrow(count, PACKED)
        .groupBy("shard")
        .applyInArrow(store, "shard bigint, n bigint, total bigint")
        .collect()
    }
    sizes = [stored[s]["n"] if s in stored else 0 for s in range(model.shards)]
    total = sum(row["total"] for row in stored.values())
    firsts = tuple(int(n) for n in np.append(0, np.cumsum(sizes)))
    if firsts[-1] >= 1 << 32:
        raise ValueError("more than 2**32 different words")
    model = replace(model, first_ids=firsts, n_tokens=total)
    # Words above a quarter of a shard's share: at most four times as many as shards.
    least = max(1000, total // (4 * model.shards))

    def busiest(batches):
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                at = np.flatnonzero(model.field("count", shard, "<u8") > least)
                yield pa.RecordBatch.from_arrays([pa.array(firsts[shard] + at)], ["id"])

    found = rows.sparkSession.range(0, model.shards).mapInArrow(busiest, "id bigint").collect()
    return replace(model, busy=tuple(sorted(row["id"] for row in found)))


def _pairs(model: Model, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Ids of all tokens, their counts' index, and the ids before them; -1 is unknown."""
    hashes, starts = tokens(texts)
    distinct, inverse = np.unique(hashes, return_inverse=True)
    ids = model.ids(distinct)[inverse]
    end = model.ids(np.array([END]))[0]
    before = np.append(end, ids[:-1])
    before[starts] = end  # a text begins after an end
    return ids, before, starts


def _learn_pairs(rows: DataFrame, model: Model) -> Model:
    def keys(batches):
        for _, texts in texts_in_chunks(batches, CHUNK, "doc_id"):
            ids, before, _ = _pairs(model, texts)
            yield before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64)

    def count(batches):
        return _counted(keys(batches), model.pair_shard)

    def store(key, table):
        """Store a shard of pairs; send on, per range of words, what was seen with them."""
        shard = key[0].as_py()
        pairs, counts = _merged(table)
        store_array(model.folder, "pair", shard, pairs)
        store_array(model.folder, "pair_count", shard, counts.astype("<u8"))
        out = {"shard": [], "what": [], "ids": [], "counts": []}
        seen = np.minimum(counts, 3)
        sides = [("after", pairs & np.uint64(0xFFFFFFFF))]
        sides += [(f"times{k}", (pairs >> np.uint64(32))[seen == k]) for k in (1, 2, 3)]
        for what, ids in sides:
            found, n = np.unique(ids.astype(np.int64), return_counts=True)
            ranges = np.searchsorted(np.array(model.first_ids), found, side="right") - 1
            for word_shard, a, b in runs(ranges):
                out["shard"].append(word_shard)
                out["what"].append(what)
                out["ids"].append((found[a:b] - model.first_ids[word_shard]).astype("<u4").tobytes())
                out["counts"].append(n[a:b].astype("<u4").tobytes())
        histogram = np.array([(counts == k).sum() for k in (1, 2, 3, 4)], "<u8")
        out["shard"].append(-1)
        out["what"].append("histogram")
        out["ids"].append(np.array([shard, len(pairs)], "<u8").tobytes())
        out["counts"].append(histogram.tobytes())
        return pa.table(out, pa.schema(_SENT))

    sent = kept(
        rows.mapInArrow(count, PACKED)
        .groupBy("shard")
        .applyInArrow(store, "shard int, what string, ids binary, counts binary")
    )
    histograms = sent.where("shard = -1").select("ids", "counts").collect()  # one row per shard
    sizes = dict(np.frombuffer(row["ids"], "<u8").tolist() for row in histograms)
    total = sum(
        (np.frombuffer(row["counts"], "<u8") for row in histograms), np.zeros(4, np.uint64)
    )
    discounts = _discounts(total)

    def finish(key, table):
        """Store what was seen with each word of a range."""
        shard = key[0].as_py()
        size = model.first_ids[shard + 1] - model.first_ids[shard]
        fields = {what: np.zeros(size, np.int64) for what in ("after", "times1", "times2", "times3")}
        columns = (table.column(c) for c in ("what", "ids", "counts"))
        for what, ids, counts in zip(*columns, strict=True):
            at = np.frombuffer(ids.as_py(), "<u4")
            fields[what.as_py()][at] += np.frombuffer(counts.as_py(), "<u4")
        mass = sum(d * fields[f"times{k}"] for k, d in enumerate(discounts, 1))
        seen = model.field("count", shard, "<u8")
        store_array(model.folder, "after", shard, fields["after"].astype("<u4"))
        store_array(model.folder, "left", shard, (mass / seen).astype("<f8"))
        after = fields["after"]
        found = [int((after == k).sum()) for k in (1, 2, 3, 4)]
        found += [int((after >= 3).sum()), int(after.sum())]
        return pa.table({"found": [found]})

    stats = sent.where("shard >= 0").groupBy("shard").applyInArrow(finish, "found array<bigint>")
    found = sum((np.array(row["found"]) for row in stats.collect()), np.zeros(6, np.int64))
    words = _discounts(found[:4])
    many = [found[0], found[1], found[4]]
    left = sum(d * n for d, n in zip(words, many, strict=True)) / max(1, found[5])
    return replace(
        model,
        discounts=(0.0, *discounts),
        word_discounts=(float(left), *words),
        n_pairs=int(found[5]),
        pair_sizes=tuple(sizes.get(shard, 0) for shard in range(model.shards)),
    )


_SENT = [("shard", pa.int32()), ("what", pa.string()), ("ids", pa.binary()), ("counts", pa.binary())]


# -- scoring ---------------------------------------------------------------------------


def token_scores(model: Model, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Per token: its training count, and log10 of its chance after the token before it."""
    ids, before, starts = _pairs(model, texts)
    words, place = np.unique(np.append(ids, before), return_inverse=True)
    known = words >= 0
    count, after, left = np.zeros(len(words)), np.zeros(len(words), np.int64), np.ones(len(words))
    count[known] = model.of_words("count", "<u8", words[known])
    after[known] = model.of_words("after", "<u4", words[known])
    left[known] = model.of_words("left", "<f8", words[known])
    lower = model.word_chances(after)
    this, last = place[: len(ids)], place[len(ids) :]
    both = known[this] & known[last]
    keys = before[both].astype(np.uint64) << np.uint64(32) | ids[both].astype(np.uint64)
    distinct, inverse = np.unique(keys, return_inverse=True)
    times = np.zeros(len(ids))
    times[both] = model.of_pairs(distinct)[inverse]
    less = np.array(model.discounts)[np.minimum(times, 3).astype(int)]
    seen = np.maximum(count[last], 1)
    chance = (times - less) / seen + left[last] * lower[this]
    return count[this], np.log10(chance), starts


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """Every row of ``doc_id, held_out, text``: token counts, base score and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = model.n_tokens + 0.1 * (model.n_words + 1)
        for ids, held, texts in texts_in_chunks(batches, CHUNK, "doc_id", "held_out"):
            count, log_chance, starts = token_scores(model, texts)
            base = np.log10((count + 0.1) / whole)
            sizes = np.diff(np.append(starts, len(count)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(held, pa.bool_()),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                    pa.array(np.full(len(ids), model.n_tokens), pa.int64()),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(log_chance, starts)),
                    pa.array(10.0 ** (-np.add.reduceat(log_chance, starts) / sizes)),
                ],
                _NAMES,
            )

    return rows.mapInArrow(
        run,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double, perplexity double",
    )


_NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
_NAMES += ["perplexity"]


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents."""
    rows = marked(read_documents(spark, sf_dir))
    return scored(rows, learn(rows))

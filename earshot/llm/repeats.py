"""Repeated passages: every byte covered by a string of 100 bytes that also starts earlier.

Prefix doubling: the name of a string of length 2n is the pair of names of its halves, and
strings are equal when their names are.  Names are 64-bit hashes of the pair, so that a
round needs no numbering of all positions, and a round sends only the positions that the
one before left open:

1. 51 bytes, at the positions that winnowing picks (two equal strings of 100 bytes pick the
   same); whatever is unique drops out;
2. 151 bytes, at what is left: a later occurrence settles the 52 windows of 100 bytes in it;
3. 100 bytes, at every window that is still open.

In each round tasks send sorted names, Spark brings equal ones together by shard, and
shards store the names that occur again, with the document that has them first.  Texts
are read again in each round and never shuffled.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import arrays
from earshot.llm.common import read_documents
from earshot.workspace import scratch_root

LENGTH = 100
GRAM = 51  # picked positions are at most LENGTH - GRAM + 1 apart
TILE = LENGTH + GRAM
# Bytes of text that are worked on at a time, few enough for a core's cache; names gathered.
CHUNK, GATHERED = 60_000, 1_000_000
LOWEST = -(1 << 63)
PRIME = np.uint64(0x9E3779B97F4A7C15)
HIGH, LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)

# Rounds whose names are stored with the document that has them first.
OWNED = ("tile", "window")
SENT = "shard int, names binary, owners binary, counts binary"


# -- names within a chunk of texts ----------------------------------------------------


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    both = left * PRIME
    both += right
    both ^= both >> np.uint64(32)
    both *= arrays.MIX_A
    both ^= both >> np.uint64(29)
    return both


def _twice(names: np.ndarray, apart: int) -> np.ndarray:
    """Names of the strings made of two, the second ``apart`` after the first."""
    return _pair(names[:-apart], names[apart:])


def _names32(raw: np.ndarray) -> np.ndarray:
    """Names of the strings of 32 bytes, doubled up from those of 8, which are the bytes."""
    wide = raw.astype(np.uint64)
    for shift in (1, 2, 4):
        wide = wide[:-shift] | wide[shift:] << np.uint64(8 * shift)
    wide *= PRIME
    wide ^= wide >> np.uint64(32)
    return _twice(_twice(wide, 8), 16)


@dataclass
class Chunk:
    """Texts one after the other, with what all rounds need of them."""

    owners: np.ndarray  # per text
    texts: list[bytes]

    def __post_init__(self) -> None:
        sizes = np.array([len(t) for t in self.texts])
        self.begins = np.cumsum(sizes) - sizes
        self.ends = self.begins + sizes
        raw = np.frombuffer(b"".join(self.texts) + bytes(2 * TILE), np.uint8)
        self.n = len(raw) - 2 * TILE
        self.names32 = _names32(raw)
        self.grams = _twice(self.names32, GRAM - 32)
        # How far each position is from the end of its text.
        self.left = np.repeat(self.ends, sizes) - np.arange(self.n)

    def windows(self) -> np.ndarray:
        """Where a window of ``LENGTH`` bytes starts, per position."""
        return self.left >= LENGTH

    def picks(self) -> np.ndarray:
        """For each position the picked gram of the window there: the least of its names."""
        keyed = self.grams[: self.n + LENGTH] & HIGH
        keyed |= np.arange(len(keyed), dtype=np.uint64)
        span, reach = keyed, 1
        wide = LENGTH - GRAM + 1
        while 2 * reach <= wide:
            span = np.minimum(span[:-reach], span[reach:])
            reach *= 2
        if reach < wide:
            rest = wide - reach
            span = np.minimum(span[:-rest], span[rest:])
        return (span[: self.n] & LOW).astype(np.int64)

    def names100(self, at: np.ndarray) -> np.ndarray:
        """Names of the windows at some positions."""
        half = LENGTH - 64
        first = _pair(self.names32[at], self.names32[at + 32])
        return _pair(first, _pair(self.names32[at + half], self.names32[at + half + 32]))

    def names151(self, at: np.ndarray) -> np.ndarray:
        return _pair(self.names100(at), self.names100(at + TILE - LENGTH))

    def owner(self, at: np.ndarray) -> np.ndarray:
        return self.owners[np.searchsorted(self.ends, at, side="right")]


# -- rounds ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rounds:
    folder: str
    shards: int
    # How many names each shard stored, by round; tasks get those of the rounds before theirs.
    sizes: dict[str, list[int]] = field(default_factory=dict)

    def repeated(self, name: str, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which names occur more than once in the corpus, and which document has them first."""
        distinct, inverse = np.unique(wanted, return_inverse=True)
        again = np.zeros(len(distinct), bool)
        first = np.zeros(len(distinct), np.int64)
        for shard, a, b in arrays.runs(arrays.range_shard(distinct, self.shards)):
            size = self.sizes[name][shard]
            known = arrays.mapped(self.folder, name, shard, "<u8", size)
            at = arrays.places(known, distinct[a:b])
            again[a:b] = at >= 0
            if size and name in OWNED:
                owners = arrays.mapped(self.folder, f"{name}_owner", shard, "<i8", size)
                first[a:b] = owners[np.maximum(at, 0)]
        return again[inverse], first[inverse]

    def later(self, name: str, chunk: Chunk, at: np.ndarray, names: np.ndarray) -> np.ndarray:
        """Which positions (in order) are not the first occurrence of their names."""
        again, first = self.repeated(name, names)
        text = np.searchsorted(chunk.ends, at, side="right")
        order = np.lexsort((at, names, text))
        same = (names[order][1:] == names[order][:-1]) & (text[order][1:] == text[order][:-1])
        before = np.zeros(len(at), bool)
        before[order[1:]] = same  # in its own text
        return before | again & (first < chunk.owners[text])

    def open_grams(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Windows whose picked gram occurs again, and those grams."""
        picks, starts = chunk.picks(), chunk.windows()
        grams = _marked(picks[starts], chunk.n)
        again, _ = self.repeated("gram", chunk.grams[grams])
        kept = np.zeros(chunk.n + LENGTH, bool)
        kept[grams[again]] = True
        return starts & kept[picks], grams[again]

    def tiles(self, chunk: Chunk, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = grams[chunk.left[grams] >= TILE]
        return at, chunk.names151(at)

    def settled(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Windows within a later occurrence of a tile, and windows still open."""
        open_, grams = self.open_grams(chunk)
        at, names = self.tiles(chunk, grams)
        at = at[self.later("tile", chunk, at, names)]
        inside = _covered(at, TILE - LENGTH + 1, chunk.n)
        return inside, np.flatnonzero(open_ & ~inside)


def _marked(at: np.ndarray, n: int) -> np.ndarray:
    """The distinct positions, in order."""
    there = np.zeros(n, bool)
    there[at] = True
    return np.flatnonzero(there)


def _covered(at: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie within ``size`` from one of the distinct ``at``."""
    steps = np.zeros(n + size + 1, np.int32)
    steps[at] += 1
    steps[at + size] -= 1
    return np.cumsum(steps)[:n] > 0


def _added(names, owners, counts) -> tuple[np.ndarray, ...]:
    """Sorted distinct names, their least owners and the sums of their counts."""
    names, owners, counts = map(np.concatenate, (names, owners, counts))
    if not len(names):
        return names, owners, counts
    order = np.argsort(names, kind="stable")
    names = names[order]
    firsts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
    return (
        names[firsts],
        np.minimum.reduceat(owners[order], firsts),
        np.add.reduceat(counts[order], firsts),
    )


def _sent(parts: Iterator[tuple[np.ndarray, np.ndarray]], shards: int, with_owners: bool):
    """Names and owners of a partition as rows of :data:`SENT`, equal names once."""

    def send() -> pa.RecordBatch:
        names, owners, counts = _added(*zip(*held, strict=True))
        found = list(arrays.runs(arrays.range_shard(names, shards)))
        many = np.minimum(counts, 2).astype(np.uint8)  # once, or more often

        def own(a: int, b: int) -> bytes:
            if not with_owners:
                return b""
            return arrays.planes(owners[a:b].astype(np.uint64) ^ np.uint64(1 << 63))

        return pa.RecordBatch.from_arrays(
            [
                pa.array([s for s, _, _ in found], pa.int32()),
                pa.array([arrays.packed(names[a:b]) for _, a, b in found], pa.binary()),
                pa.array([own(a, b) for _, a, b in found], pa.binary()),
                pa.array([many[a:b].tobytes() for _, a, b in found], pa.binary()),
            ],
            ["shard", "names", "owners", "counts"],
        )

    held, size = [], 0
    for names, owners in parts:
        held.append(_added([names], [owners], [np.ones(len(names), np.int64)]))
        size += len(held[-1][0])
        if size >= GATHERED:
            held, size = [_added(*zip(*held, strict=True))], 0
            if len(held[0][0]) >= GATHERED:
                yield send()
                held = []
    if held:
        yield send()


def _run_round(docs: DataFrame, rounds: Rounds, name: str, parts_of) -> None:
    """Send ``parts_of(chunk)`` of all chunks; store the names met more than once."""
    with_owners = name in OWNED

    def send(batches):
        chunks = (Chunk(np.array(ids), texts) for ids, texts in _chunks(batches))
        return _sent(map(parts_of, chunks), rounds.shards, with_owners)

    def meet(key, table):
        shard = key[0].as_py()
        columns = {c: [v.as_py() for v in table.column(c)] for c in ("names", "owners", "counts")}
        many = [np.frombuffer(v, np.uint8).astype(np.int64) for v in columns["counts"]]
        if with_owners:
            shifted = [arrays.from_planes(v) ^ np.uint64(1 << 63) for v in columns["owners"]]
            owners = [o.view("<i8") for o in shifted]
        else:
            owners = [np.zeros(len(m), np.int64) for m in many]
        names, first, counts = _added(
            [arrays.unpacked(v) for v in columns["names"]], owners, many
        )
        again = counts > 1
        arrays.store(rounds.folder, name, shard, names[again])
        if with_owners:
            arrays.store(rounds.folder, f"{name}_owner", shard, first[again])
        return pa.table({"shard": [shard], "n": [int(again.sum())]})

    met = docs.mapInArrow(send, SENT).groupBy("shard").applyInArrow(meet, "shard bigint, n bigint")
    sizes = {row["shard"]: row["n"] for row in met.collect()}  # one row per shard
    rounds.sizes[name] = [sizes.get(shard, 0) for shard in range(rounds.shards)]


def _chunks(batches):
    return arrays.texts_in_chunks(batches, CHUNK, "place")


def stripped(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` of every row.

    ``removed`` lists the removed runs as byte offsets.  Null text is empty; texts below
    100 bytes lose nothing.  A null id comes before all others.  Rows that share an id are
    compared with smaller ids and each with itself, not with each other.  A task holds
    about 100 bytes for each byte of a chunk of texts, or of a single longer text.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("place"),
        "text",
    )
    folder = arrays.local_folder(folder or scratch_root(spark, "repeats"))
    os.makedirs(folder, exist_ok=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rounds = Rounds(folder, arrays.power_of_two(parts))

    def grams(chunk: Chunk):
        at = _marked(chunk.picks()[chunk.windows()], chunk.n)
        return chunk.grams[at], np.zeros(len(at), np.int64)

    def tiles(chunk: Chunk):
        at, names = rounds.tiles(chunk, rounds.open_grams(chunk)[1])
        return names, chunk.owner(at)

    def windows(chunk: Chunk):
        _, at = rounds.settled(chunk)
        return chunk.names100(at), chunk.owner(at)

    _run_round(rows, rounds, "gram", grams)
    _run_round(rows, rounds, "tile", tiles)
    _run_round(rows, rounds, "window", windows)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, places, texts in arrays.texts_in_chunks(batches, CHUNK, "doc_id", "place"):
            chunk = Chunk(np.array(places), texts)
            inside, at = rounds.settled(chunk)
            again = at[rounds.later("window", chunk, at, chunk.names100(at))]
            inside[again] = True
            gone = _covered(np.flatnonzero(inside), LENGTH, chunk.n)
            yield _result(ids, chunk, gone)

    return rows.mapInArrow(
        finish,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "removed array<array<bigint>>",
    )


def _result(ids: list, chunk: Chunk, gone: np.ndarray) -> pa.RecordBatch:
    rows = []
    for doc_id, text, a, b in zip(ids, chunk.texts, chunk.begins, chunk.ends, strict=True):
        lost = gone[a:b]
        edges = np.flatnonzero(np.diff(lost, prepend=False, append=False)).reshape(-1, 2)
        if len(edges):
            kept = np.frombuffer(text, np.uint8)[~lost].tobytes()
        else:
            kept = text
        digest = hashlib.sha256(kept).hexdigest()
        rows.append((doc_id, len(text), len(text) - len(kept), len(edges), digest, edges.tolist()))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    kinds.append(pa.list_(pa.list_(pa.int64())))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents."""
    return stripped(read_documents(spark, sf_dir)).drop("removed")

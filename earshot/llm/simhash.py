"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are cut into parts of correlated bits.  If the parts' thresholds, each plus
one, add up to the distance plus one, two fingerprints within the distance are within the
threshold in some part.  The thresholds are dealt by dynamic programming on
estimated numbers of candidates; parts are probed by equi-joins and candidates verified
inside the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earshot.llm.common import free_names, kept, read_documents, released, star_components

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42  # fixed value: Spark's own seed for xxhash64

# Relative costs: a row that is shuffled to probe a part, a candidate pair verified.
PROBE_COST, PAIR_COST = 1.0, 0.02
MOST_PROBES = 5_000
# Buckets from this size on link through a centre, and are cut from the second on.
DENSE, LARGE = 256, 20_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half the hashes of the text's word shingles."""
    words = (text or "").encode().lower().split()  # both touch ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    starts = [0, *ends]
    stops = ends[shingle - 1 :] or ends[-1:]
    hash_of = xxhash.xxh64_intdigest
    set_in = np.zeros(BITS, np.int64)
    for at in range(0, len(stops), 50_000):
        some = zip(starts[at:], stops[at : at + 50_000], strict=False)
        hashes = np.array([hash_of(joined[a : b - 1], SEED) for a, b in some], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(stops), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row; ``text_hash`` tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            found = [fingerprint(text.as_py(), shingle) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found, pa.int64())],
                ["doc_id", "text_hash", "fp"],
            )

    return docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text"
    ).mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


# -- partitions and thresholds --------------------------------------------------


@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return _signed(sum(1 << b for b in self.bits))

    def probes(self) -> list[int]:
        """What to flip to reach every value within the threshold."""
        return [
            _signed(sum(1 << b for b in flips))
            for n in range(self.threshold + 1)
            for flips in combinations(self.bits, n)
        ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are and in how many two bits are both set (64 x 64)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            raw = np.ascontiguousarray(batch.column(0).to_numpy(), "<i8")
            for at in range(0, len(raw), 10_000):
                some = raw[at : at + 10_000].view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(some, axis=1, bitorder="little").astype(np.float32)
                both += bits.T @ bits
            n += len(raw)
        cells = np.append(both.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells)), pa.int64()), pa.array(cells)], ["cell", "n"]
        )

    rows = (  # 4,097 rows
        fps.select("fp")
        .mapInArrow(run, "cell bigint, n bigint")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for row in rows:
        cells[row["cell"]] = row["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def plan_parts(n: int, both: np.ndarray, distance: int = DISTANCE) -> list[Part]:
    """The cheapest grouping and thresholds; parts that need not be probed are left out."""
    total = max(n, 1)
    p = both.diagonal() / total
    together = both / total
    cells = [together, p[:, None] - together, p[None, :] - together]
    cells.append(1 - cells[0] - cells[1] - cells[2])
    agree_both = sum(c * c for c in cells)  # chance that two texts agree in both bits
    agree = p * p + (1 - p) * (1 - p)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(together - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)

    best: tuple[float, list[Part]] | None = None
    for n_parts in range(1, distance + 2):
        groups = _group_bits(related, n_parts)
        costs = [_costs(n, g, agree, agree_both, related, distance) for g in groups]
        cost, units = _allot(costs, distance + 1)
        if best is None or cost < best[0]:
            best = cost, [
                Part(tuple(sorted(g)), u - 1) for g, u in zip(groups, units, strict=True) if u
            ]
    assert best is not None
    return best[1]


def _group_bits(related: np.ndarray, n_parts: int) -> list[list[int]]:
    """Bits by parts of near equal size: each grows by the bit most related to it."""
    free, groups = set(range(BITS)), []
    for part in range(n_parts):
        size = len(free) // (n_parts - part)
        group = [max(sorted(free), key=lambda b: related[b, sorted(free)].sum())]
        free.remove(group[0])
        while len(group) < size:
            closest = max(sorted(free), key=lambda b: related[b, group].mean())
            group.append(closest)
            free.remove(closest)
        groups.append(group)
    return groups


def _costs(n, group, agree, agree_both, related, distance) -> list[float]:
    """Cost of a part by units (threshold plus one): rows sent to probe and pairs met."""
    # Agreement in all bits along a tree of the most related ones; the distance around it
    # as if bits differed independently.
    same = indep = agree[group[0]]
    for i, bit in enumerate(group[1:], 1):
        parent = max(group[:i], key=lambda b: related[b, bit])
        same *= agree_both[parent, bit] / max(agree[parent], 1e-12)
        indep *= agree[bit]
    near = np.zeros(distance + 1)
    near[0] = 1.0
    for bit in group:
        near[1:] = near[1:] * agree[bit] + near[:-1] * (1 - agree[bit])
        near[0] *= agree[bit]
    costs, probes, pairs = [0.0], 0, 0.0
    for threshold in range(distance + 1):
        probes += comb(len(group), threshold)
        pairs += near[threshold] * same / max(indep, 1e-300)
        if probes > MOST_PROBES and threshold:
            costs.append(float("inf"))
        else:
            costs.append(
                PROBE_COST * n * (1 + probes) + PAIR_COST * min(1.0, pairs) * n * n / 2
            )
    return costs


def _allot(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Deal ``units`` to the parts at least total cost (dynamic programming)."""
    best = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, dealt) in best.items():
            for more in range(units - used + 1):
                option = cost + row[more], [*dealt, more]
                if used + more not in step or option[0] < step[used + more][0]:
                    step[used + more] = option
        best = step
    return best[units]


# -- links and components -------------------------------------------------------


def _hamming(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, parts: list[Part], distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links that connect all of ``fp, n`` within ``distance``, through equi-joins.

    In a bucket of many fingerprints, those within half the distance of its centre (the one with
    most documents) link to the centre alone: any two of them are within the distance of
    each other.  Very large buckets are cut: members by hash, probes to each piece.
    """
    values = fps.select("fp", "n")

    def keys(part: Part, flips: list[int]) -> Column:
        own = F.col("fp").bitwiseAND(F.lit(part.mask))
        return F.transform(F.array(*[F.lit(f) for f in flips]), lambda f: own.bitwiseXOR(f))

    def keyed(flips: list[list[int]]) -> DataFrame:
        options = [
            F.struct(F.lit(i).alias("part"), keys(part, some).alias("keys"))
            for i, (part, some) in enumerate(zip(parts, flips, strict=True))
        ]
        return values.select("fp", "n", F.inline(F.array(*options))).select(
            "fp", "n", "part", F.explode("keys").alias("key")
        )

    members = keyed([[0]] * len(parts))
    probes = keyed([part.probes() for part in parts])
    busy = kept(
        members.groupBy("part", "key")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.max(F.struct("n", "fp"))["fp"].alias("centre"),
        )
        .where(F.col("members") >= DENSE)
        .select("part", "key", "centre", F.ceil(F.col("members") / LARGE).alias("pieces"))
    )
    if busy.isEmpty():
        nothing = F.lit(None).cast("bigint")
        members = members.select("fp", "part", "key", F.lit(0).cast("bigint").alias("piece"))
        probes = probes.select(
            "fp", "part", "key", F.lit(0).cast("bigint").alias("piece"), nothing.alias("centre")
        )
    else:
        pieces = F.coalesce("pieces", F.lit(1).cast("bigint"))
        members = members.join(busy.drop("centre"), ["part", "key"], "left").select(
            "fp", "part", "key", F.pmod(F.xxhash64("fp"), pieces).alias("piece")
        )
        probes = probes.join(busy, ["part", "key"], "left").select(
            "fp",
            "part",
            "key",
            "centre",
            F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)).alias("piece"),
        )
    left = probes.select(F.col("fp").alias("a"), "part", "key", "piece", "centre")
    right = members.select(F.col("fp").alias("b"), "part", "key", "piece")
    half = distance // 2
    around = (_hamming("a", "centre") <= half) & (_hamming("b", "centre") <= half)
    ordinary = (F.col("a") < F.col("b")) & ~F.coalesce(around, F.lit(False))
    central = F.coalesce(F.col("b") == F.col("centre"), F.lit(False))
    return (
        left.join(right, ["part", "key", "piece"])
        .where((F.col("a") != F.col("b")) & (_hamming("a", "b") <= distance))
        .where(central | ordinary)
        .select("a", "b")
    )


def components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp, root, component_id`` of each distinct fingerprint: the smallest fingerprint and the
    smallest doc_id that it reaches.
    """
    fps = kept(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    )
    n, both = bit_counts(fps)
    roots = star_components(links(fps, plan_parts(n, both, distance), distance))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = kept(rooted)
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return kept(rooted.join(lowest, "root").select("fp", "root", "component_id"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` for every row of ``doc_id, text``.

    Null and empty texts have fingerprint zero and link like any other.  Copies are one
    fingerprint, so a group of copies of any size is one node.  A row without a doc_id is
    in a component like any other but gives it no id; a component of such rows has none, and
    components of unrelated texts can share one.  ``root`` is each component's own.
    """
    prints = kept(fingerprints(docs, shingle))
    return prints.join(components(prints, distance), "fp")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents."""
    return near_duplicates(read_documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component left: the one its id names.

    Where several rows have that id and are in the component, one of them stays, chosen by
    their contents.  Components without an id keep one row each likewise.
    """
    found = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # An id can name several components, or none: only the root tells them apart.
    first = found.groupBy("root", "doc_id").agg(F.min("text_hash").alias("text_hash"))
    text_hash, place = free_names(docs.columns, "text_hash", "place")
    hashed = docs.withColumn(text_hash, F.xxhash64("text"))
    stay = hashed.alias("d").join(
        first.alias("f"),
        F.col("d.doc_id").cast("long").eqNullSafe(F.col("f.doc_id"))
        & (F.col(f"d.{text_hash}") == F.col("f.text_hash")),
        "left_semi",
    )
    same = Window.partitionBy("doc_id", text_hash).orderBy(
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    )
    return (
        stay.withColumn(place, F.row_number().over(same))
        .where(F.col(f"`{place}`") == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )

"""Merkle manifest of a dataset, with a proof for every row.

Rows of a tree stand in order; every level joins each node to its siblings by their computed
places (its own slot plus an offset, round the run), and the nodes in slot zero, which then hold
their whole run, emit the parents.  Trees' roots are the leaves of one more tree.  On the way
back down each node hands its children the siblings met above it, so a row ends with the
proof that leads from its leaf to the root.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import kept, ranked_within, read_documents
from earshot.llm.trie import CRC32

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST_BYTES = 32
PATH = "array<struct<slot:int,siblings:binary>>"
# The letters that tampering lower-cases.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def told(value: Column) -> Column:
    """A field as it enters a leaf: ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    text = value.cast("string")
    length = F.octet_length(text).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(length, F.lit(":"), text))


def leaf_hash(*fields: Column) -> Column:
    """The leaf's digest, in bytes."""
    return F.unhex(F.sha2(F.concat(*[told(f) for f in fields]), 256))


def node_hash(digests: Column) -> Column:
    """The digest of digests, which count as lowercase hex text; bytes in and out."""
    return F.unhex(F.sha2(as_text(digests), 256))


def as_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _joined(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(b"").cast("binary"), lambda s, p: F.concat(s, p))


@dataclass
class Climb:
    """Levels from the leaves up: ``tree, idx, slot, siblings``, and ``tree, height, hash`` of roots."""

    levels: list[DataFrame]
    roots: DataFrame


def climb(leaves: DataFrame, fan: int = FAN) -> Climb:
    """The trees over stored ``tree, idx, size, hash``; ``idx`` goes from 0 to ``size - 1``.

    While a tree has more than one node, every ``fan`` consecutive ones, the last run maybe
    fewer, become one.  A tree of one leaf is that leaf.
    """
    most = leaves.agg(F.max("size")).first()[0] or 0
    levels, roots, nodes = [], [], leaves.select("tree", "idx", "size", "hash")
    height = 0
    while True:
        top = F.col("size") == 1
        roots.append(nodes.where(top).select("tree", F.lit(height).alias("height"), "hash"))
        if most <= 1:
            break
        level = kept(with_siblings(nodes.where(~top), fan))
        levels.append(level.select("tree", "idx", "slot", "siblings"))
        nodes = level.where("slot = 0").select(
            "tree",
            F.floor(F.col("idx") / fan).alias("idx"),
            F.ceil(F.col("size") / fan).alias("size"),
            node_hash(F.concat("hash", "siblings")).alias("hash"),
        )
        most, height = -(-most // fan), height + 1
    found = roots[0]
    for more in roots[1:]:
        found = found.union(more)
    return Climb(levels, kept(found))


def with_siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """``nodes`` with ``slot`` and ``siblings``: the others' digests in order, as one run of bytes."""
    slot = F.col("idx") % fan
    wanted = nodes.select(
        "tree", "idx", F.explode(F.sequence(F.lit(1), F.lit(fan - 1))).alias("offset")
    ).select("tree", "idx", (F.col("idx") - slot + (slot + F.col("offset")) % fan).alias("sibling"))
    there = nodes.select("tree", F.col("idx").alias("sibling"), "hash")
    met = (
        wanted.where("sibling >= 0")
        .join(there, ["tree", "sibling"])  # the last run may lack some
        .groupBy("tree", "idx")
        .agg(F.sort_array(F.collect_list(F.struct("sibling", "hash"))).alias("met"))
        .select("tree", "idx", _joined(F.transform("met", lambda m: m["hash"])).alias("siblings"))
    )
    return nodes.join(met, ["tree", "idx"], "left").select(
        "tree",
        "idx",
        "size",
        "hash",
        slot.cast("int").alias("slot"),
        F.coalesce("siblings", F.lit(b"").cast("binary")).alias("siblings"),
    )


def descend(climbed: Climb, tops: DataFrame, above: Sequence[str], fan: int = FAN) -> DataFrame:
    """``tree, idx, path`` and ``above`` of every leaf: slots and siblings from it to the top.

    ``tops`` has ``tree``, the ``path`` from the tree's root on and columns ``above`` that its
    nodes hand down.
    """
    tops = kept(climbed.roots.select("tree", "height").join(tops, "tree"))

    def ending_at(height: int) -> DataFrame:
        return tops.where(F.col("height") == height).select(
            "tree", F.lit(0).cast("long").alias("idx"), "path", *above
        )

    paths = ending_at(len(climbed.levels))
    for height in reversed(range(len(climbed.levels))):
        up = paths.select(
            "tree", F.col("idx").alias("parent"), F.col("path").alias("upper"), *above
        )
        step = F.array(F.struct("slot", "siblings"))
        met = (
            climbed.levels[height]
            .withColumn("parent", F.floor(F.col("idx") / fan))
            .join(up, ["tree", "parent"])
            .select("tree", "idx", F.concat(step, "upper").alias("path"), *above)
        )
        paths = met.union(ending_at(height))
        if height:
            paths = kept(paths)
    return paths


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""

    def up(digest: Column, step: Column) -> Column:
        at = step["slot"] * DIGEST_BYTES
        before = F.substring(step["siblings"], F.lit(1), at)
        after = F.substring(step["siblings"], at + 1, F.octet_length(step["siblings"]))
        return node_hash(F.concat(before, digest, after))

    return F.aggregate(path, leaf, up)


def proof(path: Column) -> Column:
    """All siblings on the way up, as one run of bytes."""
    return _joined(F.transform(path, lambda step: step["siblings"]))


def manifest(rows: DataFrame, tree: str, order: Sequence[Column], fan: int = FAN) -> DataFrame:
    """``rows`` (stored, with ``leaf``) and ``subroot, root, path``.

    A tree per value of ``tree``, which is not null, its leaves in ``order`` (no ties but
    between equal rows); their roots in bytewise order of ``tree`` form the last tree.  All
    digests are bytes.  No rows, no result.
    """
    ranked = kept(
        ranked_within(rows.withColumnRenamed(tree, "tree"), ["tree"], order, "idx", "size", "part")
        .drop("part")
    )
    trees = climb(ranked.select("tree", "idx", "size", F.col("leaf").alias("hash")), fan)
    named = kept(
        ranked_within(
            trees.roots.withColumn("all", F.lit("")), ["all"], [F.col("tree")], "idx", "size", "part"
        )
    )
    last = climb(named.select(F.col("all").alias("tree"), "idx", "size", "hash"), fan)
    top = last.roots.select(
        "tree", F.array().cast(PATH).alias("path"), F.col("hash").alias("root")
    )
    over = descend(last, top, ["root"], fan).select("idx", "path", "root")
    tops = named.select("idx", "tree", F.col("hash").alias("subroot")).join(over, "idx").drop("idx")
    paths = descend(trees, tops, ["subroot", "root"], fan)
    return ranked.join(paths, ["tree", "idx"]).drop("idx", "size").withColumnRenamed("tree", tree)


def verified_documents(docs: DataFrame) -> DataFrame:
    """Every row's leaf, tree, root and proof, and whether its text as tampered with still proves.

    Trees are languages, null first; rows stand by ``doc_id`` (null first), then by leaf, so
    repeated ids are rows of their own.  A text counts as tampered with where 3 divides the
    CRC-32 of its id, and then has its A-Z in lower case; a row without an id is left as it is.
    """
    fields = [F.col(c) for c in FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    changed = F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    # In bytewise order a null language comes before any other.
    lang = F.col("lang")
    tree = F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), lang))
    rows = kept(
        docs.select(
            "doc_id",
            tree.alias("tree"),
            leaf_hash(*fields).alias("leaf"),
            leaf_hash(*fields[:-1], changed).alias("told_leaf"),
        )
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    proved = manifest(rows, "tree", order).withColumn(
        "folded_root", folded(F.col("told_leaf"), F.col("path"))
    )
    return proved.select(
        "doc_id",
        as_text(F.col("leaf")).alias("leaf"),
        as_text(F.col("subroot")).alias("subroot"),
        as_text(F.col("root")).alias("root"),
        F.sha2(as_text(proof(F.col("path"))), 256).alias("proof_sha256"),
        as_text(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents."""
    return verified_documents(read_documents(spark, sf_dir))


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"


def _leaf_sql(text: str) -> str:
    fields = [_FIELD.format(f) for f in (*FIELDS[:-1], text)]
    return f"sha256({' || '.join(fields)})"


def _levels_sql(name: str, leaves: str) -> str:
    """Nodes of all levels, then each node's siblings before and after it."""
    return f"""{name} AS (
  SELECT 0 AS l, tree, idx, h, n FROM {leaves}
  UNION ALL
  SELECT l + 1, tree, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 7) // 8
  FROM {name} WHERE n > 1 GROUP BY l, tree, idx // 8),
{name}_runs AS (
  SELECT l, tree, idx // 8 AS up, list(h ORDER BY idx) AS hs FROM {name} WHERE n > 1 GROUP BY ALL)"""


def _walk_sql(name: str, start: str, levels: str) -> str:
    """Proof and folded digest of every row of ``start``, up the levels."""
    return f"""{name} AS (
  SELECT doc_id, leaf, 0 AS l, tree, idx, proof, told FROM {start}
  UNION ALL
  SELECT w.doc_id, w.leaf, w.l + 1, w.tree, up,
         proof || array_to_string(hs[:idx % 8], '') || array_to_string(hs[idx % 8 + 2:], ''),
         sha256(array_to_string(hs[:idx % 8], '') || told || array_to_string(hs[idx % 8 + 2:], ''))
  FROM {name} w JOIN {levels}_runs r ON r.l = w.l AND r.tree = w.tree AND r.up = w.idx // 8)"""


def _top_sql(levels: str) -> str:
    return f"SELECT tree, l, h FROM {levels} WHERE n = 1"


SQL = f"""WITH RECURSIVE a AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS tree,
         {_leaf_sql("text")} AS leaf,
         CASE WHEN xor({CRC32.format(text="doc_id::VARCHAR")}, 4294967295) % 3 = 0
              THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")}
              ELSE {_leaf_sql("text")} END AS told
  FROM documents),
b AS (
  SELECT *, leaf AS h, count(*) OVER (PARTITION BY tree) AS n, '' AS proof,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM a),
{_levels_sql("nodes", "b")},
subroots AS (
  SELECT '' AS tree, tree AS lang, l, h, count(*) OVER () AS n,
         row_number() OVER (ORDER BY tree) - 1 AS idx FROM ({_top_sql("nodes")})),
{_levels_sql("tops", "subroots")},
{_walk_sql("low", "b", "nodes")},
met AS (
  SELECT low.doc_id, low.leaf, s.tree, s.idx, low.proof, low.told
  FROM low JOIN subroots s ON s.lang = low.tree AND s.l = low.l),
{_walk_sql("high", "met", "tops")}
SELECT high.doc_id, high.leaf, s.h AS subroot, t.h AS root, sha256(high.proof) AS proof_sha256,
       high.told AS folded_root, high.told = t.h AS verified
FROM high JOIN ({_top_sql("tops")}) t ON t.l = high.l
JOIN a ON a.doc_id IS NOT DISTINCT FROM high.doc_id AND a.leaf = high.leaf
JOIN subroots s ON s.lang = a.tree"""

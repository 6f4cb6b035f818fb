"""Prefix trie of conversations, totals of subtrees by depth bands.

A turn is known by 120 bits of its SHA-256, a node by its depth and the exclusive or of its
turns' hashes, each mixed with its position.  A node's ancestors stand in the rows of any one of
its conversations, so totals need no pointers: within bands of a fixed height every node adds
to its ancestors up to the band's root; roots of bands form a tree of their own, which is
summed the same way with longer steps; finished totals of band roots then go to the band above.
Depth ``d`` takes ``log(d)`` rounds each way and a node meets at most one band's height of
ancestors a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earshot.llm.common import kept, ranked_within

BLOCK = 100
MOST_SHARED = 6
BAND = 16
# Ids that are joined to one text before a node's are hashed in order.
CHUNK = 1_000
# A parent with more than this share of all nodes as children is told to them by broadcast.
HEAVY = 1_000
KEY = ["depth", "ka", "kb"]


def turn_digests(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, n_chars, a, b`` of every row; null role and text are empty.

    Rows without a ``conv_id`` belong to no conversation.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    told = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.sha2(told, 256)
    return (
        conversations.where(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.char_length(text).cast("long").alias("n_chars"),
            digest.alias("digest"),
        )
        .select(
            "conv_id",
            "turn",
            "n_chars",
            F.conv(F.substring("digest", 1, 15), 16, 10).cast("long").alias("a"),
            F.conv(F.substring("digest", 16, 15), 16, 10).cast("long").alias("b"),
        )
    )


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, n, part, n_chars, a, b``: each turn's place from 0 of its conversation's ``n``.

    By ``turn``, null first; turns of one number stand in the order of their hashes, and
    repeated rows are turns of their own.  ``part`` splits conversations of any length.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"), F.col("n_chars")]
    return ranked_within(kept(turn_digests(conversations)), ["conv_id"], order, "at", "n", "part")


def as_they_are(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, part, n_chars, a, b, length`` of conversations left as they are."""
    return turns.select(
        "conv_id",
        (F.col("at") + 1).alias("depth"),
        "part",
        "n_chars",
        "a",
        "b",
        F.col("n").alias("length"),
    )


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt around the first turns of each block of a hundred.

    ``c`` gets the first ``h`` turns of ``c - c % 100`` (what there is of them), then its own
    after its first ``h``; ``h`` is ``crc32(decimal c) % 6``.  Returns rows as
    :func:`as_they_are` has them, and ``conv_id, length`` of all conversations, turnless ones too.
    """
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    reached = turns.groupBy("conv_id", "part").agg(F.first("n").alias("n"))
    sizes = reached.groupBy("conv_id").agg(F.max("n").alias("n"))
    of_bases = sizes.where(F.col("conv_id") == base).select(
        F.col("conv_id").alias("base"), F.col("n").alias("base_n")
    )
    got = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = kept(
        sizes.select("conv_id", "n", base.alias("base"), shared.alias("h"))
        .join(of_bases, "base", "left")
        .select("conv_id", "base", "h", "n", got.alias("got"))
        .withColumn("length", F.col("got") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    heads = turns.where((F.col("conv_id") == base) & (F.col("at") < MOST_SHARED - 1)).select(
        F.col("conv_id").alias("base"), "at", "n_chars", "a", "b"
    )
    columns = ["conv_id", "depth", "part", "n_chars", "a", "b", "length"]
    first = (
        convs.where("got > 0")
        .join(heads, "base")
        .where("at < got")
        .withColumn("depth", F.col("at") + 1)
        .withColumn("part", F.lit(-1))
    )
    # Told to each part of a conversation, so that no long one meets its line in one task.
    told = reached.select("conv_id", "part").join(convs.select("conv_id", "h", "got", "length"), "conv_id")
    own = (
        turns.join(told, ["conv_id", "part"])
        .where("at >= h")
        .withColumn("depth", F.col("got") + F.col("at") - F.col("h") + 1)
    )
    return first.select(*columns).union(own.select(*columns)), convs.select("conv_id", "length")


def prefixes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv_id, depth, ka, kb, pa, pb, n_chars, last``: each conversation's nodes, root included.

    ``ka, kb`` name the node at that depth, ``pa, pb`` its parent; ``last`` where it ends.
    """
    mixed = kept(
        rows.select(
            "conv_id",
            "depth",
            "part",
            "n_chars",
            "length",
            F.xxhash64("depth", "a", "b").alias("ha"),
            F.xxhash64("b", "a", "depth", F.lit(1)).alias("hb"),
        )
    )
    so_far = (
        Window.partitionBy("conv_id", "part")
        .orderBy("depth")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy("part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = mixed.groupBy("conv_id", "part").agg(
        F.bit_xor("ha").alias("sa"), F.bit_xor("hb").alias("sb")
    )
    before = sums.select(
        "conv_id",
        "part",
        F.coalesce(F.bit_xor("sa").over(earlier), F.lit(0)).alias("ba"),
        F.coalesce(F.bit_xor("sb").over(earlier), F.lit(0)).alias("bb"),
    )
    nodes = (
        mixed.withColumn("ra", F.bit_xor("ha").over(so_far))
        .withColumn("rb", F.bit_xor("hb").over(so_far))
        .join(before, ["conv_id", "part"])
        .withColumn("ka", F.col("ra").bitwiseXOR(F.col("ba")))
        .withColumn("kb", F.col("rb").bitwiseXOR(F.col("bb")))
        .select(
            "conv_id",
            "depth",
            "ka",
            "kb",
            F.col("ka").bitwiseXOR(F.col("ha")).alias("pa"),
            F.col("kb").bitwiseXOR(F.col("hb")).alias("pb"),
            "n_chars",
            (F.col("depth") == F.col("length")).alias("last"),
        )
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = convs.select(
        "conv_id",
        zero.alias("depth"),
        zero.alias("ka"),
        zero.alias("kb"),
        none.alias("pa"),
        none.alias("pb"),
        zero.alias("n_chars"),
        (F.col("length") == 0).alias("last"),
    )
    return nodes.union(roots)


def prefix_trie(paths: DataFrame, band: int = BAND) -> DataFrame:
    """A row per node of stored ``paths`` (see :func:`prefixes`); none of an empty table.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``.  The node's text is turn ``depth`` of conversation ``conv_id``.
    """
    nodes = paths.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("pa").alias("pa"),
        F.max("pb").alias("pb"),
        F.max("n_chars").alias("n_chars"),
    )
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    tree = kept(
        nodes.join(children, KEY, "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0))
        )
    )
    own = tree.select(
        *KEY,
        "conv_id",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"),
    )
    totals = subtree_sums(own, paths, ["n_leaves", "saved_tokens"], band)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        with_parents(tree)
        .join(totals, KEY)
        .join(end_hashes(paths.where("last").select(*KEY, "conv_id")), KEY, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )


def with_parents(tree: DataFrame) -> DataFrame:
    """``tree`` with ``parent_conv_id``.

    Parents of more than a thousandth of all nodes, fewer than a thousand, are broadcast;
    a child of any other parent meets it with few siblings.
    """
    heavy = F.col("n_children") * HEAVY > tree.count()
    parents = tree.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("ka").alias("pa"),
        F.col("kb").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"),
        heavy.alias("heavy"),
    )
    up = ["depth", "pa", "pb"]
    known = tree.where("depth > 0").join(
        F.broadcast(parents.where("heavy").drop("heavy")), up, "left"
    )
    others = known.where("parent_conv_id IS NULL").drop("parent_conv_id")
    columns = [*tree.columns, "parent_conv_id"]
    roots = tree.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return (
        roots.select(*columns)
        .union(known.where("parent_conv_id IS NOT NULL").select(*columns))
        .union(others.join(parents.where("NOT heavy"), up).select(*columns))
    )


def subtree_sums(
    own: DataFrame, paths: DataFrame, values: list[str], band: int = BAND
) -> DataFrame:
    """``depth, ka, kb`` and the sums of ``values`` over each node's subtree, itself included.

    ``own`` has the key, a conversation that passes the node and the node's values.
    """
    deepest = own.agg(F.max("depth")).first()[0] or 0
    steps, step, level = [1], 1, own
    within = [kept(_added_up(level, paths, values, step, band, 0))]
    while step * band <= deepest:
        level = within[-1].where((F.col("depth") > 0) & (F.col("depth") % (step * band) == 0))
        step *= band
        steps.append(step)
        within.append(kept(_added_up(level, paths, values, step, band, 0)))
    whole = within[-1]
    for step, inside in zip(reversed(steps[:-1]), reversed(within[:-1]), strict=True):
        below = _added_up(whole.where("depth > 0"), paths, values, step, band, 1)
        whole = kept(_summed(inside.unionByName(below), KEY, values))
    return whole.select(*KEY, *values)


def _added_up(
    level: DataFrame, paths: DataFrame, values: list[str], step: int, band: int, above: int
) -> DataFrame:
    """Sums at the ancestors, every ``step`` turns, in a node's own band or the band ``above``."""
    height = step * band

    def band_of(depth: Column) -> Column:
        return F.floor(depth / height)

    ancestors = paths.where(F.col("depth") % step == 0).select(
        "conv_id",
        band_of(F.col("depth")).alias("band"),
        F.col("depth").alias("up"),
        "ka",
        "kb",
    )
    met = (
        level.select("conv_id", "depth", *values, (band_of(F.col("depth")) - above).alias("band"))
        .join(ancestors, ["conv_id", "band"])
        .where("up <= depth")
        .select("conv_id", F.col("up").alias("depth"), "ka", "kb", *values)
    )
    return _summed(met, KEY, values)


def _summed(rows: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(v).alias(v) for v in values]
    )


def end_hashes(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``depth, ka, kb, ends_sha256`` of ``depth, ka, kb, conv_id``.

    Ids are sorted and joined to texts of ``chunk`` ids in many tasks; one hash has to
    read its bytes in turn, so a node's texts then pass one task as a stream, never held together.
    """
    ranked = ranked_within(kept(ends), KEY, [F.col("conv_id")], "at", "n", "part")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string"))
    texts = ranked.groupBy(*KEY, F.floor(F.col("at") / chunk).alias("chunk")).agg(
        F.array_join(ids, ",").alias("ids")
    )
    stream = texts.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids")
    return stream.mapInArrow(_hashed, "depth bigint, ka bigint, kb bigint, ends_sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per run of equal keys; a run may go over any number of batches."""
    names = [*KEY, "ends_sha256"]
    key, state = None, None
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in (*KEY, "ids")]
        for *now, ids in zip(*columns, strict=True):
            if now != key:
                if state is not None:
                    done.append((*key, state.hexdigest()))
                key, state = now, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in done], SCHEMA)
    if state is not None:
        last = dict(zip(names, (*key, state.hexdigest()), strict=True))
        yield pa.RecordBatch.from_pylist([last], SCHEMA)


SCHEMA = pa.schema(
    [("depth", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("ends_sha256", pa.string())]
)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all conversations, rebuilt around their blocks' first turns."""
    turns = kept(numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return prefix_trie(kept(prefixes(*with_shared_heads(turns))))


# ``crc32`` byte by byte and bit by bit; its polynomial is a fixed value.
CRC32 = """list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(d)::BIGINT for d in string_split({text}, '')]),
    lambda c, d: list_reduce(
      list_prepend(xor(c, d), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))"""

SQL = f"""WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS txt,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS at
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (
  SELECT c, count(*) AS n, xor({CRC32.format(text="c::VARCHAR")}, 4294967295) % 6 AS h
  FROM t GROUP BY c),
g AS (
  SELECT s.*, least(h, coalesce((SELECT n FROM s z WHERE z.c = s.c - s.c % 100), 0)) AS got FROM s),
r AS (
  SELECT g.c, t.at AS d, role, txt FROM g JOIN t ON t.c = g.c - g.c % 100 AND t.at <= g.got
  UNION ALL
  SELECT g.c, g.got + t.at - g.h, role, txt FROM g JOIN t ON t.c = g.c AND t.at > g.h),
p AS (
  SELECT c, d, length(txt) AS len,
         string_agg(sha256(length(role) || ':' || role || txt), '')
           OVER (PARTITION BY c ORDER BY d) AS k,
         max(d) OVER (PARTITION BY c) = d AS last FROM r
  UNION ALL
  SELECT c, 0, 0, '', greatest(got + greatest(n - h, 0), 0) = 0 FROM g),
nodes AS (
  SELECT k, d, count(*) AS n_convs, min(c) AS conv_id, any_value(len) AS len,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM p GROUP BY k, d),
kids AS (
  SELECT left(k, 64 * (d - 1)) AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
v AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children, (n_convs - 1) * len AS saved
  FROM nodes LEFT JOIN kids ON kids.k = nodes.k),
sums AS (
  SELECT left(v.k, 64 * u.up) AS k, sum((n_children = 0)::INT) AS leaves, sum(saved) AS saved
  FROM v, unnest(generate_series(0, v.d)) AS u(up) GROUP BY 1)
SELECT v.conv_id, v.d::BIGINT AS depth, o.conv_id AS parent_conv_id, v.n_convs, v.n_children,
       sums.leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM v JOIN sums ON sums.k = v.k
LEFT JOIN nodes o ON v.d > 0 AND o.d = v.d - 1 AND o.k = left(v.k, 64 * (v.d - 1))"""

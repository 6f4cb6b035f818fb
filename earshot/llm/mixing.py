"""Mixing sources to target weights by Sainte-Lague apportionment.

Words are dealt to sources by highest quotient (votes divided by 1, 3, 5, ...).  A source
takes its words in blocks of equal length, which are dealt to its shards the same way; a shard
takes every block as often as its quota goes round, and the rest as a run of blocks in a
seeded order of its documents.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earshot.llm.common import WORD, kept, numbered, ranked_within, read_documents

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 64
LEAST_BLOCKS = 1_024
SHARD_WORDS = 250_000
SEED = 17
HEAVY = 1_000
# The table of sources is copied to every task only when it is known to be this small.
SMALL_ROWS = 50_000
SMALL_BYTES = 4_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source, source_size, rank, target`` from ``source, source_size``.

    Weights go round the sources in code point order, null last.  A target above
    ``MOST`` times its source's size stops there and what it leaves is shared
    among the others, again by weight, until none is above.
    """
    order = [F.col("source").isNull(), F.col("source")]
    ranked = numbered(sources, order, "rank")
    turn = F.col("rank") % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = kept(
        ranked.select(
            "source",
            "source_size",
            "rank",
            weight.alias("weight"),
            (F.col("source_size") * float(MOST)).alias("most"),
        )
    )
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    # A source is full once most / weight is at or below the level of the others.
    # Each round raises the level and can only add full sources.
    full_at = F.col("most") / F.col("weight")
    level, n_full = 0.0, -1
    while True:
        row = ranked.agg(
            F.count_if(full_at <= level).alias("n"),
            F.sum(F.when(full_at <= level, F.col("most")).otherwise(0.0)).alias("full"),
            F.sum(F.when(full_at > level, F.col("weight")).otherwise(0.0)).alias("open"),
        ).first()
        if row["n"] == n_full or not row["open"]:
            break
        n_full = row["n"]
        level = max(level, (total - row["full"]) / row["open"])
    target = F.when(full_at <= level, F.col("most")).otherwise(F.col("weight") * level)
    return ranked.select("source", "source_size", "rank", target.alias("target"))


def highest_quotients(parties: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``parties`` (stored) with ``quota``: ``seats`` of a group dealt to its members by ``votes``.

    ``seats`` is the same for all members of a group; ``order`` breaks ties and the group's
    columns hold no nulls.  Near the proportional share only a few quotients of each party can
    be in doubt: as many as its own share of the group moves when all others round the same way.
    Those are ranked, in ranges, so that no task sees a whole group; everything below is
    seated, everything above is not.
    """
    sums = parties.groupBy(*group).agg(
        F.sum("votes").alias("__votes"), F.count(F.lit(1)).alias("__n")
    )
    share = F.col("votes") / F.col("__votes")
    fair = F.when(F.col("__votes") > 0, F.floor(share * F.col("seats"))).otherwise(F.lit(0))
    doubt = F.when(F.col("__votes") > 0, F.ceil(share * F.col("__n"))).otherwise(F.lit(0)) + 2
    bounded = kept(
        told(parties, sums, group)
        .withColumn("__sure", F.greatest(F.lit(0), fair - doubt).cast("long"))
        .withColumn("__last", (fair + doubt).cast("long"))
        .select(*parties.columns, F.lit(0).alias("__all"), "__sure", "__last")
    )
    sures = bounded.groupBy(*group).agg(
        F.sum("__sure").alias("__sures"), F.count(F.lit(1)).alias("__n")
    )
    open_ = kept(
        bounded.withColumn("__seat", F.explode(F.sequence("__sure", "__last"))).withColumn(
            "__quotient", F.col("votes") / (2 * F.col("__seat") + 1)
        )
    )
    by_quotient = [F.col("__quotient").desc(), *[F.col(c) for c in order], F.col("__seat")]
    ranked = ranked_within(open_, group or ["__all"], by_quotient, "__place", "__size", "__part")
    won = (F.col("__place") < F.col("seats") - F.col("__sures")) & (F.col("votes") > 0)
    return (
        told(ranked, sures, group)
        .groupBy(*parties.columns, "__sure")
        .agg(F.count_if(won).alias("__won"))
        .select(*parties.columns, (F.col("__sure") + F.col("__won")).alias("quota"))
    )


def told(rows: DataFrame, facts: DataFrame, group: list[str]) -> DataFrame:
    """``rows`` with the ``facts`` of their group, one row per group with its number of rows ``__n``.

    Groups of more than a thousandth of all rows, fewer than a thousand, are broadcast; the
    rows of any other group meet their facts with few others.  Without groups there is one fact.
    """
    if not group:
        fact = facts.first()
        return rows.select("*", *[F.lit(fact[c]).alias(c) for c in facts.columns])
    facts = kept(facts)
    total = facts.agg(F.sum("__n")).first()[0] or 0
    heavy = F.col("__n") * HEAVY > total
    some = rows.join(F.broadcast(facts.where(heavy)), group, "left")
    others = some.where(F.col("__n").isNull()).select(*rows.columns)
    columns = [*rows.columns, *[c for c in facts.columns if c not in group]]
    return (
        some.where(F.col("__n").isNotNull())
        .select(*columns)
        .union(others.join(facts.where(~heavy), group).select(*columns))
    )


def mix(
    frame: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Decide what a mix takes of each row of ``row, key, tie, source, size``.

    ``row`` is carried along; ``key`` and ``tie`` place it in a shard and in its seeded order, so
    ``tie`` has to tell rows of one key apart unless they are alike.  Rows alike in both are
    interchangeable and stand together.
    Returns ``row, size, source_size, target`` and what :func:`pieces` needs: the
    row's start in its shard's stream of words, the shard's size, blocks, quota and phase.
    Rows of size zero and a null source are rows and a source like any other; an
    empty table gives an empty mix; repeated rows each have a place of their own.

    A source's blocks hold ``block_words`` words, fewer in a source that would otherwise have
    below ``LEAST_BLOCKS`` of them.  A quota beyond ``MOST`` times a shard's blocks, which rounding can
    give by a block or two where the target is that of all words, is cut to it.
    """
    shared = targets(frame.groupBy("source").agg(F.sum("size").alias("source_size")))
    words = shared.agg(F.sum("target")).first()[0] or 0
    in_words = highest_quotients(
        kept(
            shared.withColumn("votes", F.col("target")).withColumn(
                "seats", F.round(F.lit(words)).cast("long")
            )
        ),
        [],
        ["rank"],
    )
    block = F.greatest(
        F.lit(1), F.least(F.lit(block_words), F.floor(F.col("source_size") / LEAST_BLOCKS))
    )
    by_source = kept(
        in_words.select(
            "source",
            "source_size",
            "rank",
            "target",
            block.alias("block"),
            F.round(F.col("quota") / block).cast("long").alias("seats"),
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards"),
        )
    )
    placed = _with_source(frame, by_source).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed), "key", "tie"), "shards")
    )
    shards = placed.groupBy("rank", "shard").agg(
        F.sum("size").alias("shard_size"),
        F.first("block").alias("block"),
        F.first("seats").alias("seats"),
    )
    quotas = highest_quotients(
        kept(shards.withColumn("votes", F.col("shard_size").cast("double"))), ["rank"], ["shard"]
    ).select(
        "rank",
        "shard",
        "shard_size",
        F.greatest(F.lit(1), F.round(F.col("shard_size") / F.col("block")).cast("long")).alias(
            "blocks"
        ),
        "quota",
    )
    order = Window.partitionBy("rank", "shard").orderBy(
        F.xxhash64(F.lit(seed + 1), "key", "tie"), "key", "tie", "size"
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stream = placed.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    places = F.col("blocks") - F.col("quota") % F.col("blocks") + 1
    return stream.join(kept(quotas), ["rank", "shard"]).select(
        "row",
        "size",
        "source_size",
        "target",
        "start",
        "shard_size",
        "blocks",
        F.least("quota", F.col("blocks") * MOST).alias("quota"),
        F.pmod(F.xxhash64(F.lit(seed + 2), "rank", "shard"), places).alias("phase"),
    )


def _with_source(frame: DataFrame, by_source: DataFrame) -> DataFrame:
    """``frame`` with its source's line; copied to every task if it is known to be small."""
    size = by_source.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("source")).alias("bytes")
    ).first()
    small = size["n"] <= SMALL_ROWS and (size["bytes"] or 0) <= SMALL_BYTES
    right = (F.broadcast(by_source) if small else by_source).alias("s")
    return (
        frame.alias("d")
        .join(right, F.col("d.source").eqNullSafe(F.col("s.source")))
        .select(
            "row", "key", "tie", "size", "rank", "source_size", "target", "block", "seats", "shards"
        )
    )


def pieces() -> Column:
    """``start, end, times`` of the row's words; positions within the row.

    The quota goes round all blocks as often as it can; the rest is a run of blocks from a
    seeded phase on, in a stream whose rows already stand in seeded order.  So a row is cut at
    most where the run begins and ends.
    """
    rest = F.col("quota") % F.col("blocks")
    whole = F.floor(F.col("quota") / F.col("blocks"))
    cuts = [F.lit(0).cast("long"), edge(F.col("phase")), edge(F.col("phase") + rest), F.col("shard_size")]
    runs = [
        F.struct(
            (F.greatest(first, "start") - F.col("start")).alias("start"),
            (F.least(last, F.col("start") + F.col("size")) - F.col("start")).alias("end"),
            (whole + int(number == 1)).alias("times"),
        )
        for number, (first, last) in enumerate(itertools.pairwise(cuts))
    ]
    return F.filter(F.array(*runs), lambda p: p["start"] < p["end"]).cast(PIECES)


def edge(block: Column) -> Column:
    """The first word of a block: the blocks of a shard differ by one word at most."""
    return F.floor(block * F.col("shard_size") / F.col("blocks")).cast("long")


PIECES = "array<struct<start:bigint,end:bigint,times:bigint>>"


def words_taken(found: Column) -> Column:
    return F.aggregate(
        found, F.lit(0).cast("long"), lambda n, p: n + (p["end"] - p["start"]) * p["times"]
    )


def _alike(docs: DataFrame) -> Column:
    """A hash of the whole row; maps have no order to hash."""
    return F.xxhash64(*[F.col(f"`{name}`") for name, kind in docs.dtypes if "map<" not in kind])


def shares(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``doc_id, source, text``."""
    sizes = kept(
        docs.select(
            F.col("doc_id").alias("row"),
            F.col("doc_id").alias("key"),
            _alike(docs).alias("tie"),
            "source",
            word_count(F.col("text")).alias("size"),
        )
    )
    return mix(sizes).select(
        F.col("row").alias("doc_id"),
        "size",
        "source_size",
        "target",
        words_taken(pieces()).alias("taken"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents."""
    return shares(read_documents(spark, sf_dir))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them, in the columns of ``docs``.

    The mix goes over the words up to twice.  Documents of one id stand in the order of their
    rows' hashes; rows that are alike are interchangeable.  A round that takes all words of a
    document returns it untouched; one that takes some returns the words of the chosen
    blocks, joined by single spaces, with ``n_chars`` (if there is such a column)
    counted anew; one that takes none returns nothing.  A document without words is
    never taken.
    """
    frame = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("key"),
        _alike(docs).alias("tie"),
        "source",
        word_count(F.col("text")).alias("size"),
    )
    mixed = mix(frame).withColumn("pieces", pieces())
    rounds = mixed.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(MOST))))
    taken = rounds.withColumn(
        "pieces", F.filter("pieces", lambda p: p["times"] >= F.col("round"))
    ).where(F.size("pieces") > 0)
    n_words = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["start"])
    words = F.regexp_extract_all(F.col("row.text"), F.lit(WORD), F.lit(0))
    part = F.array_join(
        F.flatten(
            F.transform(
                "pieces",
                lambda p: F.slice(
                    "words", (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int")
                ),
            )
        ),
        " ",
    )
    taken = (
        taken.withColumn("whole", n_words == F.col("size"))
        .withColumn("words", F.when(~F.col("whole"), words))
        .withColumn("text", F.when(F.col("whole"), F.col("row.text")).otherwise(part))
    )
    fresh = {
        "text": F.col("text"),
        "n_chars": F.when(F.col("whole"), F.col("row.n_chars")).otherwise(F.char_length("text"))
        if "n_chars" in docs.columns
        else None,
    }
    return taken.select(
        *[
            (fresh[f.name] if f.name in fresh else F.col(f"row.`{f.name}`"))
            .cast(f.dataType)
            .alias(f.name)
            for f in docs.schema.fields
        ]
    )

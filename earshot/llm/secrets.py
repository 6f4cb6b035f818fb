"""Secret scans: fixed patterns, and windows of high entropy inside candidate strings.

Column expressions only: a scan is a map over the rows.  Positions are code points,
ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm.common import free_names, let, read_documents

# The patterns of the base kinds, in their order, and their least lengths.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run below 20 characters holds no longer one
HEX = r"[0-9a-f]{24,}"  # whole runs: a shorter run holds no longer one
KINDS = ("assign", "access", "hex", "entropy")

# A candidate is a whole run of key characters with a letter in it.
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*[A-Za-z])"
    r"[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])"
)
WINDOW = 20
# Character classes and the bits per character that a window of each must reach.  The
# most that 20 characters can have is 4 bits in hex and log2(20) = 4.32 otherwise.
HEX_ONLY, HEX_BITS = r"\A[0-9a-fA-F]+\z", 3.0
MIXED_BITS = 3.6
# What looks random but is not: dates and numbers with separators, UUIDs, paths of plain
# words, letters that are words by their case, and runs that repeat one short piece.
ALLOWED = (
    r"\A[0-9+/_=-]*\z",
    r"(?i)\A[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z",
    # Possessive: a run of any number of parts is matched in a loop, not by recursion.
    r"\A(?:[a-z]+|[0-9]{1,4})(?:[/_-](?:[A-Za-z][a-z]*+|[0-9]{1,4}+))*+\z",
    r"\A[/_=+-]*+(?:(?:(?:[A-Z]?[a-z]{2,}+)++|[A-Za-z][a-z]?|[A-Z]{1,15}+)(?:[/_=+-]++|\z))*+\z",
    r"\A(.{1,6}?)\1{2,}.{0,5}\z",
)

# Words of examples: windows that they are in do not count, others of the run do.
EXAMPLES = r"(?i)(?:example|sample|dummy|placeholder|xxxx|0123456789|abcdefgh)[/_=+-]*+"

# Arrays are added to in blocks of this many.
BLOCK = 64

SPAN = "array<struct<start:int,rank:int,end:int>>"


def _came_before(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """What ``add`` has made of all values before each one, ``zero`` before the first.

    In blocks of :data:`BLOCK`, so that adding to an array never copies a long one.
    """

    def in_turn(some: Column, first: Column) -> Column:
        return F.aggregate(
            some,
            F.struct(first.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda s, x: F.struct(
                add(s["at"], x).alias("at"), F.array_append(s["out"], s["at"]).alias("out")
            ),
            lambda s: s["out"],
        )

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, zero, add))
        return let(
            in_turn(totals, zero),
            lambda firsts: F.flatten(
                F.transform(blocks, lambda block, i: in_turn(block, F.get(firsts, i)))
            ),
        )

    last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), last), lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK))
    )
    return F.when(F.size(values) > 0, let(blocks, joined)).otherwise(F.array().cast("array<int>"))


def _positions(text: Column, pattern: str) -> Column:
    """``start, end`` of each match, left to right, not overlapping: from the gaps between."""
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    lengths = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.char_length)

    def placed(both: Column) -> Column:
        steps = F.transform(both, lambda x: x["gap"] + x["length"])
        return let(
            _came_before(steps, F.lit(0), lambda a, b: a + b),
            lambda before: F.transform(
                both,
                lambda x, i: F.struct(
                    (F.get(before, i) + x["gap"]).alias("start"),
                    (F.get(before, i) + x["gap"] + x["length"]).alias("end"),
                ),
            ),
        )

    both = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(lengths)).alias("gap"), lengths.alias("length")),
        lambda x: F.struct(x["gap"].alias("gap"), x["length"].alias("length")),
    )
    return let(both, placed)


def _spans(text: Column, kind: str, pattern: str, good: Column | None = None) -> Column:
    """``start, rank, end`` of the matches; ``good`` holds a flag for each match."""
    found = _positions(text, pattern)
    if good is not None:
        found = F.transform(
            F.filter(
                F.arrays_zip(found.alias("p"), good.alias("good")), lambda x: x["good"]
            ),
            lambda x: x["p"],
        )
    rank = F.lit(KINDS.index(kind))
    spans = F.transform(
        found, lambda p: F.struct(p["start"].alias("start"), rank.alias("rank"), p["end"].alias("end"))
    )
    # A row without a match is the usual case and ends at this test.
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def highest_entropy(
    candidate: Column, window: int = WINDOW, enough: Column | float = float("inf")
) -> Column:
    """The most Shannon entropy, in bits per character, of any ``window`` characters.

    Ends at the first window that has ``enough``, with that window's.

    Slides by one character at a time: the counts of the one that enters and the one that
    leaves change, and with them the sum of ``n log n`` that the entropy follows from.
    Text shorter than the window is one window.
    """
    chars = F.split(candidate, "")
    length = F.char_length(candidate)
    width = F.least(F.lit(window), length)

    def nlogn(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))

    def step(s: Column, at: Column, string: Column) -> Column:
        enters = F.element_at(string, at)
        leaves = F.when(at > width, F.element_at(string, F.greatest(at - width, F.lit(1))))
        # The character that leaves goes first, so a window never holds one too many.
        had = F.coalesce(F.element_at(s["counts"], leaves), F.lit(0))
        less = F.when(leaves.isNotNull(), nlogn(had - 1) - nlogn(had)).otherwise(F.lit(0.0))
        now = F.coalesce(F.element_at(s["counts"], enters), F.lit(0)) - (
            enters.eqNullSafe(leaves)
        ).cast("int")
        total = s["total"] + less + nlogn(now + 1) - nlogn(now)
        moved = F.map_concat(
            F.map_filter(s["counts"], lambda c, _: (c != enters) & ~c.eqNullSafe(leaves)),
            F.when(
                leaves.isNotNull() & (leaves != enters), F.create_map(leaves, had - 1)
            ).otherwise(F.create_map().cast("map<string,int>")),
            F.create_map(enters, now + 1),
        )
        bits = F.log2(width.cast("double")) - total / width
        return F.struct(
            moved.alias("counts"),
            total.alias("total"),
            F.when(at >= width, F.greatest(s["most"], bits)).otherwise(s["most"]).alias("most"),
        )

    start = F.struct(
        F.create_map().cast("map<string,int>").alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0.0).alias("most"),
    )
    # Bound once as a lambda variable, the characters are split once.
    folded = F.transform(
        F.array(chars),
        lambda string: F.aggregate(
            F.sequence(F.lit(1), length),
            start,
            lambda s, at: F.when(s["most"] >= enough, s).otherwise(step(s, at, string)),
            lambda s: s["most"],
        ),
    )
    return F.when(length > 0, F.element_at(folded, 1)).otherwise(F.lit(0.0))


def is_random(candidate: Column) -> Column:
    """Does a window of the candidate reach its class's entropy, and is it not allowed?

    Words of examples cut the candidate; only windows within a piece count.
    """

    def allowed(piece: Column) -> Column:
        found = F.lit(False)
        for pattern in ALLOWED:
            found = found | piece.rlike(pattern)
        return found

    def reaches(piece: Column) -> Column:
        least = F.when(piece.rlike(HEX_ONLY), HEX_BITS).otherwise(MIXED_BITS)
        return (
            F.when(F.char_length(piece) < WINDOW, False)
            .when(allowed(piece), False)
            .otherwise(highest_entropy(piece, enough=least) >= least)
        )

    return F.when(allowed(candidate), False).otherwise(
        F.exists(F.split(candidate, EXAMPLES, -1), reaches)
    )


def _counts_before(points: Column, queries: Column, with_equal: bool) -> Column:
    """For each query how many points are below it (or equal); both are in order."""
    query = 2 if with_equal else 0  # points are 1
    merged = F.array_sort(
        F.concat(
            F.transform(points, lambda p: F.struct(p.alias("at"), F.lit(1).alias("what"))),
            F.transform(queries, lambda q: F.struct(q.alias("at"), F.lit(query).alias("what"))),
        )
    )
    numbered = F.transform(merged, lambda x, i: F.struct(x["what"].alias("what"), i.alias("i")))
    asked = F.filter(numbered, lambda x: x["what"] == query)
    return F.transform(asked, lambda x, j: x["i"] - j)


def _uncovered(found: Column, base: Column) -> Column:
    """The spans of ``found`` that are not wholly inside spans of ``base``; both are in order.

    Spans of ``found`` do not overlap, so each span of ``base`` that starts within one is looked at
    once; those that start before it count by how far any of them reaches.
    """
    starts = F.transform(base, lambda b: b["start"])
    ends = F.transform(base, lambda b: b["end"])
    facts = F.struct(
        _came_before(ends, F.lit(0), lambda a, b: F.greatest(a, b)).alias("reach"),
        _counts_before(starts, F.transform(found, lambda r: r["start"]), True).alias("low"),
        _counts_before(starts, F.transform(found, lambda r: r["end"]), False).alias("high"),
    )

    def left(known: Column) -> Column:
        def covered(span: Column, i: Column) -> Column:
            low, high = F.get(known["low"], i), F.get(known["high"], i)
            # The reach before the first span that starts later; after all, that of the last.
            before = F.greatest(
                F.coalesce(F.get(known["reach"], low - 1), F.lit(0)),
                F.coalesce(F.get(ends, low - 1), F.lit(0)),
            )
            reached = F.aggregate(
                F.slice(base, low + 1, F.greatest(high - low, F.lit(0))),
                F.greatest(span["start"], before),
                lambda at, b: F.when(b["start"] <= at, F.greatest(at, b["end"])).otherwise(at),
            )
            return reached >= span["end"]

        marked = F.transform(
            found, lambda r, i: F.struct(r.alias("span"), covered(r, i).alias("covered"))
        )
        return F.transform(F.filter(marked, lambda m: ~m["covered"]), lambda m: m["span"])

    return let(facts, left)


def spans(text: Column) -> Column:
    """All spans of a text as ``start, rank, end`` in order; ``rank`` counts in ``KINDS``.

    Base spans are the pattern matches.  Entropy adds whole candidate runs; one that is
    inside base spans adds nothing and is left out.  Null is empty text.
    """
    text = F.coalesce(text, F.lit(""))
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_enough = F.transform(values, lambda v: F.char_length(v) >= ASSIGN_VALUE)
    base = F.array_sort(
        F.concat(
            _spans(text, "assign", ASSIGN, long_enough),
            _spans(text, "access", ACCESS),
            _spans(text, "hex", HEX),
        )
    )
    candidates = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    random = _spans(text, "entropy", CANDIDATE, F.transform(candidates, is_random))
    return let(
        F.struct(base.alias("base"), random.alias("random")),
        lambda x: F.when(F.size(x["random"]) == 0, x["base"]).otherwise(
            F.array_sort(F.concat(x["base"], _uncovered(x["random"], x["base"])))
        ),
    )


def written(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(
                ":",
                F.get(names, s["rank"]),
                s["start"].cast("string"),
                s["end"].cast("string"),
            ),
        ),
        ",",
    )


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, text, found`` for every row: its spans in order, none for null or empty text.

    The spans go through a generator so that they are found once per row, not once per
    column made of them.
    """
    found = F.struct(spans(F.col("text")).alias("found"))
    return docs.select("doc_id", "text", F.inline(F.array(found)))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents."""
    found = F.col("found")

    def count(kind: str) -> Column:
        rank = KINDS.index(kind)
        return F.size(F.filter(found, lambda s: s["rank"] == rank)).cast("long")

    entropy = KINDS.index("entropy")
    return scan(read_documents(spark, sf_dir)).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(written(F.filter(found, lambda s: s["rank"] != entropy)), 256).alias("base_sha256"),
        written(found).alias("spans"),
    )


MARK = "[REMOVED]"


def redacted(docs: DataFrame, mark: str = MARK) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; all rows stay.

    Rows without a span are untouched.  Overlapping spans are replaced as one.
    ``n_chars``, where there is such a column, is counted anew for rows that change.
    """
    found, had, clean_text = free_names(docs.columns, "found", "had", "clean_text")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    scanned = docs.select(
        *columns, F.inline(F.array(F.struct(spans(F.col("text")).alias(found))))
    )
    text = F.col("text")
    clean = _without(text, F.col(found), mark)
    has = F.size(found) > 0
    new_text = F.when(has, clean).otherwise(text).alias(clean_text)
    cleaned = scanned.select(
        *columns, has.alias(had), F.inline(F.array(F.struct(new_text)))
    )
    fresh = {
        "text": F.col(clean_text),
        "n_chars": F.when(F.col(had), F.char_length(clean_text)).otherwise(F.col("n_chars"))
        if "n_chars" in docs.columns
        else None,
    }
    return cleaned.select(
        *[
            _cast(fresh.get(f.name, F.col(f"`{f.name}`")), f).alias(f.name)
            for f in docs.schema.fields
        ]
    )


def _without(text: Column, found: Column, mark: str) -> Column:
    """``text`` with the spans replaced, those that overlap as one.

    The text is cut at every :data:`BLOCK`-th span first, as finding a position means
    counting characters from the start of what it is in.
    """
    ends = F.transform(found, lambda s: s["end"])

    def kept_before(reach: Column) -> Column:
        """For each span that does not overlap the one before: from where text is kept, to where."""
        return F.filter(
            F.transform(
                found,
                lambda s, i: F.struct(
                    F.get(reach, i).alias("first"), s["start"].alias("last")
                ),
            ),
            lambda k: k["first"] <= k["last"],
        )

    def cut(keeps: Column) -> Column:
        def block(b: Column) -> Column:
            some = F.slice(keeps, b * BLOCK + 1, F.lit(BLOCK))
            low = F.get(some, F.lit(0))["first"]
            high = F.element_at(some, -1)["last"]
            return let(
                F.struct(F.substring(text, low + 1, high - low).alias("text"), low.alias("low")),
                lambda x: F.array_join(
                    F.transform(
                        some,
                        lambda k: F.concat(
                            F.substring(
                                x["text"], k["first"] - x["low"] + 1, k["last"] - k["first"]
                            ),
                            F.lit(mark),
                        ),
                    ),
                    "",
                ),
            )

        blocks = F.sequence(F.lit(0), F.floor((F.size(keeps) - 1) / BLOCK).cast("int"))
        return F.array_join(F.transform(blocks, block), "")

    before = let(
        _came_before(ends, F.lit(0), lambda a, b: F.greatest(a, b)),
        lambda reach: let(kept_before(reach), cut),
    )
    return F.concat(before, F.substring(text, F.array_max(ends) + 1, F.char_length(text)))


def _cast(value: Column, field: T.StructField) -> Column:
    return value.cast(field.dataType)

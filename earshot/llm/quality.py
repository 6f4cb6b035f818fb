"""Quality rules by host: a host's failure rates, each shrunk by an empirical beta prior.

Column expressions only.  A document's measures stay within its row; hosts are a grouped
sum; the priors are a row for each rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import kept, read_documents

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Rules that hosts are judged by, as SQL that Spark and DuckDB share.
RULES = {
    "short": f"n_words < {MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "dup_lines": "10 * n_dup_lines > n_words",
}
# A host is bad by a rule when its rate, less so many standard deviations of what its own documents
# leave open, is above the mean by so many of the spread of all hosts.
DEVIATIONS = 2
# White space between words, and symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The words; a literal split is several times faster than matching them."""
    plain = F.translate(text, SPACES[1:], " " * (len(SPACES) - 1))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _bind(value: Column, name: str) -> Column:
    """A generator of one row: ``value`` is computed once, whatever uses it afterwards."""
    return F.inline(F.array(F.struct(value.alias(name))))


def measures(docs: DataFrame, *carried: str) -> DataFrame:
    """``carried``, then ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Null text has no words and no lines; a text without words measures zero throughout.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.select(*carried, text.alias("text"), _bind(words_of(text), "words"))
    # Windows are compared by 64-bit hashes; most texts repeat none and end there.
    last = F.size("words") - WINDOW
    window = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]),
    )
    hashes = F.when(last >= 0, window).otherwise(F.array().cast("array<bigint>"))
    two = one.select(*carried, "text", "words", _bind(hashes, "hashes"))
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    dup_lines = F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    without = F.translate("text", SPACES, "")
    return two.select(
        *carried,
        F.size("words").cast("long").alias("n_words"),
        F.char_length(without).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        F.element_at(dup_lines, 1).cast("long").alias("n_dup_lines"),
        F.when(repeated, _covered(F.col("hashes"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice: sort by hash, mark equal neighbours, add up."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def marked(rows: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            return F.get(rows, a)["h"] == F.get(rows, b)["h"]

        return F.filter(
            F.transform(
                rows,
                lambda r, at: F.when(
                    F.coalesce(same(at, at - 1), F.lit(False))
                    | F.coalesce(same(at, at + 1), F.lit(False)),
                    r["i"],
                ),
            ),
            lambda i: i.isNotNull(),
        )

    def total(starts: Column) -> Column:
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda s, i: F.struct(
                (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")
            ),
            lambda s: s["n"],
        )

    # ``transform`` over an array of one binds a value to a lambda variable.
    starts = F.element_at(F.transform(F.array(placed), marked), 1)
    return F.element_at(F.transform(F.array(F.array_sort(starts)), total), 1)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def host_verdicts(rows: DataFrame) -> DataFrame:
    """``host, host_docs, host_rate, host_bad`` from ``host, failed``; a null host is one host."""
    return host_rules(rows, ["failed"]).select(
        "host", "host_docs", F.col("failed_rate").alias("host_rate"), "host_bad"
    )


def host_rules(rows: DataFrame, rules: Sequence[str]) -> DataFrame:
    """``host, host_docs``, a ``_rate`` for each rule, and ``host_bad``: bad by any of them.

    ``rows`` has ``host`` and a flag per rule.  A rule's beta prior is fitted to the hosts' rates by
    the method of moments, hosts weighted by their documents and the binomial part of the
    spread taken off.  Where the hosts differ no more than chance would have it, the prior takes
    over, all get the mean and none is bad: the bar is the hosts' own spread.
    """
    hosts = kept(
        rows.groupBy("host").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.col(rule).cast("long")).alias(rule) for rule in rules],
        )
    )
    counts = hosts.select(
        "host",
        "n",
        F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("k")) for r in rules])),
    )
    n, rate = F.col("n"), F.col("k") / F.col("n")
    mean = counts.groupBy("rule").agg(
        (F.sum("k") / F.sum("n")).alias("mean"),
        F.sum("n").alias("docs"),
        F.count(F.lit(1)).alias("hosts"),
        F.sum(n * n).alias("squares"),
    )
    spread = (
        counts.join(F.broadcast(mean), "rule")  # a row for each rule
        .groupBy("rule", "mean", "docs", "hosts", "squares")
        .agg(F.sum(n * (rate - F.col("mean")) * (rate - F.col("mean"))).alias("q"))
    )
    noise = F.col("mean") * (1 - F.col("mean"))
    weight = F.col("docs") - F.col("squares") / F.col("docs")
    between = (F.col("q") - (F.col("hosts") - 1) * noise) / weight
    # Var(rate) = noise / (strength + 1) for a beta of that strength.
    strength = F.when(
        (weight > 0) & (between > 0) & (noise > between), noise / between - 1
    ).when((weight > 0) & (between > 0), F.lit(0.0))
    prior = spread.select("rule", "mean", strength.alias("strength"))
    s, m = F.col("strength"), F.col("mean")
    shrunk = F.when(s.isNull(), m).otherwise((F.col("k") + m * s) / (n + s))
    open_ = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (n + s + 1))
    bar = m + DEVIATIONS * F.sqrt(m * (1 - m) / (s + 1))
    judged = (
        counts.join(F.broadcast(prior), "rule")
        .withColumn("rate", shrunk)
        .withColumn("bad", F.coalesce(F.col("rate") - DEVIATIONS * open_ > bar, F.lit(False)))
    )
    return judged.groupBy("host").agg(
        F.max("n").alias("host_docs"),
        *[F.max(F.when(F.col("rule") == r, F.col("rate"))).alias(f"{r}_rate") for r in rules],
        F.max("bad").alias("host_bad"),
    )


def judged(docs: DataFrame) -> DataFrame:
    """Every row's measures, its base rule, its host's rates and the verdict.

    Columns ``doc_id, host, n_words, ..., base_failed, short_rate, ..., kept``; the host is
    ``source``.
    """
    named = docs.select("doc_id", F.col("source").alias("host"), "text")
    measured = kept(
        measures(named, "doc_id", "host").withColumn("base_failed", base_failed())
    )
    flags = measured.select("host", *[F.expr(rule).alias(name) for name, rule in RULES.items()])
    verdicts = kept(host_rules(flags, list(RULES)))
    found = measured.alias("m").join(
        verdicts.alias("v"), F.col("m.host").eqNullSafe(F.col("v.host"))
    )
    return found.select(
        "m.*",
        *[F.round(f"{name}_rate", 9).alias(f"{name}_rate") for name in RULES],
        (~F.col("base_failed") & ~F.col("host_bad")).alias("kept"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents."""
    return judged(read_documents(spark, sf_dir)).drop("host")


_MEASURED = r"""WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln
  FROM docs),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g
  FROM split, unnest(generate_series(1, len(w) - 4)) AS u(i)),
twice AS (
  SELECT doc_id, i FROM (
    SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n
  FROM twice, unnest([0, 1, 2, 3, 4]) AS u(k) GROUP BY doc_id),
m AS (
  SELECT s.doc_id, source, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id),
j AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)"""

_RULES_LONG = "\n  UNION ALL\n  ".join(
    f"SELECT source, '{name}' AS rule, count(*) AS n, sum(({rule})::INT) AS k FROM j GROUP BY source"
    for name, rule in RULES.items()
)
_RATES = ",\n         ".join(
    f"max(CASE WHEN rule = '{name}' THEN rate END) AS {name}_rate" for name in RULES
)

SQL = (
    _MEASURED
    + f""",
h AS (
  {_RULES_LONG}),
a AS (
  SELECT rule, sum(k) / sum(n) AS mean, sum(n) AS docs, count(*) AS hosts, sum(n * n) AS sq
  FROM h GROUP BY rule),
q AS (
  SELECT rule, mean, mean * (1 - mean) AS noise, hosts, docs - sq / docs AS weight,
         sum(n * (k / n - mean) * (k / n - mean)) AS q
  FROM h JOIN a USING (rule) GROUP BY ALL),
b AS (
  SELECT rule, mean, noise, weight, (q - (hosts - 1) * noise) / weight AS between_hosts FROM q),
p AS (
  SELECT rule, mean, CASE WHEN weight > 0 AND between_hosts > 0 AND noise > between_hosts
                          THEN noise / between_hosts - 1
                          WHEN weight > 0 AND between_hosts > 0 THEN 0.0 END AS strength FROM b),
r AS (
  SELECT source, rule, n, mean, strength,
         CASE WHEN strength IS NULL THEN mean
              ELSE (k + mean * strength) / (n + strength) END AS rate
  FROM h JOIN p USING (rule)),
v AS (
  SELECT source, {_RATES},
         bool_or(coalesce(rate - {DEVIATIONS} * sqrt(rate * (1 - rate) / (n + strength + 1))
           > mean + {DEVIATIONS} * sqrt(mean * (1 - mean) / (strength + 1)), false)) AS host_bad
  FROM r GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       {", ".join(f"round({name}_rate, 9) AS {name}_rate" for name in RULES)},
       NOT base_failed AND NOT host_bad AS kept
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source"""
)

"""Quality rules as a ledger of failure bits (DataFrame functions only).

``measure`` evaluates every measurement once per text, ``ledger`` turns them
into one bit a rule (set: the rule fails). Policies are versioned masks over
these bits, so applying a policy, changing it, or asking what each rule costs
(``ablation``) never reads the texts again: it is bitwise arithmetic and one
aggregation over the ledger.

Words are maximal runs outside ``[\\x20\\x09-\\x0D]``; null text counts as
empty: no words, no lines with a word, all counts 0, so it fails
``few_words``. Rows stay rows; repeated rows are judged each on their own.
Work is linear in the text, but for texts with repeated windows, whose windows
are sorted once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh_name, stored

SPACES = " \t\n\x0b\x0c\r"
GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
WINDOW = 8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A named failure test over a struct of measurements."""

    name: str
    bit: int
    fails: Callable[[Column], Column]


#: A rule keeps its bit for ever.
RULES = (
    Rule("few_words", 0, lambda m: m["n_words"] < 20),
    Rule("repeated_windows", 1, lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    Rule("symbols", 2, lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("short_words", 3, lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule("long_words", 4, lambda m: m["word_chars"] > 20 * m["n_words"]),
    Rule("duplicate_lines", 5, lambda m: 100 * m["n_dup_lines"] > 50 * m["n_lines"]),
)

#: Policy version -> names of the rules that reject. The base rules are in all.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: ("few_words", "repeated_windows", "symbols", "short_words", "long_words", "duplicate_lines"),
}
CURRENT = 2
BASE = 1


def mask(version: int) -> int:
    return sum(1 << r.bit for r in RULES if r.name in POLICIES[version])


def measure(docs: DataFrame, into: str) -> DataFrame:
    """``docs`` and a struct column ``into`` with the measurements.

    What a lambda reads more than once is a column of its own, so that it is
    computed once a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<bigint>")
    words, hashes, windows, lines, pairs, places = names = [
        fresh_name(docs, x) for x in ("_words", "_hashes", "_windows", "_lines", "_pairs", "_places")]
    inner = F.btrim(text, F.lit(SPACES))
    df = docs.withColumn(words, F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, GAP)))
    df = df.withColumn(lines, F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(SPACES)) != ""))
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    h, w, p = F.col(hashes), F.col(windows), F.col(pairs)
    df = df.withColumn(windows, F.when(
        F.size(h) >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                    lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))).otherwise(none))
    # Sorted (window, place) pairs of the texts in which a window occurs again; null for the others.
    df = df.withColumn(pairs, F.when(
        F.size(F.array_distinct(w)) < F.size(w),
        F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    df = df.withColumn(places, F.sort_array(F.filter(F.transform(p, lambda x, j: F.when(
        (F.get(p, j - 1)["h"] == x["h"]) | (F.get(p, j + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull())))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n"),
                                (i + WINDOW).alias("end")),
        lambda acc: acc["n"])
    df = df.withColumn(into, F.struct(
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.regexp_replace(text, GAP, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    ))
    return df.drop(*names)


def _bits(measured: Column) -> Column:
    """One bit for each rule that fails."""
    out = F.lit(0).cast("bigint")
    for r in RULES:
        out = out + F.when(r.fails(measured), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("bigint")
    return out


def ledger(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per input row: the key, every measurement, ``failed_rules``.
    Written to the shared folder (without the texts), so that policies and
    ablations read stored bits."""
    df = measure(docs.select(key, "text"), "_measured")
    m = F.col("_measured")
    rows = df.select(key, *[m[c].alias(c) for c in MEASURES], _bits(m).alias("failed_rules"))
    return stored(rows, "quality-ledger")


def rejects(bits: Column, version: int = CURRENT) -> Column:
    """Does a policy reject a row with these failure bits?"""
    return bits.bitwiseAND(F.lit(mask(version)).cast("bigint")) != 0


def keep(docs: DataFrame, version: int = CURRENT) -> DataFrame:
    """The rows of ``docs`` (all columns, unchanged) that the policy keeps.

    The row number makes the filter stay above the measurements; pushed below
    them it would repeat each of them many times."""
    m, bits, row = (fresh_name(docs, x) for x in ("_measured", "_failed_rules", "_row"))
    marked = measure(docs, m).withColumn(bits, _bits(F.col(m))).drop(m)
    marked = marked.withColumn(row, F.monotonically_increasing_id())
    return marked.filter((F.col(row) >= 0) & ~rejects(F.col(bits), version)).drop(bits, row)


def ablation(rows: DataFrame, version: int = CURRENT) -> DataFrame:
    """For each rule of a policy, from one bitwise aggregation of a ledger:
    rows that fail it, rows that only it rejects, rows kept with the whole
    policy and without the rule."""
    whole = mask(version)
    used = [r for r in RULES if r.name in POLICIES[version]]
    f = F.col("failed_rules").bitwiseAND(F.lit(whole).cast("bigint"))
    aggs = [F.count_if(f == 0).alias("kept")]
    for r in used:
        bit = F.lit(1 << r.bit).cast("bigint")
        aggs += [F.count_if(f.bitwiseAND(bit) != 0).alias(f"f{r.bit}"), F.count_if(f == bit).alias(f"o{r.bit}")]
    one = rows.agg(*aggs)
    return one.select(F.explode(F.array(*[F.struct(
        F.lit(version).alias("policy"), F.lit(r.name).alias("rule"), F.col(f"f{r.bit}").alias("n_failed"),
        F.col(f"o{r.bit}").alias("n_only"), F.col("kept").alias("n_kept"),
        (F.col("kept") + F.col(f"o{r.bit}")).alias("n_kept_without"),
    ) for r in used])).alias("r")).select("r.*")

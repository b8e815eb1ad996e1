"""Quality rules whose cutoffs follow the corpus: quantile sketches per language and source.

Each document is measured with built-in functions. Every measure goes into a log-linear histogram: a value keeps
its six leading bits, which bounds its relative error by 1/32 and the number of cells per group by about 1,900.
Such a histogram is a quantile sketch that merges by adding counts, in any order and with the same result, so
repeated tasks cannot change a cutoff. Sketches are kept per (language, source) and merged into coarser ones per
language and over all; a group with fewer than `min_rows` documents takes the next coarser sketch.

A document fails when a measure lies beyond the far fence of its group: the upper quartile plus `reach` times the
distance between the quartiles, or plus the measure's own `margin` where that is more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedhouse.llm.common import SPACE_RUN, SPACES, documents, settle

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Leading bits that a histogram cell keeps.
CELL_BITS = 6

# Thresholds are broadcast up to so many groups, at most about 200 bytes each; beyond that they are joined by shuffle.
BROADCAST_GROUPS = 50_000
SALTS = 16

_WORDS, _LINES, _WINDOWS, _SORTED, _HITS = "_q_words", "_q_lines", "_q_windows", "_q_sorted", "_q_hits"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["symbol_share", "dup_line_share", "repeat_share", "word_length"]


@dataclass(frozen=True)
class Fences:
    """Settings of the adaptive cutoffs. Margins: per mille, `word_length` in hundredths of a code point."""

    reach: int = 4
    min_rows: int = 100
    symbol_share: int = 60
    dup_line_share: int = 500
    repeat_share: int = 250
    word_length: int = 400


def with_measures(docs: DataFrame) -> DataFrame:
    """`docs` plus the five counts of BASE and the four scaled shares of SHARES, all bigint.

    Null text counts as empty. Columns of `docs` with these names are replaced. Texts are taken whole.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = F.lit(SPACES)
    docs = docs.drop(*BASE, *SHARES, _WORDS, _LINES, _WINDOWS, _SORTED, _HITS)
    own = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]
    split = docs.select(
        *own,
        F.array_remove(F.split(text, SPACE_RUN), "").alias(_WORDS),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(_LINES),
        F.char_length(F.translate(text, SPACES, "")).cast("bigint").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    count = F.size(_WORDS)
    windows = F.when(
        count >= WINDOW_WORDS,
        F.transform(
            F.sequence(F.lit(1), F.greatest(count - (WINDOW_WORDS - 1), F.lit(1))),
            lambda i: F.xxhash64(F.slice(_WORDS, i, WINDOW_WORDS)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        *own, "word_chars", "n_symbols",
        count.cast("bigint").alias("n_words"),
        F.size(_LINES).cast("bigint").alias("_q_n_lines"),
        (F.size(_LINES) - F.size(F.array_distinct(_LINES))).cast("bigint").alias("n_dup_lines"),
        windows.alias(_WINDOWS),
    )
    # Only texts with a window that occurs twice are sorted.
    ordered = counted.withColumn(_SORTED, F.when(
        F.size(F.array_distinct(_WINDOWS)) < F.size(_WINDOWS),
        F.sort_array(F.transform(_WINDOWS, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    at = lambda k: F.get(F.col(_SORTED), k)["h"]
    hits = ordered.withColumn(_HITS, F.sort_array(F.filter(
        F.transform(_SORTED, lambda x, k: F.when((at(k - 1) == x["h"]) | (at(k + 1) == x["h"]), x["i"])),
        lambda i: i.isNotNull(),
    )))
    # Windows that start closer than their length overlap; the last one counts in full.
    covered = F.aggregate(
        F.transform(_HITS, lambda i, k: F.least(F.lit(WINDOW_WORDS), F.coalesce(
            F.get(F.col(_HITS), k + 1) - i, F.lit(WINDOW_WORDS)))),
        F.lit(0).cast("bigint"), lambda a, x: a + x,
    )
    measured = hits.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))
    return measured.select(
        *own, *BASE,
        _share(1000, "n_symbols", "word_chars").alias("symbol_share"),
        _share(1000, "n_dup_lines", "_q_n_lines").alias("dup_line_share"),
        _share(1000, "n_repeat_words", "n_words").alias("repeat_share"),
        _share(100, "word_chars", "n_words").alias("word_length"),
    )


def _share(scale: int, part: str, whole: str) -> Column:
    """Whole-number share, zero where there is nothing to divide by."""
    return F.expr(f"case when {whole} > 0 then ({part} * {scale}) div {whole} else 0l end")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def sketch(measured: DataFrame, keys: list[str]) -> DataFrame:
    """Histogram cells per group and measure: keys, measure, cell, n. Mergeable by adding n.

    A null key stands for empty text.
    """
    long = measured.select(
        *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys],
        F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in SHARES])).alias("m"),
    )
    cell = F.expr(f"(m.value >> greatest(0, length(bin(m.value)) - {CELL_BITS}))"
                  f" << greatest(0, length(bin(m.value)) - {CELL_BITS})")
    return long.groupBy(*keys, F.col("m.measure").alias("measure"), cell.alias("cell")).agg(F.count("*").alias("n"))


def merge(cells: DataFrame, keys: list[str]) -> DataFrame:
    return cells.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))


def quartiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and measure: total, and the cells that hold the lower and the upper quartile."""
    group = Window.partitionBy(*keys, "measure")
    running = F.sum("n").over(group.orderBy("cell"))
    ranked = cells.select("*", running.alias("upto"), F.sum("n").over(group).alias("total"))
    return ranked.groupBy(*keys, "measure").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("cell"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("cell"))).alias("q3"),
    )


def thresholds(measured: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """One row per (lang, source): the cutoffs `hi_<measure>`, and `lo_word_length`."""
    keys = ["lang", "source"]
    fine = settle(sketch(measured, keys), "sketch")
    by_lang = merge(fine, ["lang"])
    levels = [
        quartiles(fine, keys),
        quartiles(by_lang, ["lang"]).select("lang", "measure", F.col("q1").alias("q1_l"), F.col("q3").alias("q3_l"),
                                            F.col("total").alias("total_l")),
        quartiles(merge(by_lang, []), []).select("measure", F.col("q1").alias("q1_a"), F.col("q3").alias("q3_a")),
    ]
    own = F.col("total") >= fences.min_rows
    lang = F.col("total_l") >= fences.min_rows
    pick = lambda q: F.when(own, F.col(q)).when(lang, F.col(f"{q}_l")).otherwise(F.col(f"{q}_a"))
    # The coarsest level has one row per measure.
    joined = levels[0].join(levels[1], ["lang", "measure"]).join(F.broadcast(levels[2]), "measure")
    margin = F.coalesce(*[F.when(F.col("measure") == m, F.lit(getattr(fences, m))) for m in SHARES])
    reach = F.greatest(fences.reach * (F.col("q3") - F.col("q1")), margin)
    cut = joined.select(*keys, "measure", pick("q1").alias("q1"), pick("q3").alias("q3"))
    cut = cut.select(*keys, "measure", (F.col("q3") + reach).alias("hi"), (F.col("q1") - reach).alias("lo"))
    of = lambda m, side: F.max(F.when(F.col("measure") == m, F.col(side)))
    return cut.groupBy(*keys).agg(
        *[of(m, "hi").alias(f"hi_{m}") for m in SHARES], of("word_length", "lo").alias("lo_word_length")
    )


def judge(measured: DataFrame, fences: Fences = Fences(), broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """`measured` plus base_failed and kept. Scanned twice, so pass a written table.

    Few groups are broadcast, their number being checked; more are joined by shuffle, where each row of a group
    draws one of `SALTS` copies of its cutoffs, so that a group with a third of all rows is spread.
    """
    names = ["lang", "source"]
    cuts = settle(thresholds(measured, fences), "cutoffs")
    few = cuts.count() <= broadcast_groups
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_q_{c}") for c in names]
    cuts = cuts.select(*[F.col(c).alias(f"_q_{c}") for c in names],
                       *[F.col(c).alias(f"_q_{c}") for c in cuts.columns if c not in names])
    left = measured.select("*", *keys)
    on = [f"_q_{c}" for c in names]
    if few:
        joined = left.join(F.broadcast(cuts), on, "left")
    else:
        left = left.withColumn("_q_salt", F.pmod(F.xxhash64("doc_id", "word_chars", "n_words"), F.lit(SALTS)))
        cuts = cuts.withColumn("_q_salt", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(SALTS)])))
        joined = left.join(cuts, [*on, "_q_salt"], "left")
    within = F.lit(True)
    for m in SHARES:
        within &= F.col(m) <= F.col(f"_q_hi_{m}")
    within &= F.col("word_length") >= F.col("_q_lo_word_length")
    own = [F.col(f"`{c.replace('`', '``')}`") for c in measured.columns]
    return joined.select(
        *own, base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(within, F.lit(False))).alias("kept"),
    )


def adaptive_rules(docs: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """doc_id, lang, source, counts, shares, base_failed and kept for each document.

    Nulls: text counts as empty, language and source as empty text. Empty tables give an empty result; repeated
    rows are judged alike, each on its own.
    """
    narrow = settle(with_measures(docs.select("doc_id", "lang", "source", "text")).drop("text"), "measures")
    return judge(narrow, fences)


def keep_good(docs: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """The documents that pass, with the columns they came with, whatever their names."""
    names = docs.columns
    hidden = {c: f"_own_{i}" for i, c in enumerate(names) if c not in ("doc_id", "text", "lang", "source")}
    held = docs.select(*[F.col(f"`{c.replace('`', '``')}`").alias(hidden.get(c, c)) for c in names])
    judged = judge(settle(with_measures(held), "measured"), fences)
    return judged.where("kept").select(
        *[F.col(f"`{hidden.get(c, c).replace('`', '``')}`").alias(c) for c in names])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_rules(documents(spark, sf_dir)).select("doc_id", *BASE, "base_failed", "kept")

"""Quality rules with risk-controlled thresholds.

Each rule is a ratio of a document, and each stratum (language) gets one set of rules with a cutoff
each, from a grid. It is found on the labelled documents that pass the base rules, in two steps.

The bad documents alone order the tries: the rule that catches the most of those still uncaught comes
next, from its loosest cutoff on, and each cutoff that catches more is a step; a rule must catch
more than the risk allows for good ones, by an exact binomial test (Bonferroni's correction over
strata and rules). So the sequence of rule sets does not depend on the good documents.

The good documents then certify steps. A step's p-value is the chance of so few good documents
rejected by the whole set, were their true share as high as ``risk`` (an exact binomial tail). The
steps are tested in order, each only if all before it held, so the sequence needs no correction;
Holm's step-down corrects over the strata: one whose whole sequence holds leaves its share of the
error to the others. The last certified step's set holds. So, with the chosen probability, no
stratum loses more than ``risk`` of its good documents to all rules together.

The labelled holdout is aggregated by stratum and cutoffs before anything is decided. Defined
cases: NULL and wordless texts have 0 words and fail the base rule; a NULL stratum is a stratum like
any other; strata without labels keep whatever passes the base rules; labels other than 0 and 1 are
not used, a document with two labels counts under each; repeated rows get equal verdicts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, staged, utf8

#: Symbols, and the white space between words (both fixed).
SYMBOLS, WHITE = b"#*$%&|<>", b" \t\n\r\x0b\x0c"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Each rule's cutoffs, loosest first; a document fails a rule above its cutoff.
GRID = [round(x, 6) for x in np.geomspace(1.0, 0.01, 24)]
RISK, CONFIDENCE = 0.02, 0.05


def counts(text: bytes) -> tuple[int, ...]:
    """Words, code points in words, symbols, repeated lines, words in repeated 3-word windows, and
    lines with a word."""
    words = text.split()  # bytes: the six ASCII white-space characters
    n = len(words)
    if not n:
        return 0, 0, len(text) - len(text.translate(None, SYMBOLS)), 0, 0, 0
    # every byte but those that continue a code point, and the white space
    chars = len(text.translate(None, WHITE + bytes(range(0x80, 0xC0))))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeat = 0
    if n >= 3:
        number: dict[bytes, int] = {}
        code = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype="int64", count=n)
        k = len(number)
        pair = np.unique(code[:-1] * k + code[1:], return_inverse=True)[1]
        _, window, times = np.unique(pair[:-1] * k + code[2:], return_inverse=True, return_counts=True)
        at = np.flatnonzero(times[window] > 1)
        if len(at):
            covered = np.zeros(n, dtype=bool)
            covered[at] = covered[at + 1] = covered[at + 2] = True
            repeat = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeat, len(lines)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the ``COUNTS`` of each whole text."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = [counts(x) for x in utf8(batch, text)]
        return [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))]

    return add_columns(docs, [T.StructField(n, T.LongType()) for n in COUNTS], run)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """The ratios that are judged: high is bad."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
        "long_words": F.greatest(F.col("word_chars") / words - 10, F.lit(0)) / 20,
    }


def tail(rejected: int, good: int, risk: float) -> float:
    """P(X <= rejected) of a binomial with ``good`` trials of probability ``risk``, exactly summed."""
    if rejected >= good:
        return 1.0
    total, log_p, log_q = 0.0, math.log(risk), math.log1p(-risk)
    for i in range(rejected + 1):
        total += math.exp(math.lgamma(good + 1) - math.lgamma(i + 1) - math.lgamma(good - i + 1) + i * log_p + (good - i) * log_q)
        if i > good * risk and total > 0.5:
            return total  # above any level that is asked for
    return min(total, 1.0)


def upper_tail(rejected: int, bad: int, risk: float) -> float:
    """P(X >= rejected) of a binomial with ``bad`` trials of probability ``risk``, exactly summed."""
    total, log_p, log_q = 0.0, math.log(risk), math.log1p(-risk)
    for i in range(rejected, bad + 1):
        term = math.exp(math.lgamma(bad + 1) - math.lgamma(i + 1) - math.lgamma(bad - i + 1) + i * log_p + (bad - i) * log_q)
        total += term
        if i > bad * risk and term < 1e-18 * max(total, 1e-300):
            break  # the terms fall from here on
    return min(total, 1.0)


def thresholds(measured: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", label: str = "quality",
               risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """(stratum, rule, cutoff, good, good_rejected, bad, bad_rejected) of each certified rule."""
    known = labels.select(F.col(doc_id).alias("_of"), F.col(label).cast("int").alias("_label")).where("_label IN (0, 1)")
    judged = rules()
    passing = measured.where(~base_failed()).select(
        F.col(doc_id).alias("_id"), F.col(stratum).cast("string").alias("stratum"), *[c.alias(n) for n, c in judged.items()])
    grid = F.array(*[F.lit(float(x)) for x in GRID])
    # how many cutoffs of the grid the document fails by each rule, counted from the strictest
    above = [F.size(F.filter(grid, lambda c: F.col(n) > c)) for n in judged]
    held = passing.join(known, F.col("_id") == F.col("_of")).select("stratum", "_label", F.array(*above).alias("above"))
    cells = held.groupBy("stratum", "above").agg(
        F.count_if(F.col("_label") == 1).alias("good"), F.count_if(F.col("_label") == 0).alias("bad"))
    return certified(cells, list(judged), risk, confidence)


def steps(above: np.ndarray, bad: np.ndarray, risk: float, level: float) -> list[tuple[int, int, np.ndarray]]:
    """(rule, place of its cutoff, cells rejected by the set so far), by the bad documents of the cells."""
    n, total = len(GRID), int(bad.sum())
    rejected, left, out = np.zeros(len(bad), bool), list(range(above.shape[1])), []
    while left:
        gains = [int(bad[(above[:, r] > 0) & ~rejected].sum()) for r in left]
        rule, before = left.pop(int(np.argmax(gains))), int(bad[rejected].sum())
        last, base = before, rejected
        for i in range(n):  # the loosest first: above GRID[i] are those that fail n - i cutoffs or more
            now = base | (above[:, rule] >= n - i)
            caught = int(bad[now].sum())
            if caught > last and upper_tail(caught - before, total, risk) <= level:
                out.append((rule, i, now))
                last, rejected = caught, now
    return out


def certified(cells: DataFrame, names: list[str], risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """(stratum, rule, cutoff, good, good_rejected, bad, bad_rejected) of the rule sets that hold, the
    counts being those of the whole set; from (stratum, above, good, bad): the labelled documents
    that fail ``above`` cutoffs of each rule."""
    strata = max(1, cells.select("stratum").distinct().count())
    columns = ["stratum", "step", "cutoffs", "good", "good_rejected", "bad", "bad_rejected", "p"]

    def tested(rows: pd.DataFrame) -> pd.DataFrame:
        above, good, bad = np.array(rows["above"].tolist()), rows["good"].to_numpy(), rows["bad"].to_numpy()
        cutoffs, out, p = [None] * len(names), [], 0.0
        for step, (rule, i, rejected) in enumerate(steps(above, bad, risk, confidence / (len(names) * strata))):
            cutoffs = [GRID[i] if r == rule else c for r, c in enumerate(cutoffs)]
            lost = int(good[rejected].sum())
            p = max(p, tail(lost, int(good.sum()), risk))  # a step holds if all before it do
            out.append((rows["stratum"].iloc[0], step, cutoffs, int(good.sum()), lost, int(bad.sum()), int(bad[rejected].sum()), p))
        return pd.DataFrame(out, columns=columns)

    found = staged(cells.groupBy("stratum").applyInPandas(
        tested, "stratum string, step int, cutoffs array<double>, good long, good_rejected long, bad long, bad_rejected long, "
                "p double"), "quality-tests")
    # Holm over the strata: one row each, in one task
    whole = found.groupBy("stratum").agg(F.max("p").alias("p_whole"))
    in_order, every = Window.orderBy("p_whole", "stratum"), Window.partitionBy(F.lit(0))
    left = F.count(F.lit(1)).over(every) - F.row_number().over(in_order) + 1
    ranked = whole.withColumn("holds", F.col("p_whole") <= F.lit(confidence) / left)
    ranked = ranked.withColumn("done", F.min("holds").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    open_ones = F.count_if(~F.col("done")).over(every)
    levels = ranked.select(F.col("stratum").alias("_stratum"), F.when(F.col("done"), F.lit(1.0)).otherwise(
        F.lit(confidence) / F.greatest(open_ones, F.lit(1))).alias("level"))
    held = found.join(levels, F.col("stratum").eqNullSafe(F.col("_stratum"))).where(F.col("p") <= F.col("level"))
    last = held.groupBy("stratum").agg(F.max_by(F.struct(*columns[2:7]), "step").alias("x")).select("stratum", "x.*")
    rules_of = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("rule"), F.col("cutoffs").alias("cutoff"))
    return last.select("stratum", F.inline(rules_of).alias("rule", "cutoff"), *columns[3:7]).where("cutoff IS NOT NULL")


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", doc_id: str = "doc_id",
          label: str = "quality", risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """(doc_id, stratum, COUNTS..., base_failed, failed, kept): ``failed`` lists the rules broken."""
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), F.col(text).cast("string").alias("text"))
    measured = staged(with_counts(narrow, "text").drop("text"), "quality-counts")
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias(label))
    chosen = thresholds(measured, known, "stratum", "doc_id", label, risk, confidence)
    limits = chosen.groupBy("stratum").pivot("rule", list(rules())).agg(F.first("cutoff"))
    limits = staged(limits.withColumnsRenamed({n: f"limit_{n}" for n in rules()}), "quality-limits")
    limits = limits.withColumnRenamed("stratum", "_stratum")
    joined = measured.join(limits, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    broken = F.array_compact(F.array(*[
        F.when(c > F.col(f"limit_{n}"), F.lit(n)) for n, c in rules().items()]))
    out = joined.withColumn("base_failed", base_failed()).withColumn("failed", broken)
    return out.select(
        "doc_id", "stratum", *COUNTS, "base_failed", "failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"))

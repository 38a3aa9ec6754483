"""Quality rules: a short-circuit cascade, cheap and selective rules first.

Method: each rule's cost and selectivity are estimated on a bounded sample, the
rules are ordered by rejections per second, and one CASE expression tries them
in that order and stops at the first that rejects.  The order changes the time
only, never the verdict.  DataFrame functions only; no shuffle.

Defined cases: a null text has no words and no characters.  Words are separated
by ASCII white space, so a text of separators only has none.  Repeated rows and
null ids are judged row by row.  An empty table gives an empty result (the order
is then the given one).  Other columns pass through, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tessera.llm.common import c, fresh, written

WINDOW = 8
#: Rows, about, of the sample that orders the rules; tasks that hold it; times a rule is timed.
SAMPLE_ROWS, SAMPLE_TASKS, RUNS = 1000, 8, 3


@dataclass(frozen=True)
class Feature:
    """A column made from the columns named by ``col(feature)``; ``text`` is the document's text."""

    name: str
    needs: tuple[str, ...]
    make: Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a row to reject; ``needs`` names the features it reads."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Callable[[str], Column]], Column]


def _body(col) -> Column:
    return F.coalesce(col("text"), F.lit(""))


def _lines(col) -> Column:
    return F.filter(F.split(_body(col), "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))


def _longs() -> Column:
    return F.array().cast("array<bigint>")


def _windows(col) -> Column:
    h = col("hashes")
    starts = F.when(F.size(h) > WINDOW, F.sequence(F.lit(1), F.size(h) - WINDOW + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, F.lit(WINDOW))))


def _placed(col) -> Column:
    """(hash, position) of all windows in order, empty when no window repeats."""
    win = col("windows")
    repeats = F.size(F.array_distinct(win)) < F.size(win)
    pairs = F.array_sort(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    return F.when(repeats, pairs).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))


def _after(x: Column) -> Column:
    """The array without its first element."""
    return F.slice(x, 2, F.greatest(F.size(x), F.lit(1)))


def _repeated_at(col) -> Column:
    """Positions of the windows found twice or more: equal neighbours in ``placed``."""
    placed = col("placed")
    none = F.array(F.lit(None).cast("struct<h:bigint,p:int>"))
    back = F.zip_with(placed, F.concat(none, placed), lambda x, y: F.struct(x.alias("x"), x["h"].eqNullSafe(y["h"]).alias("same")))
    both = F.zip_with(back, _after(placed), lambda b, y: F.when(b["x"].isNotNull() & (b["same"] | b["x"]["h"].eqNullSafe(y["h"])), b["x"]["p"]))
    return F.array_sort(F.array_compact(both))


def _covered(col) -> Column:
    """Words under the repeated windows: each window adds its words up to the next one's start."""
    at = col("repeated_at")
    steps = F.zip_with(at, _after(at), lambda x, y: F.coalesce(F.least(y - x, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x).cast("long")


#: In order of need.  A window is told by the 64-bit hash of its words' 64-bit
#: hashes; two windows of one text are mistaken for equal with probability
#: windows^2 / 2^65.
FEATURES = {
    f.name: f
    for f in (
        Feature("words", ("text",), lambda col: F.array_remove(F.split(_body(col), "[\\x20\\x09-\\x0D]+", -1), "")),
        Feature("n_words", ("words",), lambda col: F.size(col("words")).cast("long")),
        Feature("word_chars", ("words",), lambda col: F.char_length(F.array_join(col("words"), "")).cast("long")),
        Feature("n_symbols", ("text",), lambda col: F.regexp_count(_body(col), F.lit("[#*$%&|<>]")).cast("long")),
        Feature("lines", ("text",), _lines),
        Feature("n_lines", ("lines",), lambda col: F.size(col("lines")).cast("long")),
        Feature("n_dup_lines", ("lines",), lambda col: (F.size(col("lines")) - F.size(F.array_distinct(col("lines")))).cast("long")),
        Feature("hashes", ("words",), lambda col: F.when(F.size(col("words")) > WINDOW, F.transform(col("words"), lambda w: F.xxhash64(w))).otherwise(_longs())),
        Feature("windows", ("hashes",), _windows),
        Feature("placed", ("windows",), _placed),
        Feature("repeated_at", ("placed",), _repeated_at),
        Feature("n_repeat_words", ("repeated_at",), _covered),
    )
}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: The thresholds are the published ones of web-text filters: 20 words at least,
#: a mean word of 3 to 10 characters (15 here: compounds of some languages),
#: a symbol on one word in ten, 30 % of the lines or of the words repeated (and
#: five repeated lines at least: one in three lines is no evidence in a short text).
RULES = (
    Rule("few_words", ("n_words",), lambda col: col("n_words") < 20),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda col: 100 * col("n_repeat_words") > 30 * col("n_words")),
    Rule("word_length", ("n_words", "word_chars"), lambda col: (col("word_chars") < 3 * col("n_words")) | (col("word_chars") > 15 * col("n_words"))),
    Rule("symbols", ("n_words", "n_symbols"), lambda col: 10 * col("n_symbols") > col("n_words")),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda col: (col("n_dup_lines") >= 5) & (10 * col("n_dup_lines") > 3 * col("n_lines"))),
)


def base_failed(col: dict[str, Column]) -> Column:
    """The two base rules on computed features."""
    return (col["n_words"] < 20) | (100 * col["n_repeat_words"] > 30 * col["n_words"])


class _Build:
    """Adds features and a verdict to a frame, under names that it doesn't have yet."""

    def __init__(self, docs: DataFrame, text: str):
        self.df, self.names = docs, {"text": text}

    def col(self, name: str) -> Column:
        return c(self.names[name])

    def add(self, name: str, value: Column) -> None:
        self.names[name] = fresh(self.df, name)
        self.df = self.df.withColumn(self.names[name], value)

    def feature(self, name: str, only_if: Column | None = None) -> None:
        if name in self.names:
            return
        f = FEATURES[name]
        for x in f.needs:
            self.feature(x, only_if)
        value = f.make(self.col)
        self.add(name, value if only_if is None else F.when(only_if, value))


def rule_order(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """The rules by rejections per second, estimated on a seeded sample of about
    ``sample_rows`` rows of the whole table, with their whole texts.

    The sample is written, not collected.  Each rule is run alone over it, its
    features included; its cost is the least time of ``RUNS`` runs less that of a
    rule that only reads the texts, so that starting a job costs nothing.  Ties keep
    the given order.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))
    some = docs.select(c(text).alias("text")).sample(False, share, 42)
    sample = written(some.repartition(SAMPLE_TASKS), "rule-sample")

    def least(rejects: Column, df: DataFrame) -> tuple[float, Row]:
        asked, times = df.select(F.count("*").alias("n"), F.count_if(rejects).alias("rejected")), []
        for _ in range(RUNS):
            t = time.perf_counter()
            row = asked.first()
            times.append(time.perf_counter() - t)
        return min(times), row

    idle, _ = least(F.char_length("text") < 0, sample)
    out = []
    for k, rule in enumerate(rules):
        b = _Build(sample, "text")
        for x in rule.needs:
            b.feature(x)
        took, row = least(rule.rejects(b.col), b.df)
        cost = max(took - idle, 1e-4)
        share = row["rejected"] / row["n"] if row["n"] else 0.0
        out.append({"rule": rule, "selectivity": share, "cost": cost, "rank": share / cost, "given": k})
    return sorted(out, key=lambda x: (-x["rank"], x["given"]))


def apply_rules(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, features: tuple[str, ...] = (), sample_rows: int = SAMPLE_ROWS
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the first rule that rejects each row (null: kept).

    ``features`` are computed for every row; all others only for rows that reach
    a rule that needs them.  Returns the frame and the added columns by feature,
    with ``rejected_by``.
    """
    order = [x["rule"] for x in rule_order(docs, text, rules, sample_rows)]
    b = _Build(docs, text)
    for x in features:
        b.feature(x)
    for k, rule in enumerate(order):
        alive = b.col("rejected_by").isNull() if k else None
        for x in rule.needs:
            b.feature(x, alive)
        hit = F.when(rule.rejects(b.col), F.lit(rule.name))
        b.add("rejected_by", hit if alive is None else F.coalesce(b.col("rejected_by"), hit))
    if not order:
        b.add("rejected_by", F.lit(None).cast("string"))
    # A filter on the verdict stops at this generator of one row.  Pushed further
    # down, it would hold a copy of each feature's expression at each use.
    verdict = fresh(b.df, "verdict")
    out = b.df.select("*", F.explode(F.array(b.col("rejected_by"))).alias(verdict)).drop(b.names["rejected_by"])
    return out, {**b.names, "rejected_by": verdict}


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with the columns of ``docs``."""
    out, names = apply_rules(docs, text)
    return out.where(c(names["rejected_by"]).isNull()).select(*[c(x) for x in docs.columns])

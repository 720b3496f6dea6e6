"""How quality filters interact: what each removes in every order, alone, after others, and on average (Shapley).

One scan gives each row the set of filters that it fails; rows are counted by part and set, so 32 numbers a part hold
everything. What a coalition of filters removes is a sum of them, each step of each order is a difference of two
coalitions, and Shapley values come from the kernel-weighted least squares problem under the efficiency constraint,
solved exactly in rationals.

Defined results: a null text is empty, a null part is the empty string. Rows without doc_id repeat no other row, and no
row repeats them, and they have no labels; rows that share text and doc_id do not repeat each other. A row is good or toxic if any of its labels
says so. Texts of any length are judged whole. Other columns play no part, whatever their names. An empty table gives
no rows.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

FILTERS = "ABCDE"
N_SETS = 1 << len(FILTERS)
COUNTS = ("n", "good", "toxic")


def solve(a: list[list], b: list[list]) -> list[list[Fraction]]:
    """x with a x = b in rationals, by elimination; b may have many columns."""
    m = [[Fraction(v) for v in (*r, *s)] for r, s in zip(a, b, strict=True)]
    for i in range(len(m)):
        p = next(k for k in range(i, len(m)) if m[k][i])
        m[i], m[p] = m[p], m[i]
        m[i] = [v / m[i][i] for v in m[i]]
        for k in range(len(m)):
            if k != i and m[k][i]:
                m[k] = [v - m[k][i] * w for v, w in zip(m[k], m[i], strict=True)]
    return [r[len(a) :] for r in m]


def shapley_weights(players: int) -> list[list[Fraction]]:
    """w[i][s]: share of coalition s's value (s as bits) in player i's Shapley value.

    Least squares over the proper coalitions, min sum k(s) (v(s) - v(0) - sum of x over s)^2, with the kernel
    k(s) = (p - 1) / (C(p, |s|) |s| (p - |s|)) and the constraint that all x add up to v(all) - v(0): the normal
    equations, bordered by the constraint, are solved for every coalition's unit value at once.
    """
    p, full = players, (1 << players) - 1
    kernel = {s: Fraction(p - 1, comb(p, s.bit_count()) * s.bit_count() * (p - s.bit_count())) for s in range(1, full)}
    has = lambda s, i: s >> i & 1
    left = [[sum(k for s, k in kernel.items() if has(s, i) and has(s, j)) for j in range(p)] + [1] for i in range(p)] + [[1] * p + [0]]
    right = [[(kernel[s] * has(s, i) if 0 < s < full else 0) - (sum(k for t, k in kernel.items() if has(t, i)) if s == 0 else 0) for s in range(full + 1)] for i in range(p)]
    right.append([-1 if s == 0 else int(s == full) for s in range(full + 1)])
    return solve(left, right)[:p]


def failures(text: Column) -> Column:
    """Bits 0 to 3: fails A (few words), B (repeated words), C (capitals), D (symbols)."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    tests = (n < 100, 100 * distinct < 80 * n, 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text), text.rlike("[#$%&*|]"))
    return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))


def failed_sets(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, failed, n, good, toxic): rows by the set of filters they fail, as bits.

    Rows are counted by (doc_id, text digest, part) before they are shuffled. A row repeats an earlier one unless its
    doc_id is the smallest of its text: that pair is looked up, so all copies of a hot text spread by their doc_id.
    """
    text = F.coalesce("text", F.lit(""))
    judged = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), failures(text).alias("failed"))
    rows = settle(judged.groupBy("doc_id", "digest", "part", "failed").agg(F.count("*").alias("n")), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(1))
    marks = labels.groupBy("doc_id").agg(*(F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(out) for c, out in (("quality", "is_good"), ("toxic", "is_toxic"))))
    both = rows.join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    repeats = F.when(F.col("is_first").isNull() & F.col("doc_id").isNotNull(), 1 << FILTERS.index("E")).otherwise(0)
    marked = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0))
    return both.groupBy("part", (F.col("failed") + repeats).alias("failed")).agg(F.sum("n").alias("n"), marked("is_good").alias("good"), marked("is_toxic").alias("toxic"))


def coalitions(sets: DataFrame) -> DataFrame:
    """(part, total, n, good, toxic): for each part an array of 32, what each coalition of filters removes, by its bits."""
    hit = lambda s: F.col("failed").bitwiseAND(F.lit(s)) != 0
    removed = [F.array(*(F.sum(F.when(hit(s), F.col(c)).otherwise(0)) for s in range(N_SETS))).alias(c) for c in COUNTS]
    return sets.groupBy("part").agg(F.sum("n").alias("total"), *removed)


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Per part, order of the five filters and step: what the step's filter removes there, and its Shapley value times 120."""
    orders = factorial(len(FILTERS))
    weights = [[w * orders for w in row] for row in shapley_weights(len(FILTERS))]
    if any(w.denominator != 1 for row in weights for w in row):
        raise ArithmeticError("the weights of all orders are whole numbers")
    shares = F.array(*(sum((int(w) * F.element_at("n", s + 1) for s, w in enumerate(row) if w), F.lit(0)).cast("long") for row in weights))
    parts = coalitions(failed_sets(docs, labels, part)).withColumn("shares", shares)
    steps = parts.withColumn("filter_order", F.explode(F.array(*(F.lit("".join(o)) for o in permutations(FILTERS))))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    # the coalitions before and with the step's filter
    bits = lambda letters: sum((F.when(F.instr(letters, x) > 0, 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))
    own = F.expr("substring(filter_order, step, 1)")
    steps = steps.withColumn("was", bits(F.expr("substring(filter_order, 1, step - 1)"))).withColumn("own", bits(own))
    at = lambda c, s: F.element_at(c, s + 1)
    gone = lambda c: at(c, F.col("was") + F.col("own")) - at(c, F.col("was"))
    everything = F.lit(N_SETS - 1)
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - at("n", F.col("was") + F.col("own"))).alias("kept"), gone("n").alias("removed"), (at("n", F.col("own")) - gone("n")).alias("redundant"),
        (at("n", everything) - at("n", everything - F.col("own"))).alias("unique_fails"), gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"), F.element_at("shares", F.instr(F.lit(FILTERS), own)).alias("shapley"),
    )

"""Quality rules as a decision list, learned by sequential covering from labelled statistics.

Statistics, learning and verdict are DataFrame operations. Labelled rows are
reduced to bins of each statistic; one aggregation per step counts good and bad
rows by statistic and bin, which is all that growing a rule by its best
threshold needs (FOIL gain, on two thirds of the rows). The last conditions of a
grown rule are pruned as long as that helps on the other third (Cohen's RIPPER,
1995). A rule that is not precise there is dropped, and the search goes on from another first condition.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanshift.llm.text import SPACE_CLASS, fresh, word_array
from loanshift.session import discard, materialize

#: Fixed values of the base rules.
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: Quantiles of a statistic between which thresholds lie.
QUANTILES = 64
MAX_CONDITIONS = 4
#: Share of bad rows among those a rule covers in the pruning part, below which it is dropped; bad rows it must cover there.
PRECISION, LEAST_COVERED = 0.95, 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = {
    "symbol_share": ("n_symbols", "word_chars"), "upper_share": ("n_upper", "word_chars"), "mark_share": ("n_marks", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"), "word_length": ("word_chars", "n_words"),
}
STATISTICS = [*RATIOS, "n_words"]


@dataclass(frozen=True)
class Condition:
    """``statistic >= threshold``, or ``<`` it."""

    statistic: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column) -> Column:
    """Words that lie in three-word windows found twice or more."""
    windows = F.when(
        F.size(words) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])),
    ).otherwise(F.array().cast("array<bigint>"))

    def among(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(pairs: Column) -> Column:
            def again(pair: Column, k: Column) -> Column:
                before = F.when(k > 0, F.get(pairs, k - 1)["h"] == pair["h"])
                after = F.get(pairs, k + 1)["h"] == pair["h"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            return F.array_sort(F.transform(F.filter(pairs, again), lambda p: p["i"]))

        def reach(state: Column, start: Column) -> Column:
            new = F.least(F.lit(3), start + 3 - state["end"])
            return F.struct((start + 3).alias("end"), (state["n"] + new).alias("n"))

        first = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        covered = F.aggregate(_let(ordered, starts), first, reach, lambda state: state["n"])
        # Most texts repeat no window; only the others are sorted.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)

    return _let(windows, among)


def statistics(text: Column) -> Column:
    """A struct of counts (long) of one text; null text counts as empty."""
    whole = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct"),
            _repeated(words).cast("bigint").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        )

    def count(pattern: str) -> Column:
        return F.regexp_count(whole, F.lit(pattern)).cast("bigint")

    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(SPACE_CLASS.replace("[", "[^")))
    counts = F.struct(
        count(r"[#*$%&|<>]").alias("n_symbols"), count("[A-Z]").alias("n_upper"), count("[.,;:!?]").alias("n_marks")
    )
    return F.struct(_let(word_array(whole), of_words).alias("w"), _let(lines, of_lines).alias("l"), counts.alias("c"))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs (text)``, the counts, ``base_failed`` and the statistics the rules use."""
    held, *kept = fresh(["text"], "stats", *keep)
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept)], statistics(F.col("text")).alias(held))
    names = {"w": ["n_words", "word_chars", "n_distinct", "n_repeat_words"], "l": ["n_lines", "n_dup_lines"], "c": ["n_symbols", "n_upper", "n_marks"]}
    counts = [F.col(f"{held}.{part}.{name}").alias(name) for part, each in names.items() for name in each]
    rows = rows.select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], *counts)
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    shares = {name: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)) for name, (a, b) in RATIOS.items()}
    return rows.withColumns({"base_failed": (F.col("n_words") < MIN_WORDS) | repeated, **shares})


def _counts(rows: DataFrame, tests: dict[str, Column]) -> dict[str, tuple[int, int]]:
    """Per test the bad and good rows it holds for."""
    sums = [F.count(F.when(t & (F.col("bad") == b), True)).alias(f"{k}{b}") for k, t in tests.items() for b in (1, 0)]
    found = rows.agg(*sums).first()
    return {k: (found[f"{k}1"], found[f"{k}0"]) for k in tests}


def _all(rule: Rule) -> Column:
    holds = F.lit(True)
    for condition in rule:
        holds = holds & condition.column()
    return holds


Tally = tuple[int, int]


def _tallies(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[dict[Condition, dict[bool, Tally]], dict[bool, Tally]]:
    """Bad and good rows of every single condition by pruning part, and of the parts: one job, and a bounded answer.

    Each statistic's bins are counted on their own, which reads one column and makes no row longer.
    """
    sums = [F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")]
    each = [rows.groupBy(F.lit(s).alias("s"), F.col(f"bin_{s}").alias("b"), "pruning").agg(*sums) for s in cuts]
    found = reduce(DataFrame.unionByName, each).collect()

    def count(statistic: str, part: bool, least: int) -> Tally:
        own = [r for r in found if r["s"] == statistic and r["pruning"] == part and r["b"] >= least]
        return sum(r["p"] for r in own), sum(r["n"] for r in own)

    whole = {part: count(STATISTICS[0], part, 0) for part in (False, True)}
    tallies: dict[Condition, dict[bool, Tally]] = {}
    for statistic, thresholds in cuts.items():
        for k, threshold in enumerate(thresholds, start=1):
            high = {part: count(statistic, part, k) for part in whole}
            tallies[Condition(statistic, True, threshold)] = high
            tallies[Condition(statistic, False, threshold)] = {part: (whole[part][0] - p, whole[part][1] - n) for part, (p, n) in high.items()}
    return tallies, whole


def _precise(counts: Tally) -> bool:
    bad, good = counts
    return bad >= LEAST_COVERED and bad >= PRECISION * (bad + good)


def _gain(before: Tally, after: Tally) -> float:
    (p0, n0), (p1, n1) = before, after
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else 0.0


def _grow(rows: DataFrame, cuts: dict[str, list[float]], barred: set[tuple[str, bool]], alone: tuple) -> Rule:
    """Conditions added by the best FOIL gain until no good row is left or nothing is gained.

    ``alone`` are the tallies of all ``rows``; ``barred`` statistics and directions cannot come first.
    """
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        tallies, whole = _tallies(rows.where(_all(rule)), cuts) if rule else alone
        before = whole[False]
        if not all(before):
            return rule
        allowed = [c for c in tallies if rule or (c.statistic, c.at_least) not in barred]
        best = max(allowed, key=lambda c: _gain(before, tallies[c][False]), default=None)
        if best is None or _gain(before, tallies[best][False]) <= 1e-9:
            return rule
        rule = (*rule, best)
    return rule


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Per statistic the places halfway between neighbouring quantiles, of all rows and of the bad ones alone.

    So tails are cut as finely as the middle, and a gap between good and bad is
    parted in its middle.
    """
    at = [k / QUANTILES for k in range(QUANTILES + 1)]
    bad = {s: F.percentile_approx(F.when(F.col("bad") == 1, F.col(s)), at, 100_000).alias(f"bad_{s}") for s in STATISTICS}
    found = rows.agg(*[F.percentile_approx(s, at, 100_000).alias(s) for s in STATISTICS], *bad.values()).first()
    values = {s: [sorted(set(found[c] or [])) for c in (s, f"bad_{s}")] for s in STATISTICS}
    near = {s: {(a + b) / 2 for own in both for a, b in zip(own, own[1:])} for s, both in values.items()}
    # The outermost bad values are parted from what lies past them too.
    for s, (every, own) in values.items():
        past = [*[v for v in every if own and v < own[0]][-1:], *own[:1]], [*own[-1:], *[v for v in every if own and v > own[-1]][:1]]
        near[s] |= {(a + b) / 2 for pair in past if len(pair) == 2 for a, b in [pair]}
    return {s: sorted(v) for s, v in near.items()}


def _binned(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    def bin_of(statistic: str) -> Column:
        thresholds = F.array(*[F.lit(float(t)) for t in cuts[statistic]]).cast("array<double>")
        return F.size(F.filter(thresholds, lambda t: t <= F.col(statistic))).alias(f"bin_{statistic}")

    return rows.select("bad", "pruning", *STATISTICS, *[bin_of(s) for s in STATISTICS])


def _next_rule(left: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """The next precise rule, or none: a rule that fails bars its first statistic and direction, and the search goes on.

    After the last failure single conditions are all tried, the one with the most bad rows first.
    """
    barred: set[tuple[str, bool]] = set()
    first = _tallies(left, cuts)
    while True:
        rule = _grow(left, cuts, barred, first)
        if not rule:
            break
        prefixes = {f"k{k}_": _all(rule[:k]) for k in range(1, len(rule) + 1)}
        counts = list(_counts(left.where("pruning"), prefixes).values())
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in counts]
        length = max(range(len(rule)), key=lambda k: (worth[k], -k)) + 1
        if _precise(counts[length - 1]):
            return rule[:length]
        barred.add((rule[0].statistic, rule[0].at_least))
    tallies, whole = first
    if not any(good for _, good in whole.values()):
        return ()
    alone = {c: t for c, t in tallies.items() if _precise(t[True]) and _precise(t[False])}
    best = max(alone, key=lambda c: (sum(alone[c][part][0] for part in alone[c]), -c.threshold), default=None)
    return (best,) if best else ()


def learn(rows: DataFrame) -> list[Rule]:
    """Rules for bad rows, in order, from ``rows``: an id ``doc_id``, ``bad`` (1 or 0) and the statistics.

    After every rule the rows it covers go, thresholds are cut anew over the
    rest, and the search ends when no rule is precise and covers enough on the
    pruning part. Without bad or good rows there is no rule. The search is
    bounded by ``QUANTILES`` places (of all and of bad rows) per statistic and
    ``MAX_CONDITIONS`` per rule, not by rows.
    """
    pruning = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0, F.lit(False))
    left = materialize(rows.select("bad", *STATISTICS, pruning.alias("pruning")))
    rules: list[Rule] = []
    while True:
        cuts = _thresholds(left)
        if not any(cuts.values()):
            break
        binned = materialize(_binned(left, cuts))
        rule = _next_rule(binned, cuts)
        if rule:
            following = materialize(left.where(~_all(rule)))
            discard(left)
            left = following
            rules.append(rule)
        discard(binned)
        if not rule:
            break
    discard(left)
    return rules


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``bad`` from ``labels (doc_id, quality)``; ids whose labels differ, and null labels, are left out."""
    good = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    single = good.agg(F.min("quality").alias("least"), F.max("quality").alias("most")).where("least = most")
    return rows.join(single.select("doc_id", (F.col("least") == 0).cast("int").alias("bad")), "doc_id")


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional expression: the number of the rule that rejects, else 0."""
    result = F.lit(0)
    for number, rule in reversed(list(enumerate(rules, start=1))):
        result = F.when(_all(rule), F.lit(number)).otherwise(result)
    return result


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, counts, base_failed, kept, rule)`` per row of ``docs (doc_id, text)``.

    Learned from every labelled document that passes the base rules. ``kept`` is
    false where a base rule or a learned rule rejects; ``rule`` numbers the
    latter. Null and empty texts fail the base rule on words. Without labels
    only base rules decide.
    """
    rows = materialize(measured(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), ["doc_id"]))
    rules = learn(labelled(rows.where("not base_failed"), labels))
    number = F.when(F.col("base_failed"), F.lit(0)).otherwise(verdict(rules))
    judged = rows.withColumn("rule", number)
    return judged.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns; cases as in ``judge``."""
    # Stored with their statistics, which are costly: once for learning and for the verdict.
    row, own = fresh(docs.columns, "row", "id")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.col("doc_id").cast("bigint").alias(own), F.col("text").alias("text"))
    stored = materialize(measured(whole, [row, own]))
    rules = learn(labelled(stored.where("not base_failed").select(F.col(own).alias("doc_id"), *STATISTICS), labels))
    return stored.where(~F.col("base_failed") & (verdict(rules) == 0)).select(f"{row}.*")

"""Quality rules as a learned decision list, on Spark's own functions.

1. Statistics of whole texts: words, characters, symbols, repeated lines and
   repeated five-word windows, by expressions alone; staged once.
2. Sequential covering on the labelled documents: a rule grows by the threshold
   condition of greatest information gain on the growing part (two thirds of
   the ids by hash), until it covers no good document or nothing is gained; it
   is then pruned to the prefix of conditions that does best on the pruning
   part, and kept if its precision there is ``precision`` or more.  The
   documents that it covers leave, and the next rule grows.  Each step is one
   aggregation over the staged statistics of all labelled documents; the
   driver sees counts per feature and threshold, never rows.
3. The list becomes one ordered conditional expression (CASE WHEN).

Defined cases: null or empty text, or text without words, has zero statistics
and fails the base rule; labels that are null or neither 0 nor 1 teach
nothing; repeated rows are rows of their own, and repeated labels of an id
count each; without labelled documents of both classes the list is empty and
keeps what passes the base rule; an empty table gives an empty result.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import text_of

SPACE = r"[\x20\x09-\x0D]"
WINDOW = 5

_SHARES = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.5, 2.0, 3.0)
#: Feature -> its value in terms of the statistics, and the thresholds a condition may use.
FEATURES: dict[str, tuple[str, tuple[float, ...]]] = {
    "words": ("n_words", (20, 50, 100, 200, 500, 1000, 2000, 5000, 10000)),
    "word_length": ("word_chars / n_words", (2, 2.5, 3, 3.5, 4, 4.5, 5, 5.5, 6, 6.5, 7, 8, 9, 10, 12, 15, 20)),
    "symbols_per_word": ("n_symbols / n_words", _SHARES),
    "shouts_per_word": ("n_shouts / n_words", _SHARES),
    "capital_share": ("n_capitals / word_chars", _SHARES),
    "digit_share": ("n_digits / word_chars", _SHARES),
    "stops_per_word": ("n_stops / n_words", _SHARES),
    "distinct_share": ("n_distinct / n_words", _SHARES),
    "dup_line_share": ("n_dup_lines / n_lines", _SHARES),
    "repeat_share": ("n_repeat_words / n_words", _SHARES),
}

Condition = tuple[str, str, float]  # feature, ">=" or "<", threshold
Rule = list[Condition]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of each whole text."""
    s = docs.select(docs[id_col].alias("doc_id"), text_of(docs[text_col]).alias("_t"))
    s = s.select(
        "doc_id", "_t",
        F.expr(rf"filter(split(_t, r'{SPACE}+'), w -> w <> '')").alias("_words"),
        F.expr(rf"filter(split(_t, '\n'), l -> l rlike r'[^\x20\x09-\x0D]')").alias("_lines"))
    s = s.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        *[F.regexp_count("_t", F.lit(chars)).cast("long").alias(name) for name, chars in (
            ("n_symbols", "[#*$%&|<>]"), ("n_shouts", "[!?]"), ("n_capitals", "[A-Z]"), ("n_digits", "[0-9]"),
            ("n_stops", "[.,;:]"))],
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        # a window is known by the 64-bit hash of its words
        F.expr(f"""slice(transform(_words, (w, i) -> xxhash64(w, {', '.join(
            f'get(_words, i + {k})' for k in range(1, WINDOW))})), 1, greatest(size(_words) - {WINDOW - 1}, 0))
            """).alias("_windows"))
    s = s.withColumn("_sorted", F.expr("""
        CASE WHEN size(array_distinct(_windows)) < size(_windows)
             THEN array_sort(transform(_windows, (h, i) -> struct(h AS h, i AS i)))
             ELSE slice(transform(_windows, (h, i) -> struct(h AS h, i AS i)), 1, 0) END""")).drop("_windows")
    # starts of windows that occur twice or more, in order; each adds the words
    # that the one before it does not cover
    return s.withColumn("n_repeat_words", F.expr(f"""
        aggregate(
          array_sort(transform(
            filter(_sorted, (x, j) -> x.h <=> get(_sorted, j - 1).h OR x.h <=> get(_sorted, j + 1).h), x -> x.i)),
          struct(-{WINDOW} AS last, 0L AS n),
          (a, i) -> struct(i AS last, a.n + least({WINDOW}, i - a.last) AS n),
          a -> a.n)""")).drop("_sorted")


def _value(feature: str) -> Column:
    top, _, below = FEATURES[feature][0].partition(" / ")
    return F.coalesce(F.try_divide(F.col(top), F.col(below)), F.lit(0.0)) if below else F.col(top).cast("double")


def condition(c: Condition) -> Column:
    feature, side, at = c
    return _value(feature) >= at if side == ">=" else _value(feature) < at


def covers(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & condition(c)
    return out


def verdict(rules: list[Rule]) -> Column:
    """True where no rule of the list applies: an ordered CASE WHEN."""
    out = None
    for rule in rules:
        out = F.when(covers(rule), False) if out is None else out.when(covers(rule), False)
    return F.lit(True) if out is None else out.otherwise(True)


def _binned(rows: DataFrame) -> DataFrame:
    """The staged form of labelled statistics: for each feature, how many of its thresholds the value reaches."""
    def level(feature: str) -> Column:
        value = _value(feature)
        return F.size(F.filter(F.array(*[F.lit(float(x)) for x in FEATURES[feature][1]]), lambda x: x <= value))

    levels = [level(f) for f in FEATURES]
    return rows.select("_bad", "_grow", F.array(*levels).alias("_levels"))


def _level_test(c: Condition) -> Column:
    feature, side, at = c
    k, cuts = list(FEATURES).index(feature), FEATURES[feature][1]
    level = F.get("_levels", F.lit(k))
    return level > cuts.index(at) if side == ">=" else level <= cuts.index(at)


def _matches(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & _level_test(c)
    return out


def _best_condition(rows: DataFrame, bad: float, good: float) -> tuple[float, Condition] | None:
    """The condition of greatest gain over growing rows, from counts per feature and level."""
    counts = (rows.select("_bad", F.posexplode("_levels").alias("f", "level"))
              .groupBy("f", "level").agg(F.sum("_bad").alias("bad"), F.count(F.lit(1)).alias("n")).collect())
    best, before = None, log2(bad / (bad + good))
    for k, (feature, (_, cuts)) in enumerate(FEATURES.items()):
        own = [(r["level"], r["bad"], r["n"] - r["bad"]) for r in counts if r["f"] == k]
        for j, cut in enumerate(cuts):
            above = [sum(r[x] for r in own if r[0] > j) for x in (1, 2)]
            for side, (p, n) in ((">=", above), ("<", (bad - above[0], good - above[1]))):
                if p > 0:
                    gain = p * (log2(p / (p + n)) - before)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, (feature, side, cut)
    return best


def learn(labelled: DataFrame, precision: float = 0.9, least: int = 5, conditions: int = 4, rules: int = 12,
          ) -> list[Rule]:
    """A decision list from ``labelled``: the statistics, _bad (0 or 1) and _grow.

    ``least``: bad documents a rule must cover in the pruning part; the list
    stops at ``rules`` rules of ``conditions`` conditions at most.
    """
    rows, found = materialize(_binned(labelled), "rules-labelled"), []
    while len(found) < rules:
        grow, rule = rows.where("_grow"), []
        while len(rule) < conditions:
            own = grow.where(_matches(rule))
            p, n = own.agg(F.coalesce(F.sum("_bad"), F.lit(0)), F.count(F.lit(1))).first()
            if not p or p == n or (best := _best_condition(own, p, n - p)) is None:
                break
            rule.append(best[1])
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        held = rows.where("NOT _grow").agg(*[f for r in prefixes for f in (
            F.coalesce(F.sum(F.when(_matches(r), F.col("_bad"))), F.lit(0)), F.count(F.when(_matches(r), 1)))]).first()
        worth = [(2 * held[2 * k] - held[2 * k + 1]) / max(1, held[2 * k + 1]) for k in range(len(prefixes))]
        k = max(range(len(prefixes)), key=lambda i: (worth[i], -i))
        if held[2 * k] < least or held[2 * k] < precision * held[2 * k + 1]:
            break
        found.append(prefixes[k])
        rows = rows.where(~_matches(prefixes[k]))
    return found


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, all statistics, base_failed, kept, rule (place of
    the first rule that applies, null if none)."""
    stats = materialize(statistics(docs, id_col, text_col), "rules-statistics")
    taught = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_q")).where(
        F.col("_q").isin(0, 1))
    labelled = stats.join(taught, F.col("doc_id") == F.col("_id")).withColumn("_bad", 1 - F.col("_q")).withColumn(
        "_grow", F.crc32(F.col("_id").cast("string").cast("binary")) % 3 != 0)
    found = learn(labelled, **options)
    first = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(found))):
        first = F.when(covers(rule), k).otherwise(first)
    return stats.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(found)).withColumn("rule", first)

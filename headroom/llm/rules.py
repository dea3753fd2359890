"""Quality rules as a learned decision list. DataFrame and SQL functions only.

Statistics of every whole text are Spark expressions. From labelled rows, sequential covering learns
an ordered list of threshold conjunctions that reject: a rule grows by the condition of the largest
information gain, is pruned back on rows that it wasn't grown on, and is kept if it is precise there;
the rows that it covers leave, and the next rule is grown. A rule that isn't precise is dropped and another
one grown from the best start that is left, each feature and direction once; covering ends when no start is.
Each step needs only counts by feature and bin, a table of fixed size that Spark sums up. The result is one
ordered CASE expression. The most rules and conditions are parameters, and the result tells whether one of them cut the list.

Defined cases: null text has no words; texts without words have zero statistics and fail the base;
null doc_ids and labels without a document are no training rows; if labels repeat for a doc_id, the
lowest quality counts; without labels no rule is learned and the base decides; repeated rows are
kept, one result row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, DOCUMENT_COLUMNS, cut, read, remainder, text_crc32, words_of

WINDOW = 5
SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 10
REPEAT_PERCENT = 20
#: Of labelled rows, those with this remainder are kept for tests of the learned list.
FOLDS = 5
#: Shares of the labelled rows at which a feature may be cut.
CUTS = tuple(sorted({*(k / 24 for k in range(1, 24)), 0.005, 0.01, 0.02, 0.03, 0.06, 0.94, 0.97, 0.98, 0.99, 0.995}))
#: Defaults of the most rules of a list and conditions of a rule.
MOST_RULES = 12
MOST_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_COVERED = 4

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the counts that features need."""
    t = F.coalesce(F.col(text), F.lit(""))
    kept = [F.col(c) for c in df.columns]
    one = df.select(*kept, t.alias("__t"), words_of(t).alias("__w"), F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "").alias("__lines"))
    window = F.transform("__w", lambda w, i: F.xxhash64(w, *[F.get("__w", i + k) for k in range(1, WINDOW)]))
    two = one.select(*kept, "__t", "__w", "__lines", F.slice(window, 1, F.greatest(F.size("__w") - (WINDOW - 1), F.lit(0))).alias("__h"))
    doubled = F.size(F.array_distinct("__h")) < F.size("__h")
    order = F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    three = two.select(*kept, "__t", "__w", "__lines", F.when(doubled, order).alias("__s"))
    same = F.filter("__s", lambda x, i: (i > 0) & (x["h"] == F.get("__s", i - 1)["h"]) | F.coalesce(x["h"] == F.get("__s", i + 1)["h"], F.lit(False)))
    four = three.select(*kept, "__t", "__w", "__lines", F.array_sort(F.transform(same, lambda x: x["i"])).alias("__p"))
    covered = F.aggregate(F.transform("__p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__p", i + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    without = lambda pattern: F.length(F.regexp_replace("__t", pattern, "")).cast("long")
    return four.select(
        *kept,
        F.size("__w").cast("long").alias("n_words"),
        without(BLANKS).alias("word_chars"),
        without(SYMBOLS).alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        without(r"[^A-Z]+").alias("n_upper"),
        without(r"[^0-9]+").alias("n_digits"),
        without(r"[^!?]+").alias("n_bangs"),
        without(r"[^.,]+").alias("n_stops"),
        F.size(F.array_distinct("__w")).cast("long").alias("n_distinct"),
    )


def features() -> dict[str, Column]:
    """What conditions may cut, by name."""
    each = lambda c, of="n_words": F.col(c) / F.greatest(F.col(of), F.lit(1)).cast("double")
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": each("word_chars"),
        "symbols_per_word": each("n_symbols"),
        "repeated_line_share": each("n_dup_lines", "n_lines"),
        "repeated_word_share": each("n_repeat_words"),
        "capitals_share": each("n_upper", "word_chars"),
        "digits_share": each("n_digits", "word_chars"),
        "bangs_per_word": each("n_bangs"),
        "stops_per_word": each("n_stops"),
        "distinct_word_share": each("n_distinct"),
        "words_per_line": each("n_words", "n_lines"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


class Learned(list[Rule]):
    """A decision list; `cut` tells that it ended, or a rule of it, at the most rules or conditions and not by itself."""

    cut = False


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def learn(labelled: DataFrame, most_rules: int = MOST_RULES, most_conditions: int = MOST_CONDITIONS) -> Learned:
    """Decision list from rows with the counts, `bad` (boolean) and `grow` (boolean: grown on, else pruned on)."""
    known = features()
    names = list(known)
    first = labelled.agg(F.sum(F.col("bad").cast("int")).alias("bad"), *[F.percentile_approx(known[n], list(CUTS), 10_000).alias(n) for n in names]).first()
    if not first["bad"]:
        return Learned()
    cuts = {n: sorted(set(first[n])) for n in names}
    # value <= cut k where bin <= k
    bins = F.array(*[_bin(known[n], cuts[n]) for n in names])
    rows = cut(labelled.select("bad", "grow", bins.alias("bins")), "rules-bins")
    place = {n: i for i, n in enumerate(names)}
    told = lambda n, above, k: F.get("bins", F.lit(place[n])) > k if above else F.get("bins", F.lit(place[n])) <= k
    rules: list[list[tuple[str, bool, int]]] = []
    failed: set[tuple[str, bool]] = set()  # starts that gave no precise rule since the last one that is
    short = False
    while True:
        left = rows
        for r in rules:
            left = left.filter(~_all([told(*c) for c in r]))
        rule: list[tuple[str, bool, int]] = []
        impure = False
        while len(rule) < most_conditions:
            inside = left.filter("grow").filter(_all([told(*c) for c in rule])).select("bad", F.posexplode("bins").alias("f", "b"))
            sums = inside.groupBy("f", "b").agg(F.count_if(F.col("bad")).alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()  # features x bins rows
            best, gain = _best(sums, names, cuts, set() if rule else failed)
            if best is None or gain <= 0:
                impure = False
                break
            rule.append(best[:3])
            impure = best[4] > 0
            if not impure:
                break
        if not rule:
            break
        if len(rules) == most_rules:
            short = True
            break
        prune = left.filter("not grow")
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        counts = prune.agg(*[F.count_if(_all([told(*c) for c in p]) & (F.col("bad") == F.lit(b))).alias(f"{k}{'bg'[not b]}") for k, p in enumerate(prefixes) for b in (True, False)]).first()
        worth = [((counts[f"{k}b"] - counts[f"{k}g"]) / max(1, counts[f"{k}b"] + counts[f"{k}g"]), -k) for k in range(len(rule))]
        k = -max(worth)[1]
        bad, good = counts[f"{k}b"], counts[f"{k}g"]
        if bad < MIN_COVERED or bad < MIN_PRECISION * (bad + good):
            failed.add(rule[0][:2])
            continue
        short |= impure and k + 1 == most_conditions
        rules.append(rule[: k + 1])
        failed.clear()
    out = Learned(tuple(Condition(n, above, float(cuts[n][k])) for n, above, k in r) for r in rules)
    out.cut = short
    return out


def _bin(value: Column, cuts: list[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < value))


def _best(sums: list, names: list[str], cuts: dict[str, list[float]], barred: set[tuple[str, bool]]) -> tuple[tuple | None, float]:
    """Condition of the largest information gain: (feature, above, cut, bad, good). Of equal ones the first by feature, cut and direction."""
    best, most = None, 0.0
    bad, good = (sum(r[c] for r in sums if r["f"] == 0) for c in ("bad", "good"))
    if not bad:
        return None, 0.0
    prior = math.log2(bad / (bad + good))
    for i, n in enumerate(names):
        own = {r["b"]: (r["bad"], r["good"]) for r in sums if r["f"] == i}
        b = g = 0
        for k in range(len(cuts[n])):
            b, g = b + own.get(k, (0, 0))[0], g + own.get(k, (0, 0))[1]
            for above, p, q in ((False, b, g), (True, bad - b, good - g)):
                if (n, above) not in barred and p >= MIN_COVERED and (gain := p * (math.log2(p / (p + q)) - prior)) > most:
                    best, most = (n, above, k, p, q), gain
    return best, most


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_all([c.column() for c in rule]), F.lit(k)).otherwise(out)
    return out


def learn_from_labels(counts: DataFrame, labels: DataFrame, most_rules: int = MOST_RULES, most_conditions: int = MOST_CONDITIONS) -> Learned:
    """Rules from rows (doc_id, the counts) and labels (doc_id, quality)."""
    quality = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("__quality"))
    training = counts.filter(~base_failed() & (remainder(F.col("doc_id"), FOLDS) != 0)).join(quality, "doc_id")
    grow = F.pmod(F.floor(text_crc32(F.col("doc_id")) / FOLDS), F.lit(3)) != 0
    return learn(training.withColumns({"bad": F.col("__quality") == 0, "grow": grow}), most_rules, most_conditions)


def apply_rules(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """counts with base_failed, rule and kept."""
    return counts.withColumns({"base_failed": base_failed(), "rule": verdict(rules)}).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_rules(docs: DataFrame, labels: DataFrame, most_rules: int = MOST_RULES, most_conditions: int = MOST_CONDITIONS) -> DataFrame:
    """Counts and verdict of every row; `rule` is the number of the rule that rejects, `rules_cut` tells that a limit cut the list."""
    counts = cut(with_counts(docs.select("doc_id", "text")).drop("text"), "rules")
    rules = learn_from_labels(counts, labels, most_rules, most_conditions)
    return apply_rules(counts, rules).select("doc_id", *COUNTS, "base_failed", "kept", "rule", F.lit(rules.cut).alias("rules_cut"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    # written first: a filter would be pushed below the projections of the counts and repeat their work for every use
    counted = cut(with_counts(docs), "rules-docs")
    rules = learn_from_labels(counted, read(spark, sf_dir, "labels"))
    return apply_rules(counted, rules).filter("kept").select(*docs.columns)

"""Quality rules: a decision list learned by sequential covering, applied as one Spark conditional expression.

Everything runs as DataFrame expressions. The driver only holds counts by feature, bin and class.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscore.llm.common import BLANKS, WORD_SPLIT, query, table
from keyscore.storage import materialize

#: The features that conditions may test, all ratios of what ``text_statistics`` counts.
FEATURES = ("n_words", "mean_word", "symbol_share", "duplicate_line_share", "repeat_share", "distinct_share")
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Condition:
    """``feature >= threshold`` or ``feature < threshold``."""

    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once although ``body`` names it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPLIT))


def covered(places: Column, width: int) -> Column:
    """How many places the windows of ``width`` that start at the sorted ``places`` cover together."""
    state = F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, p: F.struct((p + width).alias("end"), (s["n"] + width - F.greatest(s["end"] - p, F.lit(0))).alias("n")),
    )
    return state["n"]


def repeated_words(w: Column) -> Column:
    """Words in windows of five words that occur twice or more in the text."""
    hashes = F.when(
        F.size(w) > WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW)))),
    ).otherwise(F.array().cast("array<bigint>"))

    def twice(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return let(
            ordered,
            lambda s: covered(
                F.sort_array(
                    F.transform(
                        F.filter(
                            s,
                            lambda e, j: F.coalesce(F.get(s, j - 1)["x"] == e["x"], F.lit(False))
                            | F.coalesce(F.get(s, j + 1)["x"] == e["x"], F.lit(False)),
                        ),
                        lambda e: e["i"],
                    )
                ),
                WINDOW,
            ),
        )

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(twice(h)))


def counts_of(text: Column) -> Column:
    """The counts of ``text_statistics`` as a struct; ``text`` is not null."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    by_word = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
    )
    return F.struct(
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        let(words(text), by_word).alias("by_word"),
    )


def counted(docs: DataFrame, *more: Column) -> DataFrame:
    rows = docs.select(*more, counts_of(F.coalesce(F.col("text"), F.lit(""))).alias("counts"))
    return rows.select(*(c for c in rows.columns if c != "counts"), "counts.*").select("*", "by_word.*").drop("by_word")


def text_statistics(docs: DataFrame, rows: bool = False) -> DataFrame:
    """``doc_id``, the counts ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_lines``, ``n_repeat_words``
    and ``n_distinct_words`` (long) for each row of ``docs``.

    A null text counts as empty, for which all counts but that of lines (1) are 0. Each row is looked at for itself, so
    repeated rows and ids do no harm; other columns are not read. A text's words stay in its row: nothing is shuffled, so
    a text or a source that is frequent costs no more than others. With ``rows``, the whole row stands beside them as
    the struct ``row``.
    """
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if rows else []
    return counted(docs, F.col("doc_id").cast("long").alias("doc_id"), *row)


def with_features(stats: DataFrame) -> DataFrame:
    """The ratios that rules test, beside the counts (``n_words`` is a feature as it is)."""
    total, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return stats.withColumns(
        {
            "mean_word": F.col("word_chars") / total,
            "symbol_share": F.col("n_symbols") / chars,
            "duplicate_line_share": F.col("n_dup_lines") / F.col("n_lines"),
            "repeat_share": F.col("n_repeat_words") / total,
            "distinct_share": F.col("n_distinct_words") / total,
        }
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def labelled(features: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Features with ``bad`` (quality 0) of at most about ``most`` labelled documents, picked by a hash of the id.

    A document with several labels counts as bad if any is 0; null labels and ids are left out.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg((F.min("quality") == 0).alias("bad"))
    total = known.count()
    if total > most:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * most / total)))
    return features.join(known, "doc_id").select(*(F.col(f).cast("double").alias(f) for f in FEATURES), "bad", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0).alias("prune"))


def learn_rules(
    features: DataFrame,
    labels: DataFrame,
    max_rules: int = 6,
    max_conditions: int = 3,
    thresholds: int = 24,
    min_precision: float = 0.95,
    min_covered: int = 5,
    max_labelled: int = 200_000,
) -> list[Rule]:
    """Rules that recognise bad documents, in the order in which they were learned.

    Two thirds of the labelled rows grow a rule: from all rows left, the condition with the largest information gain
    is added until no good row is covered. The other third prunes it: of its prefixes the one with the best
    (bad - good) / (bad + good) stays, and the rule is kept if it reaches ``min_precision`` there. Covered rows leave
    and the next rule is grown. Ties go to the first feature and the lowest threshold. Thresholds are quantiles of the
    bad and of the good rows. At most ``max_labelled`` rows are used. Without labels of both kinds there is no rule.
    """
    rows = materialize(labelled(features, labels, max_labelled), "rules-labelled")
    points = [i / thresholds for i in range(thresholds + 1)]
    quantiles = rows.groupBy("bad").agg(*(F.percentile_approx(f, points, 2000).alias(f) for f in FEATURES)).collect()
    if len(quantiles) < 2:
        return []
    cuts = {f: sorted({x for q in quantiles for x in q[f] if x is not None}) for f in FEATURES}

    def bin_of(feature: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[feature])), lambda t: t <= F.col(feature)))

    bins = F.array(*map(bin_of, FEATURES))
    rows = materialize(rows.select("bad", "prune", bins.alias("bins")), "rules-bins")

    def holds(conditions: list[tuple[int, bool, int]]) -> Column:
        out = F.lit(True)
        for f, at_least, cut in conditions:
            out &= (F.get("bins", F.lit(f)) >= cut) if at_least else (F.get("bins", F.lit(f)) < cut)
        return out

    def counts(left: DataFrame) -> list:
        by_bin = left.select("bad", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin")
        return by_bin.agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()

    def grow(left: DataFrame) -> list[tuple[int, bool, int]]:
        rule: list[tuple[int, bool, int]] = []
        while len(rule) < max_conditions:
            table = counts(left.where(holds(rule)))
            p0, n0 = (sum(r[k] for r in table if r.feature == 0) for k in ("p", "n"))
            if not p0 or not n0:
                break
            best, choice = 0.0, None
            for f, name in enumerate(FEATURES):
                for cut in range(1, len(cuts[name]) + 1):
                    for at_least in (True, False):
                        inside = [r for r in table if r.feature == f and (r.bin >= cut) == at_least]
                        p, n = sum(r.p for r in inside), sum(r.n for r in inside)
                        if p >= min_covered and n < n0:
                            gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                            if gain > best + 1e-9:
                                best, choice = gain, (f, at_least, cut)
            if choice is None:
                break
            rule.append(choice)
        return rule

    def pruned(left: DataFrame, rule: list[tuple[int, bool, int]]) -> list[tuple[int, bool, int]]:
        aggs = []
        for k in range(1, len(rule) + 1):
            aggs += [F.count_if(holds(rule[:k]) & F.col("bad")).alias(f"p{k}"), F.count_if(holds(rule[:k]) & ~F.col("bad")).alias(f"n{k}")]
        found = left.agg(*aggs).first()
        worth = [((found[f"p{k}"] - found[f"n{k}"]) / max(found[f"p{k}"] + found[f"n{k}"], 1), -k) for k in range(1, len(rule) + 1)]
        k = -max(worth)[1]
        p, n = found[f"p{k}"], found[f"n{k}"]
        return rule[:k] if p and p / (p + n) >= min_precision else []

    learned: list[list[tuple[int, bool, int]]] = []
    while len(learned) < max_rules:
        left = rows
        for rule in learned:
            left = left.where(~holds(rule))
        rule = grow(left.where(~F.col("prune")))
        rule = pruned(left.where("prune"), rule) if rule else []
        if not rule:
            break
        learned.append(rule)
    return [tuple(Condition(FEATURES[f], at_least, cuts[FEATURES[f]][cut - 1]) for f, at_least, cut in rule) for rule in learned]


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 where none does. One ordered conditional expression."""
    out = None
    for number, rule in enumerate(rules, 1):
        test = F.lit(True)
        for condition in rule:
            test &= condition.column()
        out = F.when(test, number) if out is None else out.when(test, number)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(features: DataFrame, rules: list[Rule]) -> DataFrame:
    """``base_failed``, ``rule`` (see ``decision``) and ``kept`` beside the features."""
    return features.withColumns({"base_failed": base_failed(), "rule": decision(rules)}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )


def keep_good(docs: DataFrame, rules: list[Rule], features: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that neither the base rules nor ``rules`` reject, with all their columns.

    ``features`` are those of all of ``docs``, each beside its ``row`` (``text_statistics`` with ``rows``), where they are known.
    """
    rows = with_features(text_statistics(docs, rows=True)) if features is None else features
    return judge(rows, rules).where("kept").select("row.*")


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = with_features(materialize(text_statistics(table(spark, sf_dir, "documents")), "rules-statistics"))
    judged = judge(features, learn_rules(features, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")

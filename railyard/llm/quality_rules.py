"""Quality by weak supervision (operator 1, DataFrame functions only).

Rules look at counts of a text and vote good, bad or abstain. The table of vote patterns (at most 3 ** rules rows,
whatever the corpus) is summed over all documents; expectation-maximisation over it estimates each rule's accuracies (on
good and on bad texts) and the share of good texts, one aggregate query a round, of which the driver sees one row. A text's posterior probability
of being good then replaces the demand that all rules pass.

Defined cases: a null or blank text has no words, fails the base and isn't kept. Counts are of whole texts, in code
points. Ties (a posterior of one half) are kept. Repeated rows get equal results; a null doc_id is returned as it is;
other columns take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm.common import documents, once, stored, words_of

WINDOW = 8
ROUNDS = 12
# of votes on good and on bad texts: a rule knows one kind of bad text, and seldom faults a good one
START_ACCURACY, START_SHARE = (0.98, 0.4), 0.85
LEAST = 0.002  # estimates stay this far from certainty
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks", "n_distinct")


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and COUNTS of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    t = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    t = t.select("doc_id", words_of(F.col("text")).alias("w"), lines.alias("lines"),
                 F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("n_symbols"),
                 F.regexp_count(text, F.lit(r"\p{Lu}")).alias("n_upper"), F.regexp_count(text, F.lit(r"[\p{L}\p{N}]")).alias("n_letters"),
                 F.regexp_count(text, F.lit("[!?]")).alias("n_marks"))
    t = once(t, F.struct("w", "lines"), "arrays", "doc_id", "n_symbols", "n_upper", "n_letters", "n_marks")
    words, lines = F.col("arrays.w"), F.col("arrays.lines")
    t = t.select("doc_id", "n_symbols", "n_upper", "n_letters", "n_marks", F.size(words).alias("n_words"),
                 F.length(F.array_join(words, "")).alias("word_chars"), F.size(lines).alias("n_lines"),
                 (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
                 F.transform(words, lambda w: F.xxhash64(w)).alias("h"))
    t = once(t, F.col("h"), "h", *[c for c in t.columns if c != "h"])
    kept = [c for c in t.columns if c != "h"]
    windows = F.when(F.size("h") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("h") - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    t = once(t.select(*kept, "h", windows.alias("g")), F.struct(F.col("g"), F.size(F.array_distinct("h")).alias("n_distinct")), "hg", *kept)
    t = t.select(*kept, F.col("hg.n_distinct").alias("n_distinct"), F.col("hg.g").alias("g"))
    kept.append("n_distinct")
    # (window, position) in order of window, only of texts that hold a window twice
    order = F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array(F.transform("g", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    t = once(t, order, "s", *kept)
    twice = F.filter("s", lambda e, j: (F.get("s", j - 1)["g"] == e["g"]) | (F.get("s", j + 1)["g"] == e["g"]))
    # a window covers its words but for those that the one before it has covered
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(F.sort_array(F.transform(twice, lambda e: e["i"])), start, lambda a, i: F.struct(
        i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")), lambda a: a["n"])
    t = t.withColumn("n_repeat_words", F.coalesce(F.when(F.col("s").isNotNull(), covered), F.lit(0)))
    return t.select("doc_id", *[F.col(c).cast("long").alias(c) for c in COUNTS])


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """1 good, -1 bad, 0 abstain."""
    words, length = F.col("n_words"), _ratio("word_chars", "n_words")
    symbols, letters = _ratio("n_symbols", "n_words"), _ratio("n_letters", "word_chars")
    repeats, variety = _ratio("n_repeat_words", "n_words"), _ratio("n_distinct", "n_words")
    marks, upper = _ratio("n_marks", "n_words"), _ratio("n_upper", "n_letters")
    copies = _ratio("n_dup_lines", "n_lines")
    never = F.lit(False)
    # each kind of bad text is known to two rules at least, so that it isn't taken for a slip of one
    return {
        "size": _vote(never, words < 12),
        "word_length": _vote(never, ~length.between(2, 14)),
        "symbols": _vote(symbols < 0.1, symbols > 0.4),
        "letters": _vote(letters > 0.92, letters < 0.88),
        "repeats": _vote(repeats < 0.1, repeats > 0.3),
        "variety": _vote(variety > 0.4, variety < 0.25),
        "upper_case": _vote(upper < 0.15, upper > 0.5),
        "marks": _vote(marks < 0.1, marks > 0.5),
        "copied_lines": _vote(copies < 0.1, copies > 0.4),
    }


Accuracies = dict[str, tuple[float, float]]


def _log_odds(accuracy: Accuracies, share: float) -> Column:
    """Of good against bad; an abstention says nothing, and no vote counts against what it says."""
    out = F.lit(math.log(share / (1 - share)))
    for r, (on_good, on_bad) in accuracy.items():
        good, bad = max(0.0, math.log(on_good / (1 - on_bad))), min(0.0, math.log((1 - on_good) / on_bad))
        out = out + F.when(F.col(r) == 1, good).when(F.col(r) == -1, bad).otherwise(0.0)
    return out


def posterior(accuracy: Accuracies, share: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_log_odds(accuracy, share)))


def estimate(patterns: DataFrame, rules: list[str], rounds: int = ROUNDS) -> tuple[Accuracies, float]:
    """(accuracy on good, on bad texts) of each rule's votes, and the share of good texts, by EM over (votes, n)."""
    accuracy, share = dict.fromkeys(rules, START_ACCURACY), START_SHARE
    good, bad = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))

    def total(r: str, vote: int, weight: Column, name: str) -> Column:
        return F.sum(F.when(F.col(r) == vote, weight).otherwise(0.0)).alias(f"{name}_{r}")

    for _ in range(rounds):
        sums = [total(r, v, w, name) for r in rules for v, w, name in (
            (1, good, "kept"), (-1, good, "lost"), (-1, bad, "caught"), (1, bad, "missed"))]
        row = patterns.withColumn("p", posterior(accuracy, share)).agg(F.sum(good).alias("good"), F.sum("n").alias("all"), *sums).first()
        if not row["all"]:
            break
        share = _bounded((row["good"] + 1) / (row["all"] + 2))
        accuracy = {r: (_bounded((row[f"kept_{r}"] + START_ACCURACY[0]) / (row[f"kept_{r}"] + row[f"lost_{r}"] + 1)),
                        _bounded((row[f"caught_{r}"] + START_ACCURACY[1]) / (row[f"caught_{r}"] + row[f"missed_{r}"] + 1))) for r in rules}
    return accuracy, share


def _bounded(p: float) -> float:
    return min(max(p, LEAST), 1 - LEAST)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts, base_failed, posterior and kept, one row per input row."""
    counts = stored(text_counts(docs, id_col, text_col), "text-counts")
    rules = votes()
    voted = counts.select("*", *[v.alias(f"vote_{r}") for r, v in rules.items()])
    names = [f"vote_{r}" for r in rules]
    patterns = stored(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "vote-patterns")
    accuracy, share = estimate(patterns, names)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = voted.withColumn("base_failed", failed).withColumn("posterior", posterior(accuracy, share))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")

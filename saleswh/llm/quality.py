"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule says good (1), bad (-1) or nothing (0) about a document. Nobody knows
which documents are good; the model takes that as hidden and estimates for each
rule how often it says good or bad of good and of bad documents. The posterior
probability of being good decides. Only built-in functions are used; a task
works on one row at a time, and the model sees a table of vote patterns, at
most 3^9 rows however many documents there are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.llm.common import BLANKS, kept
from saleswh.operators.files import write_once

BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Fixed values of the base verdict.
LEAST_WORDS, MOST_REPEATED_PERCENT = 10, 20
WINDOW = 5
# Frequent short words of four languages; prose holds some of them.
FUNCTION_WORDS = (
    "the of and to in is that for with as a de la le les et des en un une que el los las y del se por der die das und "
    "zu den mit von ist ein eine"
).split()


def with_features(documents: DataFrame) -> DataFrame:
    """``documents`` with the counts of the base and those only the rules use.

    Null text counts as no words. Repeated windows are found by sorting the
    hashes of a text's own windows, so the time grows as n log n for long ones.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    cut = documents.withColumns(
        {"_words": F.array_remove(F.split(text, BLANKS), ""), "_lines": lines}
    )
    last = F.size("_words") - (WINDOW - 1)
    windows = F.transform(
        F.slice("_words", F.lit(1), F.greatest(last, F.lit(0))),
        lambda word, at: F.xxhash64(word, *(F.get("_words", at + i) for i in range(1, WINDOW))),
    )
    hashed = cut.withColumn("_windows", windows)
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, at: F.struct(h.alias("h"), at.alias("at")))
    ordered = hashed.withColumn(
        "_sorted", F.when(repeats, F.array_sort(placed)).otherwise(F.slice(placed, F.lit(1), F.lit(0)))
    )

    def twice(entry: Column, at: Column) -> Column:
        before, behind = F.get("_sorted", at - 1), F.get("_sorted", at + 1)
        return F.coalesce(entry["h"] == before["h"], F.lit(False)) | F.coalesce(entry["h"] == behind["h"], F.lit(False))

    places = ordered.withColumn(
        "_places", F.array_sort(F.transform(F.filter("_sorted", twice), lambda entry: entry["at"]))
    )
    covered = F.aggregate(
        F.transform(
            "_places",
            lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", i + 1) - at, F.lit(WINDOW))),
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    n_lines = F.size("_lines")
    ended = F.size(F.filter("_lines", lambda line: line.rlike(r"[.!?][\x20\x09-\x0D]*$")))
    return places.select(
        *documents.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        n_lines.cast("long").alias("n_lines"),
        ended.cast("long").alias("n_ended_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct_words"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_shouts"),
        F.size(F.array_intersect("_words", F.array(*map(F.lit, FUNCTION_WORDS)))).cast("long").alias("n_function_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def _vote(bad: Column, good: Column | None = None) -> Column:
    vote = F.when(bad, -1)
    return (vote if good is None else vote.when(good, 1)).otherwise(0)


def rules() -> dict[str, Column]:
    """The votes. Most rules only know what is bad; two also know what looks like prose."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    per_word = F.col("word_chars") / words
    long_enough = F.col("n_words") >= 20
    return {
        "length": _vote(F.col("n_words") < LEAST_WORDS),
        "word_size": _vote((per_word < 2) | (per_word > 15)),
        "symbols": _vote(F.col("n_symbols") > 0.1 * words),
        "repeats": _vote(100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * words),
        "double_lines": _vote(F.col("n_dup_lines") > 0.5 * F.col("n_lines")),
        "capitals": _vote(long_enough & (F.col("n_capitals") > 0.3 * chars)),
        "shouts": _vote(long_enough & (F.col("n_shouts") > 0.2 * words)),
        "variety": _vote((F.col("n_words") >= 50) & (F.col("n_distinct_words") < 2 * F.sqrt(words))),
        "sentences": _vote(
            (F.col("n_ended_lines") == 0) & (F.col("n_words") >= 200), 2 * F.col("n_ended_lines") >= F.col("n_lines")
        ),
        "function_words": _vote(F.lit(False), F.col("n_function_words") >= 3),
    }


@dataclass(frozen=True)
class LabelModel:
    """``good`` is the prior; ``said[rule][y][v]`` the chance that a rule votes v of a document of class y."""

    good: float
    said: dict[str, dict[int, dict[int, float]]]

    def log_odds(self) -> Column:
        total = F.lit(math.log(self.good / (1 - self.good)))
        for rule, said in self.said.items():
            vote = F.col(f"vote_{rule}")
            odds = {v: math.log(said[1][v] / said[0][v]) for v in (-1, 0, 1)}
            total = total + F.when(vote == 1, odds[1]).when(vote == -1, odds[-1]).otherwise(odds[0])
        return total

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def first_model(names: list[str]) -> LabelModel:
    """Before any data: about one rule in ten speaks against a bad document, almost none against a good one."""
    both = {1: {-1: 0.003, 0: 0.10, 1: 0.897}, 0: {-1: 0.12, 0: 0.22, 1: 0.66}}
    only_bad = {1: {-1: 0.003, 0: 0.995, 1: 0.002}, 0: {-1: 0.12, 0: 0.878, 1: 0.002}}
    return LabelModel(
        0.85, {name: both if name in ("sentences", "function_words") else only_bad for name in names}
    )


#: Documents that the hand-set first model counts for, whatever the size of the corpus.
PRIOR_DOCUMENTS = 100


def fit_label_model(votes: DataFrame, rounds: int = 12, prior_documents: float = PRIOR_DOCUMENTS) -> LabelModel:
    """Expectation-maximisation over the vote patterns of all documents.

    Every round is one aggregation over the pattern table, which returns one
    row. The first model keeps the weight of ``prior_documents`` in each class,
    which gives the two classes their meaning and matters less the more
    documents there are.
    """
    names = [c.removeprefix("vote_") for c in votes.columns if c.startswith("vote_")]
    patterns = kept(votes.groupBy(*(f"vote_{n}" for n in names)).agg(F.count("*").alias("n_docs")))
    start = model = first_model(names)
    for _ in range(rounds):
        weighed = patterns.withColumn("w1", F.col("n_docs") * model.posterior())
        weighed = weighed.withColumn("w0", F.col("n_docs") - F.col("w1"))
        sums = {"n": F.sum("n_docs"), "g": F.sum("w1")}
        for name in names:
            for y in (0, 1):
                for v in (-1, 0, 1):
                    sums[f"{name}:{y}:{v}"] = F.sum(F.when(F.col(f"vote_{name}") == v, F.col(f"w{y}")))
        row = weighed.agg(*(column.alias(key) for key, column in sums.items())).first()
        if not row["n"]:
            break
        own = prior_documents
        weight = {1: row["g"] + own, 0: row["n"] - row["g"] + own}
        said = {
            name: {
                y: {
                    v: ((row[f"{name}:{y}:{v}"] or 0.0) + own * start.said[name][y][v]) / weight[y] for v in (-1, 0, 1)
                }
                for y in (0, 1)
            }
            for name in names
        }
        model = LabelModel((row["g"] + own * start.good) / (row["n"] + own), said)
    return model


def with_votes(documents: DataFrame) -> DataFrame:
    return with_features(documents).withColumns({f"vote_{name}": vote for name, vote in rules().items()})


def quality_verdicts(documents: DataFrame, least: float = 0.5) -> DataFrame:
    """Per row ``doc_id``, the base counts, ``base_failed``, ``posterior`` and ``kept``.

    ``kept`` is false if the base failed, else whether the posterior reaches
    ``least``. A null or empty text has no words and fails. Repeated rows are
    judged one by one; a null doc_id stays null; no rows in, none out.
    """
    voted = kept(with_votes(documents.select(F.col("doc_id").cast("long"), "text")).drop("text"))
    model = fit_label_model(voted)
    judged = voted.select("*", base_failed().alias("base_failed"), model.posterior().alias("posterior"))
    return judged.select(
        "doc_id",
        *BASE_COLUMNS,
        "base_failed",
        (~F.col("base_failed") & (F.col("posterior") >= least)).alias("kept"),
        "posterior",
    )


def drop_low_quality(documents: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that are kept, all columns as they were.

    Counts and votes are found once and stored beside the rows, for the model
    and for the verdict.
    """
    own = documents.select(F.struct(*documents.columns).alias("_row"), F.col("text").alias("text"))
    voted, _ = write_once(with_votes(own).drop("text"), "quality-votes")
    model = fit_label_model(voted)
    return voted.filter(~base_failed() & (model.posterior() >= least)).select("_row.*")

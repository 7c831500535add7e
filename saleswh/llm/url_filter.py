"""URL filters: rules first, then the log-likelihood ratio of two character language models.

One model is trained on the URLs that the rules accept, one on those they
reject; both read whole URLs. They are Markov models of variable order: the
chance of a character after a context is smoothed with that after the shorter
context, down to single characters. The difference of the two log likelihoods,
per character, decides URLs without a rule. Its threshold is calibrated on the
URLs with one, each scored by models of the half it is not in, since a model
thinks better of URLs it has learned. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.common import ascii_lower, kept

Rule = tuple[str, str, str]  # allow or block, host, path

ORDER = 4
SMOOTHING = 2.0
ALPHABET = 256.0
EDGE, END = "\x02", "\x03"
BINS = 0.005


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty for null and for a URL without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its action; null where none fits. Ties go to the first."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    longest_first = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    for kind, of_host, of_path in reversed(longest_first):
        fits = ((host == of_host) | host.endswith(f".{of_host}")) & path.startswith(of_path)
        text = F.when(fits, F.lit(of_host + of_path)).otherwise(text)
        action = F.when(fits, F.lit(kind)).otherwise(action)
    return text, action


def _grams(urls: DataFrame) -> DataFrame:
    """A row per character of ``text``: it and the ``ORDER`` characters before it."""
    whole = F.concat(F.lit(EDGE * ORDER), F.col("text"), F.lit(END))
    return urls.withColumn("_whole", whole).select(
        *urls.columns,
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.char_length("_whole") - ORDER),
                lambda at: F.substr("_whole", at, F.lit(ORDER + 1)),
            )
        ).alias("gram"),
    )


def _suffix(gram: Column, order: int) -> Column:
    """The last character of a gram with ``order`` characters before it."""
    return F.substr(gram, F.lit(ORDER - order + 1), F.lit(order + 1))


def _chance(counts: list[tuple[Column, Column]]) -> Column:
    """The chance of a character from ``(seen, seen contexts)`` by rising order, each smoothed with the one before."""
    chance = F.lit(1.0 / ALPHABET)
    for seen, total in counts:
        chance = (seen + SMOOTHING * chance) / (total + SMOOTHING)
    return chance


def character_ratios(labelled: DataFrame, grams: DataFrame) -> DataFrame:
    """``gram, ratio, ratio_0, ratio_1``: log10 of the chance if accepted over that if rejected.

    ``labelled``: gram and its counts in accepted and rejected URLs of two folds,
    ``a0, r0, a1, r1``. ``ratio`` rests on all, ``ratio_0`` on those of fold 1
    alone and ``ratio_1`` on those of fold 0.
    """
    names = ["a0", "r0", "a1", "r1"]
    counted = labelled.select(
        F.explode(F.array(*(_suffix(F.col("gram"), k) for k in range(ORDER + 1)))).alias("part"), *names
    )
    parts = kept(counted.groupBy("part").agg(*(F.sum(n).alias(n) for n in names)))
    contexts = parts.groupBy(F.expr("substr(part, 1, char_length(part) - 1)").alias("context")).agg(
        *(F.sum(n).alias(n) for n in names)
    )
    out = grams.select("gram")
    for k in range(ORDER + 1):
        part, context = f"_p{k}", f"_c{k}"
        out = out.withColumn(part, _suffix(F.col("gram"), k))
        out = out.withColumn(context, F.expr(f"substr({part}, 1, {k})"))
        own = parts.select(F.col("part").alias(part), *(F.col(n).alias(f"{n}_{k}") for n in names))
        own_context = contexts.select(F.col("context").alias(context), *(F.col(n).alias(f"n{n}_{k}") for n in names))
        out = out.join(own, part, "left").join(own_context, context, "left")

    def ratio(folds: str) -> Column:
        def seen(prefix: str, side: str, k: int) -> Column:
            found = [F.coalesce(f"{prefix}{side}{fold}_{k}", F.lit(0)) for fold in folds]
            return found[0] if len(found) == 1 else found[0] + found[1]

        a, r = (_chance([(seen("", side, k), seen("n", side, k)) for k in range(ORDER + 1)]) for side in "ar")
        return F.log10(a) - F.log10(r)

    return out.select("gram", ratio("01").alias("ratio"), ratio("1").alias("ratio_0"), ratio("0").alias("ratio_1"))


def threshold(scored: DataFrame) -> float:
    """The limit that best tells accepted from rejected URLs: most correct in the two halves together.

    ``unseen`` scores, of models that did not learn from the URL, are counted in
    bins of fixed width between -5 and 5. Limits between two scores do equally
    well; the middle of the first best stretch is taken. Without URLs of both
    kinds the limit is below every score: nothing is rejected.
    """
    bins = (
        scored.filter("action IS NOT NULL")
        .groupBy(F.floor(F.greatest(F.least("unseen", F.lit(5.0)), F.lit(-5.0)) / BINS).alias("bin"))
        .agg(
            F.sum(F.when(F.col("action") == "allow", F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("action") == "block", F.col("n")).otherwise(0)).alias("r"),
        )
    )
    # At most 10 / BINS + 1 rows.
    in_order = Window.orderBy("bin")
    below = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rejected = F.coalesce(F.sum("r").over(below), F.lit(0)) / F.sum("r").over(whole)
    accepted = 1 - F.coalesce(F.sum("a").over(below), F.lit(0)) / F.sum("a").over(whole)
    kinds = F.least(F.sum("r").over(whole), F.sum("a").over(whole))
    best = (
        bins.select(
            "bin",
            F.coalesce(F.lag("bin").over(in_order) + 1, "bin").alias("from"),
            F.when(kinds > 0, F.round(F.try_add(rejected, accepted), 12)).alias("right"),
        )
        .filter("right IS NOT NULL")
        .orderBy(F.desc("right"), "bin")
        .first()
    )
    return -1e9 if best is None else (best["from"] + best["bin"]) / 2 * BINS


def text_scores(texts: DataFrame) -> DataFrame:
    """``text, action, n, score, unseen`` from rows of ``text`` and ``action``; equal ones are scored once, with weight n.

    ``score`` is the ratio per character by models that learned from all labelled
    texts, ``unseen`` that by models of the other half, dealt by hash of the text.
    """
    texts = kept(
        texts.groupBy("text", "action").agg(F.count("*").alias("n")).withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(2)))
    )

    def count(action: str, fold: int) -> Column:
        return F.sum(F.when((F.col("action") == action) & (F.col("fold") == fold), F.col("n")).otherwise(0))

    counted = kept(
        _grams(texts)
        .groupBy("gram")
        .agg(*(count(action, fold).alias(f"{action[0].replace('b', 'r')}{fold}") for fold in (0, 1) for action in ("allow", "block")))
    )
    ratios = character_ratios(counted.filter("a0 + r0 + a1 + r1 > 0"), counted)
    unseen = F.when(F.col("fold") == 0, F.col("ratio_0")).otherwise(F.col("ratio_1"))
    return kept(
        _grams(texts)
        .join(ratios, "gram")
        .groupBy("text", "action", "n")
        .agg(F.avg("ratio").alias("score"), F.avg(unseen).alias("unseen"))
    )


def judge_urls(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per row ``page_id, host, path, rule, verdict, score``.

    Null and malformed URLs have no host, no path and so no rule; the models
    judge them like others, by all they say. ``score`` is the ratio per character
    of the whole URL with scheme, query and fragment; it decides where no rule
    does. Repeated rows are judged alike; a null page_id stays null; extra columns
    are not read; no rows in, none out.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(
        F.col("page_id").cast("long"), F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path")
    )
    text, action = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("*", text.alias("rule"), action.alias("action"))
    scored = text_scores(ruled.select(F.col("url").alias("text"), "action"))
    limit = threshold(scored)
    # A text has one action, since equal URLs meet the same rules.
    own = scored.select(F.col("text").alias("_url"), F.round("score", 9).alias("score"))
    judged = ruled.join(own, F.col("url") == F.col("_url"), "left")
    by_models = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("action", by_models).alias("verdict"), "score")

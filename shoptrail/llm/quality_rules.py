"""Quality rules as weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Each rule votes 1 (good), -1 (bad) or 0 (abstains). Texts with the same votes are alike to the model, so
it is fitted on the counts of the vote patterns: at most 3 to the number of rules, however many
texts there are. Each round is one aggregation over these patterns. Texts that the base rules fail are
out whatever the votes, so the model is fitted on the others. A text is kept if no base rule fails it
and its posterior probability of being good is at least one half.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import stage

_SPACE = " \t\n\x0b\x0c\r"
#: Very common words of the languages covered; two different ones speak for running text.
COMMON_WORDS = "the of and to in is that for was on der die und das nicht von zu ist mit den le la les de et des en un une que el los las del por con se".split()
ROUNDS = 15
#: A word of letters or digits, with the marks that stand around it in running text.
PLAIN_WORD = r"^[(\[\"'«„“¿¡]*[\p{L}\p{N}]+(?:[-'’.][\p{L}\p{N}]+)*[.,;:!?)\]\"'»”…]*$"
#: Pseudo-counts of the votes for (-1, 0, 1), of good and of bad texts. A bad text seldom fails every rule, but
#: a good one hardly ever fails any: a vote against is presumed to say more than one in favour.
PRIOR = {"good": (0.2, 2.0, 7.8), "bad": (4.0, 2.0, 4.0)}
#: Pseudo-counts of good and bad texts.
SHARE = (8.0, 2.0)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0)).cast("byte")


def rules() -> dict[str, Column]:
    """The votes, from the columns that ``measure`` gives."""
    n, c = F.col("n_words"), F.col
    return {
        "length": _vote(n >= 80, n < 20),
        "symbols": _vote(50 * c("n_symbols") <= n, 10 * c("n_symbols") >= n),
        "plain_words": _vote(100 * c("n_plain") >= 96 * n, 100 * c("n_plain") < 75 * n),
        "repeats": _vote(100 * c("n_repeat_words") <= 10 * n, 100 * c("n_repeat_words") >= 30 * n),
        "again": _vote(100 * c("n_again") <= 2 * n, 100 * c("n_again") >= 20 * n),
        "lines": _vote((c("n_dup_lines") == 0) & (c("n_lines") >= 3), 100 * c("n_dup_lines") >= 30 * c("n_lines")),
        "word_length": _vote((c("word_chars") >= 3 * n) & (c("word_chars") <= 10 * n), (c("word_chars") < 2 * n) | (c("word_chars") > 14 * n)),
        "capitals": _vote(10 * c("n_capitals") <= c("word_chars"), 10 * c("n_capitals") >= 4 * c("word_chars")),
        "sentences": _vote((60 * c("n_stops") >= n) & (3 * c("n_stops") <= n), 2 * c("n_stops") >= n),
        "variety": _vote(100 * c("n_different") >= 40 * n, 100 * c("n_different") < 15 * n),
        "common_words": _vote(c("n_common") >= 2, (c("n_common") == 0) & (n >= 50)),
    }


def _without(text: str, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the measures of each text; null is a text without words.

    Words are runs of anything but ASCII white space. ``n_repeat_words`` counts the words in windows of
    three words that occur twice or more, the first time included: the windows' 64-bit hashes are sorted with
    their places, and of equal neighbours the places are added up, an overlap once.
    """
    trimmed = F.btrim(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(_SPACE))
    rows = docs.select(*keep, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"), F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x09-\x0d\x20]+")).alias("__words"))
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x09-\x0d\x20]"))
    rows = rows.select(
        *keep,
        "__words",
        lines.alias("__lines"),
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        _without("__text", r"[^#*$%&|<>]+").alias("n_symbols"),
        _without("__text", r"[^\p{Lu}]+").alias("n_capitals"),
        _without("__text", r"[^.!?]+").alias("n_stops"),
        F.size(F.array_distinct("__words")).cast("long").alias("n_different"),
        F.size(F.array_intersect(F.array(*map(F.lit, COMMON_WORDS)), "__words")).cast("long").alias("n_common"),
    )
    measures = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_stops", "n_different", "n_common"]
    window = F.transform(F.sequence(F.lit(0), F.size("__words") - 3), lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)))
    rows = rows.select(
        *keep,
        *measures,
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("__words", lambda x, i: (i > 0) & (x == F.get("__words", i - 1)))).cast("long").alias("n_again"),
        F.size(F.filter("__words", lambda x: x.rlike(PLAIN_WORD))).cast("long").alias("n_plain"),
        F.when(F.size("__words") >= 3, window).otherwise(F.array().cast("array<bigint>")).alias("__hashes"),
    )
    measures += ["n_lines", "n_dup_lines", "n_again", "n_plain"]
    placed = F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select(*keep, *measures, F.when(F.size(F.array_distinct("__hashes")) < F.size("__hashes"), placed).alias("__placed"))
    twice = F.filter(
        "__placed", lambda x, k: F.coalesce(x["h"] == F.get("__placed", k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get("__placed", k + 1)["h"], F.lit(False))
    )
    rows = rows.select(*keep, *measures, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("__starts"))
    covered = F.aggregate(
        "__starts",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
    )
    return rows.select(*keep, *measures, F.coalesce(covered["n"], F.lit(0).cast("long")).alias("n_repeat_words"))


def _plus(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def posterior(votes: dict[str, dict[str, tuple[float, ...]]], share: float) -> Column:
    """Probability of being good, from the rules' votes: ``votes[rule][kind]`` are the chances of (-1, 0, 1)."""
    odds = F.lit(log(share / (1 - share)))
    for rule, chances in votes.items():
        bad, none, good = (log(g / b) for g, b in zip(chances["good"], chances["bad"], strict=True))
        odds = odds + F.when(F.col(rule) == 1, good).when(F.col(rule) == -1, bad).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> tuple[dict, float]:
    """Expectation-maximisation on rows (votes, n): the rules' chances of each vote, and the share of good texts.

    It begins with the pseudo-counts, so a table without rows gives those, and ends when no
    chance moves by 0.002.
    """

    def chances(counts: dict[str, list[float]]) -> dict[str, tuple[float, ...]]:
        out = {}
        for kind, prior in PRIOR.items():
            numbers = [a + b for a, b in zip(counts[kind], prior, strict=True)]
            out[kind] = tuple(x / sum(numbers) for x in numbers)
        return out

    votes = {rule: chances({"good": [0] * 3, "bad": [0] * 3}) for rule in names}
    share = SHARE[0] / sum(SHARE)
    for _ in range(rounds):
        good = F.col("n") * F.col("q")
        sums = [F.sum(good).alias("all_good"), F.sum(F.col("n") - good).alias("all_bad")]
        for rule in names:
            for vote in (-1, 1):
                holds = F.col(rule) == vote
                sums += [F.sum(F.when(holds, good)).alias(f"{rule} {vote} good"), F.sum(F.when(holds, F.col("n") - good)).alias(f"{rule} {vote} bad")]
        got = {k: v or 0.0 for k, v in patterns.withColumn("q", posterior(votes, share)).agg(*sums).first().asDict().items()}
        new = {}
        for rule in names:
            against, favour = ({kind: got[f"{rule} {v} {kind}"] for kind in PRIOR} for v in (-1, 1))
            new[rule] = chances({kind: [against[kind], max(0.0, got[f"all_{kind}"] - against[kind] - favour[kind]), favour[kind]] for kind in PRIOR})
        moved = max(abs(a - b) for rule in names for kind in PRIOR for a, b in zip(new[rule][kind], votes[rule][kind], strict=True))
        votes, share = new, (got["all_good"] + SHARE[0]) / (got["all_good"] + got["all_bad"] + sum(SHARE))
        if moved < 0.002:
            break
    return votes, share


def judge(docs: DataFrame, keep: list[str], text: str = "text", least: float = 0.5) -> DataFrame:
    """``keep``, the base measures, base_failed, quality (the posterior) and kept for each row of ``docs``.

    base_failed: fewer than 50 words, or more than half of the words in repeated windows. Repeated rows are
    judged each, and count each in the fit. An empty table gives an empty result.
    """
    named = rules()
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = stage(measure(docs, keep, text).withColumns(named | {"base_failed": failed}), "quality-rules")
    names = list(named)
    patterns = stage(measured.where(~F.col("base_failed")).groupBy(*names).agg(F.count("*").cast("double").alias("n")), "vote-patterns")
    votes, share = fit(patterns, names)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return measured.select(*keep, *base, "base_failed", posterior(votes, share).alias("quality")).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))

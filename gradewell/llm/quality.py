"""Quality rules by weak supervision, in DataFrame operations.

Each rule votes good, votes bad or abstains. Documents are counted by their votes, which leaves at most 3 ** rules
rows at any corpus size, and expectation-maximisation over them estimates how often each rule is right and how
common good documents are. A document stays when its posterior probability of being good reaches a half
and it fails none of the two base limits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from gradewell.llm.common import staged

_SPACE = r"[\x20\x09-\x0D]"
#: Some of the commonest words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "and", "of", "to", "in", "is", "that", "for", "der", "die", "und", "das", "ein", "mit", "nicht", "zu",
    "le", "la", "les", "de", "un", "et", "que", "pour", "el", "los", "en", "y", "por", "con", "una", "se",
)


@dataclass(frozen=True)
class Rule:
    """Votes bad where `bad` holds, else good where `good` does, else abstains; SQL over the columns of features()."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 50", "n_words >= 100"),
    Rule("repetition", "n_repeat_words * 100 > 30 * n_words", "n_repeat_words * 100 <= 20 * n_words AND n_words >= 20"),
    Rule("symbols", "n_symbols * 100 > 10 * n_words", "n_symbols * 100 <= 1 * n_words"),
    Rule("markup", "n_symbols * 100 > 20 * n_words", "n_symbols * 100 <= 5 * n_words"),
    Rule("lines", "n_dup_lines * 100 > 30 * n_lines", "n_dup_lines * 100 <= 10 * n_lines AND n_lines >= 2"),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 12 * n_words", "word_chars BETWEEN 4 * n_words AND 10 * n_words"),
    Rule("sentences", "n_stops * 50 < n_words", "n_stops * 25 >= n_words"),
    Rule("capitals", "n_capitals * 100 > 40 * word_chars", "n_capitals * 100 <= 15 * word_chars"),
    Rule("stop_words", "n_stop_words < 2", "n_stop_words >= 4"),
)


@dataclass(frozen=True)
class Voting:
    """A rule's accuracy on good documents is how often its votes on them are good, on bad ones how often bad."""

    rules: tuple[Rule, ...] = RULES
    #: Where EM starts, and the bounds of the accuracies: a rule may miss most bad documents, but errs seldom on good ones.
    prior: float = 0.7
    on_good: float = 0.97
    on_bad: float = 0.25
    least_on_good: float = 0.8
    least_on_bad: float = 0.21
    most: float = 0.995
    #: Votes added to each rule's counts, as many right ones as the start says.
    smoothing: float = 10.0
    rounds: int = 50
    tolerance: float = 1e-4


@dataclass(frozen=True)
class Estimate:
    prior: float
    on_good: dict[str, float] = field(default_factory=dict)
    on_bad: dict[str, float] = field(default_factory=dict)


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"{_SPACE}+"))


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stops, n_capitals and
    n_stop_words of the whole texts; columns of these names are replaced."""
    made = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stops", "n_capitals",
        "n_stop_words",
    ]
    kept = [c for c in docs.columns if c not in made]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # A projection for each step, so that no array is made twice.
    words = docs.select(F.struct(*kept).alias("row"), text.alias("text"), _words(text).alias("words"))
    n = F.size("words")
    three = F.transform(
        F.slice(F.arrays_zip(
            F.col("words").alias("a"), F.slice("words", 2, F.greatest(n, F.lit(1))).alias("b"),
            F.slice("words", 3, F.greatest(n, F.lit(1))).alias("c"),
        ), 1, F.greatest(n - 2, F.lit(0))),
        lambda w: F.xxhash64(w["a"], w["b"], w["c"]),
    )
    windows = words.select("row", "text", "words", three.alias("windows"))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    places = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_windows = windows.select(
        "row", "text", "words",
        F.when(repeats, places).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("places"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    twins = F.zip_with(
        "places", F.slice("places", 2, F.greatest(F.size("places"), F.lit(1))),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])),
    )
    starts = F.flatten(F.filter(twins, lambda x: x.isNotNull()))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2))))
    stop_words = F.array(*map(F.lit, STOP_WORDS))
    return sorted_windows.select(
        "row.*", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("text", F.lit(r"[.!?]")).cast("long").alias("n_stops"),
        F.regexp_count("text", F.lit(r"[A-Z]")).cast("long").alias("n_capitals"),
        F.size(F.array_intersect(stop_words, F.col("words"))).cast("long").alias("n_stop_words"),
    )


def votes(rules: tuple[Rule, ...]) -> list[Column]:
    return [
        F.when(F.expr(r.bad), -1).when(F.expr(r.good), 1).otherwise(0).cast("byte").alias(f"vote_{r.name}") for r in rules
    ]


def _odds(p: Voting, now: Estimate) -> Column:
    """Log odds of a good document, given its votes; an abstention says nothing."""
    odds = F.lit(math.log(now.prior / (1 - now.prior)))
    for r in p.rules:
        good, bad = now.on_good[r.name], now.on_bad[r.name]
        vote = F.col(f"vote_{r.name}")
        odds = odds + F.when(vote == 1, math.log(good / (1 - bad))).when(vote == -1, math.log((1 - good) / bad)).otherwise(0.0)
    return odds


def posterior(p: Voting, now: Estimate) -> Column:
    return 1 / (1 + F.exp(-_odds(p, now)))


def estimate(patterns: DataFrame, p: Voting) -> Estimate:
    """Expectation-maximisation over (vote columns, n), a row for each combination of votes."""
    names = [r.name for r in p.rules]
    now = Estimate(p.prior, dict.fromkeys(names, p.on_good), dict.fromkeys(names, p.on_bad))
    q, n = F.col("q"), F.col("n")
    sums = [F.sum(n * q), F.sum(n)]
    for name in names:
        vote = F.col(f"vote_{name}")
        sums += [F.sum(F.when(vote == v, n * w).otherwise(0.0)) for v, w in ((1, q), (-1, q), (1, 1 - q), (-1, 1 - q))]
    for _ in range(p.rounds):
        good, total, *cast = patterns.withColumn("q", posterior(p, now)).agg(*sums).first()
        if not total:
            break
        held = lambda right, wrong, start, least: min(
            p.most, max(least, (right + p.smoothing * start) / (right + wrong + p.smoothing))
        )
        by_rule = list(zip(names, cast[::4], cast[1::4], cast[2::4], cast[3::4]))
        new = Estimate(
            min(0.99, max(0.01, (good + p.smoothing * p.prior) / (total + p.smoothing))),
            {name: held(up, down, p.on_good, p.least_on_good) for name, up, down, _, _ in by_rule},
            {name: held(down, up, p.on_bad, p.least_on_bad) for name, _, _, up, down in by_rule},
        )
        moved = [abs(now.prior - new.prior)]
        moved += [abs(a[k] - b[k]) for a, b in ((now.on_good, new.on_good), (now.on_bad, new.on_bad)) for k in names]
        now = new
        if max(moved) < p.tolerance:
            break
    return now


def vote_quality(docs: DataFrame, p: Voting = Voting(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, the features, a vote per rule, posterior, base_failed and kept.

    A null or empty text has no words, so it fails the base limits and goes. Every row is judged by itself, with a null or
    repeated id too, and counts once for the estimates. Other columns are not read. An empty table gives an
    empty one. The texts are read once, without a shuffle; what is aggregated is one row per combination of votes.
    """
    measured = features(docs.select(F.col(id_col), F.col(text_col)), text_col).drop(text_col)
    measured = staged(measured.select("*", *votes(p.rules)), "features")
    cast = [f"vote_{r.name}" for r in p.rules]
    patterns = staged(measured.groupBy(*cast).agg(F.count("*").alias("n")), "patterns")
    now = estimate(patterns, p)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = measured.withColumn("posterior", posterior(p, now)).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))

"""Document quality by weak supervision.

Rules vote good, vote bad or abstain. Expectation-maximisation over the table of
vote patterns estimates how often each rule casts each vote on good and on bad
documents; the posterior probability of being good decides. There are at most
3^rules patterns whatever the number of documents. Only DataFrame functions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.llm.common import WORD, sheltered, stage

#: The fixed base rule.
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW_WORDS = 8
STRETCH_WORDS = 100
SPACE = "\x20\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_POSTERIOR = 0.5
VOTES = (1, 0, -1)
#: Documents' worth of belief in each rule before any is seen, by vote: right, abstaining, wrong.
BELIEF = (4.0, 1.0, 1.0)
#: The fit ends when no expected count moves by more than this part of the documents.
STILL = 1e-6
MOST_ROUNDS = 1000

#: Name, good vote, bad vote; a document for which neither holds is abstained on. The limits
#: are close, so that a rule is wrong at times; how often, the fit finds out.
RULES: list[tuple[str, str, str]] = [
    ("symbols", "n_symbols = 0", "n_symbols > 0.02 * n_words"),
    ("plain", "n_plain >= 0.95 * n_words", "n_plain < 0.85 * n_words"),
    ("lettered", "n_lettered >= 0.99 * n_words", "n_lettered < 0.93 * n_words"),
    ("word_length", "word_chars between 4 * n_words and 7 * n_words", "word_chars < 3.5 * n_words or word_chars > 8 * n_words"),
    ("endings", "n_ended >= 0.8 * n_lines", "n_ended < 0.5 * n_lines"),
    ("lines", "n_dup_lines = 0", "n_dup_lines > 0.1 * n_lines"),
    ("repeats", "n_repeat_words <= 0.1 * n_words", "n_repeat_words > 0.25 * n_words"),
    ("variety", "n_fresh >= 0.5 * n_words", "n_fresh < 0.3 * n_words"),
    ("length", "n_words >= 50", "n_words < 30"),
]


def base_features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and counts of each text; a null text has none of anything.

    Words are runs of other than ASCII white space. Windows of eight words are
    compared by hash first, and exactly in texts where hashes repeat.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = sheltered(docs).select(F.col("row.doc_id").alias("doc_id"), text.alias("text"))
    blank = F.translate("text", SPACE, "")
    rows = rows.withColumns({
        "words": F.regexp_extract_all("text", F.lit(WORD), 0),
        "word_chars": F.length(blank).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
        "lines": F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0),
    })
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        # Different words within each stretch, added up: alike for texts of any length.
        "n_fresh": F.aggregate(
            F.sequence(F.lit(0), F.floor((F.size("words") - 1) / STRETCH_WORDS).cast("int")), F.lit(0).cast("long"),
            lambda total, i: total + F.size(F.array_distinct(F.slice("words", i * STRETCH_WORDS + 1, STRETCH_WORDS))),
        ),
        "n_ended": F.size(F.filter("lines", lambda x: x.rlike(r"[.!?…:;\"”’»)][\x20\x09-\x0D]*$"))).cast("long"),
        "n_plain": F.size(F.filter("words", lambda w: w.rlike(r"^[\"'“«(]*[\p{L}\p{M}'’-]+[.,;:!?…\"'”»)]*$"))).cast("long"),
        "n_lettered": F.size(F.filter("words", lambda w: w.rlike(r"\p{L}"))).cast("long"),
        "windows": F.when(
            F.size("words") > WINDOW_WORDS,
            F.transform(F.sequence(F.lit(1), F.size("words") - WINDOW_WORDS + 1), lambda i: F.xxhash64(F.slice("words", i, WINDOW_WORDS))),
        ),
    })
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_fresh", "n_lettered", "n_plain", "n_ended"]
    rows = rows.select("doc_id", *counts, "words", F.coalesce(F.size(F.array_distinct("windows")) < F.size("windows"), F.lit(False)).alias("again"))
    spelled = F.transform(
        F.sequence(F.lit(1), F.size("words") - WINDOW_WORDS + 1),
        lambda i: F.struct(F.array_join(F.slice("words", i, WINDOW_WORDS), " ").alias("w"), i.alias("i")),
    )
    rows = rows.withColumn("sorted", F.when(F.col("again"), F.sort_array(spelled)))
    # Equal windows stand side by side; each that has an equal neighbour is found twice or more.
    held = F.transform(
        "sorted",
        lambda x, k: F.when(
            (x["w"] == F.get("sorted", k - 1)["w"]) | (x["w"] == F.get("sorted", k + 1)["w"]), x["i"]
        ),
    )
    rows = rows.withColumn("starts", F.sort_array(F.array_compact(held)))
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(
            (i + WINDOW_WORDS).alias("end"), (s["n"] + F.lit(WINDOW_WORDS) - F.greatest(s["end"] - i, F.lit(0))).alias("n")
        ),
        lambda s: s["n"],
    )
    return rows.select("doc_id", *counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def votes(features: DataFrame) -> DataFrame:
    """Adds one column ``vote_<rule>`` for each rule: 1 good, -1 bad, 0 abstains."""
    return features.withColumns({
        f"vote_{name}": F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for name, good, bad in RULES
    })


#: A rule's vote rates by class: ``rates["good"][vote]``.
Rates = dict[str, dict[int, float]]


def _posterior(share: float, rates: dict[str, Rates]) -> Column:
    """Probability of good given the votes of the rules that ``rates`` names."""

    def log_odds(name: str, rate: Rates) -> Column:
        told = {v: F.lit(math.log(rate["good"][v]) - math.log(rate["bad"][v])) for v in VOTES}
        return F.when(F.col(name) == 1, told[1]).when(F.col(name) == -1, told[-1]).otherwise(told[0])

    odds = F.lit(math.log(share) - math.log(1 - share))
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, [log_odds(n, r) for n, r in rates.items()], odds)))


def fit_votes(patterns: DataFrame, names: list[str]) -> tuple[float, dict[str, Rates]]:
    """Share of good documents, and how often each rule casts each vote on good and on bad ones.

    ``patterns`` counts the documents ``n`` of each combination of votes. The
    start is each combination's majority; no rule is held to be right, and
    one that is wrong often is outweighed. Abstaining is a vote with rates of its
    own. Each round brings back three pairs of sums for each rule. Of the two
    classes the good one is that with more good votes for bad ones. Without documents
    the belief alone stays.
    """
    one_of = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("vote")) for n in names]
    cast = [reduce(lambda a, b: a + b, [(F.col(n) == v).cast("int") for n in names]) for v in (1, -1)]
    p, before, share, rates = (cast[0] + 1) / (cast[0] + cast[1] + 2), None, 0.5, {}
    for _ in range(MOST_ROUNDS):
        each = patterns.select("n", (F.col("n") * p).alias("good"), F.inline(F.array(*one_of)))
        sums = each.groupBy("rule", "vote").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
        found = {(r.rule, r.vote): (r.good, r.n - r.good) for r in sums.collect()}
        told = {n: [found.get((n, v), (0.0, 0.0)) for v in VOTES] for n in names}
        n_good, n_bad = (sum(pair[y] for pair in told[names[0]]) for y in (0, 1))
        share = (n_good + 1) / (n_good + n_bad + 2)
        rates = {
            n: {
                "good": {v: (pair[0] + more) / (n_good + sum(BELIEF)) for v, pair, more in zip(VOTES, pairs, BELIEF)},
                "bad": {v: (pair[1] + more) / (n_bad + sum(BELIEF)) for v, pair, more in zip(VOTES, pairs, BELIEF[::-1])},
            }
            for n, pairs in told.items()
        }
        now = [pair[0] for pairs in told.values() for pair in pairs]
        if before and max(abs(a - b) for a, b in zip(now, before)) <= STILL * (n_good + n_bad):
            break
        p, before = _posterior(share, rates), now
    lean = {y: sum(r[y][1] - r[y][-1] for r in rates.values()) for y in ("good", "bad")}
    if lean["good"] < lean["bad"]:
        return 1 - share, {n: {"good": r["bad"], "bad": r["good"]} for n, r in rates.items()}
    return share, rates


def posterior_quality(voted: DataFrame) -> DataFrame:
    """Adds ``posterior`` to rows with a column ``vote_<rule>`` for each rule. An empty table gives none."""
    names = [c for c in voted.columns if c.startswith("vote_")]
    patterns = stage(voted.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    return voted.withColumn("posterior", _posterior(*fit_votes(patterns, names)))


def judge(docs: DataFrame, least_posterior: float = LEAST_POSTERIOR) -> DataFrame:
    """``doc_id``, all counts, the votes, ``base_failed``, ``posterior``, ``kept``: one row per document.

    Documents that fail the base rule are not kept, whatever the votes. Rows
    that repeat are judged each; an empty table gives no row.
    """
    counted = base_features(docs)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    voted = stage(votes(counted.withColumn("base_failed", failed)), "voted")
    told = posterior_quality(voted)
    return told.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least_posterior))

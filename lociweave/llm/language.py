"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent letter n-grams. A
document's own list is compared with each profile by the out-of-place
distance: how far each n-gram stands from its place in the profile, and the
greatest distance where the profile lacks it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociweave.llm.common import fold, sheltered, stage

TOP = 300
MAX_N = 3
#: A text is in no learned language if it fits its best profile worse than this share of what all but
#: ``LOW`` of the learned rows of the language and of about its length reach.
LOW, SHARE = 0.002, 0.6
#: Scores are told apart by this many steps where their low quantiles are taken, which bounds what a class gathers.
STEPS = 1 << 16
#: Lengths are told apart by powers of two between these, in characters.
SHORTEST, LONGEST = 6, 14
UNKNOWN = "und"
_PART = 1 << 20

#: Lower-case code of each letter, zero for what is no letter; letters past the table count by their code.
_CODES = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in range(0x10000)], np.uint32)


def _letters(text: str) -> np.ndarray:
    """Letters as codes, everything else as single zeros, a zero at either end."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _CODES[np.minimum(raw, 0xFFFF)]
    high = np.flatnonzero(raw > 0xFFFF)
    if len(high):
        codes[high] = [ord(c.lower()[0]) if (c := chr(x)).isalpha() else 0 for x in raw[high]]
    return codes


def _gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """n-grams (1 to 3 letters within a word, its borders as one letter) as numbers, and their counts."""
    grams, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(text), _PART):
        # Parts overlap by two letters and count only n-grams that end in their own range.
        codes = _letters(text[max(0, at - 2):at + _PART]).astype(np.int64)
        own = min(2, at)
        codes = np.concatenate((np.zeros(2 - own, np.int64), codes, np.zeros(int(at + _PART >= len(text)), np.int64)))
        c, b, a = codes[2:], codes[1:-1], codes[:-2]
        edge = 1
        a1, b1, c1 = (np.where(x == 0, edge, x) for x in (a, b, c))
        one = c[c > 0]
        two = ((b1 << 21) | c1)[(b > 0) | (c > 0)]
        three = ((a1 << 42) | (b1 << 21) | c1)[b > 0]
        found, n = np.unique(np.concatenate((one, two, three)), return_counts=True)
        if len(grams):
            both, inverse = np.unique(np.concatenate((grams, found)), return_inverse=True)
            grams, counts = both, np.bincount(inverse, np.concatenate((counts, n))).astype(np.int64)
        else:
            grams, counts = found, n
    return grams, counts


def _top(grams: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """Most frequent n-grams in order; ties by number."""
    if len(grams) > 4 * top:
        least = np.partition(counts, -top)[-top]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))[:top]]


def learning_rows(docs: DataFrame) -> DataFrame:
    """``lang, text`` of every row that teaches: null languages and null texts teach nothing.

    ``docs`` has ``doc_id, text, lang``.
    """
    return sheltered(docs).select("row.lang", "row.text").filter("lang is not null and text is not null")


def learn_profiles(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, gram, place``: each language's ``top`` n-grams, from all :func:`learning_rows`."""
    return _profiles(learning_rows(docs), top)


def _profiles(chosen: DataFrame, top: int) -> DataFrame:
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, own in batch.groupby("lang"):
                parts = [_gram_counts(t) for t in own["text"]]
                if parts:
                    grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                    n = np.bincount(inverse, np.concatenate([c for _, c in parts]), len(grams))
                    yield pd.DataFrame({"lang": lang, "gram": grams, "n": n.astype("int64")})

    sums = chosen.mapInPandas(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = sums.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1)
    return ranked.filter(F.col("place") < top).select("lang", "gram", "place")


def identify(docs: DataFrame, profiles: DataFrame, top: int = TOP) -> DataFrame:
    """``row`` (all columns of ``docs``), ``lang_pred``, ``score``.

    ``score`` is one less the share of the greatest possible distance, and 0
    for ``und``: a null text, one without a letter, or no profile at all. Ties
    go to the first language by name. Whole texts are read.
    """
    table: dict[str, list[tuple[int, int]]] = {}
    # At most ``top`` rows for each language.
    for lang, gram, place in profiles.collect():
        table.setdefault(lang, []).append((gram, place))
    langs = sorted(table)
    grams = np.unique(np.array([g for own in table.values() for g, _ in own], np.int64))
    places = np.full((len(langs), len(grams) + 1), -1, np.int64)
    for i, lang in enumerate(langs):
        for gram, place in table[lang]:
            places[i, np.searchsorted(grams, gram)] = place

    def best(text: str | None) -> tuple[str, float]:
        if not text or not langs:
            return UNKNOWN, 0.0
        own = _top(*_gram_counts(text), top)
        if not len(own):
            return UNKNOWN, 0.0
        at = np.searchsorted(grams, own)
        hit = (at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == own)
        where = places[:, np.where(hit, at, len(grams))]
        apart = np.where(where < 0, top, np.abs(where - np.arange(len(own)))).sum(axis=1)
        i = int(np.argmin(apart))
        return langs[i], float(1 - apart[i] / (top * len(own)))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([best(t) for t in texts], columns=["lang_pred", "score"])

    told = sheltered(docs).withColumn("told", predict("row.text"))
    return told.select("row", "told.lang_pred", "told.score")


def labelled_fold(docs: DataFrame) -> DataFrame:
    """Rows whose language may be learned from: fold of 4 other than 2."""
    return docs.filter(fold(F.col("doc_id"), 4) != 2)


def _length_class(text: str) -> Column:
    return F.least(F.lit(LONGEST), F.greatest(F.lit(SHORTEST), F.floor(F.log2(F.greatest(F.length(text), F.lit(1)))))).cast("int")


def least_scores(chosen: DataFrame, profiles: DataFrame) -> DataFrame:
    """``lang, length_class, least``: the score that a text of a language and length must reach, for every class of every language.

    ``chosen`` has ``lang, text``. A class takes the lowest of its own learned
    rows and of the classes beside it; one without rows near takes the lowest of the language.
    """
    told = identify(chosen, profiles)
    return _least_scores(told.select(F.col("row.lang").alias("lang"), "lang_pred", _length_class("row.text").alias("length_class"), "score"))


def _least_scores(told: DataFrame) -> DataFrame:
    """:func:`least_scores` of learned rows told before: ``lang, lang_pred, length_class, score``."""
    steps = told.filter("lang_pred = lang").groupBy("lang", "length_class", F.floor(F.col("score") * STEPS).alias("step"))
    # Counted per step map-side, so a class gathers its steps and not its rows.
    low = steps.agg(F.count("*").alias("n")).groupBy("lang", "length_class").agg(
        (F.percentile("step", F.lit(LOW), F.col("n")) / STEPS).alias("low")
    )
    # A few rows for each language.
    near = low.select("lang", "low", F.explode(F.array(*[F.col("length_class") + d for d in (-1, 0, 1)])).alias("length_class"))
    near = near.groupBy("lang", "length_class").agg(F.min("low").alias("low"))
    every = low.groupBy("lang").agg(F.min("low").alias("lowest")).withColumn(
        "length_class", F.explode(F.sequence(F.lit(SHORTEST), F.lit(LONGEST)))
    )
    return every.join(near, ["lang", "length_class"], "left").select(
        "lang", "length_class", (SHARE * F.coalesce("low", "lowest")).alias("least")
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents in a learned language, all columns kept.

    Texts without letters go, and those that fit no profile as its learned
    rows of their length do: other languages in the same letters, and
    gibberish. Of texts of a few words it cannot be told, and they stay.
    """
    profiles = stage(learn_profiles(labelled_fold(docs)), "profiles")
    # Told once, and written: limits and verdicts both come from it.
    told = stage(identify(docs, profiles).withColumn("its_class", _length_class("row.text")), "told")
    learned = told.filter(fold(F.col("row.doc_id"), 4) != 2).filter("row.lang is not null and row.text is not null")
    least = stage(
        _least_scores(learned.select("row.lang", "lang_pred", F.col("its_class").alias("length_class"), "score")), "least"
    )
    good = (F.col("lang_pred") == F.col("lang")) & (F.col("its_class") == F.col("length_class")) & (F.col("score") >= F.col("least"))
    return told.filter(F.col("lang_pred") != UNKNOWN).join(least, good, "left_semi").select("row.*")

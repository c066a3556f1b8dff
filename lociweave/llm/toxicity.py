"""Toxic passages by maximum-scoring segments.

Tokens carry the log-odds of standing in toxic rather than in clean text,
with a Dirichlet prior: a word's prior is what its longest known prefix tells,
and a prefix's prior the next shorter one, so rare and unseen forms of a stem
are scored too. Every other token costs a small constant, hence segments of
clean text don't grow. One linear scan finds all maximal scoring segments of a
text. Their scores follow an extreme-value law, whose scale is solved from the
scores of clean rows and whose level is fitted to them; the tail probability
of a text's best set of segments gives its score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.llm.common import fold, sheltered, stage

#: Rows learned from, for each class at most: the bound of everything that is collected or broadcast here.
LEARN_ROWS = 8192
#: Weight of the prior, in documents.
PRIOR = 2.0
#: Cost of a token that is no sign of toxicity, in nats.
DRIFT = 0.1
PREFIXES = range(3, 9)
#: A text is called toxic from this score on.
LIMIT = 0.7
#: Tail probability that this score stands for where no labelled rows tell.
CUT = 0.004
#: What makes a unit a sign: its log-odds, and the evidence that it is not chance.
LEAST_ODDS = 1.0
LEAST_GAIN = 8.0
_KNOWN = 200_000
_WORD = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    words: dict[str, float]
    stems: dict[str, float]
    scale: float
    level: float
    cut: float


def tokens(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall(text.lower()) if text else []


def maximal_segments(scores: np.ndarray, drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, end, score)`` of token scores, where 0 stands for a cost of ``drift``.

    Candidates are kept with their running sums at either end; each new
    positive token is merged leftwards for as long as that makes a higher
    segment. Only positive tokens are visited.
    """
    at = np.flatnonzero(scores)
    if not len(at):
        return []
    running = np.cumsum(scores[at]) - drift * (at - np.arange(len(at)))
    # Candidates: first token, end, sum before, sum after, and the last candidate with a smaller sum before.
    firsts, ends, before, after, link = [], [], [], [], []
    for i, token in enumerate(at.tolist()):
        first, end, high = token, token + 1, float(running[i])
        low = high - float(scores[token])
        while True:
            j = len(firsts) - 1
            while j >= 0 and before[j] >= low:
                j = link[j]
            if j < 0 or after[j] >= high:
                break
            first, low = firsts[j], before[j]
            del firsts[j:], ends[j:], before[j:], after[j:], link[j:]
        firsts.append(first), ends.append(end), before.append(low), after.append(high), link.append(j)
    return [(f, e, a - b) for f, e, b, a in zip(firsts, ends, before, after)]


class _Scorer:
    """Token scores of texts; remembers words it has met."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.known = dict(words)

    def _of(self, word: str) -> float:
        stem = _stem_of(word, self.stems)
        return self.stems[stem] if stem else 0.0

    def __call__(self, words: list[str]) -> np.ndarray:
        scores = list(map(self.known.get, words))
        if None in scores:
            if len(self.known) > _KNOWN + len(self.words):
                self.known = dict(self.words)
            for i, s in enumerate(scores):
                if s is None:
                    word = words[i]
                    s = self.known.get(word)
                    scores[i] = self.known[word] = self._of(word) if s is None else s
        return np.array(scores, float)


def _log_odds(units: list[tuple[str, bool, int, int]], ratio: float) -> tuple[dict[str, float], dict[str, float]]:
    """Scores of words and of prefixes from ``(unit, is a word, toxic, clean)`` document counts.

    Prefixes come first, shorter before longer, then words, so that each finds its prior.
    """
    # The share of toxic and that of clean documents, each for itself: one of them may be tiny beside the other.
    shares: dict[str, tuple[float, float]] = {}
    words, stems = {}, {}

    def prior(unit: str, longest: int) -> tuple[float, float]:
        for n in range(min(longest, PREFIXES[-1]), PREFIXES[0] - 1, -1):
            if (own := shares.get(unit[:n])) is not None:
                return own
        return 0.5, 0.5

    for unit, is_word, toxic, clean in sorted(units, key=lambda u: (u[1], len(u[0]), u[0])):
        bad, good = prior(unit, len(unit) if is_word else len(unit) - 1)
        bad, good = toxic + PRIOR * bad, clean * ratio + PRIOR * good
        odds = math.log(bad) - math.log(good)
        if is_word:
            words[unit] = odds if odds >= LEAST_ODDS else 0.0
        elif odds >= LEAST_ODDS:
            shares[unit], stems[unit] = (bad / (bad + good), good / (bad + good)), odds
    return words, stems


def _stem_of(word: str, stems) -> str | None:
    for n in reversed(PREFIXES):
        if len(word) >= n and word[:n] in stems:
            return word[:n]
    return None


def _tail(segments: list[float], n: int, scale: float, level: float) -> float:
    """Tail probability of the best set of segments: Poisson for one, the sum statistic for several."""
    best, total = 1.0, 0.0
    base = math.log(max(level * n, 1e-300))
    for r, s in enumerate(sorted(segments, reverse=True), 1):
        total += scale * s - base
        if r == 1:
            p = -math.expm1(-math.exp(min(-total, 50.0)))
        elif total > r:
            p = r * math.exp(-total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r))
        else:
            break
        best = min(best, p)
    return best


def _best_cut(tails: list[tuple[float, int]]) -> float:
    """The tail probability that parts toxic from clean rows best, three quarters of the way to the next one in logarithms."""
    n_bad = sum(t for _, t in tails)
    n_good = len(tails) - n_bad
    if not n_bad or not n_good:
        return CUT
    tails = sorted(tails)
    best, cut, gain = 0.0, CUT, 0.0
    for (p, toxic), (q, _) in zip(tails, [*tails[1:], (1.0, 0)]):
        gain += 1 / n_bad if toxic else -1 / n_good
        if q > p and gain > best:
            best, cut = gain, max(p, 1e-30) ** 0.25 * q ** 0.75
    return min(cut, 0.05)


def _solved_scale(counts: Counter, total: int) -> float:
    """The positive ``x`` with mean of exp(x score) 1 over clean tokens; one more token of each kind smooths it."""
    kinds = [(s, n) for s, n in counts.items() if s > 0] or [(2.0, 0)]
    n_all = total + 1

    def excess(x: float) -> float:
        positive = sum(n * math.exp(x * s) for s, n in kinds) + math.exp(x * max(s for s, _ in kinds))
        rest = n_all - sum(n for _, n in kinds)
        return (positive + rest * math.exp(-x * DRIFT)) / (n_all + 1) - 1

    low, high = 1e-3, 5.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def learn(docs: DataFrame, labels: DataFrame, learn_rows: int = LEARN_ROWS) -> Model:
    """Fits lexicon and calibration to at most ``learn_rows`` labelled rows of each class.

    ``docs`` has ``doc_id, text``, ``labels`` ``doc_id, toxic``. Of labels that
    disagree on an id the toxic one holds; null labels don't count. Half of the
    rows, by a hash of the id, give the lexicon and the clean ones of the other
    half the calibration. Without rows the model scores everything alike.
    """
    one = sheltered(labels).select("row.doc_id", F.col("row.toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    one = one.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.lit("learn"), "doc_id")
    some = [one.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(learn_rows) for c in (0, 1)]
    chosen = stage(some[0].union(some[1]), "labelled").withColumnRenamed("doc_id", "its_id")
    given = sheltered(docs).select("row.doc_id", "row.text").filter("text is not null")
    # Two times ``learn_rows`` rows of 12 bytes at most.
    some = given.join(F.broadcast(chosen), F.col("doc_id") == F.col("its_id"))
    # Copies would count as evidence many times: of rows with one smallest shingle hash and label, one teaches.
    some = some.withColumn("words", F.split(F.lower("text"), r"\s+"))
    sketch = F.array_min(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - 2, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, 3))
    ))
    some = some.groupBy("toxic", sketch.alias("sketch")).agg(F.min_by("text", F.xxhash64("doc_id", "text")).alias("text"))
    rows = stage(some.select("text", "toxic", (F.pmod(F.xxhash64("sketch"), F.lit(3)) > 0).alias("first")), "taught")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both: tuple[Counter, Counter] = Counter(), Counter()
            for text, toxic, first in zip(batch["text"], batch["toxic"], batch["first"]):
                if first:
                    words = set(tokens(text))
                    both[toxic].update((w, True) for w in words)
                    both[toxic].update((p, False) for p in {w[:n] for w in words for n in PREFIXES if len(w) >= n})
                    both[toxic][("", False)] += 1
            units = list(both[0].keys() | both[1].keys())
            yield pd.DataFrame({
                "unit": [u for u, _ in units], "is_word": [w for _, w in units],
                "bad": [both[1][u] for u in units], "good": [both[0][u] for u in units],
            })

    sums = rows.mapInPandas(counted, "unit string, is_word boolean, bad long, good long").groupBy("unit", "is_word")
    sums = stage(sums.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "units")
    totals = sums.filter("unit = ''").select("bad", "good").first()
    n_bad, n_good = (totals[0], totals[1]) if totals else (0, 0)
    ratio = n_bad / max(1, n_good)
    # The likelihood ratio of a unit's own share of toxic documents against the common one.
    n, even = F.col("bad") + F.col("good"), ratio / (1 + ratio)
    gain = F.col("bad") * F.log(F.col("bad") / (n * max(even, 1e-12))) + F.when(
        F.col("good") > 0, F.col("good") * F.log(F.col("good") / (n * (1 - even)))
    ).otherwise(0.0)
    signs = sums.filter((F.col("unit") != "") & (F.col("bad") >= 2) & (F.col("bad") > n * even) & (gain >= LEAST_GAIN))
    # Bounded by the text of ``learn_rows`` toxic documents, as are the words of their stems.
    units = [tuple(r) for r in signs.select("unit", "is_word", "bad", "good").collect()]
    stems = _log_odds([u for u in units if not u[1]], ratio)[1]

    def stemmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[_stem_of(w, stems) is not None for w in batch["unit"]]]

    forms = sums.filter("is_word").select("unit", "is_word", "bad", "good").mapInPandas(stemmed, "unit string, is_word boolean, bad long, good long")
    words, stems = _log_odds(list({*units, *map(tuple, forms.collect())}), ratio)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = _Scorer(words, stems)
        for batch in batches:
            out = []
            for text, toxic, first in zip(batch["text"], batch["toxic"], batch["first"]):
                if not first:
                    own = score(tokens(text))
                    kinds = Counter(np.round(own[own > 0], 1).tolist())
                    best = max((s for _, _, s in maximal_segments(own)), default=0.0)
                    out.append((toxic, len(own), best, list(kinds), list(kinds.values())))
            yield pd.DataFrame(out, columns=["toxic", "n", "best", "kinds", "counts"])

    held = "toxic int, n long, best double, kinds array<double>, counts array<long>"
    clean = stage(rows.mapInPandas(measured, held).filter("toxic = 0"), "clean")
    # One row for each tenth of a nat, and one number for each of the ``learn_rows`` clean texts at most.
    each = clean.select(F.explode(F.arrays_zip("kinds", "counts")).alias("k")).groupBy("k.kinds").agg(F.sum("k.counts").alias("n"))
    kinds = Counter({r.kinds: r.n for r in each.collect()})
    seen = clean.select("n", "best").collect()
    scale = _solved_scale(kinds, sum(r.n for r in seen))
    mass = sum(r.n * math.exp(-scale * r.best) for r in seen)
    level = len(seen) / mass if mass else 1.0

    def tailed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = _Scorer(words, stems)
        for batch in batches:
            out = []
            for text, toxic, first in zip(batch["text"], batch["toxic"], batch["first"]):
                if not first:
                    own = score(tokens(text))
                    out.append((_tail([s for _, _, s in maximal_segments(own)], len(own), scale, level), toxic))
            yield pd.DataFrame(out, columns=["tail", "toxic"])

    tails = [tuple(r) for r in rows.mapInPandas(tailed, "tail double, toxic int").collect()]
    return Model(words, stems, scale, level, _best_cut(tails))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (all columns of ``docs``), ``score``, ``n_passages``, ``passages``.

    ``passages`` are the significant segments ``(first, end, score)`` in tokens,
    each with a tail probability below the model's cut. ``score`` is 0 to 1 and
    ``LIMIT`` at that probability. Null and empty texts, and texts without a
    sign, get the lowest score. Whole texts are scanned.
    """

    @F.pandas_udf("score double, passages array<struct<first:int,end:int,score:double>>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer, even = _Scorer(model.words, model.stems), (1 - LIMIT) / LIMIT
        for texts in batches:
            out = []
            for text in texts:
                own = scorer(tokens(text))
                found = maximal_segments(own)
                tail = _tail([s for _, _, s in found], len(own), model.scale, model.level) if found else 1.0
                clear = [f for f in found if _tail([f[2]], len(own), model.scale, model.level) <= model.cut]
                out.append((1 / (1 + even * math.sqrt(tail / model.cut)), [{"first": a, "end": b, "score": s} for a, b, s in clear]))
            yield pd.DataFrame(out, columns=["score", "passages"])

    told = sheltered(docs).withColumn("told", scored("row.text"))
    return told.select("row", "told.score", F.size("told.passages").alias("n_passages"), "told.passages")


def labelled_fold(docs: DataFrame) -> DataFrame:
    """Rows whose label may be learned: fold of 3 other than 1."""
    return docs.filter(fold(F.col("doc_id"), 3) != 1)

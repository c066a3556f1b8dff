"""Hardy-Weinberg statistics from genotype counts.

Expected heterozygote frequency is closed form. The exact test (Wigginton et
al. 2005, with the mid-p correction of Graffelman and Moreno 2013) needs the
whole heterozygote distribution of a site. Each probability follows from its
neighbour by a ratio of counts, so two walks from the count seen, one up and
one down, give them relative to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Probabilities this close to each other count as equal.
TIE = 1e-10


def het_freq_hwe(n_hom_ref: Column, n_het: Column, n_hom_var: Column) -> Column:
    """Mean of the Levene-Haldane distribution divided by the sample count."""
    n = (n_hom_ref + n_het + n_hom_var).cast("double")
    ref_alleles = (2 * n_hom_ref + n_het).cast("double")
    var_alleles = (2 * n_hom_var + n_het).cast("double")
    return F.try_divide(ref_alleles * var_alleles, (2 * n - 1) * n)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is made once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _walk(hets: Column, ratio: Callable[[Column], Column]) -> Column:
    """``total`` of the probabilities of ``hets``, whose first has 1, and ``unlikely`` of those below 1, ties by half.

    ``ratio`` leads from a count's probability to that of the next.
    """
    start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("total"), F.lit(0.0).alias("unlikely"))

    def step(s: Column, het: Column) -> Column:
        p = s["p"]
        share = F.when(p > 1 + TIE, F.lit(0.0)).when(p >= 1 - TIE, p / 2).otherwise(p)
        return F.struct(
            (p * ratio(het)).alias("p"), (s["total"] + p).alias("total"), (s["unlikely"] + share).alias("unlikely"),
        )

    return F.aggregate(hets, start, step)


def _walks(v: Column) -> Column:
    """Both walks from the heterozygotes seen, ``v`` holding that count and those of the two alleles.

    One homozygote pair breaks up into two heterozygotes, or the other way
    round. A walk goes twice as far beyond the mean as what was seen lies from
    it, and by 9 deviations and 20 pairs more; what lies farther is too small
    to change a sum.
    """
    seen, rare, common = v["seen"], v["rare"], v["common"]
    n = (rare + common) / 2
    mean = rare * common / (2 * n - 1)
    # Homozygotes of the rarer allele vary no more than a Poisson variable of their mean.
    reach = 2 * F.abs(seen - mean) + 18 * F.sqrt(F.greatest(rare - mean, F.lit(0.0)) / 2) + 40
    highest = F.least(rare, F.greatest(seen, mean + reach))
    lowest = F.greatest(F.lit(0.0), F.least(seen, mean - reach))
    whole = F.struct(
        seen.alias("seen"), rare.alias("rare"), common.alias("common"),
        (F.floor((highest - seen) / 2)).alias("above"), (F.floor((seen - lowest) / 2)).alias("below"),
    )

    def walk(w: Column) -> Column:
        steps = F.sequence(F.lit(0), w["above"].cast("int"))
        h = lambda i: w["seen"] + 2 * i
        up = _walk(F.transform(steps, h), lambda x: (w["rare"] - x) * (w["common"] - x) / ((x + 1) * (x + 2)))
        steps = F.sequence(F.lit(0), w["below"].cast("int"))
        h = lambda i: w["seen"] - 2 * i
        down = _walk(F.transform(steps, h), lambda x: x * (x - 1) / ((w["rare"] - x + 2) * (w["common"] - x + 2)))
        return F.struct(up.alias("up"), down.alias("down"))

    return _let(whole, walk)


def hwe_p_values(n_hom_ref: Column, n_het: Column, n_hom_var: Column) -> Column:
    """Struct of the mid-p values ``p_value_hwe`` (two-sided) and ``p_value_excess_het``.

    Null where a count is null or no sample was counted. A sum that outgrows a
    double means that what was seen is less likely than 1e-300.
    """
    ref_alleles, var_alleles = 2 * n_hom_ref + n_het, 2 * n_hom_var + n_het
    counts = F.struct(
        n_het.cast("double").alias("seen"),
        F.least(ref_alleles, var_alleles).cast("double").alias("rare"),
        F.greatest(ref_alleles, var_alleles).cast("double").alias("common"),
    )

    def shares(walks: Column) -> Column:
        above, below = walks["up"], walks["down"]
        # What was seen stands in both walks.
        total = above["total"] + below["total"] - 1
        unlikely = above["unlikely"] + below["unlikely"] - 0.5
        excess = F.when(above["total"] == float("inf"), F.lit(1.0)).otherwise((above["total"] - 0.5) / total)
        return F.struct(
            F.least(F.lit(1.0), unlikely / total).alias("p_value_hwe"), F.least(F.lit(1.0), excess).alias("p_value_excess_het"),
        )

    return F.when(n_hom_ref + n_het + n_hom_var > 0, _let(_let(counts, _walks), shares))

"""Sample metadata: join, panels, validation, phenotype terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions.dates import parse_short_date
from lociweave.operators.annotate import first_per_key

# Columns of the sample metadata.
REQUIRED_COLUMNS = ["sample_id", "sex", "age", "date_seq", "run_id", "care_site", "health_status"]


def join_metadata(samples: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """All metadata columns onto samples, one row per sample; unchanged without metadata."""
    if metadata is None:
        return samples
    return samples.join(first_per_key(metadata, ["sample_id"]), "sample_id", "left")


def panels_per_sample(panels: DataFrame) -> DataFrame:
    """The one-to-many panel list as one sorted set per sample, ready for a keyed join."""
    return panels.groupBy("sample_id").agg(F.array_sort(F.collect_set("panel")).alias("panels"))


def panel_orphans(panels: DataFrame, metadata: DataFrame) -> DataFrame:
    """Panel rows whose sample has no metadata row."""
    return panels.join(metadata.select("sample_id"), "sample_id", "left_anti")


def _one_deletion_forms(text: Column) -> Column:
    """The text itself and every form with one character left out."""
    shorter = F.transform(
        F.sequence(F.lit(1), F.length(text)),
        lambda i: F.concat(F.substring(text, 1, i - 1), F.substring(text, i + 1, F.length(text))),
    )
    return F.array_distinct(F.concat(F.array(text), F.when(F.length(text) > 0, shorter).otherwise(F.array().cast("array<string>"))))


def likely_typos(unknown: DataFrame, known: DataFrame) -> DataFrame:
    """``(sample_id, suggestion)``: known ids at edit distance 1 from an unknown one.

    Two texts at distance 1 share a form with one character left out, so an
    equality join on those forms finds every pair; the distance itself is
    then checked. No pairwise comparison of the two lists.
    """

    def forms(ids: DataFrame, name: str) -> DataFrame:
        distinct = ids.select(F.col("sample_id").alias(name)).filter(F.col(name).isNotNull()).distinct()
        return distinct.withColumn("_form", F.explode(_one_deletion_forms(F.col(name))))

    return (
        forms(unknown, "sample_id").join(forms(known, "suggestion"), "_form")
        .filter(F.levenshtein("sample_id", "suggestion") == 1)
        .select("sample_id", "suggestion").distinct()
    )


def missing_columns(metadata: DataFrame) -> list[str]:
    """Required columns the metadata table lacks."""
    return [c for c in REQUIRED_COLUMNS if c not in metadata.columns]


def normalize_dates(metadata: DataFrame, column: str = "date_seq") -> DataFrame:
    """Adds ``<column>_date`` and ``<column>_bad`` (text present but not a date)."""
    parsed = parse_short_date(F.col(column))
    return metadata.withColumn(f"{column}_date", parsed).withColumn(
        f"{column}_bad", F.col(column).isNotNull() & parsed.isNull()
    )


def phenotype_terms(assignments: DataFrame, terms: DataFrame, version: str | None = None) -> DataFrame:
    """Per sample its sorted phenotype terms; ids without a term keep a null term.

    Several versions of a term may be listed: ``version`` picks one, else the
    latest ``valid_from`` does.
    """
    if version is not None:
        terms = terms.filter(F.col("hpo_version") == version)
    latest = terms.groupBy("hpo_id").agg(
        F.max(F.struct("valid_from", "hpo_version", "hpo_term")).alias("t")
    ).select("hpo_id", "t.hpo_term", "t.hpo_version")
    return (
        assignments.select("sample_id", "hpo_id").distinct().join(latest, "hpo_id", "left")
        .groupBy("sample_id")
        .agg(F.array_sort(F.collect_list(F.struct("hpo_id", "hpo_term", "hpo_version"))).alias("hpo"))
    )

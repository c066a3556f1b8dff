"""The operators over their whole tables, with the parameters they are meant to run with."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm import (
    attribution, chunks, conversations, embeddings, html, language, licenses, mixing, packing, quality, ranking, simhash, toxicity,
)
from lociweave.llm.common import fold, stage

#: Where executors find public tokenizer files; a parameter of the installation.
TOKENIZERS = os.environ.get("LOCIWEAVE_TOKENIZERS", "")
#: Fixed value: the split that belongs to the byte-level rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(toxicity.labelled_fold(docs), toxicity.labelled_fold(table(spark, sf_dir, "labels")))
    told = toxicity.score(docs.select("doc_id", "text"), model)
    return told.select(
        "row.doc_id", (fold(F.col("row.doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.LIMIT).cast("int").alias("predicted"), "n_passages",
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of the source, language and text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    told = attribution.attribute_tokens(docs, ["source", "lang", "text"], vocabulary("byte_bpe_50k.tiktoken"), PATTERN, "start")
    return told.select("row.doc_id", "field", "section", "start", "n_chars", "n_tokens", "n_crossing")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages: where each stands, and whether it is the occurrence that stays."""
    found = chunks.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "n_chars", "copies", "kept")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every vector."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    profiles = stage(language.learn_profiles(language.labelled_fold(docs)), "profiles")
    told = language.identify(docs.select("doc_id", "text"), profiles)
    return told.select("row.doc_id", (fold(F.col("row.doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    told = quality.judge(table(spark, sf_dir, "documents"))
    return told.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    taken = mixing.taken_words(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")), "dropped")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
        F.size("notices").cast("long").alias("n_notices"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of every benchmark item."""
    return ranking.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents through all stages."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_best_fit_packing, op3_token_counts, op4_substring_dedup, op5_embedding_near_dedup, op6_language_id,
        op7_html_extraction, op8_quality_rules, op9_simhash_near_dedup, op10_mixing,
        op11_conversation_repair, op12_license_scan, op13_ranked_search, pipeline,
    )
}

#: Terms, scores and ranks by their definition, all documents against all terms of all items.
RANKED_SEARCH_SQL = r"""
with words as (
  select row_number() over () as d, doc_id,
    regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
    ) as terms
  from documents where text is not null
),
sizes as (select d, doc_id, cast(len(terms) as bigint) as n, terms from words where len(terms) > 0),
totals as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from sizes),
asked as (
  select i, item_id, term, cast(count(*) as bigint) as times from (
    select row_number() over () as i, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
    )) as term from benchmark
  ) group by i, item_id, term
),
held as (select d, doc_id, n, term, cast(count(*) as bigint) as tf from (select d, doc_id, n, unnest(terms) as term from sizes) group by d, doc_id, n, term),
weighted as (
  select term, cast(floor(1000 * ln((2.0 * n_docs + 2) / (2.0 * count(*) + 1))) as bigint) as w
  from held, totals where term in (select term from asked) group by term, n_docs
),
scored as (
  select i, item_id, d, doc_id,
    cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) as bigint) as score
  from asked join weighted using (term) join held using (term), totals group by i, item_id, d, doc_id
)
select item_id, cast(row_number() over (partition by i order by score desc, doc_id asc nulls last, d) as int) as rank, doc_id, score
from scored where score > 0
qualify row_number() over (partition by i order by score desc, doc_id asc nulls last, d) <= 20
"""

ORACLE_SQL: dict[str, str] = {"op13_ranked_search": RANKED_SEARCH_SQL}

"""Ranked lexical search over deduplicated bags of words.

A document is narrowed to the terms that items ask for. Documents with the same
counts of these and the same length norm score alike for every item, so they form
a class: found by a hash, verified by grouping on the counts themselves, scored
once. Of a class only its smallest ids can stand among an item's best.

Items are a stated query set, taken in blocks of bounded size; what a worker
holds is one block's terms and the best rows of its items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociweave.llm.common import small_batches, stage

#: Best documents of an item.
TOP = 20
#: Fixed values of the score.
TERM_SCALE, NORM_SCALE, NORM_FREE, NORM_SHARE = 1000, 12, 75, 25
SCORE_SCALE = 1_000_000_000
#: Distinct (item, term) pairs of one block of items, about.
BLOCK_PAIRS = 500_000
#: Sums held at once while classes are scored.
_SUMS = 4_000_000
_WORDS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


class Item(NamedTuple):
    number: int
    terms: dict[bytes, int]


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII digits and letters and of characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def numbered_items(items: DataFrame) -> DataFrame:
    """``number, item_id, text``, written down: rows that repeat are items of their own."""
    given = items.select(items["item_id"].alias("item_id"), items["text"].alias("text"))
    return stage(given.withColumn("number", F.monotonically_increasing_id()), "items")


def _block(items: DataFrame, block: int, blocks: int) -> list[Item]:
    """One block of the query set: about ``BLOCK_PAIRS`` terms."""
    own = items.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).select("number", "text")
    return [Item(r.number, Counter(terms_of(r.text))) for r in own.collect()]


def _bags(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``doc_id, n, bag``: number of terms, and the counts of the given ones as pairs of unsigned 32-bit numbers in term order."""
    index = {t: i for i, t in enumerate(terms)}
    kind = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bags = [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text)
                tf = Counter(map(index.get, words))
                tf.pop(None, None)
                sizes.append(len(words))
                bags.append(np.array(sorted(tf.items()), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], names=["doc_id", "n", "bag"]
            )

    return docs.mapInArrow(counted, f"doc_id {kind}, n long, bag binary")


def _document_frequencies(bags: DataFrame, n_terms: int) -> dict[int, int]:
    """How many documents hold each term: added up in each task first, so a frequent term is one row of it."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            for bag in batch.column("bag").to_pylist():
                df[np.frombuffer(bag, "<u4")[::2]] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(df[held], pa.int64())], names=["term", "df"])

    each = bags.select("bag").mapInArrow(summed, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    # One row for each term of the block at most.
    return {r.term: r.df for r in each.collect()}


def bag_classes(bags: DataFrame, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """``bag, m, members``: classes of equal counts and norm with their ``top`` smallest ids, nulls last.

    Grouped by a hash of both and by both themselves. Each task drops what
    cannot be among the smallest before anything is shuffled.
    """
    m = F.lit(NORM_FREE) + F.expr(f"{NORM_SHARE}L * n * {n_docs}L div {max(1, n_terms)}L")
    keyed = bags.filter("octet_length(bag) > 0").select("doc_id", "bag", m.cast("long").alias("m"))
    keyed = keyed.withColumn("code", F.xxhash64("bag", "m"))
    least = Window.partitionBy("code", "m", "bag").orderBy(F.asc_nulls_last("doc_id"))
    few = keyed.withColumn("nth", F.row_number().over(least)).filter(F.col("nth") <= top)
    return few.groupBy("code", "m", "bag").agg(F.sort_array(F.collect_list(F.struct("nth", "doc_id"))).alias("own")).select(
        "bag", "m", F.col("own.doc_id").alias("members")
    )


def _best(classes: DataFrame, items: list[Item], terms: list[bytes], weights: dict[int, int], top: int) -> DataFrame:
    """``number, doc_id, score``: each task's ``top`` rows for each item."""
    index = {t: i for i, t in enumerate(terms)}
    # Postings: the items that ask for each term, and how often, one after the other.
    asked: list[list[tuple[int, int]]] = [[] for _ in terms]
    for k, item in enumerate(items):
        for t, n in item.terms.items():
            asked[index[t]].append((k, n))
    first = np.cumsum([0, *map(len, asked)])
    who = np.array([k for own in asked for k, _ in own], np.int64)
    times = np.array([n * weights.get(t, 0) for t, own in enumerate(asked) for _, n in own], np.int64)
    numbers = [item.number for item in items]
    kind = classes.schema["members"].dataType.elementType.simpleString()
    at_once = max(1, _SUMS // max(1, len(items)))

    def scores(bags: list[bytes], m: np.ndarray) -> np.ndarray:
        """Scores of some classes, a row for each: 64-bit sums over postings."""
        sums = np.zeros((len(bags), len(numbers)), np.int64)
        for c, bag in enumerate(bags):
            pairs = np.frombuffer(bag, "<u4").astype(np.int64)
            t, tf = pairs[::2], pairs[1::2]
            part = (SCORE_SCALE * tf) // (TERM_SCALE * tf + NORM_SCALE * m[c])
            sizes = first[t + 1] - first[t]
            places = np.arange(sizes.sum()) + np.repeat(first[t] - np.cumsum(sizes) + sizes, sizes)
            np.add.at(sums[c], who[places], times[places] * np.repeat(part, sizes))
        return sums

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Highest score first, then the smallest id, nulls last.
        best: list[list[tuple]] = [[] for _ in numbers]
        id_type = None
        for batch in batches:
            bags, ms, members = (batch.column(c).to_pylist() for c in ("bag", "m", "members"))
            id_type = batch.schema.field("members").type.value_type
            for at in range(0, len(bags), at_once):
                sums = scores(bags[at:at + at_once], np.array(ms[at:at + at_once], np.int64))
                for k in range(len(numbers)):
                    own = sums[:, k]
                    least = best[k][-1][0] if len(best[k]) >= top else 1
                    if len(own) > top:
                        # Whatever ties with the last of the best stays in.
                        least = max(least, int(np.partition(own, len(own) - top)[len(own) - top]))
                    hits = np.flatnonzero(own >= max(1, least))
                    if len(hits):
                        rows = best[k] + [(int(own[c]), d) for c in hits for d in members[at + c]]
                        rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
                        best[k] = rows[:top]
        out = [(numbers[k], d, s) for k, rows in enumerate(best) for s, d in rows]
        if out:
            types = [pa.int64(), id_type, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["number", "doc_id", "score"])

    return classes.mapInArrow(ranked, f"number long, doc_id {kind}, score long")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each item with a score above 0.

    ``docs`` has ``doc_id, text``, ``items`` ``item_id, text``; further columns are
    left out. Every row of either is a document or an item of its own, also where
    ids repeat or are null; null ids come last among equal scores, and rows of one id
    and score have ranks of their own. A null or empty text has no terms: such a
    document doesn't count, such an item has no row. Empty tables give no row.
    """
    small_batches(docs.sparkSession)
    given = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    asked = numbered_items(items)
    n_pairs = asked.select(F.sum(F.length("text"))).first()[0] or 0
    # A term takes two characters at least, with what parts it from the next.
    blocks = max(1, -(-n_pairs // (2 * block_pairs)))
    found = None
    for block in range(blocks):
        own = [i for i in _block(asked, block, blocks) if i.terms]
        if not own:
            continue
        terms = sorted({t for i in own for t in i.terms})
        bags = stage(_bags(given, terms), "bags")
        n_docs, n_terms = bags.select(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = {t: term_weight(n_docs, df) for t, df in _document_frequencies(bags, len(terms)).items()}
        best = stage(_best(bag_classes(bags, n_docs, n_terms, top), own, terms, weights, top), "best")
        found = best if found is None else found.unionByName(best)
    if found is None:
        types = [asked.schema["item_id"].dataType.simpleString(), given.schema["doc_id"].dataType.simpleString()]
        return docs.sparkSession.createDataFrame([], f"item_id {types[0]}, rank int, doc_id {types[1]}, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranks = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranks.join(asked.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")

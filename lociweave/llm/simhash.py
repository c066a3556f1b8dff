"""SimHash near-duplicates by the pigeonring filter.

A fingerprint is cut into ``max_distance + 2`` ring segments. If two
fingerprints differ in at most ``max_distance`` bits, some segment starts a
chain whose every prefix of k segments differs in at most
``k * max_distance / segments`` bits, so that segment and another one are
equal: pairs are only formed within equal (segment, segment) keys, pass the
chain test, and then the full Hamming check.

Texts that share a fingerprint are one class and are linked without pairs.
A key shared by more than ``MOST_IN_KEY`` fingerprints forms no pairs
either: its members meet at the fingerprints one bit away from them. Two of
them share such a meeting point exactly if they differ in at most two bits, so
nothing is lost and work stays proportional to the members.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.llm.common import connected_components, rest_key, sheltered, stage, text_key

SEED = 42
BITS = 64
MOST_IN_KEY = 32
_AT_ONCE = 1 << 16


def _fingerprint(text: str | None, size: int) -> int:
    words = re.sub(rb"[\x20\x09-\x0D]+", b" ", (text or "").encode()).strip(b" ")
    if not words:
        return 0
    # bytes.lower touches A-Z only.
    words = words.lower()
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1)).tolist()
    ends = np.append(gaps, len(words)).tolist()
    spans = list(zip(starts, ends[size - 1:])) or [(0, len(words))]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(spans), _AT_ONCE):
        hashes = np.array([digest(words[a:b], SEED) for a, b in spans[at:at + _AT_ONCE]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(spans), bitorder="little")
    return int(bits.view("<i8")[0])


def simhash(text: Column, shingle_words: int = 3) -> Column:
    """Signed 64-bit fingerprint of a text; zero for a null text or one without words."""

    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_fingerprint(t, shingle_words) for t in texts], dtype="int64")

    return fingerprints(text)


def _segments(max_distance: int) -> list[tuple[int, int]]:
    """``(first bit, bits)`` of each ring segment, as even as can be."""
    m = max_distance + 2
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(x: Column, at: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(x, at[0]).bitwiseAND(F.lit((1 << at[1]) - 1).cast("long"))


def _chain_passes(x: Column, y: Column, max_distance: int) -> Column:
    """Whether some segment starts a chain within its proportional budgets all the way round."""
    ring = _segments(max_distance)
    apart = [F.bit_count(_segment(x.bitwiseXOR(y), at)) for at in ring]
    m = len(ring)
    starts = None
    for i in range(m):
        ok, total = F.lit(True), F.lit(0)
        for k in range(1, m + 1):
            total = total + apart[(i + k - 1) % m]
            ok = ok & (total <= k * max_distance // m)
        starts = ok if starts is None else starts | ok
    return starts


def _keys(prints: DataFrame, max_distance: int) -> DataFrame:
    """``which, key, fp``: one row for each pair of segments."""
    ring = _segments(max_distance)
    two = [
        F.struct(F.lit(n).alias("which"), F.xxhash64(_segment(F.col("fp"), ring[i]), _segment(F.col("fp"), ring[j])).alias("key"))
        for n, (i, j) in enumerate(combinations(range(len(ring)), 2))
    ]
    return prints.select("fp", F.explode(F.array(*two)).alias("k")).select("k.which", "k.key", "fp")


def linked(prints: DataFrame, max_distance: int = 2) -> DataFrame:
    """Edges ``a, b`` that connect distinct fingerprints ``fp`` as their links do.

    Every pair within ``max_distance`` (1 or 2) is connected, directly or
    through meeting points, and none is beyond it.
    """
    if max_distance not in (1, 2):
        raise ValueError("max_distance must be 1 or 2")
    keys = _keys(prints, max_distance)
    shared = stage(keys.groupBy("which", "key").agg(F.count("*").alias("n")).filter("n > 1"), "keys")
    few = keys.join(shared.filter(F.col("n") <= MOST_IN_KEY), ["which", "key"], "left_semi")
    x, y = F.col("x.fp"), F.col("y.fp")
    pairs = (
        few.alias("x").join(few.alias("y"), ["which", "key"])
        .filter((x < y) & _chain_passes(x, y, max_distance) & (F.bit_count(x.bitwiseXOR(y)) <= max_distance))
        .select(x.alias("a"), y.alias("b"))
    )
    crowded = keys.join(shared.filter(F.col("n") > MOST_IN_KEY), ["which", "key"], "left_semi").select("fp").distinct()
    crowded = stage(crowded, "crowded")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(BITS)])
    near = crowded.select("fp", F.explode(flips).alias("bit")).select(F.col("fp").bitwiseXOR(F.col("bit")).alias("spot"), "fp", "bit")
    if max_distance == 1:
        met = crowded.select(F.col("fp").alias("spot")).join(near.filter("bit <> 0"), "spot").select(F.col("spot").alias("a"), F.col("fp").alias("b"))
    else:
        lowest = near.groupBy("spot").agg(F.min("fp").alias("a"), F.max("fp").alias("top"), F.count("*").alias("n")).filter("n > 1")
        lowest = stage(lowest, "spots")
        met = lowest.filter("n = 2").select("a", F.col("top").alias("b")).union(
            near.join(lowest.filter("n > 2").select("spot", "a"), "spot").select("a", F.col("fp").alias("b"))
        )
    return pairs.union(met.filter("a <> b")).distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """One row per document: ``doc_id, text_key, fp, component, component_id``.

    ``component`` is the smallest fingerprint reachable by links, and tells
    groups apart; ``component_id`` is the smallest document id of those. Null and
    empty texts have fingerprint zero and link like any other. Rows that repeat
    an id each have their row. A null id is left out of the minimum: a
    component of null ids only has a null id. An empty table gives no row.
    """
    rows = stage(
        sheltered(docs).select(
            F.col("row.doc_id").alias("doc_id"), text_key(F.col("row.text")).alias("text_key"),
            simhash(F.col("row.text"), shingle_words).alias("fp"),
        ), "prints",
    )
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    groups = connected_components(linked(prints.select("fp"), max_distance))
    named = prints.join(groups, prints.fp == groups.node, "left").select(
        prints.fp, "first_id", F.coalesce("component", "fp").alias("component")
    )
    first = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = stage(named.join(first, "component").select("fp", "component", "component_id"), "classes")
    return rows.join(ids, "fp").select("doc_id", "text_key", "fp", "component", "component_id")


def keep_one_each(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """The documents with one of each group left: smallest id first, null ids last, then smallest text key.

    Of rows that repeat both id and text the one with the smallest key of its other columns stays, whole. Columns are those of ``docs``.
    """
    found = near_duplicates(docs, shingle_words, max_distance)
    # An id may be null, or repeat within a group or in several: the smallest (id, text) of each group stays.
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("best"))
    keep = stage(best.select("best.doc_id", "best.text_key"), "kept").alias("keep")
    rows = sheltered(docs).withColumns({"id": F.col("row.doc_id"), "key": text_key(F.col("row.text"))})
    kept = rows.join(keep, F.col("id").eqNullSafe(F.col("keep.doc_id")) & (F.col("key") == F.col("keep.text_key")), "left_semi")
    least = kept.withColumn("rest", rest_key(docs)).groupBy("id", "key").agg(F.min_by("row", "rest").alias("row"))
    return least.select("row.*")

"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text and cuts where its top bits are
zero, so cuts depend on the last bytes only and fall at the same places in a
passage wherever it stands. Chunks are compared by digest. A run of chunks
that occur elsewhere is a repeated passage; its first occurrence, by document
and place, stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociweave.llm.common import sheltered, stage, text_key

#: A cut every 2^CUT_BITS bytes on average, after LEAST bytes at least.
CUT_BITS = 5
LEAST = 16
MOST = 1024
#: Runs of repeated chunks shorter than this are no passage.
LEAST_RUN = 100
_WINDOW = 16
_PART = 1 << 20
_GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) & 0xFFFF for b in range(256)], np.uint16)


def _rolled(data: np.ndarray) -> np.ndarray:
    """Gear hash after each byte, ``h = 2 h + gear[byte]`` in 16 bits, by doubling the window."""
    h, width = _GEAR[data], 1
    while width < _WINDOW:
        h[width:] = h[width:] + (h[:-width] << np.uint16(width))
        width *= 2
    return h


def cut_places(data: bytes) -> list[int]:
    """Ends of the chunks of a text; the last is its length. No cut splits a character."""
    raw = np.frombuffer(data, np.uint8)
    found = []
    for at in range(0, len(raw), _PART):
        start = max(0, at - _WINDOW)
        h = _rolled(raw[start:at + _PART])[at - start:]
        found.append(np.flatnonzero(h >> np.uint16(16 - CUT_BITS) == 0) + at + 1)
    ends, last, size = [], 0, len(raw)
    whole = lambda x: x >= size or raw[x] & 0xC0 != 0x80
    for end in np.concatenate(found).tolist() if found else []:
        while end - last > MOST:
            last += MOST
            while not whole(last):
                last -= 1
            ends.append(last)
        if end - last >= LEAST and end < size and whole(end):
            ends.append(end)
            last = end
    while size - last > MOST:
        last += MOST
        while not whole(last):
            last -= 1
        ends.append(last)
    if size > last:
        ends.append(size)
    return ends


def _chunk_rows(digests: bool):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, keys, idx, starts, sizes, raw = [], [], [], [], [], []
            for doc_id, key, text in zip(batch["doc_id"], batch["key"], batch["text"]):
                data = text.encode("utf-8", "surrogatepass")
                last, ends = 0, cut_places(data)
                for end in ends:
                    raw.append(xxhash.xxh3_128_digest(data[last:end]))
                    last = end
                if digests:
                    at = np.array([0, *ends], np.int64)
                    lead = np.concatenate(([0], np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)))
                    chars = lead[at]
                    n = len(ends)
                    ids.append(np.full(n, doc_id)), keys.append(np.full(n, key)), idx.append(np.arange(n))
                    starts.append(chars[:-1]), sizes.append(np.diff(chars))
            two = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2)
            if not digests:
                yield pd.DataFrame({"d1": two[:, 0]})
            elif len(two):
                yield pd.DataFrame({
                    "doc_id": np.concatenate(ids), "key": np.concatenate(keys), "idx": np.concatenate(idx),
                    "start": np.concatenate(starts), "size": np.concatenate(sizes), "d1": two[:, 0], "d2": two[:, 1],
                })

    return rows


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Chunks that occur more than once: ``doc_id, key, idx, start, size, is_first, copies``.

    ``start`` and ``size`` are in characters; ``key`` tells apart the texts of
    a repeated id. Rows equal in id and text are one document, and their
    copies don't count as repeats. Null and empty texts have no chunk; a null
    id is taken as -1.
    """
    given = sheltered(docs).select(
        F.coalesce("row.doc_id", F.lit(-1)).cast("long").alias("doc_id"), text_key(F.col("row.text")).alias("key"), F.col("row.text").alias("text")
    ).filter("text <> ''")
    # A first pass over half digests: what occurs once never travels with its place.
    half = given.select("doc_id", "key", "text").mapInPandas(_chunk_rows(False), "d1 long")
    again = stage(half.groupBy("d1").agg(F.count("*").alias("n")).filter("n > 1").select("d1"), "halves")
    chunks = given.mapInPandas(_chunk_rows(True), "doc_id long, key long, idx long, start long, size long, d1 long, d2 long")
    found = stage(chunks.join(again, "d1", "left_semi"), "chunks")
    # The smallest (document, text, place) in three plain minima, which hash aggregation can combine early.
    group = ["d1", "d2"]
    # Joins end in a written table, so that a digest with very many places can be split among tasks.
    low = stage(found.groupBy(*group).agg(F.min("doc_id").alias("low_id")), "low")
    mine = stage(found.join(low, group).filter("doc_id = low_id").select(*group, "doc_id", "key", "idx"), "mine")
    low_key = stage(mine.groupBy(*group).agg(F.min("key").alias("low_key")), "low_key")
    mine = stage(mine.join(low_key, group).filter("key = low_key"), "mine")
    first = stage(mine.groupBy(*group).agg(
        F.min("doc_id").alias("low_id"), F.min("low_key").alias("low_key"), F.min("idx").alias("low_idx")
    ), "first")
    place = found.join(first, group).withColumn("is_first", F.expr("doc_id = low_id and key = low_key and idx = low_idx"))
    place = stage(place.drop("low_id", "low_key", "low_idx"), "places")
    # Each chunk that has a place besides its first one.
    more = stage(place.filter("not is_first").groupBy(*group).agg(F.count("*").alias("others")), "more")
    return place.join(more, group).select("doc_id", "key", "idx", "start", "size", "is_first", F.col("others").alias("copies"))


def repeated_passages(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """Passages of at least ``least_run`` characters whose chunks all occur elsewhere too.

    ``doc_id, key, start, n_chars, copies, kept``: within a passage, chunks
    that are the first of their kind make up kept rows, the others rows to
    leave out. ``copies`` is the greatest number of further occurrences. A
    document without such a passage has no row.
    """
    chunks = repeated_chunks(docs).distinct()
    doc = Window.partitionBy("doc_id", "key")
    runs = chunks.withColumn("run", F.col("idx") - F.row_number().over(doc.orderBy("idx")))
    runs = runs.withColumn("run_size", F.sum("size").over(Window.partitionBy("doc_id", "key", "run")))
    runs = runs.filter(F.col("run_size") >= least_run)
    part = F.col("idx") - F.row_number().over(Window.partitionBy("doc_id", "key", "is_first").orderBy("idx"))
    return (
        runs.withColumn("part", part).groupBy("doc_id", "key", "run", "is_first", "part")
        .agg(F.min("start").alias("start"), F.sum("size").alias("n_chars"), F.max("copies").alias("copies"))
        .select("doc_id", "key", "start", "n_chars", "copies", F.col("is_first").alias("kept"))
    )


def drop_repeats(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """The documents without their repeated passages; first occurrences stay.

    A document of which nothing but white space stays goes; one that was empty
    before stays. ``n_chars``, where there is such a column, follows the text.
    """
    out = repeated_passages(docs, least_run).filter("not kept")
    spans = stage(
        out.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("start", "n_chars"))).alias("cut")), "spans"
    )
    rows = sheltered(docs).withColumns({
        "id": F.coalesce("row.doc_id", F.lit(-1)).cast("long"), "k": text_key(F.col("row.text")),
    })
    joined = rows.join(spans, (F.col("id") == spans.doc_id) & (F.col("k") == spans.key), "left").select("row", "cut")
    # What lies between one cut's end and the next one's start.
    n = F.size("cut")
    keep = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.substring(
            F.col("row.text"),
            F.when(i == 0, F.lit(0)).otherwise(F.get("cut", i - 1)["start"] + F.get("cut", i - 1)["n_chars"]).cast("int") + 1,
            (F.when(i == n, F.length("row.text")).otherwise(F.get("cut", i)["start"])
             - F.when(i == 0, F.lit(0)).otherwise(F.get("cut", i - 1)["start"] + F.get("cut", i - 1)["n_chars"])).cast("int"),
        ),
    )
    left = joined.withColumn("left", F.when(F.col("cut").isNotNull(), F.array_join(keep, "")))
    left = left.filter(F.col("left").isNull() | F.col("left").rlike(r"\S"))
    columns = [
        F.coalesce("left", "row.text").alias(c) if c == "text"
        else F.when(F.col("left").isNotNull(), F.length("left")).otherwise(F.col("row.n_chars")).cast("long").alias(c) if c == "n_chars"
        else F.col("row")[c].alias(c)
        for c in docs.columns
    ]
    return left.select(*columns)

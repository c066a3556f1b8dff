"""Near-duplicate vectors by sorted projection passes.

Equal vectors of a label are one class. Each pass orders the classes by label
and a bit string of random hyperplane signs, whose planes are other ones each
time, and compares every vector with the ``window`` before it. Pairs at or
above the threshold by exact cosine are united over all passes, whose number
follows the classes of the largest label, so that a pair at the threshold
itself is found with probability ``RECALL`` by estimate. Within the
components so found all links are counted, in blocks, so that groups wider
than the window lose none.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log1p, log2, pi

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.llm.common import connected_components, sheltered, stage

THRESHOLD = 0.93
#: Share of the isolated pairs at the threshold itself that the passes are meant to find; closer ones are found more often.
RECALL = 0.999
#: Passes at least, however few the rows.
PASSES = 12
WINDOW = 32
BITS = 48
_AT_ONCE = 4
_PART_ROWS = 16384
_BLOCK = 2048
_LONGS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _unit(vectors) -> np.ndarray:
    m = np.stack(vectors).astype(float)
    # Scaled first, so that squares neither overflow nor vanish.
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def passes_for(rows: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes that find an isolated pair at the threshold among ``rows`` of its label with probability ``recall``.

    A random sign tells the two apart with probability angle / pi. In one pass
    they meet if they share the leading bits that thin the rows out to one
    window. The rows count as evenly spread over the signs.
    """
    alike = 1 - acos(max(-1.0, min(1.0, threshold))) / pi
    met = alike ** max(0.0, log2(max(1, rows) / window))
    return PASSES if met >= 1 else max(PASSES, ceil(log(1 - recall) / log1p(-met)))


def _sort_keys(passes: list[int], seed: int):
    @F.pandas_udf("array<long>")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        planes: dict[int, list[np.ndarray]] = {}
        bit = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for vectors in batches:
            out: list = [[]] * len(vectors)
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_dim.setdefault(len(v), []).append(i)
            for dim, rows in by_dim.items():
                if dim not in planes:
                    planes[dim] = [np.random.default_rng([seed, p, dim]).standard_normal((dim, BITS)) for p in passes]
                m = _unit([vectors.iloc[i] for i in rows])
                found = np.stack([((m @ own) > 0) @ bit for own in planes[dim]], axis=1)
                for i, own in zip(rows, found):
                    out[i] = own
            yield pd.Series(out)

    return keys


def _compare(threshold: float, window: int):
    """Sorted rows of a partition to linked pairs, and its first and last rows for the borders between partitions."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n_seen, part = None, 0, None
        for batch in batches:
            if not len(batch):
                continue
            part = int(batch["part"].iloc[0])
            if n_seen < window:
                head = batch.head(window - n_seen)
                yield head.assign(side=1, a=-1)[["side", "part", "a", "cls", "group", "embedding"]].rename(columns={"cls": "b"})
            rows = pd.concat([held, batch]) if held is not None else batch
            yield from _pairs_in(rows, 0 if held is None else len(held), threshold, window)
            held, n_seen = rows.tail(window), n_seen + len(batch)
        if held is not None:
            yield held.assign(side=0, a=-1)[["side", "part", "a", "cls", "group", "embedding"]].rename(columns={"cls": "b"})

    return pairs


def _pairs_in(rows: pd.DataFrame, new: int, threshold: float, window: int) -> Iterator[pd.DataFrame]:
    """Links of rows from ``new`` on with at most ``window`` rows before each, of the same group and length."""
    group, cls = rows["group"].to_numpy(), rows["cls"].to_numpy()
    lengths = rows["embedding"].map(len).to_numpy()
    for dim in np.unique(lengths):
        # Groups carry the dimension, so rows of one dimension compare among themselves.
        at = np.flatnonzero(lengths == dim)
        m = _unit(rows["embedding"].iloc[at].tolist())
        left, right = [], []
        for k in range(1, min(window, len(at) - 1) + 1):
            near = (at[k:] >= new) & (group[at[k:]] == group[at[:-k]])
            hit = np.flatnonzero(near & (np.einsum("ij,ij->i", m[k:], m[:-k]) >= threshold))
            left.append(cls[at[hit]]), right.append(cls[at[hit + k]])
        if left and (n := sum(map(len, left))):
            yield pd.DataFrame({"side": 2, "part": 0, "a": np.concatenate(left), "b": np.concatenate(right), "group": 0, "embedding": [[]] * n})


def _links(classes: DataFrame, threshold: float, passes: int | None, window: int, seed: int) -> DataFrame:
    """Linked pairs ``a, b`` of classes over all passes, as written tables."""
    sizes = classes.groupBy("label", F.size("embedding")).agg(F.count("*").alias("n"))
    n, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    passes = passes_for(largest, threshold, window) if passes is None else passes
    found = None
    for first in range(0, passes, _AT_ONCE):
        own = list(range(first, min(passes, first + _AT_ONCE)))
        keyed = classes.withColumn("keys", _sort_keys(own, seed)("embedding")).select(
            "cls", "label", "embedding", F.posexplode("keys").alias("pass", "key"),
        )
        keyed = keyed.withColumn("group", F.xxhash64("pass", "label", F.size("embedding")))
        parts = max(1, -(-n * len(own) // _PART_ROWS))
        order = ["group", "key", "cls"]
        sorted_rows = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        sorted_rows = sorted_rows.select(F.spark_partition_id().cast("long").alias("part"), "cls", "group", "embedding")
        out = f"side long, part long, a long, b long, group long, embedding {classes.schema['embedding'].dataType.simpleString()}"
        got = stage(sorted_rows.mapInPandas(_compare(threshold, window), out), "pass")
        border = got.filter("side < 2").withColumn("border", F.col("part") + F.when(F.col("side") == 0, 1).otherwise(0))

        def met(rows: pd.DataFrame) -> pd.DataFrame:
            # At most one window from either side.
            rows = rows.rename(columns={"b": "cls"}).sort_values("side", kind="stable").reset_index(drop=True)
            tail = int((rows["side"] == 0).sum())
            parts = list(_pairs_in(rows, tail, threshold, 2 * window)) if 0 < tail < len(rows) else []
            return pd.concat(parts)[["a", "b"]] if parts else pd.DataFrame({"a": [], "b": []}, dtype="int64")

        crossing = border.groupBy("border").applyInPandas(met, _LONGS)
        pairs = got.filter("side = 2").select("a", "b").union(crossing).distinct()
        found = pairs if found is None else found.union(pairs)
    return stage(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")


def _link_counts(classes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """``cls, others``: vectors of linked classes, over all pairs of each component, in blocks."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    members = groups.join(sizes, "component").join(classes.select(F.col("cls").alias("node"), "copies", "embedding"), "node")
    blocks = F.ceil(F.col("n") / _BLOCK).cast("long")
    members = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # Each block meets every other one of its component once, and itself.
    met = members.select(
        "component", "node", "copies", "embedding", "block",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"),
    ).select("component", "node", "copies", "embedding", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        m, copies = _unit(rows["embedding"].tolist()), rows["copies"].to_numpy()
        x, y = rows["x"].iloc[0], rows["y"].iloc[0]
        block = rows["block"].to_numpy()
        others = np.zeros(len(rows), np.int64)
        for at in range(0, len(rows), 512):
            near = m[at:at + 512] @ m.T >= threshold
            near[np.arange(len(near)), np.arange(at, at + len(near))] = False
            if x != y:
                near &= block[at:at + 512, None] != block[None, :]
            others[at:at + 512] = near @ copies
        return pd.DataFrame({"cls": rows["node"].to_numpy(), "others": others})

    counted = met.groupBy("component", "x", "y").applyInPandas(count, "cls long, others long")
    return counted.groupBy("cls").agg(F.sum("others").alias("others"))


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, passes: int | None = None, window: int = WINDOW, seed: int = 5
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    ``vectors`` has ``vec_id, embedding, label``. Only vectors of equal
    non-null labels and equal length link. A vector that is null, empty, zero or
    holds a null or non-finite component links with nothing, and is a component of its
    own. Rows that repeat an id each count as a vector. An empty table gives no row.
    ``passes`` follow the largest label (``passes_for``) where none are given.
    Single-precision components are carried as they are, all others in double
    precision; cosines are computed in double precision.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = sheltered(vectors).select(
        F.col("row.vec_id").alias("vec_id"), F.col("row.label").alias("label"), F.col("row.embedding").cast(kind).alias("embedding")
    )
    limit = F.lit(float("inf"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists("embedding", lambda x: x != 0)
    valid = F.col("label").isNotNull() & F.coalesce(fine, F.lit(False))
    told = rows.withColumn("valid", valid)
    alike = told.filter("valid").groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low_id"))
    classes = stage(alike.withColumn("cls", F.monotonically_increasing_id()), "classes")
    links = _links(classes, threshold, passes, window, seed)
    groups = stage(connected_components(links), "groups")
    counts = stage(_link_counts(classes, groups, threshold), "counts")
    about = classes.select("cls", "label", "embedding", "copies", "low_id").join(groups, F.col("cls") == F.col("node"), "left")
    about = about.withColumn("component", F.coalesce("component", "cls")).join(counts, "cls", "left")
    about = stage(about.select("label", "embedding", "copies", "low_id", "component", F.coalesce("others", F.lit(0)).alias("others")), "about")
    low = about.groupBy("component").agg(F.min("low_id").alias("component_id"))
    about = stage(about.join(low, "component").select(
        F.col("label").alias("its_label"), F.col("embedding").alias("its_embedding"), "component_id",
        (F.col("others") + F.col("copies") - 1).alias("links"), F.lit(True).alias("found"),
    ), "found")
    out = told.join(
        about, F.col("valid") & (F.col("label") == F.col("its_label")) & (F.col("embedding") == F.col("its_embedding")), "left"
    )
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )

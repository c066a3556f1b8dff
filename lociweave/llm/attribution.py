"""Token counts by field and section through offsets.

A document's fields are joined into one text, which is encoded once and
whole. Token lengths in bytes give each token's character span; sections, the
lines of the fields, are spans too. The two sorted rows of spans are joined by
their bounds. A token that reaches over a section's end is allocated by rule:

* ``start``: to the section of its first character
* ``most``: to the section with most of its bytes, the first of equals
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.llm.common import sheltered

RULES = ("start", "most")
RESULT = "field string, section int, start long, n_chars long, n_tokens long, n_crossing long"


@lru_cache(maxsize=1)
def _encoding(path: str, pattern: str):
    """Encoder and the byte length of each id; one for each worker process."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def section_counts(ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and crossing tokens of each section.

    ``ends`` are the ascending ends of the tokens, which start at 0 without
    gaps; ``bounds`` the ascending ends of the sections, likewise.
    """
    starts = np.concatenate(([0], ends[:-1]))
    first = np.searchsorted(bounds, starts, "right")
    last = np.searchsorted(bounds, ends, "left")
    home, crossing = first.copy(), first != last
    if rule == "most":
        for i in np.flatnonzero(crossing).tolist():
            own = np.arange(first[i], last[i] + 1)
            low = np.concatenate(([0], bounds))[own]
            home[i] = own[np.argmax(np.minimum(bounds[own], ends[i]) - np.maximum(low, starts[i]))]
    n = len(bounds)
    return np.bincount(home, minlength=n), np.bincount(home[crossing], minlength=n)


def _sections(fields: list[tuple[str, str]]) -> tuple[str, list[tuple[str, int, int]]]:
    """Joined text, and ``(field, section, end in characters)`` of its lines, line ends with the line before them."""
    text, spans = [], []
    at = 0
    for name, value in fields:
        for k, line in enumerate((value + "\n").split("\n")[:-1]):
            at += len(line) + 1
            text.append(line)
            spans.append((name, k, at))
    whole = "\n".join(text)
    return whole, [*spans[:-1], (*spans[-1][:2], len(whole))] if spans else []


def attribute_tokens(docs: DataFrame, fields: list[str], vocabulary: str, pattern: str, rule: str = "start") -> DataFrame:
    """``row`` (all columns of ``docs``) and one row per section: ``field, section, start, n_chars, n_tokens, n_crossing``.

    ``n_crossing`` of ``n_tokens`` also reach into another section. A null field is left out;
    an empty one has one section, which holds its line end. Sums over a document are
    its whole token count. A document with null fields only has no row; rows
    that repeat are counted each. ``vocabulary`` is a rank file every executor
    has, ``pattern`` the split that belongs to it.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    @F.pandas_udf(f"array<struct<{', '.join(c.replace(' ', ':') for c in RESULT.split(', '))}>>")
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        encoder, lengths = _encoding(vocabulary, pattern)
        for batch in batches:
            out = []
            for values in zip(*[batch[f"f{i}"] for i in range(len(fields))]):
                text, spans = _sections([(n, v) for n, v in zip(fields, values) if v is not None])
                if not spans:
                    out.append([])
                    continue
                data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
                ends = np.cumsum(lengths[np.array(encoder.encode_ordinary(text), np.int64)])
                # Where each section's last character ends in bytes.
                places = np.array([end for _, _, end in spans])
                at = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))
                tokens, crossing = section_counts(ends, at[places], rule)
                starts = np.concatenate(([0], places[:-1]))
                out.append([
                    {"field": n, "section": k, "start": int(s), "n_chars": int(e - s), "n_tokens": int(t), "n_crossing": int(c)}
                    for (n, k, e), s, t, c in zip(spans, starts, tokens, crossing)
                ])
            yield pd.Series(out)

    row = sheltered(docs)
    given = F.struct(*[F.col("row")[name].cast("string").alias(f"f{i}") for i, name in enumerate(fields)])
    return row.withColumn("sections", counted(given)).select("row", F.inline("sections"))

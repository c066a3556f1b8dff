"""Best-fit packing by the sum of squares.

Bins of one capacity are told apart only by their gap. An item goes where
the sum over all gaps of the squared number of open bins becomes smallest, so
no gap piles up that nothing fits. Items come longest first, and a new bin is
opened only where no open one has room.

Items are packed in shards of bounded size in parallel. Bins that a shard
leaves open come together in further rounds, whole, as items of their own.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.llm.common import small_batches, stage

CAPACITY = 2048
SHARD_ITEMS = 32768
#: Bytes that a worker's remembered words take at most, of both generations.
CACHE_BYTES = 128 << 20
#: What an entry takes beside its two texts.
_ENTRY = 170
_TEXTS = 512
#: Words between two looks at the size of the memory.
_WORDS = 4096
#: Letters of one pre-token and ASCII signs of the next; no apostrophe, which may start a contraction.
_PLAIN = re.compile(r"([a-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _packed_ids(ids: list[int]) -> bytes:
    return pack_ids(f"<{len(ids)}I", *ids)


class _Words(dict):
    """Ids of words; one that isn't there is looked up among older ones, else spelled, and stays."""

    def __init__(self, spell: Callable[[bytes], bytes], older: dict[bytes, bytes]):
        self.spell, self.older, self.size = spell, older, 0

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.spell(word)
        self[word] = ids
        self.size += len(word) + len(ids) + _ENTRY
        return ids

    def followed(self) -> _Words:
        """The next generation, for which this one is the older."""
        self.older = {}
        return _Words(self.spell, self)


class _Encoder:
    """Ids of whole texts; words between ASCII white space are encoded one by one and remembered.

    White space only separates in this vocabulary, and nothing in it reaches
    over white space, so ids of the words in a row are the ids of the text.
    Remembered words stand in two generations: when the younger one is full it
    becomes the older one, and what is met there again moves over.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most = cache_bytes // 2
        self.known = _Words(self._spelled, {})
        # Precomposed letters of Latin-1 need no normalization but lower case, and then stand for their bytes.
        spelled = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
        self.letters = {ord(c): spelled.pre_tokenize_str(c.lower())[0][0] for c in letters}

    def _spelled(self, word: bytes) -> bytes:
        """Ids of one word; letters alone go straight to the model, which spares the text steps before it."""
        text = word.decode("utf-8", "surrogatepass")
        plain = _PLAIN.fullmatch(text)
        if plain is None:
            return _packed_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        letters, signs = plain.groups()
        if signs:
            return self.known[letters.encode()] + self.known[signs.encode()]
        return _packed_ids([t.id for t in self.model.tokenize(letters if letters.isascii() else letters.translate(self.letters))])

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        found = []
        for text in texts:
            if text and any(s in text for s in self.special):
                found.append(_packed_ids(self.tokenizer.encode(text, add_special_tokens=False).ids))
                continue
            # Lower case of A-Z is what the vocabulary itself does first.
            words, parts = (text or "").encode("utf-8", "surrogatepass").lower().split(), []
            for at in range(0, len(words), _WORDS):
                parts += map(self.known.__getitem__, words[at:at + _WORDS])
                if self.known.size > self.most:
                    self.known = self.known.followed()
            found.append(b"".join(parts))
        return found


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    """One for each worker process, so that later tasks know the words of earlier ones."""
    return _Encoder(path)


def tokenized_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: ids of each text and a closing 0, cut where longer than ``capacity``.

    A null text is an empty one: a single 0. Rows that repeat each have their pieces.
    ``vocabulary`` is a file every executor has.
    """

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(vocabulary)
        end = np.zeros(1, "<u4").tobytes()
        for batch in batches:
            out = []
            for first in range(0, len(batch), _TEXTS):
                some = batch.iloc[first:first + _TEXTS]
                for doc_id, ids in zip(some["doc_id"], encoder.ids(some["text"].tolist())):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at:at + 4 * capacity]
                        out.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            frame["doc_id"] = pd.array(frame["doc_id"], "Int64")
            yield frame

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInPandas(pieces, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item (1 to ``capacity``), items taken longest first."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    counts = np.zeros(capacity + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i in order.tolist():
        size = int(lengths[i])
        # Change of the sum of squares for each gap that has a bin and room; a filled bin counts no more.
        here, there = counts[size:], counts[:capacity + 1 - size]
        change = 2 * (there - here) + 2
        change[0] = 1 - 2 * here[0]
        change[here == 0] = np.iinfo(np.int64).max
        gap = size + int(np.argmin(change))
        if counts[gap]:
            b = by_gap[gap].pop()
            counts[gap] -= 1
        else:
            b, gap = made, capacity
            made += 1
        bins[i] = b
        rest = gap - size
        if rest:
            by_gap[rest].append(b)
            counts[rest] += 1
    return bins


def _packed(items: DataFrame, item: str, shards: int, capacity: int, level: int) -> DataFrame:
    """``item, bin, place``: shards packed apart; ``bin`` is ``[level, shard, number in it]`` in one long."""

    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        bins = sum_of_squares(rows["length"].to_numpy(), capacity)
        rows = rows.assign(bin=(level << 56) + (int(key[0]) << 32) + bins).sort_values(["bin", item])
        rows["place"] = rows.groupby("bin")["length"].cumsum() - rows["length"]
        return rows[[item, "bin", "place"]]

    # Item numbers are dense within a partition only, so they are hashed to even the shards out.
    dealt = items.select(item, "length", F.pmod(F.xxhash64(F.lit("shard"), item), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInPandas(pack, f"{item} long, bin long, place long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """All columns of ``pieces``, ``sequence_id`` and ``offset``.

    ``length`` is 1 to ``capacity``. Within a sequence offsets have no gap. Rows
    that repeat are packed each. An empty table gives no row. Bins that a
    round leaves open meet again as items of the next one, until all of them
    fit one shard or a round has joined none.
    """
    rows = stage(sheltered_pieces(pieces), "pieces")
    n = rows.count()
    items = rows.select("item", F.col("row.length").cast("long").alias("length"))
    packed = _packed(items, "item", max(1, -(-n // shard_items)), capacity, 0)
    placed = stage(packed.select("item", F.col("bin").alias("sequence_id"), F.col("place").alias("offset")), "packed")
    met, level = n, 0
    while met > shard_items:
        level += 1
        sizes = placed.join(items, "item").groupBy(F.col("sequence_id").alias("old")).agg(F.sum("length").alias("length"))
        loose = stage(sizes.filter(F.col("length") < capacity), "open")
        m = loose.count()
        if m < 2 or m >= met:
            break
        moved = stage(_packed(loose, "old", max(1, -(-m // shard_items)), capacity, level), "repacked")
        placed = stage(placed.join(moved, placed.sequence_id == moved.old, "left").select(
            "item", F.coalesce("bin", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("place", F.lit(0))).alias("offset"),
        ), "placed")
        met = m
    return rows.join(placed, "item").select("row.*", "sequence_id", "offset")


def sheltered_pieces(pieces: DataFrame) -> DataFrame:
    """Each row as ``row`` with a number ``item``; written down by the caller, so that numbers stay."""
    mine = [pieces[c] for c in pieces.columns if c not in ("sequence_id", "offset")]
    return pieces.select(F.struct(*mine).alias("row"), F.monotonically_increasing_id().alias("item"))


def packed_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Texts tokenized, cut and packed: see ``tokenized_pieces`` and ``pack``."""
    return pack(tokenized_pieces(docs, vocabulary, capacity), capacity)

"""License notices in texts: exact phrases, and short notices with errors.

A notice of a given number of allowed edits is cut into one piece more than
that: whatever is left of it after so many edits still holds one piece as it was.
All pieces of all notices are found in one pass of an Aho-Corasick automaton over
the words of a text; where one stands, the window in which its notice can lie is
matched by the regex library with the same bound on errors, which tells the span
and the edits.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.llm.common import sheltered

#: Phrases that name a license by themselves.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Short notices as licensors word them, with the label of each.
NOTICES = [
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("this work is licensed under the gnu general public license", "gpl"),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("made available under the terms of the eclipse public license", "epl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("distributed under the boost software license version 1 0", "boost"),
]
#: One edit for so many characters of a notice.
CHARS_PER_EDIT = 12
MOST_EDITS = 6
#: What of ASCII is no part of a word.
_BLANKS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


class Notice(NamedTuple):
    text: str
    label: str
    edits: int


class Found(NamedTuple):
    label: str
    first_word: int
    end_word: int
    edits: int
    start: int
    end: int


def allowed_edits(notice: str, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    return min(MOST_EDITS, len(notice) // chars_per_edit)


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII digits and letters and of characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BLANKS).split()


def pieces_of(notice: Notice) -> Iterator[tuple[int, str]]:
    """``(place, piece)``: the notice in ``edits + 1`` pieces of even length."""
    n, k = len(notice.text), notice.edits + 1
    for i in range(k):
        yield i * n // k, notice.text[i * n // k:(i + 1) * n // k]


class Scanner:
    """Automaton and matchers of some notices."""

    def __init__(self, notices: tuple[tuple[str, str], ...], chars_per_edit: int = CHARS_PER_EDIT):
        import ahocorasick
        import regex

        self.notices = [Notice(t, label, allowed_edits(t, chars_per_edit)) for t, label in notices]
        self.matchers = [
            regex.compile(rf"(?:{regex.escape(x.text, special_only=True)}){{e<={x.edits}}}", regex.BESTMATCH) for x in self.notices
        ]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(self.notices):
            for place, piece in pieces_of(notice):
                seeds.setdefault(piece, []).append((k, place))
        self.automaton = ahocorasick.Automaton()
        for piece, own in seeds.items():
            self.automaton.add_word(piece, (len(piece), own))
        if seeds:
            self.automaton.make_automaton()

    def windows(self, joined: str) -> Iterator[tuple[int, int, int]]:
        """``(notice, from, to)``: windows that hold every match, one for each run of seeds that tell of the same place."""
        spans: dict[int, list[list[int]]] = {}
        if not self.notices:
            return
        for last, (size, own) in self.automaton.iter(joined):
            for k, place in own:
                notice = self.notices[k]
                at = last + 1 - size - place
                low, high = max(0, at - notice.edits), min(len(joined), at + len(notice.text) + notice.edits)
                mine = spans.setdefault(k, [])
                # Seeds of one copy tell of starts within twice the edits of each other.
                if mine and low - mine[-1][0] <= 2 * notice.edits and low >= mine[-1][0]:
                    mine[-1][1] = max(mine[-1][1], high)
                else:
                    mine.append([low, high])
        for k, own in spans.items():
            for low, high in own:
                yield k, low, high

    def scan(self, words: list[bytes]) -> list[Found]:
        """Notices found: of those of one label that overlap the one of fewest edits, then the longest, then the first.

        Spans are in words and in characters of the words joined by one space.
        """
        joined = b" ".join(words).decode("utf-8", "surrogatepass")
        hits = set()
        for k, low, high in self.windows(joined):
            # Starts in one window lie closer than a notice is long, so it holds one copy.
            if m := self.matchers[k].search(joined, low, high):
                hits.add((sum(m.fuzzy_counts), m.start() - m.end(), m.start(), m.end(), self.notices[k].label))
        if not hits:
            return []
        starts, at = [], 0
        for w in joined.split(" "):
            starts.append(at)
            at += len(w) + 1
        chosen: dict[str, list[tuple[int, int]]] = {}
        out = []
        for edits, _, start, end, label in sorted(hits):
            taken = chosen.setdefault(label, [])
            i = bisect_right(taken, (start, end))
            if (i and taken[i - 1][1] > start) or (i < len(taken) and taken[i][0] < end):
                continue
            taken.insert(i, (start, end))
            out.append(Found(label, bisect_right(starts, start) - 1, bisect_left(starts, end), edits, start, end))
        return sorted(out, key=lambda f: (f.start, f.end, f.label))


@lru_cache(maxsize=4)
def scanner(notices: tuple[tuple[str, str], ...], chars_per_edit: int) -> Scanner:
    """One for each worker process."""
    return Scanner(notices, chars_per_edit)


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """``(word, label)`` of each place where the words of a phrase stand one after the other, in order."""
    joined = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases.items():
        own = b" " + phrase.encode() + b" "
        at, word, counted = joined.find(own), 0, 0
        while at >= 0:
            word += joined.count(b" ", counted, at)
            counted = at
            out.append((word, label))
            at = joined.find(own, at + 1)
    return sorted(out)


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, "
    "notices array<struct<label:string,first_word:int,end_word:int,edits:int,start:int,end:int>>"
)


def scan_licenses(
    docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, phrases: dict[str, str] = PHRASES,
    chars_per_edit: int = CHARS_PER_EDIT,
) -> DataFrame:
    """``row`` (all columns of ``docs``) and what its whole ``text`` says of licenses.

    ``n_words``; ``n_base``, ``first_word``, ``last_word``, ``base_labels`` of the
    exact phrases; ``notices``, each with label, words and characters it spans, and
    edits; ``labels`` of both, distinct and sorted; ``score``, 1 where a phrase or
    an exact notice stands, less by the share of allowed edits spent otherwise,
    0 where nothing does. A null or empty text has no words. Rows that repeat are
    scanned each; an empty table gives no row.
    """
    fixed = tuple((t, label) for t, label in notices)

    @F.pandas_udf(RESULT)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = scanner(fixed, chars_per_edit)
        bound = {}
        for notice in own.notices:
            bound[notice.label] = max(bound.get(notice.label, 0), notice.edits)
        for texts in batches:
            out = []
            for text in texts:
                words = words_of(text)
                places = phrase_places(words, phrases)
                found = own.scan(words) if words else []
                base = sorted({label for _, label in places})
                best = max((1 - f.edits / (bound[f.label] + 1) for f in found), default=0.0)
                out.append((
                    len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
                    base, sorted({*base, *(f.label for f in found)}), 1.0 if places else best, [f._asdict() for f in found],
                ))
            frame = pd.DataFrame(out, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"])
            for c in ("first_word", "last_word"):
                frame[c] = pd.array(frame[c], "Int64")
            yield frame

    return sheltered(docs).withColumn("told", scanned("row.text")).select("row", "told.*")

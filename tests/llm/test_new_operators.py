"""Conversation repair, license scans and ranked search against brute force, and on hard inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from lociweave.llm import conversations, licenses, ranking
from lociweave.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.01"
GRAMMAR = re.compile("(s?(ua)+)?")


# Conversation repair

def row_letters(rows):
    seen, out = set(), []
    for role, text in rows:
        blank = re.search("[^\x20\x09-\x0d]", text) is None
        fault = "blank" if blank else "duplicate" if (role, text) in seen else ""
        if not fault and re.search("[^\x20\x09-\x0d]", text[::-1])[0] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def every_audit(rows, faults, most_inserts):
    """All edit sequences with their cost, and whether their roles fit."""
    n = len(rows)
    for inserts in range(most_inserts + 1):
        for edits in product("DIKR", repeat=n + inserts):
            if edits.count("I") != inserts:
                continue
            cost, at, choices, bad = 0, 0, [], False
            for e in edits:
                if e == "I":
                    cost += 3
                    choices.append(("u", "a"))
                    continue
                fault, role = faults[at], rows[at][0]
                at += 1
                if e == "D":
                    cost += 4
                    continue
                bad |= fault in ("blank", "duplicate")
                cost += (3 if e == "R" else 0) + (3 if fault == "truncated" else 0)
                choices.append(("u", "a") if e == "R" else (role[:1],))
            if bad:
                continue
            if any(GRAMMAR.fullmatch("".join(c)) for c in product(*choices)):
                yield cost, "".join(edits)


@pytest.mark.parametrize("seed", range(4))
def test_cheapest_edits_by_trying_all(seed):
    rng = np.random.default_rng(seed)
    for _ in range(25):
        n = int(rng.integers(0, 4))
        rows = [(str(rng.choice(["system", "user", "assistant", "tool", " "])), str(rng.choice(["Yes.", "No", " ", "Fine!"]))) for _ in range(n)]
        faults = row_letters(rows)
        seen: set = set()
        pattern = ""
        for role, text in rows:
            pattern += conversations.row_class(role, text, (role, text) in seen)[1]
            seen.add((role, text))
        assert conversations.cheapest(pattern) == min(every_audit(rows, faults, 3))


def forward_only(pattern, start, ends):
    """Plain relaxation until nothing changes."""
    labels = {(0, start): (0, "")}
    for i in range(len(pattern) + 1):
        for _ in range(4):
            for q in range(4):
                if (i, q) in labels:
                    for j, p, more, edit in conversations._onward(pattern, i, q):
                        cost, audit = labels[i, q]
                        new = (cost + more, audit + edit)
                        if new < labels.get((j, p), (math.inf,)):
                            labels[j, p] = new
    return min((labels[len(pattern), q] for q in ends if (len(pattern), q) in labels), default=None)


def test_two_heaps_find_what_one_pass_finds():
    rng = np.random.default_rng(3)
    for _ in range(300):
        pattern = "".join(rng.choice(list("suaoxSUAO"), rng.integers(0, 30), p=[0.1, 0.25, 0.25, 0.05, 0.1, 0.05, 0.08, 0.08, 0.04]))
        for start in range(4):
            for ends in ((0, 3), (0,), (1,), (2,), (3,)):
                assert conversations.cheapest(pattern, start, ends) == forward_only(pattern, start, ends)


def conversation_by_hand(rows):
    """Summary of rows ``(turn, role, text)`` in order; the edits from one lattice over all of them."""
    faults = row_letters([(r, t) for _, r, t in rows])
    letters = {"blank": lambda r: "x", "duplicate": lambda r: "x", "truncated": lambda r: (r[:1] if r[:1] in "sua" and r else "o").upper()}
    pattern = "".join(letters.get(f, lambda r: r[:1] if r[:1] in ("s", "u", "a") else "o")(r) for f, (_, r, _) in zip(faults, rows))
    cost, audit = forward_only(pattern, 0, (0, 3))
    at, out, state = 0, [], ""
    for e in audit:
        nxt = "assistant" if state == "u" else "user"
        if e == "I":
            out.append((nxt, ""))
        else:
            _, role, text = rows[at]
            at += 1
            if e == "D":
                continue
            out.append((nxt if e == "R" else role, text))
        state = out[-1][0][:1]
    turns = [t for t, _, _ in rows if t is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }, out


def damage_by_hand(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        spell = lambda v: " " if v is None else str(v)
        act = zlib.crc32(f"{spell(conv)}:{spell(turn)}".encode()) % 20
        role, text = spell(role), spell(text)
        own = by[conv]
        if act == 0:
            continue
        if act == 1:
            text = ""
        if act == 2:
            text = re.sub("[.!?]", "", text)
        if act == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if act == 3 else 1)
    for own in by.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return by


CONVERSATIONS = "conv_id long, turn long, role string, text string, cost string, repeated int, dropped int"


def hard_conversations():
    rng = np.random.default_rng(9)
    roles, texts = ["system", "user", "assistant", "tool", "", None], ["Yes.", "No", None, "", " \t", "Fine!\n", "A\nb.", "é?", " "]
    rows = []
    for conv in [*range(60), None, 2**60 + 1]:
        for turn in sorted(rng.integers(-2, 9, rng.integers(1, 9)).tolist()):
            rows.append((conv, int(turn), roles[rng.integers(0, 6)], texts[rng.integers(0, 9)]))
    rows += [(700, None, "user", "No turn."), (700, None, "user", "No turn."), (700, 2**61, "assistant", "Late.")]
    # Longer than a segment, twice over; with one system turn, many repeats and a hundred rows of one turn.
    rows += [(800, t, ["user", "assistant"][(t + t // 97) % 2] if t else "system", f"Turn {t % 400}." + "x" * (t % 13 == 0)) for t in range(700)]
    rows += [(801, 5, "user", f"Same turn {t}.") for t in range(100)] + [(802, t, None, None) for t in range(600)]
    return rows


def test_repair_equals_the_plain_way(spark):
    rows = hard_conversations()
    given = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], CONVERSATIONS).repartition(7)
    damaged = conversations.damaged(given).select("*", F.lit("y").alias("audit")).drop("audit")
    told = conversations.repair(damaged, "dropped")
    got = {r.conv_id: r.asDict() for r in told.collect()}
    by = damage_by_hand(rows)
    assert set(got) == {r[0] for r in rows}
    turns = defaultdict(list)
    for r in conversations.repaired_turns(damaged, told, "dropped").orderBy("conv_id", "place").collect():
        assert r.place == len(turns[r.conv_id])
        turns[r.conv_id].append((r.role, r.text))
    for conv, mine in got.items():
        want, out = conversation_by_hand(by.get(conv, []))
        assert {k: mine[k] for k in want} == want, conv
        assert turns[conv] == out
        assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in out))


def test_damage_touches_rows_as_told(spark):
    rows = hard_conversations()
    damaged = conversations.damaged(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], CONVERSATIONS)).collect()
    got = Counter((r.conv_id, r.turn, r.role, r.text) for r in damaged if not r.dropped)
    assert got == Counter((conv, *r) for conv, own in damage_by_hand(rows).items() for r in own)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], CONVERSATIONS)
    assert conversations.repair(none).count() == 0
    gone = spark.createDataFrame([(1, 1, "user", "Yes.", True)], "conv_id long, turn long, role string, text string, dropped boolean")
    row = conversations.repair(gone, "dropped").first()
    assert row.repaired_sha256 == hashlib.sha256(b"").hexdigest() and row.audit == ""
    assert (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost) == (0,) * 6


def test_repair_query_over_its_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by, got = damage_by_hand(rows), QUERIES["op11_conversation_repair"](spark, SMALL).collect()
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        want, _ = conversation_by_hand(by.get(r.conv_id, []))
        assert {k: r[k] for k in want} == want


# License scans

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_by_hand(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base_by_hand(words):
    places = [
        (i, label) for i in range(len(words)) for p, label in licenses.PHRASES.items() if words[i:i + len(p.split())] == p.split()
    ]
    return sorted(places)


def edit(text, k, rng):
    letters = list(text)
    for _ in range(k):
        at, how = int(rng.integers(1, len(letters) - 1)), int(rng.integers(0, 3))
        if how == 0:
            del letters[at]
        elif how == 1:
            letters.insert(at, "q")
        else:
            letters[at] = "z"
    return "".join(letters)


def test_planted_notices_are_found_within_their_edits(spark):
    rng = np.random.default_rng(11)
    filler = "the river ran past quiet houses and old trees by the mill".split()
    docs, want = [], {}
    for i, (notice, label) in enumerate([x for x in licenses.NOTICES for _ in range(6)]):
        k = licenses.allowed_edits(notice)
        changed = edit(notice, int(rng.integers(0, k + 1)), rng)
        # A letter alone between blanks takes a blank with it.
        if least_edits(notice, " ".join(words_by_hand(changed))) > k:
            continue
        before, after = (" ".join(rng.choice(filler, 40)) for _ in range(2))
        docs.append((i, f"{before}\n{changed.upper()}, {after}", "x", "y"))
        want[i] = label
    docs += [(1000 + i, " ".join(rng.choice(filler, 200)), "x", "y") for i in range(50)]
    given = spark.createDataFrame(docs, "doc_id long, text string, row string, score string")
    got = {r.row.doc_id: r for r in licenses.scan_licenses(given).collect()}
    assert len(want) > 110
    texts = {d[0]: d[1] for d in docs}
    for i, label in want.items():
        assert label in got[i].labels and got[i].score > 0
        mine = [f for f in got[i].notices if f.label == label]
        joined = " ".join(words_by_hand(texts[i]))
        assert all(joined.startswith(" ".join(joined.split(" ")[f.first_word:f.end_word]), joined.rfind(" ", 0, f.start + 1) + 1) for f in mine)
    assert all(got[1000 + i].labels == [] and got[1000 + i].score == 0 and got[1000 + i].notices == [] for i in range(50))


def least_edits(notice, joined):
    """Fewest edits that turn the notice into some part of the text."""
    row = [0] * (len(joined) + 1)
    for i, c in enumerate(notice, 1):
        new = [i]
        for j, d in enumerate(joined, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_seeds_lose_no_notice():
    rng = np.random.default_rng(13)
    notices = tuple(licenses.NOTICES[:2] + licenses.NOTICES[7:10])
    own = licenses.Scanner(notices)
    for _ in range(150):
        notice, label = notices[rng.integers(0, len(notices))]
        text = edit("some words " + edit(notice, int(rng.integers(0, 7)), rng) + " follow here", 1, rng)
        words = licenses.words_of(text)
        joined = b" ".join(words).decode()
        got = {f.label: f.edits for f in own.scan(words)}
        want = {}
        for other, its in notices:
            d = least_edits(other, joined)
            if d <= licenses.allowed_edits(other):
                want[its] = min(d, want.get(its, 99))
        assert got == want


ODD = [
    (1, None), (2, ""), (3, " \n"), (4, "MIT License, mit license; MIT-LICENSE mit licenses"), (4, "MIT License, mit license; MIT-LICENSE mit licenses"),
    (5, "gnu general public license apache\x00license"), (None, "the mit license mit license"), (6, "MİT License é mit license"),
    (7, "mit " * 50_000 + "license"), (8, "Released under the MIT License. " * 3000), (9, "GENERAL PUBLIC\nLICENSE and Apache License"),
]


def test_base_places_by_hand(spark):
    given = spark.createDataFrame([(i, t, "r", 5) for i, t in ODD], "doc_id long, text string, n_words string, row int")
    found = licenses.scan_licenses(given)
    got = Counter((r.row.doc_id, r.row.text, r.n_words, r.n_base, r.first_word, r.last_word, tuple(r.base_labels)) for r in found.collect())
    want = Counter()
    for i, t in ODD:
        words = words_by_hand(t)
        at = base_by_hand(words)
        want[i, t, len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None, tuple(sorted({x for _, x in at}))] += 1
    assert got == want
    many = found.filter("row.doc_id = 8").first()
    assert len(many.notices) == 3000 and all(f.edits == 0 for f in many.notices) and many.score == 1
    assert licenses.scan_licenses(given.limit(0)).count() == 0
    assert licenses.scan_licenses(given, notices=[]).filter("size(notices) > 0").count() == 0


def test_license_query_over_its_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op12_license_scan"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        words = words_by_hand(texts[r.doc_id])
        at = base_by_hand(words)
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert {x for x in r.base_labels.split(",") if x} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert bool(r.labels) == (r.score > 0)


# Ranked search

def search_by_hand(docs, items, top=20):
    counts = [(i, Counter(words_by_hand(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        asked, rows = Counter(words_by_hand(text)), []
        for doc_id, c in counts:
            m = 75 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(
                k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, k in asked.items() if t in c
            )
            if s > 0:
                rows.append((-s, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(rows)[:top], 1)]
    return Counter(out)


DOCS = "doc_id long, text string, score string, rank int, item_id string"


def hard_documents():
    rng = np.random.default_rng(21)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "é", "xİ", "2024", "Ab-cd"]
    chosen = rng.zipf(1.4, 60_000) % len(vocabulary)
    docs, at = [], 0
    for i in range(400):
        n = int(rng.integers(1, 30))
        docs.append((i, " ".join(vocabulary[v] for v in chosen[at:at + n])))
        at += n
    # A third of all rows are copies; ids repeat, are null and are large.
    docs += [(2**60 + i, "W1 w2, w3 copies of one text") for i in range(250)] + [(7, "w1 w1 w39"), (7, "w1 w1 w39"), (None, "w1 w1 w39"), (None, "w39")]
    docs += [(900, None), (901, ""), (902, "--- ..."), (903, "w5 " * 100_000 + "w38")]
    items = [(i, " ".join(vocabulary[v] for v in rng.integers(0, len(vocabulary), rng.integers(1, 12)))) for i in range(30)]
    items += [(3, "w1 w1 w1 w2"), (3, "w1 w1 w1 w2"), (None, "w39 W39"), (50, None), (51, "..."), (52, "nowhere found"), (53, "copies nowhere")]
    return docs, items


@pytest.mark.parametrize("block_pairs", [ranking.BLOCK_PAIRS, 40])
def test_search_equals_all_documents_scored(spark, block_pairs):
    docs, items = hard_documents()
    d = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS).repartition(5)
    q = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string")
    got = Counter(tuple(r) for r in ranking.ranked_search(d, q, block_pairs=block_pairs).collect())
    assert got == search_by_hand(docs, items)


def test_search_of_nothing(spark):
    docs, items = hard_documents()
    d = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert ranking.ranked_search(d.limit(0), q).count() == 0
    nothing = ranking.ranked_search(d, q.limit(0))
    assert nothing.count() == 0 and nothing.columns == ["item_id", "rank", "doc_id", "score"]


def test_classes_hold_equal_bags_only(spark):
    docs, _ = hard_documents()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    terms = sorted({t.encode() for t in ["w1", "w2", "w3", "copies"]})
    bags = ranking._bags(d, terms)
    classes = ranking.bag_classes(bags, 650, 9000, top=3).collect()
    want = defaultdict(list)
    for i, t in docs:
        words = words_by_hand(t)
        own = tuple(sorted((k, words.count(x.decode())) for k, x in enumerate(terms) if x.decode() in words))
        if own:
            want[own, 75 + (25 * len(words) * 650) // 9000].append(i)
    got = {(tuple(map(tuple, np.frombuffer(r.bag, "<u4").reshape(-1, 2).tolist())), r.m): r.members for r in classes}
    assert got == {k: sorted(v, key=lambda x: (x is None, x))[:3] for k, v in want.items()}


def test_search_query_equals_its_sql(spark):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from read_parquet('{SMALL}/{table}.parquet')")
    want = con.sql(ORACLE_SQL["op13_ranked_search"])
    got = QUERIES["op13_ranked_search"](spark, SMALL)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())

"""The training-data operators against brute force, and on nulls, empty and long texts, ties, repeats and clashing names."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations, product

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lociweave.llm import attribution, chunks, embeddings, html, language, mixing, packing, quality, simhash, toxicity
from lociweave.llm.common import connected_components, fold
from lociweave.llm.queries import PATTERN, QUERIES, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, fp long, rank int"
LONG = " ".join(f"word{i % 977} and" for i in range(30_000)) + "."
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "One two three four five six seven eight nine ten.", "en", "a"),
    (4, "One two three four five six seven eight nine ten.", "en", "a"), (4, "Another text of one id.", "en", None),
    (5, LONG, "en", "b"), (6, "12345 --- ???", "en", None), (7, "Été déjà vu, naïve façon 😀😀.", "fr", "b"), (None, "No id at all here.", "fr", "c"),
    (8, "\x00\x1c   odd spaces here <|endoftext|> x", "fr", "c"), (9, "same same same same " * 40, "en", "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "r", "k", 1, 2) for i, t, lang, s in ODD], SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def components(nodes, linked):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in combinations(nodes, 2):
        if linked(a, b):
            a, b = sorted((find(a), find(b)))
            low[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fold_is_crc32_of_the_id_as_text(spark):
    ids = spark.range(200)
    assert [r[0] for r in ids.select(fold(F.col("id"), 4)).collect()] == [zlib.crc32(str(i).encode()) % 4 for i in range(200)]


# SimHash

def plain_fingerprint(text, size=3):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_of_odd_texts(odd):
    got = simhash.near_duplicates(odd).collect()
    assert Counter((r.doc_id, r.fp % (1 << 64)) for r in got) == Counter((i, plain_fingerprint(t)) for i, t, *_ in ODD)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}


@pytest.mark.parametrize("distance", [1, 2])
def test_fingerprint_links_equal_all_pairs(spark, distance, monkeypatch):
    rng = np.random.default_rng(distance)
    base = [int(x) for x in rng.integers(0, 1 << 63, 12)] + [0, (1 << 64) - 1]
    prints = {b ^ sum(1 << int(k) for k in rng.choice(64, n, replace=False)) for b, n in product(base, [0, 1, 2, 2, 3, 4, 5, 2, 1])}
    want = components(prints, lambda a, b: (a ^ b).bit_count() <= distance)
    rows = spark.createDataFrame([(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints], "fp long")
    for most in (0, 3, 1000):
        monkeypatch.setattr(simhash, "MOST_IN_KEY", most)
        got = defaultdict(set)
        for r in connected_components(simhash.linked(rows, distance)).collect():
            got[r.component].add(r.node % (1 << 64))
        groups = defaultdict(set)
        for p, c in want.items():
            groups[c].add(p)
        assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_one_of_each_group_stays(odd, none):
    kept = simhash.keep_one_each(odd)
    assert kept.columns == odd.columns and simhash.keep_one_each(none).count() == 0
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and 2 not in ids and 3 not in ids and ids[None] == 1 and all(n == 1 for n in ids.values() if n != ids[4])


def test_null_and_repeated_ids_lose_no_unlike_text(spark):
    say = lambda k: " ".join(f"w{k}x{i * i % 89}" for i in range(60))
    given = [(None, say(1)), (None, say(2)), (None, say(2)), (None, say(3)), (7, say(4)), (7, say(5)), (7, say(5)), (9, say(5)), (None, say(6)), (3, say(6))]
    fps = {t: plain_fingerprint(t) for _, t in given}
    assert min((a ^ b).bit_count() for a, b in combinations(fps.values(), 2)) > 2
    kept = simhash.keep_one_each(spark.createDataFrame(given, "doc_id long, text string"))
    want = [(None, say(1)), (None, say(2)), (None, say(3)), (7, say(4)), (7, say(5)), (3, say(6))]
    assert Counter(map(tuple, kept.collect())) == Counter(want)


# Chunks

def test_gear_hash_and_cuts_follow_the_rolling_rule():
    data = (LONG + "äöü" * 300 + "x" * 5000).encode()
    h, plain = 0, []
    for b in data:
        h = (2 * h + int(chunks._GEAR[b])) & 0xFFFF
        plain.append(h)
    assert chunks._rolled(np.frombuffer(data, np.uint8)).tolist() == plain
    ends = chunks.cut_places(data)
    assert ends[-1] == len(data) and max(np.diff([0, *ends])) <= chunks.MOST and chunks.cut_places(b"") == []
    for a, b in zip([0, *ends], ends):
        data[a:b].decode()


def test_cuts_resist_insertions_and_long_texts_are_cut_as_in_parts(monkeypatch):
    whole = LONG.encode()
    shifted = b"Something new. " + whole
    there, here = chunks.cut_places(whole), [e - 15 for e in chunks.cut_places(shifted)]
    assert set(there[5:]) <= set(here)
    monkeypatch.setattr(chunks, "_PART", 1000)
    assert chunks.cut_places(whole) == there


def test_passage_is_cut_from_all_but_the_first(spark, rows):
    rng = np.random.default_rng(3)
    say = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(n))
    passage = say(60)
    texts = {i: f"{say(40)} {passage} {say(40)}" if i < 6 else say(150) for i in range(12)}
    docs = spark.createDataFrame([(i, t, len(t), "x") for i, t in texts.items()], "doc_id long, text string, n_chars long, start string")
    found = chunks.repeated_passages(docs).collect()
    assert {r.doc_id for r in found} == set(range(6)) and {r.doc_id for r in found if r.kept} == {0}
    for r in found:
        assert texts[r.doc_id][r.start:r.start + r.n_chars] in texts[0]
    out = {r.doc_id: r for r in chunks.drop_repeats(docs).collect()}
    assert all(out[i].text == texts[i] for i in [0, *range(6, 12)]) and all(r.n_chars == len(r.text) for r in out.values())
    for i in range(1, 6):
        assert passage not in out[i].text and len(out[i].text) < len(texts[i]) - 150
        assert out[i].text[:100] == texts[i][:100] and out[i].text[-100:] == texts[i][-100:]


def test_chunks_of_odd_rows(odd, none):
    assert chunks.repeated_passages(none).count() == 0 and chunks.drop_repeats(none).count() == 0
    out = chunks.drop_repeats(odd)
    assert out.columns == odd.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(i for i, *_ in ODD)


# Language

def test_gram_counts_equal_a_plain_count(monkeypatch):
    text = "Été déjà-vu, 3x ab\nÄb c"
    want = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f"\x01{word}\x01"
        want.update((c,) for c in word)
        want.update(tuple(padded[i:i + 2]) for i in range(len(padded) - 1))
        want.update(tuple(padded[i:i + 3]) for i in range(len(padded) - 2))
    number = lambda g: int(sum(ord(c) << 21 * k for k, c in enumerate(reversed(g))))
    for part in (1 << 20, 5, 7):
        monkeypatch.setattr(language, "_PART", part)
        assert dict(zip(*(x.tolist() for x in language._gram_counts(text)))) == {number(g): n for g, n in want.items()}


def test_languages_of_odd_rows(odd, none):
    profiles = language.learn_profiles(odd)
    told = {(r.row.doc_id, r.row.text): r for r in language.identify(odd, profiles).collect()}
    for key in [(1, None), (2, ""), (3, " \n\t "), (6, "12345 --- ???")]:
        assert (told[key].lang_pred, told[key].score) == ("und", 0.0)
    assert told[5, LONG].lang_pred == "en" and all(0 <= r.score <= 1 for r in told.values())
    assert language.keep_identified(none).count() == 0 and language.keep_identified(odd).columns == odd.columns
    assert {r.lang_pred for r in language.identify(odd, none.selectExpr("lang", "doc_id gram", "doc_id place")).collect()} == {"und"}


FINNISH = (
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on "
    "toimittava toisiaan kohtaan veljeyden hengessä."
)


def test_unlearned_languages_and_gibberish_go_and_prose_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = np.random.default_rng(3)
    letters = list("qwxzjkvbpfghyucmlrtdnsaeio")
    junk = [" ".join("".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(n)) for n in (30, 100, 1000)]
    planted = [FINNISH, FINNISH * 20, *junk, "z" * 300, "12 34"]
    rows = [(-1 - i, t, None, "planted", len(t)) for i, t in enumerate(planted)]
    both = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(
        *[F.col(c).cast(docs.schema[c].dataType) for c in docs.columns]))
    kept = {r.doc_id for r in language.keep_identified(both).select("doc_id").collect()}
    assert not {i for i in kept if i < 0}
    lettered = {r.doc_id for r in docs.collect() if r.text and re.search(r"[^\W\d_]", r.text)}
    assert kept == lettered


def test_limits_of_lengths_without_rows(spark):
    rows = spark.createDataFrame([(f"{w} the cat and the dog went to the house of the man", "en") for w in "abcdefgh"], "text string, lang string")
    profiles = language._profiles(rows.select("lang", "text"), 300)
    least = language.least_scores(rows, profiles).collect()
    assert sorted(r.length_class for r in least) == list(range(language.SHORTEST, language.LONGEST + 1))
    assert all(0 < r.least < 1 for r in least) and len({round(r.least, 6) for r in least}) == 1


def test_every_labelled_row_teaches(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "concat('word ', id) as text", "if(id < 8000, 'en', null) as lang")
    assert language.learning_rows(docs).count() == 8000
    late = docs.withColumn("text", F.expr("if(doc_id < 7990, 'ab', repeat('q', 5000))"))
    first = language.learn_profiles(late).filter("place = 0").collect()
    assert [(r.lang, r.gram & ((1 << 21) - 1)) for r in first] == [("en", ord("q"))]


# Mixing

def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got, full = {s: 0.0 for s in names}, set()
    left = float(sum(sizes.values()))
    while left > 1e-9:
        open_ = [s for s in names if s not in full]
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in open_:
            got[s] += share * weight[s]
            if got[s] >= most * sizes[s]:
                left += got[s] - most * sizes[s]
                got[s] = float(most * sizes[s])
                full.add(s)
    return got


def test_targets_are_reshared_until_none_is_above(spark):
    sizes = {"b": 1000, "a": 1, "ä": 5, "c": 0, None: 30, "d": 700, "Z": 2}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_permutation_of_any_length(spark):
    for n in (1, 2, 7, 64, 1000):
        x = mixing._permuted(F.col("id"), F.lit(n).cast("long"), F.lit(1), F.lit(2))
        assert sorted(r[0] for r in spark.range(n).select(x).collect()) == list(range(n))


def test_mix_meets_targets_and_reruns_agree(spark):
    rng = np.random.default_rng(1)
    docs = [(i, " ".join(["w"] * int(rng.integers(0, 400))) or None, None if i % 9 == 0 else f"s{i % 4}") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    first = mixing.taken_words(df, block_words=16, shard_slots=64).collect()
    again = mixing.taken_words(df.repartition(7), block_words=16, shard_slots=64).collect()
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, again), key=repr)
    taken, size = Counter(), Counter()
    for r in first:
        assert r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        size[r.source] += r["size"]
    for source, target in plain_targets(size).items():
        assert abs(taken[source] - target) <= 17
    mixed = mixing.mixed_documents(df, block_words=16, shard_slots=64)
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == Counter({r.doc_id: r.taken for r in first if r.taken})


def test_repeated_rows_keep_their_own_columns(spark):
    rows = [(1, "one two three", "a", "en", "x1"), (1, "one two three", "a", "fr", "x2"), (1, "one two three", "a", "fr", "x2"), (1, "one two three", "a", None, "x3")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, text_key string")
    # One source takes all of its own size: each row once.
    assert Counter(map(tuple, mixing.mixed_documents(df).collect())) == Counter(rows)
    kept = {tuple(simhash.keep_one_each(df.repartition(n)).collect()[0]) for n in (1, 3)}
    assert len(kept) == 1 and kept <= set(rows)


def test_running_numbers_of_a_source_have_no_gap(spark):
    planned = mixing._plan_sources(mixing.source_targets(spark.createDataFrame([("a", 9000), ("b", 20_000), ("c", 100)], "source string, size long")), 4)
    slots = {r["rank"]: r.n_slots for r in planned.collect()}
    got = {}
    for r in mixing.slot_draws(planned, shard_slots=16).collect():
        got.setdefault(r["rank"], []).append(r.t)
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(n)) for k, n in slots.items() if n}


def test_mix_of_odd_rows(odd, none):
    assert mixing.taken_words(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    got = mixing.taken_words(odd).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t, *_ in ODD)
    assert mixing.mixed_documents(odd).columns == odd.columns


# Packing

def test_pieces_are_the_tokenizers_own(odd):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = Counter()
    for i, text, *_ in ODD:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            want[i, piece, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes())] += 1
    packed = packing.packed_documents(odd, vocabulary("word_bpe_49k.json")).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    gapless(packed, 2048)


def test_remembered_words_change_no_ids():
    from tokenizers import Tokenizer

    rng = np.random.default_rng(8)
    signs = list("abcdefgh") * 3 + list("ÀÉßœÿ×÷İſéñü'.,-!0189ΣЖ中") + ["'s", "e\u0301", "\u00a0", "\x1c", "\u2028"]
    texts = [" ".join("".join(rng.choice(signs, rng.integers(1, 9))) for _ in range(60)) for _ in range(120)]
    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    # A memory of a few words turns over in every batch; a larger one meets its older half.
    for most in (2_000, 100_000, packing.CACHE_BYTES):
        encoder = packing._Encoder(vocabulary("word_bpe_49k.json"), most)
        got = [ids for _ in range(2) for at in range(0, 120, 7) for ids in encoder.ids(texts[at:at + 7])]
        assert got == want * 2
        assert encoder.known.size <= most // 2


def test_open_bins_meet_until_one_shard_is_left(spark):
    rng = np.random.default_rng(6)
    pieces = spark.createDataFrame([(int(x),) for x in rng.integers(30, 101, 2000)], "length long")
    packed = packing.pack(pieces, 100, shard_items=40).collect()
    assert len(packed) == 2000
    gapless(packed, 100)
    sizes = Counter()
    for r in packed:
        sizes[r.sequence_id] += r.length
    # Shards of 40 hard items lose some matches that one pass over all would find.
    whole = packing.sum_of_squares(np.array([r.length for r in packed]), 100)
    assert len(sizes) <= 1.05 * (whole.max() + 1) and len({s >> 56 for s in sizes}) > 2


def gapless(packed, capacity):
    by = defaultdict(list)
    for r in packed:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_sum_of_squares_follows_its_rule():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 21, 120)
    got = packing.sum_of_squares(lengths, 20)
    gaps, opened = {}, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        counts = Counter(g for g in gaps.values() if g)

        def squares(gap, size=int(lengths[i]), counts=counts):
            after = counts.copy()
            after[gap] -= gap < 20 or counts[gap] > 0
            after[gap - size] += gap > size
            return sum(n * n for n in after.values() if n > 0), gap

        # A new bin is opened where no open one has room.
        choices = sorted(g for g in counts if g >= lengths[i]) or [20]
        gap = min(choices, key=squares)
        assert gaps.get(got[i], 20) == gap
        gaps[got[i]] = gap - int(lengths[i])
    assert sum(lengths[got == b].sum() > 20 for b in set(got)) == 0


def test_shards_meet_again(spark):
    rng = np.random.default_rng(4)
    pieces = spark.createDataFrame([(int(x), "kept") for x in rng.integers(1, 101, 3000)], "length long, offset string")
    packed = packing.pack(pieces, 100, shard_items=500).collect()
    assert len(packed) == 3000
    assert gapless(packed, 100) <= 1.04 * sum(r.length for r in packed) / 100


def test_packing_nothing(none):
    assert packing.packed_documents(none, vocabulary("word_bpe_49k.json")).count() == 0


# Embeddings

def test_double_vectors_keep_their_precision(spark):
    close = np.cos(np.arccos(0.93) + np.array([-1e-9, 1e-9]))
    rows = [(1, [1e39, 0.0], 0), (2, [2e39, 0.0], 0), (3, [1e-50, 0.0], 0), (4, [5.0, 0.0], 0), (5, [0.0, -3e200], 0)]
    # Two that single precision cannot tell from the threshold: one just within it, one just beyond.
    rows += [(6, [1.0, 0.0], 1), (7, [float(close[0]), float(np.sqrt(1 - close[0] ** 2))], 1)]
    rows += [(8, [1.0, 0.0], 2), (9, [float(close[1]), float(np.sqrt(1 - close[1] ** 2))], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    assert got == {
        1: (3, 1, True), 2: (3, 1, False), 3: (3, 1, False), 4: (3, 1, False), 5: (0, 5, True),
        6: (1, 6, True), 7: (1, 6, False), 8: (0, 8, True), 9: (0, 9, True),
    }


def test_vectors_link_as_all_pairs_do(spark):
    rng = np.random.default_rng(5)
    rows, at = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            base = rng.standard_normal(16)
            for _ in range(int(rng.integers(1, 60))):
                rows.append((at, (base + rng.standard_normal(16) * 0.12).astype("float32").tolist(), label))
                at += 1
    rows += [(at, rows[0][1], 0), (at + 1, rows[0][1], 1), (at + 2, [0.0] * 16, 0), (at + 3, [], 0), (at + 4, None, 0)]
    rows += [(at + 5, [float("nan")] + [1.0] * 15, 0), (at + 6, [None] + [1.0] * 15, 0), (at + 7, [float("inf")] * 16, 0), (at + 8, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, cls string")
    fine = {
        i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v, label in rows
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v)
    }
    label = {i: lab for i, _, lab in rows}
    linked = lambda a, b: a in fine and b in fine and label[a] == label[b] and len(fine[a]) == len(fine[b]) and fine[a] @ fine[b] >= 0.93
    want = components(list(label), linked)
    links = Counter(x for a, b in combinations(label, 2) if linked(a, b) for x in (a, b))
    for window in (8, 64):
        got = {r.vec_id: r for r in embeddings.near_duplicates(df, window=window).collect()}
        assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (links[i], want[i], want[i] == i) for i in label}
    assert embeddings.near_duplicates(df.filter("vec_id < 0")).count() == 0


def test_lone_pairs_at_the_threshold_are_found(spark):
    rng = np.random.default_rng(15)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9301 * a + np.sqrt(1 - 0.9301 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([a, b]).astype("float32"))], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, window=2).collect()}
    lost = sum((got[i].n_links, got[i + 2000].component_id, got[i + 2000].kept) != (1, i, False) for i in range(2000))
    assert lost <= 2000 * (1 - embeddings.RECALL)


def test_passes_follow_the_rows():
    alike = 1 - np.arccos(0.93) / np.pi
    for rows in (100, 5_700, 100_000, 10_000_000):
        n = embeddings.passes_for(rows)
        assert n >= embeddings.PASSES and (1 - alike ** np.log2(rows / embeddings.WINDOW)) ** n <= 1 - embeddings.RECALL


# Toxicity

def test_maximal_segments_equal_the_definition():
    rng = np.random.default_rng(6)
    for _ in range(60):
        scores = np.where(rng.random(40) < 0.3, rng.integers(1, 24, 40) / 8, 0.0)
        full = np.where(scores > 0, scores, -0.5)
        # Repeatedly the best segment, then what lies left and right of it.
        def best(a, b):
            if a >= b:
                return []
            s, x, y = max(((round(float(full[x:y].sum()), 9), x, y) for x in range(a, b) for y in range(x + 1, b + 1)), key=lambda t: (t[0], t[1] - t[2]))
            return best(a, x) + [(x, y, s)] + best(y, b) if s > 0 else []
        got = toxicity.maximal_segments(scores, 0.5)
        assert round(sum(s for *_, s in got), 6) == round(sum(s for *_, s in best(0, 40)), 6)
        assert max((s for *_, s in got), default=0) == pytest.approx(max((s for *_, s in best(0, 40)), default=0))


def odds_by_brute_force(units, ratio):
    """Numerators from the shortest prefix on, each prior what the longest scored prefix tells."""
    from fractions import Fraction

    told, out = {"": (Fraction(1, 2), Fraction(1, 2))}, {}
    for unit, is_word, toxic, clean in sorted(units, key=lambda u: (u[1], len(u[0]), u[0])):
        best = max((p for p in told if unit.startswith(p) and len(p) <= 8 and (is_word or p != unit)), key=len)
        bad, good = toxic + 2 * told[best][0], clean * Fraction(ratio) + 2 * told[best][1]
        out[unit, is_word] = float(np.log(float(bad)) - np.log(float(good)))
        if not is_word and bad >= good * Fraction(np.e):
            told[unit] = (bad / (bad + good), good / (bad + good))
    return out


@pytest.mark.parametrize("hot", [0, 5, 500, 5000, 10**9])
def test_log_odds_by_brute_force(hot):
    units = [("vilewordly"[:n], False, 40 + hot, 0) for n in range(3, 9)] + [("vilewordly", True, 30 + hot, 0), ("vileword", True, 10, 0)]
    units += [("vim", False, 3, 50), ("vim", True, 1, 50), ("other", True, 8, 2), ("oth", False, 9, 3), ("a", True, 20, 1)]
    words, stems = toxicity._log_odds(units, 0.5)
    want = odds_by_brute_force(units, 0.5)
    for unit, is_word, *_ in units:
        got = (words if is_word else stems).get(unit, 0.0)
        odds = want[unit, is_word]
        assert got == pytest.approx(odds if odds >= toxicity.LEAST_ODDS else 0.0, rel=1e-9)
        assert np.isfinite(got)


def test_scale_solves_its_equation():
    counts, total = Counter({0.5: 40, 2.0: 9, 4.5: 1}), 5000
    x = toxicity._solved_scale(counts, total)
    tokens = [s for s, n in counts.items() for _ in range(n)] + [max(counts)] + [-toxicity.DRIFT] * (total + 1 - 50)
    assert np.mean(np.exp(x * np.array(tokens))) == pytest.approx(1, abs=1e-6)


def test_toxicity_of_hot_stems_and_of_one_class(spark):
    fill = "the river ran past quiet houses and old trees by the mill".split()
    rng = np.random.default_rng(12)
    docs = [(i, " ".join([*rng.choice(fill, 20), str(i), "scumbags" if i % 2 else "kindness", f"w{i}", *rng.choice(fill, 9)])) for i in range(3000)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    both = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, toxic int")
    told = toxicity.score(d, toxicity.learn(d, both)).select("row.doc_id", "score").collect()
    assert all((r.score >= toxicity.LIMIT) == (r.doc_id % 2 == 1) for r in told)
    for one in (0, 1):
        scores = {r.score for r in toxicity.score(d, toxicity.learn(d, both.withColumn("toxic", F.lit(one)))).collect()}
        assert all(0 <= s <= 1 for s in scores) and all(s < toxicity.LIMIT for s in scores)


def test_toxic_passages_are_found(spark, odd, none):
    rng = np.random.default_rng(7)
    plain, bad = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)], ["vilea", "vileb", "vilec", "viled"]
    docs, labels = [], []
    for i in range(400):
        words = rng.choice(plain, 120).tolist()
        if i % 4 == 0:
            for k in rng.integers(0, 120, 4):
                words[k] = str(rng.choice(bad))
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(i % 4 == 0)))
    docs += [(900, " ".join(plain[:50] + ["vilezz", "vileyy", "vilexx"] + plain[:50]), "x"), (901, None, "x"), (902, "", "x")]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(d.filter("doc_id < 300"), lab)
    got = {r.row.doc_id: r for r in toxicity.score(d, model).collect()}
    assert all((got[i].score >= toxicity.LIMIT) == (i % 4 == 0) for i in range(300, 400))
    assert got[900].score > got[301].score and got[900].n_passages >= 1 and 49 <= got[900].passages[0].first <= 50
    assert got[901].score == got[902].score == min(r.score for r in got.values())
    empty = toxicity.learn(none, none.selectExpr("doc_id", "cast(rank as int) toxic"))
    assert len({r.score for r in toxicity.score(odd, empty).collect()}) == 1


# Pages

def test_minimum_cut_equals_all_labellings():
    rng = np.random.default_rng(8)
    for _ in range(40):
        n = int(rng.integers(1, 9))
        costs = rng.normal(size=n).tolist()
        edges = [(a, b, float(rng.random())) for a, b in combinations(range(n), 2) if rng.random() < 0.5]
        price = lambda y: sum(abs(c) for c, v in zip(costs, y) if (c > 0) != v) + sum(w for a, b, w in edges if y[a] != y[b])
        assert price(html.minimum_cut(costs, edges)) == pytest.approx(min(map(price, product([False, True], repeat=n))))


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site work for you, dear reader.</div><main><article><h1>A title &amp; more</h1>
<p>First   paragraph of the text, with a <a href="z">link</a> in it and some more words.<p>Second &lt;one&gt;<br>goes on &eacute; here, quite long enough to count.
<!-- <p>not me</p> --><div class="ad">Buy now, best price of all.</div><ul><li>An item of the list in the article.</li></ul><p hidden>Unseen words here.</p>
<form><label>Your name</label><input value=q><button>Send</button></form></article><section id="comments"><p>Great article, I liked it very much indeed.</p></section></main>
<aside><p>Related stories that you may like to read too.</p></aside><footer>&copy; 2020 Someone, all rights reserved.</footer>"""


def test_article_is_extracted(spark):
    want = "A title & more\nFirst paragraph of the text, with a link in it and some more words.\nSecond <one> goes on é here, quite long enough to count.\nAn item of the list in the article."
    pages = spark.createDataFrame([(1, PAGE, "t"), (2, None, "t"), (3, "", "t"), (4, "<", "t"), (5, "<p>Only words, with no end &am", "t")], "page_id long, html string, text string")
    got = {r.row.page_id: r.text for r in html.extract(pages).collect()}
    assert got[1] == want and got[2] == got[3] == "" and html.extract(pages.limit(0)).count() == 0
    assert "".join(got[5].split()).startswith("Onlywords") or got[5] == ""


SHAPE = (
    '<html><body><nav><a href=x>Home</a></nav><{0}><h2>A heading of it</h2><p>This is the first paragraph of a longer text, with quite a few words'
    ' in it.</p><p>Short one.</p><p>And here comes another paragraph, which also has enough words to be read.</p></{1}><footer>(c) Someone</footer>'
)
PROSE = (
    "A heading of it\nThis is the first paragraph of a longer text, with quite a few words in it.\nShort one.\n"
    "And here comes another paragraph, which also has enough words to be read."
)


@pytest.mark.parametrize("name", ["legal", "side", "notice-board", "hidden-gems", "search-engines", "tags", "x3", "post"])
def test_a_doubtful_name_does_not_empty_an_article(name):
    assert html.main_text(SHAPE.format(f'article class="{name}"', "article")) == PROSE


@pytest.mark.parametrize("name", ["sidebar", "cookie-notice", "comments", "newsletter", "legal", "share"])
def test_names_of_boilerplate_still_tell(name):
    assert html.main_text(SHAPE.format(f'div class="{name}"', "div")) == ""


def test_the_cut_turns_what_stands_among_the_other_kind():
    page = SHAPE.format("div class=x3", "div")
    signs = [b.cost > 0 for b in html.blocks_of(page)]
    labels = [keep for _, keep in html.labelled_blocks(page)]
    # The heading alone looks like boilerplate.
    assert signs == [False, False, True, True, True, False] and labels == [False, True, True, True, True, False]
    assert html.main_text(page) == PROSE


def test_formulas_and_buttons_of_the_text_stay():
    page = "<article><p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is what the <button>Run</button> key gives you here.</p></article>"
    assert html.main_text(page) == "The sum a+b is what the Run key gives you here."


def test_large_page_is_cut_in_time():
    big = "<article>" + "".join(f"<p>Paragraph {i} of a page that goes on for very long, and then some.</p>" for i in range(5000)) + "</article><footer>End</footer>"
    assert html.main_text(big).count("\n") == 4999


# Quality

def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    held = {k for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(held)


def test_base_counts_equal_plain_ones(odd, none):
    told = quality.judge(odd).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in told) == Counter(
        (i, *plain_counts(t)) for i, t, *_ in ODD
    )
    assert all(not (r.kept and r.base_failed) for r in told) and quality.judge(none).count() == 0


def test_junk_goes_and_prose_stays(spark):
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 9))))
    prose = [(i, ". ".join(" ".join(word() for _ in range(12)) for _ in range(8)) + ".") for i in range(80)]
    junk = [(100 + i, " | ".join(word() + "###" for _ in range(60))) for i in range(12)]
    kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(prose + junk, "doc_id long, text string")).collect()}
    assert all(kept[i] for i, _ in prose) and not any(kept[i] for i, _ in junk)


def plain_fit(votes, rounds=3000):
    """Share and rates by expectation-maximisation over single documents."""
    one_hot = np.stack([votes == v for v in (1, 0, -1)], axis=2).astype(float)
    p = ((votes == 1).sum(1) + 1) / ((votes != 0).sum(1) + 2)
    for _ in range(rounds):
        good, bad = ((np.einsum("d,dkv->kv", w, one_hot) + more) / (w.sum() + 6) for w, more in ((p, [4, 1, 1]), (1 - p, [1, 1, 4])))
        share = (p.sum() + 1) / (len(p) + 2)
        odds = np.log(share / (1 - share)) + np.einsum("dkv,kv->d", one_hot, np.log(good) - np.log(bad))
        p = 1 / (1 + np.exp(-odds))
    return share, good, bad, p


def test_rules_of_planted_accuracy_are_told_apart(spark):
    rng = np.random.default_rng(5)
    truth = rng.random(6000) < 0.7
    right, silent = [0.95, 0.9, 0.9, 0.85, 0.8, 0.7, 0.55], [0, 0.1, 0.3, 0.2, 0.5, 0.05, 0]
    said = np.where(rng.random((6000, 7)) < right, truth[:, None], ~truth[:, None])
    votes = np.where(rng.random((6000, 7)) < silent, 0, np.where(said, 1, -1))
    names = [f"vote_{k}" for k in range(7)]
    voted = spark.createDataFrame([(i, bool(t), *map(int, v)) for i, (t, v) in enumerate(zip(truth, votes))],
                                  f"doc_id long, truth boolean, {', '.join(f'{n} int' for n in names)}")
    share, rates = quality.fit_votes(voted.groupBy(*names).agg(F.count("*").alias("n")), names)
    want = plain_fit(votes)
    assert abs(share - want[0]) < 1e-3 and abs(share - truth.mean()) < 0.02
    for k, n in enumerate(names):
        for y, told in (("good", want[1]), ("bad", want[2])):
            assert np.allclose([rates[n][y][v] for v in (1, 0, -1)], told[k], atol=2e-3), (n, y)
        assert abs(rates[n]["good"][1] / (1 - rates[n]["good"][0]) - right[k]) < 0.03
    got = {r.doc_id: r for r in quality.posterior_quality(voted).collect()}
    assert max(abs(got[i].posterior - want[3][i]) for i in range(6000)) < 0.01
    wrong = sum((r.posterior >= 0.5) != r.truth for r in got.values())
    majority = sum((v.sum() >= 0) != t for v, t in zip(votes, truth))
    one_bad = [r.truth for r, v in zip(got.values(), votes) if (v == -1).sum() == 1 and v[5] == -1 and (v == 1).sum() >= 4]
    assert wrong < 0.6 * majority and len(one_bad) > 200
    assert all(got[i].posterior >= 0.5 for i, v in enumerate(votes) if v[5] == -1 and (np.delete(v, 5) == 1).all())


def test_tables_of_one_kind_and_variety_of_long_texts(spark):
    names = [f"vote_{n}" for n, _, _ in quality.RULES]
    for vote, kept in ((1, True), (-1, False), (0, True)):
        alike = spark.createDataFrame([(i, *[vote] * len(names)) for i in range(50)], f"doc_id long, {', '.join(f'{n} int' for n in names)}")
        assert {r.posterior >= 0.5 for r in quality.posterior_quality(alike).collect()} == {kept}
    fresh = lambda n: " ".join(f"w{i}" for i in range(n))
    texts = [(n * 10 + k, text) for n in (99, 100, 101, 250, 5000) for k, text in ((0, fresh(n)), (1, " ".join(["a", "b"] * (n // 2))))]
    for r in quality.votes(quality.base_features(spark.createDataFrame(texts, "doc_id long, text string"))).collect():
        assert r.vote_variety == (1 if r.doc_id % 10 == 0 else -1), r
        words = dict(texts)[r.doc_id].split()
        assert r.n_fresh == sum(len(set(words[i:i + 100])) for i in range(0, len(words), 100))


# Token counts

@pytest.mark.parametrize("rule", ["start", "most"])
def test_tokens_of_sections_equal_the_offsets(odd, none, rule):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    fields, path = ["source", "lang", "text"], vocabulary("byte_bpe_50k.tiktoken")
    got = Counter()
    for r in attribution.attribute_tokens(odd, fields, path, PATTERN, rule).collect():
        got[r.row.doc_id, r.row.text, r.field, r.section] += r.n_tokens
    assert attribution.attribute_tokens(none, fields, path, PATTERN, rule).count() == 0
    times = Counter((i, t) for i, t, *_ in ODD)
    for i, text, lang, source in ODD:
        parts = [(n, v) for n, v in (("source", source), ("lang", lang), ("text", text)) if v is not None]
        whole, spans = attribution._sections(parts)
        assert whole == "\n".join(v for _, v in parts)
        want, low = {}, 0
        encoded = plain.encode(whole, add_special_tokens=False).offsets if len(whole) < 5000 else None
        if encoded is None or "😀" in whole:
            continue
        for n, k, high in spans:
            want[n, k] = 0
        for a, b in encoded:
            share = [(min(b, high) - max(a, low), -j) for j, (low, high) in enumerate(zip([0, *[s[2] for s in spans]], [s[2] for s in spans]))]
            j = next((j for j, s in enumerate(spans) if a < s[2]), len(spans) - 1) if rule == "start" else -max(share)[1]
            want[spans[j][:2]] += 1
        assert {key[2:]: n // times[i, text] for key, n in got.items() if key[:2] == (i, text)} == want


# The whole

def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_path_factory):
    import corpus_pipeline

    folder = str(tmp_path_factory.mktemp("corpus"))
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    given.write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {r.doc_id: r.text for r in docs.collect()}
    at = 1
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, folder).collect()}
    assert kept == {i for i, t in ids.items() if t and re.search(r"[^\W\d_]", t)}
    fps = {i: plain_fingerprint(ids[i]) for i in kept}
    comp = components(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    second = corpus_pipeline.simhash_near_dedup(spark, docs.filter(F.col("doc_id").isin(list(kept))), folder)
    assert {r.doc_id for r in second.collect()} == set(comp.values())
    out = corpus_pipeline.run(spark, folder)
    assert out.count() >= at and gapless(out.collect(), 2048) and {r.doc_id for r in out.collect()} <= set(comp.values())
    for name, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, docs, folder).columns == docs.columns, name


def test_every_query_has_a_name_of_its_number():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "pipeline"} == set(range(1, 14))

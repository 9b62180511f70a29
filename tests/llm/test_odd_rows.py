"""Rows without ids, repeated ids, ids of unlike texts, and groups beyond the sizes that one task compares."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave.llm import mixing, near_duplicates, quality, repeated_bytes, toxicity
from tests.llm.test_operators import brute_components, brute_repeats, prose


def test_rows_without_ids_draw_apart(spark):
    rows = [(None if i % 2 else 7, f"a b c d e {i}", f"s{i % 3}") for i in range(6000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for r in mixing.mix_plan(frame).groupBy("row.source").agg(F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken")).collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.06)


def test_labelled_rows_are_bounded(spark):
    docs = spark.createDataFrame([(3, f"text {i}") for i in range(500)] + [(i, "other") for i in range(10, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), *((i, 0) for i in range(10, 40)), (None, 1)], "doc_id long, toxic int")
    got = toxicity.labelled_rows(docs, labels, 10)
    assert len(got) <= 10 and len(toxicity.labelled_rows(docs, labels)) <= 31
    held = docs.withColumn("doc_id", F.lit(None).cast("long")).select(toxicity.held_out("doc_id").alias("h")).distinct().collect()
    assert [r["h"] for r in held] == [False]


def naive_strength(lexicon, text):
    """By looking at every place for every term; the formula of length is written anew."""
    folded = toxicity.fold(text)
    covered = []
    for phrase in lexicon.exceptions:
        term = f" {toxicity.fold(phrase).strip()} "
        covered += [(i, i + len(term)) for i in range(len(folded)) if folded.startswith(term, i)]
    best = {}
    for term, weight in lexicon.weights.items():
        for i in range(len(folded)):
            if folded.startswith(" " + term, i) and not any(s <= i and i + len(term) + 1 <= e for s, e in covered):
                best[i] = max(best.get(i, 0), weight)
    words = folded.count(" ")
    return math.log(1 + sum(best.values())) * (0.5 + 0.5 * (1 + words / 200) ** -0.5) if best else 0.0


def test_toxicity_hits_equal_naive_search():
    rng = random.Random(8)
    lexicon = toxicity.learn([])
    lexicon.weights["scu"], lexicon.weights["idi"] = 0.7, 0.3
    words = ["idiot", "1D10T", "trash", "can", "trash can", "scum line", "scum", "pond", "clown", "fish", "river", "not", "an", "stupid!", "st|upid", "idiotic", "ｉdiot", "mоron", "a.b", "\n", "worthless stock option"]
    lexicon.built = None
    for _ in range(400):
        text = rng.choice([" ", " ", ", "]).join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        assert lexicon.strength(text) == pytest.approx(naive_strength(lexicon, text)), text


def test_unlike_texts_of_one_id(spark):
    """The set of an id is one of its rows' sets, by a fixed rule, and no link from it is lost."""
    rng = random.Random(3)
    a, b = prose(rng, 120).split(), prose(rng, 150).split()

    def near(words):
        return " ".join([*words[:60], "altered", *words[61:]])

    rows = [(1, " ".join(a)), (1, " ".join(b)), (5, near(a)), (6, near(b)), (9, ""), (9, "x y"), (10, "x Y"), (None, " ".join(a))]
    texts = {}
    for d, t in rows:
        if d is not None and t:
            texts.setdefault(d, []).append(t)
    expected = {}
    for order in ("doc_id", "text"):
        got = {(r["doc_id"], r["component_id"], r["n_shingles"], r["kept"]) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").orderBy(order)).collect()}
        assert len([x for x in got if x[0] == 1]) == 1
        expected.setdefault("all", got)
        assert got == expected["all"]
    size = next(x[2] for x in got if x[0] == 1)
    chosen = {d: min(ts, key=lambda t: len({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)})) for d, ts in texts.items()}
    want = brute_components(chosen.items(), 85)
    assert size == want[1][0] and {(x[0], x[1]) for x in got if x[0] is not None} == {(d, c) for d, (_, c) in want.items()}


def test_large_group_at_the_shipped_leaf(spark):
    """More near copies than one task compares: links across blocks, leaves and levels are found."""
    rng = random.Random(12)
    bases = [[f"w{g}x{rng.randrange(10**6)}" for _ in range(60)] for g in range(2)]
    rows = []
    for i in range(near_duplicates.LEAF + 900):
        w = list(bases[0])
        for _ in range(rng.choice([0, 1, 1, 2])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    for i in range(60):
        w = list(bases[1])
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((100_000 + i, " ".join(w)))
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [np.array(sorted({hash(tuple(t.split()[i : i + 5])) & (2**64 - 1) for i in range(len(t.split()) - 4)}), np.uint64) for _, t in rows]
    label = near_duplicates.truly_near(sets, 85)
    want: dict[int, int] = {}
    for (doc, _), of in zip(rows, label.tolist()):
        want.setdefault(of, doc)
    missed = sum(got[d] != want[of] for (d, _), of in zip(rows, label.tolist()))
    assert missed == 0


def test_overlaps_counted_from_lists():
    """Against intersections of Python sets."""
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(20, 60), replace=False), rng.integers(0, 1 << 62, rng.integers(0, 8), dtype=np.uint64)])) for _ in range(60)]
    label = near_duplicates.truly_near(sets, 60)
    plain = [set(s.tolist()) for s in sets]
    linked = [[100 * len(a & b) >= 60 * len(a | b) for b in plain] for a in plain]
    own = list(range(60))
    for _ in range(60):
        own = [min(own[j] for j in range(60) if linked[i][j]) for i in range(60)]
    assert [{j for j in range(60) if label[j] == label[i]} for i in range(60)] == [{j for j in range(60) if own[j] == own[i]} for i in range(60)]


def test_words_made_to_collide():
    """Thue-Morse words are equal in a polynomial modulo a power of two, whatever its base."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    data = np.frombuffer(f"{word} {other}".encode(), np.uint8)
    _, hashes = near_duplicates.word_hashes(data)
    assert len(set(hashes.tolist())) == 2


def test_very_common_fingerprint(spark, monkeypatch):
    """More unlike spans of one fingerprint than a merge takes go through the hash aggregation, and equal brute force."""
    monkeypatch.setattr(repeated_bytes, "HOT", 300)
    rng = random.Random(4)
    passage = prose(rng, 30)[:150]
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(60, 90))) + passage[rng.randrange(20) : 150 - rng.randrange(20)] + "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(60, 90)))) for i in range(900)]
    got = {r["doc_id"]: tuple(r)[1:] for r in repeated_bytes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_repeats(rows)


def test_a_document_alone_in_its_language(spark):
    """It is its own reference and stays, whatever it is like."""
    odd = "zzz qqq " * 40 + " ".join(f"x{i}" for i in range(60))
    rows = [(i, prose(random.Random(i), 80), "en") for i in range(30)] + [(99, " ".join(dict.fromkeys(odd.split())) + " 12345 67890", "de")]
    got = {r["doc_id"]: r for r in quality.score_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[99]["base_failed"] and got[99]["kept"]

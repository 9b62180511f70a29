"""Each operator against a brute-force model on a fixture with nulls, empty, long, repeated and odd texts."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spotweave.llm import decontamination, html_text, mixing, near_duplicates, pii, quality, repeated_bytes, token_counts, toxicity, urls
from spotweave.llm.batches import row_ranges

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, target int, packed string"


def prose(rng, words):
    return " ".join(rng.choice(["the", "of", "and", "thing", "other", "river", "a", "to", "in", "stone", "walked", "green."]) if rng.random() < 0.7 else "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(words))


def odd_rows():
    """(doc_id, text, lang, source): the cases that every operator must handle."""
    rng = random.Random(7)
    base = prose(rng, 400)
    changed = base.split()
    changed[50] = changed[200] = "altered"
    rows = [(i, prose(rng, rng.randint(5, 200)), rng.choice(["en", "de", None]), f"s{i % 4}") for i in range(40)]
    rows += [(50, None, "en", "s1"), (51, "", "en", None), (52, " \n\t ", None, None), (53, "word", "en", "s1"), (54, "Ünï ßcode 🙂 " * 30, "de", "s1"), (55, "a" * 5000, "en", "big")]
    rows += [(60, base, "en", "big"), (61, base, "en", "big"), (62, base.upper(), "en", "big"), (63, " ".join(changed), "en", "big"), (64, prose(rng, 20_000), "en", "big"), (65, "To To To " * 200, "en", "s2")]
    return rows + [(60, base, "en", "big"), (None, base, "en", "s3"), (None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame([(*r, None, "clash", 1, "clash") for r in odd_rows()], DOCS)
    return frame.repartition(3)


def test_steps_hold_whole_rows():
    offsets = np.cumsum([0, 5, 0, 100, 3, 3])
    assert list(row_ranges(offsets, 10)) == [(0, 2), (2, 3), (3, 5)]


def test_all_operators_on_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert quality.score_quality(empty).count() == 0 and quality.keep_quality(empty).count() == 0
    assert mixing.mix(empty).count() == 0 and pii.find_personal_data(empty).count() == 0 and pii.mask_personal_data(empty).count() == 0
    assert decontamination.find_leaks(empty, bench).count() == 0 and decontamination.keep_clean(empty, bench).count() == 0
    assert repeated_bytes.remove_repeats(empty).count() == 0 and near_duplicates.near_duplicates(empty).count() == 0 and near_duplicates.keep_one_of_each(empty).count() == 0
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert toxicity.score_toxicity(empty, toxicity.learn([])).count() == 0


# ---- 1 ----


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def brute_distance(p, q):
    p, q = [x / max(sum(p), 1) for x in p], [x / max(sum(q), 1) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    return math.sqrt(max(0, sum((a * math.log2(a / c) if a else 0) + (b * math.log2(b / c) if b else 0) for a, b, c in zip(p, q, m)) / 2))


def test_quality_counts(docs):
    got = sorted((tuple(r) for r in quality.score_quality(docs).collect()), key=str)
    want = []
    for doc_id, text, *_ in odd_rows():
        counts = brute_quality(text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        want.append((doc_id, *counts, failed))
    assert [r[:7] for r in got] == sorted(want, key=str)
    assert not any(r[6] and r[7] for r in got)


def test_quality_lines():
    assert quality.repeated_lines("a\nb\na\n\n \n\na".encode()) == 2
    assert quality.repeated_words(np.arange(30)) == 0
    assert quality.repeated_words(np.array([*range(10), *range(10)])) == 20


def test_quality_divergence(spark):
    rng = random.Random(3)
    clean = [(i, prose(rng, 300), "en") for i in range(60)]
    junk = [(100, " ".join("".join(rng.choice("qxzkv") for _ in range(6)) + "### |" for _ in range(300)), "en"), (101, " | ".join("%d" % rng.randrange(10**6) for _ in range(300)), None)]
    frame = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in quality.score_quality(frame).collect()}
    assert all(kept[i] for i in range(60)) and not kept[100] and not kept[101]
    stay = quality.keep_quality(frame)
    assert stay.columns == frame.columns and stay.count() == 60
    p = np.array([[3, 0, 5], [0, 0, 0]])
    for row, d in zip(p, quality.js_distance(p, np.array([1, 2, 3]))):
        assert d == pytest.approx(brute_distance(list(row), [1, 2, 3]))


# ---- 2 ----


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] >= 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= over
        if not free:
            return target


def test_mixing(docs):
    sizes = collections.Counter()
    for _, text, _, source in odd_rows():
        sizes[source] += len(WORD.findall(text or ""))
    want = brute_targets(sizes)
    plan = mixing.mix_plan(docs).select("row.*", "size", "source_size", F.col("target").alias("goal"), "copies").drop("target").collect()
    assert len(plan) == len(odd_rows())
    for r in plan:
        assert r["source_size"] == sizes[r["source"]] and r["goal"] == pytest.approx(want[r["source"]])
        rate = r["goal"] / r["source_size"] if r["source_size"] else 0
        assert r["copies"] in (math.floor(rate), math.floor(rate) + 1) and r["copies"] <= 2
    again = mixing.mix_plan(docs.repartition(5)).select("row.doc_id", "copies").collect()
    assert sorted(map(str, again)) == sorted(str(type(again[0])(doc_id=r["doc_id"], copies=r["copies"])) for r in plan)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copy"] and mixed.count() == sum(r["copies"] for r in plan)
    assert mixing.mix(docs.withColumn("copy", F.lit(1))).columns[-1] == "copy_number"


def test_mixing_comes_near_targets(spark):
    frame = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("a b c d e").alias("text"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 2).cast("string"))).alias("source"))
    for r in mixing.mix_plan(frame).groupBy("row.source").agg(F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken")).collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.06)


# ---- 3 ----

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and pii.luhn(digits.encode())):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_personal_data_base_patterns():
    rng = random.Random(5)
    pieces = ["a.b@c.d", "x@y", "@", "é", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "01.002.0003.4", "4111 1111 1111 1111", "4111-1111-1111-1111", "12", " ", "+1 (234) 567-8901", "+44 20 7946 0958 ", "-", ".", "+", "9", "foo", "00000000000000", "ü@ü.de", "a@b.c@d.e", "\n", "3782 822463 10005"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(3000)] + [None, "", "1" * 4000, "a" * 20000, "@" * 2000, "+1" * 2000]
    found = pii.detect(pa.array(texts), pii.Tagger())
    for text, (base, added) in zip(texts, found):
        assert base == brute_spans(text or ""), text
        assert all(e <= s2 or s >= e2 for s, _, e in added for s2, _, e2 in base)


def test_personal_data_field_finds_more():
    tagger = pii.Tagger()
    texts = ["please phone (555) 123-4567 today", "write to ann at example dot com soon", "we saw 12 birds in 1999 at 10:30", "call 555-123-4567.", "nothing here"]
    added = [m for _, m in pii.detect(pa.array(texts), tagger)]
    assert [[texts[i][s:e] for s, _, e in m] for i, m in enumerate(added)][:2] == [["(555) 123-4567"], ["ann at example dot com"]]
    assert added[3] and added[3][0][1] == 3 and not added[2] and not added[4]
    assert pii.mask_text("a b@c.d e", [(2, 0, 7)]) == "a [email] e" and pii.mask_text("abcd", [(0, 0, 3), (2, 1, 4)]) == "[email]"


def test_personal_data_rows(docs):
    assert pii.find_personal_data(docs).count() == len(odd_rows())
    masked = pii.mask_personal_data(docs)
    assert masked.schema == docs.schema and masked.count() == len(odd_rows())


def viterbi(emit, moves):
    best = {(i,): emit[0][i] + (-1e4 if pii.LABELS[i][0] == "I" else 0) for i in range(pii.N_LABELS)}
    for row in emit[1:]:
        best = {p + (j,): s + moves[p[-1]][j] + row[j] for p, s in best.items() for j in range(pii.N_LABELS)}
    return max(best, key=best.get)


def test_decoding_is_the_best_path():
    tagger, rng = pii.Tagger(), np.random.default_rng(1)
    lengths = np.array([3, 1, 2, 3])
    emit = rng.normal(size=(lengths.sum(), pii.N_LABELS)) * 2
    got, at = tagger.decode(emit, lengths), 0
    for n in lengths:
        assert tuple(got[at : at + n]) == viterbi(emit[at : at + n], tagger.moves)
        at += n


# ---- 4 ----


def least_edit(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        above, row = row, [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            row[j] = min(above[j - 1] + (c != d), above[j] + 1, row[j - 1] + 1)
    return min(row)


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(400):
        p, t = ("".join(rng.choice("abc") for _ in range(n)) for n in (rng.randint(1, 80), rng.randint(0, 50)))
        want = least_edit(p, t)
        assert decontamination.least_distance(p, t, 99) == want
        assert decontamination.least_distance(p, t, 2) == min(want, 3)


def test_leaks_against_all_pairs(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(10, 40))) for i in range(12)] + [(12, None), (13, "  "), (14, items_text := "Straße über alles gut " * 4), (15, items_text)]
    rows = []
    for i in range(60):
        item = items[rng.randrange(12)][1]
        s = list(item)
        for _ in range(rng.randint(0, len(s) // 10)):
            k = rng.randrange(len(s))
            s[k : k + 1] = rng.choice([[], ["x"], [s[k], "y"]])
        rows.append((i, prose(rng, 30) + "\n" * 3 + ("".join(s)).replace(" ", "\t ") + " " + prose(rng, 30)))
    rows += [(70, None), (71, ""), (72, items_text.upper()), (72, "x " + items_text), (None, items[0][1])]
    got = sorted((tuple(r) for r in decontamination.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()), key=str)
    want = []
    for doc_id, text in rows:
        for item in decontamination.make_items([x for x in items if x[1]], 6):
            if (d := least_edit(item.text, decontamination.folded(text))) <= item.budget:
                want += [(doc_id, i, d) for i in item.item_ids]
    assert got == sorted(want, key=str)
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    clean = decontamination.keep_clean(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == frame.columns
    held = decontamination.make_items([x for x in items if x[1]], 6)
    stay = [d for d, text in rows if not any(least_edit(i.text, decontamination.folded(text)) <= i.budget for i in held)]
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(map(str, stay))


def test_leaks_in_upper_case(spark):
    """Capitals beyond A-Z, and letters with their marks apart, are no errors: against a fold by a table of letters."""
    small, capital, apart = "ñóüéàčœя", "ÑÓÜÉÀČŒЯ", ["n\u0303", "o\u0301", "u\u0308", "e\u0301", "a\u0300", "c\u030c", "œ", "я"]
    rng = random.Random(3)
    item = " ".join("".join(rng.choice("abcde" + small) for _ in range(rng.randint(3, 8))) for _ in range(20))
    table = {**dict(zip(small, capital)), **dict(zip("abcde", "ABCDE"))}
    upper = "".join(table.get(c, c) for c in item)
    marks = "".join(dict(zip(small, apart)).get(c, c) for c in item)
    back = {v: k for k, v in table.items()}
    assert decontamination.folded(upper) == decontamination.folded(marks) == "".join(back.get(c, c) for c in upper).encode().decode("latin-1")
    frame = spark.createDataFrame([(1, f"Before {upper} after"), (2, f"Before {marks} after"), (3, "Before and after")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "Straße über alles gut " * 4)], "item_id long, text string")
    assert sorted(map(tuple, decontamination.find_leaks(frame, bench).collect())) == [(1, 7, 0), (2, 7, 0)]
    assert [r["doc_id"] for r in decontamination.keep_clean(frame, bench).collect()] == [3]


def test_leaks_with_a_replaced_word(spark, tmp_path):
    """The query and the pipeline's stage find a short item with a longer word replaced, which is above 6 %."""
    import corpus_pipeline
    from spotweave.llm.queries import op4_decontamination

    item = "the old miller counted seven grey sacks before the bridge gave way under his cart"
    changed = item.replace("bridge", "plaque")
    distance = least_edit(item, changed)
    assert len(item) == 81 and len(item) * 6 // 100 < distance <= len(item) * 10 // 100
    docs = spark.createDataFrame([(1, f"It is said that {changed} last year"), (2, "It is said that last year the old miller counted")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert list(map(tuple, op4_decontamination(spark, str(tmp_path)).collect())) == [(1, 7, distance)]
    assert [r["doc_id"] for r in corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()] == [2]


def test_partner_filter_loses_nothing():
    """Few letters, so that chance hits are many, and up to one error above the budget, at the text's ends as well."""
    rng = random.Random(4)
    for _ in range(1500):
        letters = rng.choice(["ab", "abc", "abcdefgh"])
        pattern = "".join(rng.choice(letters) for _ in range(rng.randint(8, 60)))
        items = decontamination.make_items([(1, pattern)], rng.choice([0, 6, 10, 15]))
        s = list(pattern)
        for _ in range(rng.randint(0, items[0].budget + 1)):
            k = rng.randrange(len(s))
            s[k : k + 1] = rng.choice([[], [rng.choice(letters)], [s[k], rng.choice(letters)]])
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 3, 20]))) + "".join(s) + "".join(rng.choice(letters) for _ in range(rng.choice([0, 3, 20])))
        want = least_edit(pattern, text)
        assert decontamination.leaks(text, items) == ({1: want} if want <= items[0].budget else {})


def test_items_of_one_stem():
    """Many items with a common stem: equal to all pairs, and a text with the stem alone takes no time for each of them."""
    rng = random.Random(6)
    stem = "which of the following statements about the history of the old stone bridge is right "

    def item(i):
        return stem + " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(12)) + f" {i}"

    rows = [(i, item(i)) for i in range(120)] + [(500, "another item altogether, with words of its own and nothing in common")]
    rows += [(700 + i, rows[i][1]) for i in range(3)]
    items = decontamination.make_items(rows, 10)
    assert len(items) == 121
    for _ in range(30):
        s = list(rng.choice(rows)[1])
        for _ in range(rng.randint(0, len(s) // 9)):
            k = rng.randrange(len(s))
            s[k : k + 1] = rng.choice([[], ["x"], [s[k], "y"]])
        text = decontamination.folded(prose(rng, 10) + " " + "".join(s) + " " + prose(rng, 10))
        want = {i: d for x in items if (d := decontamination.least_distance(x.text, text, x.budget)) <= x.budget for i in x.item_ids}
        assert decontamination.leaks(text, items) == want
    many = decontamination.make_items([(i, item(i)) for i in range(2000)], 10)
    decontamination.leaks("warm", many)
    import time

    begin = time.perf_counter()
    for i in range(100):
        assert not decontamination.leaks(f"{prose(rng, 60)} {stem} {prose(rng, 60)}", many)
    assert time.perf_counter() - begin < 4


# ---- 5 ----


def brute_repeats(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(raw[p : p + 100])
        left = bytes(x for x, g in zip(raw, gone) if not g)
        out[doc_id] = (len(raw), sum(gone), sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1])), hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("shard,hot", [(16_384, 20_000), (300, 20_000), (16_384, 2)])
def test_repeated_bytes(spark, monkeypatch, shard, hot):
    monkeypatch.setattr(repeated_bytes, "SHARD_BYTES", shard)
    monkeypatch.setattr(repeated_bytes, "HOT", hot)
    rng = random.Random(11)
    passage = prose(rng, 60)
    rows = {d: t for d, t, *_ in odd_rows() if d is not None and d != 64}
    for i in range(30):
        cut = rng.randrange(0, 60)
        rows[100 + i] = prose(rng, rng.randint(0, 20)) + passage[cut : len(passage) - rng.randrange(0, 60)] + prose(rng, 10)
    rows[140], rows[141] = "ab" * 150, "ba" * 120
    rows[142] = rows[100] + rows[101] + rows[100]
    frame = spark.createDataFrame([*rows.items(), (60, rows[60]), (None, rows[60])], "doc_id long, text string")
    got = repeated_bytes.remove_repeats(frame).collect()
    want = brute_repeats(rows.items())
    assert len(got) == len(rows) + 2
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            assert tuple(r)[1:] == want[r["doc_id"]], r["doc_id"]


def test_interval_merge_is_the_sort_by_prefix():
    rng = random.Random(4)
    base = ["".join(rng.choice("ab") for _ in range(150)).encode() for _ in range(2)]
    texts = [b[s : s + rng.randint(95, 140)] for b in base * 6 for s in (rng.randint(0, 9),)]
    groups = collections.defaultdict(set)
    for i, t in enumerate(texts):
        for p in range(len(t) - 99):
            groups[t[p : p + 100]].add((i, p))
    got = collections.defaultdict(set)
    for interval, text, place in zip(*repeated_bytes.merged_intervals(texts)):
        got[interval].add((int(text), int(place)))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_merge_gives_common_prefixes():
    """Against prefixes compared byte by byte, over several shards; no end of a text counts as equal."""
    rng = random.Random(5)
    base = bytes(rng.choice(b"abc") for _ in range(400))
    texts = [base[s : s + rng.randint(1, 200)] for s in (rng.randrange(300) for _ in range(150))]
    shared, text, place, room = repeated_bytes.merged_prefixes(texts)
    full = [(s, texts[t][p:][:100]) for s, t, p, r in zip(shared, text, place, room) if r >= 100]
    assert len(full) == sum(max(0, len(t) - 99) for t in texts) and len(shared) == sum(len(t) + 1 for t in texts)
    assert [t for _, t in full] == sorted(t for _, t in full)
    where = np.flatnonzero(room >= 100)
    for (_, before), (_, after), low, high in zip(full, full[1:], where, where[1:]):
        common = next((i for i in range(100) if before[i] != after[i]), 100)
        assert min(shared[low + 1 : high + 1]) == common // repeated_bytes.STRIDE * repeated_bytes.STRIDE


# ---- 6 ----


def test_html(spark):
    page = '<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href="/a">home</a></li><li><a href="/b">shop</a></li></ul></nav><div class="ad">Buy this thing now, it is good.</div><article><h1>A head &amp; more</h1><p><b>First  part<br>of it, and some more words to read.<p>Second\n&nbsp;part &copy; 2020, which goes on for a while.</p><script>var x="</p>"</script></article><div id="comments"><div class="comment"><p>I liked that, thank you.</p></div></div><footer>&copy; site</footer></body></html>'
    want = "A head & more\nFirst part of it, and some more words to read.\nSecond part © 2020, which goes on for a while."
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<" * 3000), (6, "u", page), (None, "u", "<script>x"), (7, "u", "<div>" * 3000 + "deep"), (8, "u", '<a "' * 500)]
    got = {r["page_id"]: r for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()}
    assert got[1]["text"] == got[6]["text"] == want and got[1]["n_chars"] == len(want)
    assert got[2]["text"] == got[3]["text"] == got[None]["text"] == got[4]["text"] == "" and len(got) == 9


def test_html_held_out_pages():
    model = html_text.train()
    pages = html_text.labelled_pages(120, seed=77)
    texts = html_text.extract([p for p, _ in pages], model)
    assert sum(a == b for a, (_, b) in zip(texts, pages)) >= 108


def test_html_decoding_is_consistent_and_best():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = 9
        parents = [-1, *(int(rng.integers(0, i)) for i in range(1, n))]
        chance = rng.random(n)
        got = html_text.decode(parents, [False] * n, chance)
        best = max((m for m in range(1 << n) if m & 1 and all(not m >> i & 1 or m >> parents[i] & 1 for i in range(1, n))), key=lambda m: sum(math.log(chance[i] if m >> i & 1 else 1 - chance[i]) for i in range(1, n)))
        assert got == [bool(best >> i & 1) for i in range(n)]


# ---- 7 ----


def brute_url(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1], m[2]) if m else ("", "")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def test_urls(spark):
    given = ["http://www.Casino-Win.example.com/en/5", "https://theren.example.org/en/3", "http://a.net/x", "http://b.example.net/en/1?q", "http://example.com/de/", "http://x.org/fr/z#t", "http://net", "http://fakenet/", None, "", "no scheme", "a://b://c/d", "http://ÜBER.net/é", "://", "http://" + "a" * 3000 + ".com/"]
    rows = [(i, u) for i, u in enumerate(given)] + [(0, given[0]), (None, given[1])]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    at = {r["page_id"]: r for r in got}
    for i, u in enumerate(given):
        host, path = brute_url(u)
        assert (at[i]["host"], at[i]["path"]) == (host, path), u
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert at[i]["rule"] == (max(fits)[1] if fits else None)
        if fits:
            assert at[i]["verdict"] == max(fits)[2]
    assert at[0]["verdict"] == "block" and at[1]["verdict"] == "allow" and at[8]["verdict"] == "allow"


def test_url_models(spark):
    """The tables against interpolated counts in Python, and the score against a walk over the characters."""
    seeds = [(i, i % 2 == 1, t) for i, t in enumerate(["www.the.com/a", "win-bet.com/b", "then.org/", "bet.org/x"])]
    frame = spark.createDataFrame(seeds, "n long, bad boolean, text string")
    tables = urls.markov_tables(frame)
    grams = {b: collections.Counter() for b in (False, True)}
    contexts = collections.defaultdict(set)
    for _, bad, text in seeds:
        s = " " * urls.ORDER + text
        for i in range(urls.ORDER, len(s)):
            for k in range(urls.ORDER + 1):
                grams[bad][s[i - k : i + 1]] += 1
                contexts[k].add(s[i - k : i])

    def chance(bad, h, c):
        n, total = grams[bad][h + c], sum(grams[bad][h + x] for x in urls.ALPHABET + " ")
        if not h:
            return (n + 0.5) / (total + 0.5 * (len(urls.ALPHABET) + 1))
        return (n + urls.MASS * chance(bad, h[1:], c)) / (total + urls.MASS)

    text = "bet.the-x.com"
    got = urls.likelihood_difference(spark.createDataFrame([(1, text)], "k long, t string").select("k", urls.symbols(F.col("t")).alias("text")), tables, "k").first()["difference"]
    s, total = " " * urls.ORDER + text, 0.0
    for i in range(urls.ORDER, len(s)):
        k = max(k for k in range(urls.ORDER + 1) if s[i - k : i] in contexts[k])
        total += math.log(chance(True, s[i - k : i], s[i]) / chance(False, s[i - k : i], s[i]))
    assert got == pytest.approx(total / len(text), abs=1e-6)


# ---- 8 ----


def brute_components(rows, percent):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for doc_id, text in rows:
        w = WORD.findall((text or "").translate(table))
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    ids = sorted(sets)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if label[a] < label[b] and sets[a] and sets[b]:
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        label[b], changed = label[a], True
    return {i: (len(sets[i]), label[i]) for i in ids}


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "LEAF", 6)
    rng = random.Random(9)
    rows = {d: t for d, t, *_ in odd_rows() if d is not None and d != 64}
    for g in range(3):
        base = prose(rng, 150).split()
        for i in range(25):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(99)}"
            rows[200 + 40 * g + i] = " ".join(w)
    rows[400], rows[401] = "one two", "One  TWO"
    frame = spark.createDataFrame([*rows.items(), (60, rows[60]), (None, rows[60])], "doc_id long, text string").withColumn("n_shingles", F.lit("clash"))
    got = near_duplicates.near_duplicates(frame).collect()
    want = brute_components(rows.items(), 85)
    assert len(got) == len(rows) + 2
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    stay = near_duplicates.keep_one_of_each(frame)
    assert stay.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in stay.collect()) == sorted([*(str(i) for i in rows if want[i][1] == i), "None"])


def test_trees_keep_their_recall_at_any_limit():
    """The share of pairs at the limit that no tree holds to its last level, by drawing which minwise tokens of a pair agree."""
    rng = np.random.default_rng(6)
    for limit, trees in ((0.85, 15), (0.8, 21), (0.5, None)):
        n = near_duplicates.tree_count(limit)
        assert trees in (None, n) and (1 - limit**near_duplicates.DEPTH) ** n <= near_duplicates.MISS < (1 - limit**near_duplicates.DEPTH) ** (n - 1)
        assert near_duplicates.token_count(limit) >= n * near_duplicates.DEPTH
    agree = rng.random((400_000, near_duplicates.token_count(0.8))) < 0.8
    n = near_duplicates.tree_count(0.8)
    held = agree[:, : n * near_duplicates.DEPTH].reshape(len(agree), n, near_duplicates.DEPTH).all(2).any(1)
    assert (~held).sum() <= 20  # 6 or 7 expected; with fifteen trees 148


def test_minwise_tokens_of_all_sizes():
    """More tokens leave the first as they are, are unlike each other, and agree as often as sets are similar."""
    x = near_duplicates.mixed(np.arange(9000, dtype=np.uint64))
    sets = [np.sort(x[:8000]), np.sort(x[1000:])]
    few, many = near_duplicates.minwise(sets), near_duplicates.minwise(sets, 1024)
    assert (many[:, :64] == few).all() and len(np.unique(many[0])) > 1000
    assert abs((many[0] == many[1]).mean() - 7 / 9) < 0.07


def test_components(spark):
    from spotweave.llm.components import connected_components

    chain = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (5, 5)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# ---- 9 ----


def test_token_counts_equal_the_library(docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(3)
    alphabet = "aAbB'sSdDtTmM1２ ٣\x1c\x1f\x85\xa0\u3000éÉe\u0301İΣσ<|>endoftext|>ﬀ你한ǅ🙂\n\t-_*.~\x00\ufeff½"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["aaaaaaaaaaaaaa", "<|endoftext|>x<|startoftext|>", "it's they'll I'VE don'T", ""] + [t for _, t, *_ in odd_rows() if t is not None]
    library = Tokenizer.from_file(path)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.load(path).count([t.encode() for t in texts]) == want
    got = token_counts.count_tokens(docs, path).collect()
    assert len(got) == len(odd_rows())
    of = {t: n for t, n in zip(texts, want)}
    texts_of = collections.defaultdict(set)
    for d, t, *_ in odd_rows():
        texts_of[d].add((len((t or "").encode()), of.get(t or "", 0), of.get(t or "", 0) > 2048))
    assert all(tuple(r)[1:] in texts_of[r["doc_id"]] for r in got)


# ---- 10 ----


def test_toxicity_held_out(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        words = prose(rng, rng.randint(5, 120)).split()
        toxic = i % 4 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "zorbling", "zorblax", "1d10t", "lоser"]))
        rows.append((i, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = frame.drop("toxic"), frame.select("doc_id", "toxic")
    lexicon = toxicity.learn(toxicity.labelled_rows(docs, labels))
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, lexicon).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {r[0] for r in docs.where(toxicity.held_out("doc_id")).select("doc_id").collect()} == {i for i, _ in held}
    assert sum(out[i]["predicted"] == y for i, y in held) / len(held) > 0.95
    assert toxicity.labelled_rows(docs, labels, 10).__len__() == 10


def test_toxicity_folding_and_exceptions(docs):
    lexicon = toxicity.learn([])
    assert lexicon.score("you IDI0T!") > lexicon.score("you river") and lexicon.score("an id\u200biot") > lexicon.score("")
    assert lexicon.score("put it in the trash can") == lexicon.score("") < lexicon.score("you are trash")
    assert lexicon.score("trashed idiotic") == lexicon.score("")
    scored = toxicity.score_toxicity(docs, lexicon).collect()
    assert len(scored) == len(odd_rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)

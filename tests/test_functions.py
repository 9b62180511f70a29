"""Sequence, CIGAR, identifier and annotation expressions against fixed values and plain-Python models."""

import random
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from spotweave.functions import cigar, gff, seq, umi


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_adaptor_fixed_values(spark):
    place = seq.adaptor_position("s", "A", 5)
    assert values(spark, [("CCAAAAAC",), ("CCAAAA",), ("",)], "s string", place) == [(2,), (None,), (None,)]


def model_adaptor(s, base, length, mismatches):
    """By enumeration: the leftmost window that is the run but for some places, from its first base on (or its last place)."""
    windows = (s[i : i + length] for i in range(len(s) - length + 1))
    window = next((w for w in windows if length - w.count(base) <= mismatches), None)
    if window is None:
        return None
    return s.index(window[min(window.find(base) % (length + 1), length - 1) :])


@pytest.mark.parametrize("length,mismatches", [(5, 0), (5, 2), (7, 2), (10, 3)])
def test_adaptor_model(spark, length, mismatches):
    random.seed(length)
    rows = ["".join(random.choice("AATGC") for _ in range(random.randint(0, 40))) for _ in range(400)]
    got = values(spark, [(i, s) for i, s in enumerate(rows)], "i int, s string", "i", seq.adaptor_position("s", "A", length, mismatches))
    assert dict(got) == {i: model_adaptor(s, "A", length, mismatches) for i, s in enumerate(rows)}


def model_trim_index(bases, quals, cutoff):
    """By definition: where the suffix of the largest positive loss begins, among those all of whose shorter suffixes lose no less than nothing."""
    loss = [1 if b == "G" else cutoff + 33 - ord(q) for b, q in zip(bases, quals)]
    suffix = [sum(loss[i:]) for i in range(len(loss))]
    allowed = [i for i in range(len(loss)) if min(suffix[i:]) >= 0 and suffix[i] > 0]
    return max(allowed, key=lambda i: (suffix[i], i), default=len(quals))


def test_trim_fixed_values(spark):
    rows = [("TTTTCCCCAAAATTTT", "I" * 16), ("TTTTCCCCAAAATTTT", "IIIIIII" + "#" * 9), ("CATCATGGGGG", "IIIIII#####")]
    assert values(spark, rows, "s string, q string", seq.quality_trim_index("s", "q", 20)) == [(16,), (7,), (6,)]
    cut = values(spark, rows[1:2], "s string, q string", seq.quality_trim_length("s", "q", 20, 6), seq.quality_trim_length("s", "q", 20, 12))
    assert cut == [(7, None)]
    assert values(spark, [("CATCA", "IIIII")], "s string, q string", seq.quality_trim_length("s", "q", 20, 10)) == [(None,)]


def test_trim_model(spark):
    random.seed(4)
    rows = [(i, "".join(random.choice("ACGT") for _ in range(n)), "".join(random.choice("!#%)+-/258;=?BEI") for _ in range(n))) for i, n in enumerate([*range(0, 40)] * 6)]
    got = dict(values(spark, rows, "i int, s string, q string", "i", seq.quality_trim_index("s", "q", 20)))
    assert got == {i: model_trim_index(s, q, 20) for i, s, q in rows}


def test_templates_and_content(spark):
    assert values(spark, [("ACGT1234",), ("ACGT12",)], "u string", seq.matches_template("u", "[ACGT]{4}\\d{4}")) == [(True,), (False,)]
    assert seq.iupac_regex("WN") == "[AT][ACGT]"
    with pytest.raises(ValueError):
        seq.iupac_regex("XY")
    assert values(spark, [("WSn",)], "t string", seq.iupac_regex_column("t")) == [("[AT][CG][ACGT]",)]
    percent = values(spark, [("TTAACGCGTA",)], "s string", seq.content_percent("s", "AT"))[0][0]
    assert percent == 60.0
    with pytest.raises(Exception):
        values(spark, [("",)], "s string", seq.content_percent("s", "AT"))


def test_slices_and_hamming(spark):
    s = "ABCDEFGHIJ"
    got = values(spark, [(s,)], "s string", seq.slice_between("s", 2, 5), seq.barcode_slice("s", 1, 3, 2), seq.slice_between("s", 8, 20), seq.join_slices("s", [0, 2, 4, 6]))
    assert got == [(s[2:5], s[0:6], s[8:20], s[0:2] + s[4:6])]
    assert values(spark, [("AAAT", "AATT"), ("A", "AA")], "a string, b string", seq.hamming("a", "b")) == [(1,), (None,)]


def test_cigar(spark):
    got = spark.createDataFrame([("5S10M2I3D4M100N6=2X3S", 100)], "c string, p long").select(cigar.aligned_blocks("c", "p").alias("b"), *cigar.clip_lengths("c"), cigar.reference_length("c"), *cigar.clipped_interval("c", "p", F.lit("-"))).first()
    assert [tuple(b) for b in got["b"]] == [(0, 100, 110), (1, 113, 117), (2, 217, 223), (3, 223, 225)]
    assert tuple(got)[1:] == (5, 3, 125, 228, 95)


def test_attribute_lists(spark):
    got = values(spark, [('alias "a, b" ; level=2; tag .; note x,y,z',)], "s string", gff.attribute_lists("s"))[0][0]
    assert got == {"alias": ["a", "b"], "level": ["2"], "note": ["x", "y", "z"]}


UMIS = ["AAAA", "AAAT", "AATT", "TTTT"]


def test_dedup_fixed_values():
    assert len(umi.dedup_directional(UMIS, 1)) == 2
    assert len(umi.dedup_hierarchical(UMIS, 1)) == 2
    assert umi.dedup_adjacent(UMIS, 1) == ["AAAA", "AAAT", "TTTT"]
    counted = [u for u, n in {"AAAA": 6, "AAAT": 3, "AATT": 2, "TTTT": 1}.items() for _ in range(n)]
    assert umi.dedup_directional(counted, 1) == ["AAAA", "TTTT"]
    assert umi.dedup_hierarchical(["AA", "AT"], 1) == ["AA", "AT"]
    assert umi.dedup_hierarchical(["AA", "TT"], 1) == ["AA"]
    assert umi.dedup_hierarchical(["AA", "AT"], 1, fix_pair_rule=True) == ["AA"]
    assert umi.dedup_hierarchical(UMIS, 1, "complete") == ["AAAA", "AATT", "TTTT"]
    for work in umi.ALGORITHMS.values():
        with pytest.raises(ValueError):
            work([], 1)


def model_components(umis, k):
    left, n = set(umis), 0
    while left:
        n += 1
        stack = [left.pop()]
        while stack:
            u = stack.pop()
            near = {v for v in left if len(u) == len(v) and sum(a != b for a, b in zip(u, v)) <= k}
            left -= near
            stack += near
    return n


def test_component_counts_agree(spark):
    random.seed(8)
    rows = [(i, list(dict.fromkeys("".join(random.choice("ACGT") for _ in range(4)) for _ in range(random.randint(1, 60))))) for i in range(60)]
    got = {i: (a, b) for i, a, b in values(spark, rows, "i int, u array<string>", "i", umi.component_count("u", 1), F.size(umi.cluster_column("u", 1)))}
    for i, us in rows:
        n = model_components(us, 1)
        assert got[i] == (n, n)
        assert len(umi.dedup_hierarchical(us, 1, fix_pair_rule=True)) == n
    more = [umi for umi in ("".join(p) for p in product("AC", repeat=3))]
    counts = [model_components(more, k) for k in range(4)]
    assert counts == sorted(counts, reverse=True)


def test_neighbours_pigeonhole_is_exact():
    random.seed(2)
    us = list({"".join(random.choice("AC") for _ in range(random.randint(3, 7))) for _ in range(80)})
    for k in (0, 1, 2, 3):
        near = umi.neighbours(us, k)
        assert {(a, b) for a in us for b in near[a]} == {(a, b) for a in us for b in us if a == b or umi.is_near(a, b, k)}
    assert Counter(umi.by_count(Counter("ABB"))) == Counter("AB")


def test_gff_attributes(spark):
    rows = [('gene_id "X"; gene_name "Y"; gene_id "Z"; tag .; note NA; loose; level=2;',), ("ID=gene1;Name=Gene1",), ("",)]
    got = [r[0] for r in values(spark, rows, "a string", gff.attribute_map("a"))]
    assert got[0] == {"gene_name": "Y", "gene_id": "Z", "INFO6": "loose", "level": "2"}
    assert got[1] == {"ID": "gene1", "Name": "Gene1"}
    assert got[2] == {}
    assert values(spark, [("a, b ,c",)], "v string", gff.list_value("v")) == [(["a", "b", "c"],)]

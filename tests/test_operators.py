"""Operators on small fixtures with known results, and against plain-Python models."""

import random

import pytest
from pyspark.sql import functions as F

from spotweave.operators import annotate, counts, dedup, demux, matrix, multi_qa, qa, read_filter, records, saturation

READ = "clear_name string, gene string, x int, y int, strand string, start long, umi string"
ALIGNED = "id string, flag int, chrom string, pos long, mapq int, cigar string"
FEATURE = "chrom string, low long, high long, strand string, gene string"


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_filter_reasons(spark):
    base = "ACTGACTGACTGACTGACTGACTG"
    reads = [(1, base, "I" * 24), (2, "T" * 24, "I" * 24), (3, "G" * 24, "I" * 24), (4, "C" * 24, "I" * 24), (5, base, "!!!!" + "I" * 20), (6, base, "!" * 14 + "I" * 10)]
    frame = spark.createDataFrame([(i, f"read{i} 1:N", s, q) for i, s, q in reads], "read_idx long, name string, seq string, qual string")
    pairs = read_filter.pair_reads(frame, frame)
    assert pairs.where("same_name").count() == 6
    p = read_filter.ReadFilter(umi_start=0, umi_end=4, umi_template="NNNN", umi_quality_bases=1, at_content=50, gc_content=60, poly_a=5, poly_t=5, poly_g=5, poly_c=5, poly_n=5, homopolymer_mismatches=2, barcode_length=10, overhang=2)
    out = {r["name"]: r["drop_reason"] for r in read_filter.filter_reads(pairs, p).collect()}
    assert out["read2"] == "at_content" and out["read3"] == "gc_content" and out["read5"] == "umi_quality" and out["read6"] == "umi_quality"
    by_reason = {r["reason"]: r["reads"] for r in read_filter.filter_counts(read_filter.filter_reads(pairs, p)).collect()}
    assert sum(by_reason.values()) == 6 and by_reason.get("kept", 0) < 6
    everything = read_filter.filter_reads(pairs, read_filter.ReadFilter(disable_trimming=True))
    assert everything.where("drop_reason IS NULL").count() == 6
    clipped = read_filter.clip_reads(frame, 2, 3).first()
    assert clipped["seq"] == base[2:-3]


def test_empty_reads(spark):
    frame = spark.createDataFrame([(0, "r", "", "")], "read_idx long, name string, seq string, qual string")
    out = read_filter.filter_reads(read_filter.pair_reads(frame, frame), read_filter.ReadFilter(disable_umi=True)).collect()
    assert [r["drop_reason"] for r in out] == ["adaptor"]


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row, above = [i], row
        for j, d in enumerate(b, 1):
            row.append(min(above[j - 1] + (c != d), above[j] + 1, row[j - 1] + 1))
    return row[-1]


@pytest.mark.parametrize("metric,k", [("Hamming", 1), ("Hamming", 2), ("Levenshtein", 1), ("Levenshtein", 2), ("Subglobal", 1)])
def test_demux_against_all_pairs(spark, metric, k):
    random.seed(k)
    table = ["".join(random.choice("ACGT") for _ in range(9)) for _ in range(25)]
    seen = []
    for b in table:
        for _ in range(5):
            s = list(b)
            for _ in range(random.randint(0, 3)):
                i = random.randrange(len(s))
                s[i : i + 1] = random.choice([[], [random.choice("ACGT")], [s[i], "A"]])
            seen.append(("GA" if metric == "Subglobal" else "") + "".join(s))
    barcodes = spark.createDataFrame([(b, i, i) for i, b in enumerate(table)], "barcode string, x int, y int")
    observed = spark.createDataFrame([(s,) for s in seen] + [(None,)], "observed string")
    got = {r["observed"]: r for r in demux.match_barcodes(observed, barcodes, k, metric, keep_one=True).collect()}
    far = {"Hamming": lambda a, b: sum(p != q for p, q in zip(a, b)) if len(a) == len(b) else 99, "Levenshtein": edit, "Subglobal": lambda a, b: min(edit(a[i:j], b) for i in range(len(a) + 1) for j in range(i, len(a) + 1))}[metric]
    for s in set(seen):
        near = sorted((far(s, b), b) for b in table if far(s, b) <= k)
        r = got[s]
        if s in table:
            assert r["category"] == "Perfect"
        elif not near:
            assert r["category"] == "Unmatched" and r["barcode"] is None
        else:
            ties = [b for d, b in near if d == near[0][0]]
            assert (r["category"], r["distance"], r["barcode"]) == ("Imperfect" if len(ties) == 1 else "Ambiguous", near[0][0], ties[0])
    assert got[None]["category"] == "Unmatched"
    with pytest.raises(ValueError):
        demux.match_barcodes(observed, barcodes, 1, "other")


def test_demultiplex_and_contaminants(spark):
    barcodes = spark.createDataFrame([("ACGT", 1, 2)], "barcode string, x int, y int")
    reads = spark.createDataFrame([("a", "xxACGTxx"), ("b", "xxTTTTxx"), ("c", None)], "id string, barcode string")
    out = rows(demux.demultiplex(reads, barcodes, 1, "Hamming", trim=[2, 4, 4, 6]), "id", "category", "x")
    assert out == [("a", "Perfect", 1), ("b", "Unmatched", None), ("c", "Unmatched", None)]
    clean = demux.shared_words(spark.createDataFrame([("a", "AAACCCGGG" * 80), ("b", "TTTTTTTTTT"), ("c", "AC")], "id string, seq string"), spark.createDataFrame([("GGGAAA",)], "seq string"), 6)
    assert rows(clean, "id") == [("b",), ("c",)]


def model_fold(steps, mode):
    if mode == "union":
        return set().union(*steps) if steps else set()
    held = set()
    for g in steps:
        if mode == "intersection-nonempty" and not g:
            continue
        held = held & g if held else set(g)
    return held


@pytest.mark.parametrize("mode", annotate.MODES)
@pytest.mark.parametrize("stranded", annotate.STRANDED)
def test_annotation_against_model(spark, mode, stranded):
    random.seed(17)
    features = [("c1", low := random.randrange(0, 9000), low + random.randrange(1, 900), random.choice("+-"), f"g{i}") for i in range(60)]
    cigars = {"30M": [(0, 30)], "10M200N15M": [(0, 10), (210, 225)], "5S25M": [(0, 25)], "12M3I10M2D8M": [(0, 12), (12, 22), (24, 32)]}
    reads = [(f"r{i}", random.choice([0, 16]), "c1", random.randrange(0, 9500), 60, random.choice(list(cigars))) for i in range(200)] + [("u", 4, None, -1, 0, None), ("z", 0, "c2", 5, 60, "30M"), ("q", 0, "c1", 5, 3, "30M")]
    got = dict(rows(annotate.annotate(spark.createDataFrame(reads, ALIGNED), spark.createDataFrame(features, FEATURE), mode, stranded, min_mapq=10), "id", "gene"))
    assert got["u"] == "__not_aligned" and got["z"] == "__no_feature" and got["q"] == "__too_low_aQual"
    for name, flag, chrom, pos, _, c in reads[:200]:
        strand = "-" if flag else "+"
        want = {"yes": strand, "reverse": "+" if strand == "-" else "-", "no": None}[stranded]
        steps = []
        for low, high in cigars[c]:
            last = None
            for p in range(pos + low, pos + high):
                here = frozenset(g for _, a, b, s, g in features if a <= p < b and (want is None or s == want))
                if here != last:
                    steps.append(here)
                last = here
        genes = sorted(model_fold(steps, mode))
        assert got[name] == ("__no_feature" if not genes else genes[0] if len(genes) == 1 else f"__ambiguous[{'+'.join(genes)}]")


def test_annotation_rules(spark):
    with pytest.raises(ValueError):
        annotate.validate("other", "yes")
    with pytest.raises(ValueError):
        annotate.validate("union", "maybe")
    labels = spark.createDataFrame([("a", "g1"), ("b", "__no_feature"), ("c", "__ambiguous[a+b]"), ("d", "__not_aligned")], "id string, gene string")
    assert rows(annotate.keep_annotated(labels).where("assigned"), "id") == [("a",), ("c",)]
    assert rows(annotate.keep_annotated(labels, True, True).where("assigned"), "id") == [("a",), ("b",)]
    gff = spark.createDataFrame([(1, "chr1", "gene", 1, 1000, "+", {"gene_id": "gene1"}), (2, "chr1", "exon", 5, 900, ".", {})], "line_no long, seqname string, feature string, start long, end long, strand string, attrs map<string,string>")
    assert rows(annotate.select_features(gff, ("gene",)), "low", "high", "gene") == [(0, 1000, "gene1")]
    with pytest.raises(Exception):
        annotate.select_features(gff, ("exon",)).collect()
    assert rows(annotate.gene_ends(gff), "gene", "chrom", "end") == [("gene1", "chr1", 1000)]
    with pytest.raises(Exception):
        spark.range(1).select(annotate.invert_strand(F.lit("."))).collect()


def test_sessions_and_counts(spark):
    chain = [("r1", "g", 1, 1, "+", 100, "AAAA"), ("r2", "g", 1, 1, "+", 110, "AAAT"), ("r3", "g", 1, 1, "+", 121, "AATT"), ("r4", "g", 1, 1, "-", 121, "AAAA"), ("r5", "g", 1, 1, "+", 110, "AAAA")]
    frame = spark.createDataFrame(chain, READ)
    assert rows(dedup.sessions(frame, 10), "clear_name", "session") == [("r1", 1), ("r2", 1), ("r3", 2), ("r4", 3), ("r5", 1)]
    assert rows(dedup.unique_counts(frame, 10, 1), "reads", "count") == [(5, 3)]
    assert rows(dedup.raw_counts(frame), "count") == [(5,)]
    kept = rows(dedup.representative_reads(frame, 10, 0), "clear_name", "umi")
    assert kept == [("r1", "AAAA"), ("r2", "AAAT"), ("r3", "AATT"), ("r4", "AAAA")]
    for algorithm in dedup.ALGORITHMS:
        r = dedup.unique_counts(frame, 10, 1, algorithm).first()
        assert 0 < r["count"] <= r["reads"]
        assert dedup.representative_reads(frame, 10, 1, algorithm).count() == r["count"]
    with pytest.raises(ValueError):
        dedup.unique_counts(frame, 10, 1, "other")


COUNT = "spot string, gene string, count long"


def test_stats_and_matrix(spark):
    frame = spark.createDataFrame([("1x1", "a", 5), ("1x1", "c", 10), ("2x2", "b", 2), ("2x2", "c", 3), ("3x3", "a", 1)], COUNT)
    s = qa.qa_stats(frame).first()
    assert (s["barcodes_found"], s["genes_found"], s["reads_after_duplicates_removal"], s["max_reads_feature"], s["min_genes_feature"], s["max_count"], s["min_count"]) == (3, 3, 21, 15, 1, 10, 0)
    assert abs(s["std_reads_feature"] - (((15 - 7) ** 2 + (5 - 7) ** 2 + (1 - 7) ** 2) / 3) ** 0.5) < 1e-9
    assert len(qa.report_lines(s.asDict())) == 13
    wide = counts.pivot_counts(frame)
    assert rows(wide, "spot", "a", "b", "c") == [("1x1", 5, 0, 10), ("2x2", 0, 2, 3), ("3x3", 1, 0, 0)]
    assert rows(counts.melt_counts(wide), *frame.columns) == rows(frame, *frame.columns)
    places = spark.createDataFrame([(0, 1, 1, 10.0, 10.0, 1), (1, 2, 2, 20.0, 20.0, 1), (2, 3, 3, 30.0, 30.0, 0)], "line_no long, x int, y int, new_x double, new_y double, under_tissue int")
    assert {r[0] for r in rows(matrix.adjust_coordinates(frame, places, True), "spot")} == {"10.0x10.0", "20.0x20.0"}
    assert {r[0] for r in rows(matrix.adjust_coordinates(frame, places, True, legacy_under_tissue=True), "spot")} == {"10.0x10.0", "20.0x20.0", "30.0x30.0"}
    assert {r[0] for r in rows(matrix.adjust_coordinates(frame, places), "spot")} == {"1x1", "2x2"}
    named = matrix.rename_genes(frame.withColumn("column", F.ascii("gene")), spark.createDataFrame([("a", "N", 0), ("b", "N", 1), ("c", "M", 2), ("c", "K", 3)], "gene_id string, gene_name string, line_no long"))
    assert {r[0] for r in rows(named, "gene")} == {"N", "b", "K"}
    types = spark.createDataFrame([("a", "x", 0), ("b", "y", 1)], "gene string, type string, line_no long")
    assert {r[0] for r in rows(matrix.filter_gene_types(frame, types, ["x"]), "gene")} == {"a", "c"}
    hist = qa.histogram(spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "v double"), "v", 2)
    assert rows(hist, "bin", "n") == [(0, 1), (1, 2)]
    assert rows(qa.histogram(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v", 2), "bin", "n") == [(1, 2)]
    assert abs(sum(r["density"] for r in qa.density(frame, "count", 200).collect()) * 1.0) > 0


def test_multi_qa(spark):
    rows_ = [("d1", "1x1", "a", 3), ("d1", "1x1", "b", 4), ("d1", "2x2", "c", 9), ("d2", "1x1", "a", 6), ("d2", "1x1", "b", 8), ("d3", "1x1", "a", 2), ("d3", "1x1", "c", 1)]
    frame = spark.createDataFrame(rows_, "dataset string, spot string, gene string, count long")
    assert rows(multi_qa.common_genes(frame), "gene") == [("a",)]
    assert rows(multi_qa.filled_totals(frame).where("total = 0"), "dataset", "gene") == [("d2", "c"), ("d3", "b")]
    similar = {(a, b): v for a, b, v in rows(multi_qa.gene_similarity(frame), "dataset1", "dataset2", "similarity")}
    assert similar[("d1", "d2")] == pytest.approx(2 / 3) and similar[("d2", "d1")] == 1
    near = {(a, b): v for a, b, v in rows(multi_qa.gene_correlation(frame), "dataset1", "dataset2", "correlation")}
    assert near[("d1", "d2")] == pytest.approx(1)
    parts = {r["dataset"]: (r["pc1"], r["pc2"]) for r in multi_qa.pca(frame).collect()}
    for k in (0, 1):
        assert sum(p[k] for p in parts.values()) == pytest.approx(0, abs=1e-9)
        assert sum(p[k] ** 2 for p in parts.values()) / 2 == pytest.approx(1)
    assert dict(rows(multi_qa.shared_with_all(frame), "dataset", "share"))["d2"] == 0.5


def test_saturation(spark):
    with pytest.raises(ValueError):
        saturation.saturation_points(5, [10])
    assert saturation.saturation_points(60, [100, 50, 10]) == [10, 50]
    assert saturation.saturation_points(10**12)[:3] == [2000, 3718, 8389]
    reads = spark.createDataFrame([(f"r{i}", "g1", i % 7, i % 3, "+", i * 10, "ACGT") for i in range(150)], READ)
    sampled = saturation.subsamples(reads, [10, 50, 100], "clear_name")
    assert rows(sampled.groupBy("point").count(), "point", "count") == [(10, 10), (100, 100), (50, 50)]
    curve = {r["point"]: r for r in saturation.saturation_curve(reads, [10, 100], "clear_name", disable_umi=True).collect()}
    assert curve[100]["reads"] == 100 and curve[100]["genes"] == 1


def test_records(spark):
    frame = spark.range(20).repartition(3).withColumnRenamed("id", "k")
    n = records.numbered(frame, ["k"])
    assert all(r["k"] == r["idx"] for r in n.collect())
    assert rows(records.split_chunks(n, 4).groupBy("chunk").count(), "chunk", "count") == [(0, 5), (1, 5), (2, 5), (3, 5)]
    assert records.merge([frame, frame, frame]).count() == 60
    with pytest.raises(ValueError):
        records.merge([])
    with pytest.raises(ValueError):
        records.split_chunks(n, 0)
    assert records.split_chunks(records.numbered(frame.where("false"), ["k"]), 4).count() == 0

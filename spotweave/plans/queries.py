"""Registered queries over the driver's tables, and the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.functions import cigar, seq, umi
from spotweave.functions.gff import attribute_lists, list_value
from spotweave.operators import annotate, counts, dedup, demux, matrix, multi_qa, qa, read_filter, records, saturation
from spotweave.plans import relations as R
from spotweave.sources.tables import parse_gff

OFFSET = 3000
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def rounded(c: str | Column, digits: int = 6) -> Column:
    return F.round(c, digits)


# ---- unique molecules ------------------------------------------------------------------------------

SESSIONS = f"""{R.READS}, marked AS (
  SELECT *, CASE WHEN strand = lag(strand) OVER w AND start - lag(start) OVER w <= {OFFSET} THEN 0 ELSE 1 END AS fresh FROM reads WINDOW w AS (PARTITION BY gene, x, y ORDER BY strand, start)
), sessions AS (
  SELECT *, sum(fresh) OVER (PARTITION BY gene, x, y ORDER BY strand, start)::BIGINT AS session FROM marked
), umis AS (SELECT DISTINCT gene, x, y, session, umi FROM sessions)"""
COMPONENTS = f"""{SESSIONS}, reach AS (
  SELECT gene, x, y, session, umi, umi AS other FROM umis
  UNION
  SELECT r.gene, r.x, r.y, r.session, r.umi, u.umi FROM reach r JOIN umis u ON r.gene = u.gene AND r.x = u.x AND r.y = u.y AND r.session = u.session AND hamming(r.other, u.umi) <= 1
), labels AS (SELECT gene, x, y, session, umi, min(other) AS label FROM reach GROUP BY ALL),
sizes AS (SELECT gene, x, y, session, count(DISTINCT label) AS n, count(*) AS umis, hamming(min(umi), max(umi)) AS d FROM labels GROUP BY ALL)"""
READ_TOTALS = "(SELECT gene, x, y, count(*) AS reads FROM reads GROUP BY ALL)"


@query(f"WITH RECURSIVE {COMPONENTS} SELECT gene, x, y, reads, sum(n)::BIGINT AS count FROM sizes JOIN {READ_TOTALS} USING (gene, x, y) GROUP BY ALL")
def umi_count_components(spark, d):
    return dedup.unique_counts(R.reads(spark, d), OFFSET, 1, "AdjacentBi")


@query(f"WITH {SESSIONS} SELECT id, session FROM sessions")
def umi_sessions(spark, d):
    return dedup.sessions(R.reads(spark, d), OFFSET).select("id", F.col("session").cast("long").alias("session"))


@query(f"WITH RECURSIVE {COMPONENTS} SELECT gene, x, y, reads, sum(CASE WHEN umis = 2 THEN CASE WHEN d <= 1 THEN 2 ELSE 1 END ELSE n END)::BIGINT AS count FROM sizes JOIN {READ_TOTALS} USING (gene, x, y) GROUP BY ALL")
def umi_count_hierarchical(spark, d):
    return dedup.unique_counts(R.reads(spark, d), OFFSET, 1, "hierarchical")


# of a component, in order of the identifiers: the largest of the first ranks that cover each member
ADJACENT = f"""{COMPONENTS}, placed AS (SELECT *, row_number() OVER (PARTITION BY gene, x, y, session, label ORDER BY umi) AS place FROM labels),
covered AS (SELECT v.gene, v.x, v.y, v.session, v.label, v.umi, min(u.place) AS first FROM placed v JOIN placed u ON u.gene = v.gene AND u.x = v.x AND u.y = v.y AND u.session = v.session AND u.label = v.label AND hamming(u.umi, v.umi) <= 1 GROUP BY ALL),
kept AS (SELECT gene, x, y, session, label, max(first) AS n FROM covered GROUP BY ALL)"""


@query(f"WITH RECURSIVE {ADJACENT} SELECT gene, x, y, reads, sum(n)::BIGINT AS count FROM kept JOIN {READ_TOTALS} USING (gene, x, y) GROUP BY ALL")
def umi_count_adjacent(spark, d):
    return dedup.unique_counts(R.reads(spark, d), OFFSET, 1, "Adjacent")


@query(f"WITH RECURSIVE {COMPONENTS} SELECT gene, x, y, session, list_aggregate(list_sort(list(DISTINCT label)), 'string_agg', ',') AS kept FROM labels GROUP BY ALL")
def umi_cluster_udf(spark, d):
    grouped = dedup.session_umis(R.reads(spark, d), OFFSET)
    kept = F.array_join(F.array_sort(umi.cluster_column("umis", 1, "AdjacentBi")), ",")
    return grouped.select("gene", "x", "y", F.col("session").cast("long").alias("session"), kept.alias("kept"))


@query(f"WITH {R.READS} SELECT gene, x, y, count(*) AS reads, count(*) AS count FROM reads GROUP BY ALL")
def umi_disabled_counts(spark, d):
    return dedup.raw_counts(R.reads(spark, d))


@query(f"WITH RECURSIVE {COMPONENTS} SELECT ((SELECT count(*) FROM reads) - sum(n))::BIGINT AS duplicates_found FROM sizes")
def duplicates_found(spark, d):
    return counts.duplicates_found(dedup.unique_counts(R.reads(spark, d), OFFSET, 1))


@query(f"WITH RECURSIVE {COMPONENTS} SELECT l.gene, l.x, l.y, l.umi, min(clear_name) AS clear_name FROM labels l JOIN sessions s USING (gene, x, y, session, umi) WHERE l.umi = l.label GROUP BY l.gene, l.x, l.y, l.session, l.umi")
def umi_representative_reads(spark, d):
    return dedup.representative_reads(R.reads(spark, d), OFFSET, 1).select("gene", "x", "y", "umi", "clear_name")


@query(f"WITH {R.BARCODES} SELECT a.barcode AS a, b.barcode AS b, hamming(a.barcode, b.barcode)::INT AS distance FROM barcodes a JOIN barcodes b ON a.barcode < b.barcode AND hamming(a.barcode, b.barcode) <= 3")
def hamming_pairs(spark, d):
    # at most three differences leave one of four pieces of two bases unchanged
    piece = F.explode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.struct(i.alias("i"), F.substring("barcode", i * 2 + 1, F.lit(2)).alias("t")))).alias("p")
    b = R.barcodes(spark, d).select("barcode").distinct().select("barcode", piece)
    pairs = b.select(F.col("barcode").alias("a"), "p").join(b.select(F.col("barcode").alias("b"), "p"), "p").where("a < b").select("a", "b").distinct()
    return pairs.withColumn("distance", seq.hamming("a", "b")).where("distance <= 3")


# ---- reads ----------------------------------------------------------------------------------------


@query(f"WITH {R.PAIRS} SELECT read_idx, substr(r1_seq, 1, 12) AS head, substr(r1_seq, 4, 14) AS inner_slice FROM pairs")
def barcode_slice(spark, d):
    return R.read_pairs(spark, d).select("read_idx", seq.barcode_slice("r1_seq", 0, 10, 2).alias("head"), seq.barcode_slice("r1_seq", 5, 10, 2).alias("inner_slice"))


@query(f"WITH {R.PAIRS} SELECT read_idx, substr(r1_seq, 19, 9) AS umi, substr(r1_seq, 29, 20) AS beyond, substr(r1_seq, 2, 3) || substr(r1_seq, 11, 4) AS joined FROM pairs")
def umi_slice(spark, d):
    return R.read_pairs(spark, d).select("read_idx", seq.slice_between("r1_seq", 18, 27).alias("umi"), seq.slice_between("r1_seq", 28, 48).alias("beyond"), seq.join_slices("r1_seq", [1, 4, 10, 14]).alias("joined"))


@query(f"WITH {R.PAIRS} SELECT read_idx, regexp_matches(substr(r1_seq, 19, 9), '^(?:[AT][CG][ACGT][ACGT])') AS fits FROM pairs")
def umi_template_filter(spark, d):
    return R.read_pairs(spark, d).select("read_idx", seq.matches_template(seq.slice_between("r1_seq", 18, 27), seq.iupac_regex("WSNN")).alias("fits"))


@query("SELECT p_partkey, replace(replace(replace(replace(replace(t, 'a', '[ACGT]'), 'b', '[AT]'), 'c', '[CG]'), 'd', '[ACG]'), 'e', '[CT]') AS pattern FROM (SELECT p_partkey, translate(substr(md5(p_partkey::VARCHAR), 1, 6), '0123456789abcdef', 'abcdeabcdeabcdea') AS t FROM part)")
def iupac_regex(spark, d):
    template = F.translate(F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 6), R.HEX, "NWSVYNWSVYNWSVYN")
    return R.table(spark, d, "part").select("p_partkey", seq.iupac_regex_column(template).alias("pattern"))


@query(f"WITH {R.READS} SELECT id, len(list_filter(string_split(substr(qual, 1, 9), ''), lambda c: ascii(c) - 33 < 20))::INT AS low FROM reads")
def umi_quality_filter(spark, d):
    return R.reads(spark, d).select("id", seq.low_quality_bases(seq.slice_between("qual", 0, 9), 20).alias("low"))


@query(f"WITH {R.READS} SELECT id, round(100.0 * length(regexp_replace(seq, '[^AT]', '', 'g')) / length(seq), 6) AS percent FROM reads")
def at_content(spark, d):
    return R.reads(spark, d).select("id", rounded(seq.content_percent("seq", "AT")).alias("percent"))


@query(f"WITH {R.READS} SELECT id, round(100.0 * length(regexp_replace(seq, '[^GC]', '', 'g')) / length(seq), 6) AS percent FROM reads")
def gc_content(spark, d):
    return R.reads(spark, d).select("id", rounded(seq.content_percent("seq", "GC")).alias("percent"))


@query("SELECT doc_id, round(100.0 * length(regexp_replace(text, '[^ae]', '', 'g')) / nullif(length(text), 0), 6) AS percent FROM documents")
def text_content(spark, d):
    return R.table(spark, d, "documents").withColumn("text", F.nullif("text", F.lit(""))).select("doc_id", rounded(seq.content_percent("text", "ae")).alias("percent"))


@query(f"WITH {R.PAIRS} SELECT read_idx, CASE WHEN strpos(r2_seq, 'AAAAAAAAAA') > 0 THEN strpos(r2_seq, 'AAAAAAAAAA') - 1 END::INT AS place, CASE WHEN strpos(r2_seq, 'AAAAAAAAAA') > 0 THEN substr(r2_seq, 1, strpos(r2_seq, 'AAAAAAAAAA') - 1) ELSE r2_seq END AS trimmed FROM pairs")
def homopolymer_trim_exact(spark, d):
    place = seq.adaptor_position("r2_seq", "A", 10)
    return R.read_pairs(spark, d).select("read_idx", place.alias("place"), F.substring("r2_seq", F.lit(1), F.coalesce(place, F.length("r2_seq"))).alias("trimmed"))


@query(f"""WITH {R.PAIRS}, windows AS (SELECT read_idx, r2_seq, unnest(range(1, length(r2_seq) - 8)) AS i FROM pairs),
hits AS (SELECT read_idx, arg_min(substr(r2_seq, i, 10), i) AS w FROM windows WHERE length(replace(substr(r2_seq, i, 10), 'T', '')) <= 2 GROUP BY read_idx)
SELECT read_idx, CASE WHEN w IS NOT NULL THEN strpos(r2_seq, CASE WHEN strpos(w, 'T') > 0 THEN substr(w, strpos(w, 'T')) ELSE substr(w, 10, 1) END) - 1 END::INT AS place FROM pairs LEFT JOIN hits USING (read_idx)""")
def homopolymer_trim_fuzzy(spark, d):
    return R.read_pairs(spark, d).select("read_idx", seq.adaptor_position("r2_seq", "T", 10, 2).alias("place"))


def trim_sql(source: str, key: str, bases: str, quals: str) -> str:
    return f"""trim_places AS (SELECT {key} AS k, {bases} AS s, {quals} AS q, unnest(range(1, length({quals}) + 1)) AS i FROM {source}),
trim_steps AS (SELECT k, q, i, 20 - CASE WHEN substr(s, i, 1) = 'G' THEN 19 ELSE ascii(substr(q, i, 1)) - 33 END AS d FROM trim_places),
trim_sums AS (SELECT k, q, i, sum(d) OVER (PARTITION BY k ORDER BY i DESC) AS t FROM trim_steps),
trim_valid AS (SELECT *, min(t) OVER (PARTITION BY k ORDER BY i DESC) AS m FROM trim_sums),
trims AS (SELECT k, coalesce(arg_max(i, t * 1000 + i) FILTER (WHERE m >= 0 AND t > 0) - 1, length(any_value(q)))::INT AS cut FROM trim_valid GROUP BY k)"""


@query(f"WITH {R.READS}, {trim_sql('reads', 'id', 'seq', 'qual')} SELECT k AS id, cut FROM trims")
def quality_trim_index(spark, d):
    return R.reads(spark, d).select("id", seq.quality_trim_index("seq", "qual", 20).alias("cut"))


@query(f"WITH {R.READS}, {trim_sql('reads', 'id', 'seq', 'qual')} SELECT id, CASE WHEN cut + 1 >= 20 THEN substr(seq, 1, cut) END AS seq, CASE WHEN cut + 1 >= 20 THEN substr(qual, 1, cut) END AS qual FROM reads JOIN trims ON id = k")
def quality_trim(spark, d):
    # the length is a column of its own: inside a lambda "seq" would mean the alias beside it
    rows = R.reads(spark, d).withColumn("keep", seq.quality_trim_length("seq", "qual", 20, 20))
    return rows.select("id", *[F.substring(c, F.lit(1), F.col("keep")).alias(c) for c in ("seq", "qual")])


FILTER = read_filter.ReadFilter(barcode_length=10, umi_start=18, umi_end=27, umi_template="WNNNNNNNN", umi_quality_bases=6, min_length=20, at_content=70, gc_content=75)
_CUT = "CASE WHEN {n} > 20 AND strpos(substr(r2_seq, 1, {n}), repeat('{b}', 10)) > 0 THEN strpos(substr(r2_seq, 1, {n}), repeat('{b}', 10)) - 1 ELSE {n} END"
FILTERED = f"""{R.PAIRS}, c0 AS (SELECT *, length(r2_seq) AS n0 FROM pairs), c1 AS (SELECT *, {_CUT.format(n="n0", b="A")} AS n1 FROM c0), c2 AS (SELECT *, {_CUT.format(n="n1", b="T")} AS n2 FROM c1),
c3 AS (SELECT *, {_CUT.format(n="n2", b="G")} AS n3 FROM c2), c4 AS (SELECT *, {_CUT.format(n="n3", b="C")} AS n4 FROM c3), cuts AS (SELECT *, {_CUT.format(n="n4", b="N")} AS n FROM c4),
short AS (SELECT read_idx, substr(r2_seq, 1, n) AS s, substr(r2_qual, 1, n) AS q FROM cuts WHERE n > 0), {trim_sql("short", "read_idx", "s", "q")},
filtered AS (SELECT read_idx, split_part(name, ' ', 1) AS name, substr(r1_seq, 1, 10) AS barcode, substr(r1_seq, 19, 9) AS umi, r2_seq, n, cut,
  CASE WHEN NOT regexp_matches(substr(r1_seq, 19, 9), '^[AT][ACGT]{{8}}') THEN 'umi_template' WHEN len(list_filter(string_split(substr(r1_qual, 19, 9), ''), lambda c: ascii(c) - 33 < 20)) > 6 THEN 'umi_quality'
       WHEN 100.0 * length(regexp_replace(r2_seq, '[^AT]', '', 'g')) / length(r2_seq) >= 70 THEN 'at_content' WHEN 100.0 * length(regexp_replace(r2_seq, '[^GC]', '', 'g')) / length(r2_seq) >= 75 THEN 'gc_content'
       WHEN n < 20 THEN 'adaptor' WHEN cut IS NULL OR cut + 1 < 20 OR cut = 0 THEN 'too_short' END AS drop_reason
  FROM cuts LEFT JOIN trims ON read_idx = k)"""


@query(f"WITH {FILTERED} SELECT coalesce(drop_reason, 'kept') AS reason, count(*) AS reads FROM filtered GROUP BY ALL")
def read_filter_reasons(spark, d):
    return read_filter.filter_counts(read_filter.filter_reads(R.read_pairs(spark, d), FILTER))


@query(f"WITH {FILTERED} SELECT read_idx, name, barcode, umi, CASE WHEN drop_reason IS NULL THEN substr(r2_seq, 1, cut) ELSE r2_seq END AS seq, drop_reason FROM filtered")
def read_filter_rows(spark, d):
    return read_filter.filter_reads(R.read_pairs(spark, d), FILTER).drop("qual")


@query(f"WITH {R.PAIRS} SELECT a.read_idx, b.name, a.r1_seq, b.r2_seq, split_part(a.name, ' ', 1) = split_part(b.name, ' ', 1) AS same_name FROM pairs a JOIN pairs b USING (read_idx)")
def pair_zip(spark, d):
    p = R.read_pairs(spark, d)
    first = p.select("read_idx", "name", F.col("r1_seq").alias("seq"), F.col("r1_qual").alias("qual"))
    second = p.select("read_idx", "name", F.col("r2_seq").alias("seq"), F.col("r2_qual").alias("qual"))
    return read_filter.pair_reads(first, second).select("read_idx", "name", "r1_seq", "r2_seq", "same_name")


@query(f"WITH {R.READS} SELECT id, substr(seq, 4, length(seq) - 8) AS seq, substr(qual, 4, length(qual) - 8) AS qual FROM reads")
def read_clipping(spark, d):
    return read_filter.clip_reads(R.reads(spark, d).select("id", "seq", "qual"), 3, 5)


# ---- barcodes -------------------------------------------------------------------------------------


def demux_sql(distance: str, k: int, keep_one: bool) -> str:
    given = "hits = 1" + (" OR hits > 1" if keep_one else "")
    return f"""WITH {R.BARCODES}, {R.OBSERVED}, exact AS (SELECT observed, barcode, x, y FROM observed LEFT JOIN barcodes ON observed = barcode),
near AS (SELECT observed, b.barcode, b.x, b.y, {distance}::INT AS distance FROM exact e JOIN barcodes b ON e.barcode IS NULL AND {distance} <= {k}),
best AS (SELECT observed, min(distance) AS distance FROM near GROUP BY observed),
hit AS (SELECT observed, distance, count(*) AS hits, min(barcode) AS barcode, arg_min(x, barcode) AS x, arg_min(y, barcode) AS y FROM near JOIN best USING (observed, distance) GROUP BY ALL)
SELECT observed, 'Perfect' AS category, 0 AS distance, barcode, x, y FROM exact WHERE barcode IS NOT NULL
UNION ALL SELECT observed, CASE WHEN hits IS NULL THEN 'Unmatched' WHEN hits = 1 THEN 'Imperfect' ELSE 'Ambiguous' END, hit.distance, CASE WHEN {given} THEN hit.barcode END, CASE WHEN {given} THEN hit.x END, CASE WHEN {given} THEN hit.y END
FROM exact LEFT JOIN hit USING (observed) WHERE exact.barcode IS NULL"""


@query(f"WITH {R.BARCODES}, {R.OBSERVED} SELECT observed, x, y FROM observed JOIN barcodes ON observed = barcode")
def demux_exact(spark, d):
    return demux.match_barcodes(R.observed(spark, d), R.barcodes(spark, d), 0).where("category = 'Perfect'").select("observed", "x", "y")


@query(demux_sql("hamming(observed, b.barcode)", 1, False))
def demux_hamming(spark, d):
    return demux.match_barcodes(R.observed(spark, d), R.barcodes(spark, d), 1, "Hamming")


@query(demux_sql("levenshtein(observed, b.barcode)", 2, False))
def demux_levenshtein(spark, d):
    return demux.match_barcodes(R.observed(spark, d), R.barcodes(spark, d), 2, "Levenshtein")


@query(demux_sql("hamming(observed, b.barcode)", 2, True))
def demux_keep_one(spark, d):
    return demux.match_barcodes(R.observed(spark, d), R.barcodes(spark, d), 2, "Hamming", keep_one=True)


@query(f"SELECT category, count(*) AS reads FROM ({demux_sql('hamming(observed, b.barcode)', 1, False)}) JOIN (SELECT substr(b, 1, l_linenumber - 1) || substr('ACGT', (l_orderkey % 4)::INT + 1, 1) || substr(b, l_linenumber + 1) AS observed FROM (SELECT *, substr({R.sql_seq(chr(39) + 'b' + chr(39) + ' || l_suppkey')}, 1, 8) AS b FROM lineitem)) USING (observed) GROUP BY category")
def demux_categories(spark, d):
    reads = R.observed(spark, d).withColumnRenamed("observed", "barcode")
    return demux.category_counts(demux.demultiplex(reads, R.barcodes(spark, d), 1, "Hamming"))


# a part of the observed string within one edit is as long as the barcode, or one shorter or longer
_PARTS = "least(" + ", ".join(f"levenshtein(substr(observed, {i}, {n}), b.barcode)" for n in (7, 8, 9) for i in range(1, 14 - n)) + ")"
SUBGLOBAL = demux_sql(_PARTS, 1, False).replace("SELECT DISTINCT observed FROM items", "SELECT DISTINCT 'GT' || observed || 'AC' AS observed FROM items")


@query(SUBGLOBAL)
def demux_subglobal(spark, d):
    padded = R.observed(spark, d).select(F.concat(F.lit("GT"), "observed", F.lit("AC")).alias("observed"))
    return demux.match_barcodes(padded, R.barcodes(spark, d), 1, "Subglobal")


@query("""WITH words AS (SELECT DISTINCT substr(text, i, 24) AS w FROM (SELECT text, unnest(range(1, length(text) - 22)) AS i FROM benchmark)),
hit AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, substr(text, i, 24) AS w FROM (SELECT doc_id, text, unnest(range(1, length(text) - 22)) AS i FROM documents)) JOIN words USING (w))
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM hit)""")
def contaminant_anti(spark, d):
    docs = R.table(spark, d, "documents").select("doc_id", "text")
    return demux.shared_words(docs, R.table(spark, d, "benchmark").select("text"), 24, "doc_id", "text").select("doc_id")


# ---- annotation -----------------------------------------------------------------------------------


def steps_sql(stranded: bool, gaps: bool) -> str:
    strand = "strand" if stranded else "'.'"
    left = "LEFT JOIN" if gaps else "JOIN"
    outer = "UNION ALL SELECT chrom, strand, -1000000000000, min(low), [] FROM f GROUP BY chrom, strand UNION ALL SELECT chrom, strand, max(high), 1000000000000, [] FROM f GROUP BY chrom, strand" if gaps else ""
    return f"""{R.FEATURES}, f AS (SELECT chrom, {strand} AS strand, low, high, gene FROM features), cuts AS (SELECT chrom, strand, low AS place FROM f UNION SELECT chrom, strand, high FROM f),
spans AS (SELECT chrom, strand, place AS low, lead(place) OVER (PARTITION BY chrom, strand ORDER BY place) AS high FROM cuts),
elementary AS (SELECT s.chrom, s.strand, s.low, s.high, coalesce(list_sort(list(DISTINCT gene) FILTER (WHERE gene IS NOT NULL)), []) AS genes FROM spans s {left} f ON s.chrom = f.chrom AND s.strand = f.strand AND s.low < f.high AND s.high > f.low WHERE s.high IS NOT NULL GROUP BY ALL {outer}),
fresh AS (SELECT *, CASE WHEN lag(high) OVER w = low AND lag(genes) OVER w = genes THEN 0 ELSE 1 END AS fresh FROM elementary WINDOW w AS (PARTITION BY chrom, strand ORDER BY low)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom, strand ORDER BY low) AS run FROM fresh),
steps AS (SELECT chrom, strand, run, min(low) AS low, max(high) AS high, first(genes) AS genes FROM runs GROUP BY chrom, strand, run)"""


FOLDS = {
    "union": "list_sort(list_distinct(flatten(gs)))",
    "intersection-nonempty": "list_reduce(list_filter(gs, lambda g: len(g) > 0), lambda s, g: CASE WHEN len(s) > 0 THEN list_intersect(s, g) ELSE g END, []::VARCHAR[])",
    "intersection-strict": "list_reduce(gs, lambda s, g: CASE WHEN len(s) > 0 THEN list_intersect(s, g) ELSE g END, []::VARCHAR[])",
}


def annotate_sql(mode: str, stranded: str) -> str:
    """Blocks and steps meet in bins; a pair counts in the bin of its overlap's first base.  Endless steps end where the blocks do."""
    strand = {"yes": "CASE WHEN flag = 16 THEN '-' ELSE '+' END", "reverse": "CASE WHEN flag = 16 THEN '+' ELSE '-' END", "no": "'.'"}[stranded]
    return f"""{R.ALIGNMENTS}, {steps_sql(stranded != "no", mode == "intersection-strict")},
near_steps AS (SELECT chrom, strand, genes, greatest(low, (SELECT min(low) FROM blocks)) AS low, least(high, (SELECT max(high) FROM blocks)) AS high FROM steps),
binned_steps AS (SELECT *, unnest(range(low // 1024, (high - 1) // 1024 + 1)) AS bin FROM near_steps WHERE low < high),
binned_blocks AS (SELECT id, chrom, {strand} AS strand, block, low, high, unnest(range(low // 1024, (high - 1) // 1024 + 1)) AS bin FROM blocks),
met AS (SELECT b.id, list(s.genes ORDER BY b.block, s.low) AS gs FROM binned_blocks b JOIN binned_steps s ON b.chrom = s.chrom AND b.strand = s.strand AND b.bin = s.bin WHERE b.low < s.high AND b.high > s.low AND b.bin = greatest(b.low, s.low) // 1024 GROUP BY b.id),
sets AS (SELECT a.id, a.flag, list_sort(coalesce({FOLDS[mode]}, [])) AS genes FROM alignments a LEFT JOIN met USING (id)),
labels AS (SELECT id, CASE WHEN flag = 4 THEN '__not_aligned' WHEN len(genes) = 0 THEN '__no_feature' WHEN len(genes) = 1 THEN genes[1] ELSE '__ambiguous[' || array_to_string(genes, '+') || ']' END AS gene FROM sets)"""


def annotated(spark, d, mode: str, stranded: str) -> DataFrame:
    return annotate.annotate(R.alignments(spark, d), R.features(spark, d), mode, stranded)


@query(f"WITH {steps_sql(True, False)} SELECT chrom, strand, low, high, array_to_string(genes, '+') AS genes FROM steps")
def feature_steps(spark, d):
    return annotate.feature_steps(R.features(spark, d)).select("chrom", "strand", "low", "high", F.array_join("genes", "+").alias("genes"))


@query(f"WITH {annotate_sql('union', 'no')} SELECT id, gene FROM labels")
def annotate_union(spark, d):
    return annotated(spark, d, "union", "no")


@query(f"WITH {annotate_sql('intersection-nonempty', 'yes')} SELECT id, gene FROM labels")
def annotate_nonempty(spark, d):
    return annotated(spark, d, "intersection-nonempty", "yes")


@query(f"WITH {annotate_sql('intersection-strict', 'yes')} SELECT id, gene FROM labels")
def annotate_strict(spark, d):
    return annotated(spark, d, "intersection-strict", "yes")


@query(f"WITH {annotate_sql('intersection-nonempty', 'reverse')} SELECT id, gene FROM labels")
def annotate_reverse(spark, d):
    return annotated(spark, d, "intersection-nonempty", "reverse")


@query(f"WITH {annotate_sql('union', 'yes')} SELECT id, gene, NOT (gene IN ('__not_aligned', '__too_low_aQual', '__no_feature') OR contains(gene, '__ambiguous')) AS assigned FROM labels")
def annotate_labels_filter(spark, d):
    return annotate.keep_annotated(annotated(spark, d, "union", "yes"), no_ambiguous=True)


@query(f"WITH {R.ALIGNMENTS} SELECT id, block, low, high FROM blocks")
def cigar_blocks(spark, d):
    return R.alignments(spark, d).select("id", F.explode(cigar.aligned_blocks("cigar", "pos")).alias("b")).select("id", "b.block", "b.low", "b.high")


@query(f"""WITH {R.ALIGNMENTS}, ends AS (SELECT id, flag, pos - CASE cigar WHEN '5S25M' THEN 5 ELSE 0 END AS low, pos + CASE cigar WHEN '30M' THEN 30 WHEN '10M20N15M' THEN 45 WHEN '5S25M' THEN 25 ELSE 32 END AS high FROM alignments)
SELECT id, CASE WHEN flag = 16 THEN high ELSE low END AS start, CASE WHEN flag = 16 THEN low ELSE high END AS "end" FROM ends""")
def softclip_positions(spark, d):
    null = F.lit(None).cast("string")
    rows = R.alignments(spark, d).withColumns({"name": F.col("id"), "umi": null, "gene": null, "x": F.lit(None).cast("int"), "y": F.lit(None).cast("int")})
    return dedup.transcripts(rows).select(F.col("clear_name").alias("id"), "start", "end")


@query(f"WITH {R.ALIGNMENTS} SELECT id, CASE WHEN flag = 4 THEN 'unmapped' ELSE 'mapped' END AS kind FROM alignments")
def unmapped_split(spark, d):
    mapped, unmapped = records.split_mapped(R.alignments(spark, d))
    return mapped.withColumn("kind", F.lit("mapped")).unionByName(unmapped.withColumn("kind", F.lit("unmapped"))).select("id", "kind")


@query(f"""WITH {R.ALIGNMENTS}, scored AS (SELECT *, (pos % 40)::INT AS score, (pos % 23)::INT AS loci, repeat('A', 30) AS seq FROM alignments), matched AS (SELECT id, sum(high - low) AS n FROM blocks GROUP BY id)
SELECT id FROM scored JOIN matched USING (id) WHERE n >= 26 AND n >= 0.5 * length(seq) AND score >= 10 AND score >= 0.4 * length(seq) AND loci <= 20""")
def accepted_alignments(spark, d):
    rows = R.alignments(spark, d).withColumns({"score": (F.col("pos") % 40).cast("int"), "loci": (F.col("pos") % 23).cast("int"), "seq": F.repeat(F.lit("A"), F.lit(30))})
    return records.accepted(rows, min_length=26, min_score=10, min_score_ratio=0.4, min_matched_ratio=0.5, max_loci=20).select("id")


@query(f"WITH {R.ALIGNMENTS} SELECT id, split_part(chrom, '#', 1) AS gene FROM alignments")
def transcriptome_genes(spark, d):
    rows = R.alignments(spark, d).withColumn("chrom", F.replace("chrom", F.lit("#"), F.lit(" ")))
    return annotate.transcriptome_genes(rows).select("id", "gene")


@query("SELECT 'g' || (p_partkey % 97) AS gene, arg_max(p_brand, (10 * p_partkey + 5 * p_size) * 1000000 - p_partkey) AS chrom, max(10 * p_partkey + 5 * p_size) AS \"end\" FROM part GROUP BY ALL")
def gene_ends(spark, d):
    return annotate.gene_ends(parse_gff(R.gff_lines(spark, d)))


@query("""SELECT p_partkey AS line_no, p_brand AS seqname, CASE WHEN p_partkey % 3 = 0 THEN 'gene' ELSE 'exon' END AS feature, 10 * p_partkey + 1 AS start, 10 * p_partkey + 5 * p_size AS "end", CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand,
NULL::VARCHAR AS score, 'g' || (p_partkey % 97) AS gene_id, replace(p_name, ' ', '-') AS gene_name, p_type AS gene_type, NULL::VARCHAR AS tag, 'loose' AS info5, '2' AS level FROM part""")
def gff_parse(spark, d):
    rows = parse_gff(R.gff_lines(spark, d))
    named = [F.try_element_at("attrs", F.lit(k)).alias(k.lower()) for k in ("gene_id", "gene_name", "gene_type", "tag", "INFO5", "level")]
    return rows.select("line_no", "seqname", "feature", "start", "end", "strand", "score", *named)


@query("SELECT p_partkey AS line_no, len(string_split_regex(p_name || ' , ' || p_type, '\\s*,\\s*'))::INT AS n, string_split_regex(p_name || ' , ' || p_type, '\\s*,\\s*')[2] AS second FROM part")
def gff_list_values(spark, d):
    values = list_value(F.concat("p_name", F.lit(" , "), "p_type"))
    return R.table(spark, d, "part").select(F.col("p_partkey").alias("line_no"), F.size(values).alias("n"), values[1].alias("second"))


@query("SELECT p_partkey AS line_no, 2 AS n, replace(p_name, ' ', '-') AS first, p_type AS second, '2' AS level FROM part")
def gff_attribute_lists(spark, d):
    attributes = F.concat(F.lit('alias "'), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" , "), "p_type", F.lit('"; level=2; tag .'))
    rows = R.table(spark, d, "part").select(F.col("p_partkey").alias("line_no"), attribute_lists(attributes).alias("lists"))
    return rows.select("line_no", F.size(F.col("lists")["alias"]).alias("n"), F.col("lists")["alias"][0].alias("first"), F.col("lists")["alias"][1].alias("second"), F.col("lists")["level"][0].alias("level"))


@query("""WITH ends AS (SELECT 'g' || (p_partkey % 97) AS gene, arg_max(p_brand, (10 * p_partkey + 5 * p_size) * 1000000 - p_partkey) AS chrom, max(10 * p_partkey + 5 * p_size) AS "end" FROM part GROUP BY ALL),
pairs AS (SELECT DISTINCT s_suppkey % 97 AS a, (s_suppkey * 7 + 1) % 97 AS b FROM supplier)
SELECT '__ambiguous[g' || a || '+g' || b || ']' AS gene, CASE WHEN y."end" > x."end" THEN y.chrom ELSE x.chrom END AS chrom, greatest(x."end", y."end") AS "end" FROM pairs JOIN ends x ON x.gene = 'g' || a JOIN ends y ON y.gene = 'g' || b""")
def ambiguous_gene_ends(spark, d):
    key = F.col("s_suppkey")
    label = F.concat(F.lit("__ambiguous[g"), (key % 97).cast("string"), F.lit("+g"), ((key * 7 + 1) % 97).cast("string"), F.lit("]"))
    return annotate.label_ends(R.table(spark, d, "supplier").select(label.alias("gene")), annotate.gene_ends(parse_gff(R.gff_lines(spark, d))))


# ---- counts ---------------------------------------------------------------------------------------


@query(f"WITH {R.COUNTS} SELECT x, y, spot, gene, count FROM counts")
def counts_long(spark, d):
    return counts.counts_long(R.counts(spark, d))


PIVOT_GENES = [f"g{i}" for i in range(97)]  # all of them


@query(f"WITH {R.COUNTS} SELECT spot, " + ", ".join(f"coalesce(sum(count) FILTER (WHERE gene = '{g}'), 0)::BIGINT AS {g}" for g in PIVOT_GENES) + " FROM counts GROUP BY spot")
def counts_pivot(spark, d):
    return counts.pivot_counts(R.counts(spark, d), PIVOT_GENES)


@query(f"WITH {R.COUNTS} SELECT spot, gene, count FROM counts WHERE gene IN ({', '.join(repr(g) for g in PIVOT_GENES)})")
def counts_melt(spark, d):
    return counts.melt_counts(counts.pivot_counts(R.counts(spark, d), PIVOT_GENES))


STATS = f"""{R.COUNTS}, spots AS (SELECT spot, sum(count)::BIGINT AS reads, count(*) AS genes FROM counts GROUP BY spot),
stats AS (SELECT max(genes) AS max_genes_feature, min(genes) AS min_genes_feature, max(reads) AS max_reads_feature, min(reads) AS min_reads_feature, round(avg(reads), 6) AS average_reads_feature, round(avg(genes), 6) AS average_genes_feature,
  round(stddev_pop(reads), 6) AS std_reads_feature, round(stddev_pop(genes), 6) AS std_genes_feature, sum(reads)::BIGINT AS reads_after_duplicates_removal, count(*) AS barcodes_found, (SELECT count(DISTINCT gene) FROM counts) AS genes_found FROM spots)"""


def rounded_stats(frame: DataFrame) -> DataFrame:
    return frame.withColumns({c: rounded(c) for c in frame.columns if c.startswith(("average", "std"))})


@query(f"WITH {STATS} SELECT * FROM stats")
def dataset_stats(spark, d):
    return rounded_stats(counts.dataset_stats(R.counts(spark, d)))


@query(f"WITH {STATS}, cells AS (SELECT max(count) AS max_count, min(count) AS least, count(*) AS n FROM counts) SELECT stats.*, max_count, CASE WHEN n = barcodes_found * genes_found THEN least ELSE 0 END AS min_count FROM stats, cells")
def qa_stats(spark, d):
    return rounded_stats(qa.qa_stats(R.counts(spark, d)))


@query(f"WITH {R.COUNTS} SELECT 'spot' AS kind, spot AS name, sum(count)::BIGINT AS total, count(*) FILTER (WHERE count > 0) AS above_0, count(*) FILTER (WHERE count > 1) AS above_1, count(*) FILTER (WHERE count > 2) AS above_2 FROM counts GROUP BY spot UNION ALL SELECT 'gene', gene, sum(count)::BIGINT, count(*) FILTER (WHERE count > 0), count(*) FILTER (WHERE count > 1), count(*) FILTER (WHERE count > 2) FROM counts GROUP BY gene")
def qa_thresholds(spark, d):
    c = R.counts(spark, d)
    both = [qa.threshold_counts(c, by).select(F.lit(by).alias("kind"), F.col(by).alias("name"), "total", "above_0", "above_1", "above_2") for by in ("spot", "gene")]
    return both[0].unionByName(both[1])


@query(f"WITH {R.COUNTS}, spots AS (SELECT sum(count)::DOUBLE AS v FROM counts GROUP BY spot), ends AS (SELECT min(v) AS mn, max(v) AS mx FROM spots) SELECT least(floor((v - mn) / (mx - mn) * 20), 19)::INT AS bin, count(*) AS n FROM spots, ends GROUP BY bin")
def hist_reads_spot(spark, d):
    return qa.histogram(counts.per_spot(R.counts(spark, d)), "reads", 20).select("bin", "n")


@query(f"""WITH {R.COUNTS}, spots AS (SELECT sum(count)::DOUBLE AS v FROM counts GROUP BY spot), shape AS (SELECT count(*) AS n, min(v) AS mn, max(v) AS mx, stddev_samp(v) * count(*) ** -0.2 AS w FROM spots),
grid AS (SELECT mn - 3 * w + i * (mx - mn + 6 * w) / 99 AS place, n, w FROM shape, range(100) t(i)) SELECT round(place, 6) AS "at", round(sum(exp(-0.5 * ((place - v) / w) ** 2)) / (n * w * sqrt(2 * pi())), 9) AS density FROM grid, spots GROUP BY place, n, w""")
def density_reads_spot(spark, d):
    return qa.density(counts.per_spot(R.counts(spark, d)), "reads").select(rounded("at").alias("at"), rounded("density", 9).alias("density"))


@query(f"WITH {R.COUNTS} SELECT x::DOUBLE AS x, y::DOUBLE AS y, sum(count)::BIGINT AS reads, count(*) AS genes FROM counts GROUP BY x, y")
def spot_scatter(spark, d):
    return qa.spot_scatter(R.counts(spark, d))


# ---- saturation -----------------------------------------------------------------------------------


@query("SELECT floor(1000 + 1000 * exp(x))::BIGINT AS point FROM range(15) t(x) WHERE floor(1000 + 1000 * exp(x)) < (SELECT count(*) FROM lineitem)")
def saturation_points(spark, d):
    return spark.createDataFrame([(p,) for p in saturation.saturation_points(R.table(spark, d, "lineitem").count())], "point long")


SAMPLED = f"""{R.READS}, points AS (SELECT p::BIGINT AS point FROM unnest({list(R.POINTS)}) t(p) WHERE p < (SELECT count(*) FROM reads)),
ranked AS (SELECT reads.*, point, row_number() OVER (PARTITION BY point ORDER BY md5(point || '_' || id), id) AS r FROM reads, points), sampled AS (SELECT * FROM ranked WHERE r <= point)"""


@query(f"WITH {SAMPLED} SELECT point, id FROM sampled")
def saturation_subsamples(spark, d):
    reads = R.reads(spark, d)
    return saturation.subsamples(reads, saturation.saturation_points(reads.count(), R.POINTS), "id").select("point", "id")


@query(f"""WITH {SAMPLED}, marked AS (SELECT *, CASE WHEN strand = lag(strand) OVER w AND start - lag(start) OVER w <= {OFFSET} THEN 0 ELSE 1 END AS fresh FROM sampled WINDOW w AS (PARTITION BY point, gene, x, y ORDER BY strand, start)),
sessions AS (SELECT *, sum(fresh) OVER (PARTITION BY point, gene, x, y ORDER BY strand, start) AS session FROM marked), cells AS (SELECT point, gene, x, y, count(DISTINCT (session, umi)) AS n FROM sessions GROUP BY ALL),
spots AS (SELECT point, x, y, sum(n) AS reads, count(*) AS genes FROM cells GROUP BY ALL)
SELECT point, sum(reads)::BIGINT AS reads, (SELECT count(DISTINCT gene) FROM cells c WHERE c.point = s.point) AS genes, round(avg(genes), 6) AS avg_genes, round(avg(reads), 6) AS avg_reads FROM spots s GROUP BY point""")
def saturation_curve(spark, d):
    reads = R.reads(spark, d)
    curve = saturation.saturation_curve(reads, saturation.saturation_points(reads.count(), R.POINTS), "id", OFFSET, 0)
    return curve.withColumns({"avg_genes": rounded("avg_genes"), "avg_reads": rounded("avg_reads")})


# ---- records and matrices -------------------------------------------------------------------------


@query("WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx, count(*) OVER () AS total FROM orders) SELECT o_orderkey, idx, floor(idx / ceil(total / 4))::BIGINT AS chunk FROM n")
def split_chunks(spark, d):
    orders = R.table(spark, d, "orders").select("o_orderkey")
    return records.split_chunks(records.numbered(orders, ["o_orderkey"]), 4).select("o_orderkey", F.col("idx").cast("long").alias("idx"), "chunk")


@query("SELECT 0 AS part, s_suppkey AS k FROM supplier UNION ALL SELECT 1, c_custkey FROM customer")
def merge_union(spark, d):
    a = R.table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"))
    b = R.table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return records.merge([a, b]).select("part", "k")


def coordinates(spark, d) -> DataFrame:
    s = R.table(spark, d, "supplier").where("s_suppkey % 3 <> 0")
    return s.select(F.col("s_suppkey").alias("line_no"), (F.col("s_suppkey") % 10).cast("int").alias("x"), F.floor(F.col("s_suppkey") / 10).cast("int").alias("y"), (F.col("s_suppkey") % 10 * 10.5).alias("new_x"), (F.col("s_nationkey") + 0.25).alias("new_y"), (F.col("s_suppkey") % 5).cast("int").alias("under_tissue"))


COORDINATES = "coordinates AS (SELECT (s_suppkey % 10)::INT AS x, (s_suppkey // 10)::INT AS y, s_suppkey % 10 * 10.5::DOUBLE AS new_x, s_nationkey + 0.25::DOUBLE AS new_y FROM supplier WHERE s_suppkey % 3 <> 0 AND s_suppkey % 5 <> 0)"


@query(f"WITH {R.COUNTS}, {COORDINATES} SELECT new_x::DOUBLE || 'x' || new_y::DOUBLE AS spot, gene, count FROM counts JOIN coordinates USING (x, y)")
def adjust_coordinates(spark, d):
    return matrix.adjust_coordinates(R.counts(spark, d).select("spot", "gene", "count"), coordinates(spark, d), update=True)


@query(f"WITH {R.COUNTS}, {COORDINATES} SELECT spot, gene, count FROM counts JOIN coordinates USING (x, y)")
def select_coordinates(spark, d):
    return matrix.adjust_coordinates(R.counts(spark, d).select("spot", "gene", "count"), coordinates(spark, d))


@query(f"""WITH {R.COUNTS}, names AS (SELECT 'g' || (p_partkey % 97) AS gene, arg_max(p_name, p_partkey) AS name FROM part WHERE p_partkey % 97 < 90 GROUP BY ALL),
cols AS (SELECT DISTINCT gene, "column" FROM counts), ranked AS (SELECT gene, name, row_number() OVER (PARTITION BY name ORDER BY "column") AS r FROM cols LEFT JOIN names USING (gene))
SELECT spot, CASE WHEN name IS NOT NULL AND r = 1 THEN name ELSE gene END AS gene, count, "column" FROM counts JOIN ranked USING (gene)""")
def gene_rename_first_wins(spark, d):
    names = R.table(spark, d, "part").where("p_partkey % 97 < 90").select(F.concat(F.lit("g"), (F.col("p_partkey") % 97).cast("string")).alias("gene_id"), F.col("p_name").alias("gene_name"), F.col("p_partkey").alias("line_no"))
    return matrix.rename_genes(R.counts(spark, d).select("spot", "gene", "count", "column"), names)


@query(f"WITH {R.COUNTS}, types AS (SELECT 'g' || (p_partkey % 97) AS gene, arg_max(p_type, p_partkey) AS type FROM part WHERE p_partkey % 97 < 90 GROUP BY ALL) SELECT spot, gene, count FROM counts LEFT JOIN types USING (gene) WHERE type IS NULL OR type IN ('ECONOMY', 'PROMO')")
def filter_gene_types(spark, d):
    types = matrix.gene_type_table(parse_gff(R.gff_lines(spark, d)), by_id=True).where(F.substring("gene", 2, 9).cast("int") < 90)
    return matrix.filter_gene_types(R.counts(spark, d).select("spot", "gene", "count"), types, ["ECONOMY", "PROMO"])


# ---- several datasets -----------------------------------------------------------------------------


def datasets(spark, d) -> DataFrame:
    return R.counts(spark, d, by_dataset=True).where("NOT (dataset = 'A' AND column % 11 = 0) AND NOT (dataset = 'R' AND column % 7 = 0)")


DATASETS = f"""{R.DATASETS.replace("counts AS", "every AS", 1)}, counts AS (SELECT * FROM every WHERE NOT (dataset = 'A' AND substr(gene, 2)::INT % 11 = 0) AND NOT (dataset = 'R' AND substr(gene, 2)::INT % 7 = 0)),
totals AS (SELECT dataset, gene, sum(count)::BIGINT AS total FROM counts GROUP BY ALL), pairs AS (SELECT a.dataset AS dataset1, b.dataset AS dataset2, gene, a.total AS total1, b.total AS total2 FROM totals a JOIN totals b USING (gene))"""


@query(f"WITH {DATASETS} SELECT gene FROM totals GROUP BY gene HAVING count(*) = (SELECT count(DISTINCT dataset) FROM totals)")
def multi_common_genes(spark, d):
    return multi_qa.common_genes(datasets(spark, d))


@query(f"WITH {DATASETS} SELECT DISTINCT gene FROM totals")
def multi_all_genes(spark, d):
    return multi_qa.all_genes(datasets(spark, d))


@query(f"WITH {DATASETS} SELECT dataset1, dataset2, round(count(*) / any_value(genes), 6) AS similarity FROM pairs JOIN (SELECT dataset AS dataset1, count(*) AS genes FROM totals GROUP BY ALL) USING (dataset1) GROUP BY dataset1, dataset2")
def multi_gene_similarity(spark, d):
    return multi_qa.gene_similarity(datasets(spark, d)).withColumn("similarity", rounded("similarity"))


@query(f"WITH {DATASETS}, common AS (SELECT gene FROM totals GROUP BY gene HAVING count(*) = (SELECT count(DISTINCT dataset) FROM totals)) SELECT dataset, round(count(*) FILTER (WHERE gene IN (SELECT gene FROM common)) / count(*), 6) AS share FROM totals GROUP BY dataset")
def multi_shared_with_all(spark, d):
    return multi_qa.shared_with_all(datasets(spark, d)).withColumn("share", rounded("share"))


@query(f"WITH {DATASETS} SELECT dataset1, dataset2, round(corr(ln(total1), ln(total2)), 6) AS correlation FROM pairs GROUP BY ALL")
def multi_gene_correlation(spark, d):
    return multi_qa.gene_correlation(datasets(spark, d), use_log=True).withColumn("correlation", rounded("correlation"))


@query(f"WITH {DATASETS}, spots AS (SELECT dataset, spot, sum(count)::DOUBLE AS reads, count(*)::DOUBLE AS genes FROM counts GROUP BY ALL), long AS (SELECT dataset, 'reads' AS measure, reads AS value FROM spots UNION ALL SELECT dataset, 'genes', genes FROM spots) SELECT dataset, measure, min(value) AS least, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS largest, round(avg(value), 6) AS mean FROM long GROUP BY ALL")
def multi_violin_stats(spark, d):
    frame = multi_qa.violin_stats(datasets(spark, d))
    return frame.withColumns({c: rounded(c) for c in ("q1", "median", "q3", "mean")})


@query(f"WITH {DATASETS} SELECT d.dataset, g.gene, coalesce(total, 0)::BIGINT AS total FROM (SELECT DISTINCT dataset FROM totals) d CROSS JOIN (SELECT DISTINCT gene FROM totals) g LEFT JOIN totals t ON t.dataset = d.dataset AND t.gene = g.gene")
def multi_gene_totals_filled(spark, d):
    return multi_qa.filled_totals(datasets(spark, d))


# three centred points: the Gram matrix has one eigenvalue of 0, the others solve a quadratic equation, and an
# eigenvector is the cross product of two rows of the matrix less the eigenvalue
PCA = f"""WITH {DATASETS}, logs AS (SELECT d.dataset, g.gene, ln(1 + coalesce(total, 0)) AS v FROM (SELECT DISTINCT dataset FROM totals) d CROSS JOIN (SELECT DISTINCT gene FROM totals) g LEFT JOIN totals t ON t.dataset = d.dataset AND t.gene = g.gene),
centred AS (SELECT dataset, gene, v - avg(v) OVER (PARTITION BY gene) AS v FROM logs), wide AS (SELECT sum(v) FILTER (WHERE dataset = 'A') AS a, sum(v) FILTER (WHERE dataset = 'N') AS n, sum(v) FILTER (WHERE dataset = 'R') AS r FROM centred GROUP BY gene),
gram AS (SELECT sum(a * a) AS aa, sum(a * n) AS an, sum(a * r) AS ar, sum(n * n) AS nn, sum(n * r) AS nr, sum(r * r) AS rr FROM wide),
half AS (SELECT *, (aa + nn + rr) / 2 AS h, sqrt(((aa + nn + rr) / 2) ** 2 - (aa * nn - an * an + aa * rr - ar * ar + nn * rr - nr * nr)) AS s FROM gram),
roots AS (SELECT *, 'pc1' AS pc, h + s AS l FROM half UNION ALL SELECT *, 'pc2', h - s FROM half),
vectors AS (SELECT pc, an * nr - ar * (nn - l) AS x, ar * an - (aa - l) * nr AS y, (aa - l) * (nn - l) - an * an AS z FROM roots),
signed AS (SELECT pc, x, y, z, sqrt(2) / sqrt(x * x + y * y + z * z) * CASE WHEN abs(x) >= greatest(abs(y), abs(z)) THEN sign(x) WHEN abs(y) >= abs(z) THEN sign(y) ELSE sign(z) END AS f FROM vectors),
long AS (SELECT pc, 'A' AS dataset, x * f AS v FROM signed UNION ALL SELECT pc, 'N', y * f FROM signed UNION ALL SELECT pc, 'R', z * f FROM signed)
SELECT dataset, round(sum(v) FILTER (WHERE pc = 'pc1'), 6) AS pc1, round(sum(v) FILTER (WHERE pc = 'pc2'), 6) AS pc2 FROM long GROUP BY dataset"""


@query(PCA)
def multi_pca(spark, d):
    return multi_qa.pca(datasets(spark, d)).select("dataset", rounded("pc1").alias("pc1"), rounded("pc2").alias("pc2"))

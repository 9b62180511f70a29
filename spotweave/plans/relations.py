"""Reads, barcodes, features, alignments and counts derived from the driver's tables, in Spark and in SQL.

The encodings are the same for both engines: bases and qualities are translated digests of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEX, BASES, QUALITIES = "0123456789abcdef", "ACGTACGTACGTACGT", "!#%)+-/258;=?BEI"
CIGARS = ("30M", "10M20N15M", "5S25M", "12M3I10M2D8M")
POINTS = (100, 1000, 5000)
SPREAD_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame) -> DataFrame:
    """A table of few bytes, which one task would read, dealt to all cores; a larger one as it is, as its files are split."""
    size = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return frame.repartition(frame.sparkSession.sparkContext.defaultParallelism) if size <= SPREAD_BYTES else frame


def seq_of(key: Column) -> Column:
    return F.translate(F.md5(key.cast("string")), HEX, BASES)


def qual_of(key: Column) -> Column:
    return F.translate(F.md5(F.concat(F.lit("q"), key.cast("string"))), HEX, QUALITIES)


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, key = spread(table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")), F.col("event_id")
    strand = F.when(key % 2 == 0, "+").otherwise("-")
    return e.select(
        key.alias("id"), F.concat(F.lit("read"), key.cast("string")).alias("clear_name"), F.col("event_type").alias("gene"), F.col("user_id").cast("int").alias("x"), (F.col("user_id") % 7).cast("int").alias("y"),
        strand.alias("strand"), key.alias("start"), F.substring(seq_of(key), 1, 4).alias("umi"), seq_of(key).alias("seq"), qual_of(key).alias("qual"),
    )


def read_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 has barcode and identifier; R2 of some keys has runs of one base."""
    key = F.col("event_id")
    r1, r2 = seq_of(F.concat(F.lit("f"), key.cast("string"))), seq_of(key)
    run = F.when(key % 5 == 0, F.repeat(F.lit("A"), 12)).when(key % 5 == 1, F.repeat(F.lit("G"), 11)).when(key % 5 == 2, F.concat(F.repeat(F.lit("T"), 6), F.lit("C"), F.repeat(F.lit("T"), 5))).otherwise("")
    long = F.concat(F.substring(r2, 1, 24), run, F.substring(r2, 25, 8))
    quality = F.rpad(F.concat(qual_of(key), F.repeat(F.lit("E"), 12)), F.length(long).cast("int"), F.lit("E"))
    return spread(table(spark, sf_dir, "events").select("event_id")).select(
        key.alias("read_idx"), F.concat(F.lit("read"), key.cast("string"), F.lit(" 2:N")).alias("name"), r1.alias("r1_seq"), qual_of(F.concat(F.lit("f"), key.cast("string"))).alias("r1_qual"),
        F.substring(long, F.lit(1), F.length(long)).alias("r2_seq"), F.substring(quality, F.lit(1), F.length(long)).alias("r2_qual"),
    )


def barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.substring(seq_of(F.concat(F.lit("b"), F.col("s_suppkey").cast("string"))), 1, 8).alias("barcode"), F.col("s_nationkey").alias("x"), F.col("s_suppkey").cast("int").alias("y"))


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes of line items with one base written over; one row per item."""
    true = F.substring(seq_of(F.concat(F.lit("b"), F.col("l_suppkey").cast("string"))), 1, 8)
    base = F.substring(F.lit("ACGT"), (F.col("l_orderkey") % 4 + 1).cast("int"), F.lit(1))
    n = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(F.concat(F.substring(true, F.lit(1), n - 1), base, F.substring(true, n + 1, F.lit(8))).alias("observed"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.col("p_partkey") * 10
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("chrom"), low.alias("low"), (low + F.col("p_size") * 5).alias("high"), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("strand"), F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("gene"))


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
    cigar = F.element_at(F.array(*map(F.lit, CIGARS)), (F.col("l_orderkey") % 4 + 1).cast("int"))
    flag = F.when(F.col("l_linenumber") == 7, 4).when(F.col("l_linenumber") % 2 == 1, 16).otherwise(0)
    rows = rows.select(F.col("p_brand").alias("chrom"), (F.col("l_partkey") * 10 + F.col("l_quantity").cast("long")).alias("pos"), cigar.alias("cigar"), flag.alias("flag"), F.lit(255).alias("mapq")).distinct()
    return rows.withColumn("id", F.concat_ws(":", "chrom", F.col("pos").cast("string"), "cigar", F.col("flag").cast("string")))


def counts(spark: SparkSession, sf_dir: str, by_dataset: bool = False) -> DataFrame:
    """Line items as counts; a gene's column is its number."""
    x, y = (F.col("l_suppkey") % 10).cast("int"), F.floor(F.col("l_suppkey") / 10).cast("int")
    rows = table(spark, sf_dir, "lineitem").select(x.alias("x"), y.alias("y"), (F.col("l_partkey") % 97).cast("int").alias("column"), F.col("l_returnflag").alias("dataset"))
    keys = (["dataset"] if by_dataset else []) + ["x", "y", "column"]
    out = rows.groupBy(*keys).agg(F.count("*").alias("count"))
    return out.withColumns({"spot": F.concat_ws("x", F.col("x").cast("string"), F.col("y").cast("string")), "gene": F.concat(F.lit("g"), F.col("column").cast("string"))})


def gff_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    strand = F.when(F.col("p_size") % 2 == 0, "+").otherwise("-")
    attrs = F.concat(F.lit('gene_id "g'), (k % 97).cast("string"), F.lit('"; gene_name "'), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit('"; gene_type '), F.col("p_type"), F.lit("; tag .; loose; tag NA; level=2;"))
    line = F.concat_ws("\t", "p_brand", F.lit("src"), F.when(k % 3 == 0, "gene").otherwise("exon"), (k * 10 + 1).cast("string"), (k * 10 + F.col("p_size") * 5).cast("string"), F.lit("."), strand, F.lit("."), attrs)
    return table(spark, sf_dir, "part").select(k.alias("line_no"), line.alias("value"))


# ---- the same relations in SQL -------------------------------------------------------------------


def sql_seq(key: str) -> str:
    return f"translate(md5(({key})::VARCHAR), '{HEX}', '{BASES}')"


def sql_qual(key: str) -> str:
    return f"translate(md5('q' || ({key})::VARCHAR), '{HEX}', '{QUALITIES}')"


READS = f"""reads AS (
  SELECT event_id AS id, 'read' || event_id AS clear_name, event_type AS gene, user_id::INT AS x, (user_id % 7)::INT AS y, CASE WHEN event_id % 2 = 0 THEN '+' ELSE '-' END AS strand,
         event_id AS start, substr({sql_seq("event_id")}, 1, 4) AS umi, {sql_seq("event_id")} AS seq, {sql_qual("event_id")} AS qual FROM events)"""
_R2 = f"""substr({sql_seq("event_id")}, 1, 24) || CASE event_id % 5 WHEN 0 THEN 'AAAAAAAAAAAA' WHEN 1 THEN 'GGGGGGGGGGG' WHEN 2 THEN 'TTTTTTCTTTTT' ELSE '' END || substr({sql_seq("event_id")}, 25, 8)"""
PAIRS = f"""pairs AS (
  SELECT event_id AS read_idx, 'read' || event_id || ' 2:N' AS name, {sql_seq("'f' || event_id")} AS r1_seq, {sql_qual("'f' || event_id")} AS r1_qual, {_R2} AS r2_seq,
         substr({sql_qual("event_id")} || 'EEEEEEEEEEEE', 1, length({_R2})) AS r2_qual FROM events)"""
BARCODES = f"""barcodes AS (
  SELECT barcode, first(x ORDER BY x, y) AS x, first(y ORDER BY x, y) AS y FROM (SELECT substr({sql_seq("'b' || s_suppkey")}, 1, 8) AS barcode, s_nationkey AS x, s_suppkey::INT AS y FROM supplier) GROUP BY barcode)"""
OBSERVED = f"""items AS (
  SELECT substr(b, 1, l_linenumber - 1) || substr('ACGT', (l_orderkey % 4)::INT + 1, 1) || substr(b, l_linenumber + 1) AS observed FROM (SELECT *, substr({sql_seq("'b' || l_suppkey")}, 1, 8) AS b FROM lineitem)
), observed AS (SELECT DISTINCT observed FROM items)"""
FEATURES = """features AS (
  SELECT p_brand AS chrom, 10 * p_partkey AS low, 10 * p_partkey + 5 * p_size AS high, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, 'g' || p_partkey AS gene FROM part)"""
ALIGNMENTS = """alignments AS (
  SELECT *, concat_ws(':', chrom, pos, cigar, flag) AS id FROM (SELECT DISTINCT p_brand AS chrom, l_partkey * 10 + l_quantity::BIGINT AS pos, (['30M', '10M20N15M', '5S25M', '12M3I10M2D8M'])[(l_orderkey % 4)::INT + 1] AS cigar,
         CASE WHEN l_linenumber = 7 THEN 4 WHEN l_linenumber % 2 = 1 THEN 16 ELSE 0 END AS flag FROM lineitem JOIN part ON l_partkey = p_partkey)
), shapes(cigar, block, lo, hi) AS (
  VALUES ('30M', 0, 0, 30), ('10M20N15M', 0, 0, 10), ('10M20N15M', 1, 30, 45), ('5S25M', 0, 0, 25), ('12M3I10M2D8M', 0, 0, 12), ('12M3I10M2D8M', 1, 12, 22), ('12M3I10M2D8M', 2, 24, 32)
), blocks AS (SELECT id, chrom, flag, block, pos + lo AS low, pos + hi AS high FROM alignments JOIN shapes USING (cigar))"""
COUNTS = """counts AS (
  SELECT x, y, x || 'x' || y AS spot, 'g' || col AS gene, col AS "column", count(*) AS count FROM (SELECT (l_suppkey % 10)::INT AS x, (l_suppkey // 10)::INT AS y, (l_partkey % 97)::INT AS col FROM lineitem) GROUP BY x, y, col)"""
DATASETS = """counts AS (
  SELECT dataset, x || 'x' || y AS spot, 'g' || col AS gene, count(*) AS count FROM (SELECT l_returnflag AS dataset, (l_suppkey % 10)::INT AS x, (l_suppkey // 10)::INT AS y, (l_partkey % 97)::INT AS col FROM lineitem) GROUP BY dataset, x, y, col)"""

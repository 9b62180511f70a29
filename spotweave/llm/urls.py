"""URL filters: host and path rules, then a character language-model ratio.

Two variable-order Markov models, of accepted and of rejected URLs, are interpolated from the longest
context seen down to single characters.  A URL that no rule fits is blocked if the mean log-likelihood
difference of its characters is above a threshold calibrated on labelled URLs that the models were not
trained on.  Everything is DataFrame functions.  The models are tables whose size depends on the labelled
URLs alone (by default SEED_URLS rows, of a few thousand contexts times the alphabet); up to a checked size they are broadcast,
and a page meets no other page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.storage import small_side, stored

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Words of unwanted and of ordinary addresses, and the commonest English letter pairs.
REJECTED_WORDS = (
    "casino bet bets betting win winner jackpot poker slots roulette bingo lotto gamble pills viagra cialis pharma pharmacy meds cheap discount replica fake adult sex sexy porn xxx nude cams escort dating hookup "
    "spam scam phish malware virus crack cracked warez torrent keygen hack hacks cheats click popup tracker adserver affiliate traffic loan loans payday credit debt cash money rich earn crypto miner coins "
    "weightloss diet detox miracle free gratis bonus prize gift cards followers likes seo backlinks essay"
)
ACCEPTED_WORDS = (
    "news wiki library science garden school travel history music kitchen weather museum journal research health nature city council forum docs open data university theatre books review daily times post river "
    "mountain village bridge forest ocean energy climate physics biology chemistry math language culture art design photo film radio sport football tennis cycling hiking cooking recipes coffee bread wine "
    "bank insurance market trade company office hotel airport railway transit map guide blog story article about contact support help manual software developer code project linux python cloud network security "
    "people family children parents teacher student nurse doctor clinic hospital charity church club society press magazine gazette herald tribune observer academy institute foundation association ministry "
    "police court law tax jobs career shop store house home studio lab group digital media online world global local national european"
)
LETTER_PAIRS = "th he in er an re nd at on nt ha es st en ed to it ou ea hi is or ti as te et ng of al de se le ion the and ent tha wh sh ble ly"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./-_"
SEED_URLS = 4000
ORDER = 3  # characters of the longest context
MASS = 1.5  # pseudo-count that a context lends to the next shorter one


def host_of(url: str | Column) -> Column:
    """Between the first :// and the next /, ? or #, with A-Z in lower case; else empty."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str | Column) -> Column:
    """What follows the host up to ? or #; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], give: int | None = None) -> Column:
    """Of the longest rule that fits: its verdict (give=0) or its text; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        out = F.when(fits, F.lit(rule[0] if give == 0 else rule[1] + rule[2])).otherwise(out)
    return out


#: What an address is made of besides its words: prefixes, domains, and beginnings and ends of paths, the same for either label.
JOINS, PREFIXES, SUFFIXES = ("-", "-", "-", ""), ("", "", "www.", "m.", "blog.", "en."), (".example", "", "")
TOP = (".com", ".com", ".org", ".net", ".de", ".fr", ".co.uk", ".io", ".info")
FOLDERS, ENDS = ("/", "/", "/en/", "/de/", "/fr/", "/es/", "/2021/05/", "/wiki/", "/p/", "/category/", "/index.php/"), ("", "", "/", ".html", ".php")


def seed_urls(spark: SparkSession) -> DataFrame:
    """The labelled URLs (n, bad, text), made by rule; only their words differ by label.

    A choice is made by the digest of the URL's number and the choice's.  The host of a rejected URL has
    two of the rejected words; that of an accepted one has accepted words or is made of letter pairs.  Paths
    have a number or two of the label's words.
    """
    words = {k: v.split() for k, v in (("bad", REJECTED_WORDS), ("good", ACCEPTED_WORDS), ("pair", LETTER_PAIRS))}

    def number(salt: int) -> Column:
        return F.conv(F.substring(F.md5(F.concat(F.col("n").cast("string"), F.lit(f":{salt}"))), 1, 8), 16, 10).cast("long")

    def pick(values: Sequence[str], salt: int) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (number(salt) % len(values) + 1).cast("int"))

    is_bad, pairs = F.col("n") % 2 == 1, F.concat(pick(words["pair"], 4), pick(words["pair"], 5), pick(words["pair"], 6))
    bad = F.concat(pick(words["bad"], 1), pick(JOINS, 2), pick(words["bad"], 3))
    good = F.when(F.col("n") % 4 < 2, pairs).otherwise(F.concat(pick(words["good"], 7), pick(JOINS, 8), pick(words["good"], 9)))
    host = F.concat(pick(PREFIXES, 10), F.when(is_bad, bad).otherwise(good), pick(SUFFIXES, 11), pick(TOP, 12))
    slug = F.concat(F.when(is_bad, pick(words["bad"], 16)).otherwise(pick(words["good"], 17)), F.lit("-"), F.when(is_bad, pick(words["bad"], 18)).otherwise(pick(words["good"], 19)))
    path = F.concat(pick(FOLDERS, 13), F.when(number(20) % 3 == 0, slug).otherwise((number(14) % 10_000).cast("string")), pick(ENDS, 15))
    # n // 2 pairs a rejected with an accepted URL; every fifth pair is kept for calibration
    return spark.range(SEED_URLS).withColumnRenamed("id", "n").select("n", is_bad.alias("bad"), F.concat(host, path).alias("text"))


def symbols(text: Column) -> Column:
    """Characters outside the alphabet become blanks; ORDER blanks go before."""
    return F.concat(F.lit(" " * ORDER), F.regexp_replace(F.lower(text), r"(?s)[^a-z0-9./_-]", " "))


def grams(table: DataFrame, *keep: str) -> DataFrame:
    """A row for each character: ``gram`` is the character with its ORDER predecessors; null if there is none."""
    at = F.explode_outer(F.when(F.length("text") > ORDER, F.sequence(F.lit(1), F.length("text") - ORDER)))
    return table.select(*keep, "text", at.alias("at")).select(*keep, F.substring("text", F.col("at"), F.lit(ORDER + 1)).alias("gram"))


def markov_tables(labelled: DataFrame) -> list[DataFrame]:
    """For each context length k from 0 on: (g, d), d the log-likelihood difference of the last character.

    A table of k > 0 has every context of k characters seen with either label, with every character.  It is
    marked for broadcast if its size allows.
    """
    counted = grams(labelled.select("bad", symbols(F.col("text")).alias("text")), "bad").groupBy("bad", "gram").agg(F.count("*").alias("n"))
    counted = stored(counted)
    every = F.explode(F.split(F.lit("\x01".join(ALPHABET + " ")), "\x01"))
    size = float(len(ALPHABET) + 1)
    both = [F.sum(F.when(F.col("bad") == b, F.col("n")).otherwise(0)).cast("double").alias(name) for b, name in ((False, "good_n"), (True, "bad_n"))]
    probabilities: DataFrame | None = None
    tables = []
    for k in range(ORDER + 1):
        seen = counted.select("bad", "n", F.substring("gram", ORDER + 1 - k, k + 1).alias("g")).groupBy("g").agg(*both)
        context = F.substring("g", 1, k) if k else F.lit("")
        totals = seen.groupBy(context.alias("h")).agg(F.sum("good_n").alias("good_all"), F.sum("bad_n").alias("bad_all"))
        full = totals.select("*", every.alias("c")).select("h", "good_all", "bad_all", F.concat("h", "c").alias("g")).join(seen, "g", "left").na.fill(0.0, ["good_n", "bad_n"])
        if probabilities is None:
            p = [((F.col(f"{b}_n") + 0.5) / (F.col(f"{b}_all") + 0.5 * size)).alias(f"{b}_p") for b in ("good", "bad")]
        else:
            shorter = probabilities.select(F.col("g").alias("s"), F.col("good_p").alias("good_q"), F.col("bad_p").alias("bad_q"))
            full = full.join(shorter, F.substring("g", 2, k) == F.col("s"))
            p = [((F.col(f"{b}_n") + MASS * F.col(f"{b}_q")) / (F.col(f"{b}_all") + MASS)).alias(f"{b}_p") for b in ("good", "bad")]
        probabilities = stored(full.select("g", *p))
        tables.append(small_side(probabilities.select("g", (F.log("bad_p") - F.log("good_p")).alias("d"))))
    return tables


def likelihood_difference(texts: DataFrame, tables: list[DataFrame], *keep: str) -> DataFrame:
    """Adds ``difference``: mean over the characters of the longest context's log-likelihood difference.

    Above 0 the rejected model fits better; null where ``text`` has no characters.  The rows kept by must
    differ from each other.
    """
    found = grams(texts, *keep)
    best = F.lit(None).cast("double")
    for k, table in enumerate(tables):
        found = found.join(table.select(F.col("g").alias(f"g{k}"), F.col("d").alias(f"d{k}")), F.substring("gram", ORDER + 1 - k, k + 1) == F.col(f"g{k}"), "left")
        best = F.coalesce(F.col(f"d{k}"), best)
    return found.groupBy(*keep).agg(F.round(F.sum(best) / F.count("gram"), 9).alias("difference"))


def calibrated_threshold(labelled: DataFrame, tables: list[DataFrame]) -> float:
    """Midway between the 98th percentile of accepted and the 5th of rejected URLs, and at least 0."""
    scored = likelihood_difference(labelled.select("n", symbols(F.col("text")).alias("text"), "bad"), tables, "n", "bad")
    row = scored.agg(F.percentile(F.when(~F.col("bad"), F.col("difference")), 0.98).alias("good"), F.percentile(F.when(F.col("bad"), F.col("difference")), 0.05).alias("bad")).first()
    return max(0.0, ((row["good"] or 0.0) + (row["bad"] or 0.0)) / 2)


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labelled: DataFrame | None = None, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, difference.

    Rules fit their host and its subdomains and beginnings of the path; the longest wins.  A null URL or
    one without :// has an empty host and path, fits no rule and is allowed, as the models have nothing to
    read.  Repeated rows are judged alike; other columns are not read.
    """
    labelled = stored(seed_urls(pages.sparkSession) if labelled is None else labelled)
    held = F.floor(F.col("n") / 2) % 5 == 0
    tables = markov_tables(labelled.where(~held))
    threshold = calibrated_threshold(labelled.where(held), tables)
    rows = pages.select(pages[page_id].cast("long").alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    numbered = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("rule", rule_column(F.col("host"), F.col("path"), rules))
    text = numbered.withColumn("text", F.when(F.col("rule").isNull(), symbols(F.concat("host", "path"))))
    scored = likelihood_difference(text, tables, "row", "page_id", "host", "path", "rule")
    by_rule = rule_column(F.col("host"), F.col("path"), rules, 0)
    by_model = F.when(F.coalesce(F.col("difference"), F.lit(0.0)) > threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_model).alias("verdict"), "difference")

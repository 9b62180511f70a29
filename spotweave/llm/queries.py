"""The queries ``opN_*``: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm import decontamination, html_text, mixing, near_duplicates, pii, quality, repeated_bytes, token_counts, toxicity, urls
from spotweave.llm.batches import read_table

#: Name of the vocabulary file; public_tokenizers gives its place.
VOCABULARY = "word_bpe_49k.json"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))

    def named(spans: Column) -> Column:
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, pii.KINDS)), s["kind"]).alias("k"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, pii.KINDS), F.sha2(named(F.col("base")), 256).alias("base_sha256"), named(F.concat("base", "added")).alias("spans"), F.size(F.concat("base", "added")).cast("long").alias("n_spans"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), decontamination.BUDGET_PERCENT)


def op5_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.remove_repeats(read_table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(toxicity.labelled_rows(docs, read_table(spark, sf_dir, "labels")))
    return toxicity.score_toxicity(docs, lexicon).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_mixing, op3_pii, op4_decontamination, op5_repeated_bytes, op6_html_text, op7_urls, op8_near_duplicates, op9_token_counts, op10_toxicity)}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality": op1_sql(), "op2_mixing": OP2_SQL, "op5_repeated_bytes": OP5_SQL, "op7_urls": op7_sql(), "op8_near_duplicates": OP8_SQL}


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS print, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight, 2.0::DOUBLE * source_size AS cap,
         1.5::DOUBLE * sum(source_size) OVER () AS budget FROM totals
), levels AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
), targets AS (
  SELECT source, source_size, CASE WHEN cap <= level * weight THEN cap ELSE
         (budget - sum(CASE WHEN cap <= level * weight THEN cap ELSE 0 END) OVER ()) / sum(CASE WHEN cap <= level * weight THEN 0 ELSE weight END) OVER () * weight END AS target FROM levels
), rates AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null:' || coalesce(sized.source, 'null')) || ':' || print), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT))::BIGINT AS taken FROM rates
"""

# every window of 100 bytes by its hash, cut from pieces of a text, as a place in a long string is dear to find
OP5_SQL = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (SELECT doc_id, k * 1000 AS base, substr(h, 2000 * k + 1, 2198) AS p FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2000 + 1)) AS k FROM texts)),
windows AS (SELECT doc_id, base + i AS place, hash(substr(p, 2 * i + 1, 200)) AS w FROM (SELECT doc_id, base, p, unnest(range(0, length(p) // 2 - 99)) AS i FROM pieces)),
again AS (SELECT doc_id, place FROM (SELECT doc_id, place, row_number() OVER (PARTITION BY w ORDER BY doc_id, place) AS r FROM windows) WHERE r > 1),
marked AS (SELECT doc_id, place, CASE WHEN place <= lag(place) OVER (PARTITION BY doc_id ORDER BY place) + 100 THEN 0 ELSE 1 END AS fresh FROM again),
runs AS (SELECT doc_id, place, sum(fresh) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM marked),
spans AS (SELECT doc_id, min(place) AS low, max(place) + 100 AS high FROM runs GROUP BY doc_id, run),
gaps AS (SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS a, low AS b FROM spans UNION ALL SELECT doc_id, coalesce(max(high), 0), NULL FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a, b NULLS LAST) AS h FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, (length(texts.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM texts JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""


def op1_sql(limits: quality.QualityLimits = quality.QualityLimits()) -> str:
    """The quality rules with references summed in SQL."""
    classes = ("[^a-z]", "[^A-Z]", "[^0-9]", "[^ \\t\\x0b\\x0c\\r]", "[^\\n]", "[^.,;:!?''\"()-]", "[^#*$%&|<>]")
    counted = [f"length(regexp_replace(t, '{c}', '', 'g'))" for c in classes] + ["length(regexp_replace(t, '[\\x00-\\x7F]', '', 'g'))"]
    pairs = ", ".join(f"({i if i < 7 else 8}, {c})" for i, c in enumerate(counted))
    vocabulary = ", ".join("('" + w.decode().replace("'", "''") + "')" for w in quality.VOCABULARY)
    langs = ", ".join(f"'{k}'" for k in quality.COMMON_WORDS)
    marks = quality.STRIP.decode().replace("'", "''")

    def distance(kind: str) -> str:
        """Distance of every document from every reference, by a sum over cells."""
        return f"""
{kind}_doc AS (SELECT doc_id, cell, n, n / greatest(sum(n) OVER (PARTITION BY doc_id), 1) AS p FROM {kind}_cells),
{kind}_ref AS (SELECT lang, cell, n / greatest(sum(n) OVER (PARTITION BY lang), 1) AS q FROM (SELECT lang, cell, sum(n)::DOUBLE AS n FROM {kind}_cells JOIN docs USING (doc_id) WHERE lang IN ({langs}) GROUP BY lang, cell)),
{kind}_distance AS (SELECT doc_id, lang, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END), 0) / 2) AS d, sum(n) AS size FROM {kind}_doc JOIN {kind}_ref USING (cell) GROUP BY doc_id, lang)"""

    return f"""
WITH docs AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
split AS (SELECT doc_id, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS times FROM (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM split))),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM windows, range(8) r(k) WHERE times > 1 GROUP BY doc_id),
seven AS (SELECT doc_id, t, c.cell, c.n FROM docs, LATERAL (VALUES {pairs}) c(cell, n)),
char_cells AS (SELECT doc_id, cell, n FROM seven UNION ALL SELECT doc_id, 7, any_value(length(t)) - sum(n) FROM seven GROUP BY doc_id),
plain AS (SELECT doc_id, unnest(regexp_extract_all(translate(translate(t, '{marks}', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')) AS word FROM docs),
vocabulary(word) AS (VALUES {vocabulary}), cells AS (SELECT word AS cell FROM vocabulary UNION ALL SELECT ''),
found AS (SELECT doc_id, coalesce(v.word, '') AS cell, count(*) AS n FROM plain LEFT JOIN vocabulary v USING (word) GROUP BY ALL),
word_cells AS (SELECT d.doc_id, c.cell, coalesce(f.n, 0) AS n FROM docs d CROSS JOIN cells c LEFT JOIN found f ON f.doc_id = d.doc_id AND f.cell = c.cell),{distance("char")},{distance("word")},
near AS (SELECT doc_id, bool_or((c.size < {limits.min_chars} OR c.d <= {limits.char_limit} + {limits.char_slack} / sqrt(greatest(c.size, 1))) AND (w.size < {limits.min_judged_words} OR w.d <= {limits.word_limit} + {limits.word_slack} / sqrt(greatest(w.size, 1)))) AS near
  FROM char_distance c JOIN word_distance w USING (doc_id, lang) GROUP BY doc_id),
base AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM docs JOIN split USING (doc_id) LEFT JOIN repeats USING (doc_id))
SELECT base.*, n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words AS base_failed,
  NOT (n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words) AND coalesce(near, true) AS kept FROM base LEFT JOIN near USING (doc_id)"""


def op7_sql() -> str:
    """The URL filter with its models counted, interpolated and calibrated in SQL."""
    u = urls

    def number(salt: int) -> str:
        return f"('0x' || substr(md5(n || ':{salt}'), 1, 8))::BIGINT"

    def pick(values, salt: int) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + f"][{number(salt)} % {len(values)} + 1]"

    bad, good, pair = u.REJECTED_WORDS.split(), u.ACCEPTED_WORDS.split(), u.LETTER_PAIRS.split()
    name = f"CASE WHEN n % 2 = 1 THEN {pick(bad, 1)} || {pick(u.JOINS, 2)} || {pick(bad, 3)} WHEN n % 4 < 2 THEN {pick(pair, 4)} || {pick(pair, 5)} || {pick(pair, 6)} ELSE {pick(good, 7)} || {pick(u.JOINS, 8)} || {pick(good, 9)} END"
    slug = f"CASE WHEN n % 2 = 1 THEN {pick(bad, 16)} || '-' || {pick(bad, 18)} ELSE {pick(good, 17)} || '-' || {pick(good, 19)} END"
    path = f"{pick(u.FOLDERS, 13)} || CASE WHEN {number(20)} % 3 = 0 THEN {slug} ELSE ({number(14)} % 10000)::VARCHAR END || {pick(u.ENDS, 15)}"
    folded = f"'{' ' * u.ORDER}' || regexp_replace(lower(text), '[^a-z0-9./_-]', ' ', 'g')"
    size, order = len(u.ALPHABET) + 1, u.ORDER
    tables = ""
    for k in range(order + 1):
        seen = f"SELECT substr(gram, {order + 1 - k}, {k + 1}) AS g, sum(n) FILTER (WHERE NOT bad) AS good_n, sum(n) FILTER (WHERE bad) AS bad_n FROM counted GROUP BY g"
        every = f"SELECT h || c AS g, good_all, bad_all FROM (SELECT substr(g, 1, {k}) AS h, coalesce(sum(good_n), 0) AS good_all, coalesce(sum(bad_n), 0) AS bad_all FROM seen{k} GROUP BY h), (SELECT unnest(string_split('{u.ALPHABET} ', '')) AS c)"
        chance = [f"(coalesce({b}_n, 0) + 0.5::DOUBLE) / ({b}_all + {0.5 * size}::DOUBLE)" if not k else f"(coalesce({b}_n, 0) + {u.MASS}::DOUBLE * q.{b}_p) / ({b}_all + {u.MASS}::DOUBLE)" for b in ("good", "bad")]
        shorter = f" JOIN p{k - 1} q ON q.g = substr(e.g, 2)" if k else ""
        tables += f"seen{k} AS ({seen}), every{k} AS ({every}),\np{k} AS (SELECT e.g, {chance[0]} AS good_p, {chance[1]} AS bad_p FROM every{k} e LEFT JOIN seen{k} s ON s.g = e.g{shorter}),\n"
    longest = "coalesce(" + ", ".join(f"ln(p{k}.bad_p) - ln(p{k}.good_p)" for k in reversed(range(order + 1))) + ")"
    joins = " ".join(f"LEFT JOIN p{k} ON p{k}.g = substr(gram, {order + 1 - k})" for k in range(order + 1))
    ranked = sorted(u.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN" for _, h, p in ranked]
    rule = "CASE " + " ".join(f"{f} '{h}{p}'" for f, (_, h, p) in zip(fits, ranked)) + " END"
    given = "CASE " + " ".join(f"{f} '{v}'" for f, (v, _, _) in zip(fits, ranked)) + " END"
    return f"""
WITH seeds AS (SELECT n, n % 2 = 1 AS bad, {pick(u.PREFIXES, 10)} || {name} || {pick(u.SUFFIXES, 11)} || {pick(u.TOP, 12)} || {path} AS text FROM range({u.SEED_URLS}) t(n)),
parts AS (SELECT page_id, row_number() OVER () AS r, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
judged AS (SELECT *, {rule} AS rule, {given} AS given FROM parts),
texts AS (SELECT 'seed' AS kind, n AS id, bad, {folded} AS text FROM seeds UNION ALL SELECT 'page', r, NULL, {folded} FROM (SELECT r, host || path AS text FROM judged WHERE rule IS NULL)),
grams AS (SELECT kind, id, bad, substr(text, i, {order + 1}) AS gram FROM (SELECT *, unnest(range(1, length(text) - {order} + 1)) AS i FROM texts)),
counted AS (SELECT bad, gram, count(*) AS n FROM grams WHERE kind = 'seed' AND id // 2 % 5 <> 0 GROUP BY ALL),
{tables}scored AS (SELECT kind, id, any_value(bad) AS bad, round(sum({longest}) / count(*), 9) AS difference FROM grams {joins} WHERE kind = 'page' OR id // 2 % 5 = 0 GROUP BY kind, id),
threshold AS (SELECT greatest(0, (quantile_cont(difference, 0.98) FILTER (WHERE NOT bad) + quantile_cont(difference, 0.05) FILTER (WHERE bad)) / 2) AS least FROM scored WHERE kind = 'seed')
SELECT page_id, host, path, rule, coalesce(given, CASE WHEN coalesce(difference, 0) > least THEN 'block' ELSE 'allow' END) AS verdict FROM judged LEFT JOIN scored ON kind = 'page' AND id = r CROSS JOIN threshold"""

"""The field on rows written apart from those that it is trained on (they were looked at while its features were chosen), and the query's digest columns against brute force."""

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from spotweave.llm import pii
from spotweave.llm.queries import op3_pii
from tests.llm.test_operators import brute_spans, odd_rows

MARK = re.compile(r"\[\[(email|ip|card|phone)\|(.*?)\]\]")
# [[kind|...]] is personal; all else is not.
ROWS = """
The plumber can be reached under [[phone|0711-4455667]] until noon.
Please phone our Leeds branch on [[phone|0113 496 0721]] before Friday.
She left a message: ring back at [[phone|555-0176]], it is urgent
For refunds dial [[phone|1-888-555-0119]] and hold the line
Notre bureau: tel [[phone|04 91 55 12 87]], tous les jours
Sprechstunde nur nach Anruf, Telefon [[phone|(0761) 20378-0]]
My new mobile is [[phone|07911 123456]]; the old one is gone.
Office [[phone|(312) 555-0164]], fax [[phone|(312) 555-0165]]
Para reservas llame al [[phone|934 567 812]] por la tarde
Hotline: [[phone|0800 1238765]] (free of charge)
If lost, call [[phone|310-555-0143]]
Tel: [[phone|5550149]]
You may text [[phone|07700 900982]] or [[phone|07700 900983]] to vote
Outside the country use [[phone|0044 1632 960555]].
Contact the warden ([[phone|01632 960777]]) in an emergency
call [[phone|646 555 0111]] for Joe
Kundenservice [[phone|030-4502210]], Montag bis Freitag
numero vert [[phone|0 800 123 456]] appel gratuit
They charged my card [[card|4539 5787 6362 1486]] twice
Visa [[card|4716-1089-9971-6531]] on file
The number embossed was [[card|5425.2334.3010.9903]], she said
Refund to [[card|4929722653797141]] please
debit [[card|2223 0031 2200 3222]] every month
the stolen one ends so: [[card|6011 1111 1111 1117]]
amex [[card|3759 876543 21001]] only
and [[card|8730912846510293]] was printed on the receipt
traffic came from [[ip|198[.]51[.]100[.]23]] last night
resolve to [[ip|2001:db8:0:1::42]] instead
the resolver at [[ip|2606:4700:4700::1111]] replied
host [[ip|10.24.0.8]] is unreachable
we banned [[ip|185[.]220[.]101[.]4]] and [[ip|45[.]9[.]148[.]3]]
next hop [[ip|fe80::a00:27ff:fe4e:66a1]]
drop me a line: [[email|karen at bluefield dot com]]
reach [[email|support[at]northwind[dot]org]] for help
his mail is [[email|d.lopez (at) correo (dot) es]]
[[email|press (at) museum (dot) de]] answers
send the form to [[email|registry @ college.edu]] by May
email [[email|olivia[at]paperboat.net]] about it
you can write [[email|editor at dailypost dot net]] any time
contact: [[email|hr(at)acme(dot)com]]
or to [[email|m.weber@kanzlei-weber.de]] directly
The battle of 1066 and the treaty of 1648 are in chapter 12.
Between 2004-2009 prices rose by 3.75 percent a year.
Her essay (ISBN 978-0-14-103614-4) sold 120,000 copies.
ISBN 0-19-853453-1 is out of print
The train leaves at 07:45 and arrives at 11:20.
On 2019-11-03 the river stood at 4.25 m.
He was born on 23.08.1912 and died on 07/06/1954.
It weighs 12.5 kg and costs 1.299,00 euros.
Social security 219-09-9999 was printed by mistake.
Results: 21-19, 18-21, 21-15.
The file has 1048576 bytes in 256 blocks.
Python 3.11.4 and gcc 12.2.0 are installed.
Mount the shelf with 4 screws of 3.5 x 40.
commit 9fceb02d0ae598e95dc970b74767f19372d61af8
uuid 123e4567-e89b-12d3-a456-426614174000
Population: 8 336 817 in the census of 2020.
Go to 40.7128, -74.0060 and wait.
Invoice 2021-004512 for order 90-11834 was paid.
Flight 447 left from gate 22 at 19:03.
Route 66 and Highway 101 meet nowhere near 90210.
See articles 12, 13 and 14 of law 1881-29.
e is about 2.718281828 and phi 1.6180339887
Serial number 7781029 of 10000000
They walked 20 000 steps on 3 days
The tweet by @riverwatch42 had 1,204 likes.
Meet us at the old mill, at noon.
Join the dots, dot by dot.
A dot com company of 1999
Part no. 88-1203-4 fits all models since 1987
The MAC address is 3C:22:FB:10:9A:7E here
rows 100 to 250 of table 3.2
Bible verses: 3:16, 8:28 and 12:1
EAN 5901234123457 scanned 3 times
batch 20240817-03 passed
bus lines 12, 43, 110 and 217
paragraph 823(1) and section 14.2.1
on 12 May 1999 at 3 pm
tracking 1Z999AA10123456784 is lost
pH 7.35-7.45 is normal
""".strip().split("\n")


def found(tagger, texts):
    return [{(pii.KINDS[k], t.encode()[s:e].decode()) for s, k, e in base + more} for t, (base, more) in zip(texts, pii.detect(pa.array(texts), tagger))]


def test_rows_written_apart():
    """Exact spans, all kinds: precision of 0.9 and recall of 0.8 at least; each kind alone a little less."""
    tagger = pii.Tagger()
    plain = [MARK.sub(r"\2", row) for row in ROWS]
    want = [set(MARK.findall(row)) for row in ROWS]
    got = found(tagger, plain)
    right, given, wanted = Counter(), Counter(), Counter()
    for w, g in zip(want, got):
        right.update(k for k, _ in w & g)
        given.update(k for k, _ in g)
        wanted.update(k for k, _ in w)
    assert right.total() >= 0.9 * given.total(), [(sorted(g - w), p) for w, g, p in zip(want, got, plain) if g - w]
    assert right.total() >= 0.8 * wanted.total(), [(sorted(w - g), p) for w, g, p in zip(want, got, plain) if w - g]
    for kind in pii.KINDS:
        assert right[kind] >= 0.8 * given[kind] and right[kind] >= 0.7 * wanted[kind], kind


def test_query_columns(spark, tmp_path):
    """Counts, digest and spans of the query, from patterns and offsets in code points found by Python's own expressions."""
    rows = [(d, t) for d, t, *_ in odd_rows()] + [(900, "é mail a.b@c.de, ip 1.2.3.4 and +1 (234) 567-8901; card 4111 1111 1111 1111"), (901, "call (555) 123-4567 or 1.2.3.4 "), (902, "a@b.c a@b.c 999.1.1.1")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op3_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    texts = {d: t for d, t in rows}
    for r in got:
        base = brute_spans(texts[r["doc_id"]] or "")
        named = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(kind == i for _, kind, _ in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        spans = [x for x in r["spans"].split(",") if x]
        assert set(named) <= set(spans) and spans == sorted(spans, key=lambda x: (int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0]))) and r["n_spans"] == len(spans)
    assert "phone:5:19" in next(r["spans"] for r in got if r["doc_id"] == 901)


def test_masked_texts(spark):
    frame = spark.createDataFrame([(1, "é call (555) 123-4567 or a@b.de.", 5), (2, None, 6)], "doc_id long, text string, kind int")
    got = {r["doc_id"]: r["text"] for r in pii.mask_personal_data(frame).orderBy(F.col("doc_id")).collect()}
    assert got == {1: "é call [phone] or [email].", 2: None}

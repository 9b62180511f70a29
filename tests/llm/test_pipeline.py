"""The corpus pipeline against its stages' models on a fixture."""

import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import DOCS, brute_components, odd_rows, prose


def test_stages(spark, tmp_path):
    rows = [(*r, None, "clash", 1, "clash") for r in odd_rows()]
    leak = "the quick green stone walked over to the other river and then it was gone for ever"
    filler = next(r[1] for r in odd_rows() if r[0] == 5)
    rows.append((500, filler + " start " + leak + " end " + filler[::-1], "en", "s1", 0, "clash", 1, "clash"))
    rows.append((501, prose(random.Random(99), 150) + " mail me@here.example.org", "en", "s1", 0, "clash", 1, "clash"))
    frame = spark.createDataFrame(rows, DOCS)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / f"stage{i}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{i}"))
        seen.append(docs)
    kept = [r["doc_id"] for r in seen[0].select("doc_id").collect()]
    assert 50 not in kept and 52 not in kept and 65 not in kept and 500 in kept and kept.count(60) == 2
    texts = {r["doc_id"]: r["text"] for r in seen[0].collect() if r["doc_id"] is not None}
    want = brute_components(texts.items(), corpus_pipeline.SIMILAR_PERCENT)
    stay = [r["doc_id"] for r in seen[1].select("doc_id").collect()]
    assert sorted(i for i in stay if i is not None) == sorted(i for i in want if want[i][1] == i)
    assert seen[2].where("doc_id = 500").count() == 0 and seen[2].count() == seen[1].count() - 1
    assert seen[3].count() == seen[2].count() and seen[3].where(F.col("text").contains("me@here")).count() == 0
    masked = seen[3].where("doc_id = 501").first()
    assert masked["text"].endswith("[email]") and masked["n_chars"] == len(masked["text"])
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, ran.select("doc_id", "text", "copy").collect())) == sorted(map(str, seen[4].select("doc_id", "text", "copy").collect()))


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline", *(n for n in names if n.startswith("op"))} <= names
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 11))

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import queries
from tests.llm.helpers import odd_docs, words
from tests.llm.test_ngram_join import brute
from tests.llm.test_operators import mixed, pieces

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("which", ["odd", "table"])
def test_each_stage_on_its_own_input(spark, which):
    docs = odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars") if which == "odd" else spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, SF).select(*columns).collect(), docs.schema)
        after = docs.collect()
        assert set(after) <= set(before)
        if name == "quality classifier":
            kept = queries.op8_quality_classifier(spark, SF).where("kept").select("doc_id").collect()
            assert which == "odd" or {r["doc_id"] for r in after} == {r["doc_id"] for r in kept}
        elif name == "exact dedup":
            low = {}
            for r in before:
                t = r["text"] or ""
                low[t] = min(low.get(t, (True, 0)), (r["doc_id"] is None, r["doc_id"] or 0))
            assert Counter(r["text"] or "" for r in after) == Counter(low.keys())
            assert {(r["doc_id"] is None, r["doc_id"] or 0) for r in after} == set(low.values())
        elif name.startswith("n-gram"):
            stay = {k[0] for k in brute(before) if k[0] == k[2]} | {None}
            assert Counter(after) == Counter(r for r in before if r["doc_id"] in stay)
        else:
            sizes, taken, most = defaultdict(int), defaultdict(int), Counter(after)
            for r in before:
                sizes[r["source"]] += len(words(r["text"]))
            for r in after:
                taken[r["source"]] += len(words(r["text"]))
            longest = max((len(words(r["text"])) for r in before), default=0)
            for s, t in mixed(dict(sizes)).items():
                assert abs(taken[s] - t) <= longest
            assert max(most.values(), default=0) <= 3 * max(Counter(before).values(), default=0)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter(tuple(r)[:5] for r in out) == pieces(docs.collect(), queries.tokenizer_path(), 2048)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"a.b": F.lit(1), "row": F.lit("r"), "h": F.lit(2), "size": F.lit(3), "component_id": F.lit(4), "x`y": F.lit(5)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns[-6:] == ["a.b", "row", "h", "size", "component_id", "x`y"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() and {tuple(r)[-6:] for r in docs.collect()} == {(1, "r", 2, 3, 4, 5)}


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []

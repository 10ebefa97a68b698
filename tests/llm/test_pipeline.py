import corpus_pipeline
from gablestone.llm import packing


def test_stages_keep_the_columns_of_documents_and_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns, name
        assert 0.5 * n < docs.count() <= n
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.collect()}
    assert packed.agg({"length": "max"}).first()[0] <= packing.CAPACITY


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, kept string, _f string"


def test_stages_take_odd_rows_and_none(spark, sf_dir):
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    same, benchmark = words(1, 60), spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    rows = [
        (1, same, "en", "s", 1, "a", "b", "c"), (1, same, "en", "s", 1, "a", "b", "c"), (2, same, None, None, None, None, None, None), (3, None, "en", "s", 0, "", "", ""), (4, "", "en", "s", 0, "", "", ""),
        (5, words(5, 200_000), "en", "s", 1, "", "", ""), (None, words(6, 50), "en", "s", 1, "", "", ""), (7, f"{benchmark} {words(7, 30)}", "en", "t", 1, "", "", ""), (8, words(8, 40), "xx", "t", 1, "", "", ""),
    ]
    d = spark.createDataFrame(rows, SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted((r.doc_id for r in df.collect()), key=repr)
    assert ids(stages["quality rules"](spark, d, sf_dir)) == sorted([1, 1, 2, 5, 7, 8, None], key=repr)
    assert set(ids(stages["near duplicates"](spark, d, sf_dir))) == {1, 3, 4, 5, 7, 8, None}
    assert 7 not in ids(stages["decontamination"](spark, d, sf_dir)) and {3, 4, 5, None} <= set(ids(stages["decontamination"](spark, d, sf_dir)))
    assert not {3, 4} & set(ids(stages["language ID"](spark, d, sf_dir)))
    packed = stages["packing"](spark, d, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {1, 2, 3, 4, 5, 7, 8, None} and packed.where("doc_id = 5").count() > 100
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, d.limit(0), sf_dir)
        assert none.count() == 0 and (name == "packing" or none.columns == d.columns), name

"""The corpus pipeline: what each stage keeps."""

import corpus_pipeline as pipeline
from reviewloom.llm import simhash
from reviewloom.llm.common import read_table, staged


def test_stages(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        kept = staged(stage(spark, docs, sf_dir), name)
        assert kept.columns == columns
        assert kept.join(docs, "doc_id", "left_anti").count() == 0
        if name == "simhash_near_dedup":
            groups = simhash.near_duplicate_groups(docs)
            assert kept.count() == groups.select("component").distinct().count()
        if name == "substring_dedup":
            assert kept.count() == docs.count()
        docs = kept
    packed = pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_near_duplicate_stage_keeps_rows_without_id(spark, sf_dir):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d"), (3, "x y z")]
    docs = spark.createDataFrame(
        [(i, t, None, None, len(t)) for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    kept = pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3]


def test_near_duplicate_stage_keeps_another_text_of_an_id(spark, sf_dir):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "q r s t u v"), (3, "q r s t u v"), (2, None)]
    docs = spark.createDataFrame(
        [(i, t, None, None, 0, "x") for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, component string",
    )
    kept = pipeline.drop_near_duplicates(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [
        (1, "a b c d"),
        (2, ""),
        (2, "q r s t u v"),
    ]


def test_near_duplicate_stage_takes_an_empty_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").where("false")
    assert pipeline.drop_near_duplicates(spark, docs, sf_dir).count() == 0


def test_stages_take_null_and_long_texts_and_clashing_columns(spark, sf_dir):
    words = " ".join(f"w{i}x" for i in range(60))
    texts = [None, "", " \n", words, words, "long " * 50_000, "é日🙂 " * 70]
    rows = [(i if i % 5 else None, t, None, None, 0, i, "k", True) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "row bigint, kept string, base_failed boolean",
    )
    for name, stage in pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, sf_dir), name)
        assert out.columns == docs.columns, name
        empty = stage(spark, docs.where("false"), sf_dir)
        assert empty.columns == docs.columns and empty.count() == 0, name
    packed = pipeline.STAGES[-1][1](spark, docs, sf_dir)
    # Every row has one id at least, that of its end.
    assert packed.select("doc_id").distinct().count() == len({r[0] for r in rows})

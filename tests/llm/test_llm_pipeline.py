"""The pipeline's stages and its whole run against versions that look at every document."""

import corpus_pipeline
from freightlens.llm.common import steps, table
from freightlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_stages_filter_and_mix(spark):
    ws = steps(spark)
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    before = {r.doc_id for r in docs.collect()}
    toxic = {r.doc_id for r in QUERIES["op5_noisy_channel_toxicity"](spark, FOLDER).where("predicted = 1").collect()}
    stages = dict(corpus_pipeline.STAGES)
    clean = ws.write(stages["toxicity"](spark, docs, FOLDER), "a")
    assert {r.doc_id for r in clean.collect()} == before - toxic and clean.columns == columns
    single = ws.write(stages["near_duplicates"](spark, clean, FOLDER), "b")
    classes = {r.doc_id: r.class_id for r in QUERIES["op2_dart_minhash"](spark, FOLDER).collect()}
    assert {classes[r.doc_id] for r in single.collect()} == {classes[r.doc_id] for r in clean.collect()}
    assert single.count() == len({classes[r.doc_id] for r in clean.collect()}) and single.columns == columns
    fair = ws.write(stages["decontamination"](spark, single, FOLDER), "c")
    assert fair.count() <= single.count() and fair.columns == columns
    mixed = ws.write(stages["mixing"](spark, fair, FOLDER), "d")
    assert mixed.columns == columns and mixed.groupBy("doc_id").count().where("count > 2").isEmpty()
    assert corpus_pipeline.run(spark, FOLDER).count() == mixed.count()


def test_stages_take_odd_rows(spark):
    rows = [(None, None, None, None), (1, "", None, "s"), (1, "", None, "s"), (2, "a b", "en", None), (2, "a b c", "en", None), (None, "a b", "en", "s")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, size string")
    for name, stage in corpus_pipeline.STAGES:
        docs = steps(spark).write(stage(spark, docs, FOLDER), name)
    assert docs.count() > 0
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = steps(spark).write(stage(spark, empty, FOLDER), name)
    assert empty.count() == 0


def test_stages_leave_columns_of_any_name_alone(spark):
    names = ["_words", "_nr", "_copies", "_gone", "gone_id", "mix_words", "mix_nr", "mix_copies", "mix_size", "mix_copy", "size", "copies", "class_id", "a.b"]
    texts = ["a b c d e f g", "a b c d e f g", "h i j", "", None]
    rows = [(i, t, "s" if i % 2 else None, *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    kinds = ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, {kinds}")
    held = {r[0]: tuple(r) for r in rows}
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} == {held[i] for i in (0, 2, 3, 4)}
    mixed = corpus_pipeline.mix_sources(spark, docs, FOLDER)
    assert mixed.columns == docs.columns and {tuple(r) for r in mixed.collect()} <= set(held.values())
    assert mixed.where("text is not null").count() > 0

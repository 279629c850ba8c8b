import os
import random

import corpus_pipeline
import pytest

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")
def test_stages_decide_on_what_was_kept(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}-{os.getpid()}"
        stage(spark, docs, DATA).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns, name
        now = docs.count()
        assert 0 < now <= before and (now < before or name == "pii"), name
        before = now
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert mixed.where("taken <= 0 or taken > 3 * size").isEmpty() and 0 < mixed.count() <= before


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")
def test_the_whole_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0


PLAIN = ["river", "stone", "green", "walks", "under", "bridge", "evening", "lamp", "door", "window", "cold", "light", "paper", "north", "field"]


def small_tables(spark, folder):
    """Documents of every kind that a stage decides on, with nulls, repeats and an id twice."""
    rng = random.Random(11)
    text = lambda n=60: " ".join(rng.choice(PLAIN) + str(rng.randrange(40)) for _ in range(n))
    docs = {i: text() for i in range(60)}
    toxic = {i: text(20) + " you stupid idiot moron " + text(20) for i in range(100, 130)}
    item = text(14)
    kinds = {"copy": {200: docs[1], 201: docs[1] + " end"}, "leak": {300: text(10) + " " + item + " " + text(10)}, "pii": {400: text(20) + " write to boss@firm.example or +1 (555) 010-9999 now"}}
    rows = [(i, t) for part in (docs, toxic, *kinds.values()) for i, t in part.items()] + [(500, None), (501, ""), (502, "two words"), (2, docs[2]), (None, text()), (503, text() + " a" * 20_000)]
    full = [(i, t, "en", None if i == 5 else f"s{(i or 0) % 3}", len(t or "")) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(40)] + [(i, 0, 1) for i in range(100, 125)] + [(None, 1, 1), (7, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, toxic


def test_stages_decide_as_planted(spark, tmp_path):
    folder = f"file://{tmp_path}/t"
    docs, toxic = small_tables(spark, folder)
    now, columns = spark.read.parquet(f"{folder}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, now, folder).write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        assert now.columns == columns
        texts[name] = {r["doc_id"]: r["text"] for r in now.collect()}
    ids = {name: set(found) for name, found in texts.items()}
    assert not ids["toxicity"] & set(range(100, 125)) and ids["toxicity"] >= set(docs) | {200, 201, 300, 400, 500, 501, 502, 503, None}
    assert ids["toxicity"] - ids["near_duplicates"] == {200, 201}
    assert ids["near_duplicates"] - ids["decontamination"] == {300} and ids["pii"] == ids["decontamination"]
    assert "boss@" not in texts["pii"][400] and "[EMAIL]" in texts["pii"][400] and "[PHONE]" in texts["pii"][400]
    assert all(texts["pii"][i] == texts["decontamination"][i] for i in ids["pii"] - {400}), "clean documents stay as they are"
    mixed = corpus_pipeline.STAGES[-1][1](spark, now, folder).collect()
    assert {r["doc_id"] for r in mixed} <= ids["pii"] and all(0 < r["taken"] <= 3 * r["size"] for r in mixed)


def test_stages_take_empty_tables(spark, tmp_path):
    folder = f"file://{tmp_path}/t"
    small_tables(spark, folder)
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).isEmpty()

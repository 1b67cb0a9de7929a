import sys
from pathlib import Path

import pytest
from llm_data import make_docs, prose  # noqa: F401

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture()
def corpus(spark, tmp_path, make_docs):  # noqa: F811
    passage = prose(50, 70)
    rows, labels = [], []
    for i in range(200):
        text = prose(i, 80) + "\n" + prose(300 + i, 60)
        toxic, bad = int(i % 6 == 1), int(i % 6 == 2)
        text = text.replace(" ", " vile ", 1) if toxic else text
        text = "\n".join(["SPAM!! SPAM!! $$$ ###" * 8] * 4) + f" {i}" if bad else text
        rows.append((i, text))
        labels.append((i, 1 - bad, toxic))
    rows += [(500, rows[0][1]), (501, rows[3][1])]
    rows += [(600 + i, prose(700 + i, 90) + "\n" + passage + "\n" + prose(800 + i, 90)) for i in range(3)]
    rows += [(900, None), (901, ""), (None, prose(5000, 80))]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), dict(rows), passage


def test_stages_take_effect_in_turn(spark, corpus):
    sf_dir, texts, passage = corpus
    docs = corpus_pipeline.table(spark, sf_dir, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert docs.columns == DOCUMENTS
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
    toxic, bad = {i for i in range(200) if i % 6 == 1}, {i for i in range(200) if i % 6 == 2}
    assert texts.keys() - kept["toxicity"].keys() == toxic
    assert kept["toxicity"].keys() - kept["quality"].keys() - {900, 901} == bad
    assert {500, 501} <= kept["quality"].keys() - kept["near_duplicates"].keys() <= {500, 501, 901}
    last = kept["repeated_passages"]
    assert last.keys() == kept["near_duplicates"].keys()
    changed = {i for i in last if last[i] != texts[i]}
    assert changed == {601, 602}
    assert all(len(texts[i]) - len(last[i]) > len(passage) / 2 for i in changed)
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == last.keys()
    ran = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, ran.collect())) == sorted(map(str, docs.collect()))


def test_empty_tables(spark, tmp_path, make_docs):  # noqa: F811
    make_docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

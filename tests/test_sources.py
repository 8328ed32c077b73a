"""Round trips through files."""

import json

import pytest

from hopweave.sources import readers, sinks


def test_json_modes(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"id":"1","pred_answer":"é"}\n\n{"id": \n{"id":"2"}\n')
    schema = readers.SCHEMAS["prediction"]
    assert {r.id for r in readers.json_lines(spark, str(p), schema, "DROPMALFORMED").collect()} == {"1", "2"}
    with pytest.raises(Exception):
        readers.json_lines(spark, str(p), schema, "FAILFAST").collect()


def test_keyed_documents_and_fallback(spark, tmp_path):
    for folder, ids in (("a", "12"), ("b", "23")):
        (tmp_path / folder).mkdir()
        for i in ids:
            (tmp_path / folder / f"{i}.json").write_text(json.dumps({"id": i, "matched_ontologies": [folder]}))
    got = readers.keyed_documents(spark, str(tmp_path / "a"), readers.SCHEMAS["subgraph"], str(tmp_path / "b"))
    assert {(r.id, r.matched_ontologies[0]) for r in got.collect()} == {("1", "a"), ("2", "a"), ("3", "b")}


def test_ontologies(spark, tmp_path):
    (tmp_path / "1_x.json").write_text(json.dumps({"title": "X", "concepts": [{"qid": "Q5", "label": "human"}], "relations": [{"pid": "P1", "label": "l", "domain": "Q5", "range": r} for r in ("", "Q1", ["Q1", "Q2"])]}))
    o = readers.ontologies(spark, str(tmp_path)).first()
    assert o.id == "1_x" and [list(r.range) for r in o.relations] == [[], ["Q1"], ["Q1", "Q2"]]


def test_raw_questions_and_labels(spark, tmp_path):
    p = tmp_path / "q.json"
    p.write_text(json.dumps([{"_id": "1", "type": "bridge", "supporting_facts": [["A", 0], ["B", 2]]}]))
    q = readers.linked_questions(readers.json_array(spark, str(p), readers.SCHEMAS["raw_question"])).first()
    assert q.id == "1" and q.reasoning_type == "bridge" and [tuple(e) for e in q.entities] == [("A", 0), ("B", 2)]
    df = spark.createDataFrame([({"en": "x", "de": "y"},), ({"mul": "z"},), ({"fr": "w"},)], "l map<string,string>")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(readers.best_label(F.col("l"))).collect()] == ["x", "z", "w [fr]"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "a")], "id string, route string")
    sinks.routed(df, "route", str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r" / "route=a")).count() == 2
    sinks.json_lines(df, str(tmp_path / "j"))
    with pytest.raises(Exception):
        sinks.json_lines(df, str(tmp_path / "j"))
    sinks.json_lines(df, str(tmp_path / "j"), force=True)
    assert sinks.append_undone(df.limit(2), "id", str(tmp_path / "o")) == 2
    assert sinks.append_undone(df, "id", str(tmp_path / "o")) == 1
    sinks.tsv(df, str(tmp_path / "t"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t")).count() == 3
    df.write.parquet(str(tmp_path / "p"))
    sinks.replace_in_place(spark.read.parquet(str(tmp_path / "p")).where("id > '1'"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2

"""Edge cases of building, patching and judging, and of sinks and the resuming stream."""

from pyspark.sql import functions as F

from hopweave.operators import answers, graphs, metrics, paths
from hopweave.plans import nested
from hopweave.session import Scratch, drop_scratch
from hopweave.sources import readers, sinks
from hopweave.streaming import resume


def test_build_edges(spark):
    entities = spark.createDataFrame([("r", "o", "Q1", ["C1"]), ("r", "o", "Q2", ["C9"]), ("r", "o", "Q1", ["C1"]), ("s", "", "Q1", [])], "id string, key string, qid string, classes array<string>")
    merged = spark.createDataFrame([("o", "P1", "C1", ["C5"], 1), ("o", "P2", "C1", [], 2)], "key string, pid string, domain string, range array<string>, pos int")
    follow = spark.createDataFrame([("o", "C5", "P7")], "key string, class string, pid string")
    concepts = spark.createDataFrame([("o", "C1")], "key string, class string")
    claims = spark.createDataFrame([("Q1", "P1", "Q3"), ("Q1", "P1", "Q4"), ("Q1", "P2", "Q9"), ("Q1", "P3", "Q4"), ("Q2", "P3", "Q4"), ("Q3", "P7", "Q5"), ("Q3", "P8", "Q4")], "qid string, pid string, target string")
    classes = spark.createDataFrame([("Q1", "C1"), ("Q3", "C5"), ("Q4", "C6")], "qid string, class string")
    known = spark.createDataFrame([(f"Q{i}",) for i in range(1, 6)], "target string")
    run = lambda e: {tuple(x) for x in graphs.build_edges(e, merged, follow, concepts, claims, classes, known).collect()}
    assert run(entities) == {
        ("r", "props", "Q1", "P1", "Q3"),  # in range; Q4 is not, and Q9 is no node
        ("r", "props", "Q2", "P3", "Q4"),  # no class of a domain: all claims
        ("r", "extra_props", "Q3", "P7", "Q5"),
        ("r", "TYPE", "Q1", "TYPE", "C1"),
        *(("s", "props", "Q1", p, o) for p, o in (("P1", "Q3"), ("P1", "Q4"), ("P3", "Q4"))),
    }
    assert run(entities.limit(0)) == set()


def test_merged_nodes(spark):
    v = spark.createDataFrame(
        [("Q1", "", None, ["A"], None, {"P": ["x", " ", None]}, None, 1), ("Q1", "one", "", ["B", "A", None], ["C"], None, {"P": ["y"]}, 2), ("Q1", "other", "d", None, None, {"P": ["x"]}, None, 3), ("Q2", None, None, None, None, None, None, 4)],
        "qid string, label string, description string, instance_of array<string>, subclass_of array<string>, props map<string,array<string>>, extra_props map<string,array<string>>, at int",
    )
    assert sorted(tuple(r) for r in graphs.merged_nodes(v.where("qid = 'Q1'")).collect()) == [("Q1", "one", "d", ["A", "B"], ["C"])]
    assert graphs.merged_nodes(v).where("qid = 'Q2'").first().label is None
    assert {tuple(r) for r in graphs.merged_props(v).collect()} == {("Q1", "props", "P", "x"), ("Q1", "extra_props", "P", "y")}
    assert graphs.merged_nodes(v.limit(0)).count() == 0


def test_judged_candidates(spark):
    c = spark.createDataFrame([("a", 1, "Q1", "x", "zzz"), ("a", 2, "Q2", "x", "ax"), ("a", 3, "Q3", "x", "x"), ("b", 1, "Q4", None, "x")], "id string, rank int, qid string, answer string, label string")
    ok = answers.confirmed(answers.judged(c, lambda answer, label: answer in label))
    assert [tuple(r) for r in ok.collect()] == [("a", "Q2", 2)]
    found = spark.createDataFrame([("a", 3, "Q1", 1), ("b", 3, "Q4", 1), ("c", 1, "Q5", 1), ("d", 4, None, 1), ("e", 1, "Q6", None)], "id string, tier int, qid string, has int")
    got = {r.id: (r.route, r.reason, r.qid) for r in answers.routes(found, ok).collect()}
    assert got == {"a": ("found", None, "Q2"), "b": ("not_found", "tier3_declined", None), "c": ("found", None, "Q5"), "d": ("not_found", "no_match", None), "e": ("not_found", "no_subgraph", None)}


def test_report_lines(spark):
    r = spark.createDataFrame([("model", "b", 0.0625, 1.0, None, 16), ("global", "all", 0.5, 0.25, 1.0, 4)], "dimension string, key string, em double, f1 double, h1 double, n bigint")
    assert [x.line for x in metrics.report_lines(r).orderBy("line_no").collect()] == ["global all: n=4 EM 50.0% F1 25.0% H@1 100.0%", "model b: n=16 EM 6.3% F1 100.0%"]


def test_search_leaves_dead_ends_out(spark):
    """A hub whose ways lead nowhere is not spread out, and what leads to the goal is found."""
    edges = [("g", "a", "p", "hub", 0), *(("g", "hub", "p", f"x{i}", i) for i in range(500)), ("g", "x7", "p", "goal", 0), ("g", "a", "p", "goal", 1), ("g", "goal", "p", "a", 0)]
    adj = spark.createDataFrame(edges, "id string, source string, type string, target string, adj_ord int")
    starts = spark.createDataFrame([("g", "a", "goal"), ("g", "goal", "goal"), ("h", "a", "goal")], "id string, source string, goal string")
    got = [(r.len, r.path) for r in paths.bounded_paths(adj, starts, 4, 20).orderBy("rank").collect()]
    assert got == [(1, ["a|p|goal"]), (3, ["a|p|hub", "hub|p|x7", "x7|p|goal"])]
    assert paths.bounded_paths(adj, starts.limit(0), 4, 20).count() == 0


def test_keyed_sink_and_stream(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i % 300}", i, i // 300) for i in range(600)], "id string, n int, late int")
    sinks.keyed_documents(df.where("late = 0"), "id", str(tmp_path / "keyed"))
    assert len(list((tmp_path / "keyed").glob("key_hash=*"))) <= sinks.KEY_FOLDERS
    assert readers.keyed_documents(spark, str(tmp_path / "keyed"), "id string, n int", lines=True).count() == 300
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = resume.stream_parquet(spark, str(tmp_path / "in"), "*.parquet", df.schema)
        resume.append_new_keys(stream, "id", ["late"], str(tmp_path / "out"), str(tmp_path / f"state{_}"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 300 == out.where("late = 0").count()


def test_property_values_of_repeated_keys(spark, tmp_path):
    """Two rows of one id and stage with other contents, one of them twice."""
    schema = "id string, stage string, nodes array<struct<qid:string,label:string,description:string,instance_of:array<string>,subclass_of:array<string>,props:map<string,array<string>>,extra_props:map<string,array<string>>>>"
    node = lambda p: [("Q1", None, None, None, None, p, None)]
    rows = [("g", "s", node({"P1": ["a"]})), ("g", "s", node({"P2": ["b", "c"]})), ("g", "s", node({"P1": ["a"]})), ("g", None, None), (None, "s", node({"P3": []}))]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "subgraph.parquet"))
    got = sorted((r.pid, r.value, r.dewey) for r in nested.p7_node_props(spark, str(tmp_path)).collect())
    assert got == [("P1", "a", "0.0.0"), ("P1", "a", "0.0.0"), ("P2", "b", "0.0.0"), ("P2", "c", "0.0.1")]


def test_scratch_tables_go(spark):
    import os

    root = Scratch(spark, "gone")
    root.cut(spark.range(3)).count()
    at = root.root.removeprefix("file://")
    assert os.path.isdir(at)
    drop_scratch(spark)
    assert not os.path.isdir(at)
    assert spark.range(1).select(F.lit(1)).count() == 1

"""Edge cases of the core operators."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from hopweave.functions import text as T
from hopweave.operators import dewey, graphs, metrics, paths, ranks, rows
from hopweave.operators.components import connected_components
from hopweave.plans import nested


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items()))
    return df.select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "form"), [("The Étan a", "étan"), ("x_a the-Cat", "x_a cat"), ("a.b c", "b c"), ("½ cup", "½ cup"), ("₂ a", "₂"), ("İstanbul ΟΔΟΣ", "i stanbul οδος"), ("", ""), (None, "")])
def test_score_form(spark, text, form):
    assert one(spark, T.score_form(F.col("t")), t=text) == form


@pytest.mark.parametrize(("reply", "alias", "em", "f1"), [("", "The", 1.0, 0.0), ("x x y", "x y", 0.0, 0.8), ("x x", "x x", 1.0, 0.5), ("the Cat", "cat", 1.0, 1.0)])
def test_scores(spark, reply, alias, em, f1):
    assert one(spark, T.exact_match(F.col("r"), F.col("a")), r=reply, a=[alias]) == em
    assert one(spark, T.token_f1(F.col("r"), F.col("a")), r=reply, a=[alias]) == pytest.approx(f1)


def test_fuzzy_and_hits(spark):
    assert one(spark, T.fuzzy_score(F.col("a"), F.col("b")), a="ab", b="ab cd") == 0.5
    assert one(spark, T.fuzzy_score(F.col("a"), F.col("b")), a="new york", b="new york city") == pytest.approx(0.5 + 8 / 14)
    assert one(spark, T.hit(F.col("a"), F.col("b")), a=None, b="Q1") == 0.0
    assert one(spark, T.hit(F.col("a"), F.col("b")), a=" Q1 ", b="Q1") == 1.0
    assert one(spark, T.verdict(F.col("a")), a="<think>no</think> Yes, no") is True


def test_split_sizes(spark):
    strata = {"a": 1, "b": 2, "c": 3, "e": 6970, "f": 3407, "g": 1679}
    df = spark.createDataFrame([(f"{s}{i}", s) for s, n in strata.items() for i in range(n)], "id string, s string")
    out = rows.stratified_split(df, "id", F.col("s")).groupBy("stratum", "split").count().collect()
    n = {(r[0], r[1]): r[2] for r in out}
    of = lambda s: tuple(n.get((s, x), 0) for x in ("train", "dev", "test"))
    assert [of(s) for s in "abc"] == [(1, 0, 0), (1, 1, 0), (2, 1, 0)]
    assert tuple(sum(of(s)[i] for s in "efg") for i in range(3)) == (8439, 1809, 1808)


def test_rank_within_equals_row_number(spark):
    r = random.Random(1)
    df = spark.createDataFrame([(r.choice(["hot", "hot", "a", None]), i) for i in range(3000)], "g string, id bigint").withColumn("k", ranks.hash_key(7, "id"))
    ranked = {(x.id): x["rank"] for x in ranks.rank_within(df, ["g"], "k", "id").collect()}
    by = {}
    for x in df.orderBy("k", "id").collect():
        by[x.g] = by.get(x.g, 0) + 1
        assert ranked[x.id] == by[x.g]
    assert ranks.rank_within(df.limit(0), ["g"], "k", "id").count() == 0


def bfs(graph, source, goal, hops, cap):
    """A plain breadth-first search as a second opinion."""
    if source == goal:
        return []
    found, todo = [], deque([(source, (), (source,))])
    while todo and len(found) < cap:
        node, path, seen = todo.popleft()
        if len(path) == hops:
            continue
        for p, nxt in graph.get(node, []):
            if nxt not in seen:
                if nxt == goal:
                    found.append((*path, f"{node}|{p}|{nxt}"))
                    if len(found) == cap:
                        break
                else:
                    todo.append((nxt, (*path, f"{node}|{p}|{nxt}"), (*seen, nxt)))
    return found


@pytest.mark.parametrize(("hops", "cap"), [(2, 5), (4, 3), (4, 20)])
def test_paths_equal_search(spark, hops, cap):
    r = random.Random(hops * cap)
    edges, graphs, starts = [], {}, []
    for g in range(30):
        graph = graphs[str(g)] = {}
        for i in range(r.randint(1, 24)):
            s, p, o = (r.choice("abcdef"), r.choice("pq"), r.choice("abcdef"))
            edges.append((str(g), s, p, o, i))
            graph.setdefault(s, []).append((p, o))
        starts += [(str(g), s, o) for s in "abc" for o in "adf"]
    adj = paths.adjacency(spark.createDataFrame(edges, "id string, source string, type string, target string, ords int"))
    got = {}
    for x in paths.bounded_paths(adj, spark.createDataFrame(starts, "id string, source string, goal string"), hops, cap).orderBy("rank").collect():
        got.setdefault((x.id, x.source, x.goal), []).append(tuple(x.path))
    for g, s, o in starts:
        assert got.get((g, s, o), []) == bfs(graphs[g], s, o, hops, cap)


def test_components(spark):
    r = random.Random(5)
    edges = [(f"n{i}", f"n{i + 1}") for i in range(200)] + [("hub", f"h{i}") for i in range(300)] + [(f"x{r.randint(0, 300)}", f"x{r.randint(0, 300)}") for _ in range(150)] + [("loop", "loop"), (None, "n1")]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a and b:
            ra, rb = sorted((find(a), find(b)))
            parent[rb] = ra
    df = spark.createDataFrame(edges, "a string, b string")
    assert {x.node: x.component for x in connected_components(df).collect()} == {n: find(n) for n in parent}
    assert connected_components(df.limit(0)).count() == 0


def test_closure_has_no_depth_bound(spark):
    r = random.Random(8)
    claims = [(f"c{i}", f"c{i + 1}") for i in range(6)] + [("c6", "c2"), ("c0", "c3"), ("c1", None)] + [(f"x{r.randint(0, 60)}", f"x{r.randint(0, 60)}") for _ in range(70)]
    members = [("g", "c0"), ("g", "c0"), ("h", "c5"), ("h", "x1"), ("k", "alone"), ("l", "x2"), ("l", "x3"), ("m", None)]
    want = set()
    for g in {m[0] for m in members}:
        depth = {q: 0 for m, q in members if m == g}
        queue = deque(depth)
        while queue:
            at = queue.popleft()
            for a, b in claims:
                if a == at and b is not None and b not in depth:
                    depth[b] = depth[at] + 1
                    queue.append(b)
        want |= {(g, q, d) for q, d in depth.items()}
    assert max(d for _, _, d in want) > 3
    m, c = spark.createDataFrame(members, "id string, qid string"), spark.createDataFrame(claims, "qid string, target string").where("target is not null")
    got = [tuple(x) for x in graphs.closure(m, c).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {tuple(x) for x in graphs.closure(m, c, 2).collect()} == {x for x in want if x[2] <= 2}
    assert graphs.closure(m.limit(0), c).count() == 0 and graphs.closure(m, c.limit(0)).count() == 7


def test_two_hop_links_and_their_edges(spark):
    r = random.Random(16)
    edges = [(f"n{r.randint(0, 14)}", f"n{r.randint(0, 14)}", r.choice("pqr")) for _ in range(60)]
    pairs = [(f"i{k}", f"n{r.randint(0, 14)}", f"n{r.randint(0, 14)}") for k in range(60)]
    edges += [("B", "X", "p"), ("X", "A", "q"), ("X", "A", "q"), ("C", "D", "p"), ("D", "E", "p"), ("E", "C", "q")]
    pairs += [("inverse", "A", "B"), ("direct", "C", "E")]

    def hops(s, o, a, b):
        return sorted({(p, x, q) for u, x, p in edges if u == s and x not in (a, b) for y, v, q in edges if y == x and v == o})

    want, added = set(), set()
    for i, a, b in pairs:
        direction, found = next(((k, h) for k, h in enumerate((hops(a, b, a, b), hops(b, a, a, b))) if h), (0, []))
        want |= {(i, a, b, direction, *h, n) for n, h in enumerate(found[:3], 1)}
        one = sorted([(0, p) for s, o, p in edges if (s, o) == (a, b)] + [(1, p) for s, o, p in edges if (s, o) == (b, a)])
        if one:
            added.add((i, *((a, one[0][1], b) if one[0][0] == 0 else (b, one[0][1], a))))
        elif found:
            (s, o), (p, x, q) = ((a, b), (b, a))[direction], found[0]
            added |= {(i, s, p, x), (i, x, q, o)}
    assert ("inverse", "A", "B", 1, "p", "X", "q", 1) in want and len({w[3] for w in want}) == 2
    assert ("direct", "E", "q", "C") in added and {("inverse", "B", "p", "X"), ("inverse", "X", "q", "A")} <= added
    e, p = spark.createDataFrame(edges, "source string, target string, type string"), spark.createDataFrame(pairs, "id string, a string, b string")
    two = graphs.two_hop_links(p, e)
    got = [tuple(x) for x in two.select("id", "a", "b", "direction", "p1", "x", "p2", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {tuple(x) for x in graphs.link_edges(graphs.one_hop_links(p, e), two).select("id", "source", "type", "target").collect()} == added


def test_dewey_round_trip(spark):
    schema = "id string, other int, v array<struct<a:string,m:map<string,array<string>>,s:struct<b:int>>>"
    df = spark.createDataFrame([("1", 5, [("x", {"p": ["u", None], "q": []}, (3,)), None, ("y", None, None)]), ("2", 6, None), (None, 7, [])], schema)
    top = {x.dewey: x for x in dewey.dewey_table(df, ["id"], "v", "v[]").collect()}
    assert set(top) == {"0", "1", "2"} and top["0"].a == "x" and top["0"].s_b == 3 and top["0"].parent is None and top["1"].a is None
    entry = {x.dewey: x for x in dewey.dewey_table(df, ["id"], "v", "v[].m{}").collect()}
    assert {(e.dewey, e.parent, e.key) for e in entry.values()} == {("0.0", "0", "p"), ("0.1", "0", "q")}
    leaf = dewey.dewey_table(df, ["id"], "v", "v[].m{}[]").collect()
    assert {(x.dewey, x.parent, x.value) for x in leaf} == {("0.0.0", "0.0", "u"), ("0.0.1", "0.0", None)}
    assert set(dewey.dewey_tables(df, ["id"], "v")) == {"v[]", "v[].m{}", "v[].m{}[]"}
    with pytest.raises(ValueError):
        dewey.dewey_table(df, ["id"], "v", "v[].nope[]")


def test_parsed_subgraphs(spark):
    bodies = ['{"id":"a","nodes":[{"qid":"Q1","extra_props":{"P1":"Q2","P2":["Q3"," "],"P3":"","P4":null}}],"meta":1}', '{"id":"b","nodes":{"Q5":{"extra_props":{"P1":["Q6"]}}}}', '{"id":"c","nodes":null}', '{"id":"d", "nodes": [', "", None, '{"id":"e"}']
    raw = spark.createDataFrame([(b,) for b in bodies], "body string")
    empty = spark.createDataFrame([], "id string, nodes array<struct<qid:string,extra_props:map<string,array<string>>>>")
    records = spark.createDataFrame([("r", [(1, [["Q1", "P1", "Q2"], ["Q1", None, "Q2"], ["Q1", "P1"], [" Q1", "P1", "Q2 "]])]), ("n", None)], "id string, supporting_paths array<struct<length:int,triples:array<array<string>>>>")
    got = {tuple(x) for x in dewey.nested_links(empty, raw, records).collect()}
    assert got == {("extra", "a", "Q1", "P1", "Q2"), ("extra", "a", "Q1", "P2", "Q3"), ("extra", "b", "Q5", "P1", "Q6"), ("path", "r", "Q1", "P1", "Q2")}


def test_nested_tables_have_their_links(spark, tmp_path):
    node = "struct<qid:string,props:map<string,array<string>>,extra_props:map<string,array<string>>>"
    spark.createDataFrame([("g", "built", [("Q1", {}, {"P1": ["Q2", " "], "P2": [None]}), ("Q2", {}, None)])], f"id string, stage string, nodes array<{node}>").write.parquet(f"{tmp_path}/subgraph.parquet")
    bodies = ['{"id":"a","nodes":[{"qid":"Q1"},{"qid":"Q1","extra_props":{"P1":"Q2","P2":["Q3"," "],"P4":null}}]}', '{"id":"b","nodes":{"Q5":{"extra_props":{"P1":["Q6"]}}}}', '{"id":"d", "nodes": [']
    spark.createDataFrame(list(enumerate(bodies)), "line_no bigint, body string").write.parquet(f"{tmp_path}/raw_subgraph.parquet")
    spark.createDataFrame([("r", "dev", [(1, [["Q1", "P1", "Q2"]]), (2, [["Q1", None, "Q2"], ["Q1", "P1"]])]), ("n", "dev", None)], "id string, split string, supporting_paths array<struct<length:int,triples:array<array<string>>>>").write.parquet(f"{tmp_path}/split_record.parquet")
    got = lambda q: {tuple(x) for x in nested.QUERIES[q](spark, str(tmp_path)).collect()}
    assert got("p7_extra_props") == {("g", "built", "0.0.0", "0.0", 0, "Q2", "P1"), ("g", "built", "0.0.1", "0.0", 1, " ", "P1"), ("g", "built", "0.1.0", "0.1", 0, None, "P2")}
    assert got("p7_raw_extra_props") == {(0, "a", "1.0.0", "1.0", 0, "Q2", "P1"), (0, "a", "1.1.0", "1.1", 0, "Q3", "P2"), (0, "a", "1.1.1", "1.1", 1, " ", "P2"), (1, "b", "0.0.0", "0.0", 0, "Q6", "P1")}
    assert got("p7_paths") == {("r", "dev", "0", 0, 1), ("r", "dev", "1", 1, 2)}
    assert got("p7_path_triples") == {("r", "dev", "0.0", "0", 0, "Q1", "P1", "Q2"), ("r", "dev", "1.0", "1", 0, "Q1", None, "Q2"), ("r", "dev", "1.1", "1", 1, "Q1", "P1", None)}


def test_report_without_qids(spark):
    s = spark.createDataFrame([(1, "x", 1.0, 0.5, 0.0)], "pred_id int, d string, em double, f1 double, h1 double")
    none = spark.createDataFrame([(False,)], "has_qid boolean")
    out = metrics.metric_report(s, ["d"], none).collect()
    assert {(r.dimension, r.key, r.h1, r.n) for r in out} == {("global", "all", None, 1), ("d", "x", None, 1)}


def test_annotation_edge_cases(spark):
    q = spark.createDataFrame([("1", ["A"], "A"), ("2", ["a", "b", "c", "d"], "z"), ("3", ["a"], "q")], "id string, seeds array<string>, answer string")
    edges = [("2", "a", "p", "m", 1), ("2", "m", "p", "z", 2), ("2", " ", "p", "z", 3)]
    adj = paths.adjacency(spark.createDataFrame(edges, "id string, source string, type string, target string, ords int"))
    got = {x.id: (x.strategy, x.paths) for x in paths.annotate_paths(q, adj).collect()}
    assert got == {"1": (0, []), "2": (2, [["a|p|m", "m|p|z"]]), "3": (3, [])}

"""The operators of the llm package against plain second opinions and on edge rows."""

import random
import unicodedata
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hopweave.llm import bpe, canonical, defects, fold, grouping, leakage, lookalike, mixing, mojibake, queries, sampling

SMALL = "/root/testdata/sf0.001"
REC = "id string, question string, answer_node_qid string, entity_qids array<string>, split string, source string"


# 1: overlaps across splits
Q = "Which novel by Tanor Umboley won the harbor prize in {}?"


def test_overlaps(spark):
    rows = [
        ("a", Q.format(1860), "Q1", ["Q1", "Q2"], "train", "s"),
        ("b", "Please tell me: " + Q.format(1860).upper(), " Q1 ", ["Q2", " Q1", None, "Q2"], "dev", "s"),
        ("c", Q.format(1860), "Q9", ["Q1", "Q2"], "test", "s"),
        ("d", "Which novel by Someone Else won the harbor prize in 1901?", "Q1", ["Q1", "Q3"], "test", None),
        ("e", Q.format(1860), "Q1", ["Q1"], "train", "s"),
        ("e", Q.format(1860), "Q1", ["Q1"], "train", "t"),
        ("f", None, "Q1", None, "dev", "s"),
        ("g", "", "Q1", [], "dev", "s"),
        ("h", Q.format(1861), None, ["Q1"], "dev", "s"),
        ("i", Q.format(1860), "Q1", None, "dev", "s"),
        (None, Q.format(1860), "Q1", ["Q1"], "dev", "s"),
    ]
    df = spark.createDataFrame(rows, REC)
    got = {tuple(r) for r in leakage.cross_split_pairs(df).collect()}
    assert got == {("a", "b"), ("b", "e"), ("a", "i"), ("e", "i")}
    assert leakage.cross_split_pairs(df.limit(0)).count() == 0
    report = {(r.split, r.source): (r.records, r.overlapping) for r in leakage.overlap_report(df).collect()}
    assert report["train", "s"] == (2, 2) and report["test", None] == (1, 0)


def test_overlaps_in_hot_answers_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(leakage, "EVAL_BLOCK", 20)
    monkeypatch.setattr(leakage, "TRAIN_BLOCK", 30)
    r = random.Random(3)
    names = ["".join(r.choice("abcdeiklmnorstu") for _ in range(8)).title() for _ in range(60)]
    rows = []
    for i in range(240):
        n = r.choice(names)
        text = f"Which {r.choice(['novel', 'album'])} by {n} {r.choice(['was banned', 'won a prize'])} in {r.choice([1900, 1950])}?"
        if r.random() < 0.3:
            k = r.randrange(len(text) - 1)
            text = text[:k] + text[k + 1] + text[k] + text[k + 2 :]
        rows.append((f"r{i:03}", text, "Q1", [f"E{names.index(n)}"], r.choice(["train", "dev"]), "s"))
    # Several entities, none at all, equal texts and a record delivered twice, all with the hot answer.
    rows = [(i, q, a, [] if k % 9 == 0 else [*e, "E-hot", *(["E-more"] if k % 4 == 0 else [])], sp, so) for k, (i, q, a, e, sp, so) in enumerate(rows)]
    rows += [(f"s{i}", rows[i][1], "Q1", rows[i][3], "dev" if rows[i][4] == "train" else "train", "s") for i in range(0, 60, 3)] + rows[:5] + [(rows[7][0], rows[7][1], "Q1", rows[7][3], "train" if rows[7][4] == "dev" else "dev", "t")]
    df = spark.createDataFrame(rows, REC)
    found = leakage.cross_split_overlaps(df).collect()
    got = {(x.eval_id, x.train_id) for x in found}
    want = {}
    for a in rows:
        for b in rows:
            if a[4] == "train" and b[4] != "train" and a[0] != b[0] and (set(a[3]) <= set(b[3]) or set(b[3]) <= set(a[3])):
                x, y = fold.fold(b[1]), fold.fold(a[1])
                of = leakage.coverage(x, y, leakage._passages(x) & leakage._passages(y))
                if leakage.alike(x, y, not a[3] or not b[3], *of):
                    want[b[0], a[0]] = max(of[0], want.get((b[0], a[0]), 0))
    assert got == set(want) and len(want) > 50
    members = {(x.id, x.train): x.covered for x in leakage.overlap_coverage(df).collect()}
    assert {k for k, t in members if t} == {t for _, t in want}
    assert {k: v for (k, t), v in members.items() if not t} == {e: max(v for (x, _), v in want.items() if x == e) for e, _ in want}


def test_overlaps_of_edited_texts(spark):
    """Recall and precision against edits that the operator knows nothing of."""
    r = random.Random(21)
    words = ["".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randint(3, 9))) for _ in range(400)]
    rows, edited = [], set()
    for i in range(300):
        text = " ".join(r.choice(words) for _ in range(14)) + "?"
        rows.append((f"t{i}", text, f"Q{i % 7}", [f"E{i}"], "train", "s"))
        kind = i % 6
        if kind == 0:
            other = "Please tell me: " + text
        elif kind == 1:
            other = text.upper().replace("?", " ?!")
        elif kind == 2:
            k = r.randrange(5, len(text) - 5)
            other = text[:k] + text[k + 1 :]
        elif kind == 3:
            other = text.replace("o", "о").replace(" ", "\u00a0")
        elif kind == 4:
            w = text[:-1].split()
            other = " ".join([*w[:5], w[6], w[5], *w[7:]])
        else:
            other = " ".join(r.choice(words) for _ in range(14)) + "?"
        rows.append((f"e{i}", other, f"Q{i % 7}", [f"E{i}"], "dev", "s"))
        if kind < 5:
            edited.add((f"e{i}", f"t{i}"))
    got = {(x.eval_id, x.train_id) for x in leakage.cross_split_overlaps(spark.createDataFrame(rows, REC)).collect()}
    assert len(got & edited) >= 0.97 * len(edited) and not got - edited


def test_overlap_in_many_short_matches():
    parts = ["novelbarrow", "hidingcomet", "jumpyfalcon", "wormyplaque", "stuckgizmos"]
    held = "".join(p + "".join(chr(0x430 + 9 * i + j) for j in range(9)) for i, p in enumerate(parts))
    train = "wxyz".join(parts)
    shared = leakage._passages(held) & leakage._passages(train)
    assert len(shared) < leakage.SHARED * len(leakage._passages(held)) and leakage.alike(held, train, False, *leakage.coverage(held, train, shared))
    # Other texts of the block make the shared passages common ones; whether the pair is found must not depend on them.
    for others in (0, 20):
        shard = leakage._Shard()
        shard.add("held", held, ["E"])
        for i in range(others):
            shard.add(f"o{i}", "-".join(parts) + f"{i}", ["other"])
        assert [k for k, _ in shard.partners(train, frozenset(["E"]))] == ["held"]


def test_least_shared_is_a_bound():
    r = random.Random(9)
    for _ in range(3000):
        text = "".join(r.choice("abc") for _ in range(r.randint(1, 24)))
        some = frozenset(p for p in leakage._passages(text) if r.random() < 0.4)
        assert leakage.covered(text, some) < leakage.COVER_LONG * len(text) - 1e-9 or len(some) >= leakage.least_shared(text)


# 2: balanced samples
TARGET = "dimension string, category string, target_share double, min_rows bigint, sample_rows bigint"


def test_sample_plan_does_not_depend_on_size(monkeypatch):
    r = random.Random(4)
    onts = [f"o{i}" for i in range(6)]
    kinds = sorted({(r.choice("xyz"), r.choice("pq"), tuple(sorted(r.sample(onts, r.randint(0, 3))))) for _ in range(90)})
    cells = [(*k, int(r.paretovariate(0.8) * 40)) for k in kinds]
    shares = [("difficulty", c, s, 20) for c, s in zip("xyz", (0.6, 0.3, 0.1))] + [("reasoning_type", c, s, 20) for c, s in zip("pq", (0.2, 0.8))] + [("matched_ontologies", o, s, 20) for o, s in zip(onts, (0.5, 0.4, 0.1, 0.05, 0.05, 0.3))]
    size = sum(c[3] for c in cells) // 2

    def plan(times):
        big, targets = [(*c[:3], c[3] * times) for c in cells], [(*t[:3], t[3] * times, size * times) for t in shares]
        take, quota = sampling.cell_quotas(big, targets, size * times)
        assert sum(take) == size * times and all(0 <= n <= c[3] for n, c in zip(take, big))
        has = [[k in (c[0], c[1], *c[2]) for _, k, *_ in targets] for c in big]
        sums = [sum(n for n, h in zip(take, has) if h[i]) for i in range(len(targets))]
        want = [quota[t[0], t[1]] for t in targets]
        loss = lambda x: sum(abs(v - q) / max(q, 1) ** 0.5 + 10 * max(0, min(t[3], sum(c[3] for c, h in zip(big, has) if h[i])) - v) for i, (v, q, t) in enumerate(zip(x, want, targets)))
        now = loss(sums)
        # No exchange of one record between any two cells makes it better.
        for a in range(len(big)):
            for b in range(len(big)):
                if take[a] and take[b] < big[b][3] and a != b:
                    assert loss([v - h + g for v, h, g in zip(sums, has[a], has[b])]) >= now - 1e-6
        return [v / times / size for v in sums], take

    small, large = plan(1), plan(1000)
    assert max(abs(x - y) for x, y in zip(small[0], large[0])) < 0.01
    # Comparing fewer exchanges at once leaves none out.
    monkeypatch.setattr(sampling, "EXCHANGES", 3 * len(cells))
    parts = plan(100)
    assert max(abs(x - y) for x, y in zip(small[0], parts[0])) < 0.01


def test_sample(spark):
    r = random.Random(2)
    rows = [(f"r{i}", r.choice(["x", "x", "x", "y", None]), r.choice(["p", "q"]), [(o,) for o in r.sample(["o1", "o2", "o3"], r.randint(0, 2))]) for i in range(600)] + [("r0", "x", "p", None), (None, "y", "p", [])]
    df = spark.createDataFrame(rows, "id string, difficulty string, reasoning_type string, matched_ontologies array<struct<ont_id:string>>")
    df = df.withColumn("extra", F.lit(1))
    targets = spark.createDataFrame([("difficulty", "x", 0.5, 10, 100), ("difficulty", "y", 0.5, 10, 100), ("difficulty", "z", 0.01, 5, 100), ("reasoning_type", "p", 0.3, 10, 100), ("reasoning_type", "q", 0.7, 10, 100), ("matched_ontologies", "o1", 0.4, 10, 100)], TARGET)
    assert {tuple(x) for x in sampling.short_categories(df, targets).collect()} == {("difficulty", "z")}
    s = sampling.balanced_sample(df, targets).collect()
    assert len(s) == 100 == len({x.id for x in s})
    count = lambda f: sum(map(f, s))
    assert abs(count(lambda x: x.difficulty == "x") - 50) <= 1 and abs(count(lambda x: x.reasoning_type == "p") - 30) <= 1 and abs(count(lambda x: "o1" in x.ontologies) - 40) <= 1
    report = {x.category: x for x in sampling.sample_report(df, targets).collect()}
    assert report["z"].missing == 5 and report["z"].available == 0 and report["x"].missing == 0
    assert sampling.balanced_sample(df.limit(0), targets).count() == 0
    assert sampling.short_categories(df.limit(0), targets).count() == 6


def test_largest_remainder():
    assert sampling.largest_remainder(10, [3.3, 3.3, 3.4], [0, 0, 0], [9, 9, 9]) == [3, 3, 4]
    assert sampling.largest_remainder(10, [9, 1, 0], [0, 0, 2], [5, 9, 9])[0] == 5
    assert sum(sampling.largest_remainder(10, [5, 5], [0, 0], [2, 3])) == 5


# 3: consistent forms
@pytest.mark.parametrize(
    ("text", "form", "case"),
    [("Ｔｈｅ", "The", True), ("é", "é", True), ("Furnace", "Furnace", False), ("Fur​nace", "Furnace", True), ("a b", "a b", True), ("Рarty", "Party", True), ("Роса Варинов", "Роса Варинов", False), ("речь о Foo", "речь о Foo", False), ("Zodriç", "Zodriç", False), ("ﬁre", "fire", True), ("Lake‐X", "Lake-X", True), ("𝖳he", "The", True), ("ộ", "ộ", True), ("", "", False), (None, None, False), ("Бoб", "Бoб", False)],
)
def test_forms(spark, text, form, case):
    got = lookalike.canonical_text(spark.createDataFrame([(text, 1)], "value string, form2 int"), "value").first()
    assert (got.form, got.stands_in) == (form, case)


def test_forms_equal_plain(spark):
    r = random.Random(4)
    pool = "abcdeXYZ  éñö-" + "аеорс" + "ΑΒο" + "​ ́̈" + "ＡＢ１" + "ﬁ𝖠"
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 30))) for _ in range(300)]
    got = lookalike.canonical_text(spark.createDataFrame([(t,) for t in texts], "v string"), "v").collect()
    alike = {ord(c): to for c, (_, to) in (fold.stand_ins() | fold.letters()).items()}
    every = lambda t: unicodedata.normalize("NFC", unicodedata.normalize("NFD", t).translate(alike))
    assert all(unicodedata.is_normalized("NFC", g.form) for g in got)
    # Whatever letters are swapped, nothing is lost, added or moved.
    assert [every(g.form) for g in got] == [every(g.v) for g in got]
    assert lookalike.canonical_text(spark.createDataFrame([], "v string"), "v").count() == 0


def test_forms_are_composed_canonically(spark):
    r = random.Random(14)
    marks = [c for c in map(chr, range(0x300, 0x370)) if unicodedata.combining(c)] + list("\u093c\u09be\u09d7\u0cd5\u0dcf\u0dca\u3099\u05bc")
    bases = list("aoeucnsASZ") + list("áộḉǖ") + list("\u0915\u09c7\u0cc6\u0dd9\u304b\u05d0") + ["\u1112\u1161\u11ab", "\u1100\u116e", "\uac00", "\u11a8", "\u1161", "한"]
    texts = ["".join(r.choice(bases) + "".join(r.choice(marks) for _ in range(r.choice((0, 0, 1, 1, 2, 3)))) for _ in range(r.randint(1, 6))) for _ in range(600)]
    texts += ["\u1112\u1161\u11ab\u1100\u116e\u11a8", "a\u0327\u0301", "\u00e1\u0327", "o\u0302\u0323\u0301", "\u212a\u212b\u2126", "\uf900"]
    dropped = str.maketrans({c: to for c, (_, to) in fold.stand_ins().items()})
    got = {g.v: g for g in lookalike.canonical_text(spark.createDataFrame([(t,) for t in set(texts)], "v string"), "v").collect()}
    wrong = [t for t in texts if got[t].form != unicodedata.normalize("NFC", t.translate(dropped))]
    assert not wrong, [(t.encode("unicode_escape"), got[t].form.encode("unicode_escape")) for t in wrong[:5]]
    # An accented letter with a cedilla behind it is composed already.
    assert [got[t].stands_in for t in texts[-6:]] == [True, True, False, True, True, True]
    assert all(got[t].stands_in or unicodedata.is_normalized("NFC", t.translate(dropped)) for t in texts)


# 4: canonical values
def test_canonical(spark):
    ref = spark.createDataFrame([(1, "Saint Velildørf", ["Orvodorf"]), (2, "sea shanty", None), (3, "novelist", []), (4, "Saint Marna", []), (5, "Saint Olba", []), (None, "ghost", []), (6, None, ["goldsmith"])], "ref_id bigint, name string, aliases array<string>")
    values = {"saint velildorf": 1, "St. Velildørf": 1, "Velildørf, Saint": 1, "Orvodrof": 1, "seashanty": 2, "sea/shanty": 2, "NOVELISTS": 3, "noevlist": 3, "goldsmith": 6, "ghost": None, "ice merchant": None, "": None, "?": None, "Saint": None, "The Paper Ledger": None}
    df = spark.createDataFrame([(v, 1) for v in values] * 2 + [(None, 1)], "value string, ref_id int")
    got = {r.value: r.ref_id for r in canonical.match_values(df, ref).collect()}
    assert got == {v: k for v, k in values.items() if k}
    assert canonical.match_values(df.limit(0), ref).count() == 0
    assert canonical.match_values(df, ref.limit(0)).count() == 0
    numbers = spark.createDataFrame([(5, "Flight 93", None), (6, "Flight 12", None), (7, "Studio 54", None)], "ref_id bigint, name string, aliases array<string>")
    texts = ["Flight 12", "flight 93", "Flight 13", "Studio 99", "Studio", "Studio 54", "Sutdio 54"]
    got = {r.value: r.ref_id for r in canonical.match_values(spark.createDataFrame([(v,) for v in texts], "value string"), numbers).collect()}
    assert got == {"Flight 12": 6, "flight 93": 5, "Studio 54": 7, "Sutdio 54": 7}
    assert canonical.edit_distance("abcd", "abdc") == 1 and canonical.edit_distance("", "ab") == 2


@pytest.mark.skipif(not Path(SMALL).exists(), reason="the test tables are not here")
def test_held_out_misspellings(spark):
    r = random.Random(11)
    ref = spark.read.parquet("/root/testdata/sf0.01/ref_item.parquet")
    want = {}
    for x in ref.collect():
        word = fold.fold(x.name)
        at = [i for i in range(1, len(word) - 2) if word[i] != " " and word[i + 1] != " " and word[i] != word[i + 1] and not (word[i] + word[i + 1]).isdigit()]
        words = [w for w in word.split() if len(w) > 5]
        if not words or not at:
            continue
        w = r.choice(words)
        i = r.randrange(1, len(w) - 2)
        want[r.choice([word.replace(w, w[:i] + w[i + 1] + w[i] + w[i + 2 :], 1), word.replace(w, w[:i] + w[i + 1 :], 1), word.replace(w, w[:i] + "x" + w[i:], 1).upper()])] = x.ref_id
    nodes = spark.read.parquet("/root/testdata/sf0.01/graph_node.parquet").select("description").limit(2000)
    values = spark.createDataFrame([(v,) for v in want], "value string").unionByName(nodes.withColumnRenamed("description", "value"))
    got = {x.value: x.ref_id for x in canonical.match_values(values, ref).collect()}
    assert sum(got.get(v) == k for v, k in want.items()) >= 0.98 * len(want)


# 5: groups and splits
def test_groups_and_splits(spark):
    r = random.Random(6)
    rows = [(f"r{i:04}", [f"E{r.randint(0, 900)}" for _ in range(r.randint(0, 3))], r.choice([f" E{r.randint(0, 900)} ", None, " "]), r.choice(["x", "y", None])) for i in range(700)] + [(None, ["E1"], "E2", "x")]
    df = spark.createDataFrame(rows, "id string, entity_qids array<string>, answer_node_qid string, difficulty string")
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for i, e, a, _ in rows[:-1]:
        for x in [*e, (a or "").strip()]:
            if x:
                parent[find("e" + x)] = find("r" + i)
    groups = {}
    for i, *_ in rows[:-1]:
        groups.setdefault(find("r" + i), []).append(i)
    want = {i: min(g) for g in groups.values() if len(g) > 1 for i in g}
    targets = spark.createDataFrame([("train", 0.7), ("validation", 0.15), ("test", 0.15)], "split string, target_share double")
    assert {x.id: x.group_id for x in grouping.related_records(df, targets).collect()} == want
    split = {x.id: x.split for x in grouping.grouped_splits(df, targets).collect()}
    assert len(split) == 700 and all(len({split[i] for i in g}) == 1 for g in groups.values())
    if max(map(len, groups.values())) < 400:
        assert abs(sum(s == "train" for s in split.values()) / 700 - 0.7) < 0.05
    assert grouping.grouped_splits(df.limit(0), targets).count() == 0


def test_all_rows_of_an_id_are_linked(spark):
    rows = [("r", ["A"], None), ("r", ["M", "N"], None), ("r", [], "O"), ("r", ["Z"], None), ("s", ["N"], None), ("t", ["Z"], None), ("u", None, "O"), ("v", ["A"], None), ("w", ["other"], None), ("x", None, None), ("x", [" "], "Y"), ("y", ["Y"], None)]
    df = spark.createDataFrame(rows, "id string, entity_qids array<string>, answer_node_qid string")
    targets = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "split string, target_share double")
    assert sorted(map(tuple, grouping.related_records(df.withColumn("difficulty", F.lit("x")), targets).collect())) == [*((i, "r") for i in "rstuv"), ("x", "x"), ("y", "x")]
    assert len(grouping.record_groups(df).collect()) == 8


def test_flow_keeps_quotas():
    free = [[[(1e9, 0.0)]] * 3] * 3
    flow = grouping.min_cost_flow([50, 30, 20], [70, 15, 15], free)
    assert list(flow.sum(axis=0)) == [70, 15, 15] and list(flow.sum(axis=1)) == [50, 30, 20]


def test_flow_costs_least():
    r = random.Random(5)
    for _ in range(60):
        supply = [r.randint(0, 4) for _ in range(3)]
        quota = [r.randint(0, 4) for _ in range(2)]
        steps = [[[(1, float(x)), (1, float(x + y)), (float("inf"), float(x + y + z))] for x, y, z in [[r.randint(0, 3) for _ in range(3)]] * 1] for _ in range(6)]
        steps = [[steps[2 * b][0], steps[2 * b + 1][0]] for b in range(3)]

        def cost(flow):
            spent = 16.0 * sum(max(0, sum(f[j] for f in flow) - quota[j]) for j in range(2))
            for b in range(3):
                for j in range(2):
                    n = flow[b][j]
                    for u, c in steps[b][j]:
                        spent += min(n, u) * c
                        n -= min(n, u)
            return spent

        got = grouping.min_cost_flow(supply, quota, steps)
        best = min(cost([(a, supply[0] - a), (b, supply[1] - b), (c, supply[2] - c)]) for a in range(supply[0] + 1) for b in range(supply[1] + 1) for c in range(supply[2] + 1))
        assert list(got.sum(axis=1)) == supply and abs(cost(got.tolist()) - best) < 1e-6


def test_splits_differ_neither_in_labels_nor_in_sizes():
    r = random.Random(8)
    bundles = [(label, size, max(1, int(400 / size**1.5))) for label in "xyz" for size in [*range(1, 40), *sorted(r.sample(range(41, 120), 12))]]
    shares = [0.15, 0.7, 0.15]
    got = grouping.allocate(bundles, shares)
    total = sum(s * n for _, s, n in bundles)
    for j, share in enumerate(shares):
        assert abs(sum(n[j] * s for (_, s), n in got.items()) / total - share) < 0.02
        for label in "xyz":
            own = sum(s * n for k, s, n in bundles if k == label)
            assert abs(sum(n[j] * s for (k, s), n in got.items() if k == label) / own - share) < 0.02
        assert max(s for (_, s), n in got.items() if n[j]) >= 60
    assert all(sum(got[k, s]) == n for k, s, n in bundles)
    # What is larger than a quota goes where it fits.
    assert grouping.allocate([("x", 500, 1), ("x", 1, 500)], shares)["x", 500] == [0, 1, 0]


# 6: defects
QUESTION = "Who translated the novel Meadow of Rumor, which Tavik Borel praised in a 1901 essay?"


@pytest.mark.parametrize(
    ("reply", "kind"),
    [(None, "empty"), ("", "empty"), ("  ", "empty"), ("N/A", "empty"), ("...", "empty"), ("<think></think>", "empty"), ("Answer:", "empty"), ("I don't know the answer.", "refusal"), ("Das kann ich leider nicht beantworten.", "refusal"), ("I Don't Know Her", None), ("Sorry, Not Tonight", None), (QUESTION, "copies_question"), ("You asked: " + QUESTION.lower(), "copies_question"), (QUESTION + " It was Tavik Borel.", None), ("La respuesta correcta es Tavik Borel.", "other_language"), ("Tavik de la Borel", None), ("Правильный ответ: Tavik Borel.", "other_language"), ("<think> The seeds", "truncated"), ("The ship was laid down at Tavik, launched in 18", "truncated"), ("Based on the facts (the first triple and the sec", "truncated"), ("The answer is Tavik Borel", None), ("It was the same perso", "truncated"), ("**Tavik Borel.**", None), ("<think>x</think> Tavik", None), ("x" * 50_000, None)],
)
def test_defects(reply, kind):
    assert defects.defect(reply, QUESTION) == kind


def test_defective_replies(spark):
    p = spark.createDataFrame([(1, "a", None), (2, "zz", None), (3, "a", "Tavik"), (1, "a", None)], "pred_id bigint, id string, pred_answer string")
    s = spark.createDataFrame([("a", QUESTION), ("a", QUESTION), ("b", None), (None, QUESTION)], "id string, question string")
    assert [tuple(r) for r in defects.defective_replies(p, s).collect()] == [(1, "empty")]
    assert defects.defective_replies(p.limit(0), s).count() == 0
    assert defects.open_at_end("a (b [c] d") == "(" and defects.open_at_end("```x") == "fence" and defects.open_at_end('"a" (b)') is None
    assert defects.tiles("a b c x".split(), defects.Automaton("z a b c".split())) == [True, True, True, False]


def test_tiles_equal_search():
    r = random.Random(12)
    for _ in range(400):
        q, reply = ([r.choice("abc") for _ in range(r.randint(0, 8))] for _ in range(2))
        auto = defects.Automaton(q)
        runs = [max(n for n in range(i + 2) if any(q[k : k + n] == reply[i + 1 - n : i + 1] for k in range(len(q) - n + 1))) if q else 0 for i in range(len(reply))]
        assert auto.runs(reply) == runs
        covered = {j for i, n in enumerate(runs) if n >= 2 for j in range(i + 1 - n, i + 1)}
        got = {i for i, t in enumerate(defects.tiles(reply, auto)) if t}
        assert got <= covered and (not covered or got)


@pytest.mark.parametrize("base", ["the who translated novel ", QUESTION + " ", "word ", "who the ", "(a | * "])
def test_long_replies_take_linear_time(base):
    import time

    began = time.process_time()
    defects.defect((base * 10_000)[:60_000], QUESTION)
    assert time.process_time() - began < 1.5


@pytest.fixture(scope="module")
def trained(spark):
    from hopweave.llm import speech

    return speech.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/split_record.parquet").select("answer").distinct())


# Texts of our own, none of which is like the data's.
OWN = {
    "other_language": ["A válasz a kérdésre az, hogy a könyvet Tavik Borel írta.", "Vastaus kysymykseen on, että kirjan kirjoitti Tavik Borel.", "Svaret på spørgsmålet er, at bogen blev skrevet af Tavik Borel.", "Răspunsul la întrebare este că romanul a fost scris de Tavik Borel.", "Câu trả lời cho câu hỏi này là người đã dịch cuốn sách.", "Jawaban atas pertanyaan itu adalah orang yang menulis buku tersebut.", "इस प्रश्न का उत्तर यह है कि पुस्तक का अनुवाद उन्होंने किया।", "คำตอบของคำถามนี้คือผู้แปลหนังสือเล่มนี้", "এই প্রশ্নের উত্তর হল যে বইটি তিনি অনুবাদ করেছেন।", "这个问题的答案是那位翻译了这本小说的人。", "저는 이 질문에 대한 답을 알고 있습니다."],
    "refusal": ["My knowledge doesn't extend to this.", "There's simply no way for me to tell.", "That falls outside what I can speak to.", "I'd have to pass on this one.", "This is beyond my knowledge.", "I have no clue.", "It's hard to say from the material.", "I really wouldn't want to guess here.", "The passage doesn't tell us who translated it.", "I'm not able to share that."],
    "truncated": ["1. Tavik Borel\n2. Mara Olen\n3.", "| Name | Year |\n| --- | --- |\n| Tavik Borel | 19", "The answer is **Tavik Bor", "- Tavik\n- Mara\n-"],
    "copies_question": [QUESTION + " " + QUESTION, "Let me repeat: " + QUESTION],
    None: ["1. Tavik Borel\n2. Mara Olen", "| Name | Year |\n| --- | --- |\n| Tavik Borel | 1901 |", "**Tavik Borel**", "I think it was translated by Tavik Borel.", "It would most likely be Tavik Borel, as he was the only translator mentioned.", "Tavik Borel, probably.", "Nguyễn Thị Minh Khai", "แม่น้ำโขง"],
}


@pytest.mark.skipif(not Path(SMALL).exists(), reason="the test tables are not here")
@pytest.mark.parametrize("kind", list(OWN))
def test_defects_of_own_texts(trained, kind):
    right = [defects.defect(t, QUESTION, trained) == kind for t in OWN[kind]]
    assert sum(right) >= 0.9 * len(right), [t for t, x in zip(OWN[kind], right) if not x]


def test_short_questions_are_copied():
    assert defects.defect("Who wrote Emma?", "Who wrote Emma?") == "copies_question"
    assert defects.defect("Jane Austen wrote Emma", "Who wrote Emma?") is None
    assert defects.defect("誰がこの小説を書いたのですか?", "誰がこの小説を書いたのですか?") == "copies_question"


# 8: token ids
needs_vocabulary = pytest.mark.skipif(not Path(bpe.VOCABULARY).exists(), reason="no vocabulary file")


@needs_vocabulary
def test_encoding_is_exact(spark):
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(bpe.VOCABULARY.replace(".tiktoken", ".json"))
    theirs.encode_special_tokens = True
    r = random.Random(8)
    texts = ["", None, "<|endoftext|>", "a" * 3000, "  \n\t x", "it's 12 é‍ 日本"] + ["".join(r.choice("abcdefgh é日\n'1") for _ in range(r.randint(1, 80))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, ids int")
    got = {x.doc_id: list(x.ids) for x in bpe.encode_corpus(df).collect()}
    assert got == {i: theirs.encode(t, add_special_tokens=False).ids if t else [] for i, t in enumerate(texts)}
    coder = bpe.Coder(Path(bpe.VOCABULARY).read_bytes())
    assert all(coder.decode(coder.encode(t)) == t for t in texts if t)
    assert bpe.encode_corpus(df.limit(0)).count() == 0


# 9: mixing
@needs_vocabulary
def test_mix(spark):
    docs = [(i, "word " * (i % 7 + 1), "big" if i % 3 else "small") for i in range(600)] + [(900, None, "big"), (901, "", "big"), (902, "x", None), (903, "y", "unlisted")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("big", 0.3, 1), ("small", 0.6, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    report = {x.source: x for x in mixing.mix_report(df, targets).collect()}
    assert report["none"].tokens_used == 0 and report["none"].tokens_missing > 0
    assert report["small"].tokens_used == 3 * report["small"].tokens_available
    assert abs(report["big"].share_reached - 0.3 / 0.9) < 0.01
    used = mixing.mix(df, targets).collect()
    assert max(x.uses for x in used if x.source == "small") == 3 and max(x.uses for x in used if x.source == "big") == 1 and len({x.doc_id for x in used}) == len(used)
    assert mixing.mix(df.limit(0), targets).count() == 0
    fixed = {x.source: x for x in mixing.mix_report(df, targets, total_tokens=1000).collect()}
    assert abs(fixed["small"].tokens_used - 600) <= 8


def test_quality_orders_texts(spark):
    good = "The harbour was built in 1882, when the town traded in grain and timber with its neighbours."
    bad = ["spam spam spam spam spam spam spam spam spam spam spam spam", "|||--- ### |||--- ### |||---", "1 2 3 4 5 6 7 8 9 10 11 12", "x" * 500, "", "!"]
    w = {r.t: r.w for r in mixing.with_quality(spark.createDataFrame([(t,) for t in [good, *bad]], "t string"), "t", "w").collect()}
    assert all(mixing.LEAST_WEIGHT <= x <= 1 for x in w.values()) and all(w[good] > w[t] + 0.1 for t in bad) and w[good] > 0.9


# 10: encodings
@pytest.mark.skipif(not Path(SMALL).exists(), reason="the test tables are not here")
def test_restoring_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    restorer = mojibake.Restorer(mojibake.train(docs.where("doc_id % 2 = 0")))
    clean = [r.text for r in docs.where("doc_id % 2 = 1 and text is not null").collect() if not r.text.isascii() and not mojibake.suspicious(r.text)]
    assert sum(g for _, g in restorer.restore_all(clean)) <= 0.01 * len(clean)
    found = exact = chains = 0
    poor = []
    for right, wrong in mojibake.CHAINS:
        garbled = []
        for t in clean:
            try:
                g = "".join(bytes([b]).decode(wrong, "ignore") or chr(b) for b in t.encode(right))
            except UnicodeEncodeError:
                continue
            if g != t:
                garbled.append((t, g))
        garbled = garbled[:40]
        if len(garbled) >= 5:
            back = restorer.restore_all([g for _, g in garbled])
            if (right, wrong) in {("utf-8", w) for w in ("cp1252", "latin-1", "mac_roman", "cp437", "cp1251")}:
                assert sum(x for _, x in back) >= 0.97 * len(garbled), wrong
                assert sum(r == t for (r, _), (t, _) in zip(back, garbled)) >= 0.9 * len(garbled), wrong
            chains += 1
            found += sum(x for _, x in back) >= 0.85 * len(garbled)
            exact += sum(r == t for (r, _), (t, _) in zip(back, garbled)) >= 0.85 * len(garbled)
            if sum(r == t for (r, _), (t, _) in zip(back, garbled)) < 0.85 * len(garbled):
                poor.append((right, wrong))
    assert chains > 40 and found >= 0.9 * chains and exact >= 0.85 * chains, (chains, found, exact, poor)


def test_margins_cover_all_clean_records(spark):
    x = random.Random(5)
    filler = ["".join(x.choice("aeiklmnrstvz") for _ in range(6)) for _ in range(200)]

    def text(k, o="ő"):
        return " ".join([*x.sample(filler, 12), *x.sample(["ő", "őt", "ők", "őr", "őz", "ős"], 3), str(k)]).replace("ő", o)

    # Clean records of a rarer spelling that looks like wrongly read text; by hash they come after all others.
    rare = [(text(k, "õ"),) for k in range(2400, 2800)]
    last = [r.text for r in spark.createDataFrame(rare, "text string").orderBy(F.xxhash64("text").desc()).limit(20).collect()]
    right = text(2800)
    texts = [*(text(k) for k in range(2400)), *last, right.encode().decode("cp1252")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert not any(map(mojibake.suspicious, texts[:-1])) and mojibake.suspicious(texts[-1])
    assert mojibake.train(df).factor > mojibake.FACTORS[0]
    found = {r.doc_id for r in mojibake.garbled_documents(df).collect()}
    assert 2420 in found and len(found) - 1 <= mojibake.FALSE * 2420
    got = {r.doc_id: (r.garbled, r.restored) for r in mojibake.restored_text(df).collect()}
    assert len(got) == 2421 and {k for k, (g, _) in got.items() if g} == found and got[2420] == (True, right)
    assert all(got[k][1] == t for k, t in enumerate(texts) if k not in found)


def test_restored_edge_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "plain"), (4, "caf�"), (5, "x" * 20000)], "doc_id bigint, text string")
    got = {r.doc_id: (r.garbled, r.restored) for r in mojibake.restored_text(df).collect()}
    assert got == {1: (False, None), 2: (False, ""), 3: (False, "plain"), 4: (True, "caf�"), 5: (False, "x" * 20000)}
    assert mojibake.garbled_documents(df.limit(0)).count() == 0
    assert mojibake.undo("Ã©", "utf-8", "cp1252") == ("é", 0) and mojibake.undo("abc", "utf-8", "cp1252") is None


# the queries with SQL
@pytest.mark.skipif(not Path(SMALL).exists(), reason="the test tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in Path(SMALL).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    df = queries.QUERIES[name](spark, SMALL)
    sql = con.sql(queries.ORACLES[name])
    at = [list(sql.columns).index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect())) == sorted(tuple(r[i] for i in at) for r in sql.fetchall())

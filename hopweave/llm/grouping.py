"""Problem 5: splits that keep related records together.

Records that share an entity, directly or through others, form one component.
Method: components are bundled by equal size and label profile; a min-cost flow gives
each bundle's records to the splits, with costs for deviating from a split's share and
for going beyond its quota; flows are rounded to whole components; which components of
a bundle go where is decided by the order of a hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..operators.ranks import hash_key, rank_within
from ..session import Scratch
from .records import clean_id, clean_ids

#: What a record costs that goes beyond its bundle's share in a split (up to twice the share, and further), that goes
#: beyond a split's quota, and, per part that does not fit, of a component larger than the quota.
BEYOND_SHARE, FAR_BEYOND, BEYOND_QUOTA, TOO_LARGE = 1.0, 2.0, 16.0, 64.0


def record_groups(records: DataFrame) -> DataFrame:
    """``(id, group)`` of every distinct record: equal groups must stay together.

    ``records`` has ``id, entity_qids, answer_node_qid``.  Blanks around ids, null and blank
    ids and repeats do not count.  A record without entities is a group of its own.
    Rows without an id are left out; several rows of one id count as one record with
    all their entities.
    """
    spark = records.sparkSession
    entities = F.array_distinct(F.concat(clean_ids("entity_qids"), F.array_compact(F.array(clean_id("answer_node_qid")))))
    each = records.where("id is not null").select("id", F.array_sort(entities).alias("e"))
    pivot = F.get("e", F.lit(0))
    links = each.where("size(e) > 1").select(pivot.alias("a"), F.explode(F.slice("e", F.lit(2), F.size("e"))).alias("b"))
    # Rows of one id with different entities are linked through the id itself: each row's pivot to the smallest.
    pivots = Scratch(spark, "records").cut(each.select("id", pivot.alias("other")).distinct())
    known = pivots.groupBy("id").agg(F.min("other").alias("pivot"))
    links = links.unionByName(pivots.join(known, "id").where("pivot <> other").select(F.col("pivot").alias("a"), F.col("other").alias("b")))
    nodes = connected_components(links.distinct())
    return known.join(nodes, F.col("pivot") == F.col("node"), "left").select("id", F.coalesce("component", "pivot", F.concat(F.lit("record "), "id")).alias("group"))


def min_cost_flow(supply: list[int], quota: list[int], steps: list[list[list[tuple[float, float]]]], over: float = BEYOND_QUOTA) -> np.ndarray:
    """Units of each supply to each quota at the least cost.

    ``steps[b][j]`` are the convex costs of supply ``b`` in quota ``j``: ``(units, cost of each)``,
    cheapest first, the last one without end.  A quota may be exceeded at ``over`` a unit.
    Successive shortest paths: units take the cheapest way, which may move units of
    earlier supplies on to another quota.
    """
    n, m = len(supply), len(quota)
    flow, free = np.zeros((n, m)), np.array(quota, dtype=float)
    ends = np.array([[np.cumsum([u for u, _ in steps[b][j]]) for j in range(m)] for b in range(n)]).reshape(n, m, -1)
    price = np.array([[[c for _, c in steps[b][j]] for j in range(m)] for b in range(n)]).reshape(n, m, -1)
    for b in range(n):
        units = float(supply[b])
        while units > 1e-9:
            at = np.argmax(flow[: b + 1, :, None] < ends[: b + 1] - 1e-9, axis=2)
            back = np.argmax(flow[: b + 1, :, None] <= ends[: b + 1] + 1e-9, axis=2)
            one = np.take_along_axis(price[: b + 1], at[..., None], 2)[..., 0]
            saved = np.take_along_axis(price[: b + 1], back[..., None], 2)[..., 0]
            way: list[tuple[float, int | None, int | None]] = [(float(one[b, j]), None, None) for j in range(m)]
            # Costs of moves may be negative, so plain relaxation over the few quotas.
            for _ in range(m):
                for j in range(m):
                    for k in range(m):
                        if j != k:
                            move = np.where(flow[: b + 1, j] > 1e-9, one[:, k] - saved[:, j], np.inf)
                            c = int(np.argmin(move))
                            if way[j][0] + move[c] < way[k][0] - 1e-9:
                                way[k] = (way[j][0] + float(move[c]), j, c)
            end = min(range(m), key=lambda j: way[j][0] + (0.0 if free[j] > 1e-9 else over))
            amount, j, seen = min(units, free[end]) if free[end] > 1e-9 else units, end, 0
            while way[j][1] is not None and seen <= m:
                c, k = way[j][2], way[j][1]
                low = ends[c, k, back[c, k] - 1] if back[c, k] else 0.0
                amount, j, seen = min(amount, flow[c, k] - low, ends[c, j, at[c, j]] - flow[c, j]), k, seen + 1
            amount = min(amount, ends[b, j, at[b, j]] - flow[b, j])
            flow[b, j] += amount
            j = end
            while way[j][1] is not None:
                flow[way[j][2], j] += amount
                flow[way[j][2], way[j][1]] -= amount
                j = way[j][1]
            free[end] -= min(amount, free[end])
            units -= amount
    return flow


def allocate(bundles: list[tuple[str, int, int]], shares: list[float]) -> dict[tuple[str, int], list[int]]:
    """Whole components of each bundle ``(label, size, components)`` to each split.

    Quotas hold per label, so every split gets its share of each label as far as whole
    components allow.  A split's share of a bundle costs nothing, records beyond it cost
    more the further they go, so that splits differ neither in labels nor in sizes of
    components; a component larger than a split's quota costs what it exceeds.
    """
    out: dict[tuple[str, int], list[int]] = {}
    splits = range(len(shares))
    left = [s * sum(size * n for _, size, n in bundles) for s in shares]
    for label in sorted({b[0] for b in bundles}):
        own = sorted(((size, n) for name, size, n in bundles if name == label), reverse=True)
        total = sum(size * n for size, n in own)
        quota = [s * total for s in shares]
        steps = []
        for size, n in own:
            far = [TOO_LARGE * max(0.0, size - q) / size for q in quota]
            steps.append([[(s * size * n, far[j]), (s * size * n, far[j] + BEYOND_SHARE), (float("inf"), far[j] + FAR_BEYOND)] for j, s in enumerate(shares)])
        flow = min_cost_flow([size * n for size, n in own], quota, steps)
        # From the largest components down, round to whole ones; what rounding owes or is owed goes to the next.
        owed = np.zeros(len(shares))
        for (size, n), f in zip(own, flow):
            want = np.maximum(0.0, (f + owed) / size)
            want = want * (n / want.sum()) if want.sum() > 0 else np.array(shares) * n
            got = np.floor(want + 1e-9).astype(int)
            for j in sorted(splits, key=lambda j: (got[j] - want[j], -left[j]))[: n - int(got.sum())]:
                got[j] += 1
            out[label, size] = [int(x) for x in got]
            owed = owed + f - got * size
            left = [left[j] - int(got[j]) * size for j in splits]
    return out


def grouped_splits(records: DataFrame, targets: DataFrame, label: str = "difficulty", seed: int = 42) -> DataFrame:
    """``(id, split, group_id, group_size, label)``: a split for every distinct record, the same for all of a group.

    ``group_id`` is the smallest id of the group.  ``targets`` has ``split, target_share``;
    its shares are scaled to add up to 1, null and negative ones count as 0.  A record's
    label is its largest ``label``, null counts as one; the profile of a group is its most
    frequent label (the smaller on a tie).  Without records there are no rows.
    """
    spark = records.sparkSession
    scratch = Scratch(spark, "splits")
    # Split targets are a small fixed table.
    rows = sorted((r["split"], max(0.0, r["target_share"] or 0.0)) for r in targets.where("split is not null").collect())
    total = sum(s for _, s in rows)
    if not rows or total <= 0:
        raise ValueError("targets name no split with a positive share")
    names, shares = [n for n, _ in rows], [s / total for _, s in rows]
    labels = records.where("id is not null").groupBy("id").agg(F.coalesce(F.max(label), F.lit("")).alias("label"))
    members = scratch.cut(record_groups(records).join(labels, "id"))
    by_label = members.groupBy("group", "label").agg(F.count("*").alias("n"), F.min("id").alias("group_id"))
    groups = by_label.groupBy("group").agg(F.sum("n").alias("size"), F.min("group_id").alias("group_id"), F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("profile"))
    groups = scratch.cut(groups.withColumn("key", hash_key(seed, "group")))
    # Distinct sizes of groups are fewer than the square root of twice the records, so bundles stay few.
    bundles = groups.groupBy("profile", "size").agg(F.count("*").alias("groups")).collect()
    plan = allocate([(r["profile"], r["size"], r["groups"]) for r in bundles], shares)
    cuts = []
    for (profile, size), counts in plan.items():
        at = 0
        for name, n in zip(names, counts):
            if n:
                cuts.append((profile, size, at, at + n, name))
                at += n
    table = spark.createDataFrame(cuts, "profile string, size bigint, above bigint, upto bigint, split string")
    placed = rank_within(groups, ["profile", "size"], "key", "group").join(F.broadcast(table), ["profile", "size"]).where("rank > above and rank <= upto").select("group", "split", "group_id", "size")
    return members.join(placed, "group").select("id", "split", "group_id", F.col("size").alias("group_size"), "label")


def related_records(records: DataFrame, targets: DataFrame) -> DataFrame:
    """``(id, group_id)`` of the records of every group of two or more that ``grouped_splits`` keeps in one split."""
    return grouped_splits(records, targets).where("group_size > 1").select("id", "group_id")


def split_report(records: DataFrame, targets: DataFrame, label: str = "difficulty") -> DataFrame:
    """Per split and label: records, their share among all records of the label beside the split's target, groups, and the largest group; label null is the whole split."""
    placed = grouped_splits(records, targets, label)
    counted = placed.groupBy("split", "label").agg(F.count("*").alias("records"), F.countDistinct("group_id").alias("groups"), F.max("group_size").alias("largest_group"))
    # A group has several labels, so groups of a whole split are counted apart.
    whole = placed.groupBy("split").agg(F.lit(None).cast("string").alias("label"), F.count("*").alias("records"), F.count_if(F.col("id") == F.col("group_id")).alias("groups"), F.max("group_size").alias("largest_group"))
    every = counted.unionByName(whole)
    sums = every.groupBy(F.col("label").alias("__l")).agg(F.sum("records").alias("all"))
    wanted = targets.where("split is not null").groupBy("split").agg(F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target"))
    return every.join(sums, every["label"].eqNullSafe(sums["__l"])).join(wanted, "split").select("split", "label", "records", "groups", "largest_group", (F.col("records") / F.col("all")).alias("share"), F.col("target").alias("target_share"))

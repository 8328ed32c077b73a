"""Problem 2: a sample whose category shares follow given targets.

Method: categories are counted; integer quotas come by largest remainder with floors
and availability caps; within each cell of equal categories the records with the
smallest random keys are taken; shortfalls are reported.

A record has one difficulty and one reasoning type but any number of ontologies, so
quotas of the three dimensions must hold together.  Records are counted in cells
(difficulty, reasoning type, set of listed ontologies); cell weights are raked until
every category reaches its quota, rounded by largest remainder, and blocks of records,
halved down to single ones, are moved between cells while that brings categories closer
to their quotas.
"""

from __future__ import annotations

from math import ceil

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import hash_key, rank_within

RAKING_ROUNDS = 300
#: Blocks start at this part of the sample, so that the moves needed do not grow with it. Exchanges that are compared at once.
BLOCKS, EXCHANGES = 1000, 50_000
SINGLE = ("difficulty", "reasoning_type")
MULTI = "matched_ontologies"


#: Target rows as the driver plans with them.
Target = tuple[str, str, float, int, int]


def read_targets(targets: DataFrame) -> list[Target]:
    """The rows of the small fixed table of targets: ``(dimension, category, share, min_rows, sample_rows)``; nulls count as 0, repeated categories keep their largest numbers."""
    rows: dict[tuple[str, str], tuple[float, int, int]] = {}
    for t in targets.where("dimension is not null and category is not null").select("dimension", "category", "target_share", "min_rows", "sample_rows").collect():
        new = (float(t[2] or 0), int(t[3] or 0), int(t[4] or 0))
        rows[t[0], t[1]] = tuple(map(max, new, rows.get((t[0], t[1]), new)))
    return [(*k, *rows[k]) for k in sorted(rows)]


def record_cells(records: DataFrame, targets: list[Target]) -> DataFrame:
    """``(id, difficulty, reasoning_type, ontologies)`` of every distinct record; only listed categories, ontologies sorted.

    Rows without an id are left out; rows of one id count once, with the largest value of each
    field.  Categories that no target names are null, so the cells are bounded by the targets.
    """
    named = {d: [c for k, c, *_ in targets if k == d] for d in (*SINGLE, MULTI)}
    onts = F.array_sort(F.array_distinct(F.filter(F.transform(MULTI, lambda m: m["ont_id"]), lambda x: x.isin(named[MULTI]) if named[MULTI] else F.lit(False))))
    one = records.where("id is not null").select("id", *SINGLE, F.coalesce(onts, F.array().cast("array<string>")).alias("ontologies")).groupBy("id").agg(*(F.max(c).alias(c) for c in SINGLE), F.max("ontologies").alias("ontologies"))
    return one.withColumns({c: F.when(F.col(c).isin(named[c]) if named[c] else F.lit(False), F.col(c)) for c in SINGLE})


def needed(target: Target) -> float:
    """The larger of ``min_rows`` and ``target_share * sample_rows``."""
    # A product like 0.07 * 6000 is a little more than 420; such a last digit is no need.
    return max(float(target[3]), round(target[2] * target[4], 6))


def largest_remainder(total: int, wanted: list[float], floors: list[int], caps: list[int]) -> list[int]:
    """Integers near ``wanted`` that add up to ``total`` as far as floors and caps allow.

    Floors above caps are lowered to them.  What floors and caps take from or leave to
    the others is shared among them in proportion.
    """
    floors = [min(f, c) for f, c in zip(floors, caps)]
    low, high = 0.0, 1.0
    fit = lambda x: [min(c, max(f, w * x)) for w, f, c in zip(wanted, floors, caps)]
    while sum(fit(high)) < total and high < 1e12:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(fit(mid)) < total else (low, mid)
    real = fit(high)
    out = [int(x + 1e-9) for x in real]
    for i in sorted(range(len(real)), key=lambda i: (out[i] - real[i], -wanted[i], i)):
        if sum(out) >= total:
            break
        if out[i] < caps[i]:
            out[i] += 1
    return out


def cell_quotas(cells: list[tuple[str | None, str | None, tuple[str, ...], int]], targets: list[Target], size: int) -> tuple[list[int], dict[tuple[str, str], int]]:
    """How many records to take of each cell ``(difficulty, reasoning type, ontologies, count)``, and the quota of each category."""
    count = np.array([c[3] for c in cells], dtype=float)
    size = min(size, int(count.sum()))
    has = np.array([[(c[0] == k) if d == SINGLE[0] else (c[1] == k) if d == SINGLE[1] else k in c[2] for d, k, *_ in targets] for c in cells], dtype=float).reshape(len(cells), len(targets))
    supply = has.T @ count
    quota = np.zeros(len(targets))
    for d in (*SINGLE, MULTI):
        own = [i for i, t in enumerate(targets) if t[0] == d]
        if not own:
            continue
        shares = [targets[i][2] * size for i in own]
        floors, caps = [min(targets[i][3], size) for i in own], [int(supply[i]) for i in own]
        # Ontologies overlap, so their quotas need not add up to the sample, and none makes up for what another lacks.
        total = round(sum(min(c, max(f, s)) for s, f, c in zip(shares, floors, caps))) if d == MULTI else min(size, round(sum(shares)))
        quota[own] = largest_remainder(total, shares, floors, caps)
    wanted = {(t[0], t[1]): int(q) for t, q in zip(targets, quota)}
    if size == 0:
        return [0] * len(cells), wanted
    w = count * (size / count.sum())
    for _ in range(RAKING_ROUNDS):
        for i in range(len(targets)):
            inside = has[:, i] > 0
            now, rest = w[inside].sum(), w[~inside].sum()
            if now > 0:
                w[inside] *= quota[i] / now
            if rest > 0 and size > quota[i]:
                w[~inside] *= (size - quota[i]) / rest
            w = np.minimum(w, count)
    w *= size / max(w.sum(), 1e-9)
    take = np.array(largest_remainder(size, list(w), [0] * len(cells), [int(c) for c in count]), dtype=float)
    floor = np.array([min(t[3], s, size) for t, s in zip(targets, supply)])
    # A record more or less matters more to a small category.
    weight = 1 / np.sqrt(np.maximum(quota, 1))

    def loss(sums: np.ndarray) -> np.ndarray:
        return np.abs(sums - quota) * weight + 10 * np.maximum(0, floor - sums)

    step = max(1, EXCHANGES // len(cells))
    block = max(1, size // BLOCKS)
    while block:
        moved = False
        for first in range(0, len(cells), step):
            part = has[first : first + step]
            while True:
                sums = has.T @ take
                now = loss(sums)
                more, less = loss(sums + block) - now, loss(sums - block) - now
                # A category of both cells keeps its sum.
                change = (part @ less)[:, None] + (has @ more)[None, :] - (part * (more + less)) @ has.T
                change[take[first : first + step] < block] = np.inf
                change[:, count - take < block] = np.inf
                a, b = np.unravel_index(int(np.argmin(np.round(change, 9))), change.shape)
                if change[a, b] >= -1e-9:
                    break
                take[first + a] -= block
                take[b] += block
                moved = True
        # What a later part moved may let an earlier one move again.
        if not moved or len(cells) <= step:
            block //= 2
    return [int(x) for x in take], wanted


def _plan(records: DataFrame, targets: DataFrame):
    wanted = read_targets(targets)
    cells = record_cells(records, wanted)
    found = sorted(((r[0], r[1], tuple(r[2]), r["n"]) for r in cells.groupBy(*SINGLE, "ontologies").agg(F.count("*").alias("n")).collect()), key=lambda c: (c[0] or "", c[1] or "", c[2]))
    take, quota = cell_quotas(found, wanted, max((t[4] for t in wanted), default=0))
    return cells, wanted, found, take, quota


def balanced_sample(records: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """``(id, difficulty, reasoning_type, ontologies)`` of a sample of ``sample_rows`` records.

    Where fewer records exist, all of them are taken.  Categories that no target names are
    null: their records fill up what named ones leave.
    """
    spark = records.sparkSession
    cells, _, found, take, _ = _plan(records, targets)
    table = spark.createDataFrame([(*c[:3], n) for c, n in zip(found, take) if n], "d string, r string, o array<string>, quota int")
    same = cells[SINGLE[0]].eqNullSafe(F.col("d")) & cells[SINGLE[1]].eqNullSafe(F.col("r")) & (cells["ontologies"] == F.col("o"))
    chosen = cells.join(F.broadcast(table), same).drop("d", "r", "o").withColumn("key", hash_key(seed, "id"))
    chosen = chosen.withColumn("cell", F.xxhash64(*SINGLE, "ontologies"))
    return rank_within(chosen, ["cell", *SINGLE, "ontologies"], "key", "id").where("rank <= quota").select("id", *SINGLE, "ontologies")


def sample_report(records: DataFrame, targets: DataFrame) -> DataFrame:
    """Each target with the records that exist and are needed, its quota, the records chosen for it, and what is missing to the need.

    ``capped`` tells that no quota can reach the need of the category, taken by itself;
    other misses come from the categories of several dimensions excluding each other.
    """
    _, wanted, found, take, quota = _plan(records, targets)
    available, chosen = ({(t[0], t[1]): 0 for t in wanted} for _ in range(2))
    for c, n in zip(found, take):
        for k in ((SINGLE[0], c[0]), (SINGLE[1], c[1]), *((MULTI, o) for o in c[2])):
            if k in chosen:
                available[k] += c[3]
                chosen[k] += n
    rows = []
    for t in wanted:
        k, need = (t[0], t[1]), needed(t)
        rows.append((*t, available[k], need, quota[k], chosen[k], max(0, ceil(need) - chosen[k]), need > available[k]))
    return records.sparkSession.createDataFrame(rows, "dimension string, category string, target_share double, min_rows bigint, sample_rows bigint, available bigint, needed double, quota bigint, chosen bigint, missing bigint, capped boolean")


def short_categories(records: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct ``(dimension, category)`` of the targets whose quota is capped by the records that exist."""
    return sample_report(records, targets).where("capped").select("dimension", "category")

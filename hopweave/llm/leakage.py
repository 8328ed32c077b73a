"""Problem 1: evaluation records that also appear, exactly or almost, in the training split.

Method: the passages of the normalised evaluation texts (all runs of ``SPAN``
characters) go into Aho-Corasick automata, one per shard; every training text of
the shard is scanned once; matched intervals are merged into coverage of both texts.

Shards follow the answer node, because only records with the same one can overlap.  The
records of an answer node that is too frequent for one shard are parted further by an
entity: of two records whose entities include each other, one holds the rarest entity of
the other, so each record looks for partners where its rarest entity is, and is found
where any of its entities is; nothing is compared twice.  Only records without entities
are compared with all of their answer node.  A shard that is still too large is cut into
blocks of texts, so no task grows with a hot key.  Within a shard equal texts are one,
and the automaton holds only the rarest passages of each evaluation text: as many as are
needed that a text covering ``COVER_LONG`` of it cannot miss them all.  Candidates are
then compared in full.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fold import fold
from .records import clean_id, clean_ids

#: Characters of a passage.
SPAN = 5
#: Least share of the shorter and of the longer text that shared passages must cover.
COVER_SHORT, COVER_LONG = 0.75, 0.55
#: The same where one record has no entities, so that only its wording tells what it asks about.
COVER_BARE = 0.9
#: Share of an evaluation text's passages that near copies commonly hold; no pair is left out for holding fewer.
SHARED = 0.4
#: Records of a block of evaluation and of training texts.
EVAL_BLOCK, TRAIN_BLOCK = 512, 8192


@lru_cache(50_000)
def _passages(text: str) -> frozenset[str]:
    return frozenset(text[i : i + SPAN] for i in range(max(1, len(text) - SPAN + 1)))


def covered(text: str, passages: frozenset[str]) -> int:
    """Characters of ``text`` inside the merged intervals of the given passages."""
    if len(text) <= SPAN:
        return len(text) if text in passages else 0
    total = end = 0
    for i in range(len(text) - SPAN + 1):
        if text[i : i + SPAN] in passages:
            total += i + SPAN - max(i, end)
            end = i + SPAN
    return total


def coverage(a: str, b: str, shared: frozenset[str]) -> tuple[float, float]:
    """The shares of two texts that the intervals of their shared passages cover."""
    return covered(a, shared) / max(1, len(a)), covered(b, shared) / max(1, len(b))


def alike(a: str, b: str, bare: bool, of_a: float, of_b: float) -> bool:
    """Whether two normalised texts with the given coverages are equal or nearly equal."""
    (_, short), (_, long) = sorted(((len(a), of_a), (len(b), of_b)))
    if bare:
        numbers = [{w for w in t.split() if w.isdigit()} for t in (a, b)]
        return min(short, long) >= COVER_BARE and (numbers[0] <= numbers[1] or numbers[1] <= numbers[0])
    return short >= COVER_SHORT and long >= COVER_LONG


def least_shared(text: str) -> int:
    """Passages of ``text`` that any text covering ``COVER_LONG`` of it shares at least."""
    often = Counter(text[i : i + SPAN] for i in range(max(1, len(text) - SPAN + 1)))
    need, k = COVER_LONG * len(text) - 1e-9, 0
    for n in sorted(often.values(), reverse=True):
        if need <= 0:
            break
        need -= n * SPAN
        k += 1
    return max(1, k)


def rare_passages(texts: list[str]) -> dict[str, list[int]]:
    """Rare passages to the texts that they stand for: of each text so many that no near copy lacks all of them."""
    often = Counter(p for t in texts for p in _passages(t))
    out: dict[str, list[int]] = {}
    for i, t in enumerate(texts):
        own = sorted(_passages(t), key=lambda p: (often[p], p))
        for p in own[: len(own) - least_shared(t) + 1]:
            out.setdefault(p, []).append(i)
    return out


class _Shard:
    """The automaton over one shard's evaluation texts; equal texts with equal entities are one class."""

    def __init__(self) -> None:
        self.classes: dict[tuple[str, frozenset, bool], list[str]] = {}
        self.rows: list[tuple[str, frozenset, bool]] = []
        self.machine = None
        self.least: list[int] = []
        self.known: dict[tuple[str, frozenset, bool], list[tuple[int, float]]] = {}

    def add(self, key: str, text: str, entities: Iterable[str], probe: bool = True) -> None:
        self.classes.setdefault((text, frozenset(entities), probe), []).append(key)

    def build(self) -> None:
        self.machine = ahocorasick.Automaton()
        self.rows = list(self.classes)
        texts = [t for t, _, _ in self.rows]
        rare = rare_passages(texts)
        self.least = [least_shared(t) for t in texts]
        for p in {p for t in texts for p in _passages(t)}:
            self.machine.add_word(p, (p, rare.get(p, ())))
        self.machine.make_automaton()

    def matches(self, text: str, entities: frozenset, probe: bool = True) -> list[tuple[int, float]]:
        """Classes of evaluation texts that ``text`` repeats, with the covered share of each."""
        if self.machine is None:
            self.build()
        if (text, entities, probe) in self.known:
            return self.known[text, entities, probe]
        matched, near = set(), set()
        for _, (p, who) in self.machine.iter(text):
            if p not in matched:
                matched.add(p)
                near.update(who)
        found = []
        for i in near:
            other, theirs, probes = self.rows[i]
            if (probe or probes) and (entities <= theirs or theirs <= entities):
                shared = _passages(other) & matched
                if len(shared) < self.least[i]:
                    continue
                of_eval, of_train = coverage(other, text, shared)
                if alike(other, text, not entities or not theirs, of_eval, of_train):
                    found.append((i, of_eval))
        self.known[text, entities, probe] = found
        return found

    def keys(self, i: int) -> list[str]:
        return self.classes[self.rows[i]]

    def partners(self, text: str, entities: frozenset, probe: bool = True) -> Iterator[tuple[str, float]]:
        """Ids of the evaluation records that ``text`` repeats, with the covered share of each."""
        for i, share in self.matches(text, entities, probe):
            for key in self.keys(i):
                yield key, share


_SHARD = ["answer", "entity", "side", "eval_block", "train_block"]


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[_Shard, list[tuple[str, str, frozenset, bool]], bool]]:
    """Shards with some of their training rows, and whether these are their last.  Rows come sorted by shard, evaluation texts first."""
    at, shard, rows = None, _Shard(), []
    for pdf in batches:
        for *where, train, key, question, entities, probe in zip(*(pdf[c] for c in (*_SHARD, "train", "id", "question", "entities", "probe"))):
            if where != at:
                yield shard, rows, True
                at, shard, rows = where, _Shard(), []
            text = fold(question)
            if text and not train:
                shard.add(key, text, entities, bool(probe))
            elif text and shard.classes:
                rows.append((key, text, frozenset(entities), bool(probe)))
        yield shard, rows, False
        rows = []
    yield shard, rows, True


def _scan_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for shard, rows, _ in _shards(batches):
        out = [(found, key, share) for key, text, entities, probe in rows for found, share in shard.partners(text, entities, probe) if found != key]
        if out:
            yield pd.DataFrame(out, columns=["eval_id", "train_id", "covered"])


def _scan_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records that take part in an overlap, once per shard, without their pairs."""
    best: dict[int, float] = {}
    for shard, rows, last in _shards(batches):
        out = []
        for key, text, entities, probe in rows:
            found = shard.matches(text, entities, probe)
            # A record that stands in several splits is no overlap with itself alone.
            others = [(i, share) for i, share in found if len(shard.keys(i)) > 1 or shard.keys(i)[0] != key]
            if others:
                out.append((key, True, None))
            for i, share in others:
                if len(shard.keys(i)) > 1 and key in shard.keys(i):
                    out += [(k, False, share) for k in shard.keys(i) if k != key]
                else:
                    best[i] = max(share, best.get(i, 0.0))
        if last:
            out += [(k, False, share) for i, share in best.items() for k in shard.keys(i)]
            best = {}
        if out:
            yield pd.DataFrame(out, columns=["id", "train", "covered"])


def _blocks(records: DataFrame, train: str) -> DataFrame:
    """The records of all shards, with their blocks."""
    base = records.where("id is not null and question is not null and split is not null").select("id", "question", clean_id("answer_node_qid").alias("answer"), F.array_sort(clean_ids("entity_qids")).alias("entities"), (F.col("split") == train).alias("train")).where("answer is not null").distinct()

    def sized(df: DataFrame, by: list[str]) -> DataFrame:
        n = df.groupBy(*by).agg(F.count_if("train").alias("n_train"), F.count_if(~F.col("train")).alias("n_eval")).where("n_train > 0 and n_eval > 0")
        return n.select(*by, F.ceil(F.col("n_eval") / EVAL_BLOCK).cast("int").alias("eval_blocks"), F.ceil(F.col("n_train") / TRAIN_BLOCK).cast("int").alias("train_blocks"))

    placed = base.join(sized(base, ["answer"]), "answer")
    one = (F.col("eval_blocks") == 1) & (F.col("train_blocks") == 1)
    cols = ["answer", "entity", "side", "train", "id", "question", "entities", "probe"]
    small = placed.where(one).withColumns({"entity": F.lit(""), "side": F.lit("all"), "probe": F.lit(True)}).select(*cols, "eval_blocks", "train_blocks")
    large = placed.where(~one).drop("eval_blocks", "train_blocks")
    each = large.select("answer", "id", "train", "entities", F.explode("entities").alias("entity"))
    rare = each.groupBy("answer", "entity").agg(F.count("*").alias("n"))
    # A record's rarest entity, by the hash where several are equally rare.
    pivot = each.join(rare, ["answer", "entity"]).groupBy("answer", "id", "train", "entities").agg(F.min_by("entity", F.struct("n", F.xxhash64("entity"), "entity")).alias("pivot"))
    held = large.join(pivot, ["answer", "id", "train", "entities"]).withColumn("entity", F.explode("entities"))
    held = held.withColumns({"side": F.lit("all"), "probe": F.col("entity") == F.col("pivot")}).select(*cols)
    # Records without entities are compared with all of their answer node, once as evaluation and once as training texts.
    bare = (F.size("entities") == 0).alias("bare")
    sides = large.withColumn("bare", bare).withColumn("side", F.explode(F.array(F.lit("bare eval"), F.lit("bare train"))))
    # Both sides being bare are met as bare evaluation texts.
    sides = sides.where(F.when(F.col("side") == "bare eval", F.col("train") | F.col("bare")).otherwise(~F.col("train") & ~F.col("bare") | F.col("train") & F.col("bare")))
    sides = sides.withColumns({"entity": F.lit(""), "probe": F.lit(True)}).select(*cols)
    wide = held.unionByName(sides)
    by = ["answer", "entity", "side"]
    placed = small.unionByName(wide.join(sized(wide, by), by).select(*cols, "eval_blocks", "train_blocks"))
    own = F.pmod(F.xxhash64("id", "question"), F.when(F.col("train"), F.col("train_blocks")).otherwise(F.col("eval_blocks"))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.when(F.col("train"), F.col("eval_blocks")).otherwise(F.col("train_blocks")) - 1))
    blocks = placed.select(*cols, own.alias("own"), every.alias("other"))
    blocks = blocks.select(*cols, F.when(F.col("train"), F.col("other")).otherwise(F.col("own")).alias("eval_block"), F.when(F.col("train"), F.col("own")).otherwise(F.col("other")).alias("train_block"))
    return blocks.repartition(*_SHARD).sortWithinPartitions(*_SHARD, "train")


def cross_split_overlaps(records: DataFrame, train: str = "train") -> DataFrame:
    """Rows ``(eval_id, train_id, covered)``: pairs that ask the same, and the share of the evaluation text that the training text covers.

    ``records`` has ``id, question, answer_node_qid, entity_qids, split``; further
    columns are ignored.  A pair has different ids, the same answer node, the entities
    of one among those of the other, and texts that are equal or nearly so after
    folding case, accents, look-alikes and punctuation: shared passages cover
    ``COVER_SHORT`` of the shorter and ``COVER_LONG`` of the longer text.  Null ids, splits, questions and
    answer nodes, and texts without a letter or digit, take part in no pair.  A null or
    empty entity list is a subset of any other; such texts must agree more closely.
    Repeated rows count once.
    """
    found = _blocks(records, train).mapInPandas(_scan_pairs, "eval_id string, train_id string, covered double")
    return found.groupBy("eval_id", "train_id").agg(F.max("covered").alias("covered"))


def overlap_coverage(records: DataFrame, train: str = "train") -> DataFrame:
    """``id, train, covered`` of the records that take part in an overlap; ``covered`` is the largest share of an
    evaluation text that one training text covers, null for training records.  No pairs are made."""
    found = _blocks(records, train).mapInPandas(_scan_members, "id string, train boolean, covered double")
    return found.groupBy("id", "train").agg(F.max("covered").alias("covered"))


def cross_split_pairs(records: DataFrame, train: str = "train") -> DataFrame:
    """The pairs of ``cross_split_overlaps`` as ``(id_a, id_b)``, the smaller id first."""
    found = cross_split_overlaps(records, train)
    return found.select(F.least("eval_id", "train_id").alias("id_a"), F.greatest("eval_id", "train_id").alias("id_b"))


def overlap_report(records: DataFrame, train: str = "train") -> DataFrame:
    """Per split and source: distinct records, how many of them take part in an overlap, and the mean and largest coverage of evaluation records.

    A record counts under each source that delivered it; a null source is a source of its own.
    """
    hit = overlap_coverage(records, train).withColumn("hit", F.lit(1))
    each = records.where("id is not null").select("id", "split", "source", (F.col("split") == train).alias("train")).distinct()
    out = each.join(hit, ["id", "train"], "left").groupBy("split", "source").agg(F.count("*").alias("records"), F.count("hit").alias("overlapping"), F.avg("covered").alias("mean_covered"), F.max("covered").alias("most_covered"))
    return out.withColumn("share", F.col("overlapping") / F.col("records"))

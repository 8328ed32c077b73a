"""Nested records as related flat tables, by Dewey labels.

Every repeated place of a schema (an array, or a map read as a list of entries)
gets one flat table.  A row is labelled with the ordinals on the way to it, joined
by dots: ``2.0.1`` is the second element of the first element of the third element.
Cutting the last ordinal off a label gives the label of the parent row, so parent
links need no identifiers and no join to assign.

The walk is over the schema, on the driver; each table is one chain of generators
over the scan, and Catalyst prunes the nested fields that a table does not use.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Blanks that do not count around an id.
SPACES = " \t\r\n\u00a0"
#: From an element and its entry's key, the value of a carried column.
Pick = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Repeated:
    """One repeated place of a schema.  ``steps`` are the repeated places on the way, itself last."""

    path: str
    kind: str
    element: T.DataType
    steps: tuple[str, ...] = field(default=())


def _simple(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType))


def _scalars(kind: T.DataType, prefix: str = "") -> list[str]:
    """Dotted names of the scalar fields of a struct, through nested structs."""
    found = []
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            if _simple(f.dataType):
                found.append(prefix + f.name)
            elif isinstance(f.dataType, T.StructType):
                found += _scalars(f.dataType, f"{prefix}{f.name}.")
    return found


def repeated_paths(kind: T.DataType, prefix: str = "", steps: tuple[str, ...] = ()) -> list[Repeated]:
    """The repeated places below ``kind``, parents before children.

    A path names struct fields, ``[]`` for an array's elements and ``{}`` for a map's entries.
    """
    out: list[Repeated] = []
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            out += repeated_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name, steps)
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        array = isinstance(kind, T.ArrayType)
        path = prefix + ("[]" if array else "{}")
        inner = kind.elementType if array else kind.valueType
        out.append(Repeated(path, "array" if array else "map", inner, (*steps, path)))
        out += repeated_paths(inner, path, (*steps, path))
    return out


def _field(base: Column, dotted: str) -> Column:
    for part in dotted.split("."):
        base = base.getField(part)
    return base


def dewey_table(df: DataFrame, keys: list[str], column: str, path: str, carry: dict[str, dict[str, Pick]] | None = None) -> DataFrame:
    """The flat table of one repeated ``path`` of ``column``.

    Columns: ``keys``; ``dewey``; ``parent`` (null for a row directly below the record);
    ``ordinal`` (from 0); ``key`` (of a map entry, else null); ``value`` (of a scalar
    element, as a string, else null); and the scalar fields of a struct element.  With
    ``carry`` the columns after ``value`` are those it names instead: for any path on the
    way, or ``path`` itself, a function of the element and the entry's key.

    Null and empty arrays and maps give no rows; null elements give a row with null
    fields, because they hold an ordinal.  Map entries are numbered in stored order.
    Columns of ``df`` that are neither ``keys`` nor ``column`` are not read.
    """
    found = {r.path: r for r in repeated_paths(df.schema[column].dataType, column)}
    if path not in found:
        raise ValueError(f"{path} is no repeated place of {column}; there are {sorted(found)}")
    target = found[path]
    if carry is None:
        carry = {path: {f.replace(".", "_"): (lambda v, k, f=f: _field(v, f)) for f in _scalars(target.element)}}
    ids = [f"__key{i}" for i in range(len(keys))]
    at = df.select(*(F.col(k).alias(i) for k, i in zip(keys, ids)), F.col(column).alias("__v"))
    done, held = column, list(ids)
    for n, step in enumerate(target.steps):
        here = found[step]
        way = step[len(done) :].removesuffix("[]").removesuffix("{}").strip(".")
        names = ["__p", "__v"] if here.kind == "array" else ["__p", "__k", "__v"]
        at = at.select(*held, F.posexplode(_field(F.col("__v"), way) if way else F.col("__v")).alias(*names))
        entry = F.lit(None).cast("string") if here.kind == "array" else F.col("__k").cast("string")
        label = F.col("__p").cast("string") if n == 0 else F.concat_ws(".", "__d", F.col("__p").cast("string"))
        picked = {f"__c_{alias}": pick(F.col("__v"), entry) for alias, pick in carry.get(step, {}).items()}
        held = [*[h for h in held if h != "__d"], "__d", *picked]
        at = at.select(*(c for c in held if c != "__d" and c not in picked), label.alias("__d"), *(c.alias(a) for a, c in picked.items()), F.col("__p").alias("__ord"), entry.alias("__entry"), "__v")
        done = step
    return at.select(
        *(F.col(i).alias(k) for k, i in zip(keys, ids)),
        F.col("__d").alias("dewey"),
        parent_of(F.col("__d")).alias("parent"),
        F.col("__ord").alias("ordinal"),
        F.col("__entry").alias("key"),
        (F.col("__v").cast("string") if _simple(target.element) else F.lit(None).cast("string")).alias("value"),
        *(F.col(h).alias(h.removeprefix("__c_")) for h in held if h.startswith("__c_")),
    )


def dewey_tables(df: DataFrame, keys: list[str], column: str) -> dict[str, DataFrame]:
    """All flat tables of ``column``, by schema path; none is computed until it is used."""
    return {r.path: dewey_table(df, keys, column, r.path) for r in repeated_paths(df.schema[column].dataType, column)}


def parent_of(label: Column) -> Column:
    """The parent's label: the label without its last ordinal; null at the top."""
    cut = F.length(label) - F.instr(F.reverse(label), ".")
    return F.when(F.instr(label, ".") > 0, F.substr(label, F.lit(1), cut.cast("int")))


#: Members of a node as JSON text may hold them: each property value a string, a list, an empty string or null.
_LOOSE_NODE = "qid string, label string, description string, instance_of string, subclass_of string, props map<string,string>, extra_props map<string,string>"


def _loose_list(raw: Column) -> Column:
    """A list from JSON text that is a list or one string; null stays null."""
    return F.when(F.ltrim(raw).startswith("["), F.coalesce(F.from_json(raw, "array<string>"), F.array(raw))).when(raw.isNotNull(), F.array(raw))


def parse_subgraphs(df: DataFrame, body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """Subgraphs that exist as JSON text, in the typed form: ``id``, ``nodes`` plus the columns of ``keep``.

    ``nodes`` may be a list, or an object keyed by qid whose values have no qid.
    Bodies that are not valid JSON objects are left out; absent, null and unknown
    members are allowed.
    """
    loose = F.from_json(F.col(body), "id string, matched_ontologies string, nodes string, edges string, __bad string", {"columnNameOfCorruptRecord": "__bad"})
    # A generator keeps the optimiser from parsing once for each later use.
    at = df.select(*(keep or []), F.explode(F.array(loose)).alias("__b")).where("__b is not null and __b.__bad is null")
    raw = F.col("__b.nodes")
    listed = F.from_json(raw, f"array<struct<{_LOOSE_NODE}>>")
    keyed = F.transform(
        F.map_entries(F.from_json(raw, f"map<string,struct<{_LOOSE_NODE}>>")),
        lambda e: F.struct(F.coalesce(e["value"]["qid"], e["key"]).alias("qid"), *(e["value"][c].alias(c) for c in ("label", "description", "instance_of", "subclass_of", "props", "extra_props"))),
    )
    nodes = F.when(F.ltrim(raw).startswith("{"), keyed).when(F.ltrim(raw).startswith("["), listed)
    at = at.select(*(keep or []), F.col("__b.id").alias("id"), F.explode(F.array(nodes)).alias("__n"))
    typed = F.transform(
        "__n",
        lambda n: F.struct(
            n["qid"].alias("qid"),
            n["label"].alias("label"),
            n["description"].alias("description"),
            _loose_list(n["instance_of"]).alias("instance_of"),
            _loose_list(n["subclass_of"]).alias("subclass_of"),
            F.transform_values(n["props"], lambda k, v: _loose_list(v)).alias("props"),
            F.transform_values(n["extra_props"], lambda k, v: _loose_list(v)).alias("extra_props"),
        ),
    )
    return at.select(*(keep or []), "id", F.explode(F.array(typed)).alias("nodes"))


def content_key(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``df`` with ``__h1`` and ``__h2``, two 64-bit hashes of ``keys`` and of the content of ``column``.

    They name a row where its keys do not: rows that share them are repeats of each other.
    """

    def plain(c: Column, kind: T.DataType) -> Column:
        # Maps cannot be hashed, their lists of entries can.
        if isinstance(kind, T.MapType):
            return F.transform(F.map_entries(c), lambda e: F.struct(e["key"], plain(e["value"], kind.valueType)))
        if isinstance(kind, T.ArrayType):
            return c if _simple(kind.elementType) else F.transform(c, lambda e: plain(e, kind.elementType))
        if isinstance(kind, T.StructType):
            return F.struct(*(plain(c[f.name], f.dataType).alias(f.name) for f in kind.fields))
        return c

    whole = plain(F.col(column), df.schema[column].dataType)
    return df.withColumns({"__h1": F.xxhash64(*keys, whole), "__h2": F.xxhash64(F.lit("second"), *keys, whole)})


def _labelled(df: DataFrame, column: str, path: str, carry: dict[str, dict[str, Pick]] | None = None) -> DataFrame:
    return dewey_table(df, ["__h1", "__h2", "id"], column, path, carry)


def _extra_links(graphs: DataFrame) -> DataFrame:
    """``id, source_qid, pid, target_qid`` from the tables of nodes, entries and values, related by truncated labels."""
    nodes_of = F.transform("nodes", lambda n: F.struct(n["qid"].alias("qid"), n["extra_props"].alias("extra_props")))
    keyed = content_key(graphs.where("id is not null").select("id", nodes_of.alias("nodes")), ["id"], "nodes")
    row = ["__h1", "__h2"]
    cut = lambda c: F.btrim(c, F.lit(SPACES))
    # Every table is made distinct where its join needs it anyway, so rows that repeat do not multiply.
    values = _labelled(keyed, "nodes", "nodes[].extra_props{}[]").withColumn("value", cut("value")).where("value <> ''")
    values = values.groupBy(*row, F.col("parent").alias("entry")).agg(F.first("id").alias("id"), F.collect_set("value").alias("targets"))
    entries = _labelled(keyed, "nodes", "nodes[].extra_props{}").withColumn("pid", cut("key")).where("pid <> ''")
    entries = entries.groupBy(*row, F.col("dewey").alias("entry")).agg(F.first("pid").alias("pid"))
    nodes = _labelled(keyed, "nodes", "nodes[]", {"nodes[]": {"qid": lambda v, k: v["qid"]}}).withColumn("qid", cut("qid")).where("qid <> ''")
    nodes = nodes.groupBy(*row, F.col("dewey").alias("node")).agg(F.first("qid").alias("qid"))
    found = values.join(entries, [*row, "entry"]).withColumn("node", parent_of(F.col("entry"))).join(nodes, [*row, "node"])
    return found.select("id", F.col("qid").alias("source_qid"), "pid", F.explode("targets").alias("target_qid"))


def _path_links(records: DataFrame) -> DataFrame:
    """``id, source_qid, pid, target_qid`` from the table of the parts of triples, grouped by the triple's label."""
    keyed = content_key(records.where("id is not null").select("id", "supporting_paths"), ["id"], "supporting_paths")
    parts = _labelled(keyed, "supporting_paths", "supporting_paths[].triples[][]").where("ordinal < 3").withColumn("value", F.btrim("value", F.lit(SPACES)))
    names = ["source_qid", "pid", "target_qid"]
    triples = parts.groupBy("__h1", "__h2", "parent").agg(F.first("id").alias("id"), *(F.max(F.when(F.col("ordinal") == i, F.col("value"))).alias(c) for i, c in enumerate(names)))
    return triples.where(" and ".join(f"{c} <> ''" for c in names)).select("id", *names)


def nested_links(subgraph: DataFrame, raw_subgraph: DataFrame, split_record: DataFrame) -> DataFrame:
    """Rows ``(link_kind, id, source_qid, pid, target_qid)``, distinct.

    ``extra``: each non-blank value of ``nodes.extra_props``, of typed and of parsed
    subgraphs, with the node's qid and the property.  ``path``: each triple of
    ``supporting_paths`` whose three parts are present.  Blanks around ids are cut; a
    row with a blank or null part, or without an id, is no link.  Children find their
    parents by their labels, cut by an ordinal, within rows that their content names.
    """
    typed = subgraph.select("id", "nodes")
    loose = parse_subgraphs(raw_subgraph).select("id", "nodes")
    kinds = [("extra", _extra_links(typed)), ("extra", _extra_links(loose)), ("path", _path_links(split_record))]
    cut = [t.select(F.lit(kind).alias("link_kind"), "id", "source_qid", "pid", "target_qid") for kind, t in kinds]
    return cut[0].unionByName(cut[1]).unionByName(cut[2]).distinct()

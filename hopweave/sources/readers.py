"""Scans with explicit schemas: JSON lines, JSON arrays, keyed documents, ontologies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The tables of the project as they lie in JSON files.
SCHEMAS = {
    "raw_question": "_id string, question string, answer string, type string, level string, context string, supporting_facts array<array<string>>",
    "node": "qid string, label string, description string, instance_of array<string>, subclass_of array<string>, props map<string,array<string>>, extra_props map<string,array<string>>",
    "edge": "source string, target string, type string",
    "ontology": "title string, id string, concepts array<struct<qid:string,label:string>>, relations array<struct<pid:string,label:string,domain:string,range:string>>, concepts_to_extend array<struct<qid:string,label:string,follow_pids:array<string>>>",
    "prediction": "id string, pred_answer string, pred_qid string, mode string, difficulty string, reasoning_type string",
}
SCHEMAS["subgraph"] = "id string, matched_ontologies array<string>, nodes array<struct<qid:string,label:string,description:string,instance_of:array<string>,subclass_of:array<string>,props:map<string,array<string>>,extra_props:map<string,array<string>>>>, edges array<struct<source:string,target:string,type:string>>"


def json_lines(spark: SparkSession, path: str, schema: str, mode: str = "PERMISSIVE") -> DataFrame:
    """One record a line; blank lines are skipped. ``mode``: DROPMALFORMED leaves bad lines out, FAILFAST stops at them."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One array of records per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def keyed_documents(spark: SparkSession, path: str, schema: str, fallback: str | None = None, key: str = "id", lines: bool = False) -> DataFrame:
    """JSON documents below ``path``, one per file or, as the keyed sink writes them, one per line; keys that are missing there come from ``fallback``."""
    scan = lambda p: spark.read.schema(schema).option("multiLine", not lines).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(p)
    found = scan(path)
    if fallback is None:
        return found
    return found.unionByName(scan(fallback).join(found.select(key), key, "left_anti"))


def named_files(spark: SparkSession, texts: DataFrame, name: str, value: str, path: str) -> None:
    """Write each row of a small table of configuration texts (at most 10,000 rows) to the file ``name``.json below ``path``."""
    rows = texts.select(name, value).limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("too many texts for one file each")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for r in rows:
        at = jvm.org.apache.hadoop.fs.Path(f"{path}/{r[0]}.json")
        out = at.getFileSystem(conf).create(at, True)
        try:
            out.write(bytearray(r[1].encode("utf-8")))
        finally:
            out.close()


def ontologies(spark: SparkSession, path: str) -> DataFrame:
    """Ontology files with ``ont_pos``, their place in name order from 0; a file without an id bears its name.

    A range may be a list, one string or empty; it comes out as a list.
    """
    raw = spark.read.schema(SCHEMAS["ontology"]).option("multiLine", True).json(path).withColumn("file", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))
    listed = lambda r: F.when(F.ltrim(r).startswith("["), F.from_json(r, "array<string>")).when(F.coalesce(r, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(r))
    relations = F.transform("relations", lambda x: F.struct(x["pid"].alias("pid"), x["label"].alias("label"), x["domain"].alias("domain"), listed(x["range"]).alias("range")))
    # A window without partitions: its rows are the few files of a configuration.
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("file")) - 1
    return raw.withColumns({"id": F.coalesce("id", "file"), "relations": relations}).withColumn("ont_pos", place)


def linked_questions(raw: DataFrame) -> DataFrame:
    """Raw questions with ``id``, ``reasoning_type`` and typed supporting facts."""
    facts = F.transform("supporting_facts", lambda f: F.struct(F.get(f, F.lit(0)).alias("title"), F.get(f, F.lit(1)).cast("int").alias("sentence_idx")))
    return raw.withColumns({"id": F.col("_id"), "reasoning_type": F.col("type"), "entities": facts})


def best_label(labels: Column) -> Column:
    """Of a map of languages to labels: English, else ``mul``, else any with its language behind it."""
    first = F.element_at(F.array_sort(F.map_entries(labels)), 1)
    return F.coalesce(F.element_at(labels, "en"), F.element_at(labels, "mul"), F.concat(first["value"], F.lit(" ["), first["key"], F.lit("]")))

"""Problem 3: one consistent form for text that looks the same.

Method: texts are exploded to positioned code points; a broadcast join maps width,
font, blank, hyphen and invisible forms and gives look-alike letters and canonical
decompositions; combining marks are ordered by class behind their base, recomposed
by a second broadcast join, and the text is rebuilt in order.

Only distinct texts that hold a character which might change are exploded; every
other text is its own consistent form.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .fold import HANGUL, LEADS, SCRIPTS, TRAILS, VOWELS, compositions, joiners, letters, pairs, stand_ins

#: Texts without any other character than these are in the consistent form already.
_ORDINARY = "\\x00-\\x7f¡-¬®-ʯ–—‘’‚“”„…‹›€™、。「」『』ぁ-ヿ一-鿿"
#: Rows of the two mapping tables are bounded by the Unicode database; both are broadcast.
MAX_MAPPING_ROWS = 8192


def _special_latin() -> str:
    """Characters of the ordinary ranges that the mapping changes nevertheless."""
    changed = {*stand_ins(), *letters()}
    return "".join(c for c in map(chr, range(0xA0, 0x2B0)) if c in changed)


def mapping_table(spark: SparkSession) -> DataFrame:
    """``ch, kind, to, mark_class, script, latin``: what a character stands for.

    ``to`` is canonically decomposed. ``script`` and ``latin`` are set for letters only:
    the script for which a letter speaks, and the Latin letter that it looks like.
    """
    rows: dict[str, list] = {}
    for c, (kind, to) in stand_ins().items():
        rows[c] = [kind, unicodedata.normalize("NFD", to), None, None]
    for nfd, c in compositions().items():
        rows.setdefault(c, ["composed", nfd, None, None])
    for c, (script, latin) in letters().items():
        rows[c] = ["letter", c, script, latin]
    found = [(c, kind, to, script, latin) for c, (kind, to, script, latin) in rows.items()]
    assert len(found) <= MAX_MAPPING_ROWS
    return spark.createDataFrame(found, "ch string, kind string, to string, script string, latin string")


def mark_table(spark: SparkSession) -> DataFrame:
    """``mark, mark_class``: combining marks with their canonical class; 0 for what composes with a base right before it."""
    found = [(chr(i), unicodedata.combining(chr(i))) for i in range(0x300, 0x20000) if unicodedata.combining(chr(i))] + [(c, 0) for c in joiners()]
    assert len(found) <= MAX_MAPPING_ROWS
    return spark.createDataFrame(found, "mark string, mark_class int")


def composition_table(spark: SparkSession) -> DataFrame:
    """``apart, whole``: a base with ordered marks, and the one character for it."""
    found = list(compositions().items())
    assert len(found) <= MAX_MAPPING_ROWS
    return spark.createDataFrame(found, "apart string, whole string")


def _composite(a: Column, b: Column) -> Column:
    """The character that two compose to, or null."""
    code, lead, vowel, trail = F.ascii(a), F.ascii(b) - HANGUL["vowel"], F.ascii(b) - HANGUL["trail"], F.ascii(a) - HANGUL["lead"]
    syllable = code - HANGUL["syllable"]
    chars = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")
    first = trail.between(0, LEADS - 1) & lead.between(0, VOWELS - 1)
    last = syllable.between(0, LEADS * VOWELS * TRAILS - 1) & (syllable % TRAILS == 0) & vowel.between(1, TRAILS - 1)
    listed = F.element_at(F.create_map(*(F.lit(x) for kv in pairs().items() for x in kv)), F.concat(a, b))
    return F.when(first, chars(HANGUL["syllable"] + (trail * VOWELS + lead) * TRAILS)).when(last, chars(code + vowel)).otherwise(listed)


def composed(parts: Column) -> Column:
    """Canonical composition of an array of ``(k, pos, sub, c)``, a base with its marks in canonical order.

    A mark joins the base unless one before it of no smaller class stayed apart.
    """
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("base"), F.lit("").alias("tail"), F.lit(0).alias("last"))

    def step(s: Column, x: Column) -> Column:
        both = F.when((s["base"] != "") & ((s["tail"] == "") | (s["last"] < x["k"])), _composite(s["base"], x["c"]))
        apart = (s["base"] == "") | ((x["k"] == 0) & both.isNull())
        return F.struct(
            F.when(both.isNull() & apart, F.concat(s["done"], s["base"], s["tail"])).otherwise(s["done"]).alias("done"),
            F.when(both.isNotNull(), both).when(apart, x["c"]).otherwise(s["base"]).alias("base"),
            F.when(both.isNotNull(), s["tail"]).when(apart, F.lit("")).otherwise(F.concat(s["tail"], x["c"])).alias("tail"),
            F.when(both.isNotNull(), s["last"]).when(apart, F.lit(0)).otherwise(x["k"]).alias("last"),
        )

    return F.aggregate(parts, start, step, lambda s: F.concat(s["done"], s["base"], s["tail"]))


def _chars(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit("(?s)."), F.lit(0))


def consistent_forms(texts: DataFrame, text: str) -> DataFrame:
    """Distinct ``(text, form, stands_in)`` of the texts that may change: the consistent
    form, and whether some character was invisible or stood in for an ordinary one.

    Texts that are not in the result are their own form.  Null and empty texts are not
    in it.  Letters count as stand-ins only within words of another script, or as words
    of one letter among words of Latin: text written throughout in one script stays.
    """
    spark = texts.sparkSession
    suspects = texts.select(F.col(text).alias("text")).where(F.col("text").rlike(f"[^{_ORDINARY}]|[{_special_latin()}]")).distinct()
    # Two 64-bit hashes name a text; the text itself would be repeated for each of its characters.
    key = ["h1", "h2"]
    keyed = suspects.select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"), "text")
    cps = keyed.select(*key, F.posexplode(_chars(F.col("text"))).alias("pos", "ch"))
    mapped = cps.join(F.broadcast(mapping_table(spark)), "ch", "left")

    ch = F.col("ch")
    is_letter = ch.rlike("\\p{L}|\\p{M}")
    latin = ch.rlike("\\p{IsLatin}") & F.col("script").isNull() | F.coalesce(F.col("to"), ch).rlike("^\\p{IsLatin}") & (F.coalesce(F.col("kind"), F.lit("")) != "letter")
    own_script = F.when(latin, F.lit("latin"))
    for name, block in SCRIPTS.items():
        own_script = own_script.when(ch.rlike(f"\\p{{Is{block}}}"), F.lit(name))
    facts = mapped.withColumns(
        {
            "gap": (~(is_letter | (F.coalesce(F.col("kind"), F.lit("")) == "invisible") | F.coalesce(F.col("to"), ch).rlike("^\\p{L}"))).cast("int"),
            "own": F.coalesce(F.col("script"), own_script),
        }
    )
    by_text = Window.partitionBy(*key).orderBy("pos")
    worded = facts.withColumn("word", F.sum("gap").over(by_text))
    in_word = Window.partitionBy(*key, "word")
    in_text = Window.partitionBy(*key)
    foreign = F.col("own").isin(*SCRIPTS) & F.col("latin").isNull()
    judged = worded.withColumns(
        {
            "word_latin": F.max(F.col("own") == "latin").over(in_word),
            "word_foreign": F.max(foreign).over(in_word),
            "word_letters": F.count(F.col("own")).over(in_word),
        }
    ).withColumns(
        {
            "text_latin": F.max(F.col("own") == "latin").over(in_text),
            "text_foreign": F.max(foreign).over(in_text),
        }
    )
    false = F.lit(False)
    swapped = F.col("latin").isNotNull() & ~F.coalesce("word_foreign", false) & (F.coalesce("word_latin", false) | (F.coalesce("text_latin", false) & ~F.coalesce("text_foreign", false) & (F.col("word_letters") > 0)))
    plain = judged.select(
        *key,
        "pos",
        "ch",
        F.when(swapped, F.col("latin")).otherwise(F.coalesce("to", "ch")).alias("to"),
        (swapped | F.col("kind").isin("invisible", "blank", "hyphen", "width", "font", "ligature", "canonical")).alias("stand_in"),
    )
    parts = plain.select(*key, "pos", "ch", "stand_in", F.posexplode_outer(_chars(F.col("to"))).alias("sub", "c")).join(F.broadcast(mark_table(spark)), F.col("c") == F.col("mark"), "left")
    by_part = Window.partitionBy(*key).orderBy("pos", "sub")
    # What composes without being a mark does so only right behind a base or another such character.
    parts = parts.where("c is not null or sub is null").withColumn("before", F.lag(F.coalesce("mark_class", F.lit(0))).over(by_part))
    begins = F.col("c").isNotNull() & (F.col("mark_class").isNull() | ((F.col("mark_class") == 0) & (F.coalesce("before", F.lit(1)) != 0)))
    clusters = parts.withColumn("cluster", F.sum(begins.cast("int")).over(by_part))
    found = F.when(F.col("c").isNotNull(), F.struct(F.coalesce("mark_class", F.lit(0)).alias("k"), "pos", "sub", "c"))
    built = clusters.groupBy(*key, "cluster").agg(F.array_sort(F.collect_list(found)).alias("parts"), F.coalesce(F.max("stand_in"), F.lit(False)).alias("stand_in"), F.array_sort(F.collect_set(F.when(F.col("c").isNotNull(), F.struct("pos", F.col("ch").alias("c"))))).alias("written"))
    together = lambda col: F.array_join(F.transform(col, lambda x: x["c"]), "")
    built = built.withColumns({"apart": together("parts"), "was": together("written")})
    whole = built.join(F.broadcast(composition_table(spark)), "apart", "left")
    # Most clusters are one character or compose as a whole; only others go through the marks one by one.
    joined = F.when(F.size("parts") < 2, F.col("apart")).otherwise(F.coalesce("whole", composed(F.col("parts"))))
    moved = (F.size("written") > 1) & (joined != F.col("was"))
    rebuilt = (
        whole.select(*key, "cluster", joined.alias("s"), (F.col("stand_in") | moved).alias("stand_in"))
        .groupBy(*key)
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cluster", "s"))), lambda x: x["s"]), "").alias("form"), F.max("stand_in").alias("stands_in"))
    )
    return keyed.join(rebuilt, key).select("text", "form", "stands_in")


def canonical_text(df: DataFrame, text: str, form: str = "form", flag: str = "stands_in") -> DataFrame:
    """``df`` with the consistent form of column ``text`` and whether any character stood in for another.

    Null stays null with a false flag. Rows are kept as they are, repeated ones included.
    """
    forms = consistent_forms(df, text).select(F.col("text").alias("__text"), F.col("form").alias("__form"), F.col("stands_in").alias("__flag"))
    return df.join(forms, df[text] == F.col("__text"), "left").withColumns({form: F.coalesce("__form", text), flag: F.coalesce("__flag", F.lit(False))}).drop("__text", "__form", "__flag")


def field_values(split_record: DataFrame, graph_node: DataFrame, prediction: DataFrame) -> DataFrame:
    """Distinct ``(field_name, row_key, value)`` of the fields whose text must be consistent."""
    values = [
        split_record.select(F.lit("answer").alias("field_name"), F.col("id").alias("row_key"), F.col("answer").alias("value")),
        graph_node.select(F.lit("label").alias("field_name"), F.col("qid").alias("row_key"), F.col("label").alias("value")),
    ]
    one = values[0].unionByName(values[1]).where("value is not null and row_key is not null").distinct()
    return one.unionByName(prediction.select(F.lit("pred_answer").alias("field_name"), F.col("pred_id").cast("string").alias("row_key"), F.col("pred_answer").alias("value")).where("value is not null and row_key is not null"))


def found_values(split_record: DataFrame, graph_node: DataFrame, prediction: DataFrame) -> DataFrame:
    """Distinct ``(field_name, row_key)`` of the values with a character that stands in for another."""
    values = field_values(split_record, graph_node, prediction)
    return values.join(consistent_forms(values, "value").where("stands_in"), F.col("value") == F.col("text")).select("field_name", "row_key").distinct()

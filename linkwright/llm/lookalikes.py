"""Visually identical text: bring every string to one consistent form.

Texts that hold only printable ASCII are in that form already and never leave the scan. Every other distinct text is
exploded to positioned code points, joined with the broadcast decomposition and look-alike tables (bounded by Unicode),
its combining marks are put in canonical class order, base letters and marks are recomposed through a broadcast
composition table, and the string is rebuilt with one shuffle on the text's digest.

Null stays null, an empty text stays empty, repeated texts are processed once, and very long texts only lengthen the
array of their own row.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkwright.llm import confusables as C

#: A text with any other character is looked at closely.
NOT_PLAIN = r"[^\x20-\x7E]"
#: Runs of letters, marks and characters without ink, or runs of anything else.
UNITS = r"[\p{L}\p{M}\p{Cf}\x{115F}\x{1160}\x{3164}]+|[^\p{L}\p{M}\p{Cf}\x{115F}\x{1160}\x{3164}]+"


@lru_cache(maxsize=1)
def _pairs() -> list[tuple[str, str]]:
    """Letter and mark that compose to one letter."""
    out = []
    for code in range(0xC0, 0x20000):
        char = chr(code)
        parts = unicodedata.decomposition(char).split(" ")
        if len(parts) == 2 and not parts[0].startswith("<"):
            pair = "".join(chr(int(x, 16)) for x in parts)
            if unicodedata.normalize("NFC", pair) == char:
                out.append((pair, char))
    return out


@lru_cache(maxsize=1)
def _compositions() -> list[tuple[str, str]]:
    """Full canonical decompositions of every letter that recomposes."""
    out = []
    for code in range(0xC0, 0x20000):
        char = chr(code)
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4:
            continue
        parts = unicodedata.normalize("NFD", char)
        if len(parts) > 1 and unicodedata.normalize("NFC", parts) == char:
            out.append((parts, char))
    return out


def _mapping_frame(spark: SparkSession) -> DataFrame:
    back = C.reverse_lookalikes()
    rows = {c: (c, t, latin, None, None, x) for c, t, latin, x in C.mapping()}
    for script, at in (("CYRILLIC", 3), ("GREEK", 4)):
        for latin, char in back[script].items():
            row = list(rows.get(latin, (latin, latin, latin, None, None, False)))
            row[at] = char
            rows[latin] = tuple(row)
    # one row per code point of each target, so that marks keep their own class
    out = []
    for c, target, latin, cyrillic, greek, excluded in rows.values():
        classes = [unicodedata.combining(x) for x in target]
        out.append((c, list(target), classes, latin, cyrillic, greek, excluded))
    schema = "ch string, target array<string>, classes array<int>, latin string, cyrillic string, greek string, excluded boolean"
    return spark.createDataFrame(pd.DataFrame(out, columns=[x.split(" ")[0] for x in schema.split(", ")]), schema)


def _marks_frame(spark: SparkSession) -> DataFrame:
    rows = [(chr(c), unicodedata.combining(chr(c))) for c in range(0x300, 0x1E950) if unicodedata.combining(chr(c))]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["ch", "own_class"]), "ch string, own_class int")


def _joined(items: Column) -> Column:
    return F.array_join(items, "")


def folded_texts(texts: DataFrame, column: str = "text") -> DataFrame:
    """Distinct texts that hold a character outside printable ASCII, with their consistent form.

    Columns: ``text``, ``folded`` and ``kept`` (the text with only those letters rewritten that Unicode never
    recomposes). ``folded <> kept`` tells texts that were not in the consistent form.
    """
    spark = texts.sparkSession
    source = texts.select(F.col(column).alias("text")).where(F.col("text").rlike(NOT_PLAIN)).distinct()
    units = source.select(
        F.unhex(F.md5("text")).alias("tid"), F.posexplode(F.regexp_extract_all("text", F.lit(f"({UNITS})"), 1)).alias("unit_pos", "unit")
    )
    latin = F.col("unit").rlike(r"\p{IsLatin}")
    foreign = F.col("unit").rlike(r"[\p{L}&&[^\p{IsLatin}\p{Lm}]]")
    mode = (
        F.when(~(latin & foreign), "own")
        .when(F.col("unit").rlike(rf"^[\p{{IsLatin}}\p{{M}}\p{{Cf}}\p{{Lm}}\x{{115F}}\x{{1160}}\x{{3164}}{C.LOOKALIKE_CLASS}]+$"), "latin")
        .when(F.col("unit").rlike(r"\p{IsCyrillic}"), "cyrillic")
        .when(F.col("unit").rlike(r"\p{IsGreek}"), "greek")
        .otherwise("own")
    )
    chars = units.select("tid", "unit_pos", mode.alias("mode"), F.posexplode(F.split("unit", "")).alias("pos", "ch"))
    table, marks = F.broadcast(_mapping_frame(spark)), F.broadcast(_marks_frame(spark))
    mapped = chars.join(table, "ch", "left").join(marks, "ch", "left")
    alone = F.array(F.struct(F.col("ch").alias("c"), F.coalesce("own_class", F.lit(0)).alias("k")))
    swapped = (
        F.when(F.col("mode") == "latin", F.col("latin"))
        .when(F.col("mode") == "cyrillic", F.col("cyrillic"))
        .when(F.col("mode") == "greek", F.col("greek"))
    )
    several = F.transform(
        F.arrays_zip("target", "classes"), lambda x: F.struct(x["target"].alias("c"), x["classes"].alias("k"))
    )
    # a swap replaces the letter itself; decomposed accents of the letter stay with it
    plain_target = F.size("target") <= 1
    pieces = (
        F.when(swapped.isNotNull() & (swapped != "") & (F.col("target").isNull() | plain_target), F.array(F.struct(swapped.alias("c"), F.lit(0).alias("k"))))
        .when(F.col("target").isNotNull(), several)
        .otherwise(alone)
    )
    kept = F.when(F.col("excluded"), _joined(F.col("target"))).otherwise(F.col("ch"))
    place = ["unit_pos", "pos", "sub"]
    letters = mapped.select("tid", "unit_pos", "pos", kept.alias("kept"), F.posexplode_outer(pieces).alias("sub", "piece")).select(
        "tid",
        *place,
        F.when(F.coalesce("sub", F.lit(0)) == 0, F.col("kept")).otherwise("").alias("kept"),
        F.coalesce("piece.c", F.lit("")).alias("c"),
        F.coalesce("piece.k", F.lit(0)).alias("k"),
    )
    # window, segments and texts all cluster on the digest: one shuffle serves the three
    running = Window.partitionBy("tid").orderBy(*place).rowsBetween(Window.unboundedPreceding, 0)
    numbered = letters.withColumn("segment", F.sum(F.when((F.col("k") == 0) & (F.col("c") != ""), 1).otherwise(0)).over(running))
    segments = numbered.groupBy("tid", "segment").agg(
        F.array_sort(F.collect_list(F.struct("k", *place, "c"))).alias("parts"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*place, "kept"))), lambda x: x["kept"]), "").alias("kept"),
    )
    segments = segments.withColumn("parts", F.filter("parts", lambda x: x["c"] != ""))
    sequence = _joined(F.transform("parts", lambda x: x["c"]))
    composed = spark.createDataFrame(pd.DataFrame(_compositions(), columns=["sequence", "composed"]), "sequence string, composed string")
    segments = segments.withColumn("sequence", sequence).join(F.broadcast(composed), "sequence", "left")
    segments = segments.select(
        "tid", F.struct("segment", F.coalesce("composed", _compose(F.col("parts"))).alias("text"), "kept").alias("item")
    )
    rebuilt = segments.groupBy("tid").agg(F.array_sort(F.collect_list("item")).alias("items"))
    rebuilt = rebuilt.select(
        "tid",
        _joined(F.transform("items", lambda x: x["text"])).alias("folded"),
        _joined(F.transform("items", lambda x: x["kept"])).alias("kept"),
    )
    return source.withColumn("tid", F.unhex(F.md5("text"))).join(rebuilt, "tid").select("text", "folded", "kept")


def _compose(parts: Column) -> Column:
    """A starter with marks in class order; each mark that is not blocked joins the starter where Unicode has the pair."""
    pairs = F.create_map(*[F.lit(x) for pair in _pairs() for x in pair])
    start = F.struct(F.coalesce(F.try_element_at(parts, F.lit(1))["c"], F.lit("")).alias("base"), F.lit("").alias("rest"), F.lit(0).alias("last"))

    def step(acc: Column, part: Column) -> Column:
        joined = F.when((acc["rest"] == "") | (acc["last"] < part["k"]), F.try_element_at(pairs, F.concat(acc["base"], part["c"])))
        return F.when(joined.isNotNull(), F.struct(joined.alias("base"), acc["rest"].alias("rest"), acc["last"].alias("last"))).otherwise(
            F.struct(acc["base"].alias("base"), F.concat(acc["rest"], part["c"]).alias("rest"), part["k"].alias("last"))
        )

    done = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), start, step, lambda acc: F.concat(acc["base"], acc["rest"]))
    return F.when(F.size(parts) <= 1, start["base"]).otherwise(done)


def fold_columns(frame: DataFrame, columns: list[str], suffix: str = "_folded") -> DataFrame:
    """The frame with a consistent form of each named column added as ``<column><suffix>``.

    Rows, order-free, are kept as they are; a clash with an existing column of that name raises ``ValueError``.
    """
    out = frame
    for name in columns:
        if name + suffix in frame.columns:
            raise ValueError(f"column {name + suffix} exists already")
        table = folded_texts(frame.select(F.col(name).alias("text"))).select(F.col("text").alias("__key"), F.col("folded").alias("__folded"))
        # rows in printable ASCII carry a null key, so they never meet a partner and are not moved onto one key
        keyed = out.withColumn("__probe", F.when(F.col(name).rlike(NOT_PLAIN), F.col(name)))
        plain = keyed.where(F.col("__probe").isNull()).withColumn(name + suffix, F.col(name)).drop("__probe")
        odd = keyed.where(F.col("__probe").isNotNull()).join(table, F.col("__probe") == F.col("__key"), "left")
        odd = odd.withColumn(name + suffix, F.coalesce("__folded", F.col(name))).drop("__probe", "__key", "__folded")
        out = plain.unionByName(odd)
    return out


def records_not_consistent(frame: DataFrame, key: str, column: str) -> DataFrame:
    """Distinct keys of the rows whose text is not in the consistent form."""
    odd = frame.select(key, F.col(column).alias("text")).where(F.col("text").rlike(NOT_PLAIN))
    changed = folded_texts(odd).where(F.col("folded") != F.col("kept")).select("text")
    return odd.join(changed, "text", "left_semi").select(key).distinct()

"""Several values packed in one field: one row per value with its position.

Dictionary-guided segmentation. A multi-pattern automaton finds known whole values in the field, and dynamic
programming picks the cheapest cover of the field by known values, quoted or escaped text, delimiters, wrappers and
free text. Delimiters inside a quoted, escaped or known value belong to that value.

The dictionary may be of any size: it is never broadcast. Its values meet the fields that hold them by an equi join on
the rarest two neighbouring words of each value, whatever delimiters stand inside, and each Arrow batch builds one
automaton from the values known to occur in its own rows.

Defined results: null, empty and blank fields and placeholders give no value; an empty place is no value; a repeated
value keeps every position; input columns other than the key and the field are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that separate values, and the words that do.
DELIMITERS = ",;|/:·•、，；｜&+\t\n\r "
DELIMITER_WORDS = ("and", "or", "und", "et", "y")
# Quotes with the quote that closes them, and wrappers.
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "«": "»", "`": "`"}
WRAPPERS = "()[]{}<>"
# Texts that stand for an empty field.
PLACEHOLDERS = frozenset({"none", "null", "nan", "n/a", "na", "-", "--", "[]", "{}", "()", "?"})

_WORD_DELIMITER = re.compile(rf"(?<=[\s\"')\]])(?:{'|'.join(DELIMITER_WORDS)})(?=[\s\"'(\[])")
_DELIMITER_RUN = re.compile(f"[{re.escape(DELIMITERS)}]+")
_HARD = frozenset(DELIMITERS) - {" "}

# Costs of the cover. A known value is free; the rest is ordered so that a quoted text beats free text, and free text
# is cut only at delimiters.
_COST_DELIMITER, _COST_WRAPPER, _COST_QUOTED, _COST_FREE, _COST_CHAR = 0.01, 0.02, 0.5, 2.0, 0.01
_MAX_DEPTH = 4


def _quoted(text: str, start: int) -> tuple[str, int] | None:
    """Content and end of the quoted text that opens at ``start``; a doubled or escaped quote stays in the content."""
    closing, out, i = QUOTES[text[start]], [], start + 1
    while i < len(text):
        char = text[i]
        if char == "\\" and i + 1 < len(text):
            out.append(text[i + 1])
            i += 2
        elif char == closing:
            if text[i + 1 : i + 2] == closing and closing == '"':
                out.append(closing)
                i += 2
            elif closing == "'" and text[i + 1 : i + 2].isalnum():  # an apostrophe
                out.append(char)
                i += 1
            else:
                return "".join(out), i + 1
        else:
            out.append(char)
            i += 1
    return None


def _free_end(text: str, start: int) -> tuple[str, int]:
    """Free text from ``start`` up to the next delimiter that is neither a blank nor escaped."""
    out, i = [], start
    while i < len(text):
        if text[i] == "\\" and i + 1 < len(text):
            out.append(text[i + 1])
            i += 2
            continue
        if text[i] in _HARD:
            break
        out.append(text[i])
        i += 1
    return "".join(out), i


def segment(text: str, automaton, depth: int = 0) -> list[str]:
    """The values of one field, left to right. ``automaton`` finds known whole values; None where there are none."""
    body = text.strip()
    if not body or body.lower() in PLACEHOLDERS:
        return []
    n = len(text)
    known: dict[int, list[int]] = {}
    if automaton is not None:
        for last, value in automaton.iter(text):
            first, end = last - len(value) + 1, last + 1
            if (first == 0 or not text[first - 1].isalnum()) and (end == n or not text[end].isalnum()):
                known.setdefault(first, []).append(end)
    words = {m.start(): m.end() for m in _WORD_DELIMITER.finditer(text)}
    best: list[tuple[float, int, list[str] | None]] = [(float("inf"), -1, None)] * (n + 1)
    best[0] = (0.0, -1, None)

    def offer(i: int, end: int, cost: float, values: list[str]) -> None:
        if best[i][0] + cost < best[end][0]:
            best[end] = (best[i][0] + cost, i, values)

    for i in range(n):
        if best[i][0] == float("inf"):
            continue
        for end in known.get(i, ()):
            offer(i, end, 0.0, [text[i:end]])
        char = text[i]
        if run := _DELIMITER_RUN.match(text, i):
            offer(i, run.end(), _COST_DELIMITER, [])
        if i in words:
            offer(i, words[i], _COST_DELIMITER, [])
        if char in WRAPPERS or (char == "." and (i + 1 == n or text[i + 1] in DELIMITERS)):
            offer(i, i + 1, _COST_WRAPPER, [])
        opens = i == 0 or not text[i - 1].isalnum()
        if char in QUOTES and opens and (found := _quoted(text, i)):
            content, end = found
            inner = [content.strip()] if content.strip() else []
            if depth < _MAX_DEPTH and inner and _holds_several(content, automaton):
                inner = segment(content, automaton, depth + 1)
            offer(i, end, _COST_QUOTED, inner)
        elif char not in DELIMITERS:
            value, end = _free_end(text, i)
            stripped = value.strip().strip(WRAPPERS).strip()
            offer(i, end, _COST_FREE + _COST_CHAR * (end - i), [stripped] if stripped else [])
            # free text may also stop before a word that separates, or before a known value
            for stop in sorted({*words, *known}):
                if i < stop < end and text[stop - 1] in " \"'":
                    part = text[i:stop].strip().strip(WRAPPERS).strip()
                    offer(i, stop, _COST_FREE + _COST_CHAR * (stop - i), [part] if part else [])
                    break
    at, parts = n, []
    while at > 0:
        _, before, values = best[at]
        if before < 0:
            return [body]
        parts.append(values or [])
        at = before
    found = [v for values in reversed(parts) for v in values]
    return [v for v in found if any(c.isalnum() for c in v) and v.lower() not in PLACEHOLDERS]


def _holds_several(content: str, automaton) -> bool:
    """Whether a quoted content is itself a packed field: it holds a known value that is not the whole of it."""
    if automaton is None:
        return False
    for last, value in automaton.iter(content):
        first, end = last - len(value) + 1, last + 1
        if (first == 0 or not content[first - 1].isalnum()) and (end == len(content) or not content[end].isalnum()):
            if value != content.strip():
                return True
    return False


def _segment_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import ahocorasick

    for batch in batches:
        automaton = ahocorasick.Automaton()
        for values in batch["known"]:
            for value in values if values is not None else ():
                automaton.add_word(value, value)
        ready = None
        if len(automaton):
            automaton.make_automaton()
            ready = automaton
        yield pd.DataFrame({"text": batch["text"], "values": [segment(t, ready) for t in batch["text"]]})


#: Letters and digits that belong together; a known value begins and ends at the ends of such runs.
_RUNS = r"([\p{L}\p{N}]+)"


def _anchors(text: Column, singles: bool) -> Column:
    """What a text may be looked up by: each two neighbouring runs of letters and digits, and ``singles`` each single run."""
    runs = F.regexp_extract_all(text, F.lit(_RUNS), 1)
    pairs = F.zip_with(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.concat(pairs, runs) if singles else F.when(F.size(runs) > 1, pairs).otherwise(runs))


def known_values(texts: DataFrame, dictionary: DataFrame, value: str) -> DataFrame:
    """``(text, known)``: the dictionary values that occur in each text, whatever delimiters they hold.

    A value is looked up by the rarest two neighbouring runs of its letters and digits (by its only run where it has
    one), so a common first word gathers nothing; what meets is compared whole before it is kept.
    """
    values = dictionary.select(F.col(value).alias("value")).where(F.col("value").rlike(_RUNS)).distinct()
    keyed = values.select("value", _anchors(F.col("value"), False).alias("anchors"))
    # only values of more than two runs have a choice, so only their anchors are counted
    chosen = keyed.where(F.size("anchors") > 1).select("value", F.explode("anchors").alias("anchor"))
    counts = chosen.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    rarest = chosen.join(counts, "anchor").groupBy("value").agg(F.min(F.struct("n", "anchor"))["anchor"].alias("anchor"))
    rarest = rarest.unionByName(keyed.where(F.size("anchors") == 1).select("value", F.col("anchors")[0].alias("anchor")))
    places = texts.select("text", F.explode(_anchors(F.col("text"), True)).alias("anchor"))
    met = places.join(rarest, "anchor").where(F.col("text").contains(F.col("value")))
    return met.groupBy("text").agg(F.collect_set("value").alias("known"))


def split_packed(frame: DataFrame, key: str, field: str, dictionary: DataFrame, value: str) -> DataFrame:
    """One row per value: ``key``, ``value_pos`` (from 1, left to right), ``matched_value`` and ``value_count``.

    ``dictionary[value]`` holds known whole values, with any delimiters inside; they are found as written. Rows of the
    result repeat as rows of ``frame`` do.
    """
    rows = frame.select(F.col(key).alias("key"), F.col(field).alias("text")).where(F.trim("text") != "")
    texts = rows.select("text").distinct()
    known = known_values(texts, dictionary, value)
    ready = texts.join(known, "text", "left").select("text", F.coalesce("known", F.array().cast("array<string>")).alias("known"))
    parsed = ready.mapInPandas(_segment_batches, "text string, values array<string>")
    out = rows.join(parsed, "text").select("key", F.size("values").alias("value_count"), F.posexplode("values").alias("value_pos", "matched_value"))
    return out.select(F.col("key").alias(key), (F.col("value_pos") + 1).cast("int").alias("value_pos"), "matched_value", "value_count")

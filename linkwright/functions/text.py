"""Comparison views of typed text as column functions.

Built-in expressions wherever Spark has them. Unicode forms, case folding and script names have no JVM equivalent and
run as Arrow UDFs; rows in printable ASCII bypass them.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Legal suffixes, removed only from the end of a name.
LEGAL_SUFFIXES = "co company corp corporation inc incorporated llc llp limited ltd private pvt plc pc foundation trust".split()
# Scripts told apart by the first word of a character's name; any other letter is OTHER.
SCRIPTS = "LATIN DEVANAGARI BENGALI GUJARATI GURMUKHI KANNADA MALAYALAM TAMIL TELUGU ARABIC CYRILLIC GREEK HEBREW".split()
WIDE_SCRIPTS = [*SCRIPTS, "THAI", "HANGUL", "HIRAGANA", "KATAKANA", "CJK"]

#: White space as Python's str.split sees it, letters and digits of any script, numbers of any script.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
TOKEN = r"[\p{L}\p{N}_]+"
NUMBER = r"\p{Nd}+"
_ASCII = r"^[\x20-\x7E]*$"


def text(column: Column | str) -> Column:
    """The column with null as empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def squeezed(column: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(column, f"{SPACE}+", " "))


@F.pandas_udf(StringType())
def _basic(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else " ".join(unicodedata.normalize("NFKC", v).casefold().split()))


@F.pandas_udf(StringType())
def _folded(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)))


def _past_ascii(column: Column, udf, plain: Column) -> Column:
    """``plain`` for printable ASCII, the UDF's result for other text; the UDF gets null for the former."""
    odd = F.when(~column.rlike(_ASCII), column)
    return F.coalesce(udf(odd), plain)


def normalize_basic(column: Column | str) -> Column:
    """Compatibility form, case folded, white space squeezed; null gives empty text."""
    value = text(column)
    return _past_ascii(value, _basic, F.trim(F.regexp_replace(F.lower(value), " +", " ")))


def normalize_punct(norm: Column | str) -> Column:
    """Punctuation and symbols of normalised text as blanks."""
    return squeezed(F.regexp_replace(text(norm), r"[\p{P}\p{S}]", " "))


def fold_accents(norm: Column | str) -> Column:
    """Compatibility decomposition without combining marks; not composed again."""
    value = text(norm)
    return _past_ascii(value, _folded, value)


@lru_cache(maxsize=65536)
def _roman(char: str) -> tuple[str, bool, bool]:
    """Latin letters of one character, whether a vowel that goes with it is replaced, and whether it carries one."""
    name = unicodedata.name(char, "")
    if "VIRAMA" in name:
        return "", True, False
    if "VOWEL SIGN" in name:
        return name.split("VOWEL SIGN ")[1].split()[-1].lower(), True, False
    if "ANUSVARA" in name or "CANDRABINDU" in name:
        return "n", False, False
    if " LETTER " in name:
        said = name.split(" LETTER ")[1].split(" WITH ")[0].split()[-1].lower()
        carries = len(said) > 1 and said.endswith("a")
        # alphabets name their letters, syllabic scripts say them
        alphabet = name.startswith(("GREEK", "CYRILLIC", "HEBREW", "ARABIC", "LATIN"))
        if alphabet and name.startswith("CYRILLIC"):
            spoken = "" if said == "sign" else said if said.startswith("y") else "".join(c for c in said if c not in "aeiou") or said[-1]
            return spoken, False, False
        return (said[:1] if alphabet else said, False, carries and not alphabet)
    return (char if char.isalnum() and not unicodedata.combining(char) else " " if char.isspace() else "", False, False)


def roman(text: str) -> str:
    """Text in Latin letters by the Unicode names of its characters; Latin text only loses its accents."""
    out: list[str] = []
    open_vowel = False
    for char in text:
        if char.isascii():
            said, replaces, carries = char, False, False
        else:
            said, replaces, carries = _roman(char)
        if replaces and open_vowel:
            out[-1] = out[-1][:-1]
        elif open_vowel and not char.isalpha() and not unicodedata.combining(char):
            out[-1] = out[-1][:-1]
        if said or not replaces:
            out.append(said)
        open_vowel = carries
    if open_vowel and out:
        out[-1] = out[-1][:-1]
    return "".join(out)


@F.pandas_udf(StringType())
def _romanized(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else roman(v))


def romanized(column: Column | str) -> Column:
    """The text in Latin letters, so that names in different scripts share n-grams."""
    value = text(column)
    return _past_ascii(value, _romanized, value)


def unicode_form(column: Column | str, form: str) -> Column:
    """NFC, NFD, NFKC or NFKD of the text."""
    if form not in ("NFC", "NFD", "NFKC", "NFKD"):
        raise ValueError(f"unknown form {form}")

    @F.pandas_udf(StringType())
    def convert(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else unicodedata.normalize(form, v))

    value = text(column)
    return _past_ascii(value, convert, value)


def strip_punctuation(column: Column | str) -> Column:
    """Without characters of category P; symbols stay."""
    return F.regexp_replace(text(column), r"\p{P}", "")


def strip_marks(column: Column | str) -> Column:
    """Without characters of category M."""
    return F.regexp_replace(text(column), r"\p{M}", "")


def tokens(punct: Column | str) -> Column:
    return F.regexp_extract_all(text(punct), F.lit(f"({TOKEN})"), 1)


def name_core(punct: Column | str) -> Column:
    """Name without trailing legal suffixes; may become empty."""
    joined = F.array_join(tokens(punct), " ")
    return F.regexp_replace(joined, rf"(?:(?:^| )(?:{'|'.join(LEGAL_SUFFIXES)}))+$", "")


def numbers(norm: Column | str) -> Column:
    return F.regexp_extract_all(text(norm), F.lit(f"({NUMBER})"), 1)


def number_signature(norm: Column | str) -> Column:
    return F.array_join(numbers(norm), "|")


def postal_token(norm: Column | str) -> Column:
    """The last number of five or six digits, or empty."""
    long = F.filter(numbers(norm), lambda x: F.length(x).between(5, 6))
    return F.coalesce(F.try_element_at(long, F.lit(-1)), F.lit(""))


@lru_cache(maxsize=65536)
def _script(char: str, scripts: tuple[str, ...]) -> str | None:
    if not char.isalpha():
        return None
    name = unicodedata.name(char, "")
    return next((s for s in scripts if name.startswith(s)), "OTHER")


def scripts_in(column: Column | str, scripts: list[str] | None = None) -> Column:
    """Sorted distinct scripts of the letters of raw text."""
    known = tuple(scripts or SCRIPTS)

    @F.pandas_udf(ArrayType(StringType()))
    def find(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else sorted({s for c in set(v) if (s := _script(c, known))}))

    value = text(column)
    ascii_scripts = F.when(value.rlike("[A-Za-z]"), F.array(F.lit("LATIN"))).otherwise(F.array().cast("array<string>"))
    return _past_ascii(value, find, ascii_scripts)


def script_signature(column: Column | str, scripts: list[str] | None = None) -> Column:
    found = scripts_in(column, scripts)
    return F.when(F.size(found) == 0, "NONE").otherwise(F.array_join(found, "|"))


def has_non_latin(signature: Column | str) -> Column:
    return F.exists(F.split(text(signature), r"\|"), lambda s: ~s.isin("LATIN", "NONE"))


def jaccard(a: Column, b: Column, both_empty: float) -> Column:
    """Jaccard similarity of two arrays as sets."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(both_empty)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def token_jaccard(a: Column | str, b: Column | str) -> Column:
    """Of raw texts; two empty texts are equal."""
    return jaccard(tokens(normalize_punct(normalize_basic(a))), tokens(normalize_punct(normalize_basic(b))), 1.0)


def number_jaccard(a: Column | str, b: Column | str) -> Column:
    """Of raw texts; two texts without a number share nothing."""
    return jaccard(numbers(normalize_basic(a)), numbers(normalize_basic(b)), 0.0)


def length_ratio(a: Column | str, b: Column | str) -> Column:
    first, second = F.length(text(a)), F.length(text(b))
    most = F.greatest(first, second)
    return F.when(most == 0, 1.0).otherwise(F.least(first, second) / F.greatest(most, F.lit(1)))


def char_ngrams(column: Column | str, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside words, each padded with one blank; a padded word shorter than ``low`` counts once."""
    words = F.filter(F.split(text(column), " +"), lambda w: w != "")

    def of(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        size = F.length(padded)
        sizes = F.sequence(F.lit(low), F.greatest(F.lit(low), F.least(F.lit(high), size)))
        return F.flatten(
            F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), size - n + 1)), lambda i: F.substring(padded, i, n)))
        )

    return F.flatten(F.transform(words, of))


def token_document(name: Column | str, address: Column | str) -> Column:
    """Distinct sorted terms: name words of two characters on, address words of four on that are no number, numbers of two digits on."""

    def words(value: Column | str) -> Column:
        return F.filter(F.split(text(value), " "), lambda w: w != "")

    of_name = F.transform(F.filter(words(name), lambda w: F.length(w) >= 2), lambda w: F.concat(F.lit("n:"), w))
    of_address = F.transform(F.filter(words(address), lambda w: (F.length(w) >= 4) & ~w.rlike(r"^\p{N}+$")), lambda w: F.concat(F.lit("a:"), w))
    digits = F.transform(F.filter(numbers(address), lambda n: F.length(n) >= 2), lambda n: F.concat(F.lit("d:"), n))
    return F.array_sort(F.array_distinct(F.concat(of_name, of_address, digits)))


def embedding_text(prefix: str, name: Column | str, address: Column | str, country: Column | str) -> Column:
    return F.concat(F.lit(f"{prefix}: business name: "), text(name), F.lit(" | address: "), text(address), F.lit(" | country: "), text(country))


def record_views(frame: DataFrame) -> DataFrame:
    """The four raw columns with every derived view.

    Missing columns raise ``ValueError``; null text becomes empty; the country is only trimmed.
    """
    needed = ["entity_id", "business_name", "business_address", "country"]
    missing = [c for c in needed if c not in frame.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    raw = frame.select(*[text(c).alias(c) for c in needed], *[c for c in frame.columns if c not in needed])
    raw = raw.withColumns({"name_norm": normalize_basic("business_name"), "address_norm": normalize_basic("business_address")})
    return raw.withColumns(
        {
            "name_punct": normalize_punct("name_norm"),
            "name_ascii": fold_accents("name_norm"),
            "address_punct": normalize_punct("address_norm"),
            "address_numbers": number_signature("address_norm"),
            "postal_token": postal_token("address_norm"),
            "name_script": script_signature("business_name"),
            "address_script": script_signature("business_address"),
            "country": squeezed(F.col("country")),
        }
    ).withColumns({"name_core": name_core("name_punct"), "has_non_latin_name": has_non_latin("name_script")})

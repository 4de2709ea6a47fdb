import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from linkwright.functions import text as T
from linkwright.functions.similarity import common_length, ratio, token_set_ratio


def value(spark, text, make):
    return spark.createDataFrame([(text,)], "x string").select(make(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, expected", [(" ＡCME  LTD. ", "acme ltd."), ("é", "é"), (None, ""), ("", ""), ("Straße", "strasse"), ("a　b\x85c", "a b c")]
)
def test_normalize_basic(spark, text, expected):
    assert value(spark, text, T.normalize_basic) == expected


def test_punctuation_becomes_blanks(spark):
    assert value(spark, "A.B-C", lambda c: T.normalize_punct(T.normalize_basic(c))) == "a b c"


@pytest.mark.parametrize("text, expected", [("Lakshmi लक्ष्मी", "DEVANAGARI|LATIN"), ("123", "NONE"), ("", "NONE"), (None, "NONE"), ("abc", "LATIN"), ("ＡＢ", "OTHER")])
def test_scripts(spark, text, expected):
    assert value(spark, text, T.script_signature) == expected


def test_other_counts_as_non_latin(spark):
    assert value(spark, "Lakshmi लक्ष्मी", lambda c: T.has_non_latin(T.script_signature(c)))
    assert value(spark, "ＡＢ", lambda c: T.has_non_latin(T.script_signature(c)))
    assert not value(spark, "12", lambda c: T.has_non_latin(T.script_signature(c)))


@pytest.mark.parametrize(
    "text, expected",
    [("Acme Private Limited", "acme"), ("Trust Bank", "trust bank"), ("Foundation Coffee Company", "foundation coffee"), ("Co", ""), ("Acmeco", "acmeco")],
)
def test_name_core(spark, text, expected):
    assert value(spark, text, lambda c: T.name_core(T.normalize_punct(T.normalize_basic(c)))) == expected


@pytest.mark.parametrize("text, expected", [("Agra 282005", "282005"), ("1 2 3", ""), ("12345 and 678901 end", "678901"), ("", "")])
def test_postal_token(spark, text, expected):
    assert value(spark, text, T.postal_token) == expected


def test_jaccards_of_empty_texts_differ(spark):
    frame = spark.createDataFrame([("14 Main Road 282005", "14 MG Rd 282005"), ("", None)], "a string, b string")
    rows = frame.select(T.token_jaccard("a", "b"), T.number_jaccard("a", "b"), T.length_ratio("a", "b")).collect()
    assert rows[0][1] == 1.0
    assert tuple(rows[1]) == (1.0, 0.0, 1.0)


def test_tokens_split_at_combining_marks(spark):
    assert value(spark, "लक्ष्मी", T.tokens) == ["लक", "ष", "म"]


def test_char_ngrams_stay_inside_words(spark):
    assert value(spark, "ab c", T.char_ngrams) == [" ab", "ab ", " ab ", " c "]
    assert value(spark, "", T.char_ngrams) == []


def test_token_document(spark):
    frame = spark.createDataFrame([("a bakery bakery", "main st 1234 5 road")], "n string, a string")
    assert frame.select(T.token_document("n", "a").alias("d")).first()["d"] == ["a:main", "a:road", "d:1234", "n:bakery"]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="country"):
        T.record_views(spark.createDataFrame([("S1-1", "a", "b")], "entity_id string, business_name string, business_address string"))


def test_common_subsequence_against_the_quadratic_way():
    rng = random.Random(0)

    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b, 1):
                new.append(row[j - 1] + 1 if x == y else max(row[j], new[j - 1]))
            row = new
        return row[-1]

    for _ in range(300):
        a, b = ("".join(rng.choices("abcd ", k=rng.randint(0, 20))) for _ in range(2))
        assert common_length(a, b) == slow(a, b)


def test_ratios():
    assert ratio("", "") == 1.0 and ratio("abc", "abc") == 1.0 and ratio("abc", "xyz") == 0.0
    assert token_set_ratio("", "a") == 0.0
    assert token_set_ratio("alpha bakery", "bakery alpha ltd") == 1.0
    assert 0 < token_set_ratio("alpha bakery", "alpha cafe") < 1


def test_forms(spark):
    for form in ("NFC", "NFD", "NFKC", "NFKD"):
        assert value(spark, "é ﬁ", lambda c, f=form: T.unicode_form(c, f)) == unicodedata.normalize(form, "é ﬁ")
    with pytest.raises(ValueError):
        T.unicode_form("x", "NFX")
    assert value(spark, "a-b+c", T.strip_punctuation) == "ab+c"

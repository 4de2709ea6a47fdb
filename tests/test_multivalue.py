import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkwright.operators.multivalue import known_values, segment, split_packed


def automaton(*values):
    import ahocorasick

    out = ahocorasick.Automaton()
    for v in values:
        out.add_word(v, v)
    out.make_automaton()
    return out


IDS = automaton("S2-1", "S2-2", "S3-3")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", []), (" ", []), ("-", []), ("[]", []), ("none", []), (",;|", []), ("S2-1", ["S2-1"]), ("S2-1,,S2-2,", ["S2-1", "S2-2"]), ("S2-1 S2-2", ["S2-1", "S2-2"]),
        ("S2-1 and S2-2 & S3-3", ["S2-1", "S2-2", "S3-3"]), ("['S2-1', \"S2-2\"]", ["S2-1", "S2-2"]), ("S2-1,S2-1", ["S2-1", "S2-1"]), ('"S2-1;S2-2"', ["S2-1", "S2-2"]),
        ('"S2-1, ""Foo Traders, Town; ref 7"""', ["S2-1", "Foo Traders, Town; ref 7"]), (r"S2-1,Foo Bar\, Town\; ref 4", ["S2-1", "Foo Bar, Town; ref 4"]),
        ('<S3-3,,"A, B and C">', ["S3-3", "A, B and C"]), ("S2-1、S2-2.", ["S2-1", "S2-2"]), ("S2-1\n\"Joe's, Town\"", ["S2-1", "Joe's, Town"]), ("S2-10,S2-1", ["S2-10", "S2-1"]),
        ('"unclosed, S2-1', ['"unclosed', "S2-1"]),
    ],
)
def test_segment(text, expected):
    assert segment(text, IDS) == expected


def test_a_known_value_keeps_its_delimiters():
    assert segment("S2-1, Smith, Sons & Co, S2-2", automaton("S2-1", "S2-2", "Smith, Sons & Co")) == ["S2-1", "Smith, Sons & Co", "S2-2"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["S2-1", "S2-2", "S3-3", '"A, B; c"', '"x | y"']), min_size=1, max_size=6), st.sampled_from([",", ";", " | ", "\t", "\n", "、", " and ", " / ", ":"]), st.sampled_from(["{}", "[{}]", "({})", "{}" + ","]))
def test_round_trip(values, delimiter, wrapper):
    assert segment(wrapper.format(delimiter.join(values)), IDS) == [v.strip('"') for v in values]


def test_long_fields():
    assert len(segment(",".join(["S2-1"] * 3000), IDS)) == 3000


def test_rows(spark):
    rows = [("a", "S2-1,S2-2", "x"), ("a", "S2-1,S2-2", "x"), ("b", None, "x"), ("c", "", "x"), (None, "S3-3", "x"), ("d", "[]", "x")]
    frame = spark.createDataFrame(rows, "k string, f string, matched_value string")
    known = spark.createDataFrame([("S2-1",), ("S2-2",), ("S3-3",), (None,)], "id string")
    out = split_packed(frame, "k", "f", known, "id")
    assert sorted((r["k"] or "", r["value_pos"], r["matched_value"], r["value_count"]) for r in out.collect()) == [
        ("", 1, "S3-3", 1), ("a", 1, "S2-1", 2), ("a", 1, "S2-1", 2), ("a", 2, "S2-2", 2), ("a", 2, "S2-2", 2),
    ]
    assert split_packed(frame.limit(0), "k", "f", known, "id").isEmpty()
    assert split_packed(frame, "k", "f", known.limit(0), "id").where("k = 'a'").count() == 4


@pytest.mark.parametrize("name", ["Foo, Bar Ltd", "A/B/C/D Works", "Smith; Jones | Co", "One\tTwo, Three; Four | Five/Six & Seven", "The Old Mill, The Old Barn", "C++", "R & D", "(new) Shop, Town"])
def test_dictionary_values_keep_their_delimiters(spark, name):
    fields = [("a", f"S2-1, {name}; S2-2"), ("b", name), ("c", f"[{name}|{name}]"), ("d", name.split(" ")[0]), ("e", f"x{name}")]
    known = spark.createDataFrame([("S2-1",), ("S2-2",), (name,), ("The Old Mill",), ("The Old",), ("",), (",;",), (None,)], "id string")
    out = split_packed(spark.createDataFrame(fields, "k string, f string"), "k", "f", known, "id").collect()
    values = {k: [r["matched_value"] for r in sorted(out, key=lambda r: r["value_pos"]) if r["k"] == k] for k, _ in fields}
    assert values["a"] == ["S2-1", name, "S2-2"] and values["b"] == [name] and values["c"] == [name, name]
    assert name not in values["d"] or " " not in name
    assert name not in values["e"] or not name[0].isalnum()


def test_known_values_against_brute_force(spark):
    import random

    rng = random.Random(4)
    word = lambda: "".join(rng.choices("ab1é", k=rng.randint(1, 2)))
    text = lambda n: "".join(word() + rng.choice([" ", ",", "; ", "/", "|", "-", ". "]) for _ in range(n)) + word()
    known = {text(rng.randint(0, 3)) for _ in range(150)}
    fields = {text(rng.randint(0, 8)) for _ in range(150)}
    found = known_values(spark.createDataFrame([(f,) for f in fields], "text string"), spark.createDataFrame([(k,) for k in known], "v string"), "v").collect()
    got = {r["text"]: set(r["known"]) for r in found}
    for field in fields:
        whole = {k for k in known if any((i == 0 or not field[i - 1].isalnum()) and (i + len(k) == len(field) or not field[i + len(k)].isalnum()) for i in range(len(field)) if field.startswith(k, i))}
        assert whole <= got.get(field, set()), field

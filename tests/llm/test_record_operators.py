import random

import pytest

from linkwright.llm import addresses, groups, linkage, names, records
from linkwright.llm.leakage import edits
from linkwright.llm.queries import LEXICON
from linkwright.session import cut


def pairs(frame):
    return {tuple(r) for r in frame.collect()}


def test_components_against_union_find(spark):
    rng = random.Random(2)
    links = [(f"S1-{rng.randrange(150):03d}", f"S2-{rng.randrange(220)}") for _ in range(240)] + [(f"S1-{i:03d}", f"S2-c{i // 2}") for i in range(200, 240)] + [(f"S1-{i:03d}", f"S2-c{(i + 1) // 2}") for i in range(200, 240)]
    links += [(f"S1-{i:03d}", "S2-hot") for i in range(300, 400)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    expected = {}
    for a, _ in links:
        expected.setdefault(find(a), set()).add(a)
    expected = {m: min(g) for g in expected.values() for m in g}
    rows = [(a + " ", f"{b};x") for a, b in links] + [("S1-999", None), (None, "S2-1"), (" ", "S2-1"), ("S1-998", "")]
    tied = groups.tied_entities(spark.createDataFrame(rows, "k string, f string"), "k", "f", r"S2-\w+")
    got = {r["entity"]: r["group_first"] for r in tied.collect()}
    assert got == expected | {"S1-999": "S1-999", "S1-998": "S1-998"}
    split = groups.split(tied, {"train": 0.8, "test": 0.2}).toPandas()
    assert len(split) == len(got) and split.groupby("group_first").split.nunique().max() == 1
    assert 0.6 < (split.split == "train").mean() < 0.95
    with pytest.raises(ValueError):
        groups.split(tied, {"train": 0.5})


def test_no_entities(spark):
    empty = spark.createDataFrame([], "k string, f string")
    assert groups.tied_entities(empty, "k", "f").isEmpty()


ADDRESSES = {
    "S2-1": "146 Dokoge Rd., Suite 92, Noseville, EM 33951", "S2-2": "DOKOGE ROAD 146, STE #92, EAST MARLAN 33951", "S3-1": "#92, 146 Dokoeg Road, Noseville", "S3-2": "146 Dokoge Road, Suite 94, Noseville",
    "S3-3": "148 Dokoge Road, Suite 92, Noseville", "S2-3": "Shop No 36, Plot 1558, Raloji Bazaar, Dakukuabad, 261511", "S3-4": "raloji bzr #1558, unit no 36, pin: 261 511", "S2-4": None, "S2-5": "", "S2-6": "-",
    "S2-7": "Near Bus Stand, Dakukuabad", "S3-5": "146 Dokoge Road, Suite 92, Otherton, NV 11111", "S2-8": "1４6 Ｄokoge Road, Suite 92, Noseville", "S3-6": "12th Avenue 5, Noseville", "S3-7": "5 Twelfth Ave, Noseville",
}
SAME = [{"S2-1", "S2-2", "S3-1", "S2-8"}, {"S2-3", "S3-4"}, {"S3-6", "S3-7"}]


def test_same_places(spark):
    rows = [(k, v, "x") for k, v in ADDRESSES.items()] + [("S2-1", ADDRESSES["S2-1"], "y"), (None, "1 A Road", "z")]
    frame = spark.createDataFrame(rows, "entity_id string, business_address string, street string")
    expected = {tuple(sorted((a, b))) for group in SAME for a in group for b in group if a < b}
    assert pairs(addresses.same_place_pairs(frame, "entity_id", "business_address", LEXICON)) == expected
    assert addresses.same_place_pairs(frame.limit(0), "entity_id", "business_address").isEmpty()


def test_index_misses_nothing_that_verifies(spark):
    """Prefix-filtered index against all pairs."""
    rng = random.Random(6)

    def damage(word):
        i = rng.randrange(len(word) - 1)
        return rng.choice([word, word[:i] + word[i + 1 :], word[:i] + word[i + 1] + word[i] + word[i + 2 :], word[:i] + "x" + word[i + 1 :]])

    streets = ["bemovar", "luvolur", "tajuru", "sehavi", "dokogen", "mikados"]
    rows = [(f"S2-{i}", f"{rng.randrange(1, 4)} {damage(rng.choice(streets))} Road, Noseville {rng.choice(['', '11111'])}") for i in range(150)]
    frame = spark.createDataFrame(rows, "k string, a string")
    places = addresses.parsed_places(frame, "k", "a")
    signatures = places.dropDuplicates(["sid"]).drop("entity_id")
    got = {(r[0], r[1]) for r in addresses.similar_places(signatures).collect()}
    of_street = {r["street"]: {x["g"]: x["w"] for x in r["vector"]} for r in addresses.vectors(signatures).collect()}
    vectors = {r["sid"]: of_street[r["street"]] for r in signatures.collect()}
    a, b = signatures.alias("a"), signatures.alias("b")
    from pyspark.sql import functions as F

    near = a.join(b, (F.col("a.sid") < F.col("b.sid")) & (F.col("a.door") == F.col("b.door"))).where(addresses.compatible("a", "b") & addresses.close_streets("a", "b"))
    brute = {(r[0], r[1]) for r in near.select("a.sid", "b.sid").collect()}
    brute = {(x, y) for x, y in brute if sum(w * vectors[y].get(g, 0) for g, w in vectors[x].items()) >= addresses.COSINE}
    assert got == brute and got


def same_places(spark, lexicon, *addresses_):
    frame = spark.createDataFrame([(f"S2-{i}", a) for i, a in enumerate(addresses_)], "k string, a string")
    return {(int(a[3:]), int(b[3:])) for a, b in pairs(addresses.same_place_pairs(frame, "k", "a", lexicon))}


def test_streets_of_several_words(spark):
    texts = [
        "1200 North Main Street, Springfield, 62701", "1200 South Main Street, Springfield, 62701", "1200 N Main St, Springfield 62701", "1200 Main St, Springfield, 62701",
        "12 Old Mill Road, Springfield, 62701", "12 New Mill Road, Springfield, 62701", "12 Old Mill Rd, Sprngfield 62701", "12 rue de la Paix, 75002 Paris", "12, rue Paix Paris", "7 Martin Luther King Road, Salem", "7 Stephen King Road, Salem",
    ]
    assert same_places(spark, records.GENERAL, *texts) == {(0, 2), (0, 3), (1, 3), (2, 3), (4, 6), (7, 8)}
    long = "5 Mavutu Road, beside alpha bravo delta echo foxtrot golf hotel india, Zulutown"
    assert same_places(spark, records.GENERAL, long, "5 Mavutu Rd, Zulutown", "5 Mavutu Rd, Yankeetown") == {(0, 1)}


def test_no_lexicon(spark):
    """Without any list every word is a name; spelling, numbers and structure still tell places and names apart."""
    texts = ["146 Dokoge, Noseville 33951", "146 Dokoeg, Noseville, 33951", "148 Dokoge, Noseville 33951", "146 Dokoge, Otherton 11111"]
    assert same_places(spark, records.EMPTY, *texts) == {(0, 1)}
    rows = [("S2-1", "Puyeman Luulekan"), ("S3-1", "Luulekan Puyemann"), ("S3-2", "Gohuko Yobivu"), ("S3-3", "")]
    assert pairs(names.variant_pairs(spark.createDataFrame(rows, "k string, n string"), "k", "n", records.EMPTY)) == {("S2-1", "S3-1")}


@pytest.mark.parametrize(
    "text", [None, "", "-", "...", "#", "#12", "12", "Shop No", "1 2 3 4 5", "पिन 123456", "x " * 5000, "12 " * 3000]
)
def test_parsers_take_anything(text):
    for lexicon in (records.GENERAL, records.EMPTY):
        records.parse_address(text, lexicon), records.read_address(text, lexicon), records.parse_name(text, lexicon)


def test_trie_against_edit_distance():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(200)})
    trie = names.Trie()
    for w in words:
        trie.add(w, w)
    for w in words[:80]:
        assert dict(trie.near(w)) == {x: d for x in words if (d := edits(w, x, 2)) <= 2}


def test_one_edit_in_each_word_is_always_found(spark):
    """Shards against all pairs: any name with one edit in each of two words meets its original."""
    rng = random.Random(8)
    letters = "bcdfghklmnprst"

    def word():
        return "".join(rng.choice(letters) + rng.choice("aeiou") for _ in range(rng.choice([3, 4])))

    def hurt(w):
        i = rng.randrange(len(w) - 1)
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + "z" + w[i + 1 :], w[:i] + "z" + w[i:]])

    originals = [(word(), word()) for _ in range(120)]
    cores = {" ".join(sorted(p)) for p in originals} | {" ".join(sorted((hurt(a), hurt(b)))) for a, b in originals}
    frame = spark.createDataFrame([(c,) for c in cores], "core string")
    got = pairs(names.near_cores(frame).select("a", "b"))
    expected = set()
    for x in cores:
        for y in cores:
            if x < y:
                a, b = x.split(), y.split()
                if any(edits(a[0], c, 1) <= 1 and edits(a[1], d, 1) <= 1 for c, d in (b, b[::-1])):
                    expected.add((x, y))
    assert expected <= got
    assert got == pairs(names.near_cores(frame, block=3).select("a", "b"))


def test_two_edits_anywhere_are_always_found(spark):
    """Shards against all pairs, for names of two to nine words and more, both edits in one word or in two."""
    rng = random.Random(9)

    def word():
        return "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(rng.choice([2, 3, 4])))

    def hurt(words):
        words = list(words)
        for i in rng.choice([(0, 0), (0, 1), (len(words) - 1,) * 2, (rng.randrange(len(words)),)]):
            w = words[i]
            k = rng.choice([0, rng.randrange(len(w)), len(w) - 1])
            words[i] = rng.choice([w[:k] + w[k + 1 :], w[:k] + "z" + w[k + 1 :], w[:k] + "z" + w[k:]]) if len(w) > 3 else w
        return words

    kept = [[word() for _ in range(n)] for n in (2, 2, 2, 3, 4, 5, 6, 7, 9, 14, 18) for _ in range(12)]
    made = [(" ".join(sorted(set(w))), " ".join(sorted(set(hurt(w))))) for w in kept for _ in range(3)]
    got = pairs(names.near_cores(spark.createDataFrame([(c,) for pair in made for c in pair], "core string")).select("a", "b"))
    for a, b in made:
        x, y = set(a.split()) - set(b.split()), set(b.split()) - set(a.split())
        if a == b or len(a.split()) != len(b.split()):
            continue
        total = edits(*x, *y, 2) if len(x) == len(y) == 1 else 2
        if total == 2 and len(x) == 1 and min(map(len, (*x, *y))) < names.LEAST_TWICE:
            continue
        assert (min(a, b), max(a, b)) in got, (a, b)


def test_joined_shards_find_what_tries_find(spark):
    """Small shards meet in a join and large ones in tries, with the same pairs and distances."""
    rng = random.Random(3)

    def hurt(text):
        for _ in range(rng.choice([1, 2])):
            i = rng.randrange(len(text) - 1)
            text = rng.choice([text[:i] + text[i + 1 :], text[:i] + text[i + 1] + text[i] + text[i + 2 :], text[:i] + "z" + text[i + 1 :], text[:i] + "z" + text[i:]])
        return text

    def word():
        return "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(rng.choice([2, 3, 4])))

    made = ["".join((word(), " ", word())) for _ in range(40)]
    texts = made + [hurt(t) for t in made for _ in range(3)] + [hurt(t.replace(" ", "")) for t in made] + [f"kehilos {word()}" for _ in range(30)]
    frame = spark.createDataFrame([(" ".join(sorted(set(t.split()))),) for t in texts], "core string")
    joined = pairs(names.near_cores(frame))
    assert len(joined) > 200 and joined == pairs(names.near_cores(frame, paired=1))
    # a name meets by each word whole, so it needs no keys of the ends of both
    assert not any("&" in shard for shard, _ in names.shards("kehilos relesnen", ends=False))


def test_single_keys(spark):
    """Every single word shares a key with glued ones and single ones up to two edits apart; Spark makes the same keys."""
    rng = random.Random(4)
    for size in range(5, 22):
        for _ in range(60):
            text = other = "".join(rng.choice("abcdefgh") for _ in range(size))
            for _ in range(2):
                i = rng.randrange(len(other) - 1)
                other = rng.choice([other[:i] + other[i + 1 :], other[:i] + other[i + 1] + other[i] + other[i + 2 :], other[:i] + "z" + other[i + 1 :], other[:i] + "z" + other[i:]])
            for glued in (False, True):
                assert names.single_keys(text, False) & names.single_keys(other, glued), (text, other, glued)
    cores = [f"{'abcdefghijk'[:i]} {'mnopqrstuvwx'[:j]}" for i in range(3, 12) for j in range(3, 13) if i + j > 11]
    keys = names._long_glued(spark.createDataFrame([(c,) for c in cores], "core string"))
    assert pairs(keys.select("text", "shard")) == {(t, k) for c in cores for t in ("".join(c.split()), "".join(c.split()[::-1])) for k in names.single_keys(t, True)}


def test_hot_names_meet_by_spelling(spark):
    rows = [(f"S2-{i:03d}", "Puyeman Luulekan Bakery") for i in range(60)] + [("S3-001", "PUYEMAN LUULEKAN BKRY"), ("S3-002", "PUYEMAN LUULEKAN BKRY"), ("S3-003", None)]
    got = pairs(names.variant_pairs(spark.createDataFrame(rows, "k string, n string"), "k", "n"))
    assert got == {(f"S2-{i:03d}", f"S3-00{j}") for i in range(60) for j in (1, 2)}


NAMES = {
    "S2-1": "Katherine Puyeman Luulekan Bakery LLC", "S2-2": "katie luulekan puyeman bkry", "S3-1": "LUULEKAN PUYMEAN, K.", "S3-2": "Puyeman Luulekan Hardware", "S3-3": "General Store", "S2-3": "General Store",
    "S2-4": None, "S2-5": "", "S2-6": "Gohuko & Yobivu Agencies", "S3-4": "गोहुको योबिवु एजेंसीज", "S3-5": "GOHUKOYOBIVU AGENCIES", "S3-6": "M/S. Gohuko Yobivu Agcy Ltd dba Blue Fern", "S2-7": "Robert Puyeman Luulekan Bakery",
}


def test_name_variants(spark):
    rows = [(k, v, "x") for k, v in NAMES.items()] + [("S2-1", NAMES["S2-1"], "y")]
    frame = spark.createDataFrame(rows, "entity_id string, business_name string, core string")
    got = pairs(names.variant_pairs(frame, "entity_id", "business_name"))
    agencies = {"S2-6", "S3-4", "S3-5", "S3-6"}
    assert {(a, b) for a in agencies for b in agencies if a < b} <= got
    assert {("S2-1", "S2-2"), ("S2-1", "S3-1"), ("S2-2", "S3-1")} <= got
    assert ("S2-1", "S2-7") not in got and ("S2-3", "S3-3") not in got and ("S2-1", "S3-2") not in got
    assert names.variant_pairs(frame.limit(0), "entity_id", "business_name").isEmpty()


def test_linkage(spark):
    schema = "entity_id string, business_name string, business_address string"
    left = [("S1-1", "Puyeman & Luulekan Bakery LLC", "146 Dokoge Road, Noseville, EM 33951"), ("S1-2", "General Store", "9 Main Street, Noseville"), ("S1-3", "Gohuko Yobivu Agencies", None), ("S1-4", None, None)]
    right = [
        ("S2-1", "LUULEKAN PUYEMAN BKRY", "Dokoge Rd 146, Noseville"), ("S2-2", "Puyeman & Luulekan Bakery LLC", "77 Other Lane, Kusago, TS 11111"), ("S2-3", "Xerox Centre", "146 Dokoge Road, Noseville"),
        ("S2-4", None, "146 Dokoge Rd, EM 33951"), ("S2-5", "Puyeman Luulekan Bakery", "-"), ("S2-6", "General Store", "9 Main St, Noseville"), ("S2-7", "General Store", "12 Main St, Noseville"), ("S2-8", "General Store", None),
        ("S3-1", "Gohuko & Yobivu Agcs", "Plot 12, Tajuru Cross, Tiyehupur"), ("S3-2", None, None), ("S3-3", "Puyeman Luulekan Hardware", "146 Dokoge Road, Noseville"), ("S2-1", "LUULEKAN PUYEMAN BKRY", "Dokoge Rd 146, Noseville"),
    ]
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    rows = linkage.linked(a, b, "entity_id", "business_name", "business_address", LEXICON).collect()
    assert {(r[0], r[1]) for r in rows} == {("S1-1", "S2-1"), ("S1-1", "S2-4"), ("S1-1", "S2-5"), ("S1-2", "S2-6"), ("S1-3", "S3-1")}
    assert all(0 < r["confidence"] <= 1 for r in rows) and len(rows) == 5
    assert linkage.linked(a.limit(0), b, "entity_id", "business_name", "business_address", LEXICON).isEmpty()


SIX = "entity_id string, business_name string, business_address string"


def test_no_growing_side_is_broadcast(spark, monkeypatch):
    plans = []

    def plan(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return cut(frame)

    monkeypatch.setattr(linkage, "cut", plan)
    left = [("S1-1", "Relesnen and Kehilos Ltd", "12 Dorapa Road, Kiriyeville, TS 30101")]
    right = [("S2-1", "Relesnen & Kehilos", "12 Dorapa Rd, Kiriyeville, TS 30101"), ("S2-2", "Gasobir Bumosur", "")]
    found = linkage.linked(spark.createDataFrame(left, SIX), spark.createDataFrame(right, SIX), "entity_id", "business_name", "business_address", LEXICON)
    assert pairs(found.select("left_id", "right_id")) == {("S1-1", "S2-1")}
    # the fit of a file says nothing of the rows exploded out of it
    assert sum(p.count("SortMergeJoin") for p in plans) >= 6 and not any("BroadcastHashJoin" in p for p in plans)


def test_accepted_streets_always_meet(spark):
    """Candidates against all pairs: without a telling name, every two full addresses that are accepted meet."""
    from pyspark.sql import functions as F

    rng = random.Random(11)

    def hurt(w):
        for _ in range(rng.choice([1, 2, 2, 3, 4])):
            i = rng.randrange(len(w) - 1)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + "z" + w[i + 1 :], w[:i] + "k" + w[i:]]) if len(w) > 3 else w
        return w

    streets = ["gipihe", "mavutu", "tajuru", "sehavi", "dokogen", "luvop", "bemovarul", "kusi"]
    left = [(f"S1-{i}", "General Store", f"{10 + i % 3} {w} Street, Noseville, {c}") for i, (w, c) in enumerate((w, c) for w in streets for c in ("", "273538"))]
    right = [(f"S2-{i}", "General Store", f"{10 + i % 3} {hurt(rng.choice(streets))} Street, Noseville, {rng.choice(['', '273538'])}") for i in range(400)]
    left += [("S1-x", "General Store", "No 1834, Gipihe Street, Noseville, 273538")]
    right += [("S3-x", "General Store", "No.1834 Giphie Street, Noseville 273538")]
    a, b = (linkage.described(spark.createDataFrame(rows, SIX), "entity_id", "business_name", "business_address", LEXICON).persist() for rows in (left, right))
    met = pairs(linkage.candidate_graph(a, b, prune=0.0).select("x", "y"))
    both = a.alias("a").join(b.alias("b"), F.col("a.full") & F.col("b.full")).where(linkage.address_score("a", "b") >= linkage.ACCEPT)
    brute = pairs(both.select("a.id", "b.id"))
    assert len(brute) > 100 and brute - met == set()
    got = linkage.linked(spark.createDataFrame(left, SIX), spark.createDataFrame(right, SIX), "entity_id", "business_name", "business_address", LEXICON)
    assert ("S1-x", "S3-x") in pairs(got.select("left_id", "right_id"))


def test_frequent_names_still_link_full_addresses(spark):
    """A chain's records with distant streets at one door meet by name, however many records bear it."""
    right = [(f"S2-{i}", "Puyeman Luulekan Bakery", f"{i + 20} Dokoge Road, Noseville") for i in range(30)] + [("S2-x", "Puyeman Luulekan Bakery", "9 Lokurehan Road, Noseville")]
    left = [("S1-1", "Puyeman Luulekan Bakery", "9 Mavutu Road, Noseville"), ("S1-2", "Puyeman Luulekan Bakery", "8 Mavutu Road, Noseville")]
    a, b = (linkage.described(spark.createDataFrame(rows, SIX), "entity_id", "business_name", "business_address", LEXICON).persist() for rows in (left, right))
    assert pairs(linkage.candidate_graph(a, b, prune=0.0).select("x", "y")) == {("S1-1", "S2-x")}


def test_single_words_up_to_two_edits_apart(spark):
    """Single-word names, also against glued ones, against all pairs; equal ones link without an address."""
    rng = random.Random(13)

    def word(n):
        return "".join(rng.choice("bdgklmnrt") + rng.choice("aeiou") for _ in range(n))[: 2 * n - rng.randrange(2)]

    def hurt(w):
        for _ in range(2):
            i = rng.randrange(len(w) - 1)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + "z" + w[i + 1 :], w[:i] + "z" + w[i:]])
        return w

    originals = [word(n) for n in (3, 3, 4, 5, 6, 7, 8) for _ in range(25)]
    cores = set(originals) | {hurt(w) for w in originals for _ in range(3)} | {" ".join(sorted((w[:6], w[6:]))) for w in originals if len(w) > 11}
    got = pairs(names.near_cores(spark.createDataFrame([(c,) for c in cores], "core string")).select("a", "b"))

    def forms(c):
        return {"".join(c.split()), "".join(reversed(c.split()))}

    expected = set()
    for a in cores:
        for b in cores:
            if a < b and " " not in a + b or a < b and (" " in a) != (" " in b):
                most = 2 if min(len(a), len(b)) >= names.TWO_EDITS else 1
                if any(edits(x, y, 2) <= most for x in forms(a) for y in forms(b)):
                    expected.add((a, b))
    assert expected - got == set()
    assert {(a, b) for a, b in got if " " not in a + b} == {(a, b) for a, b in expected if " " not in a + b}
    rows = [("S2-1", "Zenith Textiles"), ("S3-1", "Zenth Textiles"), ("S3-2", "Zenith Hardware")]
    assert pairs(names.variant_pairs(spark.createDataFrame(rows, "k string, n string"), "k", "n")) == {("S2-1", "S3-1")}
    left, right = [("S1-1", "Deradu Garaje Dental Care", None)], [("S2-1", "Deradu Garaje Dental Care Co", "5 Mavutu Road, Noseville"), ("S2-2", "Deraud Garaje Dental Care", None)]
    links = linkage.linked(spark.createDataFrame(left, SIX), spark.createDataFrame(right, SIX), "entity_id", "business_name", "business_address", LEXICON)
    assert pairs(links.select("left_id", "right_id")) == {("S1-1", "S2-1"), ("S1-1", "S2-2")}

"""Same postal address written differently.

Each address is parsed to door, unit, street, town, state and post code; the street's weighted character n-grams are
its vector, made once for every distinct street. An inverted index keyed by door number and gram holds only each
vector's prefix: the rarest grams without which the rest cannot reach the cosine threshold, so no pair above the
threshold is missed. Candidates meet at their common prefix grams, and are verified by cosine, edit distance and the
compatibility of door, unit, type, further words of the street, town, state and code.

Equally parsed addresses are one signature, so a hot address is indexed once; it meets its copies only in the final
join that lists the pairs. Weights are document frequencies over all signatures. What words mean is a parameter
(:class:`linkwright.llm.records.Lexicon`).

Defined results: addresses that name no numbered place (null, empty, placeholders, landmarks) are no case; repeated
rows of one record give no pair with themselves; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.llm import records as R
from linkwright.session import cut

#: Least cosine of two street vectors; the prefix bound uses the same value.
COSINE = 0.25
PARSED = "entity_id string, door string, unit string, street string, written string, kind string, more array<string>, towns array<string>, state string, code string"


def _parse(lexicon: R.Lexicon):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["entity_id"], batch["address"]):
                place = R.parse_address(text, lexicon)
                if place is not None:
                    more, towns = (sorted({R.sound(t) for t in words}) for words in (place.more, place.towns))
                    rows.append((key, place.door, place.unit, R.sound(place.street), place.street, place.kind, more, towns, place.state, place.code))
            yield pd.DataFrame(rows, columns=[x.split(" ")[0] for x in PARSED.split(", ")])

    return run


def parsed_places(frame: DataFrame, key: str, address: str, lexicon: R.Lexicon = R.GENERAL) -> DataFrame:
    """One row per record that names a numbered place, with the digest ``sid`` of what it says."""
    source = frame.select(F.col(key).alias("entity_id"), F.col(address).alias("address"))
    source = source.where(F.col("entity_id").isNotNull() & F.col("address").rlike(r"\p{Nd}")).distinct()
    parsed = source.mapInPandas(_parse(lexicon), PARSED)
    return parsed.withColumn("sid", F.xxhash64("door", "unit", "written", "kind", "more", "towns", "state", "code"))


def _alike(a: Column, b: Column) -> Column:
    """Two towns: few edits apart, or one is the stem of the other."""
    most = F.when(F.least(F.length(a), F.length(b)) >= 6, 2).otherwise(1)
    stem = (F.least(F.length(a), F.length(b)) >= 4) & (a.startswith(b) | b.startswith(a))
    return stem | (F.levenshtein(a, b) <= most)


def _states_more(a: str, b: str) -> Column:
    """Whether the street of one has a further word (or its first letter) that the other lacks altogether."""
    others = F.concat(F.col(f"{b}.more"), F.col(f"{b}.towns"), F.array(F.col(f"{b}.street")))

    def initial(x: Column, y: Column) -> Column:
        return (F.least(F.length(x), F.length(y)) == 1) & (x.startswith(y) | y.startswith(x))

    return F.exists(F.col(f"{a}.more"), lambda x: ~F.exists(others, lambda y: _alike(x, y) | initial(x, y)))


def compatible(a: str, b: str, missing_unit: bool = False) -> Column:
    """Whether two parsed places may be the same: nothing that both state differs."""

    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def agrees(name: str) -> Column:
        return (col(a, name) == "") | (col(b, name) == "") | (col(a, name) == col(b, name))

    unit = agrees("unit") if missing_unit else col(a, "unit") == col(b, "unit")
    same_code = (col(a, "code") != "") & (col(a, "code") == col(b, "code"))
    towns = (
        same_code
        | (F.size(col(a, "towns")) == 0)
        | (F.size(col(b, "towns")) == 0)
        | F.exists(col(a, "towns"), lambda x: F.exists(col(b, "towns"), lambda y: _alike(x, y)))
    )
    # North and South Main Street differ; one of them may be Main Street
    streets = ~(_states_more(a, b) & _states_more(b, a))
    return unit & agrees("kind") & agrees("code") & agrees("state") & towns & streets


def close_streets(a: str, b: str) -> Column:
    """Streets few edits apart (a swap of neighbours counts two); one more where both state the same post code."""
    x, y = F.col(f"{a}.written"), F.col(f"{b}.written")
    shorter = F.least(F.length(x), F.length(y))
    more = F.when((F.col(f"{a}.code") != "") & (F.col(f"{a}.code") == F.col(f"{b}.code")), 1).otherwise(0)
    return street_edits(a, b) <= F.when(shorter >= 5, 2).otherwise(1) + more


def street_edits(a: str, b: str) -> Column:
    """Edits between two streets, as written or by sound."""
    return F.least(*[F.levenshtein(F.col(f"{a}.{c}"), F.col(f"{b}.{c}")) for c in ("written", "street")])


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"street": batch["street"], "n": batch["n"], "grams": [list(R.grams(x)) for x in batch["street"]]})


def vectors(signatures: DataFrame, threshold: float = COSINE) -> DataFrame:
    """``(street, vector, prefix)``: the unit vector of each distinct street, rarest gram first, and the grams of its prefix.

    A gram is its 64-bit hash; the squared weight is its inverse document frequency over all signatures.
    """
    streets = signatures.groupBy("street").agg(F.count(F.lit(1)).alias("n"))
    exploded = streets.mapInPandas(_grams, "street string, n long, grams array<string>")
    exploded = exploded.select("street", "n", F.explode(F.transform("grams", lambda g: F.xxhash64(g))).alias("g"))
    total = signatures.agg(F.count(F.lit(1)).alias("total"))
    counts = exploded.groupBy("g").agg(F.sum("n").alias("df"))
    weights = counts.crossJoin(F.broadcast(total)).select("g", F.sqrt(F.log1p(F.col("total") / F.col("df"))).alias("weight"))
    gathered = exploded.join(weights, "g").groupBy("street").agg(F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), "g"))).alias("raw"))
    norm = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda acc, x: acc + x["w"] * x["w"]))
    out = gathered.withColumn("norm", norm).select(
        "street", F.transform("raw", lambda x: F.struct(x["g"].alias("g"), (-x["w"] / F.col("norm")).cast("float").alias("w"))).alias("vector")
    )
    # a gram is in the prefix while the mass from it onwards still reaches the threshold
    left = F.transform("vector", lambda x, i: 1 - F.aggregate(F.slice("vector", 1, i), F.lit(0.0), lambda acc, y: acc + y["w"] * y["w"]))
    prefix = F.filter(F.transform("vector", lambda x: x["g"]), lambda g, i: F.get(left, i) >= threshold * threshold - 1e-6)
    return out.withColumn("prefix", prefix)


def cosine(first: Column, second: Column) -> Column:
    return F.aggregate(
        first,
        F.lit(0.0),
        lambda acc, x: acc + x["w"] * F.coalesce(F.try_element_at(F.filter(second, lambda y: y["g"] == x["g"]), F.lit(1))["w"], F.lit(0.0)),
    )


def similar_places(signatures: DataFrame, threshold: float = COSINE) -> DataFrame:
    """Pairs ``(sid_a, sid_b, cosine)``, smaller first, of different signatures that denote the same place.

    Postings hold little more than hashes; what a pair says is fetched once it has met, and its vectors only when the
    cheap comparisons let it pass.
    """
    index = cut(vectors(signatures, threshold))
    said = signatures
    slim = said.select("sid", "street", "door", "unit", F.xxhash64("code").alias("c"), F.xxhash64("state").alias("s"), F.xxhash64("kind").alias("k"))
    postings = slim.join(index.select("street", "prefix"), "street").select("*", F.explode("prefix").alias("g"))
    postings = postings.select(F.xxhash64("door", "unit", "g").alias("key"), "sid", "c", "s", "k")
    a, b, none = postings.alias("a"), postings.alias("b"), F.xxhash64(F.lit(""))

    def agrees(name: str) -> Column:
        return (F.col(f"a.{name}") == none) | (F.col(f"b.{name}") == none) | (F.col(f"a.{name}") == F.col(f"b.{name}"))

    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.sid") < F.col("b.sid")) & agrees("c") & agrees("s") & agrees("k"))
    met = met.select(F.col("a.sid").alias("sid_a"), F.col("b.sid").alias("sid_b")).distinct()
    full = met.join(said.alias("a"), F.col("sid_a") == F.col("a.sid")).join(said.alias("b"), F.col("sid_b") == F.col("b.sid"))
    full = full.where((F.col("a.door") == F.col("b.door")) & compatible("a", "b") & close_streets("a", "b"))
    full = full.select("sid_a", "sid_b", F.col("a.street").alias("street_a"), F.col("b.street").alias("street_b"))
    x = index.select(F.col("street").alias("street_a"), F.col("vector").alias("vector_a"))
    y = index.select(F.col("street").alias("street_b"), F.col("vector").alias("vector_b"))
    found = full.join(x, "street_a").join(y, "street_b").select("sid_a", "sid_b", cosine(F.col("vector_a"), F.col("vector_b")).alias("cosine"))
    return found.where(F.col("cosine") >= threshold)


def same_place_pairs(frame: DataFrame, key: str, address: str, lexicon: R.Lexicon = R.GENERAL) -> DataFrame:
    """Pairs ``(entity_id_a, entity_id_b)`` of different records, smaller id first, whose addresses denote one place."""
    places = cut(parsed_places(frame, key, address, lexicon))
    signatures = places.dropDuplicates(["sid"]).drop("entity_id")
    links = similar_places(signatures).select("sid_a", "sid_b")
    members = places.select("sid", "entity_id").distinct()
    left = members.select(F.col("sid").alias("sid_a"), F.col("entity_id").alias("x"))
    right = members.select(F.col("sid").alias("sid_b"), F.col("entity_id").alias("y"))
    between = links.join(left, "sid_a").join(right, "sid_b").select("x", "y")
    within = left.join(right, F.col("sid_a") == F.col("sid_b")).where(F.col("x") < F.col("y")).select("x", "y")
    pairs = between.unionByName(within).where(F.col("x") != F.col("y"))
    return pairs.select(F.least("x", "y").alias("entity_id_a"), F.greatest("x", "y").alias("entity_id_b")).distinct()

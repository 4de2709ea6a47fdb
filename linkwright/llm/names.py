"""Variant spellings of names typed by people.

Each name is parsed to its distinctive words (spellings of one sound made alike), given name, initials and trade. The
distinct word sets are joined by tries: a word one edit away keeps its first three or its last three letters (or, when
short, some letters of both ends), so each pair of words is sharded under every combination of these parts, in the
parts' own order, which also covers reordered words; with both edits in one of two words the other is whole. Names of
many words meet by two whole ones. Each shard is a trie that a Levenshtein automaton (with swaps of
neighbours) walks once for every name of the shard. Words glued together are sharded as one long word; single words
meet each other and glued words under keys that survive any two edits. Links between word sets are then verified on given name, initials and trade.

Shards of up to ``PAIRED`` names need no trie: their names meet in a join, and Spark's edit distance rules out nearly all pairs.
Names of two words are first sharded by each word whole, and by its ends too only where more names share the word.
A shard with more than ``block`` names is split into blocks that meet pairwise, so no task holds more than two blocks.

Defined results: names that are only a trade, placeholders, null and empty names are no case; equal spellings are no
pair; a single word under five letters, and a word under four beside others, allows one edit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.llm import records as R
from linkwright.llm.leakage import edits
from linkwright.session import cut

#: Names in one block of a shard, and the most edits between two word sets.
BLOCK = 2000
EDITS = 2
#: Letters of each end of a long word that its keys are made of, and the least letters of a single word with two edits.
ENDS, TWO_EDITS = 5, 5
#: Most keys of single words that are sent to every task (8 bytes each); more of them are joined by a shuffle.
SMALL = 500_000
#: Most names of a shard that meet in a join; larger shards are walked as tries.
PAIRED = 100
#: Letters of a word from which it may have both edits.
LEAST_TWICE = 4
#: From so many words on, names meet by all words but two; from so many on, by two that are neighbours in order.
FEW, MANY = 4, 16
PARSED = "entity_id string, name string, core string, given string, initials array<string>, given_letters array<string>, trade string"


class Trie:
    """Words in a prefix tree; ``near`` walks it with a Levenshtein automaton that also allows swapped neighbours.

    The automaton is kept bit-parallel: bit ``j`` of state ``d`` says that the first ``j`` letters of the query match
    the path so far with ``d`` edits. It knows up to two edits.
    """

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str, item: object) -> None:
        node = self.root
        for char in word:
            node = node.setdefault(char, {})
        node.setdefault("", []).append(item)

    def near(self, word: str, most: int = EDITS) -> list[tuple[object, int]]:
        """Items whose word is at most ``most`` edits away, with the distance."""
        if not 0 <= most <= 2:
            raise ValueError("the automaton knows up to two edits")
        size = len(word)
        where: dict[str, int] = {}
        for j, char in enumerate(word):
            where[char] = where.get(char, 0) | 1 << j
        letters, full, last = where.get, (2 << size) - 1, 1 << size
        out: list[tuple[object, int]] = []
        stack = [(self.root, 1, 3 & full, 7 & full, 0, 0, 0)]
        while stack:
            # states with 0, 1 and 2 edits; the states 0 and 1 a letter earlier, and where that letter stands
            node, zero, one, two, zero_before, one_before, before = stack.pop()
            for char, child in node.items():
                if char == "":
                    distance = 0 if zero & last else 1 if one & last else 2 if two & last else 3
                    if distance <= most:
                        out.extend((item, distance) for item in child)
                    continue
                here = letters(char, 0)
                swap = here & before >> 1
                a = (zero & here) << 1
                b = ((one & here) << 1 | zero | zero << 1 | a << 1 | (zero_before & swap) << 2) & full
                c = ((two & here) << 1 | one | one << 1 | b << 1 | (one_before & swap) << 2) & full
                if a or b or c and most > 1:
                    stack.append((child, a, b, c, zero, one, here))
        return out


def parts(word: str) -> list[str]:
    """Parts of a word of which one survives any single edit or swap: three letters at an end, in short words also what
    stays when an edit falls between, and in very short ones every form with a letter left out."""
    out = [f"^{word[:3]}", f"{word[-3:]}$"]
    if len(word) <= 6:
        out.append(f"{word[:2]}~{word[-2:]}")
    if len(word) <= 5:
        out.append(f"{word[:1]}~~{word[-1:]}")
    if len(word) <= 3:
        out.extend(sorted({word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}))
    return out


def edit_keys(word: str) -> set[str]:
    """Keys of which any two words up to two edits apart share one.

    Short words have all forms with up to two letters left out. Of two edits in longer ones at most one touches the
    first five letters, or at most one the last five, so these have the forms with one of those letters left out.
    """
    out = set()
    if len(word) <= 2 * ENDS + 1:
        for n in range(min(2, len(word) - 1) + 1):
            for gone in combinations(range(len(word)), n):
                out.add("".join(c for i, c in enumerate(word) if i not in gone))
    if len(word) >= 2 * ENDS:
        head, tail = word[:ENDS], word[-ENDS:]
        for i in range(ENDS):
            out.update((f"^{head[:i]}{head[i + 1 :]}", f"{tail[:i]}{tail[i + 1 :]}$"))
    return out


#: Least and most letters of two words that meet by ends of the third length: the shorter one has twice that at least.
HALVES = ((12, 15, 6), (14, 17, 7), (16, 1 << 30, 8))


def half_keys(text: str, ends: int, mark: str) -> set[str]:
    head, tail = text[:ends], text[-ends:]
    return {key for i in range(ends) for key in (f"{mark}^{head[:i]}{head[i + 1 :]}", f"{mark}{tail[:i]}{tail[i + 1 :]}$")}


def single_keys(text: str, glued: bool) -> set[str]:
    """Keys of which a single word shares one with any single word or two glued ones up to two edits apart.

    Up to 11 letters all forms with up to two letters left out meet, from 12 on forms of the halves with one left out.
    Between these lie the ends of ``ENDS`` letters, marked by who is the long one: S a glued one, T a single word.
    """
    size, out = len(text), set()
    if size <= 2 * ENDS + 1:
        out.update(key for key in edit_keys(text) if key[0] != "^" and key[-1] != "$")
    if 2 * ENDS <= size <= 2 * ENDS + 3:
        for mark in ("S" if glued else "T") if size > 2 * ENDS + 1 else ("T" if glued else "ST"):
            out |= half_keys(text, ENDS, mark)
    for least, longest, ends in HALVES:
        if least <= size <= longest:
            out |= half_keys(text, ends, str(ends))
    return out


def shards(core: str, ends: bool = True) -> Iterator[tuple[str, str]]:
    """``(shard, text)`` of a word set: the text puts the words in the order of the shard's parts.

    Without ``ends``, names of two words lack the shards of one whole word."""
    words = core.split(" ")
    if len(words) >= FEW:
        # two edits touch two words at most: all others are the shard, these two the text
        for chosen in (*combinations(range(len(words)), 2), *((i,) for i in range(len(words)))) if len(words) < MANY else ():
            whole = " ".join(w for i, w in enumerate(words) if i not in chosen)
            for order in {chosen, chosen[::-1]}:
                yield f"+{whole}", " ".join(words[i] for i in order)
        if len(words) >= MANY - 2:
            # of so many words in alphabetical order two neighbours stay neighbours
            for a, b in zip(words, words[1:]):
                yield f"*{a} {b}", core
        return
    pairs = list(combinations(words, 2))
    seen = set()
    for a, b in pairs:
        rest = " ".join(sorted(w for w in words if w not in (a, b)))
        for x in parts(a):
            for y in parts(b):
                for p, q, text in ((x, y, f"{a} {b}"), (y, x, f"{b} {a}")):
                    if p <= q:
                        row = (f"{p}|{q}", f"{text} {rest}".strip())
                        if row not in seen:
                            seen.add(row)
                            yield row
    if ends and len(words) == 2:
        # both edits in one word leave the other whole
        for a, b in (words, words[::-1]):
            for key in end_keys(b):
                yield f"{a}&{key}", f"{a} {b}"


def end_keys(word: str) -> set[str]:
    """Keys of which two words up to two edits apart share one: of both edits at most one touches the first letters, or
    at most one the last ones, and three letters (two in short words) with one edit share two (one)."""
    out = set()
    if len(word) <= 5:
        out.update((f"^{word[0]}", f"^{word[1:2]}", f"{word[-1]}$", f"{word[-2:-1]}$"))
    if len(word) >= 4:
        head, tail = word[:3], word[-3:]
        for k in range(3):
            out.update((f"^{head[:k]}{head[k + 1 :]}", f"{tail[:k]}{tail[k + 1 :]}$"))
    return out


def glued_ends(core: str) -> set[str]:
    """Both ends of one or two words glued together; single words and glued ones share one."""
    words = core.split(" ")
    glued = {"".join(words), "".join(reversed(words))} if len(words) <= 2 else ()
    return {end for x in glued if len(x) >= 8 for end in (f"={x[:5]}", f"={x[-5:]}$")}


def _parse(lexicon: R.Lexicon):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["entity_id"], batch["name"]):
                name = R.parse_name(text, lexicon)
                if name is None or name.generic or not name.core:
                    continue
                core = " ".join(sorted({R.sound(w) for w in name.core}))
                letters = sorted(lexicon.given_letters.get(name.given, ()))
                rows.append((key, text, core, name.given, sorted(set(name.initials)), letters, name.trade))
            yield pd.DataFrame(rows, columns=[x.split(" ")[0] for x in PARSED.split(", ")])

    return run


def parsed_names(frame: DataFrame, key: str, name: str, lexicon: R.Lexicon = R.GENERAL) -> DataFrame:
    """One row per record with an identifying name."""
    source = frame.select(F.col(key).alias("entity_id"), F.col(name).alias("name"))
    return source.where(F.col("entity_id").isNotNull() & (F.trim("name") != "")).distinct().mapInPandas(_parse(lexicon), PARSED)


def _shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(core, shard, text) for core in batch["core"] for shard, text in shards(core, ends=False)]
        yield pd.DataFrame(rows, columns=["core", "shard", "text"])


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shards of the first word of the text whole and the ends of the second."""
    for batch in batches:
        rows = []
        for core, text in zip(batch["core"], batch["text"]):
            a, b = text.split(" ")
            rows.extend((core, f"{a}&{key}", text) for key in end_keys(b))
        yield pd.DataFrame(rows, columns=["core", "shard", "text"])


def _single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shards of single words, and of two words glued."""
    for batch in batches:
        rows = []
        for core in batch["core"]:
            words = core.split(" ")
            if len(words) <= 2:
                for text in {"".join(words), "".join(reversed(words))}:
                    rows.extend((core, key, text) for key in single_keys(text, len(words) > 1))
        yield pd.DataFrame(rows, columns=["core", "shard", "text"])


def _long_glued(frame: DataFrame) -> DataFrame:
    """What ``_single`` gives for two words glued to more than ``2 * ENDS + 1`` letters."""
    words = F.split("core", " ")
    texts = frame.select("core", F.explode(F.array(F.array_join(words, ""), F.array_join(F.reverse(words), ""))).alias("text"))

    def keyed(least: int, longest: int, ends: int, mark: str) -> DataFrame:
        head, tail = F.substring("text", 1, ends), F.substring("text", -ends, ends)

        def without(end: Column, i: int) -> Column:
            return F.concat(F.substring(end, 1, i), F.substring(end, i + 2, ends))

        keys = [F.concat(F.lit(f"{mark}^"), without(head, i)) for i in range(ends)] + [F.concat(F.lit(mark), without(tail, i), F.lit("$")) for i in range(ends)]
        return texts.where(F.length("text").between(least, longest)).select("core", F.explode(F.array_distinct(F.array(*keys))).alias("shard"), "text")

    out = keyed(2 * ENDS + 2, 2 * ENDS + 3, ENDS, "S")
    for least, longest, ends in HALVES:
        out = out.unionByName(keyed(least, longest, ends, str(ends)))
    return out


def words_apart(a: str, b: str, most: int) -> int:
    """Edits between the words that two word sets do not share, in their better order; ``most + 1`` where it is more."""
    x, y = a.split(" "), b.split(" ")
    own, other = [w for w in x if w not in y], [w for w in y if w not in x]
    if len(own) > 2 or len(other) > 2:
        return most + 1
    orders = {tuple(own), tuple(own[::-1])}
    return min(min(edits(" ".join(o), " ".join(other), most) for o in orders), most + 1)


def _walk(rows: list[tuple], most: int) -> Iterator[tuple[str, str, int]]:
    if len(rows) < 2:
        return
    if all(core.count(" ") >= MANY - 3 for core, *_ in rows):
        first, second = rows[0][3], rows[0][4]
        for core, _, block, _, _ in rows:
            for other, _, place, _, _ in rows:
                if block == first and place == second and core != other and (core < other or first != second):
                    if (distance := words_apart(core, other, most)) <= most:
                        yield (core, other, distance) if core < other else (other, core, distance)
        return
    trie = Trie()
    first, second = rows[0][3], rows[0][4]
    if first != second:
        for core, text, block, _, _ in rows:
            if block == first:
                trie.add(text, core)
    for core, text, block, _, _ in rows:
        if block == second:
            for other, distance in trie.near(text, most) if trie.root else ():
                if other != core:
                    yield (other, core, distance) if other < core else (core, other, distance)
            if first == second:
                # each name meets those before it
                trie.add(text, core)


def _walk_single(rows: list[tuple], most: int) -> Iterator[tuple[str, str, int]]:
    """Pairs of a single word and any other entry; two glued pairs of words have shards of their own."""
    trie = Trie()
    for core, text, _, _, _ in rows:
        if " " not in core:
            trie.add(text, core)
    if trie.root:
        for core, text, _, _, _ in rows:
            for other, distance in trie.near(text, most):
                if other != core:
                    yield (other, core, distance) if other < core else (core, other, distance)


def _join(most: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, rows, out = None, [], []

        def walked() -> Iterator[tuple[str, str, int]]:
            return (_walk_single if group and group[1] else _walk)(rows, most)

        for batch in batches:
            for shard, single, core, text, block, i, j in zip(*(batch[c] for c in ("shard", "single", "core", "text", "block", "i", "j"))):
                if (shard, single, i, j) != group:
                    out.extend(walked())
                    group, rows = (shard, single, i, j), []
                rows.append((core, text, block, i, j))
            yield pd.DataFrame(out, columns=["a", "b", "distance"])
            out = []
        yield pd.DataFrame(list(walked()), columns=["a", "b", "distance"])

    return run


def apart(a: str, b: str, most: int) -> int:
    """Edit distance, or ``most + 1`` where it is more; equal ends add nothing to it."""
    first, short = 0, min(len(a), len(b))
    while first < short and a[first] == b[first]:
        first += 1
    last = 0
    while last < short - first and a[-1 - last] == b[-1 - last]:
        last += 1
    return edits(a[first : len(a) - last], b[first : len(b) - last], most)


def _settle(most: int):
    """Distances that count a swap of neighbours as one edit, where Spark's count it as two."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for a, b, text, other, distance in zip(*(batch[c] for c in ("a", "b", "text", "other", "distance"))):
                # a single swap keeps the letters
                if distance > most or distance > 1 and sorted(text) == sorted(other):
                    distance = apart(text, other, most)
                if distance <= most:
                    rows.append((a, b, distance))
            yield pd.DataFrame(rows, columns=["a", "b", "distance"])

    return run


def _paired(entries: DataFrame, most: int) -> DataFrame:
    """Pairs of names that share a shard, as ``_walk`` and ``_walk_single`` find them."""
    # letters as bits (other scripts share them): an edit takes away one letter at most and adds one at most
    mask = F.aggregate(F.split("text", ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c))))
    marked = entries.select("shard", "single", "core", "text", mask.alias("mask"))
    one = ~F.col("core").contains(" ")
    # in a shard of single words each of them meets all others
    x = marked.where(~F.col("single") | one).select("shard", "single", F.col("core").alias("a"), "text", "mask")
    y = marked.select("shard", "single", F.col("core").alias("b"), F.col("text").alias("other"), F.col("mask").alias("bits"), (F.col("single") & ~one).alias("glued"))
    met = x.join(y.hint("merge"), ["shard", "single"])
    for gone in (F.col("mask").bitwiseAND(F.bitwise_not("bits")), F.col("bits").bitwiseAND(F.bitwise_not("mask"))):
        met = met.where(F.bit_count(gone) <= most)
    met = met.where((F.abs(F.length("text") - F.length("other")) <= most) & ((F.col("a") < F.col("b")) | F.col("glued")))

    def letters(text: str) -> Column:
        return F.array_join(F.array_sort(F.split(text, "")), "")

    # a swap counts two in Spark's distance and nothing among the sorted letters, any other edit two at most there
    plain, swapped = F.levenshtein("text", "other", 2 * most), F.levenshtein(letters("text"), letters("other"), 2 * most - 2)
    met = met.where((plain >= 0) & ((plain <= most) | (swapped >= 0)))
    met = met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "text", "other").agg(F.min(plain).alias("distance"))
    return met.mapInPandas(_settle(most), "a string, b string, distance int")


def near_cores(cores: DataFrame, most: int = EDITS, block: int = BLOCK, paired: int = PAIRED) -> DataFrame:
    """Pairs ``(a, b, distance)``, a before b, of different word sets at most ``most`` edits apart, in any word order."""
    distinct, kind = cut(cores.select("core").distinct()), "core string, shard string, text string"
    n, words = F.col("n"), F.split("core", " ")

    def placed_in(frame: DataFrame, single: bool) -> DataFrame:
        return frame.select(F.xxhash64("shard").alias("shard"), F.lit(single).alias("single"), "core", "text")

    both = F.explode(F.array(F.array(words[0], words[1]), F.array(words[1], words[0]))).alias("order")
    whole = distinct.where(F.size(words) == 2).select("core", both).select("core", F.col("order")[0].alias("shard"), F.array_join("order", " ").alias("text"))
    whole = cut(placed_in(whole, False))
    sharing = cut(whole.groupBy("shard", "single").agg(F.count(F.lit(1)).alias("n")).where(n > 1))
    # a word of very many names: only those whose other words have an end in common meet
    hot = whole.join(sharing.where(n > paired).hint("merge"), ["shard", "single"], "left_semi").select("core", "text")
    entries = placed_in(distinct.mapInPandas(_shard, kind), False).unionByName(placed_in(hot.mapInPandas(_ends, kind), False))
    # glued words need these shards only where a single word stands in them
    singles = placed_in(distinct.where(~F.col("core").contains(" ")).mapInPandas(_single, kind), True)
    two = distinct.where(F.size(words) == 2)
    long = F.length("core") > 2 * ENDS + 2
    glued = placed_in(two.where(~long).mapInPandas(_single, kind), True).unionByName(placed_in(_long_glued(two.where(long)), True))
    singles = cut(singles)
    wanted = singles.select("shard").distinct()
    if singles.count() <= SMALL:
        wanted = F.broadcast(wanted)
    entries = cut(entries.unionByName(singles).unionByName(glued.join(wanted, "shard", "left_semi").select(singles.columns)))
    spaces = F.length("core") - F.length(F.replace("core", F.lit(" ")))
    counts = cut(entries.groupBy("shard", "single").agg(F.count(F.lit(1)).alias("n"), F.max(spaces).alias("spaces")).where(n > 1))
    few = (n <= paired) & (F.col("spaces") < MANY - 3)
    joined = _paired(entries.join(counts.where(few).hint("merge"), ["shard", "single"], "left_semi"), most)
    rest = whole.withColumn("text", F.substring_index("text", " ", -1))
    joined = joined.unionByName(_paired(rest.join(sharing.where(n <= paired).hint("merge"), ["shard", "single"], "left_semi"), most))
    blocks = counts.where(~few).select("shard", "single", F.ceil(n / block).cast("int").alias("k"))
    placed = entries.join(blocks.hint("merge"), ["shard", "single"]).withColumn("block", F.pmod(F.xxhash64("core"), F.col("k")).cast("int"))
    partners = F.sequence(F.lit(0), F.col("k") - 1)
    placed = placed.select("shard", "single", "core", "text", "block", F.explode(partners).alias("other"))
    placed = placed.select("shard", "single", "core", "text", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    ordered = placed.repartition("shard", "single", "i", "j").sortWithinPartitions("shard", "single", "i", "j")
    walked = ordered.mapInPandas(_join(most), "a string, b string, distance int")
    found = walked.unionByName(joined).groupBy("a", "b").agg(F.min("distance").alias("distance"))
    single = ~F.col("a").contains(" ") | ~F.col("b").contains(" ")
    a, b = F.split("a", " "), F.split("b", " ")
    own, other = F.array_except(a, b), F.array_except(b, a)
    short = ~single & (F.size(own) == 1) & (F.size(other) == 1) & (F.least(F.length(own[0]), F.length(other[0])) < LEAST_TWICE)
    return found.where((F.col("distance") <= 1) | ~short & (~single | (F.least(F.length("a"), F.length("b")) >= TWO_EDITS)))


def same_bearer(a: str, b: str) -> Column:
    """Nothing that both names state differs: trade, given name, initials."""

    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def agrees(name: str) -> Column:
        return (col(a, name) == "") | (col(b, name) == "") | (col(a, name) == col(b, name))

    def initial(one: str, other: str) -> Column:
        # an initial fits the other's given name, whatever its short form, or one of its initials
        stated = F.concat(col(other, "given_letters"), col(other, "initials"))
        return (F.size(col(one, "initials")) == 0) | (F.size(stated) == 0) | F.arrays_overlap(col(one, "initials"), stated)

    return agrees("trade") & agrees("given") & initial(a, b) & initial(b, a)


def variant_pairs(frame: DataFrame, key: str, name: str, lexicon: R.Lexicon = R.GENERAL) -> DataFrame:
    """Pairs ``(entity_id_a, entity_id_b)``, smaller id first, of records whose differing names mean the same bearer.

    Spellings are compared, not records: a name that very many records bear is compared once, and its bearers only
    meet where the result lists them.
    """
    bearers = cut(parsed_names(frame, key, name, lexicon).withColumn("spelling", F.xxhash64("name", "core", "given", "initials", "trade")))
    spellings = cut(bearers.drop("entity_id").dropDuplicates(["spelling"]))
    links = near_cores(spellings).select("a", "b")
    names = spellings.select("core").distinct()
    same = names.select(F.col("core").alias("a"), F.col("core").alias("b"))
    x, y = spellings.alias("x"), spellings.alias("y")
    met = links.unionByName(same).join(x, F.col("a") == F.col("x.core")).join(y, F.col("b") == F.col("y.core"))
    # within one core each two spellings are met twice
    met = met.where((F.col("x.name") != F.col("y.name")) & ((F.col("a") != F.col("b")) | (F.col("x.spelling") < F.col("y.spelling"))))
    met = met.where(same_bearer("x", "y")).select(F.col("x.spelling").alias("one"), F.col("y.spelling").alias("other"))
    left = bearers.select(F.col("spelling").alias("one"), F.col("entity_id").alias("i"))
    right = bearers.select(F.col("spelling").alias("other"), F.col("entity_id").alias("j"))
    pairs = met.join(left, "one").join(right, "other").where(F.col("i") != F.col("j"))
    return pairs.select(F.least("i", "j").alias("entity_id_a"), F.greatest("i", "j").alias("entity_id_b")).distinct()

"""Evaluation texts leaking into training text.

Each document is scanned once by one Aho-Corasick automaton, as its words in letters and digits without what may stand
between passages, so case, punctuation, markup, cue numbers, times and line breaks do not matter. The automaton holds
every two neighbouring words of every item, however common, apart and glued. Where three of them that one item holds
stand close to each other, the document is aligned with the item in both directions: item words must follow one
another, where single words may be damaged, glued or broken in two. A passage counts from ``least`` running item words;
its offsets are those of the original text. Nothing is chosen by rarity; damage that is not isolated (fewer than three
whole pairs of neighbouring words in a passage) may hide a passage.

Letters with accents, and what wrong encodings make of them, vanish on both sides; letters of other scripts stay.

Items are held by the driver in blocks of ``block`` (a parameter with a proven bound); more items mean more scans of
the corpus, each against all documents.

Defined results: null and empty texts hold nothing; items shorter than ``least`` words cannot leak; repeated documents
are reported each; long texts are scanned whole.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.confusables import fold_text

#: Running item words that make a leak, and items held at once.
LEAST, BLOCK = 12, 20_000
_DROP = bytes(c for c in range(128) if not chr(c).isalnum())
_DROP_WORDS = _DROP.replace(b" ", b"")
_LOWER = bytes(ord(chr(c).lower()) if c < 128 else c for c in range(256))

# What stands between passages without interrupting them; replaced by blanks of the same length.
NOISE = re.compile(
    r"<[^>\n]{0,200}>|\{[^}\n]{0,200}\}|\[[^\]\n]{0,200}\]|\([^)\n]{0,200}\)|^[ \t﻿]*\d+[ \t\r]*$|^[^\n]{0,60}--?>[^\n]*$|^﻿?WEBVTT[^\n]*$"
    r"|^[^\n]*(?:www\.|https?:|@)[^\n]*$|^[^\n]*(?i:subtitles? by|synced|downloaded from|untertitel von|sous-titres|subt[ií]tulos|उपशीर्षक|sync by|corrected by)[^\n]*$"
    r"|[♪♫|]|^[ \t]*[-–—][ \t]+|^[ \t]*[A-ZÀ-Þ][A-ZÀ-Þ .']{1,20}:(?=\s)",
    re.M,
)
_WORD = re.compile(r"\S+")
# Letters beyond the Latin ones; what is neither such a letter nor a plain letter, digit or blank.
_OTHER_LETTERS = re.compile(r"[\u0370-\u1dff\u2c00-\u2dff\u3040-\ud7ff\uf900-\ufaff\U00010000-\U0001efff]")
_DROP_OTHER = re.compile(r"[^\w\s]|[_\x80-\u036f]|[\u1e00-\u2bff]")
# Characters that the consistent form of a composed text leaves as they are.
_USUAL = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
# A text without any other character than these has no look-alikes.
_ODD = re.compile(r"[^\x00-\x7f\xa1-\xff\u0900-\u097fŒœ‘’“”–—…♪♫।]")
# Letters that optical recognition confuses.
_OCR = (("rn", "m"), ("vv", "w"), ("li", "h"), ("ii", "u"), ("cl", "d"), ("0", "o"), ("1", "l"), ("5", "s"), ("i", "l"), ("c", "e"))


def reduced(text: str) -> str:
    """Letters and digits of a text, in lower case; accented letters and wrong encodings of them vanish."""
    if _OTHER_LETTERS.search(text):
        return "".join(_DROP_OTHER.sub("", text.lower()).split())
    return text.encode("ascii", "ignore").translate(_LOWER, _DROP).decode("ascii")


def _composed(text: str) -> str:
    return text if text.isascii() else unicodedata.normalize("NFC", text)


def item_words(text: str) -> list[str]:
    return [w for w in (reduced(x) for x in _WORD.findall(_composed(text))) if w]


def document_words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Words of a document without what does not interrupt a passage, with their offsets."""
    clean = NOISE.sub(lambda m: " " * (m.end() - m.start()), text)
    words, places = [], []
    for m in _WORD.finditer(clean):
        word = reduced(m.group())
        if word:
            words.append(word)
            places.append(m.span())
    return words, places


def words_alone(text: str) -> list[str]:
    """The words of ``document_words`` without their offsets."""
    clean = NOISE.sub(" ", text)
    if _OTHER_LETTERS.search(clean):
        return [w for x in clean.split() if (w := reduced(x))]
    return " ".join(clean.split()).encode("ascii", "ignore").translate(_LOWER, _DROP_WORDS).decode("ascii").split()


def _ocr(word: str) -> str:
    for a, b in _OCR:
        word = word.replace(a, b)
    return word


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, or ``most + 1`` where it is more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            cost = min(new[j - 1] + 1, row[j] + 1, row[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                cost = min(cost, before[j - 2] + 1)
            new.append(cost)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return row[-1]


@lru_cache(maxsize=500_000)
def damaged(word: str, true: str) -> bool:
    """Whether a document word may be a damaged form of an item word. Two numbers differ, however close."""
    if word == true:
        return True
    if word.isdigit() and true.isdigit():
        return False
    if _ocr(word) == _ocr(true):
        return True
    if any(c.isdigit() for c in true):
        return False
    most = max(1, len(true) // 3)
    return edits(word, true, most) <= most


def extended(words: list[str], item: list[str], start: int, first: int, seen: set[tuple[int, int]], step: int = 1) -> tuple[int, int]:
    """Item words that follow one another from a document word and an item word on, and the last document word.

    With ``step`` -1 they follow one another backwards.
    """
    n, m = len(words), len(item)

    def word(p: int) -> str | None:
        return words[p] if 0 <= p < n else None

    def true(q: int) -> str | None:
        return item[q] if 0 <= q < m else None

    def joined(*parts: str | None) -> str | None:
        return None if None in parts else "".join(parts if step > 0 else parts[::-1])

    p, q, last_p, last_q, gap = start, first, start - step, first - step, 0
    while (here := word(p)) is not None and (wanted := true(q)) is not None:
        if here == wanted:
            seen.add((p, q))
            last_p, last_q, gap = p, q, 0
            p, q = p + step, q + step
            continue
        two = joined(wanted, true(q + step))
        if here == two:
            last_p, last_q, gap = p, q + step, 0
            p, q = p + step, q + 2 * step
            continue
        if two is not None and here == joined(wanted, true(q + step), true(q + 2 * step)):
            last_p, last_q, gap = p, q + 2 * step, 0
            p, q = p + step, q + 3 * step
            continue
        broken = joined(here, word(p + step))
        if broken == wanted:
            last_p, last_q, gap = p + step, q, 0
            p, q = p + 2 * step, q + step
            continue
        if gap >= 2 or gap == 1 and not (word(p + step) is not None and word(p + step) == true(q + step)):
            break
        if damaged(here, wanted):
            gap, p, q = gap + 1, p + step, q + step
        elif two is not None and damaged(here, two):
            gap, p, q = gap + 1, p + step, q + 2 * step
        elif broken is not None and damaged(broken, wanted):
            gap, p, q = gap + 1, p + 2 * step, q + step
        else:
            break
    return (last_q - first) * step + 1, last_p


class Items:
    """Items of one block, and the automaton of every two neighbouring words of theirs."""

    def __init__(self, rows: list[tuple[int, str]], least: int = LEAST) -> None:
        known = {key: words for key, text in rows if len(words := item_words(text or "")) >= least}
        self.keys, self.words, self.least = list(known), list(known.values()), least

    def automaton(self):
        """The automaton, whose hits are ``(letters before the last blank, item set, {item: places})``.

        An item set is an integer with the bit of every item.
        """
        import ahocorasick

        places: dict[str, dict[int, list[int]]] = {}
        for item, words in enumerate(self.words):
            for q in range(len(words) - 1):
                for pattern in (f" {words[q]} {words[q + 1]} ", f" {words[q]}{words[q + 1]} "):
                    places.setdefault(pattern, {}).setdefault(item, []).append(q)
        if not places:
            return None
        out = ahocorasick.Automaton()
        for pattern, own in places.items():
            items = 0
            for item in own:
                items |= 1 << item
            out.add_word(pattern, (len(pattern) - 1, items, own))
        out.make_automaton()
        return out

    def passages(self, words: list[str], automaton) -> dict[int, tuple[int, int, int]]:
        """By item, the most running words of it found in a document, if enough, with the first and last document word."""
        best: dict[int, tuple[int, int, int]] = {}
        if automaton is None or len(words) < 2:
            return best
        hits = list(automaton.iter(f" {' '.join(words)} "))
        once = twice = thrice = 0
        for _, (_, items, _) in hits:
            thrice |= twice & items
            twice |= once & items
            once |= items
        if not thrice:
            return best
        starts = list(accumulate((len(w) + 1 for w in words), initial=0))
        at = [bisect_right(starts, end - size) - 1 for end, (size, _, _) in hits]
        seen: dict[int, set[tuple[int, int]]] = {}
        for i, (_, (_, items, own)) in enumerate(hits):
            p, one, two = at[i], 0, 0
            # the first whole pair of a passage has two more after it, not farther than its words, some broken in two
            for j in range(i + 1, len(hits)):
                if at[j] > p + self.least + 2:
                    break
                two |= one & hits[j][1][1]
                one |= hits[j][1][1]
            both = items & two
            while both:
                item = (both & -both).bit_length() - 1
                both &= both - 1
                met = seen.setdefault(item, set())
                for q in own[item]:
                    if (p, q) in met:
                        continue
                    after, last = extended(words, self.words[item], p, q, met)
                    before, first = extended(words, self.words[item], p - 1, q - 1, met, -1)
                    size = after + before
                    if size >= self.least and size > best.get(item, (0,))[0]:
                        best[item] = (size, first, last)
        return {self.keys[item]: found for item, found in best.items()}


def _scan(items: Items, key: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = items.automaton()
        for batch in batches:
            rows = []
            for doc, text in zip(batch[key], batch["text"]):
                if not text or automaton is None:
                    continue
                text = _composed(text)
                words = words_alone(text)
                found = items.passages(words, automaton)
                if found:
                    places = document_words(text)[1]
                    rows.extend((item, doc, size, places[first][0], places[last][1]) for item, (size, first, last) in found.items())
                if _ODD.search(text) and (folded := fold_lines(text)) != text and (again := words_alone(folded)) != words:
                    # look-alike letters would break a passage: once more over the consistent form
                    more = {item: at for item, at in items.passages(again, automaton).items() if item not in found}
                    if more:
                        places = document_words(folded)[1]
                        rows.extend((item, doc, size, places[first][0], places[last][1]) for item, (size, first, last) in more.items())
            yield pd.DataFrame(rows, columns=["item_id", key, "words", "first_char", "end_char"])

    return run


def fold_lines(text: str) -> str:
    """The consistent form with line breaks kept."""
    return "\n".join(line if _USUAL.fullmatch(line) else fold_text(line) or "" for line in text.split("\n"))


def leaks(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """``(item_id, <key>, words, first_char, end_char)`` of every document that holds a passage of an item."""
    source = documents.select(key, F.col(text).alias("text")).where(F.length("text") > 0)
    total = items.count()
    blocks = max(1, -(-total // block))
    kind = dict(documents.dtypes)[key]
    schema = f"item_id bigint, {key} {kind}, words int, first_char int, end_char int"
    parts = []
    for i in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i).select("item_id", "item_text").collect()
        parts.append(source.mapInPandas(_scan(Items([tuple(r) for r in rows], least), key), schema))
    return reduce(DataFrame.unionByName, parts)

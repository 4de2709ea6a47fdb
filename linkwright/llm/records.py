"""Parsing of typed business records: what an address and a name say, in one comparable form.

Plain Python, run inside Arrow batches. Every function returns a defined result for any text: null, empty and
placeholder texts parse to nothing.

What words mean (street types, legal forms, trades, given names, regions) stands in a :class:`Lexicon`, a parameter of
every operator. ``GENERAL`` holds everyday words of the three countries and no places; ``EMPTY`` knows nothing, so every
word is a name and matching rests on spelling, numbers and structure alone.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

from linkwright.llm.confusables import fold_text

# ---------------------------------------------------------------------------------------------- fixed values

#: Street types with their written forms, first the common name.
STREET_TYPES = """
street st str streat | road rd roed | avenue av ave avn | lane ln la | drive dr drv | court ct crt
boulevard blvd boul bd bld bvd | parkway pkwy pky | bazaar bazar bzr | cross crs x | marg maarg mg
rue r | chemin che chem ch | impasse imp | place pl plc | square sq | highway hwy | terrace ter | circle cir | way wy | quai | allee all | cours
"""
#: Words before a unit number, and buildings, localities, landmarks.
UNIT_WORDS = "shop unit suite ste sno local lot apt apartment flat room office"
DOOR_WORDS = "no number num door plot house hno dno bldg n"
BUILDINGS = "arcade complex tower towers market chambers plaza center centre building bldg mall"
BUILDINGS_BEFORE = "residence galerie batiment"
LOCALITIES = "layout pet nagar extension extn colony"
LANDMARK_WORDS = "near nr opp opposite above beside behind next"
LANDMARK_REST = "to the bus stand railway stn station petrol pump govt government school post office grameen bank atm shiva temple old mill clock hospital church park"
FRENCH_TYPES = "rue chemin impasse place quai allee cours"
ARTICLES = frozenset("de la le les du des d l".split())
ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth".split()

#: Legal forms, salutations and other words that do not tell one business from another.
LEGAL = "inc incorporated llc llp corp corporation co company ltd limited pvt private p plc sarl sas sa eurl sasu sci snc regd registered gmbh"
SALUTATIONS = "the messrs mr mrs ms dr shri sri smt m/s mm ets"
LINKS = "and n et"
FAMILY = "sons son fils bros brothers"
#: Trades with their written forms; a form of several words is written with a hyphen.
TRADES = """
roofing roofers roof roofer rfg | bakery bkry bakers baker baking | laundromat laundry laundries | flooring fine-flooring fine-floors fine-floor floors
auto-repair automotive-repair auto-rpr automotive auto-repairs automotive-rpr | plumbing plumbers plumber plbg | hardware hdwr hdwe hardwares
insurance-agency ins-agcy ins-agency insurance insurance-agcy ins | dental-care dntl-care dental dntl | veterinary-clinic vet-clinic veterinary vet vet-clnc
landscaping landscape landscapers landscapes lndscpg | manufacturing mfg manufacturers mfrs | coffee cafe coffees coffee-shop | office-supply office-supplies off-supplies off-supply
kirana-stores kirana-str kirana kirana-store | tiffins tiffin-centre tiffin-center tiffin | textiles textile txtls txtl
traders trading trdrs trader | enterprises enterprise entp ent | industries industry inds ind indus
electricals electrical-works electrical elec | medicals medical med medical-hall | sweets sweet-mart mithai sweet sweetmart
jewellers jwlrs jewelers jeweller jeweler jewellery | agencies agency agcs agcy
boulangerie boulang boul | pharmacie pharm phcie | epicerie epic | menuiserie menuis | creperie crep | hotel hot | librairie libr
salon-de-coiffure coiffure coiff salon | garage gar | tabac-presse tabac | restaurant resto rest | fleuriste fleur | garaje
"""
#: Names that are only a trade or a kind of shop.
GENERIC = "general store stores shop shops mobile tea stall xerox centre center medical hall kirana auto repair cafe super market bakery hotel provision cyber beauty parlour parlor tailor tailors salon hair nail pizza deli gas station grocery pharmacy hardware"
#: Given names with the short forms people use.
GIVEN = """
elizabeth betty beth liz lizzie eliza bess | katherine katie kate kathy kat catherine | jonathan johnny john jon jonny
robert bob bobby rob robbie | william bill billy will willie | richard dick rick ricky rich | margaret peggy maggie meg marge
theodore ted teddy theo | alexandra alex sandra lexi lexie alexa | michael mike mick mickey | james jim jimmy jamie | joseph joe joey
mohammed muhammad mohd md mohamed mohammad | lakshmi lakshmy laxmi luxmi lachu | venkatesh venkat venky | subramaniam subramanyam subramanian mani subbu
rajendra raju rajender rajinder rajan raj | sunita suni sunitha suneeta | krishnan krishna krish krsna kittu | jean-baptiste jb | francois fanfan franck
frederic fred fredo | elisabeth babeth lisbeth lise | thomas tom tommy | charles charlie chuck | edward ed eddie ned | anthony tony | patricia pat patty trish
"""
PLACEHOLDERS = frozenset("none null nan na unknown test tbd various xxx not available not provided".split()) | {"n/a", "-", "--", "?", "."}
#: Devanagari letters in Latin spelling; consonants carry an inherent a.
DEVANAGARI = dict(
    zip(
        "कखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसहळ",
        "k kh g gh n ch chh j jh n t th d dh n t th d dh n p ph b bh m y r l v sh sh s h l".split(),
    )
)
DEVANAGARI_VOWELS = dict(zip("अआइईउऊऋएऐओऔऑऍ", "a a i i u u ri e ai o au o e".split()))
DEVANAGARI_SIGNS = dict(zip("ािीुूृेैोौॉॅ", "a i i u u ri e ai o au o e".split()))
DEVANAGARI_TRADES = {
    "किराना स्टोर्स": "kirana stores", "इंडस्ट्रीज": "industries", "एंटरप्राइजेज": "enterprises", "मेडिकल्स": "medicals",
    "टेक्सटाइल्स": "textiles", "ट्रेडर्स": "traders", "ज्वेलर्स": "jewellers", "ज्वैलर्स": "jewellers", "एजेंसीज": "agencies", "स्वीट्स": "sweets",
    "इलेक्ट्रिकल्स": "electricals", "टिफिन्स": "tiffins", "टिफिन सेंटर": "tiffin centre", "ऑफिस सप्लाइज": "office supplies",
    "ऑफिस सप्लाई": "office supply",
}

# ---------------------------------------------------------------------------------------------- text


def _forms(text: str) -> dict[str, str]:
    out = {}
    for line in text.replace("\n", "|").split("|"):
        words = line.split()
        for word in words:
            out.setdefault(word, words[0])
    return out


@dataclass(frozen=True, eq=False)
class Lexicon:
    """What words mean. Lists are blank-separated words; lines of forms begin with the common name; all may be empty.

    ``regions`` maps the names of states to their short forms.
    """

    street_types: str = ""
    french_types: str = ""
    unit_words: str = ""
    door_words: str = ""
    buildings: str = ""
    buildings_before: str = ""
    localities: str = ""
    landmark_words: str = ""
    landmark_rest: str = ""
    legal: str = ""
    salutations: str = ""
    links: str = ""
    family: str = ""
    trades: str = ""
    generic: str = ""
    given: str = ""
    written_trades: tuple[tuple[str, str], ...] = ()
    regions: tuple[tuple[str, str], ...] = ()
    sets: dict[str, frozenset] = field(init=False, repr=False)
    streets: dict[str, str] = field(init=False, repr=False)
    trade_forms: dict[str, str] = field(init=False, repr=False)
    trade_phrases: dict[tuple, str] = field(init=False, repr=False)
    given_forms: dict[str, str] = field(init=False, repr=False)
    given_letters: dict[str, frozenset] = field(init=False, repr=False)
    region_words: dict[tuple, str] = field(init=False, repr=False)
    region_codes: frozenset = field(init=False, repr=False)

    def __post_init__(self) -> None:
        names = "french_types unit_words door_words buildings buildings_before localities landmark_words landmark_rest legal salutations links family generic".split()
        trades, given = _forms(self.trades), _forms(self.given)
        letters: dict[str, frozenset] = {}
        for form, name in given.items():
            # first letters of all forms of a given name
            letters[name] = letters.get(name, frozenset()) | {form[0]}
        made = {
            "sets": {n: frozenset(getattr(self, n).split()) for n in names},
            "streets": _forms(self.street_types),
            "trade_forms": trades,
            "trade_phrases": {tuple(k.split("-")): v for k, v in trades.items() if "-" in k},
            "given_forms": given,
            "given_letters": letters,
            "region_words": {tuple(k.split()): v for k, v in self.regions},
            "region_codes": frozenset(v for _, v in self.regions),
        }
        for name, value in made.items():
            object.__setattr__(self, name, value)


EMPTY = Lexicon()
GENERAL = Lexicon(
    STREET_TYPES, FRENCH_TYPES, UNIT_WORDS, DOOR_WORDS, BUILDINGS, BUILDINGS_BEFORE, LOCALITIES, LANDMARK_WORDS, LANDMARK_REST,
    LEGAL, SALUTATIONS, LINKS, FAMILY, TRADES, GENERIC, GIVEN, tuple(DEVANAGARI_TRADES.items()),
)
_ORDINAL = {f"{i}{'st' if i == 1 else 'nd' if i == 2 else 'rd' if i == 3 else 'th'}": w for i, w in enumerate(ORDINALS, 1)}


def latin(text: str, lexicon: Lexicon = GENERAL) -> str:
    """Devanagari in Latin letters; other text unchanged."""
    if not any("ऀ" <= c <= "ॿ" for c in text):
        return text
    for written, trade in lexicon.written_trades:
        if written in text:
            text = text.replace(written, f" {trade} ")
    out: list[str] = []
    open_vowel = False
    for char in text:
        if char in DEVANAGARI:
            if open_vowel:
                out.append("a")
            out.append(DEVANAGARI[char])
            open_vowel = True
            continue
        if char in DEVANAGARI_SIGNS:
            out.append(DEVANAGARI_SIGNS[char])
        elif char == "्":  # no vowel
            pass
        elif char in DEVANAGARI_VOWELS:
            if open_vowel:
                out.append("a")
            out.append(DEVANAGARI_VOWELS[char])
        elif char in "ंँ":
            if open_vowel:
                out.append("a")
            out.append("n")
        elif char == "़":
            continue
        else:
            if open_vowel:
                out.append("a")
            out.append(char if not "०" <= char <= "९" else str(ord(char) - 0x966))
        open_vowel = False
    if open_vowel:
        out.append("a")
    return "".join(out)


def plain(text: str | None, lexicon: Lexicon = GENERAL) -> str:
    """Consistent form, Latin letters, no accents, lower case."""
    if not text:
        return ""
    folded = latin(fold_text(text), lexicon)
    if folded.isascii():
        return folded.lower()
    bare = unicodedata.normalize("NFKD", folded.casefold())
    return "".join(c for c in bare if not unicodedata.combining(c)).replace("œ", "oe").replace("æ", "ae").replace("ø", "o")


_SOUND = tuple((re.compile(a), b) for a, b in ((r"oo", "u"), (r"ee", "i"), (r"au", "o"), (r"ph", "f"), (r"z", "j"), (r"ck", "k"), (r"w", "v"), (r"(?<=[stdkgbjp])h", ""), (r"y(?![aeiou])", "i"), (r"(.)\1+", r"\1")))


@lru_cache(maxsize=500_000)
def sound(word: str) -> str:
    """Spellings of one sound made alike: double letters, ee and i, oo and u, au and o, z and j, an h after a stop."""
    for pattern, to in _SOUND:
        word = pattern.sub(to, word)
    return word


@lru_cache(maxsize=500_000)
def grams(word: str) -> tuple[str, ...]:
    """Padded character triples, and neighbouring pairs without their order, which survive a swap of two letters."""
    padded = f"##{word}##"
    pairs = ("".join(sorted(word[i : i + 2])) for i in range(len(word) - 1))
    return tuple(sorted({*(padded[i : i + 3] for i in range(len(padded) - 2)), *pairs}))


# ---------------------------------------------------------------------------------------------- addresses


class Address(NamedTuple):
    door: str
    unit: str
    street: str
    kind: str
    #: Further words of the street's name.
    more: tuple[str, ...]
    towns: tuple[str, ...]
    state: str
    code: str


_ADDRESS_FIXES = (
    (re.compile(r"\bs\.?\s?no\b\.?"), " sno "),
    (re.compile(r"\b[hd]\.?\s?no\b\.?"), " door "),
    (re.compile(r"n\s*°|\bn[or]\.(?=\s*\d)"), " no "),
    (re.compile(r"\bpin(?:\s?code)?\b\s*[-:]?\s*"), " "),
    (re.compile(r"\b(\d{3})[ \-](\d{3})\b"), r"\1\2"),
    (re.compile(r"\b(?:mn|main)\s+(?:rd|road|roed)\b\.?"), " main-road "),
    (re.compile(r"\bcedex\b"), " "),
)
_ADDRESS_TOKEN = re.compile(r"#\s*\d+|\d+(?:st|nd|rd|th)\b|\d+|[^\W\d_](?:[^\W\d_]|[-'](?=[^\W\d_]))*")


def parse_address(text: str | None, lexicon: Lexicon = GENERAL) -> Address | None:
    """The numbered place that an address names; None where it names none."""
    place = read_address(text, lexicon)
    return place if place is not None and place.door and place.street else None


@lru_cache(maxsize=200_000)
def read_address(text: str | None, lexicon: Lexicon = GENERAL) -> Address | None:
    """What an address says, with an empty door where it names no numbered place; None where it says nothing."""
    flat = plain(text, lexicon).strip()
    if not any(c.isalnum() for c in flat) or flat in PLACEHOLDERS:
        return None
    for pattern, to in _ADDRESS_FIXES:
        flat = pattern.sub(to, flat)
    found = list(_ADDRESS_TOKEN.finditer(flat))
    tokens = [m.group() for m in found]
    # whether a comma or a line break stands before a token
    breaks = [i == 0 or any(c in ",;\n" for c in flat[found[i - 1].end() : m.start()]) for i, m in enumerate(found)]
    used = [False] * len(tokens)
    sets = lexicon.sets
    code = unit = door = ""
    hashes: list[int] = []
    numbers: list[int] = []
    for i, token in enumerate(tokens):
        if token.isdigit():
            if len(token) >= 5:
                code, used[i] = token[:6], True
            else:
                numbers.append(i)
        elif token[0] == "#":
            hashes.append(i)
    indian = len(code) == 6
    # a number after a unit word is the unit; door words may stand between
    for i in sorted([*numbers, *hashes]):
        back = i - 1
        while back >= 0 and tokens[back] in sets["door_words"] and tokens[back] in ("no", "number", "n", "num"):
            back -= 1
        if back >= 0 and tokens[back] in sets["unit_words"] and not unit:
            unit = tokens[i].strip("# ")
            for j in range(back, i + 1):
                used[j] = True
    left = [i for i in numbers if not used[i]]
    marked = [i for i in left if i and tokens[i - 1] in sets["door_words"]]
    open_hashes = [i for i in hashes if not used[i]]
    if marked:
        at = marked[0]
    elif left:
        at = left[0]
    elif open_hashes:
        at = open_hashes[0]
    else:
        at = -1
    if open_hashes and at not in open_hashes and not unit and not indian:
        unit = tokens[open_hashes[0]].strip("# ")
    for i in (*left, *open_hashes):
        used[i] = True
    door = (tokens[at].strip("# ").lstrip("0") or "0") if at >= 0 else ""
    for i, token in enumerate(tokens):
        # one letter before a number; elsewhere it may be short for North
        if (token in sets["door_words"] and (len(token) > 1 or i + 1 in numbers or i + 1 in hashes)) or token in sets["unit_words"]:
            used[i] = True
    # landmarks, buildings and localities are not part of the place's own name
    i = 0
    while i < len(tokens):
        if tokens[i] in sets["landmark_words"]:
            used[i] = True
            j = i + 1
            while j < len(tokens) and tokens[j] in sets["landmark_rest"]:
                used[j] = True
                j += 1
            i = j
            continue
        if tokens[i] in sets["buildings_before"] and i + 1 < len(tokens):
            used[i] = used[i + 1] = True
        elif (tokens[i] in sets["buildings"] or tokens[i] in sets["localities"]) and i and not used[i - 1]:
            used[i] = used[i - 1] = True
        i += 1

    def open_word(j: int) -> bool:
        return 0 <= j < len(tokens) and not used[j] and (tokens[j][0].isalpha() or tokens[j] in _ORDINAL)

    # the street: its type, and the words before it (after it in French) up to a comma or a number
    street = kind = ""
    more: list[str] = []
    unsure: list[str] = []
    for i, token in enumerate(tokens):
        if used[i]:
            continue
        form = "main-road" if token == "main-road" else lexicon.streets.get(token)
        if not form:
            continue
        after = i + 1 < len(tokens) and not used[i + 1] and tokens[i + 1][0].isalpha()
        before = i > 0 and not used[i - 1] and tokens[i - 1][0].isalpha() or (i > 0 and tokens[i - 1] in _ORDINAL)
        number_before = i > 0 and tokens[i - 1].isdigit()
        french = form in sets["french_types"] or form in ("avenue", "boulevard") and (number_before or i == 0) and after
        if french and after:
            step, name = 1, i + 1
            while tokens[name] in ARTICLES and open_word(name + 1) and not breaks[name + 1]:
                used[name] = True
                name += 1
        elif before and not french:
            step, name = -1, i - 1
        else:
            continue
        street, kind = _ORDINAL.get(tokens[name], tokens[name]), form
        used[i] = used[name] = True
        j = name + step
        while open_word(j) and not breaks[max(j, j - step)]:
            more.append(_ORDINAL.get(tokens[j], tokens[j]))
            j += step
        # words that neither a comma nor a number sets off may be the town
        bounded = 0 <= j < len(tokens) and (used[j] or not tokens[j][0].isalpha() or breaks[max(j, j - step)])
        bounded = bounded and (step < 0 or tokens[j][0].isdigit() or breaks[j])
        for k in range(name + step, j, step):
            used[k] = True
        if not bounded:
            unsure = list(more)
        more = [w for w in more if w not in ARTICLES]
        break
    rest = [t for i, t in enumerate(tokens) if t[0].isalpha() and (not used[i] or t in unsure)]
    state = ""
    for words, short in lexicon.region_words.items():
        for i in range(len(rest) - len(words) + 1):
            if tuple(rest[i : i + len(words)]) == words:
                state, rest = short, rest[:i] + rest[i + len(words) :]
                more = [w for w in more if w not in words] if unsure else more
                break
    kept = []
    for word in rest:
        if word in lexicon.region_codes and not state:
            state = word
            more = [w for w in more if w != word] if unsure else more
        elif len(word) > 2:
            kept.append(word)
    if not street and at >= 0:
        # no written type: the word after the door number, else the first word left
        following = [i for i in range(at + 1, len(tokens)) if not used[i] and tokens[i][0].isalpha() and len(tokens[i]) > 2]
        name = tokens[following[0]] if following and following[0] == at + 1 else (kept[0] if len(kept) > 1 else "")
        street = name
        if name in kept:
            kept.remove(name)
    return Address(door, unit.lstrip("0"), street, kind, tuple(sorted({w for w in more if w != street})), tuple(sorted(set(kept))), state, code)


# ---------------------------------------------------------------------------------------------- names


class Name(NamedTuple):
    core: tuple[str, ...]
    given: str
    initials: tuple[str, ...]
    trade: str
    family: bool
    generic: bool


_ALIAS = re.compile(r"\b(?:d/b/a|dba|t/a|a/k/a|aka)\b.*$|\((?:formerly|previously|now|ex)\b[^)]*\)|\bformerly\b.*$")
_CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])")
_DOTTED = re.compile(r"\b(?:[a-z]\.){2,}[a-z]?\b\.?")
_NAME_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|\d+")
_MS = re.compile(r"\bm\s*/\s*s\b\.?")


@lru_cache(maxsize=200_000)
def parse_name(text: str | None, lexicon: Lexicon = GENERAL) -> Name | None:
    """What a business name says; None for empty texts and placeholders."""
    if not text:
        return None
    folded = fold_text(text)
    if sum(c.isupper() for c in folded) < 0.6 * max(1, sum(c.isalpha() for c in folded)):
        folded = _CAMEL.sub(" ", folded)
    flat = plain(folded, lexicon).strip()
    if flat in PLACEHOLDERS or not any(c.isalpha() for c in flat):
        return None
    flat = _MS.sub(" ", flat)
    flat = _ALIAS.sub(" ", flat) or flat
    flat = _DOTTED.sub(lambda m: m.group().replace(".", "") + " ", flat)
    flat = re.sub(r"\bjean[- ]baptiste\b", "jb", flat)
    tokens, sets = _NAME_TOKEN.findall(flat), lexicon.sets
    trade, family, given = "", False, ""
    core: list[str] = []
    initials: list[str] = []
    i = 0
    while i < len(tokens):
        phrase = next((k for k in (3, 2) if tuple(tokens[i : i + k]) in lexicon.trade_phrases), 0)
        token = tokens[i]
        if phrase:
            trade = trade or lexicon.trade_phrases[tuple(tokens[i : i + phrase])]
            i += phrase
            continue
        i += 1
        if token in lexicon.trade_forms:
            trade = trade or lexicon.trade_forms[token]
        elif token in sets["family"]:
            family = True
        elif len(token) > 1 and (token in sets["legal"] or token in sets["links"]) or token in sets["salutations"]:
            continue
        elif not given and token in lexicon.given_forms:
            given = lexicon.given_forms[token]
        elif len(token) == 1:
            if token not in ("n", "p"):
                initials.append(token)
        elif token not in ("de", "la", "le", "les", "du", "des", "of"):
            core.append(token)
    # a word in another script beside the Latin name repeats the trade
    latin_words = [w for w in core if w.isascii()]
    core = latin_words if latin_words and len(latin_words) < len(core) else core
    generic = len(core) == sum(w in sets["generic"] for w in core)
    return Name(tuple(core), given, tuple(initials), trade, family, generic)

"""Mapping tables for visually identical characters, built from Unicode data and a short list of look-alikes."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Letters of other scripts drawn like a Latin letter.
LOOKALIKES = {
    # Cyrillic capitals
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P",
    "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I", "Ѵ": "V", "Ԍ": "G", "З": "3",
    # Cyrillic small letters
    "а": "a", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ѕ": "s", "у": "y",
    "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "п": "n",
    "г": "r", "ү": "y",
    # Greek capitals
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Greek small letters
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ε": "e",
    "η": "n", "γ": "y", "ω": "w", "β": "b", "ϲ": "c", "ϳ": "j",
    # Armenian
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "զ": "q", "ց": "g", "յ": "j", "Օ": "O", "Ս": "U", "Լ": "L",
    # Latin letters of unusual shape
    "ɡ": "g", "ı": "i", "ɑ": "a", "ʀ": "R", "ɩ": "i", "ʏ": "Y", "ɴ": "N", "ʜ": "H", "ʟ": "L", "ᴏ": "o", "ᴀ": "A",
    "ᴄ": "c", "ᴅ": "D", "ᴇ": "E", "ᴊ": "J", "ᴋ": "K", "ᴍ": "M", "ᴘ": "P", "ᴛ": "T", "ᴜ": "U", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z",
    "ℓ": "l",
}

#: Latin letters that replace their look-alikes in any word, not only in one that mixes scripts.
LATIN_SHAPES = frozenset("ɡɑɩᴏᴀᴄᴅᴇᴊᴋᴍᴘᴛᴜᴠᴡᴢℓʀʏɴʜʟ")

#: Compatibility tags that mark another width or a joined or styled form.
FORM_TAGS = frozenset(
    "<wide> <narrow> <compat> <font> <circle> <square> <small> <vertical> <initial> <medial> <final> <isolated>".split()
)

# Characters without ink that are not in category Cf.
OTHER_INVISIBLE = frozenset(
    [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]
)
# Format characters that are visible signs.
VISIBLE_FORMAT = frozenset([*range(0x0600, 0x0606), 0x06DD, 0x070F, 0x0890, 0x0891, 0x08E2, 0x110BD, 0x110CD])

PLAIN = " "


def _canonical(char: str) -> str:
    return unicodedata.normalize("NFD", char)


def is_invisible(char: str) -> bool:
    code, category = ord(char), unicodedata.category(char)
    if code in OTHER_INVISIBLE:
        return True
    return (category == "Cf" and code not in VISIBLE_FORMAT) or (category == "Cc" and char not in "\t\n\r\x0b\x0c\x85\x1c\x1d\x1e\x1f")


def is_odd_space(char: str) -> bool:
    return char != PLAIN and (unicodedata.category(char) in ("Zs", "Zl", "Zp") or char in "\t\n\r\x0b\x0c\x85\x1c\x1d\x1e\x1f")


def _compatible(char: str) -> str | None:
    """The usual characters behind another width, joined or styled form; None where there is none."""
    tag = unicodedata.decomposition(char).split(" ")[0]
    if tag not in FORM_TAGS:
        return None
    target = unicodedata.normalize("NFKD", char)
    return None if target[:1] == PLAIN else target


@lru_cache(maxsize=1)
def mapping() -> list[tuple[str, str, str, bool]]:
    """Rows ``(char, target, latin_target, excluded)`` of every character that is rewritten.

    ``target`` holds the decomposed usual form (empty for invisible characters); ``latin_target`` replaces it in words
    that mix Latin with look-alikes; ``excluded`` marks composed letters that Unicode never recomposes. The table is
    bounded by Unicode itself: about 16,000 rows.
    """
    rows = []
    for code in range(0x80, 0x110000):
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4 or 0xF0000 <= code or 0x20000 <= code < 0x2F800:
            continue
        char = chr(code)
        if is_invisible(char):
            rows.append((char, "", "", False))
            continue
        if is_odd_space(char):
            rows.append((char, PLAIN, PLAIN, False))
            continue
        target = _compatible(char)
        if char in LATIN_SHAPES:
            target = LOOKALIKES[char]
        latin = LOOKALIKES.get(char)
        if target is None and len(canonical := _canonical(char)) and canonical != char:
            composed = unicodedata.normalize("NFC", char)
            rows.append((char, canonical, canonical, len(canonical) > 1 and composed != char))
        elif target is not None or latin is not None:
            rows.append((char, target if target is not None else char, latin or target or char, False))
    for code in range(0x20):
        char = chr(code)
        rows.append((char, "" if is_invisible(char) else PLAIN, "" if is_invisible(char) else PLAIN, False))
    rows.append((chr(0x7F), "", "", False))
    return rows


@lru_cache(maxsize=1)
def reverse_lookalikes() -> dict[str, dict[str, str]]:
    """For Cyrillic and Greek: the letter that a Latin one stands for inside a word of that script."""
    out: dict[str, dict[str, str]] = {"CYRILLIC": {}, "GREEK": {}}
    for char, latin in LOOKALIKES.items():
        script = unicodedata.name(char, "").split(" ")[0]
        if script in out and latin not in out[script]:
            out[script][latin] = char
    return out


#: Characters that may stand in for Latin letters, for a regular-expression class.
LOOKALIKE_CLASS = "".join(c for c in LOOKALIKES if c not in LATIN_SHAPES)

_WORD = re.compile(r"(?:[^\W\d_]|[\u0300-\u036f])+")


@lru_cache(maxsize=1)
def _tables() -> tuple[dict[int, str]]:
    return ({ord(c): t for c, t, _, _ in mapping()},)


def _unmix(match: re.Match) -> str:
    word = match.group()
    if word.isascii():
        return word
    latin = any(c.isascii() or unicodedata.name(c, "").startswith("LATIN") for c in word)
    foreign = [c for c in word if not c.isascii() and not unicodedata.name(c, "").startswith("LATIN") and not unicodedata.combining(c)]
    if not latin or not foreign:
        return word
    if all(c in LOOKALIKES for c in foreign):
        return "".join(LOOKALIKES.get(c, c) for c in word)
    back = reverse_lookalikes().get(unicodedata.name(foreign[0], "").split(" ")[0])
    return "".join(back.get(c, c) for c in word) if back else word


def fold_text(text: str | None) -> str | None:
    """One string's consistent form, for use inside other Python stages; equals the DataFrame operator's result."""
    if text is None or (text.isascii() and text.isprintable()):
        return text
    decomposed = text.translate(_tables()[0])
    return unicodedata.normalize("NFC", _WORD.sub(_unmix, decomposed))

"""Folding of Unicode text to ASCII.

Most of the mapping follows from a rule: decompose a character (NFKD), drop the
combining marks, and keep the rest if it is ASCII.  Only letters that Unicode does not
decompose, and the two other alphabets that are common in western encyclopedia text,
are listed.  Characters outside the covered blocks are left as they are.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters and signs with a conventional ASCII spelling but no decomposition.
LATIN = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "ẞ": "Ss",
    "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Þ": "Th", "þ": "th",
    "Ł": "L", "ł": "l", "Ħ": "H", "ħ": "h", "Ŧ": "T", "ŧ": "t", "ı": "i", "ĸ": "k",
    "Ŋ": "NG", "ŋ": "ng", "ŉ": "'n", "ŀ": "l", "Ŀ": "L",
}
SIGNS = {
    "¡": "!", "¢": "C/", "£": "PS", "¥": "Y=", "¦": "|", "§": "SS", "¨": '"',
    "©": "(c)", "«": "<<", "¬": "!", "\u00ad": "", "®": "(r)", "¯": "-", "°": "deg",
    "±": "+-", "´": "'", "¶": "P", "·": "*", "¸": ",", "»": ">>", "¿": "?", "×": "x",
    "÷": "/", "¤": "$?", "µ": "u", "ª": "a", "º": "o", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "•": "*",
    "…": "...", "′": "'", "″": '"', "‹": "<", "›": ">", "€": "EUR", "™": "(tm)",
    "\u200b": "", "\u200c": "", "\u200d": "", "\u200e": "", "\u200f": "",
    "\u2028": "\n", "\u2029": "\n\n", "\u2060": "", "\ufeff": "",
}
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th",
    "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p",
    "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps",
    "ω": "o",
}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z",
    "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p",
    "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch",
    "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia",
    "ё": "io", "і": "i", "ї": "yi", "є": "ie", "ґ": "g",
}

# Blocks covered by the decomposition rule, as inclusive code point ranges.
RULE_BLOCKS = [
    (0x00A0, 0x024F),   # Latin-1 supplement, Latin extended A and B
    (0x1E00, 0x1EFF),   # Latin extended additional
    (0x2000, 0x200A),   # typographic spaces
    (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    (0x2070, 0x209C),   # superscripts and subscripts
    (0x2100, 0x218B),   # letter-like symbols, number forms
    (0xFB00, 0xFB06),   # Latin ligatures
    (0xFF01, 0xFF5E),   # full-width forms
]
ACCENTED_BLOCKS = [(0x0386, 0x03CE), (0x1F00, 0x1FFF), (0x0400, 0x045F)]
COMBINING = (0x0300, 0x036F)
# Letters with a stroke, hook or the like do not decompose, but are named after their letter.
LETTER_NAME = re.compile(r"LATIN (?P<case>CAPITAL|SMALL) LETTER (?P<letter>[A-Z]{1,2})(?: WITH .*)?")


def _base(text: str, form: str) -> str:
    kept = (c for c in unicodedata.normalize(form, text) if not unicodedata.combining(c))
    return "".join(kept).replace("⁄", "/")


def _with_capitals(alphabet: dict[str, str]) -> dict[str, str]:
    both = dict(alphabet)
    for letter, spelling in alphabet.items():
        both.setdefault(letter.upper(), spelling[:1].upper() + spelling[1:])
    return both


@lru_cache(maxsize=1)
def fold_table() -> dict[str, str]:
    """Map of every covered non-ASCII character to its ASCII spelling."""
    table = {chr(cp): "" for cp in range(COMBINING[0], COMBINING[1] + 1)}
    for first, last in RULE_BLOCKS:
        for char in map(chr, range(first, last + 1)):
            base = _base(char, "NFKD")
            if base != char and base.isascii():
                table[char] = base
            elif named := LETTER_NAME.fullmatch(unicodedata.name(char, "")):
                letter = named["letter"]
                table[char] = letter if named["case"] == "CAPITAL" else letter.lower()
    alphabets = {**_with_capitals(GREEK), **_with_capitals(CYRILLIC)}
    for first, last in ACCENTED_BLOCKS:
        for char in map(chr, range(first, last + 1)):
            base = _base(char, "NFD")
            if base in alphabets:
                table[char] = alphabets[base]
    table.update(alphabets)
    table.update(LATIN)
    table.update(SIGNS)
    return table


@lru_cache(maxsize=1)
def _plan() -> tuple[str, str, list[tuple[str, str]]]:
    """Split the table into one ``translate`` and the spellings longer than a letter."""
    table = fold_table()
    single = sorted(c for c, s in table.items() if len(s) == 1)
    dropped = sorted(c for c, s in table.items() if not s)
    longer = sorted((c, s) for c, s in table.items() if len(s) > 1)
    return "".join(single + dropped), "".join(table[c] for c in single), longer


@lru_cache(maxsize=1)
def _suspects() -> str:
    """Pattern for characters that may need a longer spelling; beyond Latin-1, any may."""
    longer = {char for char, _ in _plan()[2]}
    settled = (cp for cp in range(0x100) if chr(cp) not in longer)
    return "[^" + "".join(f"\\x{cp:02x}" for cp in settled) + "]"


# The short names of the letters a Hangul syllable is made of, in their order.
HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3
INITIALS = "g gg n d dd r m b bb s ss - j jj c k t p h".split()
VOWELS = "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split()
FINALS = "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".split()


def _syllable(char: Column) -> Column:
    """Spelling of a Hangul syllable, whose number is composed of those of its letters."""
    number = F.ascii(char) - HANGUL_FIRST
    place = [F.floor(number / (len(VOWELS) * len(FINALS))),
             F.floor(number / len(FINALS)) % len(VOWELS), number % len(FINALS)]
    letters = [F.array(*(F.lit(x.replace("-", "")) for x in names))
               for names in (INITIALS, VOWELS, FINALS)]
    return F.concat(*(F.get(names, at.cast("int")) for names, at in zip(letters, place)))


def ascii_fold(col: Column) -> Column:
    """ASCII spelling of ``col``; text that is ASCII already is passed through.

    Characters with longer spellings are replaced one by one, but only those that occur
    in the text; all others follow in a single ``translate``.  Hangul syllables are spelled by rule.
    """
    source, target, longer = _plan()
    listed = "\x02".join(f"{char}\x01{spelling}" for char, spelling in longer)
    spelling = F.str_to_map(F.lit(listed), F.lit("\x02"), F.lit("\x01"))
    present = F.array_distinct(F.regexp_extract_all(col, F.lit(_suspects()), F.lit(0)))
    hangul = lambda c: c.between(chr(HANGUL_FIRST), chr(HANGUL_LAST))
    spelled = F.aggregate(
        F.filter(present, lambda c: F.map_contains_key(spelling, c) | hangul(c)),
        col,
        lambda text, c: F.replace(
            text, c, F.when(hangul(c), _syllable(c)).otherwise(F.element_at(spelling, c))),
    )
    return F.when(
        col.rlike(r"[^\x00-\x7F]"), F.translate(spelled, source, target)
    ).otherwise(col)

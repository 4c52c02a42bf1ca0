"""Text clean-up as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fold import ascii_fold

# Character classes that run over whole texts are spelled out, letter by letter: Java keeps
# those in one bit set, while ranges become a chain of tests that slows down several times
# over when many threads run it.
LETTERS_AND_DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"

# The alphabet of extracted text, the marker word that is deleted, and the
# white space and line ends of the text model.
OUTSIDE_ALPHABET = f"[^{LETTERS_AND_DIGITS}|()*=]+"
MARKER_WORD = "noinclude"
LINE_END = r"\r\n|[\n\x0B\f\r\x1c\x1d\x1e\x85\x{2028}-\x{2029}]"
WHITE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
WHITE_RUN = r"[ \t\n\x0B\f\r\x1c\x1d\x1e\x1f]+"
TEMPLATE_OPENING = r"\{[^}]*(?=\})"
REFERENCES = r"(?isu)< *ref.*< */ *ref"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize_text(col: Column, drop_noinclude: bool = True) -> Column:
    """Fold to lower-case ASCII and squeeze everything outside the alphabet to one space."""
    return squeezed(folded(col), drop_noinclude)


def folded(col: Column) -> Column:
    return F.lower(ascii_fold(col))


def squeezed(text: Column, drop_noinclude: bool = True) -> Column:
    if drop_noinclude:
        text = F.replace(text, F.lit(MARKER_WORD), F.lit(""))
    return F.regexp_replace(text, OUTSIDE_ALPHABET, " ")


def strip_templates(col: Column) -> Column:
    """Blank out every brace template up to, not including, its first closing brace."""
    return F.regexp_replace(col, TEMPLATE_OPENING, " ")


def strip_refs(col: Column) -> Column:
    """Blank out everything from the first reference opening to the last closing."""
    return F.regexp_replace(col, REFERENCES, " ")


def flatten_newlines(col: Column) -> Column:
    return F.replace(col, F.lit("\n"), F.lit(" "))


def split_lines(col: Column) -> Column:
    """Lines of ``col``; a line end at the very end opens no further line."""
    lines = F.split(col, LINE_END)
    return let(
        lines,
        lambda ls: F.when(
            F.element_at(ls, -1) == "", F.slice(ls, F.lit(1), F.size(ls) - 1)
        ).otherwise(ls),
    )


def words(col: Column) -> Column:
    """White-space separated words, none of them empty."""
    return F.filter(F.split(col, WHITE_RUN), lambda w: w != "")


def squeeze(col: Column) -> Column:
    """Collapse runs of spaces and trim white space at both ends."""
    return F.btrim(F.regexp_replace(col, " +", " "), F.lit(WHITE))


def format_elapsed(seconds: Column) -> Column:
    """Seconds as ``h:mm:ss.ss``.

    The seconds are rounded half to even on their exact binary value.  That is done in
    whole numbers, since Java formats the shortest decimal form of a double instead.
    """
    one = 1 << 46  # a remainder below 60 has at most this resolution
    exact = ((seconds % 60) * float(one)).cast("bigint") * 100
    below = F.shiftright(exact, 46)
    rest = exact - F.shiftleft(below, 46)
    up = (rest > one // 2) | ((rest == one // 2) & (below % 2 == 1))
    hundredths = below + F.when(up, 1).otherwise(0)
    return F.format_string(
        "%d:%02d:%02d.%02d",
        F.floor(seconds / 3600).cast("bigint"),
        F.floor((seconds % 3600) / 60).cast("bigint"),
        F.floor(hundredths / 100).cast("bigint"),
        hundredths % 100,
    )

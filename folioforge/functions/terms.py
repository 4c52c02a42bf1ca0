"""Index terms of one document, grouped inside its own row.

A document is a single row, so its postings need no shuffle: the words are sorted inside
the array and each run of equal words becomes one posting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fold import ascii_fold
from .text import LETTERS_AND_DIGITS, let, words

# Words left out of the positional index, matched exactly after lower-casing.
STOP_WORDS = [
    "Infobox", "infobox", "getArgs", "args", "listclass", "|listclass", "br",
    "hlist", "autocollapse", "imagesize", "caption", "|hlist", "hlist|", "listclass|",
]
# Fixed value: what the positional index accepts as a term.
TERM = f"^[{LETTERS_AND_DIGITS}]+$"
# Word characters of the fielded index: letters and digits of any script.
WORD_BREAK = r"[^\p{L}\p{N}]+"


def index_words(text: Column, stop_words: list[str] | None = None) -> Column:
    """Folded lower-case words without stop words; the array index is the position."""
    stop = STOP_WORDS if stop_words is None else stop_words
    folded = words(F.lower(ascii_fold(text)))
    return F.filter(folded, lambda w: ~w.isin(stop)) if stop else folded


def positioned_terms(text: Column, stop_words: list[str] | None = None) -> Column:
    """(term, pos) of the accepted terms; positions count the rejected words too."""
    numbered = F.transform(
        index_words(text, stop_words),
        lambda w, i: F.struct(w.alias("term"), i.alias("pos")),
    )
    return F.filter(numbered, lambda t: t.term.rlike(TERM))


def field_terms(text: Column) -> Column:
    """(term, pos) of a field value for the fielded index."""
    tokens = F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")
    return F.transform(tokens, lambda w, i: F.struct(w.alias("term"), i.alias("pos")))


def term_runs(terms: Column) -> Column:
    """(term, tf, pos_list) for each distinct term of an array of (term, pos)."""
    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(1), size),
            lambda i: (i == 1) | (F.get(ordered, i - 1).term != F.get(ordered, i - 2).term),
        )
        return let(starts, lambda begin: F.transform(begin, lambda first, n: posting(
            ordered, first, F.coalesce(F.get(begin, n + 1), size + 1) - first)))

    def posting(ordered: Column, first: Column, length: Column) -> Column:
        places = F.transform(F.slice(ordered, first, length), lambda t: t.pos)
        return F.struct(
            F.get(ordered, first - 1).term.alias("term"),
            length.cast("bigint").alias("tf"),
            places.alias("pos_list"),
        )

    empty = F.expr("cast(array() as array<struct<term:string,tf:bigint,pos_list:array<int>>>)")
    return let(
        F.sort_array(terms), lambda t: F.when(F.size(t) == 0, empty).otherwise(runs(t))
    )

"""Page classes and field extraction from wikitext."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .boxes import BOX_START, WORKS_HEADING
from .text import flatten_newlines, let, strip_refs, strip_templates

# Page and box tests.
INFOBOX = r"(?iu)\{\{Infobox *(?:book|short story|film)"
INFOBOX_BOOK = r"(?iu)\{\{Infobox *(?:book|short story)"
INFOBOX_WRITER = r"(?iu)\{\{Infobox *writer"
INFOBOX_FILM = r"(?iu)\{\{Infobox *film"
NAVBOX = r"(?iu)\{\{Navbox"
RELEVANT = f"{BOX_START}|{WORKS_HEADING.removeprefix('(?iu)')}"

# One pattern per field, in output order, after the type prefix.
NAME = r"(?isu)name *=.*?\|"
AUTHOR = r"(?isu)author *=.*?\] *\|"
GENRE = r"(?isu)genre *=.*?\] *\|"
PAGES = r"(?isu)pages *=.*?\|"
DIRECTOR = r"(?isu)director *=.*?\] *\|"
BASED_ON = r"(?isu)based_on *=.*?\}\} *\|"
WRITER_NAME = r"(?isu)[ *|]name *=.*?\|"
PSEUDONYM = r"(?isu)pseudonym *=.*?\|"
GROUPS = r"(?isu)group\p{Nd}+ *=.*"
NOITALIC = r"(?iu)\{\{noitalic\|\(\p{Nd}+\)\}\}"
WORKS_SECTION = r"(?isu)(== *(?:works|bibliography) *==.*?) +==[a-zA-Z ]*=="
WORKS_SECTION_AT_START = r"(?isu)\A(== *(?:works|bibliography) *==.*?) +==[a-zA-Z ]*=="

BOOK_PREFIX = "book | "
FILM_PREFIX = "film | "
WRITER_PREFIX = "writer | "
NAVBOX_PREFIX = "navbox | "


def is_relevant(text: Column) -> Column:
    """One pass over the page that keeps exactly the pages with a class."""
    return text.rlike(RELEVANT)


def page_class(text: Column) -> Column:
    """infobox, navbox or writer, in this order of precedence; null when irrelevant."""
    return (
        F.when(text.rlike(INFOBOX), "infobox")
        .when(text.rlike(NAVBOX), "navbox")
        .when(text.rlike(WORKS_HEADING), "writer")
    )


def infobox_subtype(text: Column) -> Column:
    """book, writer or film, in this order; null when the text has none of the boxes."""
    return (
        F.when(text.rlike(INFOBOX_BOOK), "book")
        .when(text.rlike(INFOBOX_WRITER), "writer")
        .when(text.rlike(INFOBOX_FILM), "film")
    )


def _all_matches(text: Column, pattern: str) -> Column:
    return F.array_join(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), "")


def _fields(prefix: str, text: Column, *patterns: str) -> Column:
    return F.concat(F.lit(prefix), *(_all_matches(text, p) for p in patterns))


def book_fields(text: Column) -> Column:
    return _fields(BOOK_PREFIX, text, NAME, AUTHOR, GENRE, PAGES)


def film_fields(text: Column) -> Column:
    return _fields(FILM_PREFIX, text, NAME, DIRECTOR, BASED_ON)


def writer_box_fields(text: Column) -> Column:
    return _fields(WRITER_PREFIX, text, WRITER_NAME, PSEUDONYM)


def navbox_fields(text: Column) -> Column:
    return F.regexp_replace(_fields(NAVBOX_PREFIX, text, NAME, GROUPS), NOITALIC, " ")


def works_section(text: Column) -> Column:
    """Type prefix plus the cleaned works section; the prefix alone without a section."""
    section = F.regexp_extract(flatten_newlines(text), WORKS_SECTION, 1)
    return F.concat(F.lit(WRITER_PREFIX), strip_refs(strip_templates(section)))


def works_section_at_start(text: Column) -> Column:
    """As ``works_section`` for text that begins with the heading; '' otherwise."""
    section = F.regexp_extract(flatten_newlines(text), WORKS_SECTION_AT_START, 1)
    return let(
        section,
        lambda s: F.when(s == "", "").otherwise(
            F.concat(F.lit(WRITER_PREFIX), strip_refs(strip_templates(s)))
        ),
    )

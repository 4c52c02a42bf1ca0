"""Selection of the lines of a page that belong to its boxes.

A box opens at a line holding a selected box start and normally closes at the next line
that only has closing braces.  One level of nesting is tracked: inside a box, a line that
only opens braces makes the next closing line part of the nested template instead.

Only lines with braces can change the state, so the page is reduced to those "marks"
first and the fold runs over marks, not over lines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, split_lines

# What opens a selected box, and what heads a list of works.
BOX_START = r"(?iu)\{\{(?:Infobox *(?:book|short story|film)|Navbox)"
WORKS_HEADING = r"(?iu)== *(?:works|bibliography) *=="

# Folding state: `depth` 0 outside, 1 in a box, 2 in a nested template of a box.
STATE = "struct<depth:int,opened:int,spans:array<struct<first:int,last:int>>>"
OUTSIDE = "named_struct('depth', 0, 'opened', 0, 'spans', array())"


def _marks(lines: Column) -> Column:
    """(line number from 1, kind) of every line with braces.

    Kinds: s selected start, b both braces, o only opening, c only closing.
    """
    def mark(line: Column, index: Column) -> Column:
        opening, closing = F.contains(line, F.lit("{{")), F.contains(line, F.lit("}}"))
        kind = (
            F.when(opening & line.rlike(BOX_START), "s")
            .when(opening & closing, "b")
            .when(opening, "o")
            .when(closing, "c")
        )
        return F.struct((index + 1).alias("line"), kind.alias("kind"))

    return F.filter(F.transform(lines, mark), lambda m: m.kind.isNotNull())


def _spans(lines: Column) -> Column:
    """First and last line of every box, in order; an unclosed box runs to the end."""
    def step(state: Column, mark: Column) -> Column:
        opens = (state.depth == 0) & (mark.kind == "s")
        closes = (state.depth == 1) & (mark.kind == "c")
        depth = (
            F.when(mark.kind == "s", F.greatest(state.depth, F.lit(1)))
            .when(state.depth == 0, 0)
            .when(mark.kind == "o", 2)
            .when(mark.kind == "b", 1)
            .otherwise(state.depth - 1)
        )
        span = F.struct(state.opened.alias("first"), mark.line.alias("last"))
        return F.struct(
            depth.alias("depth"),
            F.when(opens, mark.line).otherwise(state.opened).alias("opened"),
            F.when(closes, F.concat(state.spans, F.array(span)))
            .otherwise(state.spans).alias("spans"),
        ).cast(STATE)

    def finish(state: Column) -> Column:
        rest = F.struct(state.opened.alias("first"), F.size(lines).alias("last"))
        return F.when(state.depth > 0, F.concat(state.spans, F.array(rest))).otherwise(
            state.spans
        )

    return F.aggregate(_marks(lines), F.expr(OUTSIDE).cast(STATE), step, finish)


def _join_spans(lines: Column, spans: Column) -> Column:
    parts = F.transform(spans, lambda s: F.slice(lines, s["first"], s["last"] - s["first"] + 1))
    return F.array_join(F.flatten(parts), " ")


def box_text(col: Column) -> Column:
    """All box lines of a page, joined by spaces."""
    return let(split_lines(col), lambda lines: _join_spans(lines, _spans(lines)))


def _first_heading(lines: Column) -> Column:
    """Number of the first line with a works heading, 0 if there is none."""
    return F.array_position(F.transform(lines, lambda l: l.rlike(WORKS_HEADING)), True).cast("int")


def writer_tail(col: Column) -> Column:
    """Everything from the line of the first works heading on, '' without a heading."""
    def tail(lines: Column) -> Column:
        return let(
            _first_heading(lines),
            lambda h: F.when(h > 0, F.array_join(F.slice(lines, h, F.size(lines)), "\n"))
            .otherwise(""),
        )

    return let(split_lines(col), tail)


def box_and_tail_text(col: Column) -> Column:
    """Box lines, plus everything from the first works heading outside a box on."""
    def select(lines: Column) -> Column:
        def merge(spans: Column) -> Column:
            numbered = F.transform(
                lines, lambda l, i: F.when(l.rlike(WORKS_HEADING), i + 1)
            )
            outside = F.filter(
                numbered,
                lambda n: n.isNotNull()
                & ~F.exists(spans, lambda s: (s["first"] <= n) & (n <= s["last"])),
            )
            return let(
                F.get(outside, F.lit(0)),
                lambda h: F.when(h.isNull(), spans).otherwise(
                    F.concat(
                        F.filter(spans, lambda s: s["last"] < h),
                        F.array(
                            F.struct(h.alias("first"), F.size(lines).alias("last"))
                        ),
                    )
                ),
            )

        return _join_spans(lines, let(_spans(lines), merge))

    return let(split_lines(col), select)

"""Grammar of search strings.

A string is free text, or pairs ``'field': 'value'``.  `` -OR`` anywhere asks for any term
instead of all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# The switch as it is found and as it is removed, and the all-fields name.
OR_SWITCH = "-OR"
OR_SUFFIX = " -OR"
ALL_FIELDS = "all"


def operator(raw: Column) -> Column:
    return F.when(F.contains(raw, F.lit(OR_SWITCH)), "OR").otherwise("AND")


def query_text(raw: Column) -> Column:
    return F.replace(raw, F.lit(OR_SUFFIX), F.lit(""))


def clauses(text: Column) -> Column:
    """(clause_id, field, value) of a search string.

    Pieces between quotes that hold a colon pair their neighbours; a colon piece without
    both neighbours gives no clause.
    """
    def paired(pieces: Column) -> Column:
        numbered = F.transform(
            pieces,
            lambda p, i: F.when(
                F.contains(p, F.lit(":")) & (i > 0) & (i + 1 < F.size(pieces)),
                F.struct(
                    F.get(pieces, i - 1).alias("field"), F.get(pieces, i + 1).alias("value")
                ),
            ),
        )
        found = F.filter(numbered, lambda c: c.isNotNull())
        return F.transform(
            found,
            lambda c, i: F.struct(
                i.alias("clause_id"), c["field"].alias("field"), c["value"].alias("value")
            ),
        )

    pieces = F.filter(F.split(text, "'"), lambda p: ~p.isin("", " "))
    free = F.array(
        F.struct(
            F.lit(0).alias("clause_id"), F.lit(ALL_FIELDS).alias("field"), text.alias("value")
        )
    )
    return F.when(F.contains(text, F.lit(":")), let(pieces, paired)).otherwise(free)

"""Clauses that stand for many terms: tests on the term dictionary.

Their text is lower-cased but neither stemmed nor stopped.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clauses import Clause


def wildcard_pattern(text: str) -> tuple[str, str]:
    """(literal start, whole-term regular expression)."""
    out, start, literal = [], [], True
    chars = iter(text)
    for c in chars:
        if c == "\\":
            c = next(chars, "\\")
        elif c in "*?":
            literal = False
            out.append(".*" if c == "*" else ".")
            continue
        out.append(re.escape(c))
        if literal:
            start.append(c)
    return "".join(start), "(?s)^" + "".join(out) + r"\z"


def term_test(clause: Clause, term: Column) -> Column:
    """Whether a term of the dictionary matches a constant-score clause.

    Prefixes and ranges reach the parquet scan as filters, and so does the
    literal start of a wildcard.
    """
    if clause.kind == "prefix":
        return F.startswith(term, F.lit(clause.text.lower()))
    if clause.kind == "wildcard":
        start, pattern = wildcard_pattern(clause.text.lower())
        return F.startswith(term, F.lit(start)) & term.rlike(pattern)
    if clause.kind == "regexp":
        return term.rlike(rf"^(?:{clause.text.lower()})\z")
    if clause.kind == "range":
        test = F.lit(True)
        if clause.lower is not None:
            low = F.lit(clause.lower.lower())
            test = test & ((term >= low) if clause.include_lower else (term > low))
        if clause.upper is not None:
            high = F.lit(clause.upper.lower())
            test = test & ((term <= high) if clause.include_upper else (term < high))
        return test
    raise ValueError(clause.kind)

"""Queries as values: clauses and groups of clauses."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, fields

OCCURS = ("should", "must", "must_not")
KINDS = ("term", "phrase", "prefix", "wildcard", "regexp", "fuzzy", "range", "all", "group")


@dataclass(frozen=True)
class Clause:
    """One condition of a query.

    ``field`` None means every searched field.  ``occur`` places the clause
    in its group, ``boost`` multiplies its score.
    """

    kind: str
    text: str = ""
    field: str | None = None
    occur: str = "should"
    boost: float = 1.0
    slop: int = 0
    max_edits: int = 2
    lower: str | None = None
    upper: str | None = None
    include_lower: bool = True
    include_upper: bool = True
    clauses: tuple["Clause", ...] = ()

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown clause kind {self.kind!r}")
        if self.occur not in OCCURS:
            raise ValueError(f"occur must be one of {OCCURS}, not {self.occur!r}")
        if self.boost < 0:
            raise ValueError("boost must not be negative")
        if self.kind == "wildcard" and self.text[:1] in ("*", "?"):
            raise ValueError("a wildcard clause must not start with * or ?")
        if self.kind == "fuzzy" and self.max_edits not in (0, 1, 2):
            raise ValueError("max_edits must be 0, 1 or 2")
        if self.slop < 0:
            raise ValueError("slop must not be negative")


def term(text: str, field: str | None = None, **options) -> Clause:
    """Analysed text; each of its terms is optional."""
    return Clause("term", text, field, **options)


def phrase(text: str, field: str | None = None, **options) -> Clause:
    """All terms of the text in order, up to ``slop`` moves apart."""
    return Clause("phrase", text, field, **options)


def prefix(text: str, field: str | None = None, **options) -> Clause:
    return Clause("prefix", text, field, **options)


def wildcard(text: str, field: str | None = None, **options) -> Clause:
    """``?`` is one character, ``*`` any number, a backslash quotes."""
    return Clause("wildcard", text, field, **options)


def regexp(text: str, field: str | None = None, **options) -> Clause:
    """The whole term must match."""
    return Clause("regexp", text, field, **options)


def fuzzy(text: str, max_edits: int = 2, field: str | None = None, **options) -> Clause:
    return Clause("fuzzy", text, field, max_edits=max_edits, **options)


def term_range(lower: str | None, upper: str | None, field: str | None = None, **options) -> Clause:
    """Terms between two strings; None leaves an end open."""
    return Clause("range", field=field, lower=lower, upper=upper, **options)


def match_all(**options) -> Clause:
    return Clause("all", **options)


def group(*clauses: Clause, **options) -> Clause:
    return Clause("group", clauses=tuple(clauses), **options)


Query = Sequence[Clause]


def from_rows(rows: Iterable[Mapping]) -> dict[int, list[Clause]]:
    """Queries from rows of a clause table.

    A row has ``query_id``, ``clause_id`` and the attributes of a clause under
    their names; ``parent_id`` names the group it belongs to, if any.
    """
    children: dict[tuple, list[Mapping]] = {}
    for row in rows:
        children.setdefault((row["query_id"], row.get("parent_id")), []).append(row)

    def clause(row: Mapping) -> Clause:
        known = {k: v for k, v in row.items() if k in _ATTRIBUTES and v is not None}
        inner = children.get((row["query_id"], row["clause_id"]), [])
        return Clause(**known, clauses=tuple(clause(r) for r in inner))

    roots = sorted({query_id for query_id, _ in children})
    return {q: [clause(r) for r in children.get((q, None), [])] for q in roots}


_ATTRIBUTES = {f.name for f in fields(Clause)} - {"clauses"}

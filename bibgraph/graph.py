"""The property graph as plain DataFrames.

One DataFrame per node label and per edge type.  Keys may be strings (graph
built from CSV load files) or longs (graph derived from the fixture tables);
every operator is key-type agnostic.

Node tables
    paper(paperId, title, url, abstract, year, citationCount)
    author(authorId, name, affiliation, affiliationType)
    venue(kind, name)                      kind in Conference/Journal/Workshop
    keyword(text)
    organization(name)
Edge tables
    wrote(authorId, paperId, corresponding)
    published_in(paperId, kind, name, year, edition, venue, journal_volume)
    cites(src, dst)                        src cites dst
    contains(paperId, keyword)
    reviewed(authorId, paperId, approved, comments)
    affiliated_to(authorId, organization)
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


class Lazy:
    """A table built on first access (see ``Graph``)."""

    def __init__(self, build: Callable[[], DataFrame]):
        self.build = build


@dataclass(frozen=True)
class Graph:
    """Tables may be given as DataFrames or as ``Lazy`` builders; a builder
    runs on first access, so a query only reads and analyses the tables it
    uses."""
    paper: DataFrame | None = None
    author: DataFrame | None = None
    venue: DataFrame | None = None
    keyword: DataFrame | None = None
    organization: DataFrame | None = None
    wrote: DataFrame | None = None
    published_in: DataFrame | None = None
    cites: DataFrame | None = None
    contains: DataFrame | None = None
    reviewed: DataFrame | None = None
    affiliated_to: DataFrame | None = None

    def __getattribute__(self, name: str):
        v = object.__getattribute__(self, name)
        if isinstance(v, Lazy):
            v = v.build()
            object.__setattr__(self, name, v)
        return v

    def with_tables(self, **tables: DataFrame) -> "Graph":
        raw = {f.name: self.__dict__[f.name] for f in fields(self)}
        raw.update(tables)
        return Graph(**raw)

    def tables(self) -> dict[str, DataFrame]:
        """All present tables (builds the lazy ones)."""
        return {f.name: getattr(self, f.name) for f in fields(self)
                if self.__dict__[f.name] is not None}


NODE_TABLES = ("paper", "author", "venue", "keyword", "organization")
EDGE_TABLES = ("wrote", "published_in", "cites", "contains", "reviewed", "affiliated_to")

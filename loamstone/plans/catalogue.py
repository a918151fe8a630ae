"""All queries of the core and their SQL equivalents."""

from __future__ import annotations

from loamstone.plans import archive, eventlog, records, story, warehouse

QUERIES = {**records.QUERIES, **archive.QUERIES, **story.QUERIES, **eventlog.QUERIES, **warehouse.QUERIES}
SQL: dict[str, str] = {**archive.SQL, **story.SQL, **eventlog.SQL, **warehouse.SQL}

"""All catalog queries in one place."""

from __future__ import annotations

from collections.abc import Callable

from packetloom.catalog import files, labelling, learning, models, sampling, streams, traffic

CATALOGS = (traffic.query, learning.query, sampling.query, labelling.query, streams.query, models.query, files.query)


def queries() -> dict[str, Callable]:
    return {name: run for catalog in CATALOGS for name, run in catalog.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for catalog in CATALOGS for name, sql in catalog.oracle.items()}

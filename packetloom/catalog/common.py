"""Registration helper of the catalog modules."""

from __future__ import annotations

from collections.abc import Callable


class Catalog:
    """Queries by name, each with the SQL it must agree with (none: rows-only check)."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.oracle: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def register(run: Callable) -> Callable:
            self.queries[run.__name__] = run
            if sql is not None:
                self.oracle[run.__name__] = sql
            return run

        return register

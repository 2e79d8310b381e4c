"""How a plan module registers its queries."""

from __future__ import annotations

from collections.abc import Callable


class Book:
    """Queries by name, and the SQL that each is compared with."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable:
        def keep(f: Callable) -> Callable:
            self.queries[name] = f
            if sql:
                self.oracle[name] = sql
            return f

        return keep

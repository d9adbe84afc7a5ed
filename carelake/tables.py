"""The set of tables that jobs work on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

NAMES = (
    "hospitals", "new_admissions", "patients", "patient_history", "plans", "policies_new",
    "patient_device_stream",
)


class CareTables:
    """One layer of the data: six batch tables and the landed device readings.

    A table may be given as a function; it is called when a job first asks for
    the table, so a job lists and opens only the files it reads.
    """

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]) -> None:
        if set(tables) != set(NAMES):
            raise ValueError(f"expected the tables {NAMES}, not {sorted(tables)}")
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        for name in NAMES:
            yield name, getattr(self, name)

    def derive(self, **changed: Callable[[], DataFrame]) -> CareTables:
        """The same tables with some of them replaced."""
        kept = {name: (lambda name=name: getattr(self, name)) for name in NAMES}
        return CareTables(**{**kept, **changed})

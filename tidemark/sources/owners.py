"""Which pipeline owns a target: by a client, or by a table property. Lookups never raise."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

from tidemark.sources.metadata import table_property

PROPERTY = "pipelines.pipelineId"


def pipeline_owners(spark: SparkSession, targets: Iterable[tuple[str, str]], find_id: Callable[[str], str | None] | None = None, find_name: Callable[[str], str | None] | None = None) -> dict[str, tuple[str | None, str | None]]:
    """(name, id) by table name, for (table name, target) pairs; a pipeline's name is asked once, also when unknown."""
    names: dict[str, str | None] = {}

    def quiet(f: Callable[[str], str | None] | None, x: str) -> str | None:
        try:
            return f(x) if f else None
        except Exception:  # noqa: BLE001  a lookup is a convenience
            return None

    out = {}
    for table, target in targets:
        own = quiet(find_id, target) or quiet(lambda t: table_property(spark, t, PROPERTY), target)
        if own and own not in names:
            names[own] = quiet(find_name, own)
        out[table] = (names.get(own) if own else None, own)
    return out

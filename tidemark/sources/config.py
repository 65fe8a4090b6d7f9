"""Configuration: the table list (CSV), a YAML file or plain parameters, and their normalisers."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any

from tidemark.plans.specs import History, Migration, Plan, Policy, Slicing, Vacuum

#: The columns that a table list may have.
TABLE_COLUMNS = ("table_name", "cut_off_date", "checkpoint_col", "shared_catalog", "shared_schema", "target_catalog", "target_schema", "partition_col", "chunk_backfill", "backfill_days")
REQUIRED = ("table_name", "cut_off_date", "checkpoint_col")
#: The runtime keys that a file may have.
RUNTIME_KEYS = ("vacuum_after", "vacuum_retain_hours", "vacuum_override_retention_check")
#: Where a path may be mounted instead (fixed value).
MOUNTS = ("/Workspace",)
PLACES = ("shared_catalog", "shared_schema", "target_catalog", "target_schema")


class ConfigError(ValueError):
    pass


def chunk_mode(value: Any, strict: bool = True) -> str:
    """off, on or auto; what can't be read is an error, or off if not ``strict``."""
    if isinstance(value, bool):
        return "on" if value else "off"
    text = "" if value is None else str(value).strip().lower()
    for mode, words in (("on", ("on", "true", "yes")), ("off", ("off", "false", "no", "")), ("auto", ("auto",))):
        if text in words:
            return mode
    if strict:
        raise ConfigError(f"chunk_backfill must be on, off or auto, not {value!r}")
    return "off"


def window_days(value: Any) -> int | None:
    """A positive number of days, or None for blank."""
    text = "" if value is None else str(value).strip()
    if not text:
        return None
    if isinstance(value, bool) or not text.isdecimal() or int(text) < 1:
        raise ConfigError(f"backfill_days must be a positive integer, not {value!r}")
    return int(text)


def given(values: Mapping[str, Any] | None) -> dict[str, Any]:
    """The settings that have a value."""
    return {k: v for k, v in (values or {}).items() if v is not None and str(v).strip()}


def existing(path: str | Path, mounts: tuple[str, ...] = MOUNTS) -> Path:
    """The path as it is, or below one of the mounts if it is only there."""
    for place in (Path(path), *(Path(f"{m}/{str(path).lstrip('/')}") for m in mounts)):
        if place.exists():
            return place
    raise ConfigError(f"{path}: not found")


def read_tables(path: str | Path) -> list[dict[str, str]]:
    """Rows of a table list: cells stripped, blank cells and lines left out."""
    with open(existing(path), newline="", encoding="utf-8-sig") as f:
        return parse_tables(f, str(path))


def parse_tables(lines: Iterable[str], name: str = "the table list") -> list[dict[str, str]]:
    cells = [[cell.strip() for cell in line] for line in csv.reader(lines)]
    if not cells or not any(cells[0]):
        raise ConfigError(f"{name}: it is empty")
    header, rows = cells[0], []
    if unknown := sorted(set(header) - {*TABLE_COLUMNS, ""}):
        raise ConfigError(f"{name}: unknown columns {', '.join(unknown)}")
    for number, line in enumerate(cells[1:], 2):
        if any(line[len(header) :]):
            raise ConfigError(f"{name}, line {number}: more cells than columns")
        if row := {c: v for c, v in zip(header, line, strict=False) if c and v}:
            rows.append(row)
    if not rows:
        raise ConfigError(f"{name}: it has no rows")
    return rows


def migration(row: Mapping[str, Any], defaults: Mapping[str, Any]) -> Migration:
    """A row over the defaults. A bad window spoils its own table, a bad chunk mode the whole list."""
    cells = {**given(defaults), **given(row)}
    if missing := [c for c in (*REQUIRED, *PLACES) if c not in cells]:
        raise ConfigError(f"{cells.get('table_name', 'a table')}: {', '.join(missing)} missing")
    days, fault = None, None
    try:
        days = window_days(cells.get("backfill_days"))
    except ConfigError as e:
        fault = str(e)
    name = cells["table_name"]
    source, target = (".".join((str(cells[f"{side}_catalog"]), str(cells[f"{side}_schema"]), name)) for side in ("shared", "target"))
    history = History(cells["checkpoint_col"], cells["cut_off_date"], days)
    return Migration(name, source, target, history, Slicing(chunk_mode(cells.get("chunk_backfill")), cells.get("partition_col")), fault)


def policy(runtime: Mapping[str, Any] | None) -> Policy:
    """What a file may say of a run's work: cleaning. A key that isn't known is an error, not a wish ignored."""
    keys = given(runtime)
    if unknown := sorted(set(keys) - set(RUNTIME_KEYS)):
        raise ConfigError(f"runtime: unknown keys {', '.join(unknown)}")
    yes = {k: str(keys.get(k, False)).strip().lower() in ("true", "yes", "on", "1") for k in ("vacuum_after", "vacuum_override_retention_check")}
    try:
        hours = int(keys.get("vacuum_retain_hours", 168))
    except ValueError as e:
        raise ConfigError(f"vacuum_retain_hours must be a number, not {keys['vacuum_retain_hours']!r}") from e
    return Policy(vacuum=Vacuum(hours, yes["vacuum_override_retention_check"]) if yes["vacuum_after"] else None)


def resolve(settings: Mapping[str, Any], rows: list[dict[str, str]], overrides: Mapping[str, Any] | None = None) -> Plan:
    """A plan from settings, the rows of a table list, and overrides that beat the settings' defaults."""
    own = {**given(settings.get("defaults")), **given(overrides)}
    unit = own.get("business_unit") or settings.get("business_unit")
    if not unit:
        raise ConfigError("business_unit missing")
    place = {**given(settings.get("control")), **{k[len("control_") :]: v for k, v in own.items() if k.startswith("control_")}}
    if missing := [c for c in ("catalog", "schema", "table") if c not in place]:
        raise ConfigError(f"control: {', '.join(missing)} missing")
    migrations = tuple(migration(row, own) for row in rows)
    names = [m.name for m in migrations]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ConfigError(f"listed twice: {', '.join(twice)}")
    zone = own.get("timezone") or settings.get("timezone")
    control = ".".join(str(place[c]) for c in ("catalog", "schema", "table"))
    return Plan(str(unit).strip(), control, migrations, policy=policy(settings.get("runtime")), **({"zone": zone} if zone else {}))


def load(path: str | Path, overrides: Mapping[str, Any] | None = None) -> Plan:
    """A YAML file; its tables_csv lies relative to it."""
    import yaml

    file = existing(path)
    settings = yaml.safe_load(file.read_text(encoding="utf-8"))
    if not isinstance(settings, dict):
        raise ConfigError(f"{path}: not a mapping")
    if not settings.get("tables_csv"):
        raise ConfigError(f"{path}: tables_csv missing")
    return resolve(settings, read_tables(file.parent / settings["tables_csv"]), overrides)


def from_parameters(tables_csv: str | Path, business_unit: str, timezone: str | None = None, overrides: Mapping[str, Any] | None = None) -> Plan:
    """Plain parameters, as a job passes them."""
    return resolve({"business_unit": business_unit, "timezone": timezone}, read_tables(tables_csv), overrides)

"""What is to be migrated, and how the engine works on it."""

from __future__ import annotations

from dataclasses import dataclass


class Status:
    """States of a control row (fixed values)."""

    PENDING = "PENDING"
    IN_PROGRESS = "IN_PROGRESS"
    DELETED = "DELETED"  # of old control rows only
    BACKFILLED = "BACKFILLED"
    SUCCESS = "SUCCESS"
    FAILED = "FAILED"
    SKIPPED = "SKIPPED"
    CLAIMED_ELSEWHERE = "CLAIMED_ELSEWHERE"  # an outcome of a call, never stored

    DONE = (SUCCESS, SKIPPED)


class RunStatus:
    """States of a run row (fixed values)."""

    RUNNING = "RUNNING"
    COMPLETED = "COMPLETED"
    FAILED = "FAILED"


@dataclass(frozen=True)
class History:
    """The rows to replace: those of checkpoint ``column`` up to ``cut_off``, of which the last ``days`` are copied (all, if None)."""

    column: str
    cut_off: str
    days: int | None = None


@dataclass(frozen=True)
class Slicing:
    """Whether each partition is a commit of its own: ``mode`` is off, on or auto (where the target has a suitable column); ``column`` is the configured one."""

    mode: str = "off"
    column: str | None = None


@dataclass(frozen=True)
class Migration:
    """One table: its key in the control table, both sides' names, what to replace. ``fault`` is why it can't be done."""

    name: str
    source: str
    target: str
    history: History
    slicing: Slicing = Slicing()
    fault: str | None = None


@dataclass(frozen=True)
class Vacuum:
    """Arguments of ``SnapshotTable.vacuum`` after a success."""

    hours: float = 168
    override: bool = False


@dataclass(frozen=True)
class Policy:
    """How a run works: threads, waits on conflicting commits, claims, cleaning."""

    threads: int = 10
    tries: int = 5
    first_wait_s: float = 5.0
    lease_minutes: int = 120
    renew_s: float | None = None  #: a third of the lease, if None
    vacuum: Vacuum | None = None

    def renewal(self) -> float:
        return max(15, self.lease_minutes * 60 // 3) if self.renew_s is None else self.renew_s


@dataclass(frozen=True)
class Plan:
    """All migrations of a business unit, and the name of their control table."""

    business_unit: str
    control: str
    migrations: tuple[Migration, ...]
    zone: str = "Asia/Kolkata"
    policy: Policy = Policy()

"""Publishing a processing unit so that a crash at any point can be recovered from.

The order is claim, reconcile, stage, validate, promote, verify, commit, complete. The row
in unit_manifest is the commit. Whatever a crash leaves is put right by the next attempt,
under the lease of its own claim: files without a manifest go, a manifest whose files are
as recorded only lacks its completion.
"""

from __future__ import annotations

import enum
import hashlib
import os
import shutil
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame

from tessera.governance.control import ControlPlane, now
from tessera.governance.schema_registry import schema_hash

LEASE_S = 3600.0

#: Allowed changes of a unit's state.
TRANSITIONS = {
    ("PENDING", "CLAIM"): "RUNNING",
    ("FAILED", "CLAIM"): "RUNNING",
    ("RUNNING", "EXPIRE"): "PENDING",
    ("RUNNING", "COMMIT"): "COMPLETE",
    ("RUNNING", "FAIL"): "FAILED",
    ("COMPLETE", "FORCE_REBUILD"): "PENDING",
    ("FAILED", "FORCE_REBUILD"): "PENDING",
    ("PENDING", "FORCE_REBUILD"): "PENDING",
}


def next_state(state: str, event: str) -> str:
    found = TRANSITIONS.get((state, event))
    if found is None:
        raise ValueError(f"{event} isn't allowed in state {state}")
    return found


class FailPoint(enum.Enum):
    """Places at which a test can make an attempt crash."""

    AFTER_CLAIM = "after_claim"
    AFTER_STAGE = "after_stage"
    AFTER_VALIDATE = "after_validate"
    DURING_PROMOTE = "during_promote"
    AFTER_PROMOTE = "after_promote"
    BEFORE_COMMIT = "before_commit"
    AFTER_COMMIT = "after_commit"


class Crash(BaseException):
    """What a fail point throws; not an Exception, so that no handler tidies up after it."""


@dataclass(frozen=True)
class Unit:
    dataset: str
    stage: str
    unit: str

    @property
    def key(self) -> tuple[str, str, str]:
        return (self.dataset, self.stage, self.unit)


@dataclass(frozen=True)
class Fingerprint:
    """Rows, files, bytes, the schema's hash and the hash of the files' names and sizes."""

    rows: int
    files: int
    bytes: int
    schema_hash: str
    content_hash: str


def files_of(folder: str) -> list[tuple[str, int]]:
    """Data files with their sizes, by relative name; hidden ones, markers and checksums don't count."""
    base = Path(folder)
    found = [p for p in base.rglob("*") if p.is_file() and not p.name.startswith((".", "_")) and p.suffix != ".crc"]
    return sorted((str(p.relative_to(base)), p.stat().st_size) for p in found)


def fingerprint(folder: str, rows: int, schema) -> Fingerprint:
    found = files_of(folder)
    text = "\n".join(f"{n}:{s}" for n, s in found)
    return Fingerprint(rows, len(found), sum(s for _, s in found), schema_hash(schema), hashlib.sha256(text.encode()).hexdigest())


def source_hash(df: DataFrame) -> str | None:
    """SHA-256 of the names, sizes and times of the files a frame reads; None if it reads none.

    Names come from the plan and the rest from Hadoop's file system, so no data are read.
    """
    spark = df.sparkSession
    lines, conf = [], spark._jsc.hadoopConfiguration()
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        found = path.getFileSystem(conf).getFileStatus(path)
        lines.append(f"{name}:{found.getLen()}:{found.getModificationTime()}")
    return hashlib.sha256("\n".join(lines).encode()).hexdigest() if lines else None


class LeaseLost(RuntimeError):
    """Another worker has the unit now."""


class Units:
    """The states and manifests of processing units. Each step checks the owner in its own transaction."""

    def __init__(self, control: ControlPlane, clock: Callable[[], float] = time.time):
        self.control, self.clock = control, clock

    def claim(self, unit: Unit, owner: str, lease_s: float = LEASE_S) -> bool:
        """Takes a unit that is new, failed, pending or whose lease has run out."""
        at = self.clock()
        with self.control.transaction() as c:
            got = c.execute(
                "INSERT INTO processing_unit (dataset, stage, unit, status, owner, lease_until, attempts) VALUES (?, ?, ?, 'RUNNING', ?, ?, 1) "
                "ON CONFLICT (dataset, stage, unit) DO UPDATE SET status = 'RUNNING', owner = excluded.owner, lease_until = excluded.lease_until, "
                "attempts = attempts + 1, error = NULL WHERE status IN ('PENDING', 'FAILED') OR (status = 'RUNNING' AND lease_until < ?) RETURNING attempts",
                (*unit.key, owner, at + lease_s, at),
            ).fetchone()
        return got is not None

    def state(self, unit: Unit):
        found = self.control.rows("SELECT * FROM processing_unit WHERE dataset = ? AND stage = ? AND unit = ?", *unit.key)
        return found[0] if found else None

    def manifest(self, unit: Unit):
        found = self.control.rows("SELECT * FROM unit_manifest WHERE dataset = ? AND stage = ? AND unit = ?", *unit.key)
        return found[0] if found else None

    def _held(self, c, unit: Unit, owner: str) -> None:
        held = c.execute(
            "SELECT 1 FROM processing_unit WHERE dataset = ? AND stage = ? AND unit = ? AND status = 'RUNNING' AND owner = ? AND lease_until >= ?",
            (*unit.key, owner, self.clock()),
        ).fetchone()
        if held is None:
            raise LeaseLost(f"{unit}: {owner} no longer holds it")

    def commit(self, unit: Unit, owner: str, run_id: str, target: str, f: Fingerprint, source: str | None = None) -> None:
        """Writes the manifest, if the owner's lease still holds. source: the hash of the input, if it is known.

        The log of commits keeps the run also when a rebuild replaces its manifest.
        """
        with self.control.transaction() as c:
            self._held(c, unit, owner)
            c.execute(
                "INSERT INTO unit_manifest (dataset, stage, unit, run_id, target, rows, files, bytes, schema_hash, content_hash, published_at, source_hash) VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?, ?, ?, ?)",
                (*unit.key, run_id, target, f.rows, f.files, f.bytes, f.schema_hash, f.content_hash, now(), source),
            )
            c.execute("INSERT INTO unit_commit VALUES (?, ?, ?, ?, ?)", (*unit.key, run_id, now()))

    def check(self, unit: Unit, owner: str) -> None:
        """LeaseLost if the owner no longer holds the unit."""
        with self.control.transaction() as c:
            self._held(c, unit, owner)

    def complete(self, unit: Unit, owner: str) -> None:
        with self.control.transaction() as c:
            self._held(c, unit, owner)
            if self.manifest(unit) is None:
                raise LeaseLost(f"{unit} has no manifest")
            self._leave(c, unit, next_state("RUNNING", "COMMIT"))

    def fail(self, unit: Unit, owner: str, error: str) -> bool:
        """Marks the owner's attempt as failed; False if another worker has the unit."""
        with self.control.transaction() as c:
            held = c.execute("SELECT status FROM processing_unit WHERE dataset = ? AND stage = ? AND unit = ? AND status = 'RUNNING' AND owner = ?", (*unit.key, owner)).fetchone()
            if held:
                self._leave(c, unit, next_state(held["status"], "FAIL"), error[:2000])
        return held is not None

    def _leave(self, c, unit: Unit, status: str, error: str | None = None) -> None:
        c.execute("UPDATE processing_unit SET status = ?, owner = NULL, lease_until = NULL, error = ? WHERE dataset = ? AND stage = ? AND unit = ?", (status, error, *unit.key))

    def drop_manifest(self, unit: Unit, owner: str) -> None:
        with self.control.transaction() as c:
            self._held(c, unit, owner)
            c.execute("DELETE FROM unit_manifest WHERE dataset = ? AND stage = ? AND unit = ?", unit.key)

    def force_rebuild(self, unit: Unit) -> bool:
        """Makes a unit pending without a manifest; False while a lease is live."""
        with self.control.transaction() as c:
            now = c.execute("SELECT status, lease_until FROM processing_unit WHERE dataset = ? AND stage = ? AND unit = ?", unit.key).fetchone()
            if now is None or (now["status"] == "RUNNING" and now["lease_until"] >= self.clock()):
                return False
            state = next_state(now["status"], "EXPIRE") if now["status"] == "RUNNING" else now["status"]
            self._leave(c, unit, next_state(state, "FORCE_REBUILD"))
            c.execute("DELETE FROM unit_manifest WHERE dataset = ? AND stage = ? AND unit = ?", unit.key)
        return True


class Outcome(enum.Enum):
    """What an attempt finds of earlier ones."""

    FRESH = "nothing there"
    COMMITTED = "manifest and files agree"
    ORPHANED = "files without a manifest, removed"
    INCONSISTENT = "a manifest whose files differ, both removed"


@dataclass(frozen=True)
class Published:
    unit: Unit
    target: str
    rows: int
    skipped: bool


class Publisher:
    """Publishes what a DataFrame gives as the Parquet folder of a unit."""

    def __init__(self, control: ControlPlane, data: str, staging: str, crash_at: FailPoint | None = None, clock: Callable[[], float] = time.time, copy: bool = False):
        """copy: promote by a copy even on one file system."""
        self.units, self.data, self.staging, self.crash_at, self.copy = Units(control, clock), data, staging, crash_at, copy

    def target(self, unit: Unit) -> str:
        return os.path.join(self.data, unit.dataset, f"unit={unit.unit}")

    def _at(self, point: FailPoint) -> None:
        if self.crash_at is point:
            raise Crash(point.value)

    def is_committed(self, unit: Unit, source: str | None = None) -> bool:
        """A manifest whose files are as recorded. Asked before any data are read, so a rerun costs nothing.

        If the hash of the input is given and was recorded, it must be the same too.
        """
        m = self.units.manifest(unit)
        changed = m is not None and source is not None and m["source_hash"] is not None and m["source_hash"] != source
        return m is not None and not changed and self._agrees(m)

    def _agrees(self, m) -> bool:
        found = files_of(m["target"]) if os.path.isdir(m["target"]) else []
        text = "\n".join(f"{n}:{s}" for n, s in found)
        return bool(found) and hashlib.sha256(text.encode()).hexdigest() == m["content_hash"]

    def _beside(self, unit: Unit) -> str:
        """Where copies to promote are made: on the target's file system, hidden from readers."""
        return os.path.join(self.data, f".promote-{unit.dataset}", unit.unit)

    def reconcile(self, unit: Unit, owner: str) -> Outcome:
        """Puts right what earlier attempts have left; only under the lease of owner."""
        m, target = self.units.manifest(unit), self.target(unit)
        shutil.rmtree(self._beside(unit), ignore_errors=True)
        if m is not None and self._agrees(m):
            return Outcome.COMMITTED
        there = os.path.exists(target)
        if m is not None:
            self.units.drop_manifest(unit, owner)
        if there:
            shutil.rmtree(target)
        return Outcome.INCONSISTENT if m is not None else Outcome.ORPHANED if there else Outcome.FRESH

    def publish(self, unit: Unit, run_id: str, build: Callable[[], DataFrame], validate: Callable[[DataFrame], None] | None = None, lease_s: float = LEASE_S,
                source: str | None = None) -> Published | None:
        """One attempt. build is called only if there is work; validate sees the staged data and may raise.

        source: the hash of the input; a committed unit whose input has changed is built
        again. None: another worker holds the unit.
        """
        if self.is_committed(unit, source) and (self.units.state(unit) or {"status": ""})["status"] == "COMPLETE":
            return Published(unit, self.target(unit), self.units.manifest(unit)["rows"], True)
        owner = uuid.uuid4().hex
        state = self.units.state(unit)
        if state is not None and state["status"] == "COMPLETE":  # its files have gone, or they or the input have changed
            self.units.force_rebuild(unit)
        if not self.units.claim(unit, owner, lease_s):
            return None
        stage = os.path.join(self.staging, unit.dataset, unit.stage, unit.unit, owner)
        try:
            self._at(FailPoint.AFTER_CLAIM)
            if self.reconcile(unit, owner) is Outcome.COMMITTED:
                self.units.complete(unit, owner)
                return Published(unit, self.target(unit), self.units.manifest(unit)["rows"], True)
            df = build()
            df.write.mode("overwrite").parquet(stage)
            self._at(FailPoint.AFTER_STAGE)
            staged = df.sparkSession.read.schema(df.schema).parquet(stage)
            rows = staged.count()
            if validate:
                validate(staged)
            expected = fingerprint(stage, rows, df.schema)
            self._at(FailPoint.AFTER_VALIDATE)
            self.units.check(unit, owner)  # a worker that has taken over may be promoting
            self._promote(stage, unit, owner)
            self._at(FailPoint.AFTER_PROMOTE)
            found = fingerprint(self.target(unit), rows, df.schema)
            if found != expected:
                raise OSError(f"{unit}: promoted files differ from the staged ones")
            self._at(FailPoint.BEFORE_COMMIT)
            self.units.commit(unit, owner, run_id, self.target(unit), expected, source)
            self._at(FailPoint.AFTER_COMMIT)
            self.units.complete(unit, owner)
            return Published(unit, self.target(unit), rows, False)
        except Exception as error:
            shutil.rmtree(stage, ignore_errors=True)
            self.units.fail(unit, owner, f"{type(error).__name__}: {error}")
            raise

    def _promote(self, stage: str, unit: Unit, owner: str) -> None:
        """Moves the staged folder to the target, which it replaces; from another file system it is copied first.

        The copy is made in a hidden folder, which the next attempt's reconciliation removes
        if this one ends before the move.
        """
        target = self.target(unit)
        os.makedirs(os.path.dirname(target), exist_ok=True)
        if os.stat(stage).st_dev != os.stat(os.path.dirname(target)).st_dev or self.copy:
            beside = os.path.join(self._beside(unit), owner)
            shutil.copytree(stage, beside)
            shutil.rmtree(stage)
            stage = beside
        self._at(FailPoint.DURING_PROMOTE)
        if os.path.exists(target):  # no manifest speaks of it, or reconciliation would have ended the attempt
            shutil.rmtree(target)
        os.replace(stage, target)
        shutil.rmtree(self._beside(unit), ignore_errors=True)


def clean_staging(control: ControlPlane, staging: str, data: str, older_than_s: float = 86_400.0, clock: Callable[[], float] = time.time) -> list[str]:
    """Removes attempt folders (dataset/stage/unit/owner) that no live lease owns and that are old; the removed.

    A root that is the file system's, the home folder, or holds or lies in the data is refused.
    """
    root, kept = Path(staging).resolve(), Path(data).resolve()
    if root == Path(root.anchor) or root == Path.home().resolve() or root == kept or root in kept.parents or kept in root.parents:
        raise ValueError(f"{staging} isn't a safe staging root")
    live = {r["owner"] for r in control.rows("SELECT owner FROM processing_unit WHERE status = 'RUNNING' AND lease_until >= ?", clock())}
    gone = []
    for p in sorted(root.glob("*/*/*/*")):
        if p.is_dir() and not p.is_symlink() and p.name not in live and clock() - p.stat().st_mtime >= older_than_s:
            shutil.rmtree(p)
            gone.append(str(p))
    return gone

"""The control plane: one SQLite file on the driver, with the constraints in the database."""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import sqlite3
import threading
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

# The layers, states, stages, severities, policies and kinds that the checks below name.
DDL = """
CREATE TABLE IF NOT EXISTS dataset_catalog (
  name TEXT PRIMARY KEY, layer TEXT NOT NULL CHECK (layer IN ('raw','bronze','silver','gold','stream','reference')), path TEXT, description TEXT,
  format TEXT, partition_keys TEXT NOT NULL DEFAULT '[]' CHECK (json_valid(partition_keys)), owner TEXT, pii TEXT NOT NULL DEFAULT 'none' CHECK (pii IN ('none','low','medium','high')),
  retention_days INTEGER CHECK (retention_days IS NULL OR retention_days > 0));
CREATE TABLE IF NOT EXISTS etl_run (
  run_id TEXT PRIMARY KEY, job_name TEXT NOT NULL, status TEXT NOT NULL CHECK (status IN ('RUNNING','SUCCESS','FAILED','ABORTED')),
  started_at TEXT NOT NULL, finished_at TEXT, error_class TEXT, error_message TEXT,
  rows_read INTEGER CHECK (rows_read >= 0), rows_written INTEGER CHECK (rows_written >= 0), rows_rejected INTEGER CHECK (rows_rejected >= 0),
  config TEXT CHECK (config IS NULL OR json_valid(config)), commit_id TEXT,
  CHECK ((status = 'RUNNING') = (finished_at IS NULL)), CHECK ((status = 'FAILED') = (error_class IS NOT NULL)));
CREATE TABLE IF NOT EXISTS etl_run_metric (
  run_id TEXT NOT NULL REFERENCES etl_run, name TEXT NOT NULL, value REAL NOT NULL, PRIMARY KEY (run_id, name));
CREATE TABLE IF NOT EXISTS schema_version (
  dataset TEXT NOT NULL, version INTEGER NOT NULL CHECK (version > 0), hash TEXT NOT NULL CHECK (length(hash) = 64), fields TEXT NOT NULL,
  change TEXT NOT NULL CHECK (change IN ('INITIAL','ADDITIVE','WIDENING')), registered_at TEXT NOT NULL, run_id TEXT,
  added TEXT NOT NULL DEFAULT '[]' CHECK (json_valid(added)), retyped TEXT NOT NULL DEFAULT '[]' CHECK (json_valid(retyped)), PRIMARY KEY (dataset, version));
CREATE TABLE IF NOT EXISTS processing_unit (
  dataset TEXT NOT NULL, stage TEXT NOT NULL CHECK (stage IN ('raw_to_bronze','bronze_to_silver','silver_to_gold','stream_to_gold')), unit TEXT NOT NULL,
  status TEXT NOT NULL CHECK (status IN ('PENDING','RUNNING','COMPLETE','FAILED')), owner TEXT, lease_until REAL, attempts INTEGER NOT NULL DEFAULT 0 CHECK (attempts >= 0),
  error TEXT, PRIMARY KEY (dataset, stage, unit), CHECK ((status = 'RUNNING') = (owner IS NOT NULL AND lease_until IS NOT NULL)));
CREATE TABLE IF NOT EXISTS unit_manifest (
  dataset TEXT NOT NULL, stage TEXT NOT NULL, unit TEXT NOT NULL, run_id TEXT NOT NULL, target TEXT NOT NULL, rows INTEGER NOT NULL CHECK (rows >= 0),
  files INTEGER NOT NULL CHECK (files >= 0), bytes INTEGER NOT NULL CHECK (bytes >= 0), schema_hash TEXT NOT NULL, content_hash TEXT NOT NULL, published_at TEXT NOT NULL,
  source_hash TEXT, PRIMARY KEY (dataset, stage, unit), FOREIGN KEY (dataset, stage, unit) REFERENCES processing_unit);
CREATE TABLE IF NOT EXISTS unit_commit (
  dataset TEXT NOT NULL, stage TEXT NOT NULL, unit TEXT NOT NULL, run_id TEXT NOT NULL, committed_at TEXT NOT NULL);
CREATE TABLE IF NOT EXISTS dq_rule (
  rule_id INTEGER PRIMARY KEY AUTOINCREMENT, dataset TEXT NOT NULL, name TEXT NOT NULL UNIQUE, kind TEXT NOT NULL, "column" TEXT, params TEXT NOT NULL DEFAULT '{}' CHECK (json_valid(params)),
  severity TEXT NOT NULL CHECK (severity IN ('FAIL','WARN')), threshold REAL NOT NULL CHECK (threshold >= 0),
  threshold_kind TEXT NOT NULL CHECK (threshold_kind IN ('fraction','count')), null_policy TEXT NOT NULL CHECK (null_policy IN ('violation','pass','ignore')),
  enabled INTEGER NOT NULL DEFAULT 1, CHECK (threshold_kind = 'count' OR threshold <= 1), CHECK (threshold_kind = 'fraction' OR threshold = CAST(threshold AS INTEGER)), CHECK (NOT (kind = 'not_null' AND null_policy = 'ignore')));
CREATE TABLE IF NOT EXISTS dq_result (
  run_id TEXT NOT NULL REFERENCES etl_run, rule TEXT NOT NULL, evaluated INTEGER NOT NULL CHECK (evaluated >= 0), violated INTEGER NOT NULL CHECK (violated >= 0),
  rate REAL NOT NULL CHECK (rate BETWEEN 0 AND 1), breached INTEGER NOT NULL CHECK (breached IN (0,1)), dataset TEXT, severity TEXT CHECK (severity IN ('FAIL','WARN')),
  CHECK (violated <= evaluated), PRIMARY KEY (run_id, rule));
CREATE TABLE IF NOT EXISTS lineage_node (
  id INTEGER PRIMARY KEY, kind TEXT NOT NULL CHECK (kind IN ('dataset','job')), name TEXT NOT NULL, UNIQUE (kind, name));
CREATE TABLE IF NOT EXISTS lineage_edge (
  source INTEGER NOT NULL REFERENCES lineage_node, target INTEGER NOT NULL REFERENCES lineage_node, kind TEXT NOT NULL CHECK (kind IN ('reads','writes','derives')),
  run_id TEXT NOT NULL, column_mapping TEXT CHECK (column_mapping IS NULL OR json_valid(column_mapping)), CHECK (source <> target), UNIQUE (source, target, kind, run_id));
CREATE TABLE IF NOT EXISTS stream_epoch (
  epoch INTEGER PRIMARY KEY AUTOINCREMENT CHECK (epoch BETWEEN 1 AND 2147483647), checkpoint TEXT NOT NULL UNIQUE, query_id TEXT NOT NULL, allocated_at TEXT NOT NULL);
CREATE TABLE IF NOT EXISTS benchmark_run (
  experiment TEXT NOT NULL, label TEXT NOT NULL, step INTEGER NOT NULL, iteration INTEGER NOT NULL, runtime_ms REAL NOT NULL CHECK (runtime_ms > 0),
  result_hash TEXT NOT NULL, input_hash TEXT NOT NULL CHECK (input_hash <> ''), correct INTEGER NOT NULL CHECK (correct IN (0,1)), settings TEXT NOT NULL, recorded_at TEXT NOT NULL);
CREATE TABLE IF NOT EXISTS dim_taxi_zone (location_id INTEGER PRIMARY KEY, borough TEXT, zone TEXT, service_zone TEXT);
CREATE TABLE IF NOT EXISTS daily_kpi (
  kpi_date TEXT NOT NULL, vendor_name TEXT NOT NULL, trip_count INTEGER, total_revenue REAL, avg_fare REAL, avg_distance_mi REAL, avg_duration_min REAL, avg_tip_pct REAL,
  PRIMARY KEY (kpi_date, vendor_name));
CREATE VIEW IF NOT EXISTS latest_run AS
  SELECT r.*, (SELECT count(*) FROM dq_result d WHERE d.run_id = r.run_id) AS dq_checks, (SELECT count(*) FROM dq_result d WHERE d.run_id = r.run_id AND breached) AS dq_failed
  FROM (SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY started_at DESC, rowid DESC) AS place FROM etl_run) r WHERE place = 1;
CREATE VIEW IF NOT EXISTS lineage AS
  SELECT s.kind AS source_kind, s.name AS source, e.kind AS edge, t.kind AS target_kind, t.name AS target, e.run_id, e.column_mapping
  FROM lineage_edge e JOIN lineage_node s ON s.id = e.source JOIN lineage_node t ON t.id = e.target;
CREATE VIEW IF NOT EXISTS committed_unit AS
  SELECT m.*, u.status, u.attempts FROM unit_manifest m JOIN processing_unit u USING (dataset, stage, unit);
"""


def now() -> str:
    return dt.datetime.now(dt.UTC).isoformat()


class ControlPlane:
    """Connections to the file; each transaction is BEGIN IMMEDIATE, so writers take turns."""

    def __init__(self, path: str):
        self.path, self.local = path, threading.local()
        self.connection.execute("PRAGMA journal_mode = WAL")
        self.connection.executescript(DDL)

    @property
    def connection(self) -> sqlite3.Connection:
        if not hasattr(self.local, "c"):
            self.local.c = sqlite3.connect(self.path, timeout=30, isolation_level=None)
            self.local.c.row_factory = sqlite3.Row
            self.local.c.execute("PRAGMA foreign_keys = ON")
        return self.local.c

    @contextlib.contextmanager
    def transaction(self) -> Iterator[sqlite3.Connection]:
        c = self.connection
        c.execute("BEGIN IMMEDIATE")
        try:
            yield c
        except BaseException:
            c.execute("ROLLBACK")
            raise
        c.execute("COMMIT")

    def rows(self, sql: str, *args) -> list[sqlite3.Row]:
        return self.connection.execute(sql, args).fetchall()

    # -- runs --------------------------------------------------------------------------

    def start_run(self, job: str, run_id: str | None = None, config: dict | None = None, commit_id: str | None = None) -> str:
        """Opens a run, with the configuration and the version of the code it works by."""
        run_id = run_id or uuid.uuid4().hex
        with self.transaction() as c:
            c.execute(
                "INSERT INTO etl_run (run_id, job_name, status, started_at, config, commit_id) VALUES (?, ?, 'RUNNING', ?, ?, ?)",
                (run_id, job, now(), json.dumps(config, sort_keys=True) if config is not None else None, commit_id),
            )
        return run_id

    def count_rows(self, run_id: str, read: int | None = None, written: int | None = None, rejected: int | None = None) -> None:
        """Adds to the run's counters; None leaves one as it is."""
        with self.transaction() as c:
            for name, n in (("rows_read", read), ("rows_written", written), ("rows_rejected", rejected)):
                if n is not None:
                    c.execute(f"UPDATE etl_run SET {name} = coalesce({name}, 0) + ? WHERE run_id = ?", (int(n), run_id))

    def abort_stale_runs(self, older_than_s: float) -> int:
        """Ends runs that began so long ago and never ended, as a killed driver leaves them; their number."""
        before = (dt.datetime.now(dt.UTC) - dt.timedelta(seconds=older_than_s)).isoformat()
        with self.transaction() as c:
            return c.execute("UPDATE etl_run SET status = 'ABORTED', finished_at = ? WHERE status = 'RUNNING' AND started_at <= ?", (now(), before)).rowcount

    def finish_run(self, run_id: str, error: BaseException | None = None) -> bool:
        """Ends a run once; False if it had ended before."""
        with self.transaction() as c:
            return 1 == c.execute(
                "UPDATE etl_run SET status = ?, finished_at = ?, error_class = ?, error_message = ? WHERE run_id = ? AND status = 'RUNNING'",
                ("FAILED" if error else "SUCCESS", now(), type(error).__name__ if error else None, str(error)[:2000] if error else None, run_id),
            ).rowcount

    # -- datasets ----------------------------------------------------------------------

    def describe(self, name: str, layer: str, **more) -> None:
        """Puts a dataset into the catalogue, or changes what it says of it: path, description, format, partition_keys, owner, pii, retention_days."""
        values = {"name": name, "layer": layer} | {k: json.dumps(list(v)) if k == "partition_keys" else v for k, v in more.items()}
        sets = ", ".join(f"{k} = excluded.{k}" for k in values if k != "name")
        with self.transaction() as c:
            c.execute(f"INSERT INTO dataset_catalog ({', '.join(values)}) VALUES ({', '.join('?' * len(values))}) ON CONFLICT (name) DO UPDATE SET {sets}", tuple(values.values()))

    def metrics(self, run_id: str, values: dict[str, float]) -> None:
        with self.transaction() as c:
            c.executemany(
                "INSERT INTO etl_run_metric VALUES (?, ?, ?) ON CONFLICT DO UPDATE SET value = excluded.value", [(run_id, k, float(v)) for k, v in values.items()]
            )

    # -- rules -------------------------------------------------------------------------

    def save_rules(self, dataset: str, rules) -> None:
        with self.transaction() as c:
            c.executemany(
                'INSERT INTO dq_rule (dataset, name, kind, "column", params, severity, threshold, threshold_kind, null_policy) VALUES (?,?,?,?,?,?,?,?,?) '
                "ON CONFLICT (name) DO UPDATE SET dataset = excluded.dataset, kind = excluded.kind, \"column\" = excluded.\"column\", params = excluded.params, "
                "severity = excluded.severity, threshold = excluded.threshold, threshold_kind = excluded.threshold_kind, null_policy = excluded.null_policy",
                [(dataset, r.name, r.kind, r.column, json.dumps(dict(r.params)), r.severity, r.threshold, r.threshold_kind, r.null_policy) for r in rules],
            )

    def load_rules(self, dataset: str) -> list:
        from tessera.operators.quality_rules import Rule

        return [Rule.from_row(dict(r)) for r in self.rows("SELECT * FROM dq_rule WHERE dataset = ? AND enabled ORDER BY rule_id", dataset)]

    def record_report(self, run_id: str, report, dataset: str | None = None) -> None:
        with self.transaction() as c:
            c.executemany(
                "INSERT OR REPLACE INTO dq_result (run_id, rule, evaluated, violated, rate, breached, dataset, severity) VALUES (?, ?, ?, ?, ?, ?, ?, ?)",
                [(run_id, r.rule.name, r.evaluated, min(r.violated, r.evaluated), r.rate, int(r.breached), dataset, r.rule.severity) for r in report.results],
            )

    def previous_count(self, dataset: str, stage: str) -> int | None:
        found = self.rows("SELECT rows FROM unit_manifest WHERE dataset = ? AND stage = ? ORDER BY published_at DESC LIMIT 1", dataset, stage)
        return found[0]["rows"] if found else None

    # -- epochs ------------------------------------------------------------------------

    def epoch(self, checkpoint: str, query_id: str = "pending") -> int:
        """The epoch of a checkpoint folder: allocated once, the same ever after."""
        with self.transaction() as c:
            c.execute("INSERT OR IGNORE INTO stream_epoch (checkpoint, query_id, allocated_at) VALUES (?, ?, ?)", (checkpoint, query_id, now()))
            return c.execute("SELECT epoch FROM stream_epoch WHERE checkpoint = ?", (checkpoint,)).fetchone()[0]


@dataclass
class Run:
    """A run in progress. Success must be claimed; leaving without it is a failure."""

    control: ControlPlane
    run_id: str
    claimed: bool = False

    def rows(self, read: int | None = None, written: int | None = None, rejected: int | None = None) -> None:
        self.control.count_rows(self.run_id, read, written, rejected)

    def succeeded(self) -> None:
        self.claimed = True


class NotClaimed(RuntimeError):
    """A run ended without an error and without claiming success."""


@contextlib.contextmanager
def run(control: ControlPlane, job: str, config: dict | None = None, commit_id: str | None = None) -> Iterator[Run]:
    """Brackets a job: FAILED with the error's class, or SUCCESS if claimed.

    An error while recording a failure is attached to the real one, not raised over it.
    """
    held = Run(control, control.start_run(job, config=config, commit_id=commit_id))
    try:
        yield held
        if not held.claimed:
            raise NotClaimed(job)
    except BaseException as error:
        try:
            control.finish_run(held.run_id, error)
        except sqlite3.Error as late:
            error.add_note(f"the failure couldn't be recorded: {late}")
        raise
    control.finish_run(held.run_id)

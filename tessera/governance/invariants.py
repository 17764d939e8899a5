"""Checks of the control plane that must each find nothing."""

from __future__ import annotations

from tessera.governance.control import ControlPlane

INVARIANTS = {
    "complete_unit_without_manifest": "SELECT 1 FROM processing_unit u WHERE status = 'COMPLETE' AND NOT EXISTS (SELECT 1 FROM unit_manifest m WHERE (m.dataset, m.stage, m.unit) = (u.dataset, u.stage, u.unit))",
    "manifest_without_unit": "SELECT 1 FROM unit_manifest m WHERE NOT EXISTS (SELECT 1 FROM processing_unit u WHERE (m.dataset, m.stage, m.unit) = (u.dataset, u.stage, u.unit))",
    "manifest_of_unsettled_unit": "SELECT 1 FROM unit_manifest JOIN processing_unit USING (dataset, stage, unit) WHERE status IN ('PENDING', 'FAILED')",
    "manifest_without_run": "SELECT 1 FROM unit_manifest m WHERE NOT EXISTS (SELECT 1 FROM etl_run r WHERE r.run_id = m.run_id)",
    "manifest_without_files": "SELECT 1 FROM unit_manifest WHERE rows > 0 AND files = 0",
    "running_unit_without_lease": "SELECT 1 FROM processing_unit WHERE status = 'RUNNING' AND (owner IS NULL OR lease_until IS NULL)",
    "idle_unit_with_lease": "SELECT 1 FROM processing_unit WHERE status <> 'RUNNING' AND (owner IS NOT NULL OR lease_until IS NOT NULL)",
    "unit_never_attempted": "SELECT 1 FROM processing_unit WHERE status IN ('COMPLETE', 'FAILED') AND attempts = 0",
    "ended_run_without_end": "SELECT 1 FROM etl_run WHERE status <> 'RUNNING' AND finished_at IS NULL",
    "run_ends_before_start": "SELECT 1 FROM etl_run WHERE finished_at < started_at",
    "failed_run_without_error": "SELECT 1 FROM etl_run WHERE status = 'FAILED' AND error_class IS NULL",
    "successful_run_with_error": "SELECT 1 FROM etl_run WHERE status = 'SUCCESS' AND error_class IS NOT NULL",
    "violations_over_evaluated": "SELECT 1 FROM dq_result WHERE violated > evaluated",
    "dq_result_without_run": "SELECT 1 FROM dq_result d WHERE NOT EXISTS (SELECT 1 FROM etl_run r WHERE r.run_id = d.run_id)",
    "committed_despite_blocking_rule": "SELECT 1 FROM unit_manifest m JOIN dq_result d USING (run_id) WHERE d.breached AND d.severity = 'FAIL'",
    "published_without_schema": "SELECT 1 FROM unit_manifest m WHERE NOT EXISTS (SELECT 1 FROM schema_version s WHERE s.dataset = m.dataset)",
    "impossible_manifest": "SELECT 1 FROM unit_manifest WHERE rows < 0 OR bytes < 0 OR files < 0",
    "inconsistent_threshold": "SELECT 1 FROM dq_rule WHERE threshold < 0 OR (threshold_kind = 'fraction' AND threshold > 1)",
    "dangling_lineage_edge": "SELECT 1 FROM lineage_edge e WHERE NOT EXISTS (SELECT 1 FROM lineage_node n WHERE n.id = e.source) OR NOT EXISTS (SELECT 1 FROM lineage_node n WHERE n.id = e.target)",
    "lineage_of_nothing_committed": "SELECT 1 FROM lineage_edge e WHERE NOT EXISTS (SELECT 1 FROM unit_commit m WHERE m.run_id = e.run_id)",
    "epoch_shared_or_not_positive": "SELECT 1 FROM stream_epoch GROUP BY epoch HAVING count(*) > 1 OR epoch <= 0",
    "benchmark_without_duration_or_input": "SELECT 1 FROM benchmark_run WHERE runtime_ms <= 0 OR coalesce(input_hash, '') = ''",
    "lineage_self_edge": "SELECT 1 FROM lineage_edge WHERE source = target",
    "write_edge_from_dataset": "SELECT 1 FROM lineage_edge e JOIN lineage_node n ON n.id = e.source WHERE e.kind = 'writes' AND n.kind <> 'job'",
    "schema_versions_with_gaps": "SELECT 1 FROM schema_version GROUP BY dataset HAVING max(version) <> count(*) OR min(version) <> 1",
    "schema_hash_repeats_in_a_row": "SELECT 1 FROM schema_version a JOIN schema_version b ON a.dataset = b.dataset AND b.version = a.version + 1 AND a.hash = b.hash",
}


def broken(control: ControlPlane) -> list[str]:
    """Names of the invariants that don't hold."""
    return [name for name, sql in INVARIANTS.items() if control.rows(f"{sql} LIMIT 1")]

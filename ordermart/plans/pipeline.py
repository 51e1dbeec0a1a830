"""The gated batch pipeline: load -> staging -> checks -> analytics -> checks
-> export -> publish.

Every layer is written under ``<out>/_runs/<run_id>/`` and re-read, which
cuts lineage at each layer boundary (a lost executor recomputes from the last
written layer, never from the sources) and lets every check scan compact
Parquet instead of recomputing the models. A run becomes visible only when all
gates pass: it is then published as a new version (``publication.py``), and
readers resolve the newest, or the one they name.
A failed run leaves the previously published run untouched; with ``resume`` a
rerun under its run_id takes over the stages that were done (``stages.py``).
A run_id that a version shows can only be resumed, never run anew.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordermart.config import ensure_session_conf
from ordermart.operators import constraints, marts, quality, reports, staging
from ordermart.operators.ledger import Ledger
from ordermart.plans.publication import PublicationError, publish, resolve, versions
from ordermart.plans.stages import Stages, fingerprint
from ordermart.sources import csv_ingest, fixtures
from ordermart.sources.export import export_all
from ordermart.sources.raw import raw_from_sources, run_timestamp

# Physical layout of the facts, in place of B-tree indexes: rows dealt to files
# by ranges of the column the index served, and sorted inside them, so range and
# key predicates skip whole files and row groups by their min/max statistics.
# The second column parts a value that would fill a range alone.
SORT_KEYS = {
    "fact_orders": ("order_purchase_timestamp", "order_id"),
    "fact_order_items": ("product_id", "order_id"),
}
# The other two indexed columns: Bloom filters, so a lookup by key reads only the
# row groups that may hold it (Parquet sizes them by the values it meets).
BLOOM_KEYS = {
    "fact_orders": ("customer_unique_id",),
    "fact_order_items": ("seller_id",),
}


class PipelineFailure(RuntimeError):
    def __init__(self, stage: str, details: list, evidence: list | None = None):
        """``evidence``: rows of ``constraints.constraint_evidence``."""
        at = "".join(f"\n  {e['table_name']} {e['constraint_name']}: key ({e['key']}), {e['violations']} rows" for e in evidence or [])
        super().__init__(f"{stage} failed: {details}{at}")
        self.stage = stage
        self.details = details
        self.evidence = evidence or []


@dataclass
class PipelineResult:
    run_id: str
    run_dir: str
    staging_checks: list = field(default_factory=list)
    analytics_checks: list = field(default_factory=list)
    violations: list = field(default_factory=list)
    exports: dict = field(default_factory=dict)
    version: int | None = None
    reused: list = field(default_factory=list)
    timings: dict = field(default_factory=dict)


def written(df: DataFrame, path: str, sort_by: tuple[str, ...] = (), bloom: tuple[str, ...] = ()) -> tuple[DataFrame, int, int]:
    """Writes a table; returns it re-read, the rows the writer saw (an
    Observation on the write itself, no second pass) and the rows stored."""
    obs = Observation(f"rows:{path}")
    if sort_by:  # dealing by ranges samples the input first: it is observed after that
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    return stored, obs.get["rows"], stored.count()  # the last from the footers


def write_counted(df: DataFrame, path: str, sort_by: tuple[str, ...] = (), bloom: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """Write a layer table; returns it re-read from storage and its rows: every
    row the writer saw must be there."""
    stored, seen, found = written(df, path, sort_by, bloom)
    if seen != found:
        raise PipelineFailure("load", [f"row-count mismatch for {path}: source={seen} stored={found}"])
    return stored, found


def write_table(df: DataFrame, path: str, sort_by: tuple[str, ...] = (), bloom: tuple[str, ...] = ()) -> DataFrame:
    return write_counted(df, path, sort_by, bloom)[0]


def reconciliation(spark: SparkSession, counts: list[tuple[str, int, int]]) -> DataFrame:
    """(table_name, source_rows, loaded_rows, status) of the loads."""
    rows = spark.createDataFrame(counts, "table_name string, source_rows bigint, loaded_rows bigint")
    return rows.withColumn("status", F.when(F.col("source_rows") == F.col("loaded_rows"), "PASS").otherwise("FAIL"))


def concurrently(tasks: dict, max_workers: int = 8) -> dict:
    """Run independent Spark actions as concurrent jobs of one session.

    Tables of one layer do not depend on each other; submitting their writes
    together lets the scheduler fill every core (and, on a cluster, every
    executor) instead of running small jobs back to back."""
    from concurrent.futures import ThreadPoolExecutor

    if len(tasks) <= 1:
        return {k: fn() for k, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = {k: pool.submit(fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def _write_layer(tables, base: str) -> dict[str, tuple[DataFrame, int]]:
    return concurrently({
        t: (lambda t=t, df=df: write_counted(df, f"{base}/{t}", SORT_KEYS.get(t, ()), BLOOM_KEYS.get(t, ())))
        for t, df in tables.items()
    })


GATE_TYPE = "decimal(38,2)"


def run_gate(spark: SparkSession, ledger: Ledger, checks: list, items: list, count_type=int):
    """Checks and constraints of one ledger as one query: (checks,
    constraints), each row with its status."""
    def row(kind, order, table, name, severity, actual):
        return F.struct(F.lit(kind).alias("kind"), F.lit(order).alias("check_order"),
                        F.lit(table).cast("string").alias("table_name"), F.lit(name).alias("name"),
                        F.lit(severity).alias("severity"), actual().cast(GATE_TYPE).alias("actual"))

    rows = [row("check", i, None, c.name, c.severity, c.actual) for i, c in enumerate(checks, 1)]
    rows += [row("constraint", 0, t, n, quality.FAIL, m) for t, n, m in items]
    found = (ledger.frame(spark).select(F.inline(F.array(*rows)))
             .withColumn("status", quality.status(F.col("actual"), F.col("severity"))).collect())

    def number(r, kind):
        return None if r["actual"] is None else kind(r["actual"])

    chk = [dict(check_order=r["check_order"], name=r["name"], severity=r["severity"], expected=0,
                actual=number(r, count_type), status=r["status"]) for r in found if r["kind"] == "check"]
    viol = [dict(table_name=r["table_name"], constraint_name=r["name"], violations=number(r, int), status=r["status"])
            for r in found if r["kind"] == "constraint"]
    return sorted(chk, key=lambda d: d["check_order"]), viol


def _gate(stage: str, checks: list, violations: list, ledger: Ledger | None = None) -> None:
    """Raises on a failed check or constraint; a broken constraint names the
    smallest keys at fault, looked up in the tables of the gate's ledger."""
    bad = [(r["table_name"], r["constraint_name"], r["violations"]) for r in violations if r["status"] == quality.FAIL]
    if bad:
        found = [] if ledger is None else constraints.constraint_evidence(
            ledger.tables, [stage], {(t, c) for t, c, _ in bad}).orderBy("table_name", "constraint_name", "key_rank").collect()
        raise PipelineFailure(f"{stage} constraints", bad, [r.asDict() for r in found])
    failed = [(r["name"], r["actual"]) for r in checks if r["status"] == quality.FAIL]
    if failed:
        raise PipelineFailure(f"{stage} checks", failed)


def run_pipeline(spark: SparkSession, out_dir: str, *, source_dir: str | None = None,
                 sf_dir: str | None = None, run_id: str | None = None,
                 export: bool = True, database: str | None = None, resume: bool = False) -> PipelineResult:
    """Run every stage; raise ``PipelineFailure`` on a failed gate, before the
    next stage starts.

    Input is either a folder of the nine CSV files (``source_dir``) or the
    driver tables bound to them (``sf_dir``). With ``database`` the published
    tables and views can also be read by name there. With ``resume`` the stages
    that a stopped run of this ``run_id`` had done over the same input files are
    taken over (``PipelineResult.reused``)."""
    import time

    if source_dir is None and sf_dir is None:
        raise ValueError("source_dir or sf_dir is required")
    if resume and run_id is None:
        raise ValueError("resume needs the run_id of the run that stopped")

    ensure_session_conf(spark)
    run_ts = run_timestamp()
    known, run_id = run_id is not None, run_id or f"{run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    out_dir = out_dir.rstrip("/")
    base = f"{out_dir}/_runs/{run_id}"
    res = PipelineResult(run_id, base)
    clock = time.perf_counter()

    def lap(name):
        nonlocal clock
        now = time.perf_counter()
        res.timings[name] = round(now - clock, 3)
        clock = now

    if known and not resume and any(v.run_id == run_id for v in versions(spark, out_dir)):
        raise PublicationError(f"run {run_id} of {out_dir} is published; it can be resumed, or run anew under another id")
    stages = Stages(spark, f"{out_dir}/_stages/{run_id}", fingerprint(spark, source_dir or sf_dir), known, resume)
    res.reused = stages.reused

    # 1. load (validate every file before writing any table)
    def load():
        frames = (csv_ingest.ingest(spark, source_dir, run_ts) if source_dir is not None
                  else raw_from_sources(fixtures.source_frames(spark, sf_dir), run_ts))
        stored = _write_layer({t: frames[t] for t in frames}, f"{base}/raw")
        if source_dir is not None:  # records counted before any cell was parsed
            for t in sorted(csv_ingest.MULTILINE_TABLES):
                lost = csv_ingest.reconcile_files(spark, source_dir, t, stored[t][0]).where("status = 'FAIL'")
                worst = lost.orderBy("source_file").limit(10).collect()
                if worst:
                    raise PipelineFailure("load", [f"{r['source_file']}: {r['source_records']} records in the source, "
                                                   f"{r['loaded_rows']} rows loaded" for r in worst])
        return stored

    raw = stages.layer("load", f"{base}/raw", load)
    lap("load")

    # 2. staging and its gate
    stg = stages.layer("staging", f"{base}/staging", lambda: _write_layer(dict(staging.build_staging(raw, run_ts)), f"{base}/staging"))
    lap("staging")

    def staging_gate():
        ledger = Ledger(quality.layered(raw=raw, staging=stg))
        found = run_gate(spark, ledger, quality.staging_checks(ledger), constraints.measures(ledger, ["staging"]))
        res.staging_checks, res.violations = found
        lap("staging_gate")
        _gate("staging", *found, ledger)
        return found

    res.staging_checks, res.violations = stages.gate("staging gate", staging_gate, int)

    # 3. analytics and its gate
    an = stages.layer("analytics", f"{base}/analytics", lambda: _write_layer(dict(marts.build_analytics(stg, run_ts)), f"{base}/analytics"))
    views = stages.layer("views", f"{base}/views", lambda: _write_layer(dict(reports.build_reports(an)), f"{base}/views"))
    lap("analytics")

    def analytics_gate():
        ledger = Ledger(quality.layered(staging=stg, analytics=an, views=views))
        found = run_gate(spark, ledger, quality.analytics_checks(ledger), constraints.measures(ledger, ["analytics"]), Decimal)
        res.analytics_checks = found[0]
        lap("analytics_gate")
        _gate("analytics", *found, ledger)
        return found

    res.analytics_checks, violations = stages.gate("analytics gate", analytics_gate, Decimal)
    res.violations = [*res.violations, *violations]

    # 4. files first, then the manifest makes the run visible
    if export:
        res.exports = export_all(spark, reports.export_queries(views), f"{base}/export")
        lap("export")
    res.version = publish(spark, out_dir, run_id, run_ts, stages.rows).version
    if database:
        register(spark, out_dir, database)
    lap("publish")
    return res


def published_run(spark: SparkSession, out_dir: str) -> str | None:
    """The newest published run id (None before the first successful run)."""
    newest = resolve(spark, out_dir)
    return newest.run_id if newest else None


def published(spark: SparkSession, out_dir: str, version: int | None = None):
    """The newest version or the one named, to read its tables from: they stay
    those of one run while others are published."""
    found = resolve(spark, out_dir, version)
    if found is None:
        raise FileNotFoundError(f"nothing published under {out_dir}")
    return found


def read_published(spark: SparkSession, out_dir: str, layer: str, table: str, version: int | None = None) -> DataFrame:
    return published(spark, out_dir, version).read(layer, table)


def register(spark: SparkSession, out_dir: str, database: str = "analytics") -> None:
    """Views of the newest published run, by name: the marts and the reports as
    ``database.<name>``, in the session's catalog. Each is replaced in one
    step; a reader sees the run before or the run after."""
    base = published(spark, out_dir).base
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for layer, tables in (("analytics", marts.TABLES), ("views", reports.VIEWS)):
        for t in tables:
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{t} AS SELECT * FROM parquet.`{base}/{layer}/{t}`")

"""Ingestion: one source's batch into the tables, and the weekly round over all sources."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import normal_form, normalize_text
from ..operators import jobs as postings
from ..operators.lifecycle import aged
from ..operators.resolution import merge, prepared, resolve
from ..operators.upsert import last_per_key, upsert
from ..sinks.export import counted, restored
from ..sinks.store import StaleWrite, Store, Upserted
from ..schemas import KEYS, TABLES, empty
from ..sources.catalog import Source
from ..sources.feeds import Batch


#: How often a batch is applied to newer tables before its run fails.
MOST_TRIES = 5


def run_id(source_id: str, now: datetime) -> str:
    import uuid

    year, week, _ = now.isocalendar()
    return str(uuid.uuid5(uuid.UUID(ids.NAMESPACE), f"run|{normal_form(source_id)}|{year}|{week}"))


def review_rows(spark: SparkSession, rows: DataFrame, kind: str, source_id: str, reason: str, now: datetime) -> DataFrame:
    """Review items with the payload of `rows` (a payload column); an item's id comes from what it says."""
    key = ids.stable_id("review", F.lit(kind), F.lit(source_id), normalize_text("payload"))
    made = rows.select(key.alias("review_id"), F.lit(kind).alias("kind"), F.lit(source_id).alias("source_id"), F.col("payload").alias("payload_json"), F.lit(reason).alias("reason"), F.lit(now).cast("timestamp").alias("created_at"), F.lit("pending").alias("status"))
    return made.dropDuplicates(["review_id"])


def persist(store: Store, batch: Batch, source: Source, run: str, now: datetime) -> dict[str, int]:
    """Applies a batch to the tables in one commit: documents, companies, postings, leads, lifecycle.

    Every change is an upsert of the rows it touches. If another writer has changed companies or postings meanwhile, the batch is
    applied again to what they are now.
    """
    for _ in range(MOST_TRIES):
        try:
            return _persist(store, batch, source, run, now)
        except StaleWrite as e:
            stale = e
    raise stale


def _persist(store: Store, batch: Batch, source: Source, run: str, now: datetime) -> dict[str, int]:
    spark, base = store.spark, store.snapshot()
    known = base.read("companies")
    changed = {n: empty(spark, n) for n in ("companies", "evidence", "review_queue")}
    counts = {"fetched_count": 0, "company_count": 0, "job_count": 0, "lead_count": 0}
    changes: dict[str, Upserted] = {}
    hashes, kept_frames = None, []

    def keep(frame: DataFrame) -> DataFrame:
        kept_frames.append(frame.persist())
        return frame

    def add(name: str, rows: DataFrame) -> None:
        changed[name] = upsert(changed[name], rows, KEYS[name])

    if batch.documents is not None:
        held = keep(batch.documents)
        counts["fetched_count"] = held.count()
        hashes = held.select("url", "content_sha256")
        rows = last_per_key(held.select(*empty(spark, "source_documents").columns), "document_id", "fetched_at")
        changes["source_documents"] = Upserted(rows, columns=("fetched_at", "storage_pointer"))

    def settle(candidates: DataFrame, reason: str, hashed: DataFrame | None) -> DataFrame:
        """Resolves candidates, with their evidence and review items; gives pos and company_id."""
        companies = upsert(known, changed["companies"], "company_id")
        verdict = keep(resolve(companies, candidates))
        ready = keep(prepared(candidates).join(verdict.select("pos", "company_id"), "pos"))
        changed["companies"] = keep(upsert(changed["companies"], merge(companies, ready), "company_id"))
        add("evidence", postings.evidence(ready, "company", "company_id", F.coalesce(F.nullif(F.col("profile"), F.lit("")), F.col("name")), F.col("confidence"), F.lit(source.attribution), hashed))
        asked = ready.join(verdict.filter("needs_review").select("pos"), "pos", "left_semi").select(F.to_json(F.struct(*candidates.columns)).alias("payload"))
        add("review_queue", review_rows(spark, asked, "company_merge", source.id, reason, now))
        return verdict.select("pos", "company_id")

    if batch.companies is not None:
        counts["company_count"] = batch.companies.count()
        settle(batch.companies, "Candidate may duplicate an existing company.", hashes)
    if batch.jobs is not None:
        kept = keep(postings.classified(batch.jobs).filter("role_family <> 'other'"))
        employer = settle(postings.employers(kept), "Job employer may duplicate an existing company.", None)
        rows = keep(postings.normalised(kept.join(employer, "pos")))
        out = rows.filter("eligibility = 'ineligible'")
        audited = out.select(F.to_json(F.struct("job_id", "title", "company_id", "eligibility_evidence", "source_url")).alias("payload"))
        add("review_queue", review_rows(spark, audited, "ineligible_job_audit", source.id, "The posting excludes applicants by place.", now))
        eligible = rows.filter("eligibility <> 'ineligible'")
        fresh = keep(postings.deduplicate(base.lookup("jobs", "fingerprint", eligible.select("fingerprint")), eligible))
        observed = fresh.select("job_id")
        counts["job_count"] = observed.distinct().count()
        seen = kept.select("pos", F.col("source_url").alias("_raw"), F.concat_ws(" | ", "title", F.coalesce("location_text", F.lit(""))).alias("_snippet"))
        told = eligible.join(seen, "pos").join(fresh.select("fingerprint", F.col("job_id").alias("_final")), "fingerprint")
        named = told.select(F.col("_final").alias("job_id"), F.lit(source.id).alias("source_id"), F.col("_raw").alias("source_url"), F.col("last_seen_at").alias("observed_at"), "_snippet", "eligibility_confidence")
        add("evidence", postings.evidence(named, "job", "job_id", F.col("_snippet"), F.col("eligibility_confidence"), F.lit(source.attribution), hashes))
        gone = aged(base.read("jobs"), observed, source.id) if batch.full_snapshot and counts["job_count"] else empty(spark, "jobs")
        changes["jobs"] = Upserted(fresh.unionByName(gone))
    if batch.leads is not None:
        counts["lead_count"] = batch.leads.count()
        leads = batch.leads.select(F.to_json(F.struct(*batch.leads.drop("pos").columns)).alias("payload"))
        add("review_queue", review_rows(spark, leads, "discovery_lead", source.id, "A search result may be an employer.", now))
    changes |= {"companies": Upserted(changed["companies"]), "evidence": Upserted(changed["evidence"]), "review_queue": Upserted(changed["review_queue"], keep=True)}
    try:
        base.commit(changes, reads=("companies", "jobs"))
    finally:
        for frame in kept_frames:
            frame.unpersist()
    return counts


def _run_row(store: Store, run: str, source: Source, status: str, started: datetime, counts: dict[str, int] | None = None, failures: int = 0) -> None:
    done = None if status == "running" else datetime.now(UTC)
    c = {"fetched_count": 0, "company_count": 0, "job_count": 0, "lead_count": 0} | (counts or {})
    row = store.spark.createDataFrame([(run, source.id, started, done, status, source.full_snapshot, c["fetched_count"], c["company_count"], c["job_count"], c["lead_count"], failures, json.dumps(c))], TABLES["ingestion_runs"])
    store.commit({"ingestion_runs": Upserted(row)}, reads=())


def run_source(store: Store, source: Source, collect: Callable[[Source], Batch], dry_run: bool = False, resume: bool = False, run: str | None = None, now: datetime | None = None, report: Callable = lambda *_a, **_k: None) -> dict:
    """One source from collection to commit. A disabled source is an error; a dry run opens no table; a completed run is taken up by `resume`."""
    if not source.enabled:
        raise ValueError(f"source {source.id} is disabled")
    now = now or datetime.now(UTC)
    run = run or run_id(source.id, now)
    report("source_started", source=source.id, run=run)
    if dry_run:
        batch = collect(source)
        found = {n: rows.count() for n in ("jobs", "companies", "leads") if (rows := getattr(batch, n)) is not None}
        report("dry_run_completed", source=source.id, **found)
        return found
    done = store.snapshot().read("ingestion_runs").filter((F.col("run_id") == run) & (F.col("status") == "completed")).first()
    if resume and done:
        report("source_resumed", source=source.id)
        return {k: done[k] for k in ("fetched_count", "company_count", "job_count", "lead_count")}
    _run_row(store, run, source, "running", now)
    try:
        counts = persist(store, collect(source), source, run, now)
    except BaseException as e:
        _run_row(store, run, source, "failed", now, failures=1)
        report("source_failed", source=source.id, error=str(e))
        raise
    _run_row(store, run, source, "completed", now, counts)
    report("source_completed", source=source.id, **counts)
    return counts


def run_weekly(store: Store, sources: dict[str, Source], collect: Callable[[Source], Batch], report: Callable = lambda *_a, **_k: None, **options) -> dict[str, dict]:
    """Every enabled source that is due weekly or daily; one that fails does not stop the others, and all failures are raised at the end."""
    done, failed = {}, {}
    for s in sources.values():
        if s.enabled and s.refresh in ("weekly", "daily"):
            try:
                done[s.id] = run_source(store, s, collect, report=report, **options)
            except Exception as e:
                failed[s.id] = e
    if failed:
        report("weekly_failed", failed=sorted(failed))
        raise RuntimeError("failed sources: " + ", ".join(f"{k} ({e})" for k, e in sorted(failed.items())))
    report("weekly_completed", sources=sorted(done))
    return done


def bootstrap(store: Store, folder: str) -> bool:
    """Fills the tables from a public CSV export, if there is no company yet; whether it did."""
    base = store.snapshot()
    if not base.read("companies").isEmpty():
        return False
    base.commit({name: restored(store.spark, folder, name, TABLES[name]) for name in ("companies", "jobs", "evidence")})
    return True


def stats(tables: dict[str, DataFrame]) -> dict[str, int]:
    return counted(tables)

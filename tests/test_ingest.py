"""Feeds to tables to exports, with the fixtures' shapes and a fetcher that reaches no network."""

import datetime
import json

import pytest

from provenir.operators import lifecycle, quality
from provenir.plans import ingest
from provenir.schemas import TABLES
from provenir.sinks import archive, export, progress
from provenir.sinks.store import Store, Upserted
from provenir.sources import catalog, feeds, http
from provenir.sources.collect import collect

NOW = datetime.datetime(2026, 8, 27, 12, tzinfo=datetime.UTC)


pytestmark = pytest.mark.usefixtures("small_plans")


def source(connector, **more):
    fields = dict(id=connector, name=connector, owner="o", kind="k", connector=connector, access_mode="api", attribution="by", base_url=f"https://{connector}.example/api", redistribution="attributed", obey_robots=False)
    return catalog.Source(**(fields | more))


def documents(spark, *bodies, urls=None):
    rows = [(i, (urls or {}).get(i, f"https://feed.example/{i}"), bytearray((b if isinstance(b, str) else json.dumps(b)).encode()), NOW) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "seq long, url string, content binary, observed_at timestamp")


#: A week of a feed: two employers with three postings, one for cooks, one closed to the world, one without a title.
FEED = [
    {"legal": "terms apply"},
    {"id": "p7", "position": "Senior Platform Engineer", "company": "Sakura Cloud KK", "location": "Worldwide", "description": "<p>Kubernetes &amp; Terraform, 5+ years.</p> NOT FOR PRINT", "url": "https://sakura.test/p7?utm_medium=feed", "apply_url": "https://sakura.test/apply/p7", "tags": ["sre"], "date": "2026-05-02T08:30:00+09:00", "salary": "NPR 150,000 - 180,000 per month"},
    {"id": "p8", "position": "Data Engineer", "company": "Sakura Cloud KK", "location": "Worldwide", "description": "Spark and SQL", "url": "https://sakura.test/p8", "salary": "€64k"},
    {"id": "p9", "position": "Junior QA Engineer", "company": "Bossa Testes", "location": "Worldwide", "description": "Selenium", "url": "https://bossa.test/9"},
    {"id": "c1", "position": "Pastry Chef", "company": "Doce Vida", "url": "https://doce.test/1"},
    {"id": "u1", "position": "Backend Developer", "company": "Fenced Inc", "location": "US only", "description": "", "url": "https://fenced.test/1"},
    {"id": "n1", "position": "", "company": "Nameless"},
]


def test_feed_rows(spark):
    rows = {r["external_id"]: r for r in feeds.remoteok(documents(spark, "\ufeff" + json.dumps(FEED)), source("remoteok")).jobs.collect()}
    assert set(rows) == {"p7", "p8", "p9", "c1", "u1"} and [rows[k]["pos"] for k in ("p7", "p8", "p9")] == sorted(rows[k]["pos"] for k in ("p7", "p8", "p9"))
    one, chef = rows["p7"], rows["c1"]
    assert one["company_name"] == "Sakura Cloud KK" and one["skills"] == ["sre"] and one["posted_at"] == datetime.datetime(2026, 5, 1, 23, 30) and one["workplace_type"] == "remote"
    assert chef["candidate_location"] == "Worldwide" and chef["salary_text"] is None


def test_other_feeds(spark):
    remotive = {"job-count": 1, "jobs": [{"id": 202, "url": "https://r.example/202", "title": "Remote QA Engineer", "company_name": "Quality Works", "category": "QA", "job_type": "full_time", "publication_date": "2026-08-21T12:00:00Z", "candidate_required_location": "Asia", "salary": "USD 30000-45000 per year", "description": "d"}, {"id": 1, "title": "x"}]}
    (row,) = feeds.remotive(documents(spark, remotive), source("remotive")).jobs.collect()
    assert (row["company_name"], row["external_id"], row["skills"], row["description_public"]) == ("Quality Works", "202", ["QA"], True)
    himalayas = {"data": [{"url": "https://h/1", "guid": 7, "company": {"name": "A", "website": "https://a.io"}, "title": "T", "locationRestrictions": ["Nepal", "India"], "pubDate": 1700000000}, {"url": "u2", "companyName": "B", "title": "S", "location": "Anywhere"}], "nextCursor": "c"}
    one, two = feeds.himalayas(documents(spark, himalayas), source("himalayas")).jobs.orderBy("pos").collect()
    assert (one["company_name"], one["company_website"], one["location_text"], one["external_id"], one["posted_at"]) == ("A", "https://a.io", "Nepal, India", "7", None)
    assert (two["company_name"], two["location_text"]) == ("B", "Anywhere") and feeds.next_cursor(json.dumps(himalayas)) == "c"
    with pytest.raises(Exception, match="no title"):
        feeds.himalayas(documents(spark, {"jobs": [{"url": "x"}]}), source("himalayas")).jobs.collect()


def test_boards(spark):
    boards = {"parameters": {"boards": ["acme", {"token": "beta", "company": "Beta Co", "website": "https://beta.io"}, "jobs", "v1"]}}  # two tokens that are parts of every address
    at = {0: "https://b.example/v1/boards/acme/jobs?content=true", 1: "https://b.example/v1/boards/beta/jobs?content=true"}
    body = {"jobs": [{"id": 1, "absolute_url": "https://b/1", "title": "Dev", "content": "hybrid", "location": {"name": "Here"}, "updated_at": "2026-01-01"}]}
    got = feeds.greenhouse(documents(spark, body, body, urls=at), source("greenhouse", **boards))
    assert sorted((r["company_name"], r["workplace_type"], r["location_text"]) for r in got.jobs.collect()) == [("Beta Co", "hybrid", "Here"), ("acme", "hybrid", "Here")]
    assert sorted(r["name"] for r in got.companies.collect()) == ["Beta Co", "acme"]
    lever = [{"id": "a", "text": "Dev", "description": "one", "additional": "two", "hostedUrl": "https://l/a", "categories": {"location": "X", "commitment": "Full-time"}}]
    (row,) = feeds.lever(documents(spark, lever, urls={0: "https://l.example/v0/postings/acme?mode=json"}), source("lever", **boards)).jobs.collect()
    assert (row["description"], row["apply_url"], row["employment_type"]) == ("one two", "https://l/a", "Full-time")
    ashby = {"jobs": [{"title": "Dev", "jobUrl": "https://a/1", "descriptionHtml": "", "descriptionPlain": "p", "workplaceType": "Remote"}]}
    (row,) = feeds.ashby(documents(spark, ashby, urls={0: "https://a.example/posting-api/job-board/acme?x"}), source("ashby", **boards)).jobs.collect()
    assert (row["external_id"], row["description"], row["workplace_type"]) == ("https://a/1", "p", "remote")
    with pytest.raises(ValueError):
        source("lever").parameter("boards")
    with pytest.raises(ValueError):
        feeds.connector(source("nothing"))


def test_leads_csv_and_directory(spark, tmp_path):
    brave = feeds.brave_search(documents(spark, {"web": {"results": [{"url": "https://x", "title": "t"}]}}), source("brave_search"))
    assert brave.leads.first()["source_url"] == "https://x" and not brave.full_snapshot
    assert [r["external_id"] for r in feeds.google_places(documents(spark, {"places": [{"id": "p1", "name": "dropped"}, {}]}), source("google_places")).leads.collect()] == ["p1"]
    path = tmp_path / "m.csv"
    path.write_text("﻿name,sectors,confidence,registration_id\nAcme,ai|web,0.5,r1\n,x,,\nBeta,,,\n", encoding="utf-8")
    rows = {r["name"]: r for r in feeds.manual_csv(feeds.read_manual_csv(spark, str(path)), source("manual_csv")).companies.collect()}
    assert rows["Acme"]["sectors"] == ["ai", "web"] and rows["Beta"]["sectors"] == ["technology"] and rows["Beta"]["confidence"] == 0.9 and len(rows) == 2 and rows["Beta"]["country"] == "Nepal"
    page = "<ul><li class='m x'><h3>One <b>Co</b></h3><a class=site href='https://one.io'>w</a><br><p class=loc>Here</p></li><li class=m><h3></h3></li><li>no</li></ul>"
    (row,) = feeds.html_directory(documents(spark, page), source("html_directory", parameters={"item_selector": "li.m", "name_selector": "h3", "website_selector": "a.site", "location_selector": "p.loc"})).companies.collect()
    assert (row["name"], row["website"], row["locality"]) == ("One Co", "https://one.io", "Here")


def batch_of(spark, rows):
    return feeds.remoteok(documents(spark, rows), source("remoteok"))


def week(k):
    return NOW + datetime.timedelta(weeks=k)


def jobs_of(store):
    return {r["title"]: r for r in store.snapshot().read("jobs").collect()}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory, small_plans):
    """A store after one week of the feed."""
    store = Store(spark, str(tmp_path_factory.mktemp("stored")))
    told = []
    counts = ingest.run_source(store, source("remoteok"), lambda s: batch_of(spark, FEED), now=NOW, report=lambda e, **k: told.append(e))
    assert told == ["source_started", "source_completed"] and counts == {"fetched_count": 0, "company_count": 0, "job_count": 3, "lead_count": 0}
    return store


def test_postings_of_a_week(stored):
    jobs = jobs_of(stored)
    one, two, three = (jobs[t] for t in ("Senior Platform Engineer", "Data Engineer", "Junior QA Engineer"))
    assert (one["seniority"], one["min_years_experience"], one["salary_min"], one["salary_max"], one["salary_currency"], one["salary_period"]) == ("senior", 5.0, 150000.0, 180000.0, "NPR", "month")
    assert (two["salary_min"], two["salary_currency"], two["salary_period"], three["seniority"], three["early_career_fit"]) == (64000.0, "EUR", None, "entry", True)
    assert one["company_id"] == two["company_id"] != three["company_id"] and one["source_url"] == "https://sakura.test/p7" and len(jobs) == 3
    now = stored.snapshot()
    assert sorted(r["canonical_name"] for r in now.read("companies").collect()) == ["Bossa Testes", "Fenced Inc", "Sakura Cloud KK"]
    assert [r["kind"] for r in now.read("review_queue").collect()] == ["ineligible_job_audit"]
    assert sorted(r["record_type"] for r in now.read("evidence").collect()) == ["company"] * 4 + ["job"] * 3
    assert ingest.stats(now.tables()) == {"companies": 3, "active_jobs": 3, "pending_review": 1, "failed_runs": 0}


def test_weeks_that_follow(spark, stored, tmp_path):
    """A posting that is gone misses a run, comes back by a board, and a failed week changes nothing."""
    store = Store(spark, str(tmp_path / "t"))
    store.commit({n: rows for n, rows in stored.snapshot().tables().items() if n != "source_documents"})
    feed = source("remoteok")
    state = lambda: {t: (r["status"], r["missing_runs"]) for t, r in jobs_of(store).items()}
    ingest.run_source(store, feed, lambda s: batch_of(spark, [r for r in FEED if r.get("id") != "p8"]), now=week(1))
    missed = {"Senior Platform Engineer": ("active", 0), "Data Engineer": ("active", 1), "Junior QA Engineer": ("active", 0)}
    assert state() == missed
    with pytest.raises(RuntimeError, match="remoteok"):
        ingest.run_weekly(store, {"remoteok": feed, "off": source("remotive", enabled=False)}, lambda s: 1 / 0, now=week(2))
    assert state() == missed and ingest.stats(store.snapshot().tables())["failed_runs"] == 1
    before = jobs_of(store)["Data Engineer"]
    board = source("lever", parameters={"boards": [{"token": "sakura", "company": "Sakura Cloud KK"}]})
    posting = [{"id": "zz", "text": "Data Engineer", "description": "spark, worldwide", "hostedUrl": "https://boards.test/zz", "categories": {"location": "Worldwide"}}]
    ingest.run_source(store, board, lambda s: feeds.lever(documents(spark, posting, urls={0: "https://l.example/v0/postings/sakura?mode=json"}), board), now=week(2))
    back = jobs_of(store)["Data Engineer"]
    assert (back["job_id"], back["first_seen_at"], back["missing_runs"], back["source_id"]) == (before["job_id"], before["first_seen_at"], 0, "lever")
    ingest.run_source(store, feed, lambda s: batch_of(spark, FEED), now=week(3))
    kept = jobs_of(store)["Data Engineer"]  # the board outranks the feed
    assert (kept["source_id"], kept["source_url"], kept["salary_min"]) == ("lever", "https://boards.test/zz", 64000.0) and len(jobs_of(store)) == 3
    assert ingest.run_source(store, feed, lambda s: 1 / 0, now=week(3), resume=True)["job_count"] == 3
    with pytest.raises(ValueError):
        ingest.run_source(store, source("remotive", enabled=False), None)


def test_employers_of_one_batch(spark, tmp_path):
    """Three spellings of one employer in a batch, two that are only similar, and a writer who comes between with one of these."""
    names = ["Aurora Sistemas", "aurora sistemas", "Aurora Sistemas do Brasil", "Aurora Systemas", "Aurora Sistemos"]
    rows = [{"id": str(k), "position": f"Software Engineer {k}", "company": n, "location": "Worldwide", "url": f"https://a.test/{k}"} for k, n in enumerate(names)]
    store, tries = Store(spark, str(tmp_path / "t")), []
    commit = Store.commit

    def late(self, changes, *args, **more):
        """Another source commits a company while this batch is being applied."""
        if "companies" in changes and not tries:
            tries.append(1)
            fields = [c.split(" ", 1)[0] for c in TABLES["companies"].split(", ")]
            row = tuple({"company_id": "other", "canonical_name": "Aurora Systemas Ltda", "active": True, "first_seen_at": NOW, "aliases": []}.get(f) for f in fields)
            commit(Store(spark, store.root), {"companies": Upserted(spark.createDataFrame([row], TABLES["companies"]))}, reads=())
        return commit(self, changes, *args, **more)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(Store, "commit", late)
        ingest.run_source(store, source("remoteok"), lambda s: batch_of(spark, [{}, *rows]), now=NOW)
    now = store.snapshot()
    assert sorted((r["canonical_name"], tuple(r["aliases"])) for r in now.read("companies").collect()) == [("Aurora Sistemas", ("Aurora Sistemas do Brasil", "aurora sistemas")), ("Aurora Sistemos", ()), ("Aurora Systemas Ltda", ("Aurora Systemas",))]
    assert [r["kind"] for r in now.read("review_queue").collect()] == ["company_merge"] and tries == [1]


def test_exports(spark, stored, tmp_path):
    import hashlib

    import duckdb

    tables, known = stored.snapshot().tables(), {"remoteok": source("remoteok")}
    folder = tmp_path / "out" / "data" / "data"  # the folder's name recurs in its path
    files = export.export(tables, known, folder, "csv")
    assert set(files) == {"ATTRIBUTION.md", "COVERAGE.md", "DATA_DICTIONARY.md", "companies.csv", "evidence.csv", "jobs.csv", "manifest.json", "runs.csv", "sources.json"}
    text = "".join(p.read_text(encoding="utf-8") for p in (folder / "jobs.csv").glob("part-*"))
    assert "public_description" not in text and "NOT FOR PRINT" not in text and "Senior Platform" in text
    listed = json.loads((folder / "manifest.json").read_text())["files"]
    there = {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file() and not p.name.startswith((".", "_")) and p != folder / "manifest.json"}
    assert {f["path"]: (f["bytes"], f["sha256"]) for f in listed} == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in there.items()}
    fresh = Store(spark, str(tmp_path / "u"))
    assert ingest.bootstrap(fresh, str(folder)) and not ingest.bootstrap(fresh, str(folder))
    again, jobs = jobs_of(fresh), jobs_of(stored)
    assert {t: (r["job_id"], r["skills"], r["last_seen_at"], r["missing_runs"]) for t, r in again.items()} == {t: (r["job_id"], r["skills"], r["last_seen_at"], 0) for t, r in jobs.items()}
    for kind in ("jsonl", "parquet", "duckdb"):
        export.export(tables, known, tmp_path / kind, kind)
    with duckdb.connect(str(tmp_path / "duckdb" / "public.duckdb"), read_only=True) as c:
        assert c.execute("SELECT title, salary_min FROM jobs ORDER BY title").fetchall() == [("Data Engineer", 64000.0), ("Junior QA Engineer", None), ("Senior Platform Engineer", 150000.0)]
        assert [c.execute(f"SELECT count(*) FROM {n}").fetchone()[0] for n in ("companies", "evidence", "runs")] == [3, 7, 1]
    assert '"attribution":"by"' in "".join(p.read_text() for p in (tmp_path / "jsonl" / "jobs.jsonl").glob("part-*"))
    assert export.export_review(tables, str(tmp_path / "review")) == 1


def test_rules_over_tables(spark, stored):
    tables = stored.snapshot().tables()
    good = catalog.as_table(spark, {"remoteok": source("remoteok")})
    issues, metrics = quality.validate(tables, good, ["no maintainer"])
    assert [r["code"] for r in issues.collect()] == ["source_catalog"] and metrics["active_companies"] == 3 and metrics["active_jobs"] == 3
    closed = catalog.as_table(spark, {"remoteok": source("remoteok", redistribution="restricted")})
    issues, _ = quality.validate(tables | {"evidence": tables["evidence"].filter("record_type = 'job'")}, closed, release=True)
    count = {r["code"]: r["count"] for r in issues.groupBy("code").count().collect()}
    assert count == {"company_provenance": 3, "restricted_company_source": 3, "restricted_job_source": 3, "release_company_count": 1, "release_job_count": 1}
    twice = tables["jobs"].limit(1)
    issues, _ = quality.validate(tables | {"jobs": tables["jobs"].unionByName(twice)}, good)
    assert {r["code"] for r in issues.collect()} == {"duplicate_jobs", "duplicate_key"}


def test_lifecycle(spark):
    jobs = spark.createDataFrame([("a", "s", "active", 0), ("b", "other", "active", 0)], "job_id string, source_id string, status string, missing_runs int")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "job_id string")
    state = lambda j: {r["job_id"]: (r["status"], r["missing_runs"]) for r in j.collect()}
    assert state(lifecycle.age_missing(jobs, ids(), "s"))["a"] == ("active", 0)
    once = lifecycle.age_missing(jobs, ids("x"), "s")
    assert state(lifecycle.aged(jobs, ids("x"), "s")) == {"a": ("active", 1)} and state(lifecycle.aged(once, ids("x"), "s")) == {"a": ("closed", 2)} and state(lifecycle.aged(jobs, ids("a"), "s")) == {}
    assert state(once) == {"a": ("active", 1), "b": ("active", 0)}
    assert state(lifecycle.age_missing(once, ids("x"), "s"))["a"] == ("closed", 2)


def test_history_is_the_sequence_of_steps(spark):
    import random

    pick = random.Random(5)
    seen = [(d, j) for d in range(9) for j in range(12) if pick.random() < 0.5]
    got = {r["job_id"]: (r["status"], r["missing_runs"]) for r in lifecycle.history(spark.createDataFrame([("s", d, j) for d, j in seen], "source_id string, run_day int, job_id int")).collect()}
    state = {}
    for d in range(9):
        now = {j for day, j in seen if day == d}
        for j in state:
            if now and j not in now and state[j][0] == "active":
                state[j] = ("closed" if state[j][1] + 1 >= 2 else "active", state[j][1] + 1)
        state |= {j: ("active", 0) for j in now}
    assert got == state


def test_fetcher():
    public = lambda host, port, proto=0: [(0, 0, 0, "", ("93.184.216.34", port))]
    for bad in ("file:///x", "https://u:p@x.org", "ftp://x.org"):
        with pytest.raises(http.UnsafeUrl):
            http.validate_public_url(bad, public)
    with pytest.raises(http.UnsafeUrl):
        http.validate_public_url("http://local.test", lambda *a, **k: [(0, 0, 0, "", ("127.0.0.1", 80))])
    answers = [http.Response("", 503, {"retry-after": "1"}, b""), http.Response("", 302, {"location": "/b"}, b""), http.Response("", 200, {}, b"ok")]
    waits = []
    got = http.Fetcher(60, transport=lambda *a: answers.pop(0), resolve=public, sleep=waits.append).fetch("https://x.org/a")
    assert (got.url, got.content) == ("https://x.org/b", b"ok") and 1.0 in waits and len(waits) >= 3
    assert http.retry_after("99", 0) == 30 and http.retry_after(None, 2) == 4 and http.retry_after("Thu, 27 Aug 2026 12:00:10 GMT", 0, NOW) == 10
    robots = {"https://x.org/robots.txt": http.Response("", 200, {}, b"User-agent: *\nDisallow: /no")}
    f = http.Fetcher(600, transport=lambda m, u, h, b: robots.get(u, http.Response("", 200, {}, b"y")), resolve=public, sleep=lambda s: None)
    assert f.allowed("https://x.org/yes") and not f.allowed("https://x.org/no")
    with pytest.raises(PermissionError):
        f.fetch("https://x.org/no", obey_robots=True)


def test_collect_follows_cursors(spark):
    public = lambda host, port, proto=0: [(0, 0, 0, "", ("93.184.216.34", port))]
    pages = [{"jobs": [{"title": f"T{k}", "url": f"https://h/{k}", "companyName": "C"}], "nextCursor": c} for k, c in ((1, "n"), (2, None))]
    f = http.Fetcher(600, transport=lambda *a: http.Response("", 200, {}, json.dumps(pages.pop(0)).encode()), resolve=public, sleep=lambda s: None)
    batch = collect(spark, source("himalayas"), f)
    assert [r["title"] for r in batch.jobs.orderBy("pos").collect()] == ["T1", "T2"] and batch.documents.count() == 2


def test_catalog(tmp_path):
    text = "id: {}\nname: n\nowner: o\nkind: k\nconnector: remotive\naccess_mode: {}\nattribution: a\nbase_url: https://x\n"
    (tmp_path / "a.yaml").write_text(text.format("one", "api"))
    assert list(catalog.load(tmp_path)) == ["one"] and catalog.check(catalog.load(tmp_path)) == []
    (tmp_path / "b.yaml").write_text(text.format("one", "api"))
    with pytest.raises(ValueError):
        catalog.load(tmp_path)
    (tmp_path / "b.yaml").write_text(text.format("two", "blocked"))
    with pytest.raises(ValueError):
        catalog.load(tmp_path)
    (tmp_path / "b.yaml").write_text(text.format("two", "blocked") + "blocked_reason: terms\n")
    assert len(catalog.check(catalog.load(tmp_path))) == 1 and catalog.check({})


def test_archive_and_progress(tmp_path):
    store = archive.choose_store({"RAW_DIR": str(tmp_path / "raw")})
    key = store.put("s", "r", b"content", {"fetched_at": NOW.isoformat()})
    assert store.put("s", "r", b"content", {}) == key and (tmp_path / "raw" / key).exists()
    assert archive.prune(tmp_path / "raw", {"s": 5}, NOW + datetime.timedelta(days=5)) == 0
    assert archive.prune(tmp_path / "raw", {"s": 5}, NOW + datetime.timedelta(days=6)) == 1 and not (tmp_path / "raw" / key).exists()
    put = []
    client = type("C", (), {"put_object": lambda self, **k: put.append(k["Key"])})()
    remote = archive.choose_store({k: "x" for k in ("R2_ENDPOINT_URL", "R2_BUCKET", "R2_ACCESS_KEY_ID", "R2_SECRET_ACCESS_KEY")}, lambda *a: client)
    assert remote.put("s", "r", b"c", {}).startswith("s3://x/s/r/") and len(put) == 1
    one, two = progress.Progress(tmp_path, "collect"), progress.Progress(tmp_path, "collect")
    one("fetch_completed", source="s", request=1, elapsed=0.5)
    said = json.loads(one.path.read_text())
    assert one.path != two.path and said["event"] == "fetch_completed" and said["timestamp"].endswith("+00:00") and said["source"] == "s"


def test_stream_of_snapshots(spark, tmp_path):
    from provenir.streaming import lifecycle as stream

    store = Store(spark, str(tmp_path / "t"))
    names = [c.split(" ", 1)[0] for c in TABLES["jobs"].split(", ")]
    row = lambda j: tuple({"job_id": j, "source_id": "s", "status": "active", "missing_runs": 0, "last_seen_at": NOW, "first_seen_at": NOW}.get(n) for n in names)
    store.commit({"jobs": spark.createDataFrame([row("a"), row("b")], TABLES["jobs"])})
    schema = "source_id string, job_id string, observed_at timestamp"
    (tmp_path / "in").mkdir()
    for k in range(2):
        spark.createDataFrame([("s", "a", NOW + datetime.timedelta(days=k))], schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        query = stream.follow(store, spark.readStream.schema(schema).json(str(tmp_path / "in")), str(tmp_path / "cp"))
        query.processAllAvailable()
        query.stop()
    got = {r["job_id"]: (r["status"], r["missing_runs"]) for r in store.read("jobs").collect()}
    assert got == {"a": ("active", 0), "b": ("closed", 2)}
    counts = stream.windowed_counts(spark.read.schema(schema).json(str(tmp_path / "in"))).collect()
    assert len(counts) == 2 and {r["n"] for r in counts} == {1}


def test_network_errors_are_tried_again():
    import urllib.error

    from provenir.sources.http import Fetcher, Response

    told, answers = [], [urllib.error.URLError("refused"), TimeoutError(), Response("", 200, {}, b"x")]

    def send(*_):
        got = answers.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    fetcher = Fetcher(6000, transport=send, resolve=lambda *_a, **_k: [(0, 0, 0, "", ("8.8.8.8", 443))], sleep=lambda _s: None, report=lambda event, **_k: told.append(event))
    assert fetcher.fetch("https://a.example/").content == b"x" and told == ["fetch_started", "fetch_retried", "fetch_retried", "fetch_completed"]


def test_answers_are_archived_before_they_are_read(spark, tmp_path):
    import zstandard

    from provenir.sinks.archive import FolderStore
    from provenir.sources.collect import collect
    from provenir.sources.http import Response

    class Fixed:
        def fetch(self, url, **_):
            return Response(url, 200, {}, b'{"jobs": []}')

    told = []
    remotive = source("remotive", base_url="https://jobs.example/feed")
    batch = collect(spark, remotive, Fixed(), {}, FolderStore(tmp_path), "run-1", lambda event, **_: told.append(event))
    row = batch.documents.first()
    assert row["run_id"] == "run-1" and zstandard.decompress((tmp_path / row["storage_pointer"]).read_bytes()) == b'{"jobs": []}'
    assert told == ["archive_started", "archive_completed"]


def test_command_line(spark, stored, tmp_path, capsys, monkeypatch):
    """Commands over a data folder: a dry run, a weekly run with documents in the archive, validation, export, review, counts."""
    from provenir import cli
    from provenir.sinks.archive import FolderStore
    from provenir.sources.http import Response

    monkeypatch.setattr(cli, "session", lambda: spark)
    (tmp_path / "sources").mkdir()
    (tmp_path / "sources" / "remoteok.yaml").write_text("id: remoteok\nname: Feed\nowner: o\nkind: jobs\nconnector: remoteok\naccess_mode: api\nattribution: by\nbase_url: https://feed.example/api\nredistribution: attributed\nobey_robots: false\nrefresh: weekly\n")

    class Fixed:
        def fetch(self, url, **_):
            return Response(url, 200, {"content-type": "application/json"}, json.dumps(FEED[:3]).encode())

    def run(*args):
        code = cli.main(["--data", str(tmp_path / "data"), "--sources", str(tmp_path / "sources"), *args], lambda s: collect(spark, s, Fixed(), {}, FolderStore(tmp_path / "data" / "raw"), "r"))
        return code, capsys.readouterr().out.strip().splitlines()[-1]

    assert run("sources", "list") == (0, "remoteok\tenabled\tapi\tFeed") and run("sources", "check") == (0, "ok")
    assert json.loads(run("collect", "--source", "remoteok", "--dry-run")[1]) == {"jobs": 2} and not (tmp_path / "data" / "tables").exists()
    code, said = run("run", "weekly", "--bootstrap", str(tmp_path / "none"))
    assert code == 0 and json.loads(said)["remoteok"]["job_count"] == 2 and json.loads(said)["remoteok"]["fetched_count"] == 1
    (document,) = Store(spark, str(tmp_path / "data" / "tables")).read("source_documents").collect()
    assert (tmp_path / "data" / "raw" / document["storage_pointer"]).stat().st_size > 0
    code, said = run("validate")
    assert code == 0 and json.loads(said)["ok"] and json.loads(said)["active_jobs"] == 2
    assert run("validate", "--release")[0] == 1 and json.loads((tmp_path / "data" / "reports" / "validation.json").read_text())["errors"] == {"release_company_count": 1, "release_job_count": 1}
    assert "jobs.jsonl" in json.loads(run("export", "--format", "jsonl", "--output", str(tmp_path / "public"))[1])
    assert run("review", "export", "--output", str(tmp_path / "queue")) == (0, "0")
    assert json.loads(run("stats")[1]) == {"companies": 1, "active_jobs": 2, "pending_review": 0, "failed_runs": 0}


def test_snapshots_in_parts_and_replays(spark, tmp_path):
    from datetime import UTC, datetime

    from provenir.schemas import TABLES
    from provenir.sinks.store import Store, Upserted
    from provenir.streaming import lifecycle as stream

    store = Store(spark, f"file://{tmp_path}/tables")
    fields = [f.split(" ")[0] for f in TABLES["jobs"].split(", ")]
    known = {"status": "active", "missing_runs": 0, "last_seen_at": datetime(2026, 1, 1, tzinfo=UTC)}
    rows = [tuple(({"job_id": k, "source_id": s} | known).get(f) for f in fields) for k, s in (("a", "x"), ("b", "x"), ("c", "y"))]
    store.commit({"jobs": spark.createDataFrame(rows, TABLES["jobs"])})
    seen = lambda *rows: spark.createDataFrame([(s, k, datetime(2026, 1, 2, tzinfo=UTC), w) for s, k, w in rows], "source_id string, job_id string, observed_at timestamp, complete boolean")
    state = lambda: {r["job_id"]: (r["status"], r["missing_runs"]) for r in store.read("jobs").collect()}
    assert stream.apply_snapshots(store, seen(("x", "a", False)), 0) and state() == {k: ("active", 0) for k in "abc"}
    assert stream.apply_snapshots(store, seen(("x", "a", True)), 1) and state()["b"] == ("active", 1)
    assert not stream.apply_snapshots(store, seen(("x", "a", True)), 1) and state()["b"] == ("active", 1)
    assert stream.apply_snapshots(store, seen(("x", "a", True)), 2) and state() == {"a": ("active", 0), "b": ("closed", 2), "c": ("active", 0)}

"""Source catalog: YAML definitions, checked before anything is fetched."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

MODES = ("api", "feed", "html", "manual", "search", "blocked", "partner")
_ID = re.compile(r"[a-z0-9][a-z0-9_-]+")


@dataclass
class Source:
    id: str
    name: str
    owner: str
    kind: str
    connector: str
    access_mode: str
    attribution: str
    base_url: str | None = None
    terms_url: str | None = None
    enabled: bool = True
    blocked_reason: str | None = None
    obey_robots: bool = True
    requests_per_minute: int = 30
    redistribution: str = "facts_only"
    raw_retention_days: int = 90
    refresh: str = "weekly"
    full_snapshot: bool = True
    parameters: dict = field(default_factory=dict)

    def __post_init__(self):
        problems = []
        if not _ID.fullmatch(self.id):
            problems.append("id")
        if self.access_mode not in MODES:
            problems.append("access_mode")
        if not 1 <= self.requests_per_minute <= 600:
            problems.append("requests_per_minute")
        if not 0 <= self.raw_retention_days <= 3650:
            problems.append("raw_retention_days")
        if self.access_mode == "blocked" and not self.blocked_reason:
            problems.append("blocked_reason")
        if problems:
            raise ValueError(f"source {self.id}: {', '.join(problems)}")

    def parameter(self, key: str):
        """A parameter the connector cannot do without."""
        if not self.parameters.get(key):
            raise ValueError(f"source {self.id} needs parameter {key}")
        return self.parameters[key]


def load(folder: str | Path) -> dict[str, Source]:
    """Sources of every YAML file, by file name; an id that comes twice or an unknown key is an error."""
    import yaml

    found: dict[str, Source] = {}
    for path in sorted(Path(folder).glob("*.yaml")):
        source = Source(**yaml.safe_load(path.read_text(encoding="utf-8")))
        if source.id in found:
            raise ValueError(f"source id {source.id} comes twice")
        found[source.id] = source
    return found


def check(sources: dict[str, Source]) -> list[str]:
    """Why the catalog must not be used; nothing if it may."""
    if not sources:
        return ["No source definitions were found."]
    said = []
    for s in sources.values():
        if s.enabled and s.access_mode == "blocked":
            said.append(f"{s.id}: a blocked source is enabled.")
        if s.enabled and not s.base_url and s.access_mode not in ("manual", "search"):
            said.append(f"{s.id}: an enabled source has no base_url.")
        if s.enabled and s.redistribution == "unknown":
            said.append(f"{s.id}: an enabled source has unreviewed redistribution terms.")
    return said


def as_table(spark: SparkSession, sources: dict[str, Source]) -> DataFrame:
    import json

    rows = [{**asdict(s), "parameters": json.dumps(s.parameters, sort_keys=True)} for s in sources.values()]
    schema = (
        "id string, name string, owner string, kind string, connector string, access_mode string, attribution string, base_url string, terms_url string, enabled boolean, "
        "blocked_reason string, obey_robots boolean, requests_per_minute int, redistribution string, raw_retention_days int, refresh string, full_snapshot boolean, parameters string"
    )
    return spark.createDataFrame([tuple(r[f.split()[0]] for f in schema.split(", ")) for r in rows], schema)

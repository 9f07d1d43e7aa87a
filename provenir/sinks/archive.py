"""Raw documents kept by content, and their retention."""

from __future__ import annotations

import hashlib
import json
import os
from datetime import datetime
from pathlib import Path
from typing import Protocol

import zstandard

LEVEL = 9


class ArchiveStore(Protocol):
    def put(self, source_id: str, run_id: str, content: bytes, meta: dict) -> str: ...


class FolderStore:
    """root/source/run/sha256.bin.zst with a sidecar of metadata; content that is there is not written again."""

    def __init__(self, root: str | Path):
        self.root = Path(root)

    def put(self, source_id: str, run_id: str, content: bytes, meta: dict) -> str:
        key = Path(source_id) / run_id / f"{hashlib.sha256(content).hexdigest()}.bin.zst"
        path = self.root / key
        if not path.exists():
            path.parent.mkdir(parents=True, exist_ok=True)
            draft = path.with_suffix(f".{os.getpid()}")
            draft.write_bytes(zstandard.ZstdCompressor(level=LEVEL).compress(content))
            draft.replace(path)
            path.with_name(path.name.replace(".bin.zst", ".meta.json")).write_text(json.dumps(meta, default=str, sort_keys=True), encoding="utf-8")
        return str(key)


class ObjectStore:
    """The same keys in an S3-compatible bucket, by a client with put_object."""

    def __init__(self, client, bucket: str):
        self.client, self.bucket = client, bucket

    def put(self, source_id: str, run_id: str, content: bytes, meta: dict) -> str:
        key = f"{source_id}/{run_id}/{hashlib.sha256(content).hexdigest()}.bin.zst"
        self.client.put_object(Bucket=self.bucket, Key=key, Body=zstandard.ZstdCompressor(level=LEVEL).compress(content), Metadata={k: str(v) for k, v in meta.items()})
        return f"s3://{self.bucket}/{key}"


def choose_store(settings: dict[str, str], make_client=None) -> ArchiveStore:
    """The bucket if its four settings are all there, else the folder."""
    wanted = [settings.get(k) for k in ("R2_ENDPOINT_URL", "R2_BUCKET", "R2_ACCESS_KEY_ID", "R2_SECRET_ACCESS_KEY")]
    if all(wanted):
        return ObjectStore((make_client or _s3)(*wanted), wanted[1])
    return FolderStore(settings.get("RAW_DIR", "data/raw"))


def _s3(endpoint: str, _bucket: str, key: str, secret: str):
    import boto3

    return boto3.client("s3", endpoint_url=endpoint, aws_access_key_id=key, aws_secret_access_key=secret)


def prune(root: str | Path, retention_days: dict[str, int], now: datetime) -> int:
    """Removes documents of a source older than its days; how many."""
    gone = 0
    for meta in Path(root).glob("*/*/*.meta.json"):
        said = json.loads(meta.read_text(encoding="utf-8"))
        days = retention_days.get(meta.parent.parent.name)
        if days is not None and (now - datetime.fromisoformat(str(said["fetched_at"]))).days > days:
            meta.with_name(meta.name.replace(".meta.json", ".bin.zst")).unlink(missing_ok=True)
            meta.unlink()
            gone += 1
    return gone

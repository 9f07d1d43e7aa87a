"""Progress: a line on the terminal and a JSON line in a file of its own."""

from __future__ import annotations

import json
import sys
import threading
import uuid
from datetime import UTC, datetime
from pathlib import Path


class Progress:
    def __init__(self, folder: str | Path, command: str, stream=sys.stderr):
        now = datetime.now(UTC)
        self.command, self._stream, self._lock = command, stream, threading.Lock()
        self.path = Path(folder) / f"{now:%Y%m%dT%H%M%SZ}-{command}-{uuid.uuid4().hex[:8]}.jsonl"
        self.path.parent.mkdir(parents=True, exist_ok=True)

    def __call__(self, event: str, **details) -> None:
        row = {"timestamp": datetime.now(UTC).isoformat(), "command": self.command, "event": event, **details}
        with self._lock:
            with self.path.open("a", encoding="utf-8") as f:
                f.write(json.dumps(row, default=str, ensure_ascii=False) + "\n")
            print(f"{event}: " + ", ".join(f"{k}={v}" for k, v in details.items()), file=self._stream)

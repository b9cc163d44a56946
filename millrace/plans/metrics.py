"""Run times and counts of a run, kept as a small JSON line."""

from __future__ import annotations

import json
import time
from contextlib import contextmanager
from pathlib import Path


@contextmanager
def timed(run_id: str, log: str | None = None):
    """Yields a dict; on leaving, start, end and elapsed seconds are added and appended to ``log`` or printed."""
    found: dict = {"run": run_id, "start": time.time()}
    try:
        yield found
    finally:
        found["end"] = time.time()
        found["elapsed_s"] = round(found["end"] - found["start"], 3)
        line = json.dumps(found)
        if log:
            with Path(log).open("a") as f:
                f.write(line + "\n")
        else:
            print(line)

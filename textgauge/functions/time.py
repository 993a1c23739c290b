"""Run identity and timestamps. Both are parameters of a job, never read inside it."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_identity() -> tuple[str, str]:
    """A new run id and the present time, to be passed to one job."""
    return str(uuid.uuid4()), datetime.now(timezone.utc).isoformat().replace("+00:00", "Z")


def utc_text(timestamp: Column) -> Column:
    """A UTC timestamp as ISO-8601 text, for output."""
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")

"""Plain versions of what several operators share."""

from __future__ import annotations

import os
import re

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, n_lines long, rk string, id string"


def documents(spark, texts, ids=None):
    """Rows with further columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 7, "x", "y") for i, t in zip(ids, texts)], DOCS)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def split(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


class Groups:
    """Union-find; a group's name is its smallest member."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def find(self, m):
        while self.up[m] != m:
            m = self.up[m]
        return m

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)

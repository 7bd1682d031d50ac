"""Memory that a task's worker no longer needs is given back, because the worker stays."""

from __future__ import annotations

import numpy as np
import pandas as pd

from tidemark.llm import quality


def test_fitting_gives_its_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(quality, "give_back", lambda: given.append(1))
    rows = pd.DataFrame({"order": [2, 1], "text": [b"good words here", b"bad bad bad"], "label": [1, 0]})
    assert len(quality.fit_shard(rows)) > 0
    assert given


def test_scoring_gives_its_memory_back(documents, monkeypatch):
    wrapped = []
    monkeypatch.setattr(quality, "trimmed", lambda batches: wrapped.append(1) or batches)
    docs = documents([(1, "one two three"), (2, None)])
    run = {}
    frame = type(docs)
    whole = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, job, schema: (run.update(job=job), whole(self, job, schema))[1])
    quality.score(docs, np.zeros((1 << quality.BITS) + 1))
    run["job"](iter([]))
    assert wrapped

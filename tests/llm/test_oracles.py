"""The text queries that SQL can express, against their SQL over whole tables."""

from __future__ import annotations

import pytest

from check_oracles import compare, connect
from tidemark.llm.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf, name):
    assert compare(spark, connect(sf), name, sf).startswith("ok ")

"""Every core query against its SQL, and figures known for the feed."""

import pytest

from conftest import SF
from tidemark import queries as core


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query_equals_sql(spark, duck, same, name):
    same(core.queries()[name](spark, SF).toPandas(), duck.execute(core.oracle_sql()[name]).df())


def test_known_counts(spark):
    q = core.queries()
    counts = {n: q[n](spark, SF).count() for n in ("feed", "replay_current", "current_state", "inv_tombstone", "inv_latest_seqval")}
    assert counts == {"feed": 1500, "replay_current": 129, "current_state": 145, "inv_tombstone": 2, "inv_latest_seqval": 18}


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 145
    assert set(core.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())

"""Every query with a SQL twin gives the twin's rows and types."""

import pytest
from compare import diff, duck

from quaymart.plans import registry

registry.load_all()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(registry.SQL_TWINS))
def test_twin(spark, con, small, name):
    df = registry.QUERIES[name](spark, small)
    problems = [p for p in diff(df, con, registry.SQL_TWINS[name]) if not p.startswith("EMPTY")]
    assert not problems, "\n".join(problems)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL_TWINS)))
def test_rows_only(spark, small, name):
    rows = registry.QUERIES[name](spark, small).collect()  # a count would let the planner drop the columns
    assert rows and all(len(r) for r in rows)
    for r in rows:
        for c in ("probability", "f1", "f1_mean", "accuracy", "importance", "best_on_test"):
            assert c not in r.__fields__ or r[c] is None or 0 <= r[c] <= 1


def test_names():
    assert not [n for n in registry.QUERIES if n.startswith("op") or n == "pipeline"]
    assert set(registry.SQL_TWINS) <= set(registry.QUERIES)

"""Comparisons and audits on random rows against plain counting."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from roundhaul.operators import audit, stats, validate

SCHEMA = "k int, v double, s string"
ROW = st.tuples(
    st.none() | st.integers(0, 4),
    st.none() | st.sampled_from([0.0, 1.5, -2.0]),
    st.none() | st.sampled_from(["", "a", "b"]),
)
ROWS = st.lists(ROW, max_size=25)
RANDOM = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def by_key(rows):
    groups = defaultdict(Counter)
    for row in rows:
        groups[row[0]][row[1:]] += 1
    return groups


@RANDOM
@given(left=ROWS, right=ROWS)
def test_comparisons(spark, left, right):
    source, target = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    lost, made_up = Counter(left) - Counter(right), Counter(right) - Counter(left)
    status = "PASSED" if Counter(left) == Counter(right) else "FAILED"
    counts = (lost.total(), made_up.total(), status)
    assert tuple(validate.content_diff(source, target).first()) == counts
    assert tuple(validate.content_match(source, target).first()) == (len(left), len(right), status)
    found = {tuple(r)[:3]: (r["only_in"], r["copies"]) for r in validate.differing_rows(source, target).collect()}
    sides = (("source", lost), ("target", made_up))
    assert found == {row: (side, n) for side, more in sides for row, n in more.items()}
    before, after = by_key(left), by_key(right)
    changes = {
        key: "added" if key not in before else "removed" if key not in after else "changed"
        for key in before.keys() | after.keys()
        if before.get(key) != after.get(key)
    }
    assert dict(map(tuple, validate.keyed_diff(source, target, ["k"]).collect())) == changes


@RANDOM
@given(rows=ROWS, others=ROWS)
def test_audits_and_statistics(spark, rows, others):
    child, parent = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(others, SCHEMA)
    pairs = Counter((k, s) for k, _, s in rows)
    found = {(r["k"], r["s"]): r["copies"] for r in audit.audit_unique(child, ["k", "s"]).collect()}
    assert found == {pair: n for pair, n in pairs.items() if n > 1}
    known = {k for k, _, _ in others}
    orphans = Counter(k for k, _, _ in rows if k is not None and k not in known)
    assert dict(map(tuple, audit.audit_foreign_key(child, ["k"], parent, ["k"]).collect())) == orphans
    nulls = {r["column_name"]: r["violations"] for r in audit.audit_not_null(child, ["k", "v", "s"]).collect()}
    assert nulls == {name: sum(row[i] is None for row in rows) for i, name in enumerate("kvs")}
    keys, values = [k for k, _, _ in rows if k is not None], [v for _, v, _ in rows if v is not None]
    expected = (len(rows), len(set(keys)), min(values, default=None), max(values, default=None))
    assert tuple(stats.load_statistics(child, "k", "v").first()) == expected

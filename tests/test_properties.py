"""Property tests against plain-Python statements of the source system's rules."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from civicledger.operators import keyed, merge

AS_OF = dt.date(2024, 6, 10)
dates = st.sampled_from([dt.date(2024, 6, 1), dt.date(2024, 6, 2), dt.date(2024, 1, 1), None])
texts = st.sampled_from(["", "a", None])
rows = st.lists(st.tuples(texts, dates, st.sampled_from(["X", "Y"]), st.sampled_from([1, 2])),
                min_size=0, max_size=12)
SCHEMA = "status string, date_recorded date, symbol string, v int"


def reference_collapse(data):
    """The delete-then-insert of the source procedure, row by row."""
    recent = [r for r in data if r[1] is not None and r[1] >= AS_OF - dt.timedelta(days=70)]
    counts = {}
    for r in recent:
        counts[r] = counts.get(r, 0) + 1
    holder = [g for g, n in counts.items() if n > 1]

    def text(r):
        return tuple("" if v is None else str(v) for v in r)
    keys = {text(g) for g in holder}
    kept = [r for r in data if text(r) not in keys]
    return sorted(kept + holder, key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_collapse_matches_delete_then_insert(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted(map(tuple, keyed.collapse_duplicates(df, "date_recorded", AS_OF.isoformat()).collect()), key=repr)
    assert got == reference_collapse(data)


keys = st.sampled_from(["a", "b", "c", None])
kv = st.lists(st.tuples(keys, st.integers(0, 9)), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(kv, kv)
def test_upsert_matches_merge_statement(spark, target, source):
    # a merge source has unique non-NULL keys
    seen, src = set(), []
    for k, v in source:
        if k is None or k not in seen:
            src.append((k, v))
            seen.add(k)
    t = spark.createDataFrame(target, "k string, v int")
    s = spark.createDataFrame(src, "k string, v int")
    got = sorted(map(tuple, merge.upsert(t, s, "k").collect()), key=repr)
    src_keys = {k for k, _ in src if k is not None}
    expected = [r for r in target if r[0] is None or r[0] not in src_keys] + src
    assert got == sorted(expected, key=repr)

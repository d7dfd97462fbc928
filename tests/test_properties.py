"""Property tests (hypothesis) for the invariants the pipeline relies on."""

import datetime as dt
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millstar.operators import cleaning
from millstar.operators.dense_key import dense_key, dense_key_window
from millstar.sinks.csv import CsvSink, read_csv_export
from millstar.sources import snapshots

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])

keys = st.one_of(st.none(), st.text(alphabet="abcXYZ019 _-", max_size=6))


@SETTINGS
@given(st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(-3, 3))), max_size=60),
       st.integers(1, 6))
def test_dense_key_equals_row_number(spark, rows, parts):
    df = spark.createDataFrame(rows, "a string, b int").distinct()
    got = sorted((r["a"] is None, r["a"], r["b"] is None, r["b"], r["sk"])
                 for r in dense_key(df, ["a", "b"], "sk", partitions=parts).collect())
    want = sorted((r["a"] is None, r["a"], r["b"] is None, r["b"], r["sk"])
                  for r in dense_key_window(df, ["a", "b"], "sk").collect())
    assert got == want
    assert sorted(x[-1] for x in got) == list(range(1, len(got) + 1))


row = st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.sampled_from("xyz")))


@SETTINGS
@given(st.lists(row, max_size=40))
def test_base_clean_idempotent_and_exact(spark, rows):
    df = spark.createDataFrame(rows, "id long, v string")
    spec = cleaning.CleaningSpec("id")
    once = sorted(map(tuple, cleaning.clean(df, spec).collect()), key=repr)
    twice = sorted(map(tuple, cleaning.clean(cleaning.clean(df, spec), spec).collect()), key=repr)
    assert once == twice == sorted({r for r in rows if r[0] is not None}, key=repr)


@SETTINGS
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=5, unique=True))
def test_latest_is_newest_stamp(spark, offsets):
    root = tempfile.mkdtemp(prefix="millstar-prop-")
    base = dt.datetime(2026, 1, 1)
    for i, off in enumerate(offsets):
        snapshots.write_snapshot(spark.range(i + 1), f"{root}/t", base + dt.timedelta(minutes=off))
    newest = max(range(len(offsets)), key=lambda i: offsets[i])
    assert snapshots.read_latest(spark, f"{root}/t").count() == newest + 1
    assert snapshots.read_all_versions(spark, f"{root}/t").count() == sum(
        i + 1 for i in range(len(offsets)))


text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), min_size=1, max_size=8)


@SETTINGS
@given(st.lists(st.tuples(st.integers(-5, 5), st.one_of(st.none(), text),
                          st.one_of(st.none(), st.floats(allow_nan=False, width=32))),
                max_size=20),
       st.sampled_from([",", ";", "|", "\t"]))
def test_csv_round_trip(spark, rows, sep):
    df = spark.createDataFrame(rows, "id long, s string, x double")
    root = tempfile.mkdtemp(prefix="millstar-prop-")
    path = CsvSink(root, delimiter=sep).write(df, "t")
    back = sorted(map(tuple, read_csv_export(spark, path, df.schema, delimiter=sep).collect()),
                  key=repr)
    assert back == sorted(map(tuple, df.collect()), key=repr)


def test_fact_rows_equal_source_rows_with_unique_dim_keys(spark):
    from harness.adapter import bronze
    from harness.queries import fact
    from conftest import SF_SMALL
    for name, src in (("fact_sensor_readings", "sensor_readings"), ("fact_alerts", "alerts")):
        n_src = cleaning.clean_table(bronze(spark, SF_SMALL, src), src).count()
        assert fact(spark, SF_SMALL, name).count() == n_src


fact_key = st.one_of(st.none(), st.sampled_from([1, 2, 3]), st.integers(4, 40))


@SETTINGS
@given(st.lists(st.tuples(fact_key, st.one_of(st.none(), st.sampled_from("ab"))), max_size=120),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 30)), st.one_of(st.none(), st.sampled_from("ab")),
                          st.integers(0, 9)), max_size=40))
def test_lookup_matches_python_left_join(spark, fact_rows, dim_rows):
    """Both join strategies equal a plain left join: NULLs never match, duplicates fan out."""
    from millstar.operators.lookup import Lookup, resolve
    fact_df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(fact_rows)],
                                    "rid long, k long, t string")
    dim_df = spark.createDataFrame(dim_rows, "dk long, dt string, v long")
    lk = [Lookup("d", (("k", "dk"), ("t", "dt")), (("v", "v"),))]
    want = []
    for i, (k, t) in enumerate(fact_rows):
        hits = [v for dk, dt, v in dim_rows
                if k is not None and t is not None and dk == k and dt == t]
        want += [(i, k, t, v) for v in hits] or [(i, k, t, None)]
    want = sorted(want, key=repr)
    for bound in (None, 0):
        got = sorted(map(tuple, resolve(fact_df, {"d": dim_df}, lk, bound).collect()), key=repr)
        assert got == want, bound

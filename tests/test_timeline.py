"""As-of joins over long histories, and dimensions from changes in any order."""

import itertools
import random
from datetime import datetime, timedelta

import duckdb
import pytest
from check import differences
from pyspark.sql import functions as F

import __spark_entry__ as contract
from wattloom.functions.keys import composite_key
from wattloom.operators import late_changes, scd2
from wattloom.operators.timeline import as_of, neighbours
from wattloom.schemas import no_rows

T0 = datetime(2024, 1, 1)
HOUR = 3_600_000_000


def hours(n):
    return None if n is None else T0 + timedelta(hours=n)


@pytest.mark.parametrize("chunk", [HOUR, 24 * HOUR, 10_000 * HOUR])
@pytest.mark.parametrize("from_start", [False, True])
def test_as_of_equals_brute_force(spark, rows, chunk, from_start):
    rnd = random.Random(chunk % 97 + from_start)
    versions = []
    for k in range(6):
        cuts = sorted(rnd.sample(range(200), rnd.randint(1, 60)))
        for n, (a, b) in enumerate(zip(cuts, [*cuts[1:], None], strict=True)):
            end = b if rnd.random() < 0.8 else a + 1  # some leave a gap
            versions.append((k, hours(a), hours(end), f"v{k}-{n}"))
            if rnd.random() < 0.2:
                versions.append((k, hours(a), hours(a), f"empty{k}-{n}"))
    versions += [(None, hours(0), None, "nobody"), (9, None, None, "never")]
    facts = [(i, rnd.choice([*range(8), None]), hours(rnd.choice([*range(-5, 210), None]))) for i in range(500)]

    def brute(key, at):
        own = [v for v in versions if v[0] == key and v[1] is not None] if key is not None else []
        if at is None or not own:
            return None
        best = lambda some, pick: pick(some, key=lambda v: (v[1], v[2] is None, v[2] or T0, v[3]))
        before = [v for v in own if v[1] <= at]
        v = best(before, max) if before else best(own, min) if from_start else None
        return v[3] if v and (v[2] is None or at < v[2]) else None

    f = spark.createDataFrame(facts, "id INT, device INT, at TIMESTAMP")
    v = spark.createDataFrame(versions, "device INT, begin TIMESTAMP, until TIMESTAMP, name STRING")
    got = as_of(f, v, {"device": "device"}, "at", "begin", "until", ["name"], from_start, chunk)
    assert rows(got) == sorted(((*r, brute(r[1], r[2])) for r in facts), key=repr)


def test_as_of_costs_no_more_than_its_rows(spark):
    """No join compares times: with 10,000 versions of one key every join is on key and chunk alone."""
    v = spark.range(10_000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("a"), F.timestamp_seconds(F.col("id") * 60 + 60).alias("b"), F.col("id").alias("version"))
    f = spark.range(20_000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 30).alias("at"))
    got = as_of(f, v, {"k": "k"}, "at", "a", "b", ["version"])
    assert got.filter(F.col("version") == F.floor(F.unix_seconds("at") / 60)).count() == 20_000
    for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines():
        if "Join" in line:
            assert "<" not in line and ">" not in line and "Cross" not in line


def test_as_of_without_rows(spark):
    f = spark.createDataFrame([(1, T0)], "k INT, at TIMESTAMP")
    v = spark.createDataFrame([], "k INT, a TIMESTAMP, b TIMESTAMP, name STRING")
    assert [tuple(r) for r in as_of(f, v, {"k": "k"}, "at", "a", "b", ["name"]).collect()] == [(1, T0, None)]
    assert as_of(f.limit(0), v, {"k": "k"}, "at", "a", "b", ["name"]).count() == 0


def test_neighbours_cross_chunks(spark):
    rows = [(1, hours(h), h) for h in (0, 1, 30, 31, 200)] + [(2, hours(5), 5)]
    df = spark.createDataFrame(rows, "k INT, at TIMESTAMP, v INT")
    got = {(r.k, r.v): (r._before, r._next) for r in neighbours(df, ["k"], "at", "v").collect()}
    assert got == {(1, 0): (None, hours(1)), (1, 1): (0, hours(30)), (1, 30): (1, hours(31)), (1, 31): (30, hours(200)), (1, 200): (31, None), (2, 5): (None, None)}


DIM = "device_key BIGINT, device_id INT, rating INT, name STRING, start_date TIMESTAMP, end_date TIMESTAMP, current_flag BOOLEAN"
KEY = scd2.CompositeKey("device_key", "device_id", "second")


def kept(df, folder):
    df.write.parquet(str(folder))
    return df.sparkSession.read.schema(df.schema).parquet(str(folder))


def load_all(spark, loads, folder):
    schema = "device_id INT, rating INT, name STRING, effective TIMESTAMP"
    dim = no_rows(spark, spark.createDataFrame([], DIM).schema)
    record = no_rows(spark, spark.createDataFrame([], schema).schema)
    for n, load in enumerate(loads):
        changes = spark.createDataFrame(load, schema)
        dim = kept(late_changes.scd2_late(dim, record, changes, ["device_id"], ["rating"], KEY), folder / f"dim{n}")
        record = kept(record.unionByName(changes), folder / f"record{n}")
    return dim


def test_any_order_gives_the_same_dimension(spark, rows, tmp_path):
    rnd = random.Random(4)
    changes = [(rnd.randint(1, 4), rnd.choice([1, 2, 3, None]), f"n{rnd.randint(1, 2)}", hours(rnd.randint(0, 30))) for _ in range(60)]
    changes += [(None, 1, "x", T0), (2, 1, "x", None)]
    parts = [changes[n::3] for n in range(3)]
    expected = []
    for d in range(1, 5):
        at = {}
        for c in (c for c in changes if c[0] == d and c[3] is not None):
            key = lambda c: (c[1] is not None, c[1] or 0, c[2])
            at[c[3]] = max(at.get(c[3], c), c, key=key)
        opened = [at[t] for n, t in enumerate(sorted(at)) if n == 0 or at[t][1] != at[sorted(at)[n - 1]][1]]
        for a, b in itertools.zip_longest(opened, opened[1:]):
            expected.append((d * 10**14 + int(a[3].strftime("%Y%m%d%H%M%S")), d, a[1], a[2], a[3], b and b[3], b is None))
    for n, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 2, 0)]):
        (tmp_path / str(n)).mkdir()
        assert rows(load_all(spark, [parts[i] for i in order], tmp_path / str(n))) == sorted(expected, key=repr)


def test_untouched_keys_and_surrogate_keys_stay(spark, tmp_path):
    first = [(1, 5, "a", hours(0)), (1, 7, "a", hours(20)), (2, 5, "b", hours(3))]
    before = load_all(spark, [first], tmp_path)
    record = spark.createDataFrame(first, "device_id INT, rating INT, name STRING, effective TIMESTAMP")
    dense = before.withColumn("device_key", F.col("device_key") % 1000 + 1)
    late = spark.createDataFrame([(1, 6, "a", hours(10))], record.schema)
    after = late_changes.scd2_late(dense, record, late, ["device_id"], ["rating"], scd2.DenseKey("device_key", ("device_id", "start_date")))
    old = {(r.device_id, r.start_date): r.device_key for r in dense.collect()}
    new = {(r.device_id, r.start_date): r.device_key for r in after.collect()}
    assert {k: new[k] for k in old} == old and new[1, hours(10)] == max(old.values()) + 1 and len(new) == 4
    spans = late_changes.moved_spans(dense, kept(after, tmp_path / "after"), ["device_id"], "device_key").collect()
    assert [(s.device_id, s["from"], s["to"], s.old_key, s.new_key) for s in spans] == [(1, hours(10), hours(20), old[1, hours(0)], new[1, hours(10)])]


def test_a_record_begins_with_the_dimension(spark, rows, tmp_path):
    dim = load_all(spark, [[(1, 5, "a", hours(0)), (1, 7, "a", hours(20)), (2, 5, "b", hours(3))]], tmp_path)
    again = late_changes.versions_of(late_changes.changes_of(dim, "device_key"), ["device_id"], ["rating"])
    assert rows(again, *dim.columns[1:]) == rows(dim, *dim.columns[1:])


def test_late_spans_of_ids_that_leave_a_bigint_no_room_for_seconds(spark, tmp_path):
    con = duckdb.connect()
    con.sql(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01 00:00:30' + INTERVAL (i * 53 % 7200) MINUTE AS ts, CASE WHEN i % 5 = 0 THEN 2147483647 ELSE 92232 + i % 5 END AS user_id,
      'view' AS event_type, i / 4 AS value, '{{"k": ' || i * 37 % 100 || '}}' AS props FROM range(400) AS r(i)) TO '{tmp_path}/events.parquet'""")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    want = con.sql(contract.oracle_sql()["scd2_late_spans"]).df()
    assert len(want) == 5 and differences(contract.queries()["scd2_late_spans"](spark, str(tmp_path)).toPandas(), want) == []


def test_wide_keys_are_the_narrow_ones_without_their_limit(spark):
    ids = spark.createDataFrame([(0,), (92_232,), (92_234,), (2**63 - 1,), (None,)], "id BIGINT").withColumn("at", F.lit(T0))
    made = ids.select(composite_key(F.col("id"), F.col("at"), "second", wide=True).alias("k")).collect()
    assert [r.k for r in made] == [None if i is None else i * 10**14 + 20240101000000 for i in (0, 92_232, 92_234, 2**63 - 1, None)]
    with pytest.raises(Exception, match="OVERFLOW"):  # a BIGINT key never wraps around
        ids.select(composite_key(F.col("id"), F.col("at"), "second")).collect()


@pytest.mark.parametrize("seed", range(3))
def test_moved_spans_equal_brute_force(spark, rows, seed):
    rnd = random.Random(seed)

    def side():
        versions = [(None, hours(0), None, 1), (9, None, hours(5), 2)]
        for k in range(8):
            cuts = sorted(rnd.sample(range(0, 120, 3), rnd.randint(1, 12)))
            for a, b in zip(cuts, [*cuts[1:], None], strict=True):
                versions.append((k, hours(a), hours(b if rnd.random() < 0.8 else a + 1), rnd.choice([None, *range(4)])))
                versions += [(k, hours(a), hours(a), 7)] * (rnd.random() < 0.2)
        return versions

    before, after = side(), side()
    same = [v for v in before if v[0] in (0, 1)]  # keys that stay as they are
    after = [v for v in after if v[0] not in (0, 1)] + same

    def valid(versions, at):
        own = max((v for v in versions if v[1] is not None and v[1] <= at), key=lambda v: (v[1], v[2] is None, v[2] or T0, v[3] is not None, v[3] or 0), default=None)
        return own[3] if own and (own[2] is None or at < own[2]) else None

    want = []
    for k in range(2, 10):
        old, new = ([v for v in versions if v[0] == k] for versions in (before, after))
        cuts = sorted({t for v in [*old, *new] for t in v[1:3] if t is not None})
        for a, b in itertools.zip_longest(cuts, cuts[1:]):
            if valid(old, a) != valid(new, a):
                want.append((k, a, b, valid(old, a), valid(new, a)))
    schema = "device_id INT, start_date TIMESTAMP, end_date TIMESTAMP, device_key INT"
    spans = late_changes.moved_spans(*(spark.createDataFrame(d, schema) for d in (before, after)), ["device_id"], "device_key")
    assert len(want) > 5 and rows(spans, "device_id", "from", "to", "old_key", "new_key") == sorted(want, key=repr)

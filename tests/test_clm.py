import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattloom.sources import clm
from wattloom.sources.climate import read_clm

HEADER = "*CLIMATE\n" + "# text\n" * 9 + " 2013,29.87,1.33,0   # year\n 1,365    # period\n"


def block(day, rows=24):
    head = f"* day {day.day:2d} month {day.month:2d}\n"
    return head + "".join(f" {h},{day.day * 10 - 200},{h * day.month},18,344,70\n" for h in range(1, rows + 1))


def year_text(days=365):
    first = dt.date(2013, 1, 1)
    return HEADER + "".join(block(first + dt.timedelta(n)) for n in range(days))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("clm")
    for name in ("a", "b", "c d"):
        (root / f"{name}.clm").write_text(year_text())
    (root / "_part").write_text("not a station")
    return root


def rows_of(batches):
    return [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]


@pytest.mark.parametrize("range_bytes", [997, 50_000, 1 << 20])
def test_any_ranges_give_the_whole_text_reader_s_rows(spark, folder, range_bytes):
    if range_bytes < 5000:  # many ranges: without Spark
        path = str(folder / "a.clm")
        reader = clm.ClmReader({"path": path, "rangebytes": range_bytes})
        got = sorted((r[1:5] for p in reader.partitions() for r in rows_of(reader.read(p))), key=repr)
        want = read_clm(spark, path)
    else:
        got_rows = clm.read_clm_ranges(spark, str(folder), range_bytes=range_bytes)
        assert got_rows.filter("torn IS NOT NULL").count() == 0 and got_rows.select("station").distinct().count() == 3
        got = sorted((tuple(r) for r in got_rows.drop("station", "torn").collect()), key=repr)
        want = read_clm(spark, [str(folder / f"{n}.clm") for n in ("a", "b", "c d")])
    assert got == sorted((tuple(r) for r in want.drop("station").collect()), key=repr)


def test_a_date_filter_reads_fewer_ranges(spark, folder):
    days = clm.read_clm_ranges(spark, str(folder / "a.clm"), range_bytes=4000).filter(F.col("date") == dt.date(2013, 7, 4))
    assert sorted(r.hour for r in days.collect()) == list(range(1, 25))

    reader = clm.ClmReader({"path": str(folder / "a.clm"), "rangebytes": "4000"})
    equal = clm.EqualTo(("date",), dt.date(2013, 7, 4))
    assert list(reader.pushFilters([equal])) == [equal]
    parts = reader.partitions()
    read = [p for p in parts if rows_of(reader.read(p))]
    assert len(parts) > 40 and 1 <= len(read) <= 2


def test_bounds_of_filters():
    reader, d = clm.ClmReader({"path": "x"}), lambda n: dt.date(2013, 1, n)
    at = ("date",)
    given = [clm.GreaterThan(at, d(2)), clm.LessThanOrEqual(at, d(20)), clm.In(at, (d(9), d(4), None)), clm.GreaterThan(("hour",), 5), clm.LessThan(at, d(8))]
    assert list(reader.pushFilters(given)) == given
    assert (reader.low, reader.high) == (d(4), d(8))


def test_torn_lines_are_rows_of_their_own(spark, tmp_path):
    text = HEADER + block(dt.date(2013, 1, 1), 22) + " 0,110,0,18\n x,y,z,1,2,3\n 9,9,9,9,9,9\n* day one\n" + block(dt.date(2013, 1, 2)) + " 1,2"
    (tmp_path / "t.clm").write_text(text)
    rows = clm.read_clm_ranges(spark, str(tmp_path / "t.clm"))
    torn = {(r.date and r.date.day, r.hour, r.torn.strip()) for r in rows.filter("torn IS NOT NULL").collect()}
    assert torn == {(1, 23, "0,110,0,18"), (1, 24, "x,y,z,1,2,3"), (1, None, "9,9,9,9,9,9"), (1, None, "* day one"), (2, None, "1,2")}
    assert rows.filter("torn IS NULL").count() == 46


def test_odd_files(spark, tmp_path):
    (tmp_path / "empty.clm").write_text("")
    (tmp_path / "short.clm").write_text("one line")
    (tmp_path / "header.clm").write_text(HEADER)
    (tmp_path / "crlf.clm").write_bytes(year_text(2).replace("\n", "\r\n").encode())
    rows = clm.read_clm_ranges(spark, str(tmp_path), range_bytes=100)
    assert rows.count() == 48 and rows.select("date").distinct().count() == 2
    assert clm.read_clm_ranges(spark, str(tmp_path), year=1999).agg(F.min("date")).first()[0] == dt.date(1999, 1, 1)
    with pytest.raises(Exception, match="missing"):
        clm.read_clm_ranges(spark, str(tmp_path / "missing")).collect()


def test_days_that_do_not_ascend_are_an_error(tmp_path):
    (tmp_path / "t.clm").write_text(HEADER + block(dt.date(2013, 1, 2)) + block(dt.date(2013, 1, 1)))
    reader = clm.ClmReader({"path": str(tmp_path / "t.clm")})
    with pytest.raises(ValueError, match="later one"):
        rows_of(reader.read(reader.partitions()[0]))

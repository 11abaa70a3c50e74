"""Result pages, single metric points, markers and snapshots."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from opsflow.functions import wall_clock
from opsflow.operators import clusters as cl
from opsflow.operators import runs, status
from opsflow.plans import jobs
from opsflow.session import scratch_path
from opsflow.sources import files, sinks
from conftest import rows

T = dt.datetime


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def land(spark, pages):
    """Pages {request: document} as files that span lines."""
    root = scratch_path(spark, "t_pages")
    for request, doc in pages.items():
        os.makedirs(f"{local(root)}/request={request}")
        with open(f"{local(root)}/request={request}/page.json", "w") as f:
            f.write(doc if isinstance(doc, str) else json.dumps(doc, indent=2))
    return root


def cluster(i, state="WAITING"):
    return {"Id": f"j-{i}", "NormalizedInstanceHours": i, "Status": {"State": state, "Timeline": {"CreationDateTime": "2024-01-29T00:00:00"}}}


def read(spark, path):
    return cl.flatten_clusters(files.read_pages(spark, path, cl.CLUSTER_PAGE, "Clusters", "Marker"))


def test_pages_are_read_whole(spark):
    path = land(spark, {"first": {"Clusters": [cluster(1), cluster(2)], "Marker": "m1"}, "m1": {"Marker": "m2"},
                        "m2": {"Clusters": [cluster(3), {}], "Marker": ""}})
    assert rows(read(spark, path), "ClusterId", "State") == [("", ""), ("j-1", "WAITING"), ("j-2", "WAITING"), ("j-3", "WAITING")]


@pytest.mark.parametrize("lost", ["first", "m1", "m2"])
def test_a_lost_page_fails(spark, lost):
    pages = {"first": {"Clusters": [cluster(1)], "Marker": "m1"}, "m1": {"Clusters": [], "Marker": "m2"}, "m2": {"Clusters": [cluster(3)]}}
    del pages[lost]
    with pytest.raises(ValueError, match="broken page chain"):
        read(spark, land(spark, pages))


def test_a_stray_or_broken_page_fails(spark):
    with pytest.raises(ValueError, match="no page leads to"):
        read(spark, land(spark, {"first": {"Clusters": []}, "old": {"Clusters": [cluster(9)]}}))
    with pytest.raises(Exception, match="MALFORMED|parse"):
        read(spark, land(spark, {"first": '{"Clusters": [{"Id": "j-1"}, '})).collect()


def test_report_over_pages(spark):
    clusters = land(spark, {"first": {"Clusters": [cluster(1)], "Marker": "m"}, "m": {"Clusters": [cluster(2)]}})
    event = {"Username": "u", "CloudTrailEvent": '{"responseElements": {"jobFlowId": "j-2"}}', "EventName": "RunJobFlow",
             "EventTime": "2024-01-29T00:00:00"}
    events = land(spark, {"first": {"Events": [], "NextToken": "n"}, "n": {"Events": [event]}})
    points = scratch_path(spark, "t_points")
    spark.createDataFrame([("j-1", T(2024, 1, 29, 20), 1.0)], "ClusterId string, Timestamp timestamp_ntz, IsIdle double").write.json(points)
    out = jobs.cluster_report_run(spark, clusters, events, points, T(2024, 1, 30), scratch_path(spark, "t_out"), "1", paged=True)
    assert [(r["ClusterId"], r["Username"], r["idle_pct_12h"]) for r in out.orderBy("position").collect()] == [("j-2", "u", None), ("j-1", None, 1.0)]


def test_only_a_single_point_counts(spark):
    """Periods of four days start at the epoch: 2024-01-26 and 2024-01-30 are starts (19748 and 19752 days)."""
    pts = spark.createDataFrame([("a", T(2024, 1, 30, 1), 1.0), ("a", T(2024, 1, 29, 23), 3.0), ("b", T(2024, 1, 30, 1), 1.0),
                                 ("b", T(2024, 1, 30, 2), 2.0), ("c", T(2024, 1, 29, 23), 5.0), ("c", T(2024, 1, 30, 3), None)],
                                "ClusterId string, Timestamp timestamp_ntz, IsIdle double")
    got = {r["ClusterId"]: (r["idle_pct_12h"], r["idle_pct_3h"]) for r in cl.idle_windows(pts, wall_clock(T(2024, 1, 30, 4))).collect()}
    assert got["a"] == (None, 1.0)          # 12 h: two periods answer, 3 h: one
    assert got["b"] == (1.5, 1.5)
    assert got["c"] == (5.0, None)          # a point without a value is no point
    # the period of the lifetime is its whole days and four: 11 days, starts at day 19745 (2024-01-23)
    clusters = spark.createDataFrame([("d", T(2024, 1, 20), T(2024, 1, 27, 12)), ("e", T(2024, 1, 24), T(2024, 1, 31, 12)), ("f", None, None)],
                                     "ClusterId string, ReadyDateTime timestamp_ntz, EndDateTime timestamp_ntz")
    pts = spark.createDataFrame([(c, T(2024, 1, day), float(day)) for c in "def" for day in (22, 25, 26)],
                                "ClusterId string, Timestamp timestamp_ntz, IsIdle double")
    got = {r["ClusterId"]: r["idle_pct"] for r in cl.idle_windows(pts, wall_clock(T(2024, 2, 1)), clusters=clusters).collect()}
    assert got == {"d": None, "e": 25.5, "f": None}


def test_markers_of_a_date(spark):
    root = scratch_path(spark, "t_markers")
    names = spark.createDataFrame([("success-a-b-t1-20240130",), ("success-a-b-t10",), ("with blank+x",), (None,), ("success-a-b-t1-20240130",)], "marker string")
    assert files.touch_markers(spark, f"{root}/day=30", names) == 3
    with open(f"{local(root)}/day=30/not-empty", "w") as f:
        f.write("x")
    assert rows(files.list_markers(spark, f"{root}/day=30")) == [("not-empty",), ("success-a-b-t1-20240130",), ("success-a-b-t10",), ("with blank+x",)]
    assert rows(files.list_markers(spark, f"{root}/day=30", "success-*")) == [("success-a-b-t1-20240130",), ("success-a-b-t10",)]
    wanted = spark.createDataFrame([("a~b~t1~t",), ("a~b~t2~t",), ("a~b~t2~M",)], "k string")
    wanted = wanted.select("k", *runs.parse_process_key("k"))
    assert rows(runs.readiness(wanted, files.list_markers(spark, f"{root}/day=30")), "k", "ready") == \
        [("a~b~t1~t", True), ("a~b~t2~M", True), ("a~b~t2~t", False)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.list_markers(spark, f"{root}/day=31")


def test_markers_are_created_by_tasks(spark, monkeypatch):
    root = scratch_path(spark, "t_markers")
    names = spark.range(3000).selectExpr("concat('success-a-b-t', id % 2000) as marker").unionAll(spark.sql("select '' as marker"))

    def refuse(*a, **k):
        raise AssertionError("names came to the driver")

    with monkeypatch.context() as m:
        for f in ("toLocalIterator", "toPandas", "toArrow"):
            m.setattr(type(names), f, refuse)
        assert files.touch_markers(spark, f"{root}/day=30", names) == 2000
        assert files.touch_markers(spark, f"{root}/day=31", names.limit(0)) == 0
    assert rows(files.list_markers(spark, f"{root}/day=30")) == sorted((f"success-a-b-t{i}",) for i in range(2000))
    assert all(os.path.getsize(f"{local(root)}/day=30/success-a-b-t{i}") == 0 for i in range(2000))


def test_snapshot_as_of(spark):
    root = scratch_path(spark, "t_snapshots")
    for ts in ("20240103_2330", "20240101_2330", "20240102_2330"):
        sinks.snapshot(spark.createDataFrame([(ts,)], "v string"), root, ts)
    assert files.snapshot_times(spark, root) == ["20240101_2330", "20240102_2330", "20240103_2330"]
    for as_of, want in (("20240102_2330", "20240102_2330"), ("20240103_0000", "20240102_2330"), ("2025", "20240103_2330")):
        got = files.read_snapshot_as_of(spark, root, as_of)
        assert rows(got) == [(want, want)]
        assert f"snapshot_ts={want}" in got.inputFiles()[0] and len(got.inputFiles()) == 1
    with pytest.raises(ValueError, match="no snapshot"):
        files.read_snapshot_as_of(spark, root, "20240101_0000")


def test_first_line_by_whole_words(spark):
    master = spark.createDataFrame([("UC 1",), ("uc",), ("A-B",), ("a.b",), ("--",), (None,), ("été",), ("UC 1",), ("ghost",), ("x\\Ey",)], "usecase string")
    lines = spark.createDataFrame([(1, "x_UC 1,no"), (2, "a b,UC  1"), (3, "see uc 1, then"), (4, "A-B"), (5, "aXb a-b"), (6, "UC_1"), (7, "ÉTÉ!"),
                                   (8, "a.b"), (9, None), (10, "uc 1"), (11, "X\\eY")], "n int, line string")
    got = sorted(((r.usecase, r.line) for r in status.first_lines_by_words(master, lines, "n").collect()), key=str)
    assert got == sorted([("UC 1", "see uc 1, then"), ("UC 1", "see uc 1, then"), ("uc", "a b,UC  1"), ("A-B", "A-B"), ("a.b", "a.b"), ("--", None),
                          (None, None), ("été", "ÉTÉ!"), ("ghost", None), ("x\\Ey", "X\\eY")], key=str)


def test_a_key_in_a_third_of_all_lines(spark):
    from test_skew import large_input_plan
    lines = spark.range(0, 30000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot job "), F.col("id").cast("string")))
                                         .otherwise(F.concat(F.lit("job "), F.col("id").cast("string"))).alias("line"))
    master = spark.createDataFrame([("hot job",), ("job 7",), ("job 70",)], "usecase string")
    with large_input_plan(spark):
        got = rows(status.first_lines_by_words(master, lines, "id"), "usecase", "line")
    assert got == [("hot job", "hot job 0"), ("job 7", "job 7"), ("job 70", "job 70")]


def test_whole_line_order(spark):
    df = spark.createDataFrame([("b", "DLY", 5, "2"), ("b", "DLY", 5, "1"), ("a", "MLY_01", 0, "1"), ("Z", "DLY", 5, "3"), ("b", None, 5, "1"), ("c", "DLY", None, "9")],
                               "usecase string, FREQ string, mtd int, x string")
    cols = ["usecase", "FREQ", "mtd", "x"]

    def lines(**opts):
        return [tuple(r[c] for c in cols) for r in status.dashboard_order(df, line_cols=cols, **opts).orderBy("position").collect()]

    bytewise = lines()
    assert bytewise == [("c", "DLY", None, "9"), ("Z", "DLY", 5, "3"), ("b", None, 5, "1"), ("b", "DLY", 5, "1"), ("b", "DLY", 5, "2"), ("a", "MLY_01", 0, "1")]
    by_locale = lines(collation="UNICODE")
    assert [r[0] for r in by_locale] == ["c", "b", "b", "b", "Z", "a"]


def test_every_code_of_a_cell_counts(spark):
    df = spark.createDataFrame([("u", dt.date(2024, 1, 1), "OK, dlt"), ("u", dt.date(2024, 1, 2), "ok ok"), ("u", dt.date(2024, 1, 3), "TOKEN"),
                                ("u", dt.date(2024, 1, 4), None)], "usecase string, report_date date, category string")
    assert rows(status.code_tally(df, [])) == [("DLT", 1), ("OK", 3), ("UNCLASSIFIED", 2)]
    assert rows(status.mtd_success(df, ["usecase"], dt.date(2024, 1, 30))) == [("u", 75, 75)]

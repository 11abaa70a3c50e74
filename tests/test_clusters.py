from opsflow.functions import wall_clock
import datetime as dt

from pyspark.sql import functions as F

from opsflow.operators import clusters as cl
from opsflow.session import scratch_path
from opsflow.sources import files
from conftest import rows

T = dt.datetime


def now():
    return wall_clock(T(2024, 1, 30))


def _clusters(spark):
    path = scratch_path(spark, "t_clusters")
    docs = ['{"Id": "j-1", "NormalizedInstanceHours": 8, "Status": {"State": "WAITING", "Timeline": '
            '{"CreationDateTime": "2024-01-29T00:00:00", "ReadyDateTime": "2024-01-29T01:00:00"}}}',
            '{"Id": "j-2", "NormalizedInstanceHours": 4, "Status": {"State": "TERMINATED", "Timeline": '
            '{"CreationDateTime": "2024-01-01T00:00:00", "ReadyDateTime": "2024-01-01T00:00:00", '
            '"EndDateTime": "2024-01-01T02:00:00"}}}',
            '{"NormalizedInstanceHours": 1, "Status": {"Timeline": {"CreationDateTime": "2024-01-29T00:00:00"}}}']
    spark.createDataFrame([(d,) for d in docs], "value string").write.text(path)
    return cl.flatten_clusters(files.read_cluster_docs(spark, path, cl.CLUSTER_SCHEMA))


def test_flatten_and_runtime(spark):
    flat = cl.with_runtime(_clusters(spark), now())
    got = rows(flat, "ClusterId", "State", "runtime")
    assert got == [("", "", None), ("j-1", "WAITING", 23 * 3600), ("j-2", "TERMINATED", 7200)]
    recent = cl.filter_clusters(flat, ["WAITING", "RUNNING"], now() - F.make_dt_interval(days=F.lit(30)))
    assert rows(recent, "ClusterId") == [("j-1",)]


def test_creator_extract(spark):
    ev = spark.createDataFrame([("u1", '{"responseElements": {"jobFlowId": "j-1"}}'), ("u2", '{"responseElements": {}}'),
                                ("u3", "{}"), ("u4", '{"responseElements": {"x": 1}}'), (None, None), ("u5", "{bad")],
                               "Username string, CloudTrailEvent string")
    assert rows(cl.creator_extract(ev)) == [("", "No responseElements"), ("u1", "j-1"), ("u2", "No responseElements"),
                                            ("u3", "No responseElements"), ("u4", ""), ("u5", "No responseElements")]


def test_idle_windows_and_report(spark):
    flat = cl.with_runtime(_clusters(spark), now())
    pts = spark.createDataFrame([("j-1", T(2024, 1, 29, 23), 1.0), ("j-1", T(2024, 1, 29, 2), 0.0),
                                 ("j-1", T(2024, 1, 28), 1.0), ("j-2", T(2024, 1, 1, 1), 0.5)],
                                "ClusterId string, Timestamp timestamp_ntz, IsIdle double")
    idle = cl.idle_windows(pts, now(), clusters=flat)
    got = {r["ClusterId"]: (r["idle_pct"], r["idle_pct_12h"], r["idle_pct_3h"]) for r in idle.collect()}
    assert got["j-1"] == (0.5, 1.0, 1.0)      # the point before ready is outside the lifetime
    assert got["j-2"] == (0.5, None, None)
    creators = spark.createDataFrame([("alice", "j-1"), ("bob", "j-1")], "Username string, ClusterId string")
    rep = cl.cluster_report(flat, creators, idle, rate=0.5)
    assert rep.columns[:-1] == cl.C.REPORT_COLUMNS
    order = [(r["ClusterId"], r["Username"]) for r in rep.orderBy("position").collect()]
    assert order == [("j-1", "alice"), ("j-1", "bob"), ("j-2", None), ("", None)]
    assert rep.filter("ClusterId = 'j-1'").first()["ApproxCost"] == 4.0
    none = cl.cluster_report(flat, creators)
    assert none.filter("ClusterId = 'j-2'").first()["idle_pct"] is None


def test_runtime_order(spark):
    flat = cl.with_runtime(_clusters(spark), now())
    got = [r["ClusterId"] for r in cl.runtime_order(flat).orderBy("position").collect()]
    assert got == ["j-1", "j-2", ""]          # longest first, never-ready last

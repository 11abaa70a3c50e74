import datetime as dt

from pyspark.sql import functions as F

from opsflow.operators import status
from opsflow.session import scratch_path
from conftest import rows

D = dt.date


def test_daily_status_cases(spark):
    master = spark.createDataFrame([("UC1", "10", "DLY"), ("uc2", "11", "DLY"), ("UC3", "12", "MLY_01")],
                                   "usecase string, SLA string, FREQ string")
    raw = spark.createDataFrame([(2, "uc1", "DLT"), (1, "UC1", "OK"), (3, "UC2", "xyz")],
                                "pos int, usecase string, category string")
    out = rows(status.daily_status(master, raw, "usecase", "category", "pos"), "usecase", "category")
    assert out == [("UC1", "OK"), ("UC3", None), ("uc2", "xyz")]


def _long(spark):
    return spark.createDataFrame([
        ("A", D(2024, 1, 30), "OK"), ("A", D(2024, 1, 29), "ok"), ("A", D(2024, 1, 28), "DLT"), ("A", D(2024, 1, 27), "SRC"),
        ("A", D(2023, 12, 31), "OK"), ("B", D(2024, 1, 30), "nope"), ("C", D(2024, 1, 30), "DLT"),
    ], "usecase string, report_date date, category string")


def test_mtd_success_and_scope(spark):
    out = {r["usecase"]: (r["mtd"], r["mtd_dl"]) for r in status.mtd_success(_long(spark), ["usecase"], D(2024, 1, 30)).collect()}
    assert out["A"] == (50, 75)          # 2 OK of 4 classified; 1 DLT
    assert out["B"] == (None, None)      # no classified day
    assert out["C"] == (0, 0)
    allh = {r["usecase"]: r["mtd"] for r in status.mtd_success(_long(spark), ["usecase"], D(2024, 1, 30), "all").collect()}
    assert allh["A"] == 60


def test_code_tally(spark):
    out = dict((r["code"], r["n"]) for r in status.code_tally(_long(spark), []).collect())
    assert out == {"OK": 3, "DLT": 2, "SRC": 1, "UNCLASSIFIED": 1}


def test_matrix_unpivot_round_trip(spark):
    days = [D(2024, 1, 30), D(2024, 1, 29), D(2024, 1, 28)]
    master = spark.createDataFrame([("A",), ("Z",)], "usecase string")
    wide = status.status_matrix(_long(spark), days, master=master)
    assert wide.columns == ["usecase", "d20240130", "d20240129", "d20240128"]
    got = {r["usecase"]: tuple(r)[1:] for r in wide.collect()}
    assert got["A"] == ("OK", "ok", "DLT") and got["Z"] == (None, None, None)
    back = status.history_unpivot(wide, ["usecase"], [status.day_column(d) for d in days])
    assert rows(back, "usecase", "report_date", "category") == [
        ("A", D(2024, 1, 28), "DLT"), ("A", D(2024, 1, 29), "ok"), ("A", D(2024, 1, 30), "OK")]


def test_dashboard_order(spark):
    df = spark.createDataFrame([("m1", "MLY_01", 10), ("d1", "DLY", None), ("d2", "DLY", 5), ("d0", "DLY", 0)],
                               "usecase string, FREQ string, mtd int")
    out = [r["usecase"] for r in status.dashboard_order(df).orderBy("position").collect()]
    assert out == ["d0", "d1", "d2", "m1"]      # blank counts as 0, then name; monthly last


def test_failure_list_colour_rows(spark):
    raw = spark.createDataFrame([("a,SUCCESS",), ("b,Success",), ("c,FAILED",)], "line string")
    assert rows(status.failure_list(raw)) == [("b,Success",), ("c,FAILED",)]
    codes = spark.createDataFrame([("OK",), ("DLT",), ("TGT",), ("ok",), ("ZZZ",), (None,)], "category string")
    got = dict((r[0], r[1]) for r in status.with_colour(codes).collect())
    assert got == {"OK": "#9FE2BF", "DLT": "#FFBF00", "TGT": "#FFFF00", "ok": None, "ZZZ": None, None: None}
    html = status.report_rows(spark.createDataFrame([("a", None, "OK")], "x string, y string, z string"), ["x", "y", "z"])
    assert html.first()["html"] == '<tr><td class="y_n">a</td><td class="y_n"></td><td class="y_n">OK</td></tr>'


def test_rollover_twice_equals_once(spark):
    folder = scratch_path(spark, "t_hist")
    day = _long(spark).filter(F.col("report_date") == D(2024, 1, 30))
    status.rollover(day, folder)
    status.rollover(day, folder)
    other = _long(spark).filter(F.col("report_date") == D(2024, 1, 29))
    status.rollover(other, folder)
    back = spark.read.parquet(folder)
    assert back.count() == 4

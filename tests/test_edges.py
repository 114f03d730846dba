"""Hand-made edge frames (ties, constants, zero denominators, NaN vs NULL, names, file formats)."""
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewise.functions import stats as S
from tablewise.operators import clean as C
from tablewise.operators import evaluate as EV
from tablewise.operators import features as FE
from tablewise.operators import model as M
from tablewise.operators import profile as P
from tablewise.operators import timeseries as TS
from tablewise.sources import readers as R


def test_constant_column_histogram_spans_half(spark):
    df = spark.createDataFrame([(3.0,)] * 7, "x double")
    h = {r["bin"]: r for r in P.histogram(df).collect()}
    assert len(h) == 5  # max(5, 1 distinct)
    assert h[0]["lo"] == 2.5 and h[4]["hi"] == 3.5
    assert sum(r["cnt"] for r in h.values()) == 7


def test_histogram_matches_numpy(spark):
    vals = [0.0, 1.0, 1.5, 2.0, 9.99, 10.0, 3.3, 7.7, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["cnt"] for r in sorted(P.histogram(df).collect(), key=lambda r: r["bin"])]
    exp, _ = np.histogram(vals, bins=min(20, max(5, len(set(vals)))))
    assert got == list(exp)


def test_mode_tie_takes_lowest_and_missing_when_empty(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert S.modes(df, ["c"]) == {"c": "a"}
    out, imputed = C.impute(df)
    assert imputed == {"c": "mode"}
    assert sorted(r["c"] for r in out.collect()) == ["a", "a", "a", "b", "b"]
    empty = spark.createDataFrame([(None, 1), (None, 2)], "c string, k int")
    out, _ = C.impute(empty, key="k")
    assert {r["c"] for r in out.collect()} == {"missing"}


def test_median_impute_even_count_and_datetime_midpoint(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,), (None,)], "x double")
    out, imputed = C.impute(df)
    assert imputed == {"x": "median"}
    assert sorted(r["x"] for r in out.collect())[2] == 6.0
    import datetime as dt
    d = spark.createDataFrame([(dt.datetime(2020, 1, 1),), (dt.datetime(2020, 1, 2),), (None,)], "t timestamp_ntz")
    out, imputed = C.impute(d)
    assert imputed == {"t": "median(datetime)"}
    assert dt.datetime(2020, 1, 1, 12) in [r["t"] for r in out.collect()]


def test_nan_and_null_both_missing_after_tokens(spark):
    df = spark.createDataFrame([(float("nan"), " NULL "), (1.0, " x "), (None, "-")], "a double, b string")
    rows = C.strip_null_tokens(df).collect()
    assert [r["a"] for r in rows] == [None, 1.0, None]
    assert [r["b"] for r in rows] == [None, "x", None]


def test_coercion_95_percent_rule(spark):
    good = [(str(i),) for i in range(97)] + [("bad",)] * 3
    bad = [(str(i),) for i in range(90)] + [("bad",)] * 10
    d1, c1 = C.coerce_numeric(spark.createDataFrame(good, "v string"))
    d2, c2 = C.coerce_numeric(spark.createDataFrame(bad, "v string"))
    assert c1 == ["v"] and c2 == []
    assert dict(d1.dtypes)["v"] == "double"
    d3, c3 = C.coerce_numeric(spark.createDataFrame([("1",), ("2",), ("12d",)] * 40, "v string"))
    assert c3 == []  # '12d' is not a number here


def test_datetime_coercion_rejects_time_only(spark):
    df = spark.createDataFrame([("12:30",), ("13:45",)] * 10, "v string")
    _, coerced = C.coerce_datetime(df)
    assert coerced == []
    df2 = spark.createDataFrame([("2024-01-05",), ("1/31/2024",), ("2024/2/3",)] * 10, "v string")
    out, coerced = C.coerce_datetime(df2)
    assert coerced == ["v"] and out.where(F.col("v").isNull()).count() == 0


def test_duplicates_null_equals_null_and_keep_lowest_key(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", 1.0)], "k int, s string, x double")
    out = C.drop_duplicates(df, key="k")
    assert sorted(r["k"] for r in out.collect()) == [1, 3]


def test_drop_empty_rows_then_columns(spark):
    df = spark.createDataFrame([(None, None, 1), (None, None, None), (None, "x", 2)], "a int, b string, c int")
    out = C.drop_empty(df)
    assert out.columns == ["b", "c"] and out.count() == 2


def test_sparse_threshold_is_strict(spark):
    rows = [(None,)] * 6 + [(1.0,)] * 4  # exactly 0.6 -> kept
    out, dropped = C.drop_sparse_columns(spark.createDataFrame(rows, "x double"))
    assert dropped == []
    rows = [(None,)] * 7 + [(1.0,)] * 3
    out, dropped = C.drop_sparse_columns(spark.createDataFrame(rows, "x double"))
    assert dropped == ["x"]


def test_column_name_dedupe_and_unnamed(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "c1 int, c2 int, c3 int, c4 int, c5 int").toDF("a", " a", "a.1", "", "Unnamed: 0")
    out, junk = R.normalize_columns(df)
    assert out.columns == ["a", "a.1", "a.1.1"]
    assert junk == ["Unnamed: 3", "Unnamed: 0"]


def test_csv_blank_header_latin1_and_spaces(spark, tmp_out):
    p = os.path.join(tmp_out, "x.csv")
    with open(p, "wb") as fh:
        fh.write("name, ,value\n".encode("latin-1"))
        fh.write("caf\xe9, 1, 2.5\n".encode("latin-1"))
        fh.write("na\xefve, 2, NA\n".encode("latin-1"))
    df, meta = R.ingest(spark, p)
    assert meta["dropped_unnamed_columns"] == ["Unnamed: 1"]
    rows = df.collect()
    assert [r["name"] for r in rows] == ["café", "naïve"]
    assert [r["value"] for r in rows] == [2.5, None]


def test_json_array_and_lines_and_mixed(spark, tmp_out):
    a = os.path.join(tmp_out, "a.json")
    with open(a, "w") as fh:
        fh.write('[\n {"x": 1, "y": "a", "z": {"k": 1}},\n {"x": 2, "y": 3, "z": [1, 2]}\n]\n')
    b = os.path.join(tmp_out, "b.json")
    with open(b, "w") as fh:
        fh.write('{"x": 1, "y": "a"}\n{"x": 2, "y": "b"}\n')
    da, _ = R.ingest(spark, a)
    db, _ = R.ingest(spark, b)
    assert da.count() == 2 and db.count() == 2
    ra = {r["x"]: r for r in da.collect()}
    assert ra[2]["y"] == "3"  # mixed scalar types become text
    assert isinstance(ra[1]["z"], str)


def test_mom_from_zero_is_null_and_best_month_tie_first(spark):
    import datetime as dt
    rows = [(dt.datetime(2020, 1, 5), 0.0), (dt.datetime(2020, 2, 5), 5.0), (dt.datetime(2020, 3, 5), 5.0),
            (dt.datetime(2020, 5, 5), 1.0)]
    df = spark.createDataFrame(rows, "d timestamp_ntz, v double")
    m = {r["period"]: r for r in TS.with_changes(TS.monthly_rollup(df, "d", "v")).collect()}
    assert m["2020-02"]["mom_pct"] is None  # previous month 0
    assert m["2020-04"]["value_count"] == 0 and m["2020-04"]["value_mean"] is None
    s = TS.kpi_summary(df, "d", "v").first()
    assert s["best_period"] == "2020-02" and s["n_months"] == 5
    assert s["worst_period"] == "2020-01" and s["drop_period"] == "2020-04"


def test_under_two_months_unavailable(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0), (dt.datetime(2024, 1, 9), 2.0)], "d timestamp_ntz, v double")
    s = TS.kpi_summary(df, "d", "v").first()
    assert s["available"] is False and s["latest_value"] is None


def test_target_and_task_detection(spark):
    df = spark.createDataFrame([(1, 2.5, "x")], "a int, Label double, z string")
    assert FE.detect_target(df) == "Label"
    df2 = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.5)], "a int, b double")
    assert FE.detect_target(df2) == "b" and FE.detect_task_type(df2, "b") == "regression"
    df3 = spark.createDataFrame([(i, float(i % 3)) for i in range(30)], "a int, b double")
    assert FE.detect_task_type(df3, "b") == "classification"


def test_label_codes_sort_as_text(spark):
    df = spark.createDataFrame([(i, str(v)) for i, v in enumerate([10, 2, 1, 2])], "k int, y string")
    m = {r["value"]: r["code"] for r in FE.label_mapping(df, "y").collect()}
    assert m == {"1": 0, "10": 1, "2": 2}


def test_weekday_monday_zero(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "d timestamp_ntz")  # a Monday
    assert FE.expand_datetimes(df).first()["d__dayofweek"] == 0


def test_infinite_regression_target_dropped(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("inf")), (3, float("nan")), (4, None)], "k int, y double")
    assert [r["k"] for r in FE.finite_target(df, "y").collect()] == [1]


def test_holdout_rules(spark):
    nine = spark.createDataFrame([(i, i % 2) for i in range(9)], "k long, y long")
    out, info = M.holdout_split(nine, "k", "y", "classification")
    assert info["train_on_all"] and out.where("is_test").count() == 9
    ten = spark.createDataFrame([(i, i % 2) for i in range(10)], "k long, y long")
    out, info = M.holdout_split(ten, "k", "y", "classification")
    assert out.where("is_test").count() == 2 and info["stratified"]
    one_member = spark.createDataFrame([(i, 0 if i else 1) for i in range(30)], "k long, y long")
    out, info = M.holdout_split(one_member, "k", "y", "classification")
    assert not info["stratified"] and out.where("is_test").count() == 6
    one_class = spark.createDataFrame([(i, 0) for i in range(30)], "k long, y long")
    out, info = M.holdout_split(one_class, "k", "y", "classification")
    assert not info["stratified"] and out.where("is_test").count() == 6


def test_regression_metrics_zero_variance_and_mape(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0)], "actual double, predicted double")
    r = EV.regression_metrics(df).first()
    assert r["r2"] == 1.0 and r["mape"] is None
    df = spark.createDataFrame([(2.0, 1.0), (4.0, 5.0), (0.0, 1.0)], "actual double, predicted double")
    r = EV.regression_metrics(df).first()
    assert math.isclose(r["mape"], (0.5 + 0.25) / 2 * 100)


def test_weighted_metrics_zero_division(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "a"), ("c", "a")], "actual string, predicted string")
    r = EV.classification_metrics(df).first()
    # class c never predicted: precision 0 there; b predicted once, wrong
    assert math.isclose(r["accuracy"], 0.25)
    assert math.isclose(r["precision_weighted"], (2 * (1 / 3) + 0 + 0) / 4)


def test_confusion_matrix_all_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "actual string, predicted string")
    cm = EV.confusion_matrix(df, classes=["a", "b", "c"]).collect()
    assert len(cm) == 9 and sum(r["n"] for r in cm) == 2


def test_auc_ties_average(spark):
    df = spark.createDataFrame([("0", 0.2, 0.8), ("1", 0.2, 0.8), ("1", 0.1, 0.9), ("0", 0.6, 0.4)],
                               "actual string, p0 double, p1 double")
    v = EV.roc_auc(df, "actual", {"0": "p0", "1": "p1"}).first()["value"]
    assert math.isclose(v, 0.875)


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), [5.0] * 700, rng.exponential(size=500) * 1e6])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    exact = S.exact_quantiles(df, ["x"], probs)["x"]
    for a, c in zip(exact, np.quantile(vals, probs)):
        assert math.isclose(a, c, rel_tol=1e-12, abs_tol=1e-12)


def test_drift_carry_over(spark, tmp_out):
    from tablewise.operators import drift as D
    hist = f"{tmp_out}/stats"
    s1 = spark.createDataFrame([("a", 10.0, 1.0, 0.0, 20.0, 0, 5), ("b", 1.0, 0.0, 1.0, 1.0, 0, 5)], D.STATS_SCHEMA)
    ev, _ = D.carry_over(spark, hist, s1, "r1")
    assert ev.count() == 0  # first run: nothing to compare
    s2 = spark.createDataFrame([("a", 13.0, 1.0, 0.0, 20.0, 0, 5), ("c", 1.0, 1.0, 1.0, 1.0, 0, 5)], D.STATS_SCHEMA)
    ev, _ = D.carry_over(spark, hist, s2, "r2")
    st = {r["column_name"]: r["status"] for r in ev.collect()}
    assert st == {"a": "drift", "b": "dropped", "c": "new"}
    empty = spark.createDataFrame([], D.STATS_SCHEMA)
    ev, _ = D.carry_over(spark, hist, empty, "r3")  # no features: baseline kept, all dropped
    assert {r["status"] for r in ev.collect()} == {"dropped"}
    ev, _ = D.carry_over(spark, hist, s2, "r4")
    assert {r["status"] for r in ev.collect()} == {"ok"}


def test_only_blank_headers_are_index_columns(spark):
    """A column that is really called _c1 is data."""
    df = spark.createDataFrame([(1, 2, 3)], "a int, _c1 int, b int")
    out, junk = R.normalize_columns(df)
    assert out.columns == ["a", "_c1", "b"] and junk == []


def test_datetime_layouts_cast_equals_formatted_parse(spark):
    """Under each layout's shape guard, the parse used equals a formatted parse
    with that layout, valid and invalid dates and times alike; free text and
    time-only text give NULL."""
    import itertools
    from tablewise.functions.scalars import DATETIME_LAYOUTS, parse_datetime
    vals = []
    for y, m, d in itertools.product(["2020", "0001", "9999"], ["1", "02", "12", "13", "00"], ["1", "29", "30", "31", "00"]):
        vals.append(f"{y}-{m}-{d}")
        for tm in ["00:00:00", "23:59:59", "24:00:00", "12:60:00", "09:05:07"]:
            vals += [f"{y}-{m}-{d} {tm}", f"{y}-{m}-{d}T{tm}", f"{y}-{m}-{d} {tm}.123456", f"{y}-{m}-{d} {tm}.123",
                     f"{y}-{m}-{d} {tm[:5]}", f"{m}/{d}/{y} {tm}", f"{y}/{m}/{d}"]
    vals += ["12:30", "a 2020-01-01", "2020-01-01 is a date", "", " 1/2/2020 ", "x" * 40]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    expect = None
    t = F.trim(F.col("s"))
    for pattern, fmt in DATETIME_LAYOUTS:
        parsed = F.try_to_timestamp(t, F.lit(fmt))
        expect = F.when(t.rlike(pattern), parsed) if expect is None else expect.when(t.rlike(pattern), parsed)
    bad = df.where(~F.equal_null(parse_datetime(F.col("s")), expect.cast("timestamp_ntz")))
    assert bad.count() == 0
    assert df.where(parse_datetime(F.col("s")).isNotNull()).count() > 100


def test_more_datetime_layouts(spark):
    import datetime as dt
    from tablewise.functions.scalars import parse_datetime
    want = {"2024-01-05T10:20:30Z": dt.datetime(2024, 1, 5, 10, 20, 30),
            "2024-01-05T10:20:30.123": dt.datetime(2024, 1, 5, 10, 20, 30, 123000),
            "2024-01-05T10:20:30+02:00": dt.datetime(2024, 1, 5, 8, 20, 30),
            "2024-01-05 10:20:30.123456789": dt.datetime(2024, 1, 5, 10, 20, 30, 123456),
            "1/5/2024 3:04 PM": dt.datetime(2024, 1, 5, 15, 4), "1/5/2024 12:04 am": dt.datetime(2024, 1, 5, 0, 4),
            "01/05/24": dt.datetime(2024, 1, 5), "12/31/99": dt.datetime(1999, 12, 31), "5-Jan-2024": dt.datetime(2024, 1, 5),
            "Jan 5, 2024": dt.datetime(2024, 1, 5), "5 January 2024 14:05": dt.datetime(2024, 1, 5, 14, 5),
            "\u00a0\t2024-01-05\n": dt.datetime(2024, 1, 5), "13/13/2024": None, "5-Foo-2024": None, "12:30": None,
            "1/5/2024 13:04 PM": None, "march on": None, "May 99": None}
    df = spark.createDataFrame([(k,) for k in want], "s string")
    assert {r["s"]: r["d"] for r in df.select("s", parse_datetime(F.col("s")).alias("d")).collect()} == want


def test_strip_all_white_space(spark):
    from tablewise.functions.scalars import null_token
    df = spark.createDataFrame([("\tN/A\n",), ("x\t",), ("\u2003 x \u00a0",), ("a b",)], "s string")
    assert [r[0] for r in df.select(null_token(F.col("s"))).collect()] == [None, "x", "x", "a b"]


def _put(folder, name, text):
    p = os.path.join(folder, name)
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(text)
    return p


def test_csv_quotes_line_ends_and_surplus(spark, tmp_out):
    p = _put(tmp_out, "q.csv", 'id,txt,v\n1,"say ""hi"", bob",5\n2,"two\nlines",6\n3,,7\n4,short\n')
    df = R.read_dataset(spark, p)
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, 'say "hi", bob', 5), (2, "two\nlines", 6), (3, None, 7), (4, "short", None)]
    with pytest.raises(ValueError, match="more fields"):
        R.read_dataset(spark, _put(tmp_out, "s.csv", "id,txt\n1,a,x\n2,b\n"))


def test_json_forms_and_order(spark, tmp_out):
    def read(name, text):
        d = R.read_dataset(spark, _put(tmp_out, name, text))
        return d.columns, [tuple(r) for r in d.collect()]

    lines = '{"zeta":1,"price":2.5,"alpha":"x"}\n{"zeta":2,"price":3.5,"alpha":"y","new":1}\n'
    assert read("l.json", lines) == (["zeta", "price", "alpha", "new"], [(1, 2.5, "x", None), (2, 3.5, "y", 1)])
    assert read("a.json", '[{"zeta":1,"alpha":"x"},\n{"zeta":2,"beta":3}]') == (
        ["zeta", "alpha", "beta"], [(1, "x", None), (2, None, 3)])
    assert read("c.json", '{"b":{"0":1,"1":2,"10":3},"a":{"0":"x","1":"y","10":null}}') == (
        ["b", "a"], [(1, "x"), (2, "y"), (3, None)])
    assert read("d.json", '{"b":[1,2],\n "a":["x","y"]}') == (["b", "a"], [(1, "x"), (2, "y")])
    assert read("e.json", '{\n "b": 1,\n "a": "x"\n}') == (["b", "a"], [(1, "x")])
    with pytest.raises(Exception, match="(?i)malformed"):
        R.read_dataset(spark, _put(tmp_out, "bad.json", '{"b":1}\n{"b":\n')).count()
    with pytest.raises(ValueError):
        R.read_dataset(spark, _put(tmp_out, "none.json", "hello\n"))


def test_nested_nulls_and_bad_bytes(spark):
    df = spark.sql("select cast(X'61ff62' as binary) b, named_struct('a', cast(null as int), 'b', 2) s")
    assert tuple(R.nested_to_text(df).first()) == ("a\ufffdb", '{"a":null,"b":2}')


def test_row_key_follows_file_order(spark, tmp_out):
    """Parts are packed into tasks by size; the key follows the files' names and the rows in them."""
    from tablewise.plans.run import ROW_KEY, in_file_order
    folder = os.path.join(tmp_out, "p.csv")
    os.mkdir(folder)
    at = 0
    for i, n in enumerate((3, 4000, 50)):
        _put(folder, f"part-{i}.csv", "v,w\n" + "".join(f"{at + k},1\n" for k in range(n)))
        at += n
    rows = in_file_order(R.read_dataset(spark, folder)).orderBy(ROW_KEY).collect()
    assert [r["v"] for r in rows] == list(range(at)) and [r[ROW_KEY] for r in rows] == list(range(at))


def test_json_lines_with_a_long_first_record(spark, tmp_out):
    long = "x" * ((1 << 20) + 1000)
    path = _put(tmp_out, "long.json", f'{{"b":1,"a":"{long}"}}\n' + '{"b":2,"a":"y"}\n{"b":3,"a":"z"}\n')
    df = R.read_dataset(spark, path)
    assert df.columns == ["b", "a"]
    assert sorted((r["b"], len(r["a"])) for r in df.collect()) == [(1, len(long)), (2, 1), (3, 1)]
    alone = R.read_dataset(spark, _put(tmp_out, "alone.json", f'{{"b":1,"a":"{long}"}}\n'))
    assert [(r["b"], len(r["a"])) for r in alone.collect()] == [(1, len(long))]
    odd = R.read_dataset(spark, _put(tmp_out, "odd.json", '{"b":NaN,"a":"{}"}\n{"b":2,"a":"y"}\n'))
    assert odd.columns == ["b", "a"] and odd.count() == 2


def test_json_values_after_the_first_raise(spark, tmp_out):
    for name, text in [("two.json", '{\n"b":1\n}\n{\n"b":2\n}\n'), ("joined.json", '{"b":1}{"b":2}\n')]:
        with pytest.raises(ValueError, match="one JSON object"):
            R.read_dataset(spark, _put(tmp_out, name, text))


def test_json_objects_of_columns_at_any_size(spark, tmp_out):
    n = 3000
    doc = ('{"b":{' + ",".join(f'"r{i}":{i if i % 2 else "null"}' for i in range(n)) + '},"a":{'
           + ",".join(f'"r{i}":{i}.5' for i in range(n)) + '},"c":{"r0":true,"r1":false},"d":{"r0":"x","r1":7}}')
    df = R.read_dataset(spark, _put(tmp_out, "one.json", doc))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("b", "bigint"), ("a", "double"), ("c", "boolean"), ("d", "string")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000 and "r2999" not in plan  # the plan does not grow with the rows
    rows = [tuple(r) for r in df.collect()]
    assert rows[:2] == [(None, 0.5, True, "x"), (1, 1.5, False, "7")]
    assert rows[2:] == [(i if i % 2 else None, i + 0.5, None, None) for i in range(2, n)]
    many = R.read_json_columns(spark, _put(tmp_out, "many.json", '{"b":{"0":1,"1":2},"a":{"0":"x","1":"y"}}\n'
                                                                 '{"a":{"0":"z"},"b":{"0":3}}\n{"b":{"7":4}}\n'))
    assert sorted((r["b"], r["a"]) for r in many.collect()) == [(1, "x"), (2, "y"), (3, "z"), (4, None)]
    with pytest.raises(ValueError, match="different forms"):
        R.read_dataset(spark, _put(tmp_out, "mix.json", '{\n"b":{"0":1},\n"a":[1]\n}'))

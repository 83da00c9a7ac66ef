"""Charts, tests and ranks from stored counts give what they give from rows."""

from pyspark.sql import functions as F

from tallywork.functions.text import BLANKS, clean_label, strip
from tallywork.operators import charts, clean, contingency, correlation, quality
from tallywork.operators.frequency import numeric_frequencies
from tallywork.plans.analysis import analyze
from tallywork.spec import AnalysisSpec

ROWS = [
    (float(i % 7) if i % 11 else None, float(i * i % 101) / 4, "ab"[i % 2] if i % 13 else None, "xyz"[i % 3] if i % 5 else None)
    for i in range(200)
] + [(float("nan"), 3.5, "a", "x"), (2.0, 500.0, "c", "x"), (2.0, 501.0, "c", "w")]
SPEC = AnalysisSpec(
    numeric=("v", "w"), categorical=("k",), target="g", positive="a", negative="b", test_values=("v",), test_categories=("k",),
    share_categories=("k",), rate_categories=("k",), histogram=("w",), histogram_by_target=("v",), box_by_target=("w",), box_log=("w",), top_n=2,
)


def _table(spark):
    return spark.createDataFrame(ROWS, "v double, w double, g string, k string")


def _rows(df):
    return sorted([tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()], key=str)


def test_charts_of_counted_values(spark):
    df = _table(spark)
    freq = numeric_frequencies(df, ["v", "w"], by=("g",), keep_missing=True, exact=True, keep_ungrouped=True)
    for name in ("v", "w"):
        for group in (None, "g"):
            values = charts.counted_values(freq, name, group)
            assert _rows(charts.histogram(df, name, group, values)) == _rows(charts.histogram(df, name, group))
            # group c holds one value of v twice: it has no curve
            assert _rows(charts.density_curve(df, name, group, 20, values)) == _rows(charts.density_curve(df, name, group, 20))
        assert _rows(charts.box_stats(df, name, "g", charts.counted_values(freq, name, "g"))) == _rows(charts.box_stats(df, name, "g"))
    assert _rows(charts.log_box_stats(df, ["v", "w"], freq)) == _rows(charts.log_box_stats(df, ["v", "w"]))
    assert {r["group"] for r in charts.density_curve(df, "v", "g", 20, charts.counted_values(freq, "v", "g")).collect()} == {"a", "b"}


def test_ranks_of_counted_values(spark):
    df = _table(spark)
    freq = numeric_frequencies(df, ["v", "w"], by=("g",), keep_missing=True, exact=True, keep_ungrouped=True)
    assert _rows(correlation.spearman_pairs(df, ["v", "w"], freq)) == _rows(correlation.spearman_pairs(df, ["v", "w"]))
    whole = df.where("v IS NOT NULL AND NOT isnan(v)")
    freq = numeric_frequencies(whole, ["v", "w"], by=("g",), keep_missing=True, exact=True, keep_ungrouped=True)
    assert _rows(correlation.spearman_pairs(whole, ["v", "w"], freq)) == _rows(correlation.spearman_pairs(whole, ["v", "w"]))


def test_categories_are_counted_in_one_scan(spark, monkeypatch):
    df, scans, count = _table(spark), [], contingency.label_frequencies

    def counted(*args, **named):
        scans.append(args)
        return count(*args, **named)

    monkeypatch.setattr(contingency, "label_frequencies", counted)
    found = analyze(df, SPEC, models=False).results
    assert len(scans) == 1
    monkeypatch.undo()
    cleaned = clean.clean(df, "g", ("v", "w"))
    assert _rows(found["chi_square"]) == _rows(contingency.chi_square_tests(cleaned, ["k"], "g", 2))
    assert _rows(found["chart_shares"]) == _rows(charts.stacked_shares(cleaned, ["k"], "g", 2))
    assert _rows(found["chart_rates"]) == _rows(charts.positive_rate_bars(cleaned, ["k"], "g", "a", 2))
    assert _rows(found["chart_histogram_v"]) == _rows(charts.histogram(cleaned, "v", "g"))
    assert _rows(found["clean_counts"]) == _rows(clean.clean_counts(df, "g"))
    assert _rows(found["data"]) == _rows(quality.overview(df))


def test_strip_leaves_no_blank(spark):
    texts = ["", " ", "a", "a.", " a", "a\t", " a b ", "é", " é", "é.", "~", "!", ".", "..", " . ", "a . .", "\x7f", "a　", "\x1fa", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    full = F.btrim("t", F.lit(BLANKS))
    label = F.btrim(F.rtrim(full, F.lit(".")), F.lit(BLANKS))
    for got, want in df.select(F.struct(strip(F.col("t")), clean_label(F.col("t"))), F.struct(full, label)).collect():
        assert tuple(got) == tuple(want)
    plan = df.select(strip(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN" in plan  # texts without a blank at either end are not trimmed

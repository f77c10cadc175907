"""Operators on small hand-made tables, and against plain Python on random ones."""

import random
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfpanel.operators import audit_checks, changes, keys, outliers, positions, ranks, runs, targets, verification
from shelfpanel.operators.dedup import first_per_group, keep_last
from shelfpanel.operators import extraction, selectors
from shelfpanel.operators.failures import failure_ledger, first_permanent, ledger_counts, retryable
from shelfpanel.operators.history import history_flags
from shelfpanel.operators.outliers import iqr_outliers
from workload import adapters as A

NF = "Not Found"


def test_redirects(spark):
    a, b = "B000000001", "B000000002"
    df = spark.createDataFrame(
        [("US", a, b), ("US", a, ""), ("US", a, f" {a} "), ("DE", None, b), ("DE", a, None)],
        "Country string, ASIN string, `ASIN Product Page` string",
    )
    fixed = keys.correct_redirects(df)
    assert rows(fixed, "ASIN", "Requested ASIN", "redirected", "page_invalid") == sorted(
        [(b, a, True, False), (a, a, False, True), (a, a, False, False), (b, None, True, False), (a, a, False, True)],
        key=lambda r: tuple(str(x) for x in r),
    )
    assert rows(keys.redirect_stats(fixed, ["Country"])) == [("DE", 2, 1, 1), ("US", 3, 1, 1)]
    assert rows(keys.redirected_keys(fixed)) == [("DE", None, b), ("US", a, b)]
    assert rows(keys.invalid_page_keys(fixed)) == [("DE", a), ("US", a)]


def test_key_filters(spark):
    df = spark.createDataFrame([("US", "A"), ("XX", "A"), (None, "B")], "Country string, ASIN string")
    places = A.marketplaces(spark)
    assert rows(keys.known_countries(df, places)) == [("US", "A")]
    assert rows(keys.unknown_countries(df, places)) == [(None, "B"), ("XX", "A")]
    assert keys.unknown_countries(df, places).count() == 2
    wanted = spark.createDataFrame([("US", "A")], "Country string, ASIN string")
    assert keys.only_keys(df, wanted, ["Country", "ASIN"]).count() == 1
    assert keys.without_keys(df, wanted, ["Country", "ASIN"]).count() == 2


def test_price_errors(spark):
    df = spark.createDataFrame(
        [("1", NF, NF), ("2", None, " "), ("3", "1.0", NF), ("4", NF, "2.0")], "ASIN string, Price string, PED string"
    )
    assert rows(keys.price_errors(df), "ASIN") == [("1",), ("2",)]


def test_keep_last(spark):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "new"), (None, 1, "x"), (None, 1, "y"), ("b", None, "n"), ("b", 0, "z")],
        "k string, seq int, v string",
    )
    assert rows(keep_last(df, ["k"], ["seq"]), "k", "v") == [(None, "y"), ("a", "new"), ("b", "z")]


def test_keep_last_trims_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = keep_last(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    shuffle, partial = plan.index("Exchange hashpartitioning"), plan.index("Partial")
    assert partial > shuffle


def test_first_per_group(spark):
    df = spark.range(20).select((F.col("id") % 2).alias("k"), "id")
    assert rows(first_per_group(df, ["k"], ["id"], 2)) == [(0, 0), (0, 2), (1, 1), (1, 3)]


def test_batches(spark):
    df = spark.createDataFrame([("US", f"A{i}") for i in range(11)] + [("DE", "B1")], "Country string, ASIN string")
    sizes = rows(positions.work_batches(df, 4).groupBy("Country", "batch").count())
    assert sizes == [("DE", 1, 1), ("US", 1, 3), ("US", 2, 3), ("US", 3, 3), ("US", 4, 2)]


@pytest.mark.parametrize("n, batches", [(1, 1), (100, 7), (13, 13), (5, 9), (1000, 16)])
def test_batch_sizes_differ_by_one(spark, n, batches):
    df = spark.range(n).select(F.lit("US").alias("Country"), F.col("id").cast("string").alias("ASIN"))
    sizes = [r[0] for r in positions.work_batches(df, batches).groupBy("batch").count().select("count").collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_session_positions(spark):
    df = spark.range(23).select(F.lit("US").alias("Country"), F.col("id").cast("string").alias("ASIN"))
    got = positions.session_positions(df, 10)
    assert sorted((r["session"], r["session_pos"]) for r in got.collect()) == [
        (i // 10 + 1, i % 10) for i in range(23)
    ]


def test_number_within_matches_plain_numbering(spark):
    rng = random.Random(1)
    # A third of the rows in one group, null keys, repeated order values.
    data = [(("hot" if i % 3 == 0 else rng.choice(["a", "b", None])), rng.randrange(5000), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, o int, i int")
    got = positions.number_within(df, ["k"], F.floor(F.col("o") / 100), ["o", "i"], "pos", "size")
    groups = {}
    for k, o, i in data:
        groups.setdefault(k, []).append((o, i))
    want = {}
    for k, members in groups.items():
        for p, (_, i) in enumerate(sorted(members), 1):
            want[i] = (p, len(members))
    assert {r["i"]: (r["pos"], r["size"]) for r in got.collect()} == want


def test_key_texts_do_not_collide(spark):
    df = spark.createDataFrame([("a|1:b", None), ("a", "1:b"), ("a", None), ("a", "-")], "x string, y string")
    assert df.select(positions.group_text(["x", "y"]).alias("g")).distinct().count() == 4


def tile(rank, asin, sponsored, title="t", price="1"):
    return ("2024-05-01", "US", "bin", rank, asin, title, sponsored, price, None, NF, NF)


TILE_SCHEMA = (
    "Date string, Country string, Keyword string, Rank int, ASIN string, Title string, Sponsored string, Price string, "
    "`Num Reviews` string, `Bought Past Month` string, Deal string"
)


def test_ranks(spark):
    tiles = spark.createDataFrame(
        [tile(1, "A", "No"), tile(2, "B", "Yes"), tile(3, "C", "No"), tile(4, "A", "Yes")], TILE_SCHEMA
    )
    renumbered = ranks.renumber_ranks(tiles)
    assert rows(renumbered, "ASIN", "Sponsored", "Rank") == [("A", "No", 1), ("A", "Yes", 2), ("B", "Yes", 1), ("C", "No", 2)]
    want = [("A", 1, 2), ("B", None, 1), ("C", 2, None)]
    assert rows(ranks.pivot_ranks(renumbered), "ASIN", "Organic Rank", "Sponsored Rank") == want
    assert rows(ranks.join_rank_sides(renumbered), "ASIN", "Organic Rank", "Sponsored Rank") == want


def test_rank_fan_out(spark):
    tiles = spark.createDataFrame(
        [tile(1, "A", "No"), tile(2, "A", "No"), tile(1, "A", "Yes"), tile(2, "A", "Yes")], TILE_SCHEMA
    )
    assert ranks.join_rank_sides(tiles).count() == 4
    assert rows(ranks.pivot_ranks(tiles), "Organic Rank", "Sponsored Rank") == [(2, 2)]


def test_calendar_and_gap(spark):
    d1, d2, d3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 9)
    days = [("US", "A", d1, "x"), ("US", "A", d3, "y"), ("US", "B", d1, "x"), ("US", "B", d2, "y"), ("US", "B", d3, "y"),
            ("US", "B", None, "z")]
    panel = spark.createDataFrame(days, "Country string, ASIN string, Date date, Badge string")
    calendar = changes.collection_calendar(panel)
    assert [(r["Date"], r["date_no"], r["previous_date"], r["from_last"]) for r in calendar.orderBy("Date").collect()] == [
        (d1, 1, None, 3), (d2, 2, d1, 2), (d3, 3, d2, 1)
    ]
    found = changes.field_changes(changes.monitored_states(panel, ["Badge"]), ["Badge"])
    assert found.count() == 2
    kept = changes.consecutive_only(found, calendar)
    assert rows(kept, "ASIN", "Date", "Value_before", "Value_after", "Change_type") == [("B", d2, "x", "y", "changed")]
    assert rows(changes.key_pairs(panel), "ASIN", "Date") == [("B", d2), ("B", d3)]


def test_outliers_need_twenty_values(spark):
    base = [("US", str(10 + i % 5)) for i in range(19)]

    def found(extra):
        df = spark.createDataFrame(base + extra, "Country string, Price string")
        return rows(iqr_outliers(df), "Country", "column", "outliers", "max_outlier")

    assert found([]) == []
    assert found([("US", "1000")]) == [("US", "Price", 1, 1000.0)]
    assert found([("US", "nan"), ("US", NF)]) == []


def test_value_on_a_fence_is_no_outlier(spark):
    # 0..19: quartiles 4.75 and 14.25, fences -9.5 and 28.5; with 21 values the fences are -10 and 30.
    df = spark.createDataFrame([("US", str(i)) for i in range(20)] + [("US", "30")], "Country string, Price string")
    assert rows(iqr_outliers(df)) == []
    df = spark.createDataFrame([("US", str(i)) for i in range(20)] + [("US", "30.01")], "Country string, Price string")
    assert rows(iqr_outliers(df), "outliers", "lower", "upper") == [(1, -10.0, 30.0)]


def test_narrow_values_spread_over_many_bins(spark):
    import numpy as np

    values = np.random.default_rng(8).permutation(20000) * 4e-7 + 0.002  # all within 0.01
    values[:5] = 0.0119
    df = spark.createDataFrame([("US", repr(float(v))) for v in values], "Country string, Price string")
    sizes = [r["n"] for r in outliers.value_counts(df, ["Price"]).groupBy("bin").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > outliers.BINS // 2 and max(sizes) < 20000 / outliers.BINS * 4
    q1, q3 = np.quantile(values, [0.25, 0.75])
    counts = outliers.value_counts(df, ["Price"])
    got = outliers.quartiles(counts, outliers.bin_ranges(counts)).collect()[0]
    assert np.allclose([got["q1"], got["q3"]], [q1, q3], rtol=1e-12)


def test_outliers_match_numpy_on_random_values(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    data = []
    for country, n in (("hot", 3000), ("US", 400), ("DE", 37), ("IT", 20)):
        scale = rng.choice([0.01, 1.0, 1000.0])
        values = np.round(rng.standard_cauchy(n) * scale, 3)
        data += [(country, repr(float(v))) for v in values]
    got = {r["Country"]: r for r in iqr_outliers(spark.createDataFrame(data, "Country string, PED string")).collect()}
    for country in {c for c, _ in data}:
        v = np.array([float(x) for c, x in data if c == country])
        q1, q3 = np.quantile(v, [0.25, 0.75])
        lower, upper = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        out = v[(v < lower) | (v > upper)]
        if len(out) == 0:
            assert country not in got
            continue
        r = got[country]
        assert (r["outliers"], r["min_outlier"], r["max_outlier"]) == (len(out), out.min(), out.max())
        assert r["lower"] == pytest.approx(lower) and r["upper"] == pytest.approx(upper)


@pytest.mark.parametrize("price, flagged", [("15", False), ("15.01", True), ("5", False), ("4.99", True)])
def test_history_limits(spark, price, flagged):
    schema = "Country string, ASIN string, Date date, Price string, `Number of ratings` string, PED string"
    old = [("US", "A", date(2024, 1, d), p, "7", NF) for d, p in ((1, "8"), (2, "12"))]
    panel = spark.createDataFrame(old + [("US", "A", date(2024, 1, 3), price, "7", NF)], schema)
    assert rows(history_flags(panel)) == ([("price_jump", 1, "US", "A")] if flagged else [])


def test_history_per_country(spark):
    schema = "Country string, ASIN string, Date date, Price string, `Number of ratings` string, PED string"
    data = [("US", "A", date(2024, 1, 1), "1", "9", NF), ("US", "A", date(2024, 1, 2), "1", "8", NF),
            ("DE", "B", date(2024, 1, 3), "1", "5", NF), ("DE", "B", date(2024, 1, 4), "1", "4", NF),
            ("DE", "B", date(2024, 1, 4), "1", "3", NF)]
    panel = spark.createDataFrame(data, schema)
    assert rows(history_flags(panel)) == [("rating_drop", 2, "DE", "B")]
    assert rows(history_flags(panel, per_country=True)) == [("rating_drop", 3, "DE", "B")]


def test_duplicates_count_every_member(spark):
    keys5 = [("US", "A", "1")] * 2 + [("US", "B", "1")] * 3 + [("US", "C", "1")]
    df = spark.createDataFrame(keys5, "Country string, ASIN string, Date string")
    assert rows(audit_checks.duplicate_rows(df)) == [(5, 2)]
    assert rows(audit_checks.duplicate_rows(df.where("ASIN = 'C'"))) == [(0, 0)]


def test_counting_checks(spark):
    df = spark.createDataFrame(
        [("05/16/2026", "A\\\\\\\\B", NF, "6", "-1"), ("05/18/2026", "A\\\\B", None, "5", "3"), ("bad", "M", " ", "x", NF)],
        "Date string, `Size Name` string, Brand string, `Rating Stars` string, `Number of ratings` string",
    )
    profile = audit_checks.date_profile(df).collect()[0]
    assert (profile["span_days"], profile["dates"], profile["invalid_dates"]) == (2, 2, 1)
    assert rows(audit_checks.range_rules(df)) == [
        ("negative_rating_count", 1), ("rating_out_of_range", 1), ("size_name_escape", 2)
    ]
    assert rows(audit_checks.missing_counts(df, ["Brand", "Date"])) == [("Brand", 2, 1), ("Date", 0, 0)]
    assert rows(audit_checks.escape_scan(df, ["Size Name", "Brand"], ["Date"])) == [("Size Name", 1, "A\\\\\\\\B")]
    ratio = audit_checks.sentinel_ratio(df).collect()[0]
    assert (ratio["sentinels"], ratio["cells"], ratio["alert"]) == (2, 15, False)
    assert audit_checks.sentinel_ratio(df, helper_columns=1).collect()[0]["cells"] == 18
    size = audit_checks.row_size(df).collect()[0]
    # 43, 31 and 30 bytes: the cells of each row with two quotes and a mark
    assert size["rows"] == 3 and size["avg_bytes"] == pytest.approx(104 / 3) and not size["alert"]
    quoted = spark.createDataFrame([('a"b', None, 12)], "x string, y string, z int")
    assert audit_checks.row_size(quoted).collect()[0]["avg_bytes"] == 3 + 1 + 2 + 9


def test_currency(spark):
    cases = [("GB", "£", True, "ok"), ("GB", "€", True, "wrong"), ("GB", None, True, "missing_priced"),
             ("GB", " ", False, "missing_unpriced"), ("GB", "gbp", True, "ok"), ("XX", "£", True, "unmapped"),
             ("gb", "£", True, "ok")]
    df = spark.createDataFrame(cases, "c string, s string, p boolean, want string")
    verdict = verification.currency_verdict(F.col("c"), F.col("s"), F.col("p"))
    got = df.select("want", verdict.alias("v"), verification.currency_is_valid(verdict).alias("ok")).collect()
    assert [r["v"] for r in got] == [r["want"] for r in got]
    assert [r["ok"] for r in got] == [True, False, False, True, True, True, True]


def test_region(spark):
    cases = [("London W2 4", "W2 4RT", True), ("Brazil", "10115", False), ("Berlin", "10115", False), ("", "10115", False),
             (None, "10115", False), ("Berlin 10115", "10115", True), ("W2 4RT London", "W2 4RT", True),
             ("10001", "10001", True), ("x 99999 y z", "10001", False)]
    df = spark.createDataFrame(cases, "t string, e string, want boolean")
    got = df.select(verification.region_is_valid(F.col("t"), F.col("e")).alias("v"), "want").collect()
    assert [r["v"] for r in got] == [r["want"] for r in got]


def test_audit_sample_shares(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, "DE").otherwise("US").alias("Country"), F.col("id").cast("string").alias("ASIN")
    )
    placed = positions.session_positions(df, 50)
    sample = verification.audit_sample(placed, 50)
    assert sample.where("session_pos = 0").count() == 0
    share = {r[0]: r[1] / 10000 for r in sample.groupBy("Country").count().collect()}
    # 49 of 50 places are open, ten of them at twice the share.
    assert share["DE"] == pytest.approx(0.40 * 59 / 50, abs=0.03)
    assert share["US"] == pytest.approx(0.15 * 59 / 50, abs=0.03)
    assert sample.count() == verification.audit_sample(placed, 50).count()


def test_check_rates(spark):
    df = spark.createDataFrame([("US", True), ("US", False), ("US", False)], "Country string, bad boolean")
    assert rows(verification.check_rates(df, ["Country"], F.col("bad"))) == [("US", 3, 1, 66.67)]


def test_failure_ledger(spark):
    events = [("A", 1, "bad zip", False), ("A", 2, "timeout", False), ("B", 1, "x", False), ("B", 2, None, True),
              ("C", 1, None, True)] + [("D", i, "network", False) for i in range(4)]
    ledger = failure_ledger(spark.createDataFrame(events, "ASIN string, seq int, message string, ok boolean"))
    assert rows(ledger) == [
        ("A", "zip_error", 1, "network_error", "pending", "NEW_SESSION"),
        ("B", "scraping_error", 0, None, "recovered", None),
        ("D", "network_error", 3, "network_error", "permanent", None),
    ]
    assert rows(retryable(ledger), "ASIN") == [("A",)]
    assert rows(ledger_counts(ledger, ["status"])) == [("pending", 1), ("permanent", 1), ("recovered", 1)]
    assert rows(first_permanent(ledger, ["reason"]), "ASIN") == [("D",)]


def test_failure_after_a_success_opens_a_new_entry(spark):
    events = [("A", 1, "bad zip", False), ("A", 2, None, True)] + [("A", i, "timeout", False) for i in range(3, 7)]
    events += [("B", 1, None, True), ("B", 2, "x", False), ("C", 1, "x", False), ("C", 2, None, True), ("C", 3, "x", False), ("C", 4, None, True)]
    ledger = failure_ledger(spark.createDataFrame(events, "ASIN string, seq int, message string, ok boolean"))
    assert rows(ledger, "ASIN", "reason", "attempts", "status") == [
        ("A", "network_error", 3, "permanent"), ("B", "scraping_error", 0, "pending"), ("C", "scraping_error", 1, "recovered"),
    ]


def test_tiles_end_with_their_element(spark):
    html = '<i>head</i><div class="t">1<div>in</div>x</div><p>between</p><div class="t">2<div>y</div></div><div>foot</div>'
    df = extraction.with_tags(spark.createDataFrame([(1, html)], "page_id int, html string"))
    found = extraction.tiles(df, selectors.rule("div.t"), ["page_id"])
    found = found.withColumn("text", F.expr(extraction.shown(extraction.TAGS)))
    assert rows(found, "Rank", "text") == [(1, "1inx"), (2, "2y")]


def page_text(spark, html, selector, attribute=None):
    df = extraction.with_tags(spark.createDataFrame([("US", html)], "Country string, html string"))
    fields = {"f": [selectors.rule(selector, attribute=attribute)]}
    return extraction.extract_fields(df, fields).select("f").collect()[0][0]


def test_selectors_find_whole_elements(spark):
    html = (
        '<!DOCTYPE html><!-- <p id="a">no</p> --><script>var t = "<p id=a>no</p>"; if (a < b) {}</script>'
        '<div id="a" data-x="1 > 0" title=\'it "is"\'>A &amp; <div>b<br>c</div> d 1 < 2 &lt;x&gt;</div><p class="k m">one</p><p class="m">two'
        '<table id="t"><tr><th>Weight</th><td>1</td></tr><tr><th>Date here</th><td><table><tr><td>B1</td></tr></table>Z</td></tr></table>'
        '<input id="i" value="v &amp; w"><span data-id="s">no</span><SPAN ID="s">Up</SPAN><div class="c"><b>x</b><b>y</b></div><em>open <em>ends'
    )
    want = {
        "#a": "A & bc d 1 < 2 <x>", "//div[@id='a']": "A & bc d 1 < 2 <x>", "p.m": "one", "p.k.m": "one", ".c > b": "x", "//div[@class='c']/b[2]": "y",
        "//tr[th[contains(text(), 'Date')]]/td": "B1Z", "//th[contains(text(), 'Weight')]/following-sibling::td": "1",
        "//tr[th[contains(text(), 'None')]]/td": NF, "//b[contains(., 'y')]": "y", "//div[contains(@class, 'c') and contains(., 'xy')]": "xy",
        "[data-x='1 > 0'] div": "bc", "em": "open ends", "#none": NF, "p[class*='k']": "one", "#i": "", "span#s": NF, "#t td": "1",
    }
    assert {k: page_text(spark, html, k) for k in want} == want
    assert page_text(spark, html, "#i", "value") == "v & w"
    assert page_text(spark, html, "#a", "title") == 'it "is"'
    for bad in ("//p[last()]", "p:hover", "//p[@id=a]"):
        with pytest.raises(ValueError):
            selectors.rule(bad)


def test_each_country_has_its_selectors(spark):
    settings = {
        "US": {"title": [{"by": "ID", "value": "t"}]}, "CA": {"title": [{"by": "ID", "value": "t"}]},
        "DE": {"title": [{"by": "XPATH", "value": "//h1"}, {"by": "CLASS_NAME", "value": "n"}]}, "FR": {},
    }
    rules = selectors.settings_rules(settings, "title", [selectors.rule("h2")])
    html = '<h2>two</h2><h1>one</h1><p class="n m">n</p><b id="t">t</b>'
    pages = [(c, html) for c in ("US", "CA", "DE", "FR")] + [("DE", '<p class="n m">n</p><b id="t">t</b>')]
    df = extraction.with_tags(spark.createDataFrame(pages, "Country string, html string"))
    assert rows(extraction.extract_fields(df, {"f": rules}), "Country", "f") == [("CA", "t"), ("DE", "n"), ("DE", "one"), ("FR", "two"), ("US", "t")]
    with pytest.raises(ValueError):
        selectors.steps_of("LINK_TEXT", "x")


def run_tables(spark, processed=90, requested=100, seconds=3600, failed=("F1", "F2", "F3", "F4"), ped=("P1",)):
    runs_df = spark.createDataFrame(
        [("US", "2024-05-01 10:00:00", seconds, requested, processed, 2, 0, list(failed), list(ped))],
        "Country string, ended_at string, elapsed_seconds long, requested long, processed long, redirects long, "
        "removed long, failed array<string>, price_ped array<string>",
    ).withColumn("ended_at", F.col("ended_at").cast("timestamp"))
    return runs_df, runs.errors_from_lists(runs_df)


def test_run_summary(spark):
    got = runs.execution_summary(*run_tables(spark), detailed=True).collect()[0]
    assert (got["Success Rate (%)"], got["Processing Time (min)"], got["Avg Time per ASIN (s)"]) == (90.0, 60.0, 40.0)
    assert (got["Scraping Errors"], got["Price/PED Errors"], got["Total Errors"]) == (4, 1, 5)
    assert (got["tier"], got["status"], got["duration"]) == ("amber", "Ran with Errors", "1h")
    empty = runs.execution_summary(*run_tables(spark, processed=0, requested=0, failed=(), ped=())).collect()[0]
    assert (empty["Success Rate (%)"], empty["Avg Time per ASIN (s)"], empty["Total Errors"]) == (0.0, 0.0, 0)


def test_error_samples_and_report(spark):
    tables = run_tables(spark, failed=[f"F{i:02d}" for i in range(30)])
    samples = runs.error_samples(tables[1])
    assert samples.where("`Error Type` = 'Complete Scraping Failure'").count() == 10
    assert samples.where("`Error Type` = 'Price/PED Error'").count() == 1
    lines = [r["line"] for r in runs.run_report(*tables, title="Panel").orderBy("line_no").collect()]
    assert lines[1] == "Panel US - Ran with Errors"
    assert lines[2] == "Extracted: 90/100 products (90.0%)"
    assert "- Sample failed ASINs (showing first 3): F00, F01, F02" in lines
    assert lines[0] == lines[-1] == "=" * 60


def test_rollup(spark):
    df = spark.createDataFrame([("US", True, 10), ("US", False, 20), ("DE", True, 5)], "Country string, success boolean, elapsed_seconds int")
    assert rows(runs.batch_rollup(df)) == [("DE", 1, 1, 0, 5), (None, 3, 2, 1, 35), ("US", 2, 1, 1, 30)]


def test_targets(spark):
    own = spark.createDataFrame([("US", "A"), ("DE", "B")], "Country string, ASIN string")
    other = spark.createDataFrame([("US", "A"), ("US", "C"), ("XX", "D")], "Country string, ASIN string")
    union = targets.union_targets(own, other)
    assert rows(union) == [("DE", "B"), ("US", "A"), ("US", "C"), ("XX", "D")]
    urls = targets.with_product_urls(union, A.marketplaces(spark))
    assert rows(urls, "Url")[0] == ("https://de.shop.example/dp/B?th=1",)
    assert urls.count() == 3
    assert rows(targets.first_targets(union, 2, [("US", "Z")])) == [("DE", "B"), ("US", "A"), ("US", "Z")]
    words = spark.createDataFrame([("EU", "bin lid"), ("US", "box")], "`Sales Region` string, Keywords string")
    assert targets.with_search_urls(words, A.marketplaces(spark)).count() == 5


def test_copies_of_tiles_count_in_the_ranks(spark):
    tiles = spark.createDataFrame(
        [tile(1, "A", "No")] * 3 + [tile(2, "B", "No"), tile(3, "A", "No"), tile(3, "A", "Yes"), tile(3, "C", "No")], TILE_SCHEMA
    )
    by_row, by_copy = (ranks.pivot_ranks(f(tiles)) for f in (ranks.renumber_ranks, ranks.last_ranks))
    want = [("A", 5, 1), ("B", 4, None), ("C", 6, None)]
    assert rows(by_row, "ASIN", "Organic Rank", "Sponsored Rank") == want
    assert rows(by_copy, "ASIN", "Organic Rank", "Sponsored Rank") == want
    assert ranks.last_ranks(tiles).count() == 5

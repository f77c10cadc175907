"""Jobs end to end, and properties that must hold for any input."""

from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfpanel import schemas as S
from shelfpanel.plans.audit import audit_panel, audit_verdict
from shelfpanel.operators.keys import correct_redirects, lost_keys, observed_stats, redirect_stats, tagged_rows, write_tagged
from shelfpanel.operators.targets import with_product_urls
from shelfpanel.plans.changes import backfill_changes, covered_days, latest_changes
from shelfpanel.plans.clean import clean_observations
from shelfpanel.plans.keywords import keyword_panel
from shelfpanel.plans.pages import EXTRA_RULES, PRODUCT_RULES, extract_products, extract_search, selector_coverage
from shelfpanel.plans.panel import deduplicate_panel, upsert_panel
from shelfpanel.plans.run_quality import price_ped_rows, run_quality, store_run_quality
from shelfpanel.plans.targets import collection_targets
from shelfpanel.plans.verification import sampled_check_rates, verify_pages
from shelfpanel.sources.sinks import append_events, write_targets
from shelfpanel.sources.tables import read_error_samples, read_events, read_run_summaries
from workload import adapters as A

NF = "Not Found"
SMALL = "/root/testdata/sf0.001"


def observation(**given):
    return tuple(given.get(c.replace(" ", "_"), NF) for c in S.OBSERVATION_COLUMNS)


@pytest.fixture(scope="module")
def cleaned(spark):
    data = [
        observation(Date="05/16/2026", ASIN="B000000001", Country="US", Name=' A\n"lid" ', Brand="Maker",
                    ASIN_Product_Page="B000000002", Product_Category="Home›Box", Coupon="Coupon: Save 5% | x",
                    Price="24.99", PED="Join Prime to buy this item at $19.99", List_Price="$1,030.00",
                    Number_of_ratings="1.234 ratings", Rating_Stars="4.6", Date_Created="March 5, 2021",
                    BSR_1="#1 in Home (See Top 100)", DOW="home_box_display_on_website", Size_Name="W\\\\\\X"),
        observation(Date="05/16/2026", ASIN="B000000003", Country="XX"),
    ]
    df = spark.createDataFrame(data, S.OBSERVATION_SCHEMA)
    return clean_observations(df, A.marketplaces(spark), keep_flags=True)


def test_clean(cleaned):
    got = [r.asDict() for r in cleaned.collect()]
    assert len(got) == 1
    want = {
        "ASIN": "B000000002", "Requested ASIN": "B000000001", "redirected": True, "page_invalid": False,
        "Link": "https://shop.example/dp/B000000002", "Name": "A 'lid'", "Root Category": "Home",
        "Product Category": "Home › Box", "Coupon": "Save 5%", "Price": "19.99", "PED": "19.99", "List Price": "24.99",
        "Number of ratings": "1234", "Rating Stars": "4.6", "Date Created": "03/05/2021", "BSR 1": "#1 in Home",
        "DOW": "Home Box", "Size Name": "W\\X", "Merchant": NF,
    }
    assert {k: got[0][k] for k in want} == want
    assert "ASIN Product Page" not in got[0]


def test_cleaning_again_changes_nothing(spark, cleaned):
    once = cleaned.drop("Requested ASIN", "redirected", "page_invalid")
    # A second pass would parse its own date and category text, which are kept out of this.
    stable = [c for c in once.columns if c not in ("Date Created", "Product Category", "Product Category Nodes", "Root Category")]
    twice = clean_observations(once, A.marketplaces(spark))
    assert rows(twice, *stable) == rows(once, *stable)


def test_upsert_is_idempotent_and_unique(spark):
    panel = A.price_panel(spark, SMALL)
    first, second = panel.where("seq % 2 = 0"), panel.where("seq % 3 = 0")
    once = upsert_panel(first, second, ["seq"])
    twice = upsert_panel(once, second, ["seq"])
    assert once.count() == once.select(*S.KEY_COLUMNS).distinct().count()
    assert once.exceptAll(twice).count() == twice.exceptAll(once).count() == 0


def test_unparseable_dates_share_a_key(spark):
    schema = "Country string, ASIN string, Date string, Name string"
    old = spark.createDataFrame([("US", "A", "n/a", "old")], schema)
    new = spark.createDataFrame([("US", "A", "soon", "new"), ("US", "A", "5/6/2026", "day")], schema)
    got = upsert_panel(old, new)
    assert rows(got, "Name", "Date") == [("day", date(2026, 5, 6)), ("new", None)]
    assert deduplicate_panel(old.unionByName(new)).count() == 2


@pytest.fixture(scope="module")
def states(spark):
    return A.state_rows(spark, SMALL), A.listing_rows(spark, SMALL)


def test_latest_changes_are_part_of_all(states):
    every = backfill_changes(*states, order=["ts"])
    last = latest_changes(*states, order=["ts"])
    assert last.count() > 0 and last.exceptAll(every).count() == 0


def test_long_listing_list_gives_the_same(states):
    for job in (backfill_changes, latest_changes):
        short, long = job(*states, order=["ts"]), job(*states, order=["ts"])
        assert short.exceptAll(long).count() == long.exceptAll(short).count() == 0


def test_start_and_countries(states):
    every = backfill_changes(*states, order=["ts"])
    part = backfill_changes(*states, start="2024-01-10", countries=["US", "DE"], order=["ts"])
    # The first date of the range has nothing before it.
    assert part.count() > 0
    assert part.exceptAll(every.where("Country IN ('US', 'DE') AND Date > '2024-01-10'")).count() == 0


def test_stored_panel_needs_no_dedup(spark, states):
    panel, listings = states
    unique = deduplicate_panel(panel, ["ts"])
    a, b = backfill_changes(unique, listings, unique=True), backfill_changes(panel, listings, order=["ts"])
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_gained_and_lost_swap_when_time_runs_back(spark, states):
    panel, listings = states
    unique = deduplicate_panel(panel, ["ts"])
    back = unique.withColumn("Date", F.date_sub(F.lit("2030-01-01").cast("date"), F.datediff("Date", F.lit("2020-01-01"))))

    def counts(df):
        return {r[0]: r[1] for r in backfill_changes(df, listings, unique=True).groupBy("Change_type").count().collect()}

    forth, reverse = counts(unique), counts(back)
    assert (forth["gained"], forth["lost"], forth["changed"]) == (reverse["lost"], reverse["gained"], reverse["changed"])


def test_one_date_gives_no_changes(spark, states):
    one_day = states[0].where("Date = '2024-01-05'")
    assert backfill_changes(one_day, states[1]).count() == latest_changes(one_day, states[1]).count() == 0


def test_hot_key_with_many_copies(spark):
    d = date(2024, 1, 1)
    hot = spark.range(30000).select(
        F.lit("US").alias("Country"), F.lit("B000000000").alias("ASIN"),
        F.date_add(F.lit(d), (F.col("id") % 3).cast("int")).alias("Date"), F.col("id").alias("ts"),
        F.concat(F.lit("b"), (F.col("id") % 7).cast("string")).alias("Badge"),
    )
    listings = spark.createDataFrame([("B000000000", "s", "US", "Active")], S.LISTING_SCHEMA)
    got = backfill_changes(hot, listings, fields=["Badge"], order=["ts"])
    last = {(i % 3): f"b{i % 7}" for i in range(30000)}
    want = [((d + timedelta(days=i)).isoformat(), last[i - 1], last[i]) for i in (1, 2) if last[i] != last[i - 1]]
    assert rows(got, "Date", "Value_before", "Value_after") == want


def test_keyword_panel_prefers_new_rows(spark):
    tiles = A.keyword_tiles(spark, SMALL)
    panel = keyword_panel(tiles)
    assert panel.count() == panel.select(*S.KEYWORD_KEY).distinct().count()
    old = panel.withColumn("Title", F.lit("old"))
    merged = keyword_panel(tiles, old)
    assert merged.where("Title = 'old'").count() == 0 and merged.count() == panel.count()
    # Old rows stay where nothing new came.
    part = keyword_panel(tiles.where("Date < '2024-01-10'"), old)
    assert part.where("Title = 'old'").count() == panel.where("Date >= '2024-01-10'").count()


def test_keyword_panel_keeps_the_last_in_column_order(spark):
    columns = "Date string, Country string, Keyword string, Rank long, ASIN string, Sponsored string, Price string, Deal string"
    tiles = spark.createDataFrame(
        [
            ("2026-05-01", "US", "bin", 9, "A", "No", "5", NF), ("2026-05-01", "US", "bin", 1, "A", "Yes", "5", "Save 5%"),
            ("2026-05-01", "US", "bin", 2, "B", "Yes", None, "a"), ("2026-05-01", "US", "bin", 3, "B", "No", "7", "z"),
        ],
        columns,
    )
    got = rows(keyword_panel(tiles), "ASIN", "Price", "Deal", "Organic Rank", "Sponsored Rank")
    assert got == [("A", "5", "Save 5%", None, 1), ("B", None, "a", None, 2)]


def test_audit(spark):
    findings = audit_panel(A.price_panel(spark, SMALL))
    by = {(r["category"], r["item"]): r["count"] for r in findings.collect()}
    assert by[("range_rule", "rating_out_of_range")] > 0 and ("empty", "panel") not in by
    verdict = audit_verdict(findings).collect()[0]
    assert verdict["valid"] and verdict["warnings"] == len(by)
    empty = audit_panel(A.price_panel(spark, SMALL).where("false"))
    assert not audit_verdict(empty).collect()[0]["valid"]


def test_run_quality_is_stored(spark, tmp_path):
    runs, errors = (df.where("ended_at < '1995-02-01'") for df in A.runs_and_errors(spark, SMALL))
    tables = run_quality(runs, errors)
    store_run_quality(tables, str(tmp_path))
    store_run_quality(tables, str(tmp_path))
    summary = read_run_summaries(spark, str(tmp_path / "execution_summary"))
    assert summary.columns == S.SUMMARY_SCHEMA.names and summary.count() == tables["summary"].count()
    samples = read_error_samples(spark, str(tmp_path / "error_samples"))
    assert samples.columns == S.ERROR_SCHEMA.names and rows(samples) == rows(tables["samples"])
    assert spark.read.text(str(tmp_path / "reports")).select("value").count() == tables["report"].count()


def test_a_run_without_errors_any_more_has_no_samples(spark, tmp_path):
    runs, errors = (df.where("ended_at < '1995-02-01'") for df in A.runs_and_errors(spark, SMALL))
    tables = run_quality(runs, errors)
    store_run_quality(tables, str(tmp_path))
    one = tables["samples"].select("Country").first()[0]
    some = runs.where(F.col("Country") == one)
    store_run_quality(run_quality(some, errors.where("false")), str(tmp_path))
    left = read_error_samples(spark, str(tmp_path / "error_samples"))
    assert rows(left) == rows(tables["samples"].where(F.col("Country") != one)) != []
    assert read_run_summaries(spark, str(tmp_path / "execution_summary")).count() == runs.count()


def test_statistics_come_with_the_rows(spark):
    df = spark.createDataFrame(
        [("US", "A" * 10, "B" * 10, "1", NF), ("US", "A" * 10, "", NF, " "), ("US", "A" * 10, "A" * 10, NF, "2")],
        "Country string, ASIN string, `ASIN Product Page` string, Price string, PED string",
    )
    seen, counts = observed_stats(correct_redirects(df))
    assert seen.count() == 3
    assert counts.get == {"rows": 3, "redirected": 1, "page_invalid": 1, "price_errors": 1}
    total = redirect_stats(correct_redirects(df), []).collect()[0].asDict()
    assert {k: counts.get[k] for k in total} == total


def test_rejected_rows_are_written_apart(spark, tmp_path):
    df = spark.createDataFrame([("US", "A"), ("XX", "B"), (None, "C"), ("US", NF)], "Country string, ASIN string")
    write_tagged(tagged_rows(df, A.marketplaces(spark)), str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert rows(back, "ASIN", "Verdict") == [("A", "accepted"), ("B", "unknown country"), ("C", "no country"), (NF, "no key")]
    assert rows(spark.read.parquet(str(tmp_path / "t" / "Verdict=accepted"))) == [("US", "A")]


def test_lost_keys_feed_the_next_targets(spark, tmp_path):
    a, b, c, d, e = (f"B00000000{i}" for i in range(1, 6))
    wanted = spark.createDataFrame([("US", x) for x in (a, b, c, d, e)] + [("US", a)], "Country string, ASIN string")
    seen = spark.createDataFrame([("US", a, a), ("US", b, ""), ("US", d, c), ("US", d, "")], "Country string, ASIN string, `ASIN Product Page` string")
    lost = lost_keys(wanted, correct_redirects(seen), spark.createDataFrame([("US", e, "zip_error")], "Country string, ASIN string, reason string"))
    assert rows(lost, "ASIN", "Reason") == [(b, "invalid page"), (e, "zip_error")]
    assert rows(lost_keys(wanted, correct_redirects(seen.limit(0))), "Reason") == [("not collected",)] * 5
    write_targets(with_product_urls(lost.drop("Reason"), A.marketplaces(spark)), str(tmp_path / "t"))
    assert rows(spark.read.text(str(tmp_path / "t"))) == [(f"https://shop.example/dp/{x}?th=1",) for x in (b, e)]


def test_covered_days_go_with_the_events(spark, states, tmp_path):
    panel, listings = states
    path = str(tmp_path / "e")
    every = backfill_changes(panel, listings, order=["ts"])
    append_events(every, path, covered_days(panel, listings))
    assert rows(read_events(spark, path)) == rows(every)
    append_events(latest_changes(panel, listings, order=["ts"], fields=["Deal"]), path, covered_days(panel, listings, fields=["Deal"], latest=True))
    assert rows(read_events(spark, path)) == rows(every)
    append_events(every.where("false"), path, covered_days(panel, listings, countries=["US"]))
    assert read_events(spark, path).where("Country = 'US'").count() == 0 < read_events(spark, path).count()


def test_price_ped_rows(spark):
    df = spark.createDataFrame([("US", "A", NF, " "), ("US", "B", "1", NF)], "Country string, ASIN string, Price string, PED string")
    assert rows(price_ped_rows(df, ["Country"]), "ASIN", "kind") == [("A", "price_ped")]


def test_collection_targets(spark):
    got = collection_targets(
        A.listing_rows(spark, SMALL), A.competitor_rows(spark, SMALL), A.marketplaces(spark), batches=3, per_session=50
    )
    assert got.count() == got.select("Country", "ASIN").distinct().count()
    assert {r[0] for r in got.select("batch").distinct().collect()} == {1, 2, 3}
    assert got.where("NOT Url LIKE 'https://%/dp/%?th=1'").count() == 0
    assert collection_targets(
        A.listing_rows(spark, SMALL), A.competitor_rows(spark, SMALL), A.marketplaces(spark), country="DE"
    ).select("Country").distinct().collect()[0][0] == "DE"


def test_bare_product_page(spark):
    pages = spark.createDataFrame(
        [("US", "B000000001", "https://shop.example/x", "<html></html>")], "Country string, ASIN string, url string, html string"
    )
    got = extract_products(pages, A.marketplaces(spark), F.lit("2026-05-16").cast("date")).collect()[0].asDict()
    assert got["Date"] == "05/16/2026" and got["ASIN"] == "B000000001"
    rest = {k: v for k, v in got.items() if k not in ("Date", "ASIN", "Link", "Country")}
    assert set(rest.values()) == {NF}


def test_member_notes_follow_the_country(spark):
    html = '<span class="a-size-base">Con Prime</span><span id="primeExclusivePricingMessage">msg</span>'
    pages = spark.createDataFrame(
        [(c, "B000000001", "u", html) for c in ("ES", "US")], "Country string, ASIN string, url string, html string"
    )
    got = extract_products(pages, A.marketplaces(spark), F.lit("2026-05-16").cast("date"))
    assert rows(got, "Country", "PED") == [("ES", "Con Prime"), ("US", "msg")]


def test_fields_are_whole_elements(spark):
    html = (
        '<span id="productTitle">Bin <b>large</b> with <span>a</span> lid</span><div id="availability"><div>In</div> stock</div>'
        '<div id="corePriceDisplay_desktop_feature_div"><div>Now</div><span class="a-price-whole">12<span>.</span></span>'
        '<span class="a-price-fraction">50</span></div><span class="a-price-fraction">99</span>'
        '<div id="feature-bullets"><ul><li><span>One <span>of</span> two</span></li></ul><ul><li><span>Two</span></li></ul></div>'
        '<ul><li><span>Other</span></li></ul><a id="bylineInfo">Brand <i>B</i> Ltd</a><input id="acrCustomerReviewText">'
        '<span class="a-size-base">Con <span>Prime</span> hoy</span>'
    )
    pages = spark.createDataFrame([("ES", "B000000001", "u", html)], "Country string, ASIN string, url string, html string")
    got = extract_products(pages, A.marketplaces(spark), F.lit("2026-05-16").cast("date")).collect()[0]
    assert (got["Name"], got["Stock"], got["Price"]) == ("Bin large with a lid", "In stock", "12.50")
    assert got["Features"] == "One of two | Two" and "B Ltd" in got["Brand"] and got["PED"] == "Con Prime hoy"


def test_search_page(spark):
    def item(asin, inner):
        return f'<div data-asin="{asin}" data-component-type="s-search-result">{inner}</div>'

    html = "<div>head</div>" + "".join(
        [
            item("B000000001", "<h2><span>A &amp; B</span></h2><span>Sponsored</span><span class='q'>5K+ bought in past month</span>"),
            item("", "<h2>no key</h2>"),
            item("B000000002", '<span class="a-price"><span class="a-offscreen">$9.99</span></span>'
                 '<span class="a-size-base s-underline-text">1,234</span><span class="s-coupon-unclipped">Save 5% with coupon</span>'),
            item("B000000003", '<span class="a-badge-text">Deal</span><span class="s-coupon-unclipped">Save 5% with coupon</span>'),
        ]
    )
    pages = spark.createDataFrame([("US", "bin", html)], "Country string, Keyword string, html string")
    got = extract_search(pages, A.marketplaces(spark), F.lit("2026-05-16").cast("date"))
    cols = ["Rank", "ASIN", "Title", "Sponsored", "Price", "Num Reviews", "Bought Past Month", "Deal"]
    assert rows(got, *cols) == [
        (1, "B000000001", "A & B", "Yes", NF, NF, "5K+ bought in past month", NF),
        (3, "B000000002", NF, "No", "$9.99", "1,234", NF, "Save 5%"),
        (4, "B000000003", NF, "No", NF, NF, NF, "Deal"),
    ]


def test_verification_rates(spark):
    data = [("US", f"B{i:09d}", "$" if i % 2 else "€", True, "New York 10001") for i in range(500)]
    observed = spark.createDataFrame(data, "Country string, ASIN string, symbol string, has_price boolean, location string")
    checked = verify_pages(observed, A.marketplaces(spark))
    assert checked.where("currency_valid").count() == 250 and checked.where("region_valid").count() == 500
    rate = sampled_check_rates(checked).collect()[0]
    assert 0 < rate["failed"] < rate["checks"] < 200


def test_default_candidates(spark):
    html = [
        '<div class="a dealBadge">Deal</div><span class="x-coupon-y">Save</span>',
        '<span id="dealBadgeSupportingText"></span><b id="deal-badge-msg">Msg</b>',
    ]
    pages = spark.createDataFrame([(h,) for h in html], "html string")
    got = {(r["field"], r["rule"]): (r["found"], r["found_empty"], r["best"]) for r in selector_coverage(pages).collect()}
    assert got["Limited Time Deal", "class dealBadge"] == (1, 0, 1)
    assert got["Limited Time Deal", "id dealBadgeSupportingText"] == (0, 1, 0)
    assert got["Limited Time Deal", "id deal-badge-msg"] == (1, 0, 1)
    assert got["Coupon", "class part coupon"] == (1, 0, 1)
    extra = extract_products(
        spark.createDataFrame([("US", "B", "u", '<div id="NEW_1_nostos_badge"><h5><p><span>Often</span></p></h5></div>')],
                              "Country string, ASIN string, url string, html string"),
        A.marketplaces(spark), F.lit("2026-05-16").cast("date"), {**PRODUCT_RULES, **EXTRA_RULES},
    )
    assert rows(extra, "Freq Badge") == [("Often",)]


def test_outliers_count_values_once(spark):
    from shelfpanel.operators.outliers import iqr_outliers

    panel = spark.createDataFrame([("DE", str(i % 40), "1", "2", "x") for i in range(300)] + [("DE", "9999", "1", "2", "x")],
                                  '`Country` string, `Price` string, `List Price` string, `Number of ratings` string, `PED` string')
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = iqr_outliers(panel)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Generate inline") == 1  # every use of the counts reads the one shuffle
        assert [(r.column, r.outliers, r.max_outlier) for r in found.collect()] == [("Price", 1, 9999.0)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")

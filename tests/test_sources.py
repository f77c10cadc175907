"""Readers and sinks: what is written reads back the same."""

import json
from datetime import date

from conftest import rows
from pyspark.sql import functions as F

from shelfpanel import schemas as S
from shelfpanel.plans.changes import latest_changes
from shelfpanel.plans.panel import panel_as_text, stored_rows_like, upsert_panel_table
from shelfpanel.sources import marketplaces, sinks, tables

NF = "Not Found"
ODD = ['say "hi"', "two\nlines", "a,b", "back\\slash", "ünï›cod", "", None]


def panel_frame(spark, data):
    return spark.createDataFrame(data, "Country string, ASIN string, Date date, Name string")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(ODD)], "ASIN string, Name string")
    sinks.write_text_csv(df, str(tmp_path / "c"))
    back = tables.read_text_csv(spark, str(tmp_path / "c"))
    want = sorted((str(i), t) for i, t in enumerate(ODD) if t)
    assert [r for r in rows(back, "ASIN", "Name") if r[1]] == want
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "c").glob("*.csv"))
    assert '"say ""hi"""' in text


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "bom.csv"
    path.write_bytes("﻿\"Date\",\"ASIN\"\n\"05/16/2026\",\"A\"\n".encode("utf-8"))
    assert rows(tables.read_text_csv(spark, str(path))) == [("05/16/2026", "A")]


def test_missing_tables_are_empty(spark, tmp_path):
    none = str(tmp_path / "none")
    assert tables.read_panel(spark, none).columns == S.PANEL_COLUMNS
    assert tables.read_panel(spark, none, "csv").count() == 0
    assert tables.read_keyword_panel(spark, none).count() == 0
    assert tables.read_listings(spark, none).count() == tables.read_competitors(spark, none).count() == 0
    assert tables.read_keywords(spark, none).count() == 0
    assert marketplaces.read_marketplaces(spark, none).count() == 0


def test_panel_fields_fill_what_is_absent(spark, tmp_path):
    df = spark.createDataFrame([("US", "A", "05/16/2026", "Deal!")], "Country string, ASIN string, Date string, Deal string")
    sinks.write_text_csv(df, str(tmp_path / "p"))
    got = tables.read_panel_fields(spark, str(tmp_path / "p"), "csv")
    assert rows(got, *S.KEY_COLUMNS, *S.MONITORED_FIELDS) == [("US", "A", "05/16/2026", NF, NF, "Deal!", NF, NF)]


def test_listings(spark):
    data = [("A", "s1", "US", "Active"), ("A", "s2", "US", "Active"), ("B", "s", "US", "Inactive"), (None, "s", "US", "Active"),
            ("C", "s", "DE", "Active")]
    listings = spark.createDataFrame(data, S.LISTING_SCHEMA)
    assert rows(tables.own_asins(listings)) == [("DE", "C"), ("US", "A")]
    assert rows(tables.own_asins(listings, "US")) == [("US", "A")]
    assert rows(tables.own_skus(listings, "US")) == [("US", "A", "s2")]
    rivals = spark.createDataFrame([("US", "X"), ("US", None), ("DE", "Y")], S.COMPETITOR_SCHEMA)
    assert rows(tables.competitor_asins(rivals, "US")) == [("US", "X")]
    words = spark.createDataFrame([("US", "bin"), ("EU", "box")], S.KEYWORD_LIST_SCHEMA)
    assert rows(tables.region_keywords(words, "US")) == [("bin",)]


def test_marketplaces(spark, tmp_path):
    config = {
        "default_xpaths": {"title": {"by": "ID", "value": "t"}, "size": [{"by": "ID", "value": "s1"}, {"by": "CSS", "value": "s2"}]},
        "marketplaces": {
            "US": {"name": "United States", "sales_region_code": "US", "domain": "shop.example", "base_url": "https://shop.example/dp/",
                   "zip_code": "10001", "text_replacements": {"brand_prefix": "Visit the ", "brand_suffix": " Store"},
                   "xpaths": {"title": {"by": "XPATH", "value": "//h1"}, "ped": [{"by": "ID", "value": "p"}]}},
            "DE": {"name": "Germany", "sales_region_code": "EU"},
        },
    }
    path = tmp_path / "m.json"
    path.write_text(json.dumps(config, indent=1))
    got = {r["Country"]: r for r in marketplaces.read_marketplaces(spark, str(path)).collect()}
    us, de = got["US"], got["DE"]
    assert (us["brand_prefix"], us["zip_code"], us["sponsored_text"]) == ("Visit the ", "10001", "Sponsored")
    assert {k: [tuple(s) for s in v] for k, v in us["rules"].items()} == {
        "title": [("XPATH", "//h1")], "size": [("ID", "s1"), ("CSS", "s2")], "ped": [("ID", "p")]
    }
    assert set(de["rules"]) == {"title", "size"} and de["region"] == "EU"


def test_panel_export_in_date_order(spark, tmp_path):
    df = panel_frame(spark, [("US", "B", None, "n"), ("US", "A", date(2026, 5, 17), "x"), ("US", "A", date(2025, 12, 2), "y")])
    for name, panel in (("p", df), ("t", panel_as_text(df))):
        sinks.write_panel_csv(panel, str(tmp_path / name))
        # One partition each way at this size, so the order of the file is the order of the rows.
        parts = sorted((tmp_path / name).glob("*.csv"))
        lines = [line for p in parts for line in p.read_text().splitlines()[1:]]
        assert ["12/02/2025" in lines[0], "05/17/2026" in lines[1], '"B"' in lines[2]] == [True] * 3
    assert rows(panel_as_text(df), "Date") == [("05/17/2026",), ("12/02/2025",), (None,)]


def test_upsert_touches_only_new_dates(spark, tmp_path):
    path = str(tmp_path / "panel")
    d1, d2, d3 = date(2026, 5, 1), date(2026, 5, 2), date(2026, 5, 3)
    upsert_panel_table(spark, path, panel_frame(spark, [("US", "A", d1, "a1"), ("US", "A", d2, "a2"), ("DE", "B", d2, "b2")]))
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "panel").rglob("Date=2026-05-01/*.parquet")}
    upsert_panel_table(
        spark, path,
        panel_frame(spark, [("US", "A", d2, "new"), ("US", "C", d2, "c2"), ("US", "A", d3, "a3"), ("US", "N", None, "n")]),
    )
    want = [("DE", "B", d2, "b2"), ("US", "A", d1, "a1"), ("US", "A", d2, "new"), ("US", "A", d3, "a3"), ("US", "C", d2, "c2"),
            ("US", "N", None, "n")]
    assert rows(tables.read_panel(spark, path), "Country", "ASIN", "Date", "Name") == want
    assert untouched and all(p.stat().st_mtime_ns == t for p, t in untouched.items())
    upsert_panel_table(spark, path, panel_frame(spark, [("US", "N", None, "again")]))
    got = rows(tables.read_panel(spark, path), "Country", "ASIN", "Date", "Name")
    assert got == want[:-1] + [("US", "N", None, "again")]


def event_frame(spark, data):
    return spark.createDataFrame(data, S.EVENT_SCHEMA)


def test_events_rerun_replaces_its_dates(spark, tmp_path):
    path = str(tmp_path / "events")
    first = [("2026-05-01", "A", "US", "s", "Badge", "null", "x", "gained"), ("2026-05-01", "B", "DE", "s", "Badge", "x", "null", "lost")]
    sinks.append_events(event_frame(spark, first), path)
    again = [("2026-05-01", "A", "US", "s", "Deal", "null", "y", "gained")]
    later = [("2026-05-02", "A", "US", "s", "Badge", "x", "y", "changed")]
    sinks.append_events(event_frame(spark, again + later), path)
    back = spark.read.parquet(path)
    assert sorted((str(r["Date"]), r["Country"], r["Field"]) for r in back.collect()) == [
        ("2026-05-01", "DE", "Badge"), ("2026-05-01", "US", "Deal"), ("2026-05-02", "US", "Badge")
    ]
    sinks.rebuild_events(event_frame(spark, later), path)
    assert spark.read.parquet(path).count() == 1


def test_targets_and_reports(spark, tmp_path):
    urls = spark.createDataFrame([("US", "https://a"), ("US", "https://b")], "Country string, Url string")
    sinks.write_targets(urls, str(tmp_path / "t"))
    assert rows(spark.read.text(str(tmp_path / "t"))) == [("https://a",), ("https://b",)]
    lines = spark.createDataFrame([("r", 1, "second"), ("r", 0, "first")], "run_id string, line_no int, line string")
    sinks.append_report(lines, str(tmp_path / "r"))
    sinks.append_report(lines, str(tmp_path / "r"))
    sinks.append_report(spark.createDataFrame([("q", 0, "other")], "run_id string, line_no int, line string"), str(tmp_path / "r"))
    files = sorted(p.read_text().split() for p in (tmp_path / "r").glob("*/*.txt") if p.stat().st_size)
    assert files == [["first", "second"], ["other"]]


def test_covered_days_without_events_are_emptied(spark, tmp_path):
    path = str(tmp_path / "events")
    first = [("2026-05-01", "A", "US", "s", "Badge", "null", "x", "gained"), ("2026-05-01", "A", "US", "s", "Deal", "null", "d", "gained"),
             ("2026-05-01", "B", "DE", "s", "Badge", "x", "null", "lost"), ("2026-05-02", "A", "US", "s", "Badge", "x", "y", "changed")]
    sinks.append_events(event_frame(spark, first), path)

    def covered(*days):
        return spark.createDataFrame(list(days), "Date string, Country string, Field string")

    def stored():
        return rows(tables.read_events(spark, path), "Date", "Country", "Field", "ASIN")

    # a second run of one field finds nothing in the US any more, and something else in Germany
    again = [("2026-05-01", "C", "DE", "s", "Badge", "x", "z", "changed"), ("2026-05-09", "C", "DE", "s", "Badge", "x", "z", "changed")]
    days = [("2026-05-01", c, "Badge") for c in ("US", "DE", "FR")]
    for _ in range(2):
        sinks.append_events(event_frame(spark, again), path, covered(*days))
        assert stored() == [("2026-05-01", "DE", "Badge", "C"), ("2026-05-01", "US", "Deal", "A"), ("2026-05-02", "US", "Badge", "A")]
    sinks.append_events(event_frame(spark, []), path, covered(("2026-05-02", "US", "Badge"), ("2026-05-01", "US", "Deal")))
    assert stored() == [("2026-05-01", "DE", "Badge", "C")]


def test_panel_files_with_other_headers_are_joined_by_name(spark, tmp_path):
    folder = tmp_path / "p"
    folder.mkdir()
    (folder / "a.csv").write_text('"ASIN","Name","Country"\n"A","one, ""1""","US"\n')
    (folder / "b.csv").write_text('\ufeff"Country","ASIN"\n"DE","B"\n')
    (folder / "c.csv").write_text('"ASIN","Name","Country"\n"C","three","FR"\n')
    (folder / "_SUCCESS").write_text("")
    got = tables.read_text_csv(spark, str(folder))
    assert rows(got, "ASIN", "Name", "Country") == [("A", 'one, "1"', "US"), ("B", None, "DE"), ("C", "three", "FR")]
    assert rows(tables.read_text_csv(spark, str(folder / "b.csv"))) == [("DE", "B")]


def test_keyword_panel_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("2026-05-01", "US", "bin", "A", "t", "1", None, NF, NF, 1, None)], S.KEYWORD_PANEL_SCHEMA
    )
    sinks.write_keyword_csv(df, str(tmp_path / "k"))
    back = tables.read_keyword_panel(spark, str(tmp_path / "k"), "csv")
    assert back.schema["Organic Rank"].dataType.simpleString() == "bigint"
    assert rows(back, "Date", "ASIN", "Organic Rank", "Sponsored Rank") == [("2026-05-01", "A", 1, None)]


def test_stored_pages(spark, tmp_path):
    df = spark.range(2).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("<p>").alias("html"))
    df.write.parquet(str(tmp_path / "pages"))
    assert tables.read_pages(spark, str(tmp_path / "pages")).count() == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_touched_folders_are_read(spark, tmp_path):
    path = str(tmp_path / "panel")
    days = [date(2026, 5, d) for d in range(1, 9)]
    sinks.write_panel_table(panel_frame(spark, [("US", f"A{i}", d, "n") for d in days for i in range(5)]), path)
    stored = tables.read_panel(spark, path)
    new = panel_frame(spark, [("US", "A0", days[3], "x")])
    picked = stored_rows_like(stored, new)
    assert "dynamicpruning" in plan_of(picked)
    assert picked.count() == 5
    # The odd rows come from folders chosen when the plan is made.
    assert "isnull(Date" in plan_of(picked).replace("#", "")

    listings = spark.createDataFrame([(f"A{i}", "s", "US", "Active") for i in range(5)], S.LISTING_SCHEMA)
    later = panel_frame(spark, [("US", "A0", days[7], "x")]).withColumn("Badge", F.lit("b"))
    upsert_panel_table(spark, path, later)
    changed = latest_changes(tables.read_panel_fields(spark, path), listings, unique=True)
    assert "dynamicpruning" in plan_of(changed)


def test_rows_without_country_or_date_are_kept(spark, tmp_path):
    path = str(tmp_path / "panel")
    d1 = date(2026, 5, 1)
    upsert_panel_table(spark, path, panel_frame(spark, [(None, "A", d1, "a"), ("US", "B", None, "b"), (None, "C", None, "c")]))
    upsert_panel_table(spark, path, panel_frame(spark, [(None, "X", d1, "x"), ("US", "Y", None, "y"), (None, "C", None, "new")]))
    got = rows(tables.read_panel(spark, path), "Country", "ASIN", "Date", "Name")
    assert sorted(r[1] + r[3] for r in got) == ["Aa", "Bb", "Cnew", "Xx", "Yy"]

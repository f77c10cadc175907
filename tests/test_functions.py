"""Column expressions against hand-derived values."""

from pyspark.sql import functions as F

from shelfpanel.functions import addresses, dates, numbers, states, text

C = F.col("c")
NF = "Not Found"


def test_valid_asin(values):
    texts = ["B0B61V8KNW", " B0B61V8KNW ", "B0B61V8KNW\n", "b0b61v8knw", "", NF, None, "B0B61V8KN", "B0B61V8KNWX"]
    assert values(addresses.is_valid_asin(C), texts) == [True] * 3 + [False] * 6


def test_clean_text(values):
    assert values(text.clean_text(C), ['a\n"b"\t c​\r', "x 　y", "﻿ ", None, "a\rb", "­z�"]) == [
        "a 'b' c", "x y", "", None, "ab", "z"
    ]


def test_backslash_runs(values):
    runs = ["\\" * n for n in range(1, 6)]
    assert values(text.collapse_backslashes(C), ["a" + r + "b" for r in runs]) == ["a\\b"] * 5


def test_final_clean(values):
    assert values(text.final_clean(C), [" a\r\nb\\\\c ", None]) == ["a  b\\c", None]


def test_numbers_in_text(values):
    assert values(numbers.first_number(C), ["1,299.50 x", "none", None, "5."]) == ["1299.50", NF, NF, "5."]
    assert values(numbers.count_digits(C), ["1.234 ratings", "1,234", "none", None]) == ["1234", "1234", NF, NF]
    assert values(numbers.rating_number(C), ["4,6 von 5 Sternen", NF]) == ["4.6", NF]


def test_numeric_coercion(values):
    texts = ["1.5", " 2 ", "1e3", ".5", "5.", "-3", "12d", "nan", "inf", "", None, "1 2", "0x1"]
    assert values(numbers.to_number(C), texts) == [1.5, 2.0, 1000.0, 0.5, 5.0, -3.0] + [None] * 7


def test_price_text(spark):
    df = spark.createDataFrame([("1,299", "99"), (None, "99"), ("5", None)], "w string, f string")
    got = [r[0] for r in df.select(numbers.price_text(F.col("w"), F.col("f"))).collect()]
    assert got == ["1299.99", NF, NF]


def test_prime_price(spark):
    rows = [
        ("24.99", "Join Prime to buy this item at $19.99", "30.00"),
        ("24.99", "Exclusive Prime price", "30.00"),
        ("24.99", "This price is exclusively for Amazon Prime members.", NF),
        ("24.99", NF, "30.00"),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "price string, ped string, listed string")

    def run(**kw):
        fixed = numbers.reconcile_prime(F.col("price"), F.col("ped"), F.col("listed"), **kw)
        return [tuple(r) for r in df.select(*[fixed[n] for n in ("Price", "PED", "List Price")]).collect()]

    assert run() == [
        ("19.99", "19.99", "24.99"), ("24.99", "24.99", "30.00"), ("24.99", "24.99", NF), ("24.99", NF, "30.00"),
        (None, None, None),
    ]
    assert [r[2] for r in run(list_from_price=True)] == ["24.99"] * 4 + [None]


def test_category_and_ranks(values):
    assert values(text.root_category(C), [" Home › Box › Lid", "Solo", None]) == ["Home", "Solo", None]
    assert values(text.spaced_category(C), ["Home›Box"]) == ["Home › Box"]
    assert values(text.rank_line(C), ["#1,234 in Home (See Top 100)", "#2 in Box"]) == ["#1,234 in Home", "#2 in Box"]
    assert values(text.display_name(C), ["home_o'neil's_box_display_on_website", None]) == ["Home O'Neil'S Box", NF]
    lines = F.concat_ws("/", *text.rank_lines(C))
    assert values(lines, ["#1 in A\n #2 in B\n#3\n#4", "#1"]) == ["#1 in A/#2 in B/#3", f"#1/{NF}/{NF}"]


def test_coupon(values):
    texts = ["Coupon: Save 5% | Terms", "", None, "  ", "Save\n7%", "a: b: c"]
    assert values(text.coupon_text(C), texts) == ["Save 5%", NF, NF, NF, "Save 7%", "c"]


def test_size_name_and_codes(values):
    assert values(F.length(text.size_name(C)), ["x" * 150]) == [100]
    assert values(text.category_code(C), ["gl_home"]) == ["home"]


def test_brand(spark):
    df = spark.createDataFrame(
        [("Visit the Box Store", "Visit the ", " Store"), ("Visita la tienda de Caja", "Visita la tienda de ", ""),
         (NF, "Not ", ""), ("Plain", None, None)],
        "b string, p string, s string",
    )
    got = [r[0] for r in df.select(text.strip_brand(F.col("b"), F.col("p"), F.col("s"))).collect()]
    assert got == ["Box", "Caja", NF, "Plain"]


def test_features(spark):
    df = spark.createDataFrame([([' one\n"two" ', "", "  ", "a – b"],), ([],), (None,)], "f array<string>")
    assert [r[0] for r in df.select(text.feature_list(F.col("f"))).collect()] == ["one 'two' | a - b", NF, NF]


def test_addresses(values, spark):
    urls = ["https://shop.example/dp/B0B61V8KNW?th=1", "https://shop.example/x", None]
    assert values(addresses.asin_from_url(C), urls) == ["B0B61V8KNW", NF, NF]
    assert values(addresses.asin_from_url(C, F.lit("B000000001")), urls)[1] == "B000000001"
    df = spark.createDataFrame([(["?node=12&node=5", "/x", "?node=7"],), (["/x"],)], "h array<string>")
    assert [r[0] for r in df.select(addresses.node_ids(F.col("h"))).collect()] == ["12›7", NF]
    assert values(addresses.form_encode(C), ["a b&c~*é/"]) == ["a+b%26c~%2A%C3%A9%2F"]
    assert values(addresses.search_url(F.lit("shop.example"), C), ["bin lid"]) == ["https://shop.example/s?k=bin+lid"]
    assert values(addresses.product_url(F.lit("b/"), C, "?th=1"), ["X"]) == ["b/X?th=1"]


def test_script_value(values):
    pages = [
        '<script>x({"immutableParams" :\n {"ptd":"BOX","pgid":"g_display_on_website"}, "more":{}})</script>',
        "<script>none</script>",
        '"immutableParams": {"ptd": {"a": 1}}',
    ]
    assert values(addresses.script_value(C, "ptd"), pages) == ["BOX", NF, NF]
    assert values(addresses.script_value(C, "pgid"), pages)[0] == "g_display_on_website"


def test_dates(values):
    day = dates.event_text(dates.panel_date(C))
    assert values(day, ["05/16/2026", "5/6/2026", "2026-05-16", "13/40/2026", "", None]) == [
        "2026-05-16", "2026-05-06", None, None, None, None
    ]
    assert values(dates.event_text(dates.iso_date(C)), ["2026-05-16", "05/16/2026", None]) == ["2026-05-16", None, None]
    created = ["March 5, 2021", "5 March 2021", "Mar 5, 2021", "2021-03-05", "3/5/2021", "5. März 2021", "5 mars 2021", "5 de marzo de 2021",
               "5 marzo 2021", "5 mar. 2021", "5 MÄRZ 2021"]
    assert values(dates.date_created(C), created) == ["03/05/2021"] * len(created)
    assert values(dates.date_created(C), ["1er août 2020", "2 déc. 2020", "Sept 3, 2020", "4 luglio 2020", "3 ago. 2020"]) == [
        "08/01/2020", "12/02/2020", "09/03/2020", "07/04/2020", "08/03/2020"
    ]
    bad = ["February 30, 2021", "5 jui 2021", "5 Monat 2021", "marble 5, 2021", "5 2021", "", NF, None]
    assert values(dates.date_created(C), bad) == [NF] * len(bad)


def test_short_month_names_are_not_ambiguous():
    numbers_of = dates.month_numbers()
    assert "jui" not in numbers_of and numbers_of["juil"] == 7 and numbers_of["juin"] == 6
    assert {numbers_of[n] for names in dates.MONTHS.values() for n in names.split()} == set(range(1, 13))


def test_durations(values):
    got = values(numbers.duration_text(F.col("c")), [4530, 0, 3600, 59, 60], "c long")
    assert got == ["1h 15m 30s", "0s", "1h", "59s", "1m"]


def test_tiers_and_status(values):
    assert values(states.success_tier(F.col("c")), [95.0, 94.9, 85.0, 84.9], "c double") == ["green", "amber", "amber", "red"]
    assert values(states.run_status(F.col("c")), [0, 1], "c int") == ["Ran Successfully", "Ran with Errors"]


def test_stock_class(values):
    texts = {
        "In Stock": "in_stock", "In stock soon": "in_stock", "Only 3 left in stock": "low_stock", "Nur noch 5 auf Lager": "low_stock",
        "Auf Lager": "in_stock", "Currently unavailable": "unavailable",
        "Usually ships within 2 to 3 days": "ships_delayed", "xyz": "null", NF: "null", " nan ": "null",
        "Disponibilità immediata": "in_stock", "Expédié sous 3 jours": "ships_delayed",
    }
    assert values(states.stock_class(C), list(texts)) == list(texts.values())
    assert values(states.stock_class(C), [None]) == ["null"]


def test_changes(spark):
    df = spark.createDataFrame([("null", "X"), ("X", "null"), ("X", "Y"), ("X", "X")], "b string, a string")
    got = [r[0] for r in df.select(states.change_type(F.col("b"), F.col("a"))).collect()]
    assert got == ["gained", "lost", "changed", None]


def test_failure_rules(spark, values):
    assert values(states.failure_reason(C), ["bad ZIP", "Network down", "read timeout", "other", None]) == [
        "zip_error", "network_error", "network_error", "scraping_error", "scraping_error"
    ]
    cases = [("zip_error", 0, "DELAYED"), ("zip_error", 1, "NEW_SESSION"), ("zip_error", 2, "SKIP"),
             ("network_error", 1, "DELAYED"), ("network_error", 2, "SKIP"),
             ("scraping_error", 0, "IMMEDIATE"), ("scraping_error", 1, "NEW_SESSION")]
    df = spark.createDataFrame(cases, "r string, n int, want string")
    assert all(r[0] == r[1] for r in df.select(states.next_action(F.col("r"), F.col("n")), "want").collect())


def test_run_key_repeats(values):
    one, two = values(addresses.run_key(C, F.lit("x")), ["a", "a"])
    assert one == two and len(one) == 8


def test_location_text(values):
    assert values(text.location_text(C), ["  New  York‎ 10001 ", None]) == ["New York 10001", None]

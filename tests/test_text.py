import datetime

from pyspark.sql import functions as F

from facetflow.functions import keys, text
from facetflow.operators import normalize, specs, titles
from facetflow.schema import LISTING_COLUMNS


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def apply(spark, values, expression, kind="string"):
    rows = one_column(spark, values, kind).select("v", expression(F.col("v")).alias("r")).collect()
    return {r["v"]: r["r"] for r in rows}


def test_numbers_reject_everything_but_decimal_text(spark):
    got = apply(spark, [" 12 ", "1f", "1e3", "abc", ".5", "5.", "", "-3.25", None], text.to_number)
    assert got == {
        " 12 ": 12.0, "1f": None, "1e3": 1000.0, "abc": None, ".5": 0.5, "5.": 5.0, "": None,
        "-3.25": -3.25, None: None,
    }


def test_percent_sign_is_dropped(spark):
    assert apply(spark, ["62%", " 58 ", "x%"], text.to_percent) == {"62%": 62.0, " 58 ": 58.0, "x%": None}


def test_dates_in_listed_layouts(spark):
    day = datetime.date(2026, 1, 2)
    values = ["2026-01-02", "2026-01-02T03:04:05Z", "01/02/2026", "1/2/2026 10:05", "2026/1/2 1:02:03", "Jan 2, 2026", "2-Jan-2026"]
    assert set(apply(spark, values, text.to_date).values()) == {day}
    assert apply(spark, ["soon", ""], text.to_date) == {"soon": None, "": None}


def test_title_case_equals_python(spark):
    values = ["pear-shape", "o'neil 3d", "  two  words ", "ÉLAN vital", "cut-CORNERED square"]
    got = apply(spark, values, text.title_case)
    assert got == {v: v.title() for v in values}


def test_strip_takes_unicode_space(spark):
    values = [" x ", "\tx\n", " a b "]
    assert apply(spark, values, text.strip) == {v: v.strip() for v in values}


def test_price_text(spark):
    got = apply(spark, ["USD 12,345", "$1,234.50", "call", ""], text.parse_price)
    assert got == {"USD 12,345": 12345.0, "$1,234.50": 1234.5, "call": None, "": None}


def test_measurements_need_three_numbers(spark):
    got = apply(spark, ["9.01 x 7.21 x 4.78 mm", "9 × 7.5 × 4 MM extra 2", "1 x 2", None], text.parse_measurements)
    assert tuple(got["9.01 x 7.21 x 4.78 mm"]) == (9.01, 7.21, 4.78)
    assert tuple(got["9 × 7.5 × 4 MM extra 2"]) == (9.0, 7.5, 4.0)
    assert tuple(got["1 x 2"]) == (None, None, None)
    assert tuple(got[None]) == (None, None, None)


def test_ratio_rounds_by_binary_value(spark):
    pairs = [(l / 100, w / 100) for l in range(101, 2500, 37) for w in (100, 125, 160, 333, 2000)]
    df = spark.createDataFrame(pairs, "l double, w double")
    for row in df.select("l", "w", text.l_w_ratio(F.col("l"), F.col("w")).alias("r")).collect():
        assert row["r"] == round(max(row["l"], row["w"]) / min(row["l"], row["w"]), 3)
    none = spark.createDataFrame([(0.0, 1.0), (None, 2.0)], "l double, w double")
    assert [r[0] for r in none.select(text.l_w_ratio(F.col("l"), F.col("w"))).collect()] == [None, None]


def test_modifier_words_mean_none(spark):
    got = apply(spark, ["No Overtone", "N/A", "Greenish", None], text.clean_modifier)
    assert got == {"No Overtone": "", "N/A": "", "Greenish": "Greenish", None: ""}


def test_url_parts_do_not_depend_on_position(spark):
    slugs = apply(spark, ["https://a/products/x-1", "https://a/other"], text.slug_from_url)
    assert slugs["https://a/products/x-1"] == "x-1"
    assert slugs["https://a/other"].startswith("lb_")
    stocks = apply(spark, ["https://a/b/item-12-3", "https://a/b/none"], text.stock_from_url)
    assert stocks["https://a/b/item-12-3"] == "12"
    assert stocks["https://a/b/none"].startswith("bn_")


def test_certificate_digits_lengths(spark):
    values = ["GIA 123456789", "abc", "12345", "123456", "123456789012", "1234567890123", "12-34-56"]
    got = apply(spark, values, keys.certificate_digits)
    assert got == {
        "GIA 123456789": "123456789", "abc": "", "12345": "", "123456": "123456",
        "123456789012": "123456789012", "1234567890123": "", "12-34-56": "123456",
    }


def test_listing_key_branches(spark):
    rows = [
        ("gia", "1234567", "V", "x", "u", "CERT:GIA:1234567"),
        ("  ", "0012345678", "V", "x", "u", "CERT:UNK:0012345678"),
        ("gia", "12", "V", " x ", "u", "SKU:V:x"),
        ("gia", None, "V", None, "u", "URL:V:u"),
        (None, None, "V", " ", "u", "URL:V:u"),
    ]
    df = spark.createDataFrame(rows, "cert_lab string, cert_number string, vendor string, sku_or_stock string, source_url string, want string")
    for row in df.withColumn("got", keys.listing_key(df)).collect():
        assert row["got"] == row["want"]


def test_dedupe_certificate_takes_first_run_of_digits(spark):
    df = spark.createDataFrame(
        [("GIA", "12345 1234567890123"), ("NAN", "123456"), (None, "no"), ("", "x654321")],
        "lab string, number string",
    )
    got = [r[0] for r in df.select(keys.dedupe_certificate(F.col("lab"), F.col("number"))).collect()]
    assert got == ["GIA|1234567890", "UNK|123456", None, "UNK|654321"]


def test_steps_round_half_to_even(spark):
    got = apply(spark, [0.005, 0.015, 0.025, 1.234], lambda c: keys.step_bucket(c, 0.01), "double")
    assert got == {v: round(v / 0.01) for v in got}


def test_normalize_backfills_and_coerces(spark):
    df = spark.createDataFrame(
        [(" fancy deep ", " vs1", "pear-shape", " gia ", "12.5", "x", "2026-02-03 10:00:00", "True", "00123456", "None", "extra")],
        "intensity string, clarity string, shape string, cert_lab string, price_usd string, carat string, "
        "date_seen string, is_lab_grown string, cert_number string, culet string, other string",
    )
    out = normalize.normalize(df)
    assert out.columns == LISTING_COLUMNS
    row = out.first()
    assert (row["intensity"], row["clarity"], row["shape"], row["cert_lab"]) == ("Fancy Deep", "VS1", "Pear-Shape", "GIA")
    assert (row["price_usd"], row["carat"]) == (12.5, None)
    assert str(row["date_seen"]) == "2026-02-03"
    assert row["is_lab_grown"] is True
    assert row["cert_number"] == "00123456"
    assert row["culet"] == "None"
    assert row["vendor"] is None and row["fluorescence"] is None


def test_missing_text_stays_missing(spark):
    df = spark.createDataFrame([(None, "  ")], "intensity string, clarity string")
    row = normalize.normalize(df).first()
    assert row["intensity"] is None and row["clarity"] is None


def test_vendor_is_filled(spark):
    df = spark.createDataFrame([("a", " v "), ("b", " "), ("c", None)], "source_url string, vendor string")
    assert [r["vendor"] for r in normalize.fill_vendor(df, "p").collect()] == ["v", "p", "p"]
    assert {r["vendor"] for r in normalize.fill_vendor(df.drop("vendor"), "p").collect()} == {"p"}


TABLE_TITLES = {
    "GIA 5.06 Carat Fancy Vivid Yellow-VVS2 Round Cut Diamond": ("GIA", "5.06", "Fancy Vivid", "Yellow", "VVS2", "Round"),
    "Natural 1 carat fancy deep orange–si1 pear shaped diamond!": ("", "1", "fancy deep", "orange", "si1", "pear shaped"),
    "Fancy stone": (None,) * 6,
    None: (None,) * 6,
}
LABEL_TITLES = {
    "1.15 Carat Fancy Intense Yellow Radiant Diamond FL GIA": ("1.15", "Fancy Intense Yellow", "Radiant", "FL", "GIA"),
    "1.15 Carat Fancy Intense Yellow Radiant Diamond FL": (None,) * 5,
    "1 15 Carat fancy light cut cornered diamond vs2 x": ("15", "fancy light", "cut cornered", "vs2", ""),
}


def test_titles(spark):
    for titles_wanted, parse in ((TABLE_TITLES, titles.parse_table_title), (LABEL_TITLES, titles.parse_label_title)):
        got = apply(spark, list(titles_wanted), parse)
        assert {k: tuple(v) for k, v in got.items()} == titles_wanted


def test_table_specs_last_line_wins(spark):
    lines = [
        "Stock Number 7654321", "Shape Oval", "Color Fancy Deep Orange", "  Carat   Weight 3.21 ", "Fluorescence None",
        "Length/Width Ratio 1.25", "Depth % 66.5", "Table % 58", "Measurement 9 x 7 x 4 mm", "shape  Round", "Other x", "Polish", None,
    ]
    df = spark.createDataFrame([(lines,), ([],), (None,)], "l array<string>")
    got = [r[0] for r in df.select(specs.parse_table_specs(F.col("l"))).collect()]
    assert got[0] == {
        "stock": "7654321", "shape": "Round", "color": "Fancy Deep Orange", "carat": "3.21", "fluorescence": "None",
        "lw_ratio": "1.25", "depth_pct": "66.5", "table_pct": "58", "measurements": "9 x 7 x 4 mm",
    }
    assert got[1] == {} and got[2] == {}


def test_spec_fields_are_those_of_the_map(spark):
    words = ["Weight:", "weight :", "Shape", "Shape:", "Table %", "Table:", "Depth:", "Measurements", "Measurements:", "\u017fhape", "5", "1 ct", "%", "\n", "x\x01Shape y", " ", ""]
    lines = [[words[(i * 3 + j * 5 + k * (i % 7)) % len(words)] + words[(i + j + k) % len(words)] for j in range(i % 5)] for i in range(200) for k in (1, 2)]
    df = spark.createDataFrame([(x,) for x in [*lines, None, [None]]], "l array<string>")
    for parse, labels in ((specs.parse_table_specs, specs.TABLE_LABELS), (specs.parse_label_specs, specs.LABEL_LABELS)):
        rows = df.select(parse(F.col("l")).alias("m"), parse(F.col("l"), fields=True).alias("s")).collect()
        assert all(list(r["s"].asDict()) == [key for _, key, _ in labels] for r in rows)
        assert all({k: v for k, v in r["s"].asDict().items() if v is not None} == r["m"] for r in rows) and sum(bool(r["m"]) for r in rows) > 100


def test_label_specs_value_layouts(spark):
    lines = [
        "Weight: 2.15Ct", "Shape:Cushion", "Main Color: Yellow", "Secondary  Color: None", "Table: 62 % ", "Depth: 68%",
        "Measurements: 8.10 x 7.40 x 5.03", "Weight:", "Culet: None",
    ]
    df = spark.createDataFrame([(lines,)], "l array<string>")
    assert df.select(specs.parse_label_specs(F.col("l"))).first()[0] == {
        "carat": "2.15", "shape": "Cushion", "color": "Yellow", "modifier": "None", "table_pct": "62", "depth_pct": "68",
        "measurements": "8.10 x 7.40 x 5.03", "culet": "None",
    }


def test_specification_entries_of_two_lines(spark):
    rows = [
        ["Weight: 2.0\nmore", "Shape: Oval\nmodified"],
        ["Weight: 1.5 ct\nnet", "Table: 58%\nabout", "Depth:\n61 %  "],
        ["Table: 57%", "Table: 58%\nabout", "Depth: 61\n%"],
        ["Weight: 1", "weight: 2ct", "Weight: 3\nx"],
        [],
    ]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, lines array<string>")
    got = {r.i: r.m for r in df.select("i", specs.parse_label_specs(F.col("lines")).alias("m")).collect()}
    assert got[0] == {"shape": "Oval"}
    assert got[1] == {"carat": "1.5", "depth_pct": "61"}
    assert got[2] == {"table_pct": "57"}
    assert got[3] == {"carat": "2"} and got[4] == {}


def test_lines_of_the_label_layout_are_judged_once(spark):
    rows = spark.createDataFrame([(["Weight: 2Ct", "Table: 5%", "Table: 6%\nor so"],)], "lines array<string>")
    parsed = rows.select(specs.parse_label_specs(F.col("lines")).alias("m"))
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("zip_with(") <= 2
    assert parsed.first()["m"] == {"carat": "2", "table_pct": "5"}

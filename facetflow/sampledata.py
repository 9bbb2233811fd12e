"""Listings, priced listings, history, texts and pages derived from the driver tables.

The tables have no gaps, so some are made by remainder of a key; every row of
the tables is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """Deal out a scan that has fewer pieces than there are cores.

    Text extraction and model passes are bound by computing; a small file that
    is read as one piece would leave all but one core idle. Large tables have
    more pieces than cores and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _spread(table(spark, sf_dir, "lineitem").drop("l_tax", "l_discount"))
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    suppliers = table(spark, sf_dir, "supplier")
    # Nations and regions are fixed lists of 25 and 5 rows.
    places = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey"))
    )


def _unless(condition: str, value: Column) -> Column:
    return F.when(~F.expr(condition), value)


def _priced(spark: SparkSession, sf_dir: str, price: Column) -> DataFrame:
    text = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    url = F.concat(F.lit("https://shop.example/products/"), F.concat_ws("-", *text))
    number = F.concat(F.lit("No "), (F.lit(1000000) + F.col("l_partkey")).cast("string"))
    lab = F.when(F.expr("l_suppkey % 3 = 0"), "gia").when(F.expr("l_suppkey % 3 = 1"), " IGI ")
    return _source(spark, sf_dir).select(
        F.lower("r_name").alias("feed"),
        F.col("r_name").alias("vendor"),
        url.alias("source_url"),
        F.when(F.expr("l_orderkey % 5 = 0"), "")
        .otherwise(F.col("l_partkey").cast("string"))
        .alias("sku_or_stock"),
        F.col("l_shipdate").cast("date").alias("date_seen"),
        _unless("l_orderkey % 41 = 0", price).alias("price_usd"),
        _unless("l_orderkey % 53 = 0", F.col("l_quantity") / 10).alias("carat"),
        F.lit("Yellow").alias("fancy_color_primary"),
        F.lit("").alias("fancy_color_modifier"),
        F.col("p_type").alias("intensity"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("clarity"),
        F.col("p_name").alias("shape"),
        F.col("l_returnflag").alias("polish"),
        F.col("l_linestatus").alias("symmetry"),
        _unless("o_orderstatus = 'P'", F.col("o_orderstatus")).alias("fluorescence"),
        _unless("l_orderkey % 7 = 0", F.col("p_size") / 4).alias("length_mm"),
        (F.col("p_size") / 5).alias("width_mm"),
        (F.col("p_size") / 8).alias("depth_mm"),
        (F.lit(50) + F.col("l_linenumber")).cast("double").alias("table_pct"),
        _unless("l_linenumber = 3", (F.lit(60) + F.col("l_linenumber")).cast("double")).alias(
            "depth_pct"
        ),
        F.lit("").alias("girdle"),
        F.lit("").alias("culet"),
        F.lit(None).cast("double").alias("l_w_ratio"),
        F.lit("").alias("measurements"),
        lab.otherwise("").alias("cert_lab"),
        _unless("l_orderkey % 3 = 0", number).alias("cert_number"),
        F.lit(True).alias("is_natural"),
        _unless("l_partkey % 50 = 1", F.expr("l_partkey % 50 = 0")).alias("is_lab_grown"),
        F.lit(True).alias("in_stock"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as a vendor would send them, with a ``feed`` column."""
    return _priced(spark, sf_dir, F.col("l_extendedprice"))


def priced_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings whose price depends on weight, for the price model."""
    price = (
        F.lit(500)
        * F.pow(F.col("l_quantity") / 10, F.lit(1.6))
        * (1 + F.col("p_size") / 100)
        * (1 + (F.col("l_partkey") % 11) / 100)
    )
    return _priced(spark, sf_dir, price)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price history with one run per day, from the event stream."""
    return history_of(table(spark, sf_dir, "events"))


def history_of(events: DataFrame) -> DataFrame:
    day = F.replace(F.col("ts").cast("date").cast("string"), F.lit("-"), F.lit(""))
    return events.select(
        F.col("event_type").alias("feed"),
        F.col("event_type").alias("vendor"),
        F.concat(F.lit("U:"), F.col("user_id").cast("string")).alias("listing_key"),
        F.concat(F.lit("https://shop.example/e/"), F.col("event_id").cast("string")).alias(
            "source_url"
        ),
        F.col("value").alias("price_usd"),
        _unless("event_id % 10 = 0", F.col("value") / 100).alias("carat"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("cert_number"),
        F.col("ts").cast("timestamp").alias("scraped_at"),
        F.concat(day, F.lit("T000000Z")).alias("run_id"),
    )


# Words of the title layouts, picked by the table percentage of a listing.
_INTENSITY = "element_at(array('Fancy Vivid', 'Fancy Intense', 'fancy light yellow'), 1 + cast(table_pct as int) % 3)"
_GRADE = "element_at(array('VVS2', 'vs1', 'IF'), 1 + cast(table_pct as int) % 3)"
_LAB = "case when cert_lab = 'gia' then 'GIA ' else '' end"
_CARAT = "coalesce(cast(carat as string), '')"
_SIZE = "cast(width_mm as string), ' x ', cast(depth_mm as string), ' x ', cast(table_pct as string)"

TABLE_TITLE = (
    f"concat({_LAB}, {_CARAT}, ' Carat ', {_INTENSITY}, ' Yellow-', {_GRADE}, ' ', shape, ' Cut Diamond')"
)
LABEL_TITLE = f"concat({_CARAT}, ' carat ', {_INTENSITY}, ' ', shape, ' Diamond ', {_GRADE}, ' ', {_LAB})"
TABLE_LINES = (
    "array(concat('Stock Number ', sku_or_stock), 'Shape unknown', concat('Clarity', clarity), "
    "concat('  Carat  Weight ', coalesce(cast(carat as string), '')), 'Setting none', "
    "concat('Polish ', polish, ' '), concat('Table % ', cast(table_pct as string)), "
    f"concat('Measurements ', {_SIZE}, ' mm'), concat('shape ', shape))"
)
LABEL_LINES = (
    "array(concat('Weight: ', coalesce(cast(carat as string), '0'), 'Ct'), 'Shape: unknown', "
    "concat('Secondary Color: ', fancy_color_modifier), concat('Main  Color:', vendor), "
    "concat('Table: ', cast(table_pct as string), '%'), 'Remarks: none', "
    f"concat('Measurement: ', {_SIZE}), concat('SHAPE: ', shape))"
)
# Entries with a second line of text.
WRAPPED_LINES = (
    "array(concat('Weight: ', coalesce(cast(carat as string), '0'), 'Ct', chr(10), 'net'), concat('Shape: ', shape, chr(10), 'brilliant'), "
    "concat('Table: ', cast(table_pct as string), '%'), case when table_pct > 53 then concat('Table: 1%', chr(10), 'or so') else 'Girdle: thin' end, "
    "concat('Depth: ', cast(table_pct as string), chr(10), '%'), concat('Weight: 9', chr(10), 'about'), concat('Polish:', chr(10), polish))"
)
MEASURES = (
    "case when table_pct = 52 then '' when table_pct = 53 then concat(cast(width_mm as string), ' x 2') "
    "else concat(cast(width_mm as string), ' \u00d7 ', cast(depth_mm as string), ' x ', "
    "cast(table_pct as string), ' MM') end"
)
PRICE_TEXT = (
    "case when price_usd is null then 'on request' else concat('USD ', "
    "cast(cast(floor(price_usd / 1000) as bigint) as string), ',', "
    "lpad(cast(cast(floor(price_usd) as bigint) % 1000 as string), 3, '0')) end"
)


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source_url, table_title, label_title`` of every listing."""
    return listings(spark, sf_dir).select(
        "source_url",
        F.expr(TABLE_TITLE).alias("table_title"),
        F.expr(LABEL_TITLE).alias("label_title"),
    )


# Words that stand for no modifier, and some that are one.
MODIFIERS = "element_at(array('No Overtone', 'none', 'N/A', 'Brownish', ' None ', 'no  overtone', ''), 1 + cast(table_pct as int) % 7)"
# Texts that need quotes in CSV: line breaks, quotes, a comma.
QUOTED = "element_at(array(concat('thin', chr(10), 'to \"thick\"'), 'a, b', concat('x', chr(10), chr(10), 'y'), 'plain', '\"'), 1 + cast(table_pct as int) % 5)"


def spec_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source_url, table_lines, label_lines`` of every listing.

    With a repeated label, an unknown line and lines without a value.
    """
    return listings(spark, sf_dir).select(
        "source_url",
        F.expr(TABLE_LINES).alias("table_lines"),
        F.expr(LABEL_LINES).alias("label_lines"),
    )


def measure_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source_url, measures, price_text`` of every listing."""
    return listings(spark, sf_dir).select(
        "source_url", F.expr(MEASURES).alias("measures"), F.expr(PRICE_TEXT).alias("price_text")
    )


def _markup(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _lines_as(tag: str, lines: str) -> Column:
    return _markup(f"<{tag}>", F.array_join(F.expr(lines), f"</{tag}><{tag}>"), f"</{tag}>")


def table_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """List and detail pages in the "table" layout, one of each per listing.

    A list page shows a card without a link and its product twice, the later
    card with the title and price that count. Listings with an odd stock number
    have no specification rows on their detail page.
    """
    rows = listings(spark, sf_dir)
    url = F.col("source_url")
    card = "<div class='wideJewelGridItemContainer--x'>"
    dollars = F.expr("coalesce(cast(cast(floor(price_usd) as bigint) as string), 'call')")
    lists = rows.select(
        F.concat(url, F.lit("?list")).alias("url"),
        _markup(
            f"<html><body><h1>Stones</h1>{card}<h3>sold</h3></div>",
            f"{card}<a href='",
            url,
            "'>see</a><h3>old</h3><div class='price--now'>$1</div></div>",
            f"{card}<a href='",
            url,
            "'><b>see</b></a><h3> ",
            F.expr(TABLE_TITLE),
            "</h3><div class='a price--now b'>$",
            dollars,
            "</div></div></body></html>",
        ).alias("html"),
    )
    has_rows = F.expr("sku_or_stock = '' or cast(sku_or_stock as bigint) % 2 = 0")
    details = rows.select(
        url.alias("url"),
        _markup(
            "<html><body><p>One stone<div class='cui-info-table'>",
            F.when(
                has_rows,
                _markup(
                    "<div class='x cui-info-table-rows--y'>",
                    _lines_as("div", TABLE_LINES),
                    "</div>",
                ),
            ).otherwise(""),
            "</div></body></html>",
        ).alias("html"),
    )
    return lists, details


def label_url() -> Column:
    """Product address with the title as slug, in which points are hyphens."""
    slug = F.translate(F.expr(LABEL_TITLE), " .", "--")
    keys = F.element_at(F.split("source_url", "/products/"), -1)
    return _markup("https://shop.example/products/", slug, "-", keys)


def label_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """List and detail pages in the "label" layout, one of each per listing.

    Detail pages of listings with table percentage 52 have no specification
    block; those without a price show no price span.
    """
    rows = listings(spark, sf_dir).withColumn("_url", label_url())
    lists = rows.select(
        F.concat("source_url", F.lit("?list")).alias("url"),
        _markup(
            "<html><body><a href='/about'>About carat</a><a class='c' href='",
            F.replace(F.col("_url"), F.lit("https://shop.example"), F.lit("")),
            "'><b>One</b> Carat stone</a><a href='",
            F.col("_url"),
            "'>a carat again</a><a href='/products/other'>no weight</a></body></html>",
        ).alias("html"),
    )
    details = rows.select(
        F.col("_url").alias("url"),
        _markup(
            "<html><body><span>USD</span>",
            F.when(
                F.col("price_usd").isNotNull(),
                _markup("<div><span class='p'> ", F.expr(PRICE_TEXT), " </span></div>"),
            ).otherwise(""),
            F.when(
                F.expr("table_pct <> 52"),
                _markup(
                    "<section class='wide details-block'><h2>Details</h2><div>",
                    _lines_as("p", LABEL_LINES),
                    "</div></section>",
                ),
            ).otherwise(""),
            "<div class='mb-1'>Size</div><div class='x mb-1'>Report Type: ",
            F.coalesce("cert_lab", F.lit("")),
            "</div></body></html>",
        ).alias("html"),
    )
    return lists, details


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages as page sequences: ``site, page_no, url, html``."""
    return table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("site"),
        F.col("page_id").alias("page_no"),
        "url",
        "html",
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source registry: suppliers, active while their balance is positive."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"),
        F.lit("table").alias("layout"),
        (F.col("s_acctbal") > 0).alias("active"),
        F.when(F.col("s_acctbal") <= 0, "no credit").otherwise("").alias("reason"),
    )

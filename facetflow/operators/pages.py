"""From stored pages to cards, links and specification lines.

Pages are a table ``url, html``, read by built-in expressions only (see
``functions.markup``). No operator here gathers the pages of a site into one
task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetflow.functions import markup
from facetflow.functions.text import once, parse_price, strip


@dataclass(frozen=True)
class Markup:
    # Class names that mark the parts of a page.
    card: str = "wideJewelGridItemContainer"
    price: str = "price--"
    rows: str = "cui-info-table-rows"
    block: str = "details-block"
    report: str = "mb-1"


MARKUP = Markup()

_SHARES = 64
_PRICE_SPAN = r"\A(?U)USD\s+[\d,]+\z"

_ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"


def _read(pages: DataFrame) -> DataFrame:
    """``url, _page``: the visible part of every page, a column of its own so that it is made once."""
    return pages.select("url", markup.visible(F.col("html")).alias("_page"))


def page_cards(pages: DataFrame, marks: Markup = MARKUP) -> DataFrame:
    """``url, position, href, title, price`` of every product card."""
    holding = pages.where(F.contains("html", F.lit(marks.card)))
    found = markup.contents(F.col("_page"), markup.with_class(marks.card), marks.card)
    cards = _read(holding).select("url", F.posexplode(found).alias("position", "_card"))
    card = F.col("_card")
    href = once(markup.start_tag(card, "a"), lambda tag: strip(markup.attribute(tag, "href")))
    title, price = (
        F.coalesce(markup.text_of(markup.first_content(card, pattern)), F.lit(""))
        for pattern in (markup.with_tag("h3"), markup.with_class(marks.price))
    )
    # The link is a column of its own, since resolving it reads it many times.
    read = cards.select("url", "position", href.alias("_href"), title.alias("title"), price.alias("price"))
    return read.select("url", "position", absolute_url(F.col("_href"), F.col("url")).alias("href"), "title", "price")


def table_details(pages: DataFrame, marks: Markup = MARKUP) -> DataFrame:
    """``url, lines``: the information-table rows of every detail page."""
    holding = pages.where(F.contains("html", F.lit(marks.rows)))
    rows = markup.first_content(F.col("_page"), markup.with_class(marks.rows))
    lines = F.coalesce(markup.children_texts(F.col("_rows")), F.array().cast("array<string>"))
    return _one_per_url(_read(holding).select("url", rows.alias("_rows")).select("url", lines.alias("lines")))


def label_details(pages: DataFrame, marks: Markup = MARKUP) -> DataFrame:
    """``url, price_usd, lines, cert_lab`` of every detail page."""
    holding = pages.where(
        F.contains("html", F.lit(marks.block))
        | F.contains("html", F.lit("USD"))
        | F.contains("html", F.lit(marks.report))
    )
    page = F.col("_page")
    spans = F.filter(markup.tag_texts(page, "span"), lambda t: t.rlike(_PRICE_SPAN))
    block = markup.first_content(page, markup.with_class(marks.block, whole=True))
    reports = F.transform(markup.contents(page, markup.with_class(marks.report), marks.report), markup.text_of)
    report = F.get(F.filter(reports, lambda t: F.lower(t).contains("report type")), F.lit(0))
    parsed = _read(holding).select(
        "url",
        F.coalesce(F.get(spans, F.lit(0)), F.lit("")).alias("price_text"),
        F.coalesce(markup.tag_texts(block, "p"), F.array().cast("array<string>")).alias("lines"),
        F.coalesce(report, F.lit("")).alias("report"),
    )
    return _one_per_url(parsed).select(
        "url",
        parse_price(F.col("price_text")).alias("price_usd"),
        "lines",
        certificate_lab(F.col("report")).alias("cert_lab"),
    )


def _one_per_url(parsed: DataFrame) -> DataFrame:
    """Copies of a page count once; they are dropped before the shuffle."""
    rest = [F.col(c).desc() for c in parsed.columns if c != "url"]
    rank = F.row_number().over(Window.partitionBy("url").orderBy(*rest))
    return parsed.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def certificate_lab(report: Column) -> Column:
    text = F.upper(report)
    return F.when(text.contains("GIA"), "GIA").when(text.contains("IGI"), "IGI")


def tag_texts(pages: DataFrame, tag: str, keep: list[str]) -> DataFrame:
    """``keep, position, text``: text of every element with the tag, in page order."""
    page = pages.select(*keep, markup.visible(F.col("html")).alias("_page"))
    return page.select(*keep, F.posexplode(markup.tag_texts(F.col("_page"), tag)).alias("position", "text"))


def first_heading(pages: DataFrame, keep: list[str], tag: str = "h3") -> DataFrame:
    return tag_texts(pages, tag, keep).where("position = 0").drop("position")


def absolute_url(href: Column, base: Column) -> Column:
    """Resolve a link against its page: one without a scheme, a site, or a path from the root."""
    scheme = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    site = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/(?:[^?#]*/)?)", 1)
    page, whole = F.regexp_extract(base, "^([^?#]*)", 1), F.regexp_extract(base, "^([^#]*)", 1)
    return (
        F.when((href == "") | href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(whole, href))
        .otherwise(F.concat(F.when(folder == "", F.concat(site, F.lit("/"))).otherwise(folder), href))
    )


def page_anchors(pages: DataFrame, keep: list[str]) -> DataFrame:
    """``keep, href, text`` of every anchor; inside Spark, no Python."""
    hrefs = F.regexp_extract_all("html", F.lit(_ANCHOR), F.lit(1))
    texts = F.regexp_extract_all("html", F.lit(_ANCHOR), F.lit(2))
    anchors = F.arrays_zip(hrefs.alias("href"), texts.alias("text"))
    each = pages.select(*keep, F.explode(anchors).alias("_a"))
    return each.select(
        *keep,
        F.replace(strip(F.col("_a.href")), F.lit("&amp;"), F.lit("&")).alias("href"),
        strip(F.regexp_replace("_a.text", "<[^>]*>", "")).alias("text"),
    )


def product_links(
    pages: DataFrame,
    keep: list[str],
    href_part: str = "/products/",
    text_pattern: str = "(?i)carat",
    absolute: bool = True,
) -> DataFrame:
    """Distinct ``keep, href`` of the anchors that lead to a product."""
    carried = list(dict.fromkeys([*keep, "url"]))
    links = page_anchors(pages, carried).where(
        F.col("href").contains(href_part) & F.col("text").rlike(text_pattern)
    )
    if absolute:
        links = links.withColumn("href", absolute_url(F.col("href"), F.col("url")))
    return links.select(*keep, "href").distinct()


def frontier(cards: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """One card per link, the last one in ``order``; the first links if limited.

    The rank filter becomes a partial group limit, so copies of one link are
    dropped before the shuffle. Only a limited frontier is sorted.
    """
    last_first = Window.partitionBy("href").orderBy(
        *[F.col(c).desc() for c in order],
        *[F.col(c).desc() for c in cards.columns if c not in order and c != "href"],
    )
    unique = (
        cards.where(F.col("href") != "")
        .withColumn("_rank", F.row_number().over(last_first))
        .where("_rank = 1")
        .drop("_rank")
    )
    return unique.orderBy("href").limit(limit) if limit else unique


def pages_in_sequence(
    list_pages: DataFrame, links: DataFrame, max_links: int | None = None
) -> DataFrame:
    """Listing pages up to the first one without links, per site.

    ``list_pages`` has ``site, page_no``; ``links`` has ``site, page_no, href``
    and is read twice.
    With ``max_links`` the sequence also ends at the page on which that many
    distinct links have been seen: the page of the ``max_links``-th link by
    first appearance.
    """
    holding = links.select("site", "page_no").distinct()
    empty = list_pages.select("site", "page_no").join(holding, ["site", "page_no"], "left_anti")
    first_empty = empty.groupBy("site").agg(F.min("page_no").alias("_first_empty"))
    kept = list_pages.join(first_empty, "site", "left").where(
        F.col("_first_empty").isNull() | (F.col("page_no") < F.col("_first_empty"))
    )
    if max_links is None:
        return kept.drop("_first_empty")
    seen = links.groupBy("site", "href").agg(F.min("page_no").alias("_page"))
    # A site may hold most links: first the smallest of each share of its links.
    share = F.pmod(F.xxhash64("href"), F.lit(_SHARES)).alias("_share")
    in_share = Window.partitionBy("site", "_share").orderBy("_page", "href")
    seen = (
        seen.select("*", share)
        .withColumn("_in_share", F.row_number().over(in_share))
        .where(F.col("_in_share") <= max_links)
    )
    nth = F.row_number().over(Window.partitionBy("site").orderBy("_page", "href"))
    last = (
        seen.withColumn("_nth", nth)
        .where(F.col("_nth") <= max_links)
        .groupBy("site")
        .agg(F.max("_page").alias("_last_page"), F.max("_nth").alias("_links"))
        .where(F.col("_links") == max_links)
    )
    kept = kept.join(last.select("site", "_last_page"), "site", "left").where(
        F.col("_last_page").isNull() | (F.col("page_no") <= F.col("_last_page"))
    )
    return kept.drop("_first_empty", "_last_page")

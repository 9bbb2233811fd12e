import tree as html
from facetflow.functions import markup
from facetflow.operators import assemble, pages
from facetflow.plans import harvest
from pyspark.sql import functions as F

CARD = "<div class='wideJewelGridItemContainer--a'>"
LIST = (
    f"<html><body>{CARD}<h3>no link</h3></div>"
    f"{CARD}<a href='/d/12'>x</a><h3>old</h3></div>"
    f"{CARD}<a href='/d/12'><b>x</b></a><h3>IGI 1.5 Carat Fancy Deep Yellow-VS1 Oval Cut Diamond</h3>"
    "<span class='cur price--usd'>$1,250</span></div></body></html>"
)
TABLE = (
    "<p>stone<div class='cui-info-table-rows--x'><div><b>Stock Number</b> 777</div><div>Shape Round</div>"
    "<div>Measurements 4 x 2 x 1 mm</div><div>Table % 58%</div></div>"
)
LABEL = (
    "<span>USD</span><span> USD  9,900 </span><span>USD 1</span><div class='a details-block'><p>Weight: 2Ct<p>Shape: Oval</p>"
    "<div><p>Secondary Color: None</p></div></div><div class='x mb-1y'>REPORT TYPE igi</div>"
)


def test_tree_reading():
    assert html.tag_texts("<p>a<p>b<div>c</p>d</div><!-- <p>no --><script>'<p>'</script><p title='>x'>e&amp;<br>f", "p") == ["a", "b", "e&f"]
    assert html.tag_texts("", "p") == [] and html.tag_texts(None, "p") == []
    assert html.table_detail("<ul><li>x</ul>", "rows") == []


SLOPPY = [
    "<p>a<p>b<div>c</p>d</div><!-- <p>no --><script>'<p>'</script><p title='>x'>e&amp;<br>f",
    "<div><p>one <b>two</b></p><p>three</div> tail <p>four",
    "<pre>x</pre><param><P CLASS=a>upper</P><p/>",
    "<span>USD</span><span class='a'>x<span> USD 9,900 </span></span>",
    "<h3>a<h3>b</h3></h3><h3>c &lt;d&gt; &#233;&#x1F600; &nosuch; &copy &amp;amp;</h3>",
    "", None, "no tags < at all > here", "<!-- open <p>x", "<style><p>y</style><h3>z</h3>",
]


def test_texts_agree_with_the_tree(spark, sf_dir):
    stored = [r[0] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect()]
    df = spark.createDataFrame(list(enumerate([*SLOPPY, *stored])), "i int, html string")
    for tag in ("p", "h1", "li"):
        got = {r.i: r.t for r in df.select("i", markup.tag_texts(markup.visible(F.col("html")), tag).alias("t")).collect()}
        for i, page in enumerate([*SLOPPY, *stored]):
            assert got[i] == html.tag_texts(page, tag), (tag, page)


def test_long_pages_need_no_deep_stack(spark):
    body = "<p>" + "word " * 20_000 + "</p><div class='mb-1'>" + "<b>x</b>" * 3_000 + "</div>" + "<span>y</span>" * 2_000
    page = f"<html title='{'a' * 50_000}'>{body}{LABEL}"
    (row,) = pages.label_details(spark.createDataFrame([("u", page)], "url string, html string")).collect()
    assert (row["price_usd"], row["cert_lab"], row["lines"]) == (9900.0, "IGI", ["Weight: 2Ct", "Shape: Oval", "Secondary Color: None"])


def test_links_are_resolved_like_a_browser(spark):
    from urllib.parse import urljoin

    hrefs = ["", "/a", "//x/y", "b/c", "?q", "#f", "http://z/1", "mailto:x"]
    bases = ["https://s.example/list/p?x=/1", "https://s.example", "http://s/"]
    df = spark.createDataFrame([(h, b) for h in hrefs for b in bases], "h string, b string")
    for r in df.withColumn("u", pages.absolute_url(F.col("h"), F.col("b"))).collect():
        assert r.u == (urljoin(r.b, r.h) if r.h else ""), r


def test_cards_and_frontier(spark):
    df = spark.createDataFrame([("http://s/list", LIST), ("http://s/other", "<p>none</p>")], "url string, html string")
    cards = pages.page_cards(df)
    assert [tuple(r) for r in cards.orderBy("position").collect()][0] == ("http://s/list", 0, "", "no link", "")
    rows = pages.frontier(cards, ["url", "position"]).collect()
    assert [(r["href"], r["price"]) for r in rows] == [("http://s/d/12", "$1,250")]
    many = spark.createDataFrame([(f"u{i % 7}", i) for i in range(20)], "href string, position int")
    assert [tuple(r) for r in pages.frontier(many, ["position"], 2).collect()] == [("u0", 14), ("u1", 15)]


def test_table_harvest(spark):
    lists = spark.createDataFrame([("http://s/list", LIST)], "url string, html string")
    details = spark.createDataFrame([("http://s/d/12", TABLE), ("http://s/d/12", TABLE)], "url string, html string")
    (row,) = harvest.harvest_table(lists, details, "2026-01-01").collect()
    assert (row["sku_or_stock"], row["cert_number"], row["cert_lab"]) == ("777", "777", "IGI")
    assert (row["price_usd"], row["carat"], row["shape"], row["clarity"]) == (1250.0, 1.5, "Round", "VS1")
    assert (row["length_mm"], row["l_w_ratio"], row["table_pct"]) == (4.0, 2.0, 58.0)
    (bare,) = harvest.harvest_table(lists, details.where("false"), "2026-01-01").collect()
    assert (bare["sku_or_stock"], bare["shape"], bare["measurements"]) == ("12", "Oval", "")


def test_label_harvest(spark):
    slug = "1-15-carat-fancy-light-pear-diamond-vs2-gia"
    listing = f"<a href='/products/{slug}'>One Carat</a><a href='/products/two'>2 carat</a><a href='/products/x'>ring</a><a href='/about'>carat</a>"
    lists = spark.createDataFrame([("http://s/list", listing)], "url string, html string")
    details = spark.createDataFrame([("http://s/products/two", LABEL)], "url string, html string")
    rows = {r["sku_or_stock"]: r for r in harvest.harvest_label(lists, details, "2026-01-01").collect()}
    assert set(rows) == {slug, "two"}
    found, guessed = rows["two"], rows[slug]
    assert (found["price_usd"], found["carat"], found["shape"], found["cert_lab"], found["carat_from_slug"]) == (9900.0, 2.0, "Oval", "IGI", False)
    assert found["fancy_color_primary"] == "Yellow" and found["fancy_color_modifier"] == ""
    assert (guessed["carat"], guessed["clarity"], guessed["cert_lab"], guessed["carat_from_slug"]) == (15.0, "vs2", "gia", True)
    log = {r["listing_key"]: r for r in assemble.extraction_log(harvest.harvest_label(lists, details, "2026-01-01")).collect()}
    assert log["two"]["parse_ok"] is True and log[slug]["parse_ok"] is False
    assert "is_lab_grown" in log["two"]["parsed_fields"] and "price_usd" not in log[slug]["parsed_fields"]
    assert log["two"]["parsed_fields"] == sorted(log["two"]["parsed_fields"])


def test_builtin_links_agree_with_the_tree(spark, sf_dir):
    stored = spark.read.parquet(f"{sf_dir}/pages.parquet")
    built = {tuple(r) for r in pages.page_anchors(stored, ["page_id"]).select("page_id", "href", "text").collect()}
    for page in stored.collect():
        for a in html.parse(page["html"]).elements():
            if a.tag == "a" and "href" in a.attrs and a.text():
                assert (page["page_id"], a.attrs["href"], a.text()) in built


def test_page_sequence(spark):
    listed = spark.createDataFrame([("s", i) for i in range(1, 7)] + [("t", 1)], "site string, page_no int")
    links = spark.createDataFrame(
        [("s", 1, "a"), ("s", 1, "b"), ("s", 2, "b"), ("s", 2, "c"), ("s", 3, "d"), ("s", 5, "e"), ("t", 1, "z")],
        "site string, page_no int, href string",
    )

    def kept(limit=None):
        return sorted((r["site"], r["page_no"]) for r in pages.pages_in_sequence(listed, links, limit).collect())

    assert kept() == [("s", 1), ("s", 2), ("s", 3), ("t", 1)]
    assert kept(3) == [("s", 1), ("s", 2), ("t", 1)]
    assert kept(2) == [("s", 1), ("t", 1)]
    assert kept(100) == kept()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_repeated_values_are_made_once(spark):
    df = spark.createDataFrame([("http://s/list", LIST)], "url string, html string")
    plan = _optimized(pages.page_cards(df))
    # Before, the start tag of a price stood in the plan 90 times, that of a title 30 times.
    assert plan.count("price--") <= 6 and plan.count("<(h3)") <= 2
    details = _optimized(pages.table_details(df))
    assert details.count("area|base|br") == 1
    # A start tag inside the value of an attribute still starts a part, as a cut at every place does.
    page = f"<html><p title=\"{CARD}a</div>\">x</p>{CARD}b<DIV>c</div></Div>d{CARD}e"
    (row,) = spark.range(1).select(markup.contents(F.lit(page), markup.with_class("wideJewelGridItemContainer")).alias("c")).collect()
    assert row["c"] == ["a", "b<DIV>c</div>", "e"]


def test_nested_elements_are_read_by_one_pattern(spark):
    card = markup.with_class("k")
    nested = "<div class='k'>a<div/><div>b<div>c<div>d</div></div><divx></div>e</DIV>f"
    deeper = "<div class='k'>" + "<div>" * 4 + "x" + "</div>" * 5
    read = spark.createDataFrame([(nested,), (deeper,), ("<div class=k>open",), ("<p>none",), (None,)], "h string")
    plain = markup._plain_or(F.col("h"), card, F.lit("?")).alias("plain")
    found = read.select(plain, markup.first_content(F.col("h"), card), F.get(markup.contents(F.col("h"), card), F.lit(0))).collect()
    inside = "a<div/><div>b<div>c<div>d</div></div><divx></div>e"
    assert [tuple(r) for r in found[:2]] == [(inside,) * 3, ("?", deeper[15:-6], deeper[15:-6])]
    assert [tuple(r) for r in found[2:]] == [("?", "open", "open"), ("?", None, None), ("?", None, None)]


def test_flat_children_are_read_without_a_fold(spark):
    flat, other = "x<div a=1>A &amp; b</div> y<p>c</P><br>", "<div>a<b>b</b></div><img src='/'><div>c"
    rows = spark.createDataFrame([(flat[:-4],), (flat,), (other,), ("",)], "h string")
    assert [r[0] for r in rows.select(markup.children_texts(F.col("h"))).collect()] == [["A & b", "c"], ["A & b", "c"], ["ab", "c"], []]


def test_one_pattern_reads_what_parts_give_one_by_one(spark):
    start, rest = markup.with_class("k"), markup.with_class("k").split("<", 1)[1]
    bits = ["<div class='k'>", "<DIV title='a>b' CLASS=k>", "<div class='k' title=\"<div class='k'>\">", "<div>", "</div>", "</Div >", "<p>", "</p>", "k", "<k/>", "<div/>"]
    pages_ = ["".join(bits[(i * 7 + j * (i % 5 + 1) + i // 11) % len(bits)] for j in range(i % 9)) for i in range(600)]
    rows = spark.createDataFrame([(p,) for p in [*pages_, None]], "h string")
    h = F.col("h")
    parts = markup._contents_one_by_one(h, start, f"(?is)(?=<{rest})<[^<]*+(?:(?!<{rest})<[^<]*+)*+")
    read = rows.select("h", parts.alias("parts"), markup.contents(h, start).alias("c"), markup.contents(h, start, "K").alias("d")).collect()
    assert all(r["parts"] == r["c"] == r["d"] for r in read) and sum(len(r["c"] or []) > 1 for r in read) > 100


def test_the_value_of_an_attribute_is_found_by_one_pattern(spark):
    tags = {"<a href='x\"y'>": "x\"y", '<a HREF = "it\'s">': "it's", "<a href=u?a=1&amp;b=2 x>": "u?a=1&b=2", "<a href='open>": "", "<a data-href='n' href=''>": "", "<a>": "", "<a x='1'href=v>": "v"}
    rows = spark.createDataFrame([(t,) for t in tags], "t string")
    value = markup.attribute(F.col("t"), "href")
    assert {r["t"]: r["v"] for r in rows.select("t", value.alias("v")).collect()} == tags
    assert str(value._jc).count("href") == 1


def test_pages_that_hide_nothing_are_not_rewritten(spark):
    rows = {"<p>a</p>": "<p>a</p>", "a<!--b-->c": "ac", "a<SCRIPT>b</script>c": "ac", "a<Style x='>'>b": "a", "<scripted>b": "<scripted>b", None: ""}
    df = spark.createDataFrame([(h,) for h in rows], "h string")
    assert {r["h"]: r["v"] for r in df.select("h", markup.visible(F.col("h")).alias("v")).collect()} == rows

"""The named queries as SQL for DuckDB, written against the driver tables."""

from __future__ import annotations

from pyspark.sql import types as T

from facetflow.catalog import AS_OF, LIMITS, NUDGE, RERUN, stored_coefficient
from facetflow.functions import features
from facetflow.operators import model, quality, splits, titles
from facetflow.schema import LISTING_COLUMNS, LISTING_SCHEMA

_FROM = """from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
join region on n_regionkey = r_regionkey"""


def _listings(price: str) -> str:
    return f"""select lower(r_name) as feed, r_name as vendor,
concat('https://shop.example/products/', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) as source_url,
case when l_orderkey % 5 = 0 then '' else cast(l_partkey as varchar) end as sku_or_stock,
cast(l_shipdate as date) as date_seen,
case when l_orderkey % 41 = 0 then null else {price} end as price_usd,
case when l_orderkey % 53 = 0 then null else l_quantity / 10 end as carat,
'Yellow' as fancy_color_primary, '' as fancy_color_modifier, p_type as intensity,
concat(' ', lower(o_orderpriority)) as clarity, p_name as shape, l_returnflag as polish,
l_linestatus as symmetry, case when o_orderstatus = 'P' then null else o_orderstatus end as fluorescence,
case when l_orderkey % 7 = 0 then null else p_size / 4 end as length_mm, p_size / 5 as width_mm,
p_size / 8 as depth_mm, cast(50 + l_linenumber as double) as table_pct,
case when l_linenumber = 3 then null else cast(60 + l_linenumber as double) end as depth_pct,
'' as girdle, '' as culet, cast(null as double) as l_w_ratio, '' as measurements,
case l_suppkey % 3 when 0 then 'gia' when 1 then ' IGI ' else '' end as cert_lab,
case when l_orderkey % 3 = 0 then null else concat('No ', cast(1000000 + l_partkey as varchar)) end as cert_number,
true as is_natural, case when l_partkey % 50 = 1 then null else l_partkey % 50 = 0 end as is_lab_grown,
true as in_stock {_FROM}"""


_RAW = _listings("l_extendedprice")
_PRICED = _listings(
    "500 * power(l_quantity / 10, 1.6e0) * (1 + p_size / 100) * (1 + (l_partkey % 11) / 100)"
)

_TITLED = "array_to_string(list_transform(string_split({0}, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ')"


def _standard(name: str, raw: str) -> str:
    return f"""{name}_raw as ({raw}), {name} as (select * replace (
{_TITLED.format("intensity")} as intensity, upper(trim(clarity)) as clarity,
{_TITLED.format("shape")} as shape, nullif(upper(trim(cert_lab)), '') as cert_lab) from {name}_raw)"""


_N = "with " + _standard("n", _RAW)
_R = f"with r as ({_RAW})"

_LOG_ROWS = f"""with {_standard("p", _PRICED)}, t as (select *, ln(price_usd) as log_price,
round_even(carat / 0.25, 0) * 0.25 as carat_bucket from p
where is_lab_grown is distinct from true and price_usd > 0 and carat > 0)"""

_H = """with h as (select event_type as feed, event_type as vendor, concat('U:', user_id) as listing_key,
concat('https://shop.example/e/', event_id) as source_url, value as price_usd,
case when event_id % 10 = 0 then null else value / 100 end as carat,
regexp_extract(props, '([0-9]+)', 1) as cert_number, ts as scraped_at,
concat(replace(cast(cast(ts as date) as varchar), '-', ''), 'T000000Z') as run_id from events)"""

_CANON = """vendor, source_url, sku_or_stock, cast(date_seen as varchar) as date_seen, price_usd, carat,
fancy_color_primary, fancy_color_modifier, intensity, clarity, shape, polish, symmetry, fluorescence, length_mm,
width_mm, depth_mm, table_pct, depth_pct, girdle, culet, l_w_ratio, measurements, cert_lab, cert_number, is_natural,
is_lab_grown, in_stock"""

_CERT = "coalesce(cert_lab, 'UNK') || '|' || nullif(regexp_extract(cert_number, '([0-9]{6,10})', 1), '')"


def _step(c: str, step: str) -> str:
    return f"cast(round_even({c} / {step}, 0) as bigint)"


_KEYS = f"""{_CERT} as k0, case when ({_CERT}) is null then {_step("carat", "0.01")} end as k1,
case when ({_CERT}) is null then {_step("length_mm", "0.02")} end as k2,
case when ({_CERT}) is null then {_step("width_mm", "0.02")} end as k3,
case when ({_CERT}) is null then {_step("depth_mm", "0.02")} end as k4,
case when ({_CERT}) is null then intensity end as k5, case when ({_CERT}) is null then clarity end as k6,
case when ({_CERT}) is null then shape end as k7"""

_LATEST = """row_number() over (partition by k0, k1, k2, k3, k4, k5, k6, k7 order by date_seen desc nulls last,
vendor nulls last, source_url nulls last, sku_or_stock nulls last, price_usd nulls last, carat nulls last,
fancy_color_primary nulls last, fancy_color_modifier nulls last, intensity nulls last, clarity nulls last,
shape nulls last, polish nulls last, symmetry nulls last, fluorescence nulls last)"""

_DIGITS = "regexp_replace(coalesce(cert_number, ''), '[^0-9]', '', 'g')"


def _rate(condition: str) -> str:
    return f"round(coalesce(avg(case when {condition} then 1.0 else 0.0 end), 0), 6)"


_MEASURES = f"""cast(count(*) as bigint) as rows, {_rate("price_usd is not null")} as price_present_rate,
{_rate("carat is not null")} as carat_present_rate,
round((coalesce(avg(case when price_usd is not null then 1.0 else 0.0 end), 0)
+ coalesce(avg(case when carat is not null then 1.0 else 0.0 end), 0)) / 2, 6) as mean_parse_rate,
{_rate("trim(cert_number) <> ''")} as cert_present_rate"""

_GROWTH = """select run_id, current_rows, lag(run_id) over (order by run_id) as previous_run_id,
coalesce(lag(current_rows) over (order by run_id), 0) as previous_rows from
(select run_id, cast(count(*) as bigint) as current_rows from h group by run_id)"""
_GROWTH = f"""select *, current_rows - previous_rows as delta_rows, round(coalesce(
(current_rows - previous_rows) / nullif(previous_rows, 0), 1.0), 6) as delta_pct from ({_GROWTH})"""

_COVERAGE = """select run_id, cast(count(distinct listing_key) as bigint) as current_unique_listings,
cast(count(distinct nullif(trim(cert_number), '')) as bigint) as current_unique_certs from h group by run_id"""
_EXPANSION = f"""select *, coalesce(current_unique_listings / nullif(baseline_unique_listings, 0), 0) as lm,
coalesce(current_unique_certs / nullif(baseline_unique_certs, 0), 0) as cm from (select *,
first_value(run_id) over (order by run_id) as baseline_run_id,
first_value(current_unique_listings) over (order by run_id) as baseline_unique_listings,
first_value(current_unique_certs) over (order by run_id) as baseline_unique_certs from ({_COVERAGE}))"""
_EXPANSION_OUT = f"""select run_id, current_unique_listings, current_unique_certs, baseline_run_id,
baseline_unique_listings, baseline_unique_certs, round(lm, 6) as listing_coverage_multiple,
round(cm, 6) as cert_coverage_multiple from ({_EXPANSION})"""

_DIVERSITY = """select run_id, cast(sum(n) as bigint) as current_rows, cast(count(vendor) as bigint) as active_vendor_count,
arg_min(vendor, (-n, vendor)) as dominant_vendor, coalesce(max(n) / sum(n), 0) as share,
sum(certified) / sum(n) as cert_rate, (sum(priced) + sum(weighed)) / 2 / sum(n) as parse_rate
from (select run_id, vendor, count(*) as n, count(price_usd) as priced, count(carat) as weighed,
count(nullif(trim(cert_number), '')) as certified from h group by run_id, vendor) group by run_id"""

_JUDGED = f"""select g.run_id, g.delta_rows >= {LIMITS.min_new_rows} as grew,
d.active_vendor_count >= {LIMITS.min_active_vendors} as c1, e.lm >= {LIMITS.min_coverage_multiple} as c2,
e.cm >= {LIMITS.min_coverage_multiple} as c3, d.share <= {LIMITS.max_vendor_share} as c4,
d.cert_rate >= {LIMITS.min_weighted_cert_present_rate} as c5,
d.parse_rate >= {LIMITS.min_weighted_parse_success_rate} as c6
from ({_GROWTH}) g join ({_DIVERSITY}) d on g.run_id = d.run_id join ({_EXPANSION}) e on g.run_id = e.run_id"""

_MISPRICED = """select *, (price_usd - median) / nullif(std, 0) as z, (median - price_usd) / nullif(median, 0) as fall
from (select listing_key, cast(count(*) as bigint) as count, median(price_usd) as median,
stddev_samp(price_usd) as std, arg_max(price_usd, scraped_at) as price_usd, arg_max(vendor, scraped_at) as vendor,
arg_max(feed, scraped_at) as feed, arg_max(source_url, scraped_at) as source_url,
arg_max(cert_number, scraped_at) as cert_number, arg_max(run_id, scraped_at) as run_id,
max(scraped_at) as scraped_at from h group by listing_key) where count >= 5"""

_INTENSITY = "(['Fancy Vivid', 'Fancy Intense', 'fancy light yellow'])[1 + cast(table_pct as int) % 3]"
_GRADE = "(['VVS2', 'vs1', 'IF'])[1 + cast(table_pct as int) % 3]"
_LAB = "case when cert_lab = 'gia' then 'GIA ' else '' end"
_CARAT = "coalesce(cast(carat as varchar), '')"
_SIZE = "cast(width_mm as varchar) || ' x ' || cast(depth_mm as varchar) || ' x ' || cast(table_pct as varchar)"
_TABLE_TITLE = f"concat({_LAB}, {_CARAT}, ' Carat ', {_INTENSITY}, ' Yellow-', {_GRADE}, ' ', shape, ' Cut Diamond')"
_LABEL_TITLE = f"concat({_CARAT}, ' carat ', {_INTENSITY}, ' ', shape, ' Diamond ', {_GRADE}, ' ', {_LAB})"

_TABLE_RE = f"(?i){titles.TABLE_TITLE}"
_LABEL_RE = f"(?i){titles.LABEL_TITLE}"


def _groups(text: str, pattern: str, names: list[str]) -> str:
    # Titles without a match give null in every group.
    picked = ", ".join(
        f"case when regexp_matches({text}, '{pattern}') then regexp_extract({text}, '{pattern}', {i + 1}) end as {n}"
        for i, n in enumerate(names)
    )
    return picked


_ROUND3 = "cast(printf('%.3f', greatest({0}, {1}) / least({0}, {1})) as double)"
_MEASURED = "table_pct not in (52, 53)"
_NO_SPECS = "sku_or_stock <> '' and cast(case when sku_or_stock = '' then '0' else sku_or_stock end as bigint) % 2 = 1"

_CARDS = f"""select *, row_number() over (partition by source_url order by trim({_TABLE_TITLE}) desc,
coalesce(cast(cast(floor(price_usd) as bigint) as varchar), 'call') desc) as rn from r"""
_DETAILS = """select source_url, carat as spec_carat, polish as spec_polish, row_number() over (partition by source_url
order by coalesce(cast(carat as varchar), '') desc, polish desc) as rn from r"""

_STOCK = f"""case when {_NO_SPECS} or sku_or_stock = '' then split_part(split_part(source_url, '/', 5), '-', 1)
else sku_or_stock end"""


def _from_specs(value: str, otherwise: str) -> str:
    return f"case when {_NO_SPECS} then {otherwise} else {value} end"


_ASSEMBLED_TABLE = f"""select 'BlueNile' as vendor, source_url, {_STOCK} as sku_or_stock,
'{AS_OF}' as date_seen, floor(price_usd) as price_usd, {_from_specs("coalesce(spec_carat, carat)", "carat")} as carat,
'Yellow' as fancy_color_primary, '' as fancy_color_modifier,
case when carat is null then '' else {_INTENSITY} end as intensity,
{_from_specs("trim(clarity)", f"case when carat is null then '' else {_GRADE} end")} as clarity,
{_from_specs("shape", "case when carat is null then '' else shape end")} as shape,
{_from_specs("spec_polish", "''")} as polish, '' as symmetry, '' as fluorescence,
{_from_specs("width_mm", "null")} as length_mm, {_from_specs("depth_mm", "null")} as width_mm,
{_from_specs("table_pct", "null")} as depth_mm, {_from_specs("table_pct", "null")} as table_pct,
cast(null as double) as depth_pct, '' as girdle, '' as culet,
{_from_specs(_ROUND3.format("width_mm", "depth_mm"), "null")} as l_w_ratio,
{_from_specs(_SIZE + " || ' mm'", "''")} as measurements, 'GIA' as cert_lab, {_STOCK} as cert_number,
true as is_natural, false as is_lab_grown, true as in_stock
from ({_CARDS}) c join ({_DETAILS}) d using (source_url) where c.rn = 1 and d.rn = 1"""

_BLANK = ["sku_or_stock", "fancy_color_modifier", "girdle", "culet", "measurements"]
_TEXT_COLUMNS = [f.name for f in LISTING_SCHEMA if isinstance(f.dataType, T.StringType)]
_PARSED_FIELDS = "concat_ws(',', {})".format(
    ", ".join(
        "case when {} then '{}' end".format(
            (f"{c} <> ''" if c in _TEXT_COLUMNS else f"{c} is not null"), c
        )
        for c in sorted(LISTING_COLUMNS)
    )
)

_SLUG = f"replace(replace({_LABEL_TITLE}, ' ', '-'), '.', '-')"
_SLUG_CARAT = "cast(split_part(cast(carat as varchar), '.', 2) as double)"
_ASSEMBLED_LABEL = f"""select 'Leibish' as vendor, concat('https://shop.example/products/', {_SLUG}, '-',
split_part(source_url, '/products/', 2)) as source_url, concat({_SLUG}, '-', split_part(source_url, '/products/', 2)) as sku_or_stock,
'{AS_OF}' as date_seen, floor(price_usd) as price_usd,
case when table_pct = 52 then {_SLUG_CARAT} else coalesce(carat, null) end as carat,
case when table_pct = 52 then 'Yellow' else vendor end as fancy_color_primary, '' as fancy_color_modifier,
case when carat is null then '' else {_INTENSITY} end as intensity,
case when carat is null then '' else {_GRADE} end as clarity,
case when table_pct = 52 and carat is null then '' else shape end as shape,
'' as polish, '' as symmetry, '' as fluorescence, case when table_pct = 52 then null else width_mm end as length_mm,
case when table_pct = 52 then null else depth_mm end as width_mm,
case when table_pct = 52 then null else table_pct end as depth_mm,
case when table_pct = 52 then null else table_pct end as table_pct, cast(null as double) as depth_pct,
'' as girdle, '' as culet, case when table_pct = 52 then null else {_ROUND3.format("width_mm", "depth_mm")} end as l_w_ratio,
case when table_pct = 52 then '' else {_SIZE} end as measurements,
case when cert_lab = 'gia' then 'GIA' when cert_lab = ' IGI ' then 'IGI' else '' end as cert_lab,
'' as cert_number, true as is_natural, false as is_lab_grown, true as in_stock,
table_pct = 52 and carat is not null as carat_from_slug from r qualify row_number() over
(partition by {_SLUG}, split_part(r.source_url, '/products/', 2) order by floor(r.price_usd) desc nulls last) = 1"""

_ANCHOR = """(?is)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["''][^>]*>(.*?)</a>"""
_ANCHORS = f"""select *, replace(trim(a[1]), '&amp;', '&') as href, trim(regexp_replace(a[2], '<[^>]*>', '', 'g')) as text
from (select page_id, url, unnest(list_zip(regexp_extract_all(html, '{_ANCHOR}', 1),
regexp_extract_all(html, '{_ANCHOR}', 2))) as a from pages)"""
_SITE = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"


def _sequence(pattern: str) -> str:
    return f"""with links as (select distinct {_SITE} as site, page_id as page_no, href from ({_ANCHORS})
where contains(href, '/') and regexp_matches(text, '{pattern}')),
listed as (select {_SITE} as site, page_id as page_no from pages),
stops as (select site, min(page_no) as stop from listed where (site, page_no) not in (select site, page_no from links) group by site),
kept as (select l.site, l.page_no from listed l left join stops s on l.site = s.site where s.stop is null or l.page_no < s.stop)"""


_MEDIANS = """(select median(b.log_price) from t b where b.carat_bucket = a.carat_bucket
and b.intensity = a.intensity and b.vendor <> a.vendor)"""


def _left_out_error(condition: str = "true") -> str:
    return f"""{_LOG_ROWS}, g as (select distinct vendor as v from t),
m as (select g.v, t.carat_bucket, t.intensity, median(t.log_price) as m from g join t on t.vendor <> g.v group by all),
o as (select g.v, median(t.log_price) as m from g join t on t.vendor <> g.v group by all)
select t.vendor, cast(count(*) as bigint) as {{rows}}, round(avg(abs(t.log_price - coalesce(m.m, o.m))), 6) as baseline_mae_log
from t join o on o.v = t.vendor left join m on m.v = t.vendor and m.carat_bucket = t.carat_bucket and m.intensity = t.intensity
where {condition} group by t.vendor"""


_SPLIT = f"""{_LOG_ROWS}, s as (select *, row_number() over (order by date_seen, md5(source_url)) - 1 as pos,
cast(floor((select count(*) from t) * 0.8) as bigint) as cut from t where date_seen is not null)"""

_RAMPS = list(zip(model.RAMP_EDGES, model.RAMP_EDGES[1:]))
_NUMBERS = {
    "intercept": "1e0",
    **{k: v for m in model.MEASURES for k, v in ((m, f"coalesce({m}, 0e0)"), (f"{m}_missing", f"case when {m} is null then 1e0 else 0e0 end"))},
    **{f"carat_ramp_{a}_{b}": f"least(greatest((carat - {a}e0) / {b - a}e0, 0e0), 1e0)" for a, b in _RAMPS},
    "carat_ln": "ln(carat)",
}
_TERMS = _NUMBERS | {"log_price": "log_price"}


def _level(grade: str) -> str:
    return f"'{grade}=' || coalesce({grade}, '<MISSING>')"


def _unpivoted(group: str, sums: dict[tuple[str, str], str]) -> str:
    """One row for every pair of terms of a grouped select."""
    rows = ", ".join(f"{{'l': {left}, 'r': {right}, 'v': {value}}}" for (left, right), value in sums.items())
    return f"select vendor, unnest([{rows}]) as c from t group by vendor{group}"


_TERM_LIST = list(_TERMS.items())
_GRAM_PARTS = [
    _unpivoted("", {(f"'{a}'", f"'{b}'"): f"sum(({x}) * ({y}))" for n, (a, x) in enumerate(_TERM_LIST) for b, y in _TERM_LIST[n:]})
]
for _n, _g in enumerate(features.CATEGORICAL):
    _beside = {("'intercept'", _level(_g)): "count(*) * 1e0", (_level(_g), _level(_g)): "count(*) * 1e0"}
    _beside |= {(_level(_g), f"'{b}'"): f"sum({y})" for b, y in _TERM_LIST[1:]}
    _GRAM_PARTS.append(_unpivoted(f", {_g}", _beside))
    for _h in features.CATEGORICAL[_n + 1 :]:
        _GRAM_PARTS.append(_unpivoted(f", {_g}, {_h}", {(_level(_g), _level(_h)): "count(*) * 1e0"}))
_GRAM = f"""select vendor, c.l as left_term, c.r as right_term, round(c.v + {NUDGE}, 2) as value
from ({" union all ".join(_GRAM_PARTS)}) where round(c.v + {NUDGE}, 2) <> 0"""


def _predicted(shift: str = "0e0") -> str:
    """The stored model in SQL; ``shift`` moves the intercept."""
    grades = [f"((length({_level(g)}) * 7) % 11 - 5) / 100e0" for g in features.CATEGORICAL]
    numbers = [f"({x}) * {stored_coefficient(name)!r}e0" for name, x in _NUMBERS.items()]
    return " + ".join([*numbers, shift, *grades])


#: Rows with what the stored models and the baselines of the others predict, per fold; every vendor is a fold.
_CV = f"""{_LOG_ROWS}, f as (select vendor, row_number() over (order by count(*) desc, vendor) - 1 as fold from t group by vendor),
g as (select distinct vendor as v from t),
m as (select g.v, t.carat_bucket, t.intensity, median(t.log_price) as m from g join t on t.vendor <> g.v group by all),
o as (select g.v, median(t.log_price) as m from g join t on t.vendor <> g.v group by all),
d as (select t.*, f.fold, {_predicted("f.fold / 50e0")} as pred, {_predicted("length(t.vendor) / 50e0")} as vendor_pred from t join f on f.vendor = t.vendor),
e as (select d.*, coalesce(m.m, o.m) as base from d join o on o.v = d.vendor
left join m on m.v = d.vendor and m.carat_bucket = d.carat_bucket and m.intensity = d.intensity)"""
#: The model of the others, trained for every vendor: the scaled cross products of all other vendors are swept column by column,
#: first those of any sign, then of those that may not be negative the first one that is negative or still lowers the error, until none is left.
_TRAINED_CV = f"""{_LOG_ROWS.replace("with", "with recursive", 1)},
cells as (select vendor, c.l as l, c.r as r, sum(c.v) as v from ({" union all ".join(_GRAM_PARTS)}) group by all),
g as (select distinct vendor as v from t),
kept as (select g.v as held, l, r, sum(cells.v) as x from g join cells on cells.vendor <> g.v group by all),
sums as (select held, l, r, x from kept union all select held, r, l, x from kept where l <> r),
places as (select name, starts_with(name, 'carat_') as bound, row_number() over (order by starts_with(name, 'carat_'), name) as i
from (select distinct r as name from kept where r <> 'log_price')),
size as (select count(*) as p, count(*) filter (not bound) as free from places),
scales as (select held, l as name, sqrt(x / max(x) filter (l = 'intercept') over (partition by held)) as s,
max(x) filter (l = 'intercept') over (partition by held) as n from sums where l = r and l <> 'log_price'),
dense as (select a.held, pa.i, pb.i as j, coalesce(x.x / a.n / nullif(a.s * b.s, 0), 0) * case when pa.i = pb.i and a.name <> 'intercept' then 1 + {model.RIDGE!r}e0 else 1e0 end as x
from scales a join scales b on b.held = a.held join places pa on pa.name = a.name join places pb on pb.name = b.name
left join sums x on x.held = a.held and x.l = a.name and x.r = b.name
union all select a.held, pa.i, p + 1, coalesce(x.x / a.n / nullif(a.s, 0), 0) from scales a join places pa on pa.name = a.name cross join size
left join sums x on x.held = a.held and x.l = a.name and x.r = 'log_price'),
filled as (select g.v as held, a.i, b.j, coalesce(d.x, 0e0) as x from g cross join places a cross join (select unnest(range(1, p + 2)) as j from size) b
left join dense d on d.held = g.v and d.i = a.i and d.j = b.j),
fit as (select held, i, 0 as done, list(x order by j) as m from filled group by held, i
union all select f.held, f.i, f.done + 1, case when k.m[k.i] = 0 then f.m
when f.i = k.i then list_transform(f.m, lambda x, j: case when j = k.i then -1 / x else x / abs(k.m[k.i]) end)
else list_transform(list_zip(f.m, k.m), lambda z, j: case when j = k.i then z[1] / abs(k.m[k.i]) else z[1] - f.m[k.i] * z[2] / k.m[k.i] end) end
from fit f join (select held, min(i) as i, arg_min(m, i) as m from (select fit.*, free, p from fit cross join size)
where case when done < free then i = done + 1 else i > free and sign(m[i]) * m[p + 1] > 1e-10 end group by held) k on k.held = f.held),
beta as (select f.held, map_from_entries(list({{'k': places.name, 'v': case when f.m[f.i] < 0 then f.m[p + 1] / s else 0e0 end}})) as coefs
from (select held, i, arg_max(m, done) as m from fit group by held, i) f join places on places.i = f.i
join scales on scales.held = f.held and scales.name = places.name cross join size group by f.held),
f as (select vendor, row_number() over (order by count(*) desc, vendor) - 1 as fold from t group by vendor),
m as (select g.v, t.carat_bucket, t.intensity, median(t.log_price) as m from g join t on t.vendor <> g.v group by all),
o as (select g.v, median(t.log_price) as m from g join t on t.vendor <> g.v group by all),
d as (select t.*, f.fold, {" + ".join([f"coalesce(coefs['{n}'], 0e0) * ({x})" for n, x in _NUMBERS.items()] + [f"coalesce(coefs[{_level(g)}], 0e0)" for g in features.CATEGORICAL])} as pred
from t join f on f.vendor = t.vendor join beta on beta.held = t.vendor),
e as (select d.*, coalesce(m.m, o.m) as base from d join o on o.v = d.vendor
left join m on m.v = d.vendor and m.carat_bucket = d.carat_bucket and m.intensity = d.intensity)"""
_FOLDS = """select fold, count(*) as rows, avg(abs(log_price - pred)) as mae_log,
1 - sum((log_price - pred) ** 2) / (var_pop(log_price) * count(*)) as r2, avg(abs(log_price - base)) as baseline_mae_log from e group by fold"""
_CONTRIBUTIONS = " union all ".join(
    [f"select {_level(g)} as feature, abs(((length({_level(g)}) * 7) % 11 - 5) / 100e0) * 2 * (count(*) / n) * (1 - count(*) / n) as size from t, s group by {g}, n" for g in features.CATEGORICAL]
    + [f"select '{name}', {abs(stored_coefficient(name))!r}e0 * avg(abs(({x}) - (select avg({x}) from t))) from t" for name, x in _NUMBERS.items() if name != "intercept"]
)

_SPARSE = " + ".join(f"({c} is null)::int" for c in features.SPARSE_FIELDS)

_PAGE_TEXT = """regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g')"""

ORACLES: dict[str, str] = {
    "normalize_listings": f"{_N} select {_CANON} from n",
    "import_feed_vendor_fill": f"""{_R} select source_url,
        case when table_pct in (51, 52) then 'partner' else vendor end as vendor from r""",
    "listing_keys": f"""{_N} select source_url, case when length({_DIGITS}) between 6 and 12 then {_DIGITS} else '' end as certificate,
        case when length({_DIGITS}) between 6 and 12 then 'CERT:' || coalesce(cert_lab, 'UNK') || ':' || {_DIGITS}
        when trim(sku_or_stock) <> '' then 'SKU:' || vendor || ':' || trim(sku_or_stock)
        else 'URL:' || vendor || ':' || source_url end as listing_key from n""",
    "dedupe_keys": f"""{_N} select source_url, k0 as key_certificate, k1 as key_carat_step, k2 as key_length_step,
        k3 as key_width_step, k4 as key_depth_step, k5 as key_intensity, k6 as key_clarity, k7 as key_shape
        from (select *, {_KEYS} from n)""",
    "dedupe_listings": f"""{_N} select {_CANON} from (select *, {_LATEST} as rn from (select *, {_KEYS} from n)) where rn = 1""",
    "dedupe_keep_incomplete": f"""{_N} select source_url, cast(date_seen as varchar) as date_seen, carat, length_mm from (select *, {_LATEST} as rn from (select *, {_KEYS} from n))
        where rn = 1 or (k0 is null and (carat is null or length_mm is null or width_mm is null or depth_mm is null))""",
    "quality_report": f"""{_N} select cast(count(*) as bigint) as row_count,
        {", ".join(f"round(count({c}) / count(*), 6) as {c}" for c in quality.REQUIRED)},
        round(count(case when price_usd is not null and carat is not null then 1 end) / count(*), 6) as joint_parse_rate,
        cast(count(*) - count(price_usd) as bigint) as missing_price_rows,
        cast(count(*) - count(carat) as bigint) as missing_carat_rows,
        cast(count(distinct coalesce(vendor, 'Unknown')) as bigint) as vendors from n""",
    "vendor_counts": f"{_N} select coalesce(vendor, 'Unknown') as vendor, cast(count(*) as bigint) as rows from n group by 1",
    "feed_summary": f"""{_N} select feed, {_MEASURES} from n group by feed union all
        select 'import:' || lower(r_name), 0, 0.0, 0.0, 0.0, 0.0 from region""",
    "batch_summary": f"{_N} select {_MEASURES} from n",
    "weighted_quality": f"""{_N} select cast(count(*) as bigint) as rows,
        round(avg(case when trim(cert_number) <> '' then 1.0 else 0.0 end), 6) as weighted_cert_present_rate,
        round((count(price_usd) + count(carat)) / 2 / count(*), 6) as weighted_parse_success_rate from n""",
    "active_vendors": f"{_N} select cast(count(distinct nullif(trim(vendor), '')) as bigint) as active_vendor_count from n",
    "dominant_vendor": f"""{_N} select arg_min(vendor, (-c, vendor)) as dominant_vendor, round(max(c) / sum(c), 6) as dominant_vendor_share
        from (select vendor, count(*) as c from n group by vendor)""",
    "run_growth": f"{_H} {_GROWTH}",
    "run_expansion": f"{_H} {_EXPANSION_OUT}",
    "latest_run_growth": f"{_H} select * from ({_GROWTH}) order by run_id desc limit 1",
    "latest_run_expansion": f"{_H} select * from ({_EXPANSION_OUT}) order by run_id desc limit 1",
    "run_diversity": f"""{_H} select run_id, current_rows, active_vendor_count, dominant_vendor, round(share, 6) as dominant_vendor_share,
        round(cert_rate, 6) as weighted_cert_present_rate, round(parse_rate, 6) as weighted_parse_success_rate from ({_DIVERSITY})""",
    "gate_status": f"""{_H} select run_id, case when not grew then 'failed_growth_gate' when not c1 then 'failed_source_gate'
        when not (c2 and c3) then 'failed_coverage_gate' when not (c1 and c2 and c3 and c4 and c5 and c6) then 'failed_phase12_exit_gate'
        else 'ok' end as status from ({_JUDGED})""",
    "exit_checks": f"""{_H} select run_id, c1 and c2 and c3 and c4 and c5 and c6 as ready, c1 as min_active_vendors,
        c2 as min_listing_coverage_multiple, c3 as min_cert_coverage_multiple, c4 as max_dominant_vendor_share,
        c5 as min_weighted_cert_present_rate, c6 as min_weighted_parse_success_rate from ({_JUDGED})""",
    "phase_progress": f"{_H} select run_id, c1 as sources_ready, c2 and c3 as coverage_ready from ({_JUDGED})",
    "source_policy": """select cast(count(*) as bigint) as known_sources,
        cast(count(case when s_acctbal > 0 then 1 end) as bigint) as active_sources, cast(3 as bigint) as required_sources,
        count(case when s_acctbal > 0 then 1 end) >= 3 as passes from supplier""",
    "run_ids": "select strftime(ts, '%Y%m%dT%H%M%SZ') as run_id, cast(count(*) as bigint) as rows from events group by 1",
    "mispriced": f"""{_H} select listing_key, feed, vendor, source_url, round(price_usd, 6) as price_usd, cert_number,
        cast(cast(scraped_at as date) as varchar) as scraped_at, run_id, count, round(median, 6) as median, round(std, 6) as std,
        round(z, 6) as z_score, round(fall, 6) as drop_pct_vs_median, coalesce(abs(z) >= 2.5, false) as is_mispriced,
        coalesce(fall >= 0.2, false) as is_potentially_undervalued from ({_MISPRICED})""",
    "price_stats": f"""{_H} select listing_key, cast(count(*) as bigint) as count, round(stddev_samp(price_usd), 6) as std,
        round(median(price_usd), 6) as median from h group by listing_key""",
    "mispriced_ranking": f"""{_H} select cast(row_number() over (order by coalesce(fall >= 0.2, false) desc, z asc nulls last, listing_key) as bigint) as rank,
        listing_key from ({_MISPRICED}) qualify rank <= 100""",
    "flag_counts": f"""{_H} select cast(count(*) as bigint) as examined, cast(count(case when abs(z) >= 2.5 then 1 end) as bigint) as mispriced,
        cast(count(case when fall >= 0.2 then 1 end) as bigint) as undervalued from ({_MISPRICED})""",
    "title_parse_table": f"""{_R} select source_url, {_groups("title", _TABLE_RE, ["lab", "carat", "intensity", "color", "clarity", "shape"])}
        from (select source_url, {_TABLE_TITLE} as title from r)""",
    "title_parse_label": f"""{_R} select source_url, {_groups("title", _LABEL_RE, ["carat", "intensity", "shape", "clarity", "lab"])}
        from (select source_url, {_LABEL_TITLE} as title from r)""",
    "spec_parse_table": f"""{_R} select source_url, nullif(sku_or_stock, '') as stock, shape, trim(clarity) as clarity,
        cast(carat as varchar) as carat, polish, cast(table_pct as varchar) as table_pct, {_SIZE} || ' mm' as measurements,
        cast(5 + (sku_or_stock <> '')::int + (carat is not null)::int as bigint) as parsed_keys from r""",
    "spec_parse_label": f"""{_R} select source_url, coalesce(cast(carat as varchar), '0') as carat, shape, vendor as color,
        cast(null as varchar) as modifier, cast(table_pct as varchar) as table_pct, {_SIZE} as measurements,
        cast(5 as bigint) as parsed_keys from r""",
    "spec_parse_wrapped": f"""{_R} select source_url, coalesce(cast(carat as varchar), '0') as carat, shape, cast(table_pct as varchar) as table_pct,
        cast(null as varchar) as depth_pct, case when table_pct > 53 then null else 'thin' end as girdle, polish from r""",
    "measurements": f"""{_R} select source_url, case when {_MEASURED} then width_mm end as length_mm,
        case when {_MEASURED} then depth_mm end as width_mm, case when {_MEASURED} then table_pct end as depth_mm,
        case when {_MEASURED} then {_ROUND3.format("width_mm", "depth_mm")} end as l_w_ratio from r""",
    "modifier_words": f"""{_R} select source_url, word, case when lower(word) in ('no overtone', 'none', 'n/a') then '' else word end as modifier
        from (select source_url, (['No Overtone', 'none', 'N/A', 'Brownish', ' None ', 'no  overtone', ''])[1 + cast(table_pct as int) % 7] as word from r)""",
    "price_text": f"{_R} select source_url, floor(price_usd) as price_usd from r",
    "url_keys": f"""{_R}, u as (select source_url from r union all select url from pages)
        select source_url, case when contains(source_url, '/products/') then split_part(source_url, '/products/', 2) else 'lb_' end as slug,
        coalesce(nullif(regexp_extract(regexp_extract(source_url, '[^/]*$'), '([0-9]+)', 1), ''), 'bn_') as stock from u""",
    "page_links": f"select distinct page_id, href from ({_ANCHORS}) where contains(href, '/') and regexp_matches(text, '(?i)e')",
    "page_links_absolute": f"""select distinct page_id, case when starts_with(href, '//') then regexp_extract(url, '^([a-z]+:)', 1) || href
        when starts_with(href, '/') then regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href else href end as href
        from ({_ANCHORS}) where contains(href, '/') and regexp_matches(text, '(?i)th')""",
    "page_headings": f"""select page_id, trim(replace(replace(replace({_PAGE_TEXT}, '&copy;', '©'), '&quot;', '"'), '&amp;', '&')) as text
        from pages where regexp_matches(html, '(?s)<h1>.*?</h1>')""",
    "page_block_counts": """select page_id, cast(len(regexp_extract_all(regexp_replace(html, '(?s)<script.*?</script>|<!--.*?-->', '', 'g'),
        '<p[ >]')) as bigint) as blocks from pages where regexp_matches(html, '<p[ >]')""",
    "page_blocks": """with v as (select page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '', 'g') as page from pages),
        b as (select page_id, unnest(regexp_extract_all(regexp_replace(page, '(?i)(</?(?:address|article|aside|blockquote|body|details|div|dl|fieldset|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)[\\s/>])', chr(1) || '\\1', 'g') || chr(1),
        '(?is)<p(?:\\s[^>]*)?>([^\\x01]*)\\x01', 1)) as content from v),
        t as (select page_id, replace(replace(replace(replace(replace(regexp_replace(content, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&amp;', '&') as text from b)
        select page_id, cast(count(*) as bigint) as blocks, cast(sum(length(regexp_replace(text, '^[\\s\\xa0]+|[\\s\\xa0]+$', '', 'g'))) as bigint) as characters from t group by page_id""",
    "first_links": f"""select href, max(page_id) as page_id from ({_ANCHORS}) where contains(href, '/') and regexp_matches(text, '(?i)[a-z]')
        group by href order by href limit 50""",
    "page_sequence": f"{_sequence('(?i)ch')} select * from kept",
    "page_sequence_limited": f"""{_sequence('(?i)[a-z]')}, seen as (select site, href, min(page_no) as page from links group by all),
        nth as (select site, page, row_number() over (partition by site order by page, href) as nth from seen),
        last as (select site, page from nth where nth = 20)
        select kept.site, kept.page_no from kept left join last on kept.site = last.site where last.page is null or page_no <= last.page""",
    "card_frontier": f"""{_R}, c as (select source_url as href, trim({_TABLE_TITLE}) as title,
        concat('$', coalesce(cast(cast(floor(price_usd) as bigint) as varchar), 'call')) as price from r)
        select href, title, price from (select *, row_number() over (partition by href order by title desc, price desc) as rn from c) where rn = 1""",
    "assembled_table": _R + " " + _ASSEMBLED_TABLE,
    "assembled_label": _R + " " + _ASSEMBLED_LABEL,
    "extraction_log": f"""{_R} select vendor, sku_or_stock as listing_key, source_url,
        coalesce(price_usd <> 0 and carat <> 0, false) as parse_ok, {_PARSED_FIELDS} as parsed_fields from ({_ASSEMBLED_TABLE})""",
    "model_features": f"""{_LOG_ROWS} select vendor, source_url, cast(date_seen as varchar) as date_seen,
        {", ".join(f"coalesce({c}, '<MISSING>') as {c}" for c in features.CATEGORICAL)},
        {"carat, length_mm, width_mm, depth_mm, table_pct, depth_pct, l_w_ratio"},
        carat * carat as carat_sq,
        {", ".join(f"greatest(carat - {k}::double, 0) as carat_over_{str(k).replace('.', '_')}" for k in features.KNOTS)},
        round(log_price, 6) as log_price from t""",
    "model_row_counts": f"""with {_standard("p", _PRICED)} select cast(count(*) as bigint) as rows,
        cast(count(case when is_lab_grown then 1 end) as bigint) as lab_grown,
        cast(count(case when is_lab_grown is distinct from true and (price_usd is null or carat is null) then 1 end) as bigint) as without_price_or_carat,
        cast(count(case when is_lab_grown is distinct from true and (price_usd <= 0 or carat <= 0) and price_usd is not null
        and carat is not null then 1 end) as bigint) as not_positive,
        cast(count(case when is_lab_grown is distinct from true and price_usd > 0 and carat > 0 then 1 end) as bigint) as usable from p""",
    "feature_contract": f"""{_LOG_ROWS}, l as ({" union ".join(f"select '{c}=' || coalesce({c}, '<MISSING>') as feature from t" for c in features.CATEGORICAL)})
        select feature, false as monotone from l union all select 'intercept', false union all
        select unnest([{", ".join(f"'{m}', '{m}_missing'" for m in model.MEASURES)}]), false union all
        select unnest([{", ".join(f"'carat_ramp_{a}_{b}'" for a, b in zip(model.RAMP_EDGES, model.RAMP_EDGES[1:]))}, 'carat_ln']), true""",
    "model_contract": f"""{_LOG_ROWS}, l as ({" union all ".join(f"select distinct {k} as g, coalesce({c}, '<MISSING>') as level, {_level(c)} as feature from t" for k, c in enumerate(features.CATEGORICAL))}),
        n as (select unnest([{", ".join(f"'{n}'" for n in list(_NUMBERS)[1:])}]) as feature, unnest(range({len(_NUMBERS) - 1})) as k),
        c as (select 'intercept' as feature, 0 as position union all select feature, row_number() over (order by g, level) from l
        union all select feature, (select count(*) from l) + 1 + k from n)
        select feature, cast(position as bigint) as position, starts_with(feature, 'carat_') as monotone, true as not_negative,
        true as stationary, true as complementary from c""",
    "encoded_levels": f"""{_LOG_ROWS}, l as ({" union all ".join(f"select '{c}' as feature, coalesce({c}, '<MISSING>') as level from t" for c in features.CATEGORICAL)}),
        c as (select feature, level, cast(count(*) as bigint) as rows from l group by all)
        select feature, level, rows, cast(row_number() over (partition by feature order by level) as bigint) as code from c""",
    "category_levels": _N
    + " "
    + " union ".join(f"select '{c}' as feature, coalesce({c}, '<MISSING>') as level from n" for c in features.CATEGORICAL),
    "vendor_folds": f"""{_LOG_ROWS} select vendor, cast(row_number() over (order by count(*) desc, vendor) - 1 as bigint) as fold
        from t group by vendor""",
    "group_count": f"{_LOG_ROWS} select cast(count(distinct coalesce(vendor, 'Unknown')) as bigint) as n_groups from t",
    "bucket_medians": f"""{_LOG_ROWS} select round(carat_bucket, 6) as carat_bucket, intensity, round(median(log_price), 6) as bucket_median
        from t group by carat_bucket, intensity""",
    "baseline_cv": _left_out_error().format(rows="rows"),
    "vendor_holdout_baseline": _left_out_error().format(rows="test_rows"),
    "time_holdout_split": f"""{_SPLIT} select pos >= cut as is_late, cast(count(*) as bigint) as rows,
        cast(min(date_seen) as varchar) as first_date, cast(max(date_seen) as varchar) as last_date,
        min(source_url) as first_url from s group by 1""",
    "time_holdout_baseline": f"""{_SPLIT}, e as (select * from s where pos < cut), l as (select * from s where pos >= cut),
        m as (select carat_bucket, intensity, median(log_price) as m from e group by all)
        select cast(min(date_seen) as varchar) as cutoff_date, cast(count(*) as bigint) as test_rows,
        round(avg(abs(log_price - coalesce(m, (select median(log_price) from e)))), 6) as baseline_mae_log
        from l left join m using (carat_bucket, intensity)""",
    "gram_matrix": f"{_LOG_ROWS} {_GRAM}",
    "training_gates": f"""{_CV}, x as (select 'quality' as gate, count(case when price_usd is not null and carat is not null then 1 end) / count(*) as value, 0.9 as minimum from p
        union all select 'model', avg(baseline_mae_log) - avg(mae_log), 0.0 from ({_FOLDS}))
        select gate, round(value, 6) as value, cast(minimum as double) as minimum, value >= minimum as passes from x""",
    "cv_metrics": f"""{_TRAINED_CV} select cast(fold as bigint) as fold, cast(rows as bigint) as rows, round(mae_log, 6) as mae_log, round(r2, 6) as r2,
        round(baseline_mae_log, 6) as baseline_mae_log from ({_FOLDS})""",
    "cv_summary": f"""{_CV} select round(avg(mae_log), 6) as cv_mae_log_mean, round(avg(r2), 6) as cv_r2_mean,
        round(avg(baseline_mae_log), 6) as baseline_cv_mae_log_mean, round(avg(baseline_mae_log) - avg(mae_log), 6) as cv_mae_improvement_vs_baseline,
        'ok' as status from ({_FOLDS})""",
    "vendor_holdout": f"""{_TRAINED_CV} select vendor, cast(count(*) as bigint) as test_rows, round(avg(abs(log_price - pred)), 6) as model_mae_log,
        round(avg(abs(log_price - base)), 6) as baseline_mae_log from e group by vendor
        having count(*) >= {splits.MIN_VENDOR_TEST_ROWS} and (select count(*) from e) - count(*) >= {splits.MIN_VENDOR_TRAIN_ROWS}""",
    "time_holdout": f"""{_SPLIT}, e as (select * from s where pos < cut), l as (select * from s where pos >= cut),
        m as (select carat_bucket, intensity, median(log_price) as m from e group by all)
        select cast(min(date_seen) as varchar) as cutoff_date, cast(count(*) as bigint) as test_rows,
        round(avg(abs(log_price - coalesce(m, (select median(log_price) from e)))), 6) as baseline_mae_log,
        round(avg(abs(log_price - ({_predicted("0.05e0")}))), 6) as model_mae_log
        from l left join m using (carat_bucket, intensity)""",
    "attribution": f"""{_LOG_ROWS}, s as (select count(*) as n from t), c as ({_CONTRIBUTIONS})
        select feature, round(size, 6) as mean_abs_contribution, row_number() over (order by round(size, 12) desc, feature) as rank from c""",
    "metrics_record": f"""{_CV} select cast((select count(*) from t) as bigint) as n_samples, cast(count(*) as bigint) as n_groups,
        cast((select {" + ".join(f"count(distinct coalesce({c}, ''))" for c in features.CATEGORICAL)} from t) + {len(_NUMBERS)} as bigint) as feature_count,
        'ok' as status, round(avg(baseline_mae_log) - avg(mae_log), 6) as cv_mae_improvement_vs_baseline,
        (select string_agg(vendor, ',' order by vendor) from f) as vendors,
        (select cast(date_seen as varchar) from (select date_seen, row_number() over (order by date_seen) - 1 as pos from t where date_seen is not null)
        where pos = cast(floor((select count(*) from t) * 0.8) as bigint)) as cutoff_date from ({_FOLDS})""",
    "scored": f"""{_CV}, b as (select quantile_cont(abs(log_price - pred), 0.9) as high from e),
        r as (select source_url, cast({_SPARSE} as bigint) as missing_count, ({_SPARSE}) >= 4 as reject,
        case when ({_SPARSE}) < 4 and carat > 0 then {_predicted()} end as pred from p)
        select source_url, missing_count, reject, round(exp(pred), 2) as predicted_price, round(exp(pred - high), 2) as price_low,
        round(exp(pred + high), 2) as price_high from r, b""",
    "reject_rule": f"""with {_standard("p", _PRICED)} select source_url, cast({_SPARSE} as bigint) as missing_count, ({_SPARSE}) >= 4 as reject from p""",
    "uncertainty_policy": f"""{_CV}, x as (select abs(log_price - pred) as e from e)
        select cast(4 as bigint) as reject_missing, round((select quantile_cont(e, 0.9) from x), 6) as high_error,
        round((select quantile_cont(e, 0.75) from x), 6) as medium_error,
        round((select quantile_cont(cast({_SPARSE} as double), 0.5) from t), 6) as missing_p50,
        round((select quantile_cont(cast({_SPARSE} as double), 0.9) from t), 6) as missing_p90""",
    "csv_scan": f"""{_N} select * replace ({", ".join(f"nullif({c}, '') as {c}" for c in _BLANK)}) from (select {_CANON} from n)""",
    "csv_quoted_breaks": f"""{_R} select source_url, carat, nullif(([concat('thin', chr(10), 'to "thick"'), 'a, b', concat('x', chr(10), chr(10), 'y'), 'plain', '"'])[1 + cast(table_pct as int) % 5], '') as girdle,
        cast(null as varchar) as culet, cert_number from r""",
    "merged_inputs": f"""{_N} select * replace (case when cast(right(split_part(table_pct::varchar, '.', 1), 1) as int) % 2 = 1 then null else culet end as culet,
        {", ".join(f"case when cast(right(split_part(table_pct::varchar, '.', 1), 1) as int) % 2 = 1 then nullif({c}, '') else {c} end as {c}" for c in _BLANK if c != "culet")})
        from (select {_CANON} from n)""",
    "run_feeds": """with c as (select lower(r_name) as feed, r_name as vendor, cast(count(*) as bigint) as rows from lineitem join orders on l_orderkey = o_orderkey
        join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by all)
        select feed, 'read' as status, rows, vendor as first_vendor from c where feed in ('africa', 'asia', 'europe')
        union all select 'import:partner', 'read', rows, 'partner' from c where feed = 'america'
        union all values ('placeholder', 'empty', 0, null), ('absent', 'absent', 0, null), ('table', 'unsupported', 0, null), ('import:nobody', 'absent', 0, null)""",
    "harvest_batch": _R + " " + _ASSEMBLED_TABLE,
    "harvest_log": f"""{_R} select vendor, sku_or_stock as listing_key, source_url,
        coalesce(price_usd <> 0 and carat <> 0, false) as parse_ok, {_PARSED_FIELDS} as parsed_fields from ({_ASSEMBLED_TABLE})""",
    "harvest_counts": f"""{_R} select 'table' as feed, {_MEASURES}, cast(count(case when price_usd <> 0 and carat <> 0 then 1 end) as bigint) as parsed
        from ({_ASSEMBLED_TABLE}) union all select 'placeholder', 0, 0.0, 0.0, 0.0, 0.0, 0""",
    "import_scan": f"""{_R} select case when table_pct = 51 then 'partner' else vendor end as vendor, cast(count(*) as bigint) as rows from r group by 1""",
    "anomaly_report": f"""{_H} select vendor, listing_key, round(price_usd, 6) as price_usd, round(median, 6) as median, round(z, 6) as z_score,
        coalesce(fall >= 0.2, false) as is_potentially_undervalued from ({_MISPRICED})""",
    "json_scan": f"{_N} select {_CANON} from n",
    "history_roundtrip": f"{_H} {_GROWTH}",
    "history_stream": f"{_H} {_GROWTH}",
    "history_rerun_empty": f"{_H} select run_id, count(*) as rows from h where run_id <> '{RERUN}' group by run_id",
    "history_batch_then_stream": f"{_H} select run_id, count(*) as rows from h group by run_id",
    "merge_clean": f"""{_N} select cast((select count(*) from n) as bigint) as rows_read, cast(count(*) as bigint) as rows_kept,
        cast(count(*) as bigint) as row_count,
        round(count(case when price_usd is not null and carat is not null then 1 end) / count(*), 6) as joint_parse_rate,
        round(count(carat) / count(*), 6) as carat from (select *, {_LATEST} as rn from (select *, {_KEYS} from n)) where rn = 1""",
    "run_summary": f"""{_N}, k as (select *, case when length({_DIGITS}) between 6 and 12 then 'CERT:' || coalesce(cert_lab, 'UNK') || ':' || {_DIGITS}
        when trim(sku_or_stock) <> '' then 'SKU:' || vendor || ':' || trim(sku_or_stock) else 'URL:' || vendor || ':' || source_url end as listing_key from n)
        select '20240201T000000Z' as run_id, cast(count(*) as bigint) as batch_rows, cast(count(*) as bigint) as history_rows,
        cast((select count(*) from (select listing_key from k where price_usd is not null group by 1 having count(*) >= 5)) as bigint) as examined,
        cast(count(*) as bigint) as delta_rows, cast(count(distinct vendor) as bigint) as active_vendor_count,
        (select arg_min(vendor, (-c, vendor)) from (select vendor, count(*) as c from k group by vendor)) as dominant_vendor,
        'ok' as status from k""",
}

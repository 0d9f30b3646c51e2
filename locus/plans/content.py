"""Page queries over pages that carry content of our own: (Spark, DuckDB SQL) under each name.

What a parser finds cannot be said in SQL; the SQL of these queries is a table of what each kind of page states.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import vendors as V
from ..functions.hours import week_column
from ..operators.listings import top_per
from ..sources.adapters import chosen, chosen_sql, literal, table

_ITEM = '{"@context":"https://schema.org","@graph":[{"@type":"Restaurant","name":"Maple Counter","address":{"@type":"PostalAddress","streetAddress":"410 Quarry Road","addressLocality":"Burlington","addressRegion":"Vermont","postalCode":"05401"},"geo":{"latitude":44.47,"longitude":-73.21},"openingHoursSpecification":[{"dayOfWeek":["Monday","Tuesday","Wednesday","Thursday"],"opens":"11:00","closes":"21:00"},{"dayOfWeek":"Friday","opens":"17:00","closes":"01:00"},{"dayOfWeek":"Sunday","opens":"10:00","closes":"14:00","validFrom":"2026-12-24"}]}]}'
_SCHEDULE = '{"schedule":[{"days":["monday","tuesday","wednesday"],"intervals":[{"startTime":"08:00","endTime":"15:00"}]},{"days":["saturday"],"intervals":[{"startTime":"09:00","endTime":"13:00"},{"startTime":"12:30","endTime":"16:00"}]}]}'
_CARD = '<div class="card"><h3>{}</h3><p>{}</p></div>'
#: One page for each thing that pages state; a page of the driver's table carries the one of its number.
_PAGES = [
    f'<html><head><title>Maple Counter | Burlington</title><script type="application/ld+json">{_ITEM}</script></head><body><p>Welcome in</p></body></html>',
    '<html><head><meta property="og:site_name" content="Birch Room"></head><body><time itemprop="openingHours" datetime="Mo-Fr 07:30-14:00"></time><p>Visit 77 Orchard Avenue, Suite 4, Concord, NH 03301 today</p><p>Soon: 9 Depot St, Keene, New Hampshire 03431 coming soon</p></body></html>',
    f'<html><body><script>window.x = {_SCHEDULE}</script><p>After ten years we have permanently closed our doors. Thank you all.</p></body></html>',
    "<html><body><p>Hours: Tuesday to Thursday 12pm - 9pm, Fri & Sat noon-11pm, closed Sunday and Monday</p><p>The old room is permanently closed while we renovate; we reopen in May.</p></body></html>",
    "<html><head><style>p {color: red}</style></head><body><h1>cedarbowl.example</h1><p>This domain may be for sale. Buy this domain now.</p></body></html>",
    "<html><body><nav><h2>Ramen everywhere</h2></nav><main>" + _CARD.format("KIRI COUNTER", "Slow broths and hand-cut ramen, daily.") + _CARD.format("Taco Stand", "Corn tortillas.") + _CARD.format("Yuki — Noodles", "Ramen, coming soon") + _CARD.format("Ramen Cup 3 pack", "For your pantry") + "</main></body></html>",
    "<html><body><h2>Our updates</h2><p>Special: cold noodles with plum https://x.example/a</p><p>Closed: Nov 26 - Dec 1</p><p>Hours: Tue-Sun 5pm-10pm</p><p>Come by!</p><p>Note: never read</p></body></html>",
    '<html><body><p>Find us at 1200 N Harbor Blvd, Portland, ME 04101.</p><a href="https://maps.example/?q=43.6612,-70.2551">Map</a><a href="/menu">Menu</a></body></html>',
    "<html><body><div>Stall nine</div><div>Long-simmered ramen with greens from the valley</div><div>Sweet Things</div><div>Cakes and pies of many kinds, made each morning</div></body></html>",
    "",
    "<urlset><url><loc>https://a.example/1</loc></url><url><loc> https://a.example/2 </loc></url><url><loc>https://a.example/1</loc></url></urlset>",
    '<html><head><title>Elm — a kitchen</title></head><body><a href="about">About <b>us</b></a><a href="//cdn.example/menu.pdf">Menu (PDF)</a><a href="#top"></a><p>code abc-123def</p></body></html>',
]
N = len(_PAGES)


def _pages(spark, d):
    return table(spark, d, "pages").select("page_id", chosen(F.col("page_id"), _PAGES).alias("html"))


def _stated(columns: str, rows: list[tuple], kinds: str) -> str:
    """SQL of the rows that each kind of page states: (kind of page, columns...)."""
    values = ", ".join("(" + ", ".join(literal(v) if not isinstance(v, bool) else str(v).lower() for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST({c} AS {k}) AS {c}" for c, k in zip(columns.split(", "), kinds.split(", "), strict=True))
    return f"WITH v(kind_of, {columns}) AS (VALUES {values}) SELECT page_id, {casts} FROM pages JOIN v ON page_id % {N} = kind_of"


_WEEKS = {
    0: ("[[[660,1260]],[[660,1260]],[[660,1260]],[[660,1260]],[[1020,1500]],[],[]]", "jsonld"),
    1: ("[[[450,840]],[[450,840]],[[450,840]],[[450,840]],[[450,840]],[],[]]", "microdata"),
    2: ("[[[480,900]],[[480,900]],[[480,900]],[],[],[[540,960]],[]]", "schedule"),
    3: ("[[],[[720,1260]],[[720,1260]],[[720,1260]],[[720,1380]],[[720,1380]],[]]", "text"),
    6: ("[[],[[1020,1320]],[[1020,1320]],[[1020,1320]],[[1020,1320]],[[1020,1320]],[[1020,1320]]]", "text"),
}


def page_hours(spark, d):
    """The week of hours that a page states, and where it was found."""
    found = _pages(spark, d).select("page_id", week_column(F.col("html")).alias("found"))
    return found.select("page_id", F.to_json("found.week").alias("week"), F.coalesce("found.how", F.lit("none")).alias("how"))


PAGE_HOURS = _stated("week, how", [(i, *_WEEKS.get(i, (None, "none"))) for i in range(N)], "VARCHAR, VARCHAR")


def page_locations(spark, d):
    """US addresses stated on pages, structured ones first; a lone map pin goes with a lone address."""
    return X.location_rows(_pages(spark, d), "page_id", "html")


PAGE_LOCATIONS = _stated(
    "pos, street, city, state, zip, soon, pin_lat, pin_lon",
    [(0, 0, "410 Quarry Road", "Burlington", "VT", "05401", False, None, None), (1, 0, "77 Orchard Avenue Suite 4", "Concord", "NH", "03301", False, None, None), (1, 1, "9 Depot St", "Keene", "NH", "03431", True, None, None), (7, 0, "1200 N Harbor Blvd", "Portland", "ME", "04101", False, 43.6612, -70.2551)],
    "INT, VARCHAR, VARCHAR, VARCHAR, VARCHAR, BOOLEAN, DOUBLE, DOUBLE",
)


def page_links(spark, d):
    """All links of pages, resolved against the page's address, with their labels."""
    pages = _pages(spark, d).withColumn("url", F.concat(F.lit("https://w.example/p"), (F.col("page_id") % 5).cast("string"), F.lit("/x")))
    return X.link_rows(pages, "page_id", "url", "html")


PAGE_LINKS = f"""WITH v(kind_of, pos, path, label) AS (VALUES (7, 0, 'https://maps.example/?q=43.6612,-70.2551', 'Map'), (7, 1, '/menu', 'Menu'), ({N - 1}, 0, 'about', 'About us'), ({N - 1}, 1, '//cdn.example/menu.pdf', 'Menu (PDF)'), ({N - 1}, 2, '#top', ''))
SELECT page_id, CAST(pos AS INT) AS pos, CASE WHEN starts_with(path, 'https') THEN path WHEN starts_with(path, '//') THEN 'https:' || path WHEN starts_with(path, '/') THEN 'https://w.example' || path WHEN starts_with(path, '#') THEN 'https://w.example/p' || CAST(page_id % 5 AS VARCHAR) || '/x' || path ELSE 'https://w.example/p' || CAST(page_id % 5 AS VARCHAR) || '/' || path END AS href, label FROM pages JOIN v ON page_id % {N} = kind_of"""


def page_state(spark, d):
    """Pages whose visible text says that a place has closed for good, or that the site is parked."""
    return _pages(spark, d).select("page_id", X.notices(F.col("html")).alias("n")).select("page_id", "n.closed", "n.parked")


PAGE_STATE = f"SELECT page_id, page_id % {N} = 2 AS closed, page_id % {N} = 4 AS parked FROM pages"


def page_updates(spark, d):
    """Owners' update lines, and the days that a closing line names."""
    rows = X.update_rows(_pages(spark, d), "page_id", "html", "updates")
    days = X.closed_range_column(F.when(F.col("kind") == "closed", F.col("text")), dt.date(2026, 11, 20))
    return rows.withColumn("days", days).select("page_id", "pos", "kind", "text", F.col("days.first").cast("string").alias("first"), F.col("days.last").cast("string").alias("last"))


PAGE_UPDATES = _stated("pos, kind, text, first, last", [(6, 0, "special", "cold noodles with plum", None, None), (6, 1, "closed", "Nov 26 - Dec 1", "2026-11-26", "2026-12-01"), (6, 2, "hours", "Tue-Sun 5pm-10pm", None, None)], "INT, VARCHAR, VARCHAR, VARCHAR, VARCHAR")


def page_vendors(spark, d):
    """Vendors of directory pages that offer the dish, from cards or from plain lines."""
    return V.vendor_rows(_pages(spark, d), "page_id", "html", "Field Hall", "(?<![a-z])ramen")


PAGE_VENDORS = _stated("name, about", [(5, "Kiri Counter", "KIRI COUNTER Slow broths and hand-cut ramen, daily."), (8, "Stall nine", "Long-simmered ramen with greens from the valley")], "VARCHAR, VARCHAR")


def page_titles(spark, d):
    """A page's name: its site's, or its title up to a separator; and the distinct addresses of a site map."""
    p = _pages(spark, d)
    return p.select("page_id", X.title_column(F.col("html")).alias("title"), F.array_join(X.sitemap_urls(F.col("html")), " ").alias("urls"))


PAGE_TITLES = _stated("title, urls", [(i, {0: "Maple Counter", 1: "Birch Room", 11: "Elm"}.get(i, ""), "https://a.example/1 https://a.example/2" if i == 10 else "") for i in range(N)], "VARCHAR, VARCHAR")


def domain_states(spark, d):
    """What new domains turned out to be, by reading their pages."""
    p = _pages(spark, d)
    read = p.select("page_id", "html", X.notices(F.col("html")).alias("n"))
    found = X.location_rows(p, "page_id", "html").groupBy("page_id").agg(F.count(F.lit(1)).alias("locations"), F.count_if(F.col("zip") != "04101").alias("located"))
    i, no = F.col("page_id"), F.lit(0)
    final = F.when(i % 5 == 1, "other.example").otherwise("w.example")
    status = X.domain_status(i % 7 != 0, F.lit("w.example"), final, i % 10 == 1, F.col("n.length") + F.when(i % 2 == 0, 300).otherwise(0), F.col("n.parked"), F.col("html").rlike("(?i)(?<![a-z])ramen|Quarry|Harbor|Orchard") | (i % N == 11), i % N == 11, F.coalesce("locations", no), F.coalesce("located", no))
    return read.join(found, "page_id", "left").select("page_id", status.alias("status"))


DOMAIN_STATES = f"""WITH p AS (SELECT page_id, page_id % {N} AS k, page_id % {N} IN (0, 1, 7) AS located, {chosen_sql('page_id', [10, 88, 64, 178, 65, 120, 125, 60, 120, 0, 58, 36])} AS n FROM pages)
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'unreachable' WHEN page_id % 5 = 1 AND page_id % 10 <> 1 THEN 'elsewhere' WHEN page_id % 2 = 1 AND NOT located THEN 'empty' WHEN k = 4 THEN 'parked' WHEN k NOT IN (0, 1, 5, 7, 8, 11) THEN 'not ramen' WHEN k = 11 THEN 'not a restaurant' WHEN k = 7 OR NOT located THEN 'no US address' ELSE 'ok' END AS status FROM p"""


def store_pages(spark, d):
    """Stores of a chain's directory, by the depth of their pages' paths."""
    i = F.col("c_custkey")
    url = F.concat(F.lit("https://l.example/shops/"), chosen(i, ["nc", "va"]), F.lit("/"), chosen(i, ["troy", "dover", "salem"]), chosen(i, ["/12-main-st", "", "/menu", "/7b-oak-rd"]))
    rows = table(spark, d, "customer").select(i.alias("id"), X.store_slugs(url, "https://l.example/shops", F.lit("nc")).alias("s"))
    return rows.where("s is not null").groupBy(F.col("s.city").alias("city"), F.col("s.slug").alias("slug")).agg(F.count(F.lit(1)).alias("n"))


STORE_PAGES = f"SELECT {chosen_sql('c_custkey', ['troy', 'dover', 'salem'])} AS city, CASE c_custkey % 4 WHEN 0 THEN '12-main-st' ELSE '7b-oak-rd' END AS slug, count(*) AS n FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 4 IN (0, 3) GROUP BY 1, 2"


def claim_pages(spark, d):
    """Pages that carry their claim's code, in their text or in a meta tag."""
    def held(html: pd.Series) -> pd.Series:
        return html.map(lambda h: X.has_code(h or "", "abc-123def", "place-verify"))

    body = F.when(F.col("page_id") % N == 3, F.lit('<meta name="place-verify" content="ABC-123def">')).when(F.col("page_id") % N == 4, F.lit("<script>abc-123def</script>")).otherwise(F.col("html"))
    return _pages(spark, d).select("page_id", F.pandas_udf(held, "boolean")(body).alias("held"))


CLAIM_PAGES = f"SELECT page_id, page_id % {N} IN (3, {N - 1}) AS held FROM pages"


def list_documents(spark, d):
    """Structured data of up to 50 spots of each city, as published."""
    from .listings import _cities

    c = _cities(spark, d)
    item = F.struct(F.lit("Restaurant").alias("@type"), F.col("name"), F.struct(F.lit("GeoCoordinates").alias("@type"), F.round("lat", 5).alias("latitude")).alias("geo"), F.when(F.col("host") != "", F.concat(F.lit("https://"), "host")).alias("url"))
    first = top_per(c, ["city"], ["id"], 50)
    return first.select("city", F.col("rank").alias("position"), F.get_json_object(F.to_json(item), "$.name").alias("name"), F.contains(F.to_json(item), F.lit('"url"')).alias("has_url"), F.get_json_object(F.to_json(item), "$.geo.latitude").cast("double").alias("latitude"))


def _list_documents_sql() -> str:
    from .listings import _CITIES

    return f"WITH {_CITIES} SELECT city, CAST(row_number() OVER (PARTITION BY city ORDER BY id) AS INT) AS position, name, host <> '' AS has_url, round(lat, 5) AS latitude FROM cities QUALIFY position <= 50"


LIST_DOCUMENTS = _list_documents_sql()

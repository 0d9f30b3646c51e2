"""Menu queries over pages that carry menus of our own: (Spark, DuckDB SQL) under each name."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.menu import BARE_HEADINGS, CLASSIC_BROTHS, OTHER_BROTHS, RE2, RULES, SPICY_FLAVOUR, TOPPING
from ..functions.text import lines as split_lines
from ..operators import menus as M
from ..sources.adapters import table

#: One menu for each arm of the rules; a page carries the one of its number.
_MENUS = [
    ("Kitsune House", "STARTERS\nPickled radish $4\nGyoza $7\nBOWLS\nTonkotsu Ramen $15\nShoyu Ramen $14\nSpicy Miso Ramen $15\nVegetable Ramen $13\nBlack Garlic Ramen $16\nTsukemen $15\nDRINKS\nGreen tea $3\nSake $9"),
    ("Corner Grill", "Cheese plate $9\nTomato soup $6\nSteak $24\nTrout $21\nMiso Ramen $14\nRamen with chicken thigh $13\nIce cream $5\nCoffee 3.50"),
    ("Lantern Bar", "Our bowl\nRamen\nyour choice of broth\ntonkotsu, shoyu or spicy miso\nFries 4.00"),
    ("Harbor Cafe", "Noodle soup: ramen\nshio or chicken broth\nSalmon $19"),
    ("Field Kitchen", "Miso Ramen\nchashu, nori and sweet corn in a long-cooked broth\nApple pie"),
    ("Oak Tavern", "Burger $12\nClub sandwich $11\nShoyu Ramen\n$13\nCaesar salad $9"),
    ("Pier Nine", "Tacos $9\nPoke $14\nRAMEN\nNumber one, the house bowl $13\nKids menu $6"),
    ("Old Mill", "Soup $5\nPie $8\nRoast $17\nWeekly Specials\nTonkotsu Ramen $14\nPudding $6"),
    ("Market Hall", "Ramen Burger $12\nRamen salad $9\nAdd ramen noodles $2\nFried rice and ramen $11\nInstant ramen $3\nSacramento roll $8"),
    ("Menya Nine", "Shoyu Ramen • Shio Ramen • Miso Ramen • Tantan Ramen • Yuzu Ramen"),
    ("Nine Bowls", "Shoyu Ramen\nShio Ramen\nMiso Ramen\nTantan Ramen\nYuzu Ramen"),
    ("Story Place", "Ramen\nFor more than twenty years this family has brought the best ramen of the whole valley to its tables, every single day of the year\nSteak $20"),
    ("Two Spellings", "SHOYU RAMEN ..... 14.00\nShoyu Ramen $14\nTofu $6\nRice $2"),
    ("Fusion Point", "Ramen\nspicy shoyu, pick your heat\nBeans $4"),
    ("Garden Wok", "Choice of toppings for ramen $2\nPad thai $12\nLo mein with ramen $12\nCurry $11"),
    ("Double Page", "Shio Ramen $12\nRice $2"),
]


def _pick(i: str, at: int):
    return F.element_at(F.array(*[F.lit(m[at]) for m in _MENUS]), (F.col(i) % len(_MENUS) + 1).cast("int"))


def _menu_lines(spark, d):
    p = table(spark, d, "pages").select("page_id", (F.col("page_id") % 40).alias("site"), _pick("page_id", 0).alias("name"), _pick("page_id", 1).alias("text"))
    return p.select("page_id", "site", "name", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))


def _list(at: int) -> str:
    return "[" + ", ".join("'" + m[at].replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for m in _MENUS) + "]"


_MENU_LINES = (
    f"mp AS (SELECT page_id, page_id % 40 AS site, {_list(0)}[page_id % {len(_MENUS)} + 1] AS name, regexp_split_to_array({_list(1)}[page_id % {len(_MENUS)} + 1], '\\n|[•·|]') AS parts FROM pages), "
    "mr AS (SELECT page_id, site, name, unnest(parts) AS part, generate_subscripts(parts, 1) AS nth FROM mp), "
    "ml AS (SELECT page_id, site, name, row_number() OVER (PARTITION BY page_id ORDER BY nth) - 1 AS pos, trim(regexp_replace(part, '\\s+', ' ', 'g')) AS line FROM mr WHERE length(trim(regexp_replace(part, '\\s+', ' ', 'g'))) BETWEEN 3 AND 160)"
)


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _named(text: str, broths: dict[str, str]) -> str:
    bare = f"regexp_replace({text}, {_q(SPICY_FLAVOUR)}, ' ', 'g')"
    return " + ".join(f"CAST(regexp_matches({bare if n == 'spicy' else text}, {_q(RE2.broth(p))}) AS INT)" for n, p in broths.items())


def _verdict_sql(rows: str, keys: str) -> str:
    """SQL of `classify` over a relation (keys, name, pos, line): WITH entries that end in `verdicts`."""
    unpriced = r"regexp_replace(regexp_replace({0}, '\$\s?\d{{1,3}}(?:\.\d{{2}})?', '', 'g'), '(^|[^\d.])\d{{1,3}}\.\d{{2}}([^\d]|$)', '\1\2', 'g')"
    key = f"substr(trim(regexp_replace(regexp_replace({unpriced.format('lower(line)')}, '[^a-z぀-ヿ一-鿿 ]', ' ', 'g'), ' +', ' ', 'g')), 1, 60)"
    w = f"PARTITION BY {keys} ORDER BY pos"
    bare = ", ".join(_q(h) for h in BARE_HEADINGS)
    return f"""
v1 AS (SELECT *, lower(line) AS low, {key} AS k, length(trim({unpriced.format('line')})) AS len, regexp_matches(lower(line), {_q(RE2.price)}) AS price, regexp_matches(lower(line), {_q(RE2.not_bowl)}) AS no_bowl,
  regexp_matches(lower(line), {_q(RE2.option)}) AS opt, regexp_matches(lower(line), {_q(RE2.section)}) AS section, regexp_matches(lower(line), {_q(RE2.specials)}) AS special, regexp_matches(lower(line), {_q(RE2.dish)}) AS met FROM {rows}),
v2 AS (SELECT *, met AND NOT no_bowl AND NOT opt AND k <> '' AND k NOT IN ({bare}) AND (length(line) <= 110 OR price) AS dish FROM v1),
v3 AS (SELECT *, concat_ws(' ', low, lead(low, 1) OVER w, lead(low, 2) OVER w, lead(low, 3) OVER w) AS win, bool_or(price) OVER ({w} ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS near_price,
  coalesce(bool_or(special) OVER ({w} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), false) AS below,
  coalesce(lead(section OR no_bowl OR opt, 1) OVER w, true) AS s1, coalesce(lead(section OR no_bowl OR opt, 2) OVER w, true) AS s2, coalesce(lead(section OR no_bowl OR opt, 3) OVER w, true) AS s3,
  coalesce(lead(price AND len >= 3, 1) OVER w, false) AS g1, coalesce(lead(price AND len >= 3, 2) OVER w, false) AS g2, coalesce(lead(price AND len >= 3, 3) OVER w, false) AS g3, lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2, lead(line, 3) OVER w AS l3 FROM v2 WINDOW w AS ({w})),
fk AS (SELECT {keys}, k, arg_min(line, pos) AS line FROM v2 WHERE dish GROUP BY ALL),
v4 AS (SELECT v3.*, {_named('win', CLASSIC_BROTHS)} AS classic, {_named('win', CLASSIC_BROTHS)} + {_named('win', OTHER_BROTHS)} AS nb, (met OR regexp_matches(low, {_q(RE2.bare)})) AND NOT no_bowl AS bowl,
  EXISTS (SELECT 1 FROM fk WHERE ({', '.join('fk.' + x.strip() for x in keys.split(','))}) = ({', '.join('v3.' + x.strip() for x in keys.split(','))}) AND fk.line = v3.line) AND near_price AND len <= 70 AND NOT below AS single,
  CASE WHEN section THEN CASE WHEN s1 THEN NULL WHEN g1 THEN l1 WHEN s2 THEN NULL WHEN g2 THEN l2 WHEN s3 THEN NULL WHEN g3 THEN l3 END END AS hit FROM v3),
v5 AS (SELECT *, bowl AND classic > 0 AND nb >= 2 AND regexp_matches(win, {_q(RE2.choice)}) AS choices FROM v4),
v6 AS (SELECT *, bowl AND NOT choices AND classic > 0 AND len(list_distinct(regexp_extract_all(win, {_q(TOPPING)}))) >= 2 AND regexp_matches(win, {_q(RE2.noodle)}) AS genuine FROM v5),
v7 AS (SELECT {keys}, max(name) AS name, count(DISTINCT CASE WHEN dish THEN k END) AS dishes, count(*) FILTER (price) AS priced, max(CASE WHEN choices THEN nb END) AS cn, arg_min(line, (-nb, pos)) FILTER (choices) AS choice,
  arg_min(line, pos) FILTER (genuine) AS genuine, arg_min(line, pos) FILTER (single) AS single, arg_min(hit, pos) FILTER (hit IS NOT NULL) AS hit, arg_min(line, pos) FILTER (dish) AS first_dish FROM v6 GROUP BY {keys}),
v8 AS (SELECT *, dishes >= 5 AND ((priced >= 8 AND dishes >= 0.25 * greatest(priced, dishes)) OR regexp_matches(lower(name), {_q(RE2.noodle_name)})) AS shop, coalesce(choice, genuine) AS one_bowl, CASE WHEN priced >= 3 THEN coalesce(single, hit) END AS one FROM v7),
verdicts AS (SELECT {keys}, CASE WHEN shop THEN 'shop' WHEN dishes >= 2 OR one_bowl IS NOT NULL OR one IS NOT NULL THEN 'serves' ELSE 'none' END AS kind, CASE WHEN dishes >= 2 THEN dishes WHEN one_bowl IS NOT NULL OR one IS NOT NULL THEN 1 ELSE dishes END AS dishes, priced,
  CAST(CASE WHEN dishes < 2 AND choice IS NOT NULL THEN cn ELSE 0 END AS INT) AS broths, CASE WHEN shop THEN '5+ dishes' WHEN dishes >= 2 THEN '2+ dishes' WHEN choice IS NOT NULL THEN 'broth choices' WHEN genuine IS NOT NULL THEN 'genuine bowl' WHEN one IS NOT NULL THEN 'one dish' ELSE '' END AS reason,
  CASE WHEN dishes >= 2 THEN first_dish ELSE coalesce(one_bowl, one, first_dish) END AS example FROM v8)"""


def menu_verdicts(spark, d):
    """The verdict of every page's menu, with the rule that decided it."""
    return M.classify(_menu_lines(spark, d), ["page_id"])


MENU_VERDICTS = f"WITH {_MENU_LINES}, {_verdict_sql('ml', 'page_id')} SELECT * FROM verdicts"


def site_verdicts(spark, d):
    """The best page of every site, or its pages as one text where that has more dishes."""
    return M.best_pages(_menu_lines(spark, d), "site", "page_id")


SITE_VERDICTS = f"""WITH {_MENU_LINES}, both_of AS (SELECT site, page_id, name, page_id AS pg, pos AS p, line FROM ml UNION ALL SELECT site, -1, name, page_id, pos, line FROM ml),
ordered AS (SELECT site, page_id, name, row_number() OVER (PARTITION BY site, page_id ORDER BY pg, p) AS pos, line FROM both_of), {_verdict_sql('ordered', 'site, page_id')},
b AS (SELECT site, arg_max({{'page_id': page_id, 'kind': kind, 'dishes': dishes, 'broths': broths, 'reason': reason}}, (dishes, -page_id)) AS b FROM verdicts WHERE page_id >= 0 GROUP BY site),
c AS (SELECT b.site, CASE WHEN w.dishes > b.b.dishes THEN {{'page_id': w.page_id, 'kind': w.kind, 'dishes': w.dishes, 'broths': w.broths, 'reason': w.reason}} ELSE b.b END AS c FROM b JOIN verdicts w ON w.site = b.site AND w.page_id < 0)
SELECT site, c.page_id AS page_id, c.kind AS kind, c.dishes AS dishes, c.broths AS broths, c.reason AS reason FROM c"""


def verdict_counts(spark, d):
    """Sites and dishes by kind."""
    return site_verdicts(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("sites"), F.sum("dishes").alias("dishes"))


VERDICT_COUNTS = f"SELECT kind, count(*) AS sites, CAST(sum(dishes) AS BIGINT) AS dishes FROM ({SITE_VERDICTS}) GROUP BY kind"

_KINDS = ["shop", "serves", "none", "error", "robots", "platform", None]


def _state(spark, d):
    i = F.col("page_id")
    s = table(spark, d, "pages").where("page_id % 11 <> 0")
    checked = F.when(i % 13 != 0, F.date_sub(F.lit("2026-10-01").cast("date"), (i * 17 % 200).cast("int")))
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (i % 7 + 1).cast("int"))
    return s.select(i.alias("id"), kind.alias("kind"), F.when(i % 5 != 0, (i % 9).cast("int")).alias("rules"), (i * 3 % 8).cast("int").alias("dishes"), F.when(i % 23 == 0, "https://moved.example").otherwise(F.col("url")).alias("website"), checked.alias("checked"))


_STATE = "st AS (SELECT page_id AS id, " + "[" + ", ".join("NULL" if k is None else f"'{k}'" for k in _KINDS) + "][page_id % 7 + 1] AS kind, CASE WHEN page_id % 5 <> 0 THEN page_id % 9 END AS rules, page_id * 3 % 8 AS dishes, CASE WHEN page_id % 23 = 0 THEN 'https://moved.example' ELSE url END AS website, CASE WHEN page_id % 13 <> 0 THEN DATE '2026-10-01' - CAST(page_id * 17 % 200 AS INT) END AS checked FROM pages WHERE page_id % 11 <> 0)"


def check_queue(spark, d):
    """Pages due for a check by class, limited to the first 30 hosts, not rows."""
    from ..functions.urls import host_of

    candidates = table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("website"), host_of(F.col("url")).alias("site"))
    queue = M.due(candidates, _state(spark, d), F.lit("2026-10-01").cast("date")).withColumn("class", F.col("class").cast("int"))
    return M.first_sites(queue, "site", ["class", "checked", "id"], 30).select("id", "site", "class", F.col("checked").cast("string").alias("checked"))


def _check_queue_sql() -> str:
    from ..sources.adapters import HOST

    days = "CASE coalesce(kind, 'error') " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in M.RECHECK_DAYS.items()) + f" ELSE {M.OTHER_DAYS} END"
    return f"""WITH {_STATE}, q AS (SELECT p.page_id AS id, {HOST} AS site, st.checked, CAST(CASE WHEN st.id IS NULL OR st.website IS DISTINCT FROM p.url THEN 0
WHEN coalesce(rules, 1) < {RULES} AND ((coalesce(kind, 'error') = 'none' AND (coalesce(rules, 1) < {RULES - 1} OR dishes >= 1)) OR kind = 'shop' OR (kind = 'serves' AND dishes >= 5)) THEN 1
WHEN coalesce(date_diff('day', checked, DATE '2026-10-01'), {M.NEVER_DAYS}) >= {days} THEN 2 END AS INT) AS class FROM pages p LEFT JOIN st ON st.id = p.page_id),
f AS (SELECT site, min((class, coalesce(CAST(checked AS VARCHAR), ''), id)) AS first FROM q WHERE class IS NOT NULL GROUP BY site ORDER BY first, site LIMIT 30)
SELECT id, site, class, CAST(checked AS VARCHAR) AS checked FROM q WHERE class IS NOT NULL AND site IN (SELECT site FROM f)"""


CHECK_QUEUE = _check_queue_sql()

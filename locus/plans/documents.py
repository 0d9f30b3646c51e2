"""Line and classifier queries on documents, week queries and state folds: (Spark, DuckDB SQL) under each name."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import line_key
from ..operators.windows import equal_runs, merged_spans
from ..sources.adapters import ACTIVITY, LINES, WEEK, activity, week
from ..sources.adapters import doc_lines as _lines
from .classifier import verdicts

#: The classifier's tables for documents without prices: a comma stands for a price.
TERMS, EXCLUDED, PRICED = r"\b(that|with|this)\b", r"\b(from|they)\b", ","


def doc_lines(spark, d):
    return _lines(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("line")).alias("longest"), F.min("line").alias("first"))


DOC_LINES = f"WITH {LINES} SELECT doc_id, count(*) AS n, CAST(max(length(line)) AS INT) AS longest, min(line) AS first FROM lines GROUP BY doc_id"


def dish_lines(spark, d):
    """Distinct lines by key that meet the terms, and priced lines, by document."""
    flagged = _lines(spark, d).select("doc_id", F.when(F.lower("line").rlike(TERMS) & ~F.lower("line").rlike(EXCLUDED), line_key(F.col("line"))).alias("key"), F.col("line").rlike(PRICED).alias("priced"))
    return flagged.groupBy("doc_id").agg(F.count_distinct("key").alias("dishes"), F.count_if("priced").alias("priced"))


_KEY = "substr(trim(regexp_replace(regexp_replace(lower(line), '[^a-z぀-ヿ一-鿿 ]', ' ', 'g'), ' +', ' ', 'g')), 1, 60)"
_MET = "regexp_matches(lower(line), '\\b(that|with|this)\\b') AND NOT regexp_matches(lower(line), '\\b(from|they)\\b')"
DISH_LINES = f"WITH {LINES} SELECT doc_id, count(DISTINCT CASE WHEN {_MET} THEN {_KEY} END) AS dishes, count(*) FILTER (contains(line, ',')) AS priced FROM lines GROUP BY doc_id"


def doc_verdict(spark, d):
    """The flagship: documents as shop, serves or none by their lines, with neighbouring lines as context."""
    return verdicts(_lines(spark, d), "doc_id", TERMS, EXCLUDED, PRICED)


DOC_VERDICT = f"""WITH {LINES}, f AS (SELECT doc_id, pos, {_MET} AS met, {_KEY} AS key, contains(line, ',') AS priced, length(line) AS len FROM lines),
c AS (SELECT *, met AND (len <= 110 OR priced) AS dish, coalesce(bool_or(priced) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), false) AS near_price FROM f),
g AS (SELECT doc_id, count(DISTINCT CASE WHEN dish THEN key END) AS dishes, count(*) FILTER (priced) AS priced, count(*) FILTER (dish AND near_price AND len <= 70) AS single FROM c GROUP BY doc_id)
SELECT doc_id, dishes, priced, CASE WHEN dishes >= 5 AND priced >= 8 AND dishes >= 0.25 * greatest(priced, dishes) THEN 'shop' WHEN dishes >= 2 THEN 'serves' WHEN single >= 1 AND priced >= 3 THEN 'serves' ELSE 'none' END AS verdict FROM g"""


def verdict_histogram(spark, d):
    return doc_verdict(spark, d).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.sum("dishes").alias("dishes"))


VERDICT_HISTOGRAM = f"SELECT verdict, count(*) AS n, CAST(sum(dishes) AS BIGINT) AS dishes FROM ({DOC_VERDICT}) GROUP BY 1"


def merge_spans(spark, d):
    return merged_spans(week(spark, d), ["user_id", "dow"], "o", "c")


_MERGED = "x AS (SELECT DISTINCT user_id, dow, o, c FROM spans), y AS (SELECT *, max(c) OVER (PARTITION BY user_id, dow ORDER BY o, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM x), z AS (SELECT *, sum(CASE WHEN before IS NULL OR o > before THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, dow ORDER BY o, c) AS island FROM y), merged AS (SELECT user_id, dow, min(o) AS o, max(c) AS c FROM z GROUP BY user_id, dow, island)"
MERGE_SPANS = f"WITH {WEEK}, {_MERGED} SELECT * FROM merged"


def _days(spark, d):
    m = merge_spans(spark, d).withColumn("span", F.concat_ws("-", F.floor(F.col("o") / 360).cast("string"), F.floor(F.col("c") / 360).cast("string")))
    return m.groupBy("user_id", "dow").agg(F.array_join(F.array_sort(F.array_distinct(F.collect_list("span"))), " ").alias("day"))


def week_runs(spark, d):
    """Neighbouring days with equal (rounded) hours as one run."""
    return equal_runs(_days(spark, d), ["user_id"], "dow", "day")


WEEK_RUNS = f"""WITH {WEEK}, {_MERGED}, s AS (SELECT DISTINCT user_id, dow, CAST(o // 360 AS VARCHAR) || '-' || CAST(c // 360 AS VARCHAR) AS span FROM merged), days AS (SELECT user_id, dow, string_agg(span, ' ' ORDER BY span) AS day FROM s GROUP BY 1, 2),
n AS (SELECT *, CASE WHEN lag(day) OVER w = day AND lag(dow) OVER w = dow - 1 THEN 0 ELSE 1 END AS new FROM days WINDOW w AS (PARTITION BY user_id ORDER BY dow)), r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY dow) AS run FROM n)
SELECT user_id, min(dow) AS first, max(dow) AS last, any_value(day) AS day FROM r GROUP BY user_id, run"""


def open_now(spark, d):
    """State at Wednesday 13:00: open (yesterday's hours past midnight or today's), closing within 45 minutes, later, closed."""
    dow, minute = 2, 780
    m = merge_spans(spark, d)
    left = F.when((F.col("dow") == dow) & (F.col("o") <= minute) & (F.col("c") > minute), F.col("c") - minute).when((F.col("dow") == (dow + 6) % 7) & (F.col("c") - 1440 > minute), F.col("c") - 1440 - minute)
    later = F.when((F.col("dow") == dow) & (F.col("o") > minute), F.col("o"))
    g = m.groupBy("user_id").agg(F.max(left).alias("left"), F.min(later).alias("opens"))
    return g.select("user_id", F.when(F.col("left").isNotNull(), F.when(F.col("left") <= 45, "closes soon").otherwise("open")).when(F.col("opens").isNotNull(), "later").otherwise("closed").alias("state"), "opens")


OPEN_NOW = f"WITH {WEEK}, {_MERGED}, g AS (SELECT user_id, max(CASE WHEN dow = 2 AND o <= 780 AND c > 780 THEN c - 780 WHEN dow = 1 AND c - 1440 > 780 THEN c - 2220 END) AS remaining, min(CASE WHEN dow = 2 AND o > 780 THEN o END) AS opens FROM merged GROUP BY user_id) SELECT user_id, CASE WHEN remaining <= 45 THEN 'closes soon' WHEN remaining IS NOT NULL THEN 'open' WHEN opens IS NOT NULL THEN 'later' ELSE 'closed' END AS state, opens FROM g"


def late_nights(spark, d):
    return week(spark, d).groupBy("user_id").agg(F.bool_or(F.col("c") >= 1320).alias("late"), F.count_distinct("dow").alias("days"))


LATE_NIGHTS = f"WITH {WEEK} SELECT user_id, bool_or(c >= 1320) AS late, count(DISTINCT dow) AS days FROM spans GROUP BY user_id"


def site_health(spark, d):
    """Open runs of trouble: other trouble starts anew, good days end a run, missing states change nothing, days count once."""
    state = F.when(F.col("event_type") == "error", "down").when(F.col("event_type") == "signup", "dns").when(F.col("event_type") == "click", "ok")
    s = activity(spark, d).select((F.col("k") % 50).alias("host"), "day", "seq", state.alias("state")).where("state is not null")
    by = Window.partitionBy("host").orderBy("seq")
    runs = s.withColumn("new", F.when(F.lag("state").over(by).eqNullSafe(F.col("state")), 0).otherwise(1)).withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    last = runs.groupBy("host", "run").agg(F.first("state").alias("state"), F.min("day").alias("first"), F.max("day").alias("last"), F.count_distinct("day").alias("n"))
    return last.groupBy("host").agg(F.max_by(F.struct("state", "first", "last", "n"), "run").alias("r")).select("host", "r.*").where("state <> 'ok'")


SITE_HEALTH = f"""WITH {ACTIVITY}, s AS (SELECT k % 50 AS host, day, seq, CASE event_type WHEN 'error' THEN 'down' WHEN 'signup' THEN 'dns' WHEN 'click' THEN 'ok' END AS state FROM activity WHERE event_type IN ('error', 'signup', 'click')),
r AS (SELECT *, sum(new) OVER (PARTITION BY host ORDER BY seq) AS run FROM (SELECT *, CASE WHEN lag(state) OVER (PARTITION BY host ORDER BY seq) = state THEN 0 ELSE 1 END AS new FROM s))
SELECT host, any_value(state) AS state, min(day) AS first, max(day) AS last, count(DISTINCT day) AS n FROM r GROUP BY host, run HAVING run = (SELECT max(run) FROM r q WHERE q.host = r.host) AND any_value(state) <> 'ok'"""


def signals_hide(spark, d):
    """Shops warned of in two or more distinct ways are hidden; ways of one family count once."""
    kind = F.when(F.col("event_type").isin("error", "signup"), "site").otherwise(F.col("event_type"))
    return activity(spark, d).where("stars <= 2 and day = DATE '2024-01-10'").groupBy("shop").agg(F.count_distinct(kind).alias("kinds"), F.array_join(F.array_sort(F.collect_set(kind)), " / ").alias("label")).where("kinds >= 2")


SIGNALS_HIDE = f"WITH {ACTIVITY}, s AS (SELECT shop, CASE WHEN event_type IN ('error', 'signup') THEN 'site' ELSE event_type END AS kind FROM activity WHERE stars <= 2 AND day = DATE '2024-01-10') SELECT shop, count(DISTINCT kind) AS kinds, string_agg(DISTINCT kind, ' / ' ORDER BY kind) AS label FROM s GROUP BY shop HAVING count(DISTINCT kind) >= 2"


def stream_counts(spark, d):
    """Daily counters from a stream of the events, read once to its end; equals the batch result."""
    from ..streaming.counters import counted

    return counted(spark, d)


STREAM_COUNTS = f"WITH {ACTIVITY} SELECT shop, day, event_type, count(*) AS n FROM activity GROUP BY 1, 2, 3"


def suppressed(spark, d):
    """Events kept when repeats within 30 minutes of a kept one are dropped: sequential by visitor and kind."""
    from ..streaming.counters import suppress_repeats

    return suppress_repeats(activity(spark, d).select("device", "event_type", "seq", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")), ["device", "event_type"], "us", "seq", 30 * 60 * 1_000_000)


#: From each key's first row on, the first row that is late enough after the last kept one.
SUPPRESSED = f"""WITH RECURSIVE {ACTIVITY}, e AS (SELECT device, event_type, seq, epoch_us(ts) AS us FROM activity),
k AS (SELECT device, event_type, min((us, seq)) AS p FROM e GROUP BY ALL UNION ALL SELECT e.device, e.event_type, min((e.us, e.seq)) AS p FROM k JOIN e ON e.device = k.device AND e.event_type = k.event_type AND e.us - k.p[1] > 1800000000 GROUP BY ALL)
SELECT device, event_type, p[2] AS seq, p[1] AS us FROM k"""

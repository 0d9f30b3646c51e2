"""The menu classifier on exploded lines: verdicts, best pages, recheck gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.menu import BARE_HEADINGS, CLASSIC_BROTHS, JAVA, OTHER_BROTHS, RULES, SPICY_FLAVOUR, TOPPING
from ..functions.text import line_key


def _broths(text: Column, table: dict[str, str]) -> Column:
    """How many of a table's broths a lower-case text names."""
    bare = F.regexp_replace(text, SPICY_FLAVOUR, " ")
    return sum((F.when((bare if name == "spicy" else text).rlike(JAVA.broth(pattern)), 1).otherwise(0) for name, pattern in table.items()), F.lit(0))


def classify(lines: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """(keys, kind, dishes, priced, broths, reason, example) of lines (keys, name, pos, line).

    A dish line has the dish's words, is nothing that only looks like it and no option, has a key that is no bare heading, and is
    short or priced; dishes are distinct keys. In this order: 5 dishes on a focused menu or under a noodle name make a shop; 2
    dishes serve; so does one bowl with a choice of broths, one with a broth and two toppings, or one priced dish of a menu with 3
    prices that does not stand below a heading of specials; a section heading lends its name to a priced line below it.
    Neighbouring lines are read by windows over one partitioning by the keys, which the aggregation shares.
    """
    by = Window.partitionBy(*keys).orderBy("pos")
    low = F.lower("line")
    bare_price = F.length(F.trim(F.regexp_replace("line", JAVA.price, "")))
    f = lines.select(*keys, name, "pos", "line", low.alias("low"), line_key(F.col("line")).alias("k"), low.rlike(JAVA.price).alias("price"), low.rlike(JAVA.not_bowl).alias("no_bowl"), low.rlike(JAVA.option).alias("option"), low.rlike(JAVA.section).alias("section"), low.rlike(JAVA.specials).alias("special"), bare_price.alias("len"))
    met = F.col("low").rlike(JAVA.dish)
    dish = met & ~F.col("no_bowl") & ~F.col("option") & (F.col("k") != "") & ~F.col("k").isin(*BARE_HEADINGS) & ((F.length("line") <= 110) | F.col("price"))
    f = f.withColumn("dish", dish)
    ahead = [F.lead("low", i).over(by) for i in (1, 2, 3)]
    f = f.withColumn("window", F.concat_ws(" ", "low", *ahead)).withColumn("near_price", F.bool_or("price").over(by.rowsBetween(0, 2)))
    f = f.withColumn("below_special", F.coalesce(F.bool_or("special").over(by.rowsBetween(-3, -1)), F.lit(False)))
    # A line counts as a dish by its text: that of the first line of some key.
    firsts = Window.partitionBy(*keys)
    f = f.withColumn("first_of_key", F.min(F.when(F.col("dish"), F.struct("pos", "line"))).over(Window.partitionBy(*keys, "k"))["line"])
    f = f.withColumn("names", F.collect_set(F.when(F.col("dish"), F.col("first_of_key"))).over(firsts))
    classic, other = _broths(F.col("window"), CLASSIC_BROTHS), _broths(F.col("window"), OTHER_BROTHS)
    f = f.withColumn("classic", classic).withColumn("n_broths", classic + other).withColumn("bowl", (met | F.col("low").rlike(JAVA.bare)) & ~F.col("no_bowl"))
    choices = F.col("bowl") & (F.col("classic") > 0) & F.col("window").rlike(JAVA.choice) & (F.col("n_broths") >= 2)
    toppings = F.size(F.array_distinct(F.regexp_extract_all("window", F.lit(TOPPING), F.lit(0))))
    genuine = F.col("bowl") & ~choices & (F.col("classic") > 0) & (toppings >= 2) & F.col("window").rlike(JAVA.noodle)
    single = F.array_contains("names", F.col("line")) & F.col("near_price") & (F.col("len") <= 70) & ~F.col("below_special")
    stop = [F.coalesce(F.lead(F.col("section") | F.col("no_bowl") | F.col("option"), i).over(by), F.lit(True)) for i in (1, 2, 3)]
    good = [F.coalesce(F.lead(F.col("price") & (F.col("len") >= 3), i).over(by), F.lit(False)) for i in (1, 2, 3)]
    hit = F.when(stop[0], None).when(good[0], F.lead("line", 1).over(by)).when(stop[1], None).when(good[1], F.lead("line", 2).over(by)).when(stop[2], None).when(good[2], F.lead("line", 3).over(by))
    f = f.select(*keys, name, "pos", "line", "k", "price", "dish", "n_broths", choices.alias("choices"), genuine.alias("genuine"), single.alias("single"), F.when(F.col("section"), hit).alias("hit"))
    at = lambda c: F.min_by("line", F.when(c, F.col("pos")))
    g = f.groupBy(*keys).agg(
        F.count_distinct(F.when(F.col("dish"), F.col("k"))).alias("dishes"),
        F.count_if("price").alias("priced"),
        F.max(F.when(F.col("choices"), F.struct(F.col("n_broths").alias("n"), F.negative("pos").alias("p"), "line"))).alias("choice"),
        at(F.col("genuine")).alias("genuine"),
        at(F.col("single")).alias("single"),
        F.min_by("hit", F.when(F.col("hit").isNotNull(), F.col("pos"))).alias("hit"),
        at(F.col("dish")).alias("first_dish"),
        F.max(name).alias("name"),
    )
    size = F.greatest("priced", "dishes")
    shop = (F.col("dishes") >= 5) & (((F.col("priced") >= 8) & (F.col("dishes") >= 0.25 * size)) | F.lower(F.coalesce("name", F.lit(""))).rlike(JAVA.noodle_name))
    one = F.when(F.col("priced") >= 3, F.coalesce("single", "hit"))
    bowl = F.coalesce("choice.line", "genuine")
    reason = F.when(shop, "5+ dishes").when(F.col("dishes") >= 2, "2+ dishes").when(F.col("choice").isNotNull(), "broth choices").when(F.col("genuine").isNotNull(), "genuine bowl").when(one.isNotNull(), "one dish").otherwise("")
    many = F.col("dishes") >= 2
    return g.select(
        *keys,
        F.when(shop, "shop").when(many | bowl.isNotNull() | one.isNotNull(), "serves").otherwise("none").alias("kind"),
        F.when(many, F.col("dishes")).when(bowl.isNotNull() | one.isNotNull(), 1).otherwise(F.col("dishes")).cast("bigint").alias("dishes"),
        "priced",
        F.when(~many & F.col("choice").isNotNull(), F.col("choice.n")).otherwise(0).cast("int").alias("broths"),
        reason.alias("reason"),
        F.when(many, F.col("first_dish")).otherwise(F.coalesce(bowl, one, "first_dish")).alias("example"),
    )


def best_pages(lines: DataFrame, site: str, page: str, name: str = "name") -> DataFrame:
    """The verdict of each site: its page with most dishes, the first among equals; all its pages read as one text where that has
    more dishes. Lines are (site, page, name, pos, line)."""
    together = lines.select(site, F.lit(-1).cast("bigint").alias(page), name, F.struct(page, "pos").alias("at"), "line")
    apart = lines.select(site, F.col(page).cast("bigint").alias(page), name, F.struct(page, "pos").alias("at"), "line")
    v = classify(apart.unionByName(together).withColumnRenamed("at", "pos").withColumn("pos", F.row_number().over(Window.partitionBy(site, page).orderBy("pos"))), [site, page], name)
    best = v.where(F.col(page) >= 0).groupBy(site).agg(F.max_by(F.struct(page, "kind", "dishes", "broths", "reason"), F.struct("dishes", F.negative(page))).alias("b"))
    whole = v.where(F.col(page) < 0).select(F.col(site).alias("s2"), F.struct(page, "kind", "dishes", "broths", "reason").alias("w"))
    chosen = F.when(F.col("w.dishes") > F.col("b.dishes"), F.col("w")).otherwise(F.col("b"))
    return best.join(whole, F.col(site) == F.col("s2")).select(site, chosen.alias("c")).select(site, "c.*")


#: Days after which a verdict is looked at again. Fixed values.
RECHECK_DAYS = {"shop": 30, "serves": 30, "none": 90, "error": 14, "robots": 120, "platform": 180}
OTHER_DAYS = 30
NEVER_DAYS = 10_000


def due(candidates: DataFrame, state: DataFrame, today, key: str = "id") -> DataFrame:
    """(key, site, class, checked) of candidates (key, site, website) to look at, by state (key, kind, rules, dishes, website,
    checked): 0 new or with another website; 1 judged by outdated rules that could change the verdict; 2 older than its kind's
    days. A state row without rules counts as rules 1, without a kind as error; a missing date is 10,000 days ago."""
    s = state.select(F.col(key).alias("k2"), F.coalesce("kind", F.lit("error")).alias("kind"), F.coalesce("rules", F.lit(1)).alias("rules"), F.coalesce("dishes", F.lit(0)).alias("dishes"), F.col("website").alias("old"), "checked")
    age = F.coalesce(F.datediff(F.lit(today), "checked"), F.lit(NEVER_DAYS))
    days = F.lit(OTHER_DAYS)
    for kind, n in RECHECK_DAYS.items():
        days = F.when(F.col("kind") == kind, n).otherwise(days)
    outdated = (F.col("rules") < RULES) & (((F.col("kind") == "none") & ((F.col("rules") < RULES - 1) | (F.col("dishes") >= 1))) | (F.col("kind") == "shop") | ((F.col("kind") == "serves") & (F.col("dishes") >= 5)))
    group = F.when(F.col("k2").isNull() | ~F.col("old").eqNullSafe(F.col("website")), 0).when(outdated, 1).when(age >= days, 2)
    return candidates.join(s, F.col(key) == F.col("k2"), "left").withColumn("class", group).where("class is not null").select(key, "site", "class", "checked")


def first_sites(queue: DataFrame, site: str, order: list[str], most: int) -> DataFrame:
    """Rows of a queue's first `most` sites in order of their first rows; later rows of an admitted site stay."""
    first = queue.groupBy(site).agg(F.min(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c == "checked" else F.col(c) for c in order])).alias("first"))
    admitted = first.orderBy("first", site).limit(most).select(site)  # a table of at most `most` rows
    return queue.join(F.broadcast(admitted), site, "left_semi")

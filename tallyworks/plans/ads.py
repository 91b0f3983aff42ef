"""Ad analytics: daily reports, click-through rates, platforms, spikes, log defects, clients.

Every report reads the event table once where the question allows it. Events are first combined per
ad, per ad and day, or per client and day, so what is shuffled is aggregates; a single ad or client
may hold any share of the rows.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions.columns import (
    count_where,
    day_key,
    days_between,
    flag,
    hour_number,
    percent,
    ratio,
    sum_where,
)
from tallyworks.operators.keyed_join import join_per_key, small_table
from tallyworks.operators.quantile import exact_quantile, mean_of, rank_discrete, value_counts
from tallyworks.sources.workspace import written

SPIKE_DAY = datetime.date(2024, 1, 5)
APPROXIMATE_DEVIATION = 0.05  # relative standard deviation of approximate distinct counts


def is_view() -> Column:
    return F.col("event") == "view"


def is_click() -> Column:
    return F.col("event") == "click"


def views() -> Column:
    return count_where(is_view()).alias("views")


def clicks() -> Column:
    return count_where(is_click()).alias("clicks")


# --- by day -----------------------------------------------------------------------------------


def daily_stats(ads: DataFrame) -> DataFrame:
    """Events, views, clicks, distinct ads and campaigns per date.

    Each row counts for the two distinct columns and for the rest, so three rows go into the first,
    partial aggregate. Its result, one row per task, date and id, is spread by (date, id), and the counts
    meet by date in a second exchange: neither a busy date nor a busy ad meets a single task.
    """
    return ads.groupBy("date").agg(
        F.count("event").alias("all_events"),
        views(),
        clicks(),
        F.count_distinct("ad_id").alias("unique_ads"),
        F.count_distinct("campaign_union_id").alias("unique_campaigns"),
    )


def daily_event_mix(ads: DataFrame) -> DataFrame:
    mix = ads.groupBy("date").agg(F.count("event").alias("all_events"), views(), clicks())
    return mix.orderBy("date")


def daily_revenue(ads: DataFrame) -> DataFrame:
    """CPC ads earn their price per click, CPM ads a thousandth of it per view."""
    per_click = sum_where((F.col("ad_cost_type") == "CPC") & is_click(), F.col("ad_cost"))
    per_view = sum_where((F.col("ad_cost_type") == "CPM") & is_view(), F.col("ad_cost") / 1000)
    earned = ads.groupBy("date").agg(per_click.alias("cpc"), per_view.alias("cpm"))
    earned = earned.select(
        "date",
        F.round("cpc", 6).alias("cpc"),
        F.round("cpm", 6).alias("cpm"),
        F.round(F.col("cpc") + F.col("cpm"), 6).alias("revenue"),
    )
    return earned.orderBy(F.desc("revenue"), "date")


def date_keys(ads: DataFrame) -> DataFrame:
    return ads.groupBy(day_key(F.col("date")).alias("date_key")).agg(F.count("event").alias("all_events"))


def ad_days(ads: DataFrame) -> DataFrame:
    """One row per ad and date."""
    return ads.groupBy("ad_id", "date").agg(F.count("event").alias("all_events"), views(), clicks())


def ad_day_stats(ads: DataFrame) -> DataFrame:
    return ad_days(ads).orderBy(F.desc("ad_id"), "date")


# --- the spike day ----------------------------------------------------------------------------


def ads_active_on_day(ads: DataFrame, day: datetime.date = SPIKE_DAY) -> DataFrame:
    """Days of all ads that had an event on the given day (semi-join on ad-day rows)."""
    per_day = ad_days(ads)
    active = ads.where(F.col("date") == F.lit(day)).select("ad_id").distinct()
    return per_day.join(active, "ad_id", "left_semi")


def spike_ads_ranked(ads: DataFrame, day: datetime.date = SPIKE_DAY) -> DataFrame:
    """Ads seen on the day, by their events of all time; one pass instead of a semi-join."""
    per_ad = ads.groupBy("ad_id").agg(
        F.count("event").alias("all_events_count"),
        F.max(F.col("date") == F.lit(day)).alias("seen"),
    )
    ranked = per_ad.where("seen").drop("seen")
    return ranked.orderBy(F.desc("all_events_count"), "ad_id")


def top_spike_ads_daily(ads: DataFrame, day: datetime.date = SPIKE_DAY, k: int = 5) -> DataFrame:
    """Daily numbers of the k largest ads seen on the day.

    The ranking shuffles one row per ad; its k ids are broadcast (never more than k rows), so the
    second scan keeps only their events before anything else is shuffled.
    """
    largest = F.broadcast(spike_ads_ranked(ads, day).limit(k).select("ad_id"))
    return ad_days(ads.join(largest, "ad_id", "left_semi")).orderBy(F.desc("ad_id"), "date")


def spike_diagnosis(ads: DataFrame, day: datetime.date = SPIKE_DAY) -> DataFrame:
    """Share of the ads seen on the day for which it was the peak day, the first day, and both."""
    on_day = F.col("date") == F.lit(day)
    per_ad = (
        ad_days(ads)
        .groupBy("ad_id")
        .agg(
            F.max("all_events").alias("peak"),
            F.min("date").alias("first_day"),
            F.max(F.when(on_day, F.col("all_events"))).alias("events_on_day"),
        )
        .where(F.col("events_on_day").isNotNull())
    )
    at_peak = F.col("events_on_day") == F.col("peak")
    at_first = F.col("first_day") == F.lit(day)
    ads_seen = F.count(F.lit(1))
    return per_ad.agg(
        ads_seen.alias("ads"),
        percent(count_where(at_peak), ads_seen).alias("perc_peak_on_day"),
        percent(count_where(at_first), ads_seen).alias("perc_first_on_day"),
        percent(count_where(at_peak & at_first), ads_seen).alias("perc_first_and_peak"),
    )


def day_arrays(ads: DataFrame) -> DataFrame:
    """Per ad, its (day, events) pairs in day order; at most one pair per calendar day."""
    pair = F.struct(day_key(F.col("date")).alias("day"), F.col("all_events").alias("events"))
    return ad_days(ads).groupBy("ad_id").agg(F.array_sort(F.collect_list(pair)).alias("days"))


def ad_peak_day(ads: DataFrame, day: datetime.date = SPIKE_DAY) -> DataFrame:
    """The spike question per ad, asked of the day arrays."""
    key = F.lit(int(day.strftime("%Y%m%d")))
    found = day_arrays(ads).select(
        "ad_id",
        "days",
        F.array_position(F.col("days.day"), key).cast("int").alias("day_index"),
        F.array_max(F.col("days.events")).alias("max_events_in_day"),
    )
    on_day = F.get("days", F.col("day_index") - 1).getField("events")
    return found.where("day_index > 0").select(
        "ad_id",
        "day_index",
        "max_events_in_day",
        flag(on_day == F.col("max_events_in_day")).alias("peak_on_day"),
        flag(F.col("day_index") == 1).alias("first_on_day"),
    )


def array_ops(ads: DataFrame, day: datetime.date = SPIKE_DAY) -> DataFrame:
    """Array constructor, sort, map, element, index and reduce on the days of each ad."""
    key = F.lit(int(day.strftime("%Y%m%d")))
    counted = day_arrays(ads).select(
        "ad_id",
        F.array_sort(F.transform("days", lambda pair: pair.getField("day"))).alias("day_keys"),
        F.transform("days", lambda pair: pair.getField("events")).alias("events"),
    )
    zipped = counted.withColumn("pairs", F.arrays_zip("day_keys", "events"))
    low_high = F.array(F.array_min("events"), F.array_max("events"))
    return zipped.select(
        "ad_id",
        F.size("pairs").alias("days"),
        F.try_element_at("day_keys", F.lit(1)).alias("first_key"),
        F.try_element_at("day_keys", F.lit(2)).alias("second_key"),
        F.array_position("day_keys", key).cast("int").alias("index_of_day"),
        F.array_max(F.col("pairs.events")).alias("max_events"),
        F.aggregate("events", F.lit(0).cast("long"), lambda total, n: total + n).alias("all_events"),
        F.size(F.array_distinct(low_high)).alias("distinct_low_high"),
    )


# --- click-through rate -----------------------------------------------------------------------


def ctr_by(ads: DataFrame, key: str) -> DataFrame:
    """Views, clicks and their ratio per key, for keys that were viewed at all."""
    counted = ads.groupBy(key).agg(views(), clicks()).where("views <> 0")
    return counted.withColumn("ctr", ratio(F.col("clicks"), F.col("views")))


def ctr_by_ad_sql(ads: DataFrame) -> DataFrame:
    """SQL text: aliases of aggregates are reused in the same SELECT and in HAVING."""
    return ads.sparkSession.sql(
        """
        select ad_id,
               count_if(event = 'view')   as views,
               count_if(event = 'click')  as clicks,
               try_divide(clicks, views)  as ctr
        from {ads}
        group by ad_id
        having views <> 0
        """,
        ads=ads,
    )


def top_ctr(ads: DataFrame, k: int = 10) -> DataFrame:
    return ctr_by(ads, "ad_id").orderBy(F.desc("ctr"), "ad_id").limit(k)


def ctr_median_and_mean(ads: DataFrame) -> DataFrame:
    counted = value_counts(ctr_by(ads, "ad_id"), "ctr")
    mean = counted.agg(F.round(mean_of(counted), 9).alias("avg_ctr"))
    return mean.select(
        exact_quantile(counted, 0.5).alias("median_ctr"),
        exact_quantile(counted, 0.5, rank_discrete).alias("median_ctr_discrete"),
        "avg_ctr",
    )


def ctr_quantile_on_day(ads: DataFrame, day: datetime.date = SPIKE_DAY, p: float = 0.95) -> DataFrame:
    counted = value_counts(ctr_by(ads.where(F.col("date") == F.lit(day)), "ad_id"), "ctr")
    return counted.agg(F.sum("n").alias("ads")).select("ads", exact_quantile(counted, p).alias("ctr_p95"))


# --- platforms --------------------------------------------------------------------------------


def platform_view_share(ads: DataFrame) -> DataFrame:
    """Percent of all views per platform; the total is summed over the per-platform rows."""
    per_platform = ads.groupBy("platform").agg(count_where(is_view()).alias("platform_views"))
    total = F.sum("platform_views").over(Window.partitionBy())
    shares = per_platform.withColumn("perc", percent(F.col("platform_views"), total))
    return shares.orderBy(F.desc("platform_views"), "platform")


def platform_views(ads: DataFrame, platform: str = "android") -> DataFrame:
    shown = ads.where((F.col("platform") == platform) & is_view())
    return shown.agg(F.count("event").alias("views"))


def mobile_views(ads: DataFrame) -> DataFrame:
    on_android = (F.col("platform") == "android") & is_view()
    on_ios = (F.col("platform") == "ios") & is_view()
    return ads.agg(
        count_where(on_android).alias("android_views"),
        count_where(on_ios).alias("ios_views"),
        count_where(F.col("platform").isin("android", "ios") & is_view()).alias("mobile_views"),
    )


def distinct_platforms(ads: DataFrame) -> DataFrame:
    return ads.agg(F.count_distinct("platform").alias("platforms"))


def max_platforms_per_ad(ads: DataFrame) -> DataFrame:
    """The largest number of platforms one ad was viewed on."""
    per_ad = ads.where(is_view()).groupBy("ad_id").agg(F.count_distinct("platform").alias("platforms"))
    return per_ad.agg(F.max("platforms").alias("max_platforms"))


WORD = 62  # platforms whose bits share a number


def platform_numbers(ads: DataFrame) -> DataFrame:
    """platform and number, from 0 in the order of the names, of every platform with a view."""
    names = ads.where(is_view() & F.col("platform").isNotNull()).select("platform").distinct()
    return names.select("platform", (F.row_number().over(Window.orderBy("platform")) - 1).alias("number"))


def platform_bits(ads: DataFrame, numbers: DataFrame) -> DataFrame:
    """ad_id and words: for every ad the sorted (word, bits) of the platforms that it was viewed on, none without views.

    Bits are combined as plain numbers by hash, in the tasks first, so an ad or platform with most of the events sends
    one row a task.
    """
    shown = is_view() & F.col("number").isNotNull()
    word = F.when(shown, F.floor(F.col("number") / WORD)).otherwise(0).cast("int")
    bit = F.when(shown, F.expr(f"shiftleft(1L, cast(number % {WORD} as int))")).otherwise(F.lit(0).cast("long"))
    numbered = ads.select("ad_id", "platform", "event").join(small_table(numbers), "platform", "left")
    parts = numbered.groupBy("ad_id", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    some = F.when(F.col("bits") != 0, F.struct("word", "bits"))
    return parts.groupBy("ad_id").agg(F.array_sort(F.collect_list(some)).alias("words"))


def platform_sets(ads: DataFrame) -> DataFrame:
    """Share of all ads per combination of platforms they were viewed on, for any number of platforms.

    Platforms are numbered in a table of their own; numbers become names again in the result rows only.
    """
    numbers = written(platform_numbers(ads), "platforms")
    sets = platform_bits(ads, numbers).groupBy("words").agg(F.count(F.lit(1)).alias("ads"))
    sets = written(sets, "platform-sets")
    total = sets.agg(F.sum("ads").alias("n"))
    places = F.expr(f"transform(filter(sequence(0, {WORD - 1}), b -> getbit(w.bits, b) = 1), b -> w.word * {WORD} + b)")
    ones = sets.select("words", F.explode("words").alias("w")).select("words", F.explode(places).alias("number"))
    ordered = F.array_sort(F.collect_list(F.struct("number", "platform")))["platform"]
    named = ones.join(small_table(numbers), "number").groupBy("words").agg(F.array_join(ordered, ",").alias("platforms"))
    shares = sets.join(named, "words").select(
        "platforms",
        "ads",
        total.scalar().alias("sum_ads"),
        (F.col("ads").cast("double") / total.scalar() * 100).alias("perc_ads"),
    )
    return shares.orderBy(F.desc("perc_ads"), "platforms")


# --- defects of the log -----------------------------------------------------------------------


def never_viewed(ads: DataFrame) -> DataFrame:
    """Ads with clicks and no view, with their clicks per platform."""
    clicked_on = [
        count_where(F.col("platform") == platform).alias(name)
        for platform, name in (("android", "androids"), ("ios", "ios"), ("web", "web"))
    ]
    per_ad = ads.groupBy("ad_id").agg(views(), clicks(), F.count(F.lit(1)).alias("events"), *clicked_on)
    return per_ad.where("views = 0 and clicks <> 0")


def clicked_never_viewed(ads: DataFrame) -> DataFrame:
    return never_viewed(ads).agg(F.count("ad_id").alias("ads"))


def orphan_platforms(ads: DataFrame, first: int | None = None) -> DataFrame:
    """Platforms of the events of ads that were clicked but never viewed: of all, or of the `first` ones by time
    and platform, if the caller asks for no more."""
    if first is None:
        return orphan_platforms_all(ads)
    orphans = never_viewed(ads).select("ad_id", "events")
    # an ad without views has no view rows, so those need not meet the join
    candidates = ads.where(~is_view()).select("event_id", "ad_id", "time", "platform")
    events = join_per_key(candidates, orphans, "ad_id", "events", F.col("event_id"), "left_semi")
    earliest = events.orderBy("time", "platform", "event_id").limit(first)
    return earliest.agg(
        count_where(F.col("platform") == "android").alias("androids"),
        count_where(F.col("platform") == "ios").alias("ios"),
        count_where(F.col("platform") == "web").alias("web"),
    )


def orphan_platforms_all(ads: DataFrame) -> DataFrame:
    """The same split over all such events; the per-ad counts already hold it."""
    return never_viewed(ads).agg(
        F.sum("androids").alias("androids"), F.sum("ios").alias("ios"), F.sum("web").alias("web")
    )


def click_comes_first() -> Column:
    """Aggregate: the group's earliest event is a click; at equal times the view counts as earlier."""
    first_click = F.min(F.when(is_click(), F.col("time")))
    first_view = F.min(F.when(is_view(), F.col("time")))
    return first_click.isNotNull() & (first_view.isNull() | (first_click < first_view))


def click_first(ads: DataFrame) -> DataFrame:
    """(ad, platform) pairs whose first event is a click.

    Two conditional minima instead of the event name at the minimal time: timestamps fit the hash
    aggregate's fixed-width buffer, a string would force a sort of the raw events.
    """
    return ads.groupBy("ad_id", "platform").agg(click_comes_first().alias("click_first")).where("click_first")


def click_first_ads(ads: DataFrame) -> DataFrame:
    return click_first(ads).agg(F.count_distinct("ad_id").alias("ads"))


def click_first_ads_check(ads: DataFrame, deviations: int = 4) -> DataFrame:
    """The exact number beside whether the approximate one lies within so many of its standard deviations."""
    exact, near = click_first_ads(ads), click_first_ads_approx(ads)
    both = exact.select("ads", near.scalar().alias("_near"))
    bound = deviations * APPROXIMATE_DEVIATION * F.col("ads")
    return both.select("ads", (F.abs(F.col("_near") - F.col("ads")) > bound).alias("outside_bound"))


def click_first_ads_approx(ads: DataFrame) -> DataFrame:
    return click_first(ads).agg(F.approx_count_distinct("ad_id", APPROXIMATE_DEVIATION).alias("ads"))


def late_changes(ads: DataFrame) -> DataFrame:
    """Events more than an hour after the previous event of their ad and of another type.

    A row that lies over an hour after its predecessor is the first of its ad in its clock hour, and
    the predecessor is the last of the ad's preceding non-empty hour. So only the edges of each
    (ad, hour) are compared, and no window ever runs over the raw events of a hot ad. Events at the
    same time are taken as view before click.
    """
    hour = hour_number(F.col("time"), dict(ads.dtypes)["time"] == "timestamp")
    last_click = F.max(F.when(is_click(), F.col("time")))
    last_view = F.max(F.when(is_view(), F.col("time")))
    hours = ads.groupBy("ad_id", hour.alias("hour")).agg(
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        click_comes_first().alias("starts_with_click"),
        F.coalesce(last_click >= last_view, last_click.isNotNull()).alias("ends_with_click"),
    )
    by_hour = Window.partitionBy("ad_id").orderBy("hour")
    edges = hours.select(
        "starts_with_click",
        "first_time",
        F.lag("last_time").over(by_hour).alias("previous_time"),
        F.lag("ends_with_click").over(by_hour).alias("previous_click"),
    )
    late = F.col("first_time") > F.col("previous_time") + F.expr("interval 1 hour")
    changed = F.col("starts_with_click") != F.col("previous_click")
    return edges.agg(
        count_where(late & changed).alias("late_changes"),
        count_where(late & changed & F.col("starts_with_click")).alias("late_clicks_after_view"),
    )


# --- clients ----------------------------------------------------------------------------------


def active_clients(ads: DataFrame) -> DataFrame:
    return ads.select("client_union_id").distinct()


def clients_without_ads(clients: DataFrame, ads: DataFrame) -> DataFrame:
    """Anti-join: unlike NOT IN it is not emptied by a NULL among the active ids."""
    return clients.join(active_clients(ads), "client_union_id", "left_anti")


def never_active_share(clients: DataFrame, ads: DataFrame) -> DataFrame:
    """Clients that never advertised: count, share, and the oldest create dates, in one join."""
    active = active_clients(ads).withColumn("is_active", F.lit(True))
    marked = clients.join(active, "client_union_id", "left")
    idle = F.col("is_active").isNull()
    counted = marked.agg(
        F.count_distinct("client_union_id").alias("total"),
        count_where(idle & F.col("client_union_id").isNotNull()).alias("never"),
        F.min(F.when(idle, F.col("create_date"))).alias("oldest"),
        F.min("create_date").alias("earliest_client"),
    )
    return counted.withColumn("part", F.round(percent(F.col("never"), F.col("total")), 0))


def client_gap_rows(clients: DataFrame, ads: DataFrame) -> DataFrame:
    """Days between client creation and each ad event, with how many events lie that far apart.

    Events are counted per client and date before the join, so a busy client costs one row per day.
    """
    per_day = ads.groupBy("client_union_id", "date").agg(F.count(F.lit(1)).alias("events"))
    joined = clients.join(per_day, "client_union_id")
    gap = F.abs(days_between(F.col("create_date"), F.col("date")))
    return joined.groupBy(F.col("create_date").alias("created"), gap.alias("diff")).agg(
        F.sum("events").alias("events")
    )


def first_ad_gap(clients: DataFrame, ads: DataFrame) -> DataFrame:
    """Least, mean and most days from client creation to the client's first ad event."""
    first_ad = ads.groupBy("client_union_id").agg(F.min("time").alias("first_time"))
    gap = F.abs(days_between(F.col("create_date"), F.col("first_time"))).alias("diff")
    gaps = clients.join(first_ad, "client_union_id").select(gap)
    return gaps.agg(
        F.min("diff").alias("min_diff"),
        F.round(F.avg("diff"), 0).alias("avg_diff"),
        F.max("diff").alias("max_diff"),
    )

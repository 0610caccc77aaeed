"""Registered queries that run single operators on the sales and event tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart.functions.numbers import exact_mean, ratio, rounded
from joulemart.operators.distribution import bin_of, box_summary, histogram_2d, marginals, value_counts
from joulemart.operators.latest import latest_per_key
from joulemart.operators.quantiles import box_of_values
from joulemart.operators.ranking import running_max
from joulemart.operators.reshape import pivot_fill
from joulemart.operators.shares import share_of_group, with_total
from joulemart.oracle import rnd
from joulemart.sources.certificate_rows import read_table

_MONEY = "decimal(18,2)"
_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's last event."""
    events = read_table(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", ["ts", "event_id"], ["event_id", "ts", "event_type", "value"])


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per value of a JSON property."""
    k = F.get_json_object("props", "$.k").cast("int")
    return read_table(spark, sf_dir, "events").groupBy(k.alias("k")).agg(F.count("*").alias("n"))


def events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days as rows, event types as columns."""
    counts = read_table(spark, sf_dir, "events").groupBy(
        F.to_date("ts").alias("day"), "event_type"
    ).agg(F.count("*").alias("n"))
    return pivot_fill(counts, "day", "event_type", {"n_": "n"}, _EVENT_TYPES)


def sales_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity and quantity-weighted price per flag and status, with totals."""
    quantity = F.col("l_quantity").cast(_MONEY)
    price = F.col("l_extendedprice").cast(_MONEY)
    return read_table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(
        (2 - F.grouping("l_returnflag") - F.grouping("l_linestatus")).cast("int").alias("level"),
        F.sum(quantity).cast("double").alias("quantity"),
        rounded(
            F.sum(price * quantity).cast("double") / F.nullif(F.sum(quantity).cast("double"), F.lit(0.0)), 4
        ).alias("weighted_price"),
    )


def quantity_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-plot numbers of line quantities per return flag."""
    lines = read_table(spark, sf_dir, "lineitem")
    box = box_summary(value_counts(lines, "l_returnflag", "l_quantity"), "l_returnflag", "l_quantity")
    return box.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


def price_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-plot numbers of line prices, which are nearly all different, per return flag."""
    box = box_of_values(read_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice", rank_rows=2000)
    return box.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


def order_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest price up to each order, by ranges of the order key."""
    return running_max(read_table(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice", "best_so_far", pass_rows=1000)


def _price_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_2d(
        read_table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        bin_of(F.col("l_quantity"), 1, 5),
        bin_of(F.col("l_extendedprice"), 0, 5000),
    )


def price_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marginals(_price_density(spark, sf_dir), "l_returnflag")


def daily_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest order price up to each day."""
    orders = read_table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return running_max(orders, "day", "o_totalprice", "best_so_far")


def segment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per priority and its share of all revenue."""
    revenue = read_table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.sum(F.col("o_totalprice").cast(_MONEY)).alias("revenue")
    )
    whole = with_total(revenue, F.sum("revenue"), "whole")
    share = rounded(ratio(F.col("revenue"), F.col("whole")) * 100, 4)
    return whole.select("o_orderpriority", F.col("revenue").cast("double").alias("revenue"), share.alias("pct"))


def status_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each line status within its return flag."""
    counts = read_table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", share_of_group(F.col("n"), "l_returnflag", 4))


def mean_price_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean retail price per brand, for brands with enough parts."""
    price = F.col("p_retailprice").cast(_MONEY)
    groups = read_table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.count("*").alias("n"), exact_mean(price).alias("avg_price")
    )
    return groups.filter(F.col("n") > 10)


def _box_sql(column: str) -> str:
    return f"""with box as (
  select l_returnflag, cast(count(*) as bigint) as n_rows, min({column}) as min_value, max({column}) as max_value,
    quantile_cont({column}, 0.25) as q1, quantile_cont({column}, 0.5) as median, quantile_cont({column}, 0.75) as q3
  from lineitem group by 1),
ends as (
  select r.l_returnflag, min({column}) as lower_whisker, max({column}) as upper_whisker
  from lineitem r join box b on r.l_returnflag = b.l_returnflag
  where {column} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) group by 1)
select box.l_returnflag, n_rows, min_value, lower_whisker, round(q1, 4) as q1, round(median, 4) as median,
  round(q3, 4) as q3, upper_whisker, max_value,
  round(median - 1.57 * (q3 - q1) / sqrt(n_rows), 4) as notch_low,
  round(median + 1.57 * (q3 - q1) / sqrt(n_rows), 4) as notch_high
from box join ends on box.l_returnflag = ends.l_returnflag"""


# name -> (DataFrame query, SQL to check it against)
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "latest_per_key": (
        latest_event,
        """select user_id, event_id, ts, event_type, value from (
  select *, rank() over (partition by user_id order by ts desc, event_id desc) as place
  from events where user_id is not null) e where place = 1""",
    ),
    "json_path_access": (
        event_props,
        "select cast(json_extract_string(props, '$.k') as integer) as k, cast(count(*) as bigint) as n from events group by 1",
    ),
    "pivot_fill": (
        events_by_day,
        "select cast(ts as date) as day, "
        + ", ".join(
            f"cast(count(*) filter (where event_type = '{k}') as bigint) as n_{k}"
            for k in ("click", "error", "purchase", "signup", "view")
        )
        + " from events group by 1",
    ),
    "hierarchy_rollup": (
        sales_rollup,
        f"""with boxes as (
  select 2 as level, l_returnflag, l_linestatus, l_quantity, l_extendedprice from lineitem
  union all select 1, l_returnflag, null, l_quantity, l_extendedprice from lineitem
  union all select 0, null, null, l_quantity, l_extendedprice from lineitem)
select cast(level as integer) as level, l_returnflag, l_linestatus,
  cast(sum(cast(l_quantity as decimal(18, 2))) as double) as quantity,
  {rnd("cast(sum(cast(l_extendedprice as decimal(18, 2)) * cast(l_quantity as decimal(18, 2))) as double)"
       " / cast(sum(cast(l_quantity as decimal(18, 2))) as double)", 4)} as weighted_price
from boxes group by 1, 2, 3""",
    ),
    "five_number_summary": (quantity_box, _box_sql("l_quantity")),
    "five_number_continuous": (price_box, _box_sql("l_extendedprice")),
    "histogram_2d": (
        _price_density,
        """select l_returnflag, cast(floor((l_quantity - 1) / 5) as integer) as x_bin,
  cast(floor(l_extendedprice / 5000) as integer) as y_bin, cast(count(*) as bigint) as n
from lineitem group by 1, 2, 3""",
    ),
    "histogram_marginals": (
        price_marginals,
        """select 'x' as axis, l_returnflag, cast(floor((l_quantity - 1) / 5) as integer) as bin, cast(count(*) as bigint) as n
from lineitem group by 1, 2, 3
union all
select 'y', l_returnflag, cast(floor(l_extendedprice / 5000) as integer), cast(count(*) as bigint)
from lineitem group by 1, 2, 3""",
    ),
    "running_max": (
        daily_record,
        """select day, max(price) as o_totalprice, max(max(price)) over (order by day rows unbounded preceding) as best_so_far
from (select cast(o_orderdate as date) as day, o_totalprice as price from orders) o group by day""",
    ),
    "running_max_by_order": (
        order_record,
        """select o_orderkey, max(o_totalprice) as o_totalprice,
  max(max(o_totalprice)) over (order by o_orderkey rows unbounded preceding) as best_so_far from orders group by o_orderkey""",
    ),
    "cross_join_scalar": (
        segment_share,
        f"""select o_orderpriority, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as revenue,
  {rnd("cast(sum(cast(o_totalprice as decimal(18, 2))) as double)"
       " / (select cast(sum(cast(o_totalprice as decimal(18, 2))) as double) from orders) * 100", 4)} as pct
from orders group by 1""",
    ),
    "pct_of_partition": (
        status_share,
        f"""select l_returnflag, l_linestatus, cast(count(*) as bigint) as n,
  {rnd("cast(count(*) as double) / sum(count(*)) over (partition by l_returnflag) * 100", 4)} as pct
from lineitem group by 1, 2""",
    ),
    "having": (
        mean_price_by_brand,
        """select p_brand, cast(count(*) as bigint) as n,
  cast(sum(cast(p_retailprice as decimal(18, 2))) as double) / count(*) as avg_price
from part group by 1 having count(*) > 10""",
    ),
}

"""Domain tables of a private-bank book derived from the driver's TPC-H-like
tables, so every query runs over the whole given data and grows with it.

Mapping (fixed choice of this repository):
  account      = customer nation (``c_nationkey``); client = customer
  instrument   = part brand (``p_brand``) for the book, part key for the register
  venue        = ``'XV' || l_suppkey % 4``
  trades       = line items with line status F; transfers = line status O
  side / dir.  = return flag R -> SELL / OUT, else BUY / IN
  calendar     = every day between the first and last ship date; open on
                 weekdays except 1 Jan and 25 Dec
  currency     = nation key, 0 is the base currency (EUR)

Each stand-in exists twice: a DataFrame builder (used by the library and the
Spark queries) and the equivalent DuckDB SQL (used only by the oracle).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkbook.operators import calendar as cal
from sparkbook.session import materialise

# Closing days (month, day) of the stand-in exchange calendar.
CLOSING_MONTH_DAYS = [(1, 1), (12, 25)]
# Register record types in the order of their numeric code.
RECORD_TYPES = ["NEW", "MODFD", "TERMNTD", "CANC"]
REGISTER_BASE_DATE = "1998-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their account (nation), client and instrument (brand)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    # orders is as large as the facts: shuffle join. customer and part are
    # dimensions: the planner broadcasts them only when their measured size
    # (file statistics, then AQE's runtime shuffle statistics) is under the
    # broadcast threshold, with no extra counting job
    x = li.join(o, li.l_orderkey == o.o_orderkey)
    x = x.join(c, F.col("o_custkey") == c.c_custkey).join(p, li.l_partkey == p.p_partkey)
    return x.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
        F.col("c_nationkey").cast("bigint").alias("account_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("p_brand").alias("isin"),
        F.concat(F.lit("XV"), (F.col("l_suppkey") % 4).cast("string")).alias("trading_venue_mic"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("gross_consideration"),
        F.col("p_retailprice").cast("decimal(18,4)").alias("price"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_of(book_lines(spark, sf_dir))


def trades_of(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("linestatus") == "F").select(
        F.col("line_id").alias("trade_id"),
        F.col("ship_date").alias("trade_date"),
        "account_id", "isin", "trading_venue_mic",
        F.when(F.col("returnflag") == "R", "SELL").otherwise("BUY").alias("trade_side"),
        "quantity", "price", "gross_consideration",
    )


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfers_of(book_lines(spark, sf_dir))


def transfers_of(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("linestatus") == "O").select(
        F.col("line_id").alias("transfer_id"),
        F.col("ship_date").alias("transfer_date"),
        "account_id", "isin", "trading_venue_mic",
        F.when(F.col("returnflag") == "R", "OUT").otherwise("IN").alias("transfer_direction"),
        "quantity",
    )


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movements_of(book_lines(spark, sf_dir))


def movements_of(lines: DataFrame) -> DataFrame:
    """Trades and transfers in one pass: sign and kind by the line's flag and status, where two feeds would be ``position_movements``."""
    trade = F.col("linestatus") == "F"
    return lines.filter(F.col("linestatus").isin("F", "O")).select(
        "account_id", "isin", "trading_venue_mic", F.col("ship_date").alias("movement_date"),
        F.when(F.col("returnflag") == "R", -F.col("quantity")).otherwise(F.col("quantity")).alias("quantity_delta"),
        F.when(trade, "TRADE").otherwise("TRANSFER").alias("movement_type"), F.col("line_id").alias("movement_id"))


def bounded_calendar(days: DataFrame, day: str) -> DataFrame:
    """Every day between the first and the last of ``days``; nothing runs until it is used."""
    bounds = days.agg(F.min(F.col(day).cast("date")).alias("start_date"), F.max(F.col(day).cast("date")).alias("end_date"))
    return cal.trading_calendar(bounds, closing_month_days=CLOSING_MONTH_DAYS)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_calendar(table(spark, sf_dir, "lineitem").select("l_shipdate"), "l_shipdate")


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.dim_dates(calendar(spark, sf_dir))


def convention(brand: str = "isin") -> Column:
    """Price convention by brand parity: even brands quote in percent of par."""
    return F.when(F.substring(brand, 7, 10).cast("int") % 2 == 0, "percent_of_par").otherwise("per_unit")


def _prints(tops: DataFrame) -> DataFrame:
    return tops.select(
        "isin", "business_date", "price",
        F.lit("EUR").alias("price_currency"),
        F.lit("simulated").alias("price_source"),
        convention().alias("price_convention"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One print per (brand, ship day) with shipments: the day's largest gross."""
    return prices_of(book_lines(spark, sf_dir))


def prices_of(lines: DataFrame) -> DataFrame:
    return _prints(lines.groupBy("isin", F.col("ship_date").alias("business_date")).agg(
        F.max("gross_consideration").cast("decimal(18,4)").alias("price")))


@dataclass(frozen=True)
class Book:
    """What the position book is made of, all read from one small table per
    (account, instrument, day) that a single pass over the facts has written."""

    movements: DataFrame
    calendar: DataFrame
    dates: DataFrame
    prices: DataFrame


def book(spark: SparkSession, sf_dir: str) -> Book:
    b = book_lines(spark, sf_dir)
    moves = F.col("linestatus").isin("F", "O")
    signed = F.when(F.col("returnflag") == "R", -F.col("quantity")).otherwise(F.col("quantity"))
    days = materialise(b.groupBy("account_id", "isin", F.col("ship_date").alias("movement_date")).agg(
        F.sum(F.when(moves, signed)).alias("quantity_delta"), F.max("gross_consideration").alias("top_gross")), "book-days")
    spine = bounded_calendar(days.select("movement_date"), "movement_date")
    tops = days.groupBy("isin", F.col("movement_date").alias("business_date")).agg(F.max("top_gross").cast("decimal(18,4)").alias("price"))
    moved = days.filter(F.col("quantity_delta").isNotNull()).select("account_id", "isin", "movement_date", "quantity_delta")
    return Book(moved, spine, cal.dim_dates(spine), _prints(tops))


def brand_register_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioning events of the brand-level instrument register: a base
    version per brand, then a new version at each brand's first shipment of
    every year (nominal = smallest part size shipped that year)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    base = p.groupBy(F.col("p_brand").alias("isin")).agg(F.lit(100).cast("decimal(18,5)").alias("nominal_value_per_unit")).select(
        "isin", F.lit("XOFF").alias("trading_venue_mic"), F.lit("BASE").alias("version_source"),
        F.to_date(F.lit("1960-01-01")).alias("effective_date"), F.lit(0).cast("bigint").alias("record_sequence"),
        "nominal_value_per_unit", F.lit(1).cast("decimal(18,5)").alias("price_multiplier"),
    )
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate")
    yearly = li.join(p, li.l_partkey == p.p_partkey).groupBy(
        F.col("p_brand").alias("isin"), F.year("l_shipdate").alias("yr")
    ).agg(F.min("l_shipdate").cast("date").alias("effective_date"), F.min("p_size").alias("min_size"))
    deltas = yearly.select(
        "isin", F.lit("XOFF").alias("trading_venue_mic"), F.lit("MODFD").alias("version_source"),
        "effective_date", F.lit(1).cast("bigint").alias("record_sequence"),
        F.col("min_size").cast("decimal(18,5)").alias("nominal_value_per_unit"),
        (F.col("yr") % 3 + 1).cast("decimal(18,5)").alias("price_multiplier"),
    )
    return base.unionByName(deltas)


def register_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("isin"),
        (F.col("p_partkey") % 4).alias("trading_venue_mic"),
        F.lit("BASE").alias("version_source"),
        F.to_date(F.lit("1960-01-01")).alias("effective_date"),
        F.lit(0).cast("bigint").alias("record_sequence"),
        F.lit("base").alias("source_file"),
        F.col("p_name").alias("instrument_full_name"),
    )


def register_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily register deltas, one per (part, venue, day): the record type and
    sequence come from the day's highest line code."""
    li = table(spark, sf_dir, "lineitem")
    code = (
        F.when(F.col("l_orderkey") % 97 == 0, 3)
        .when(F.col("l_returnflag") == "N", 0)
        .when(F.col("l_returnflag") == "A", 1)
        .otherwise(2)
    )
    e = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10 + code
    g = li.groupBy(
        F.col("l_partkey").alias("isin"),
        (F.col("l_suppkey") % 4).alias("trading_venue_mic"),
        F.col("l_shipdate").cast("date").alias("effective_date"),
    ).agg(F.max(e).alias("e"))
    types = F.array(*[F.lit(t) for t in RECORD_TYPES])
    return g.select(
        "isin", "trading_venue_mic",
        F.element_at(types, (F.col("e") % 10 + 1).cast("int")).alias("version_source"),
        "effective_date",
        F.floor(F.col("e") / 10).cast("bigint").alias("record_sequence"),
        F.concat(F.lit("delta_"), F.date_format("effective_date", "yyyyMMdd")).alias("source_file"),
        F.concat(F.lit("part "), F.col("isin").cast("string"), F.lit(" v"), F.col("record_sequence").cast("string")).alias(
            "instrument_full_name"
        ),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse per-currency reference rates (units per base-currency unit)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    x = o.join(c, o.o_custkey == c.c_custkey).filter(F.col("c_nationkey") != 0)
    return x.groupBy(
        F.col("c_nationkey").cast("bigint").alias("currency"), F.col("o_orderdate").cast("date").alias("rate_date")
    ).agg((F.max("o_totalprice") / 100000).alias("units_per_eur"))


def fx_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    x = o.join(c, o.o_custkey == c.c_custkey)
    return x.select(
        F.col("o_orderkey").alias("fx_trade_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("c_nationkey").cast("bigint").alias("sell_currency"),
        ((F.col("c_nationkey") + 7) % 25).cast("bigint").alias("buy_currency"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("buy_amount"),
        F.col("o_orderdate").cast("date").alias("trade_date"),
        (F.col("o_orderkey") % 50).cast("decimal(9,4)").alias("margin_bp"),
    )


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("client_id"),
        (F.col("o_orderkey") % 6).alias("rm_id"),
        F.col("o_orderdate").cast("date").alias("assigned_date"),
        F.col("o_orderkey").alias("tie"),
    )


def cash_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    signed = F.when(F.col("event_type").isin("purchase", "error"), -F.col("value")).otherwise(F.col("value"))
    return ev.select(
        F.col("user_id").alias("account_id"),
        "event_id",
        F.col("ts").cast("date").alias("event_date"),
        "event_type",
        signed.cast("decimal(18,2)").alias("amount"),
    )


def dirty_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    m = F.col("p_size") % 10
    raw = (
        F.when(m == 0, F.lit("9999-12-31T00:00:00Z"))
        .when(m == 1, F.lit("1900-01-01"))
        .when(m == 2, F.lit("n/a"))
        .when(m == 3, F.lit(""))
        .when(m == 4, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("20"), (F.col("p_size") % 50 + 10).cast("string"), F.lit("-06-15T22:00:00Z")))
    )
    return p.select(F.col("p_partkey").alias("id"), raw.alias("raw"))


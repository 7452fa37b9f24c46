"""Session context of tickers from their daily bars: last bar, returns over bars, volatility of daily returns.

Returns and volatility are windows over a ticker's bars (bounded by the calendar), computed once for all sessions; sessions then take the last bar at
or before their day from a sorted union of bars and sessions, so there is one shuffle on the ticker and no range join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import keys as K
from quillstone.operators.merge import last_per_key

HORIZONS = (1, 5, 20)
LOOKBACK_DAYS = 60


def bars(df: DataFrame) -> DataFrame:
    """One bar per (ticker, price_date) with a close, the last ingested."""
    rows = df.select(K.ticker("ticker").alias("ticker"), "price_date", "close", "volume", "ingested_at").filter("close is not null")
    return last_per_key(rows, ["ticker", "price_date"], ["ingested_at"]).drop("ingested_at")


def measures(daily: DataFrame) -> DataFrame:
    """Bars with, per horizon k, ``ret_k`` and the day it reaches back to, and ``vol_20`` with its own; null where bars are missing or a divisor is 0."""
    by_day = Window.partitionBy("ticker").orderBy("price_date")
    x = daily.withColumn("x", F.col("close").cast("double"))
    for k in HORIZONS:
        before = F.lag("x", k).over(by_day)
        x = x.withColumns({f"ret_{k}": F.when(before != 0, F.col("x") / before - 1), f"back_{k}": F.lag("price_date", k).over(by_day)})
    last20 = by_day.rowsBetween(-19, 0)
    vol = F.when((F.count("x").over(by_day.rowsBetween(-20, 0)) == 21) & (F.count("ret_1").over(last20) >= 2), F.stddev_samp("ret_1").over(last20))
    return x.withColumn("vol_20", vol).drop("x")


def context(sessions: DataFrame, daily: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """``sessions`` has distinct (trading_date, ticker, ...). Adds the last bar within the look-back and the measures that lie wholly within it; a session
    without bars keeps its row with nulls."""
    known = measures(daily)
    values = [c for c in known.columns if c != "ticker"]
    others = [c for c in sessions.columns if c not in ("ticker", "trading_date")]
    left = sessions.select("ticker", F.col("trading_date").alias("__day"), F.lit(1).alias("__turn"), F.struct("trading_date", *others).alias("__session"), F.lit(None).cast(known.select(F.struct(*values).alias("b")).schema["b"].dataType).alias("__bar"))
    right = known.select("ticker", F.col("price_date").alias("__day"), F.lit(0).alias("__turn"), F.lit(None).cast(left.schema["__session"].dataType).alias("__session"), F.struct(*values).alias("__bar"))
    upto = Window.partitionBy("ticker").orderBy("__day", "__turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = left.unionByName(right).withColumn("b", F.last("__bar", ignorenulls=True).over(upto)).filter("__session is not null")
    start = F.date_sub("__session.trading_date", lookback_days)
    near = F.col("b.price_date") >= start
    out = joined.select("ticker", "__session.*", *[F.when(near, F.col(f"b.{c}")).alias(c) for c in ("price_date", "close", "volume")], *[F.when(near & (F.col(f"b.back_{k}") >= start), F.round(f"b.ret_{k}", 8)).alias(f"ret_{k}d") for k in HORIZONS], F.when(near & (F.col("b.back_20") >= start), F.round("b.vol_20", 8)).alias("vol_20d"))
    return out.withColumnRenamed("price_date", "bar_date")

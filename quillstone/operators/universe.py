"""Session membership: groups, entrants, lookups. Sessions are as many as calendar days, which bounds every per-session step."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import filings as X
from quillstone.functions import keys as K


#: Characters of a dead letter's message that are kept.
MESSAGE = 500


def members(df: DataFrame) -> DataFrame:
    """Distinct (trading_date, ticker, universe_group, cik) in normal form."""
    return df.select("trading_date", K.ticker("ticker").alias("ticker"), K.group_name("universe_group").alias("universe_group"), "cik").distinct()


def single_group(df: DataFrame) -> DataFrame:
    """(trading_date, ticker, universe_group): the group if it is the only one of that session, else null."""
    groups = df.groupBy("trading_date", "ticker").agg(F.min("universe_group").alias("lo"), F.max("universe_group").alias("hi"))
    return groups.select("trading_date", "ticker", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("universe_group"))


def ticker_metadata(df: DataFrame) -> DataFrame:
    """(ticker, first_session, universe_group): the first session and the group if exactly one is known over all sessions."""
    by_day = single_group(df)
    return by_day.groupBy("ticker").agg(F.min("trading_date").alias("first_session"), F.min("universe_group").alias("lo"), F.max("universe_group").alias("hi")).select("ticker", "first_session", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("universe_group"))


def entrants(df: DataFrame) -> DataFrame:
    """(trading_date, universe_group, ticker) of tickers that the group did not have in the session before; the first session has none."""
    rows = df.select("trading_date", "universe_group", "ticker").distinct()
    days = rows.select("trading_date").distinct()
    steps = days.select("trading_date", F.lag("trading_date").over(Window.orderBy("trading_date")).alias("before")).filter("before is not null")
    now = rows.join(steps, "trading_date")
    old = rows.select(F.col("trading_date").alias("before"), "universe_group", "ticker")
    return now.join(old, ["before", "universe_group", "ticker"], "left_anti").select("trading_date", "universe_group", "ticker")


def in_scope(filings: DataFrame, universe: DataFrame) -> DataFrame:
    """Filings whose cik or ticker the universe has: a flag from each of two equi-joins and one filter, instead of a join with OR, which would be a nested
    loop. Filings are read once."""
    ciks = universe.select(F.col("cik").alias("__cik")).filter("__cik is not null").distinct().withColumn("__by_cik", F.lit(True))
    tickers = universe.select(F.upper(F.trim("ticker")).alias("__ticker")).filter("__ticker is not null").distinct().withColumn("__by_ticker", F.lit(True))
    flagged = filings.withColumn("__ticker", F.upper(F.trim(F.coalesce("issuer_ticker", F.lit(""))))).withColumn("__cik", F.col("issuer_cik"))
    both = flagged.join(ciks, "__cik", "left").join(tickers, "__ticker", "left").filter("__by_cik or __by_ticker")
    return both.select(*filings.columns)


def session_tickers(df: DataFrame, day: str | None = None, group: str | None = None) -> DataFrame:
    """(ticker, universe_group) of a session, the last one if no day is given, in order of ticker, or of group and ticker where no group is asked."""
    wanted = F.lit(day).cast("date") if day else df.agg(F.max("trading_date").alias("d")).select("d").scalar()
    rows = df.filter(F.col("trading_date") == wanted).select("ticker", "universe_group").distinct()
    name = (group or "").strip().lower()
    return rows.filter(F.col("universe_group") == name).orderBy("ticker") if name else rows.orderBy("universe_group", "ticker")


def lookup_cik(tickers: DataFrame, ciks: DataFrame) -> DataFrame:
    """``tickers`` with the cik of the ticker itself, else of its spelling with dashes, else with dots. ``ciks`` has one row per ticker.

    One left join on exploded spellings and a map-side combined minimum, not three joins."""
    rows = tickers.select("ticker").distinct()
    spelled = rows.select("ticker", F.posexplode(F.array("ticker", F.translate("ticker", ".", "-"), F.translate("ticker", "-", "."))).alias("turn", "key"))
    known = ciks.select(F.col("ticker").alias("key"), "cik")
    found = spelled.join(known, "key", "left").filter("cik is not null").groupBy("ticker").agg(F.min(F.struct("turn", "cik"))["cik"].alias("cik"))
    return rows.join(found, "ticker", "left")


def screen_members(lines: DataFrame) -> DataFrame:
    """(trading_date, universe_group, ticker, line_no) of screen files: the date and group of the file's name, first mention of each probable ticker above
    the footer."""
    from quillstone.operators.parsefail import FOOTER

    rows = lines.select("file_name", "line_no", "c0")
    ends = rows.filter(F.col("c0").rlike(FOOTER)).groupBy("file_name").agg(F.min("line_no").alias("end"))  # one row per file
    body = rows.join(ends, "file_name", "left").filter("end is null or line_no < end").filter(~F.col("c0").rlike(r'(?i)^[\x{FEFF}\s]*"?symbol"?\s*(,|$)'))
    name = F.lower("file_name")
    first = F.from_csv("c0", "symbol string", {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})["symbol"]
    out = body.select(
        F.try_to_date(F.regexp_extract(name, r"([0-9]{2}-[0-9]{2}-[0-9]{4})\.csv$", 1), "MM-dd-yyyy").alias("trading_date"),
        F.when(name.contains("highs"), "high").when(name.contains("lows"), "low").alias("universe_group"), F.upper(X.strip(first)).alias("ticker"), "line_no",
    )
    return out.filter(X.probable_ticker("ticker") & F.col("trading_date").isNotNull() & F.col("universe_group").isNotNull()).groupBy("trading_date", "universe_group", "ticker").agg(F.min("line_no").alias("line_no"))


def backfill_plan(new: DataFrame, members_df: DataFrame, lookback_days: int) -> DataFrame:
    """(cik, first_day, last_day) to fetch for entrants: from ``lookback_days`` (1 to 3,650) before their first session as entrants to that session."""
    days = max(1, min(3650, lookback_days))
    ciks = members_df.filter("cik is not null").select("trading_date", "ticker", "cik").distinct()
    first = new.select("trading_date", "ticker").distinct().join(ciks, ["trading_date", "ticker"]).groupBy("cik").agg(F.min("trading_date").alias("last_day"))
    return first.select("cik", F.date_sub("last_day", days).alias("first_day"), "last_day")


def calendar(plan: DataFrame) -> DataFrame:
    """One row per cik and day of a plan (cik, first_day, last_day)."""
    return plan.select("cik", F.explode(F.sequence("first_day", "last_day")).alias("day"))


def dead_letters(df: DataFrame, stage: str, kind, message, payload_columns: list[str], created_at) -> DataFrame:
    """Rows of a dead-letter table: (id, accession_number, stage, error_type, message, payload, created_at); messages are cut at 500 characters as stored."""
    return df.select(F.expr("uuid()").alias("id"), "accession_number", F.lit(stage).alias("stage"), kind.alias("error_type"), F.left(message, F.lit(MESSAGE)).alias("message"), F.to_json(F.struct(*payload_columns)).alias("payload"), created_at.alias("created_at"))

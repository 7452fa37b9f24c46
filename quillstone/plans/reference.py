"""Queries of filings, sessions, bars, merges, search and audits over the domain tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import filings as X
from quillstone.functions import keys as K
from quillstone.operators import embed, knn, market, merge, parsefail, universe
from quillstone.session import scratch
from quillstone.sources import landed
from quillstone.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# --- shared inputs: repeated rows are one row ----------------------------------------------------------------------------------------

_TX = ["accession_number", "transaction_index", "issuer_ticker", "transaction_category", "transaction_date", "transaction_code", "acquired_disposed_code", "shares", "price_per_share", "total_value", "direct_indirect"]
_FILING = ["accession_number", "document_type", "is_amendment", "issuer_cik", "issuer_name", "issuer_ticker", "insider_name", "insider_title"]


def _tx(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Distinct transactions; only the named columns besides the key are read."""
    keys = ["accession_number", "transaction_index"]
    return table(spark, sf, "form4_transaction").select(*keys, *[c for c in (columns or _TX) if c not in keys]).distinct()


def _filing(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return table(spark, sf, "filing").select("accession_number", *[c for c in (columns or _FILING) if c != "accession_number"]).distinct()


def _universe(spark: SparkSession, sf: str) -> DataFrame:
    return universe.members(table(spark, sf, "universe_snapshot"))


def _join(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.drop("issuer_ticker").join(b, "accession_number")


_S = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_BASE = """
WITH tx AS (SELECT DISTINCT accession_number, transaction_index, transaction_category, transaction_date::DATE AS transaction_date, transaction_code, acquired_disposed_code, shares, price_per_share, total_value, direct_indirect FROM form4_transaction)
, fl AS (SELECT DISTINCT accession_number, document_type, is_amendment, issuer_cik, issuer_name, issuer_ticker, insider_name, insider_title FROM filing)
, uni AS (SELECT DISTINCT trading_date::DATE AS trading_date, upper(trim(ticker, ' ' || chr(9))) AS ticker, lower(trim(universe_group, ' ' || chr(9))) AS universe_group, cik FROM universe_snapshot)
"""
_ACTION = f"""CASE coalesce(upper({_S.format('transaction_code')}), '') WHEN 'P' THEN 'open-market purchase' WHEN 'S' THEN 'open-market sale' WHEN 'A' THEN 'grant or award' WHEN 'M' THEN 'option exercise' WHEN 'G' THEN 'gift'
  ELSE CASE coalesce(upper({_S.format('acquired_disposed_code')}), '') WHEN 'A' THEN 'acquisition' WHEN 'D' THEN 'disposition'
  ELSE CASE WHEN coalesce({_S.format('transaction_code')}, '') <> '' THEN 'transaction code ' || upper({_S.format('transaction_code')}) ELSE 'insider transaction' END END END"""
_OWNED = f"CASE WHEN direct_indirect = '' THEN NULL WHEN lower({_S.format('direct_indirect')}) IN ('d', 'direct') THEN 'direct ownership' WHEN lower({_S.format('direct_indirect')}) IN ('i', 'indirect') THEN 'indirect ownership' ELSE 'ownership: ' || direct_indirect END"
_NUM = r"regexp_replace({0}::VARCHAR, '\.?0+$', '')"
_TEXT = f"""{_S.format(f'''replace('On ' || coalesce(strftime(transaction_date, '%Y-%m-%d'), 'an undisclosed date') || ', ' || {_S.format("coalesce(nullif(insider_name, ''), 'an insider')")}
  || CASE WHEN coalesce({_S.format('insider_title')}, '') <> '' THEN ', ' || {_S.format('insider_title')} || ',' ELSE '' END
  || ' at ' || {_S.format("coalesce(nullif(issuer_name, ''), 'the issuer')")} || CASE WHEN coalesce({_S.format('issuer_ticker')}, '') <> '' THEN ' (' || {_S.format('issuer_ticker')} || ')' ELSE '' END
  || ' reported a ' || {_ACTION} || CASE WHEN coalesce({_S.format('transaction_category')}, '') = 'derivative' THEN ' (derivative)' ELSE '' END || '.'
  || CASE WHEN shares IS NOT NULL AND price_per_share IS NOT NULL THEN ' Amount: ' || {_NUM.format('shares')} || ' shares at $' || {_NUM.format('price_per_share')} || ' per share.' || coalesce(' Total value about $' || {_NUM.format('total_value')} || '.', '')
          WHEN shares IS NOT NULL THEN ' Share amount: ' || {_NUM.format('shares')} || '; price per share not reported.'
          WHEN price_per_share IS NOT NULL THEN ' Price per share: $' || {_NUM.format('price_per_share')} || '; share amount not reported.'
          ELSE ' Share amount and price were not reported as scalars.' END
  || coalesce(' ' || ({_OWNED}) || '.', '')
  || CASE WHEN is_amendment THEN ' Filing is a Form 4/A amendment.' WHEN coalesce({_S.format('document_type')}, '') <> '' THEN ' Document type: ' || {_S.format('document_type')} || '.' ELSE '' END, '  ', ' ')''')}"""
_SCOPE = """
, scoped AS (SELECT * FROM fl WHERE issuer_cik IN (SELECT cik FROM uni WHERE cik IS NOT NULL) OR upper(trim(coalesce(issuer_ticker, ''))) IN (SELECT upper(trim(ticker)) FROM uni))
, daygroup AS (SELECT trading_date, ticker, CASE WHEN min(universe_group) = max(universe_group) THEN min(universe_group) END AS g FROM uni GROUP BY ALL)
, meta AS (SELECT ticker, min(trading_date) AS first_session, CASE WHEN min(g) = max(g) THEN min(g) END AS universe_group FROM daygroup GROUP BY ticker)
"""

# --- text chunks -------------------------------------------------------------------------------------------------------------------


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    members = _universe(spark, sf)
    filings = universe.in_scope(_filing(spark, sf), members)
    rows = _join(_tx(spark, sf), filings).withColumn("text", X.narrative())
    meta = universe.ticker_metadata(members).withColumnRenamed("ticker", "__ticker")
    rows = rows.withColumn("__ticker", F.upper(X.strip("issuer_ticker"))).join(meta, "__ticker", "left")
    return rows.withColumns({"chunk_id": X.chunk_id("accession_number", "transaction_index"), "content_hash": X.content_hash("text")})


@query(_BASE + _SCOPE + f"""SELECT accession_number || ':' || transaction_index AS chunk_id, {_TEXT} AS text, sha256('1' || chr(10) || ({_TEXT})) AS content_hash, strftime(first_session, '%Y-%m-%d') AS first_session, meta.universe_group
FROM tx JOIN scoped USING (accession_number) LEFT JOIN meta ON meta.ticker = upper({_S.format('issuer_ticker')})""")
def chunk_text(spark, sf):
    """Chunks of the transactions whose issuer was on a screen: text, hash and session metadata."""
    return _chunks(spark, sf).select("chunk_id", "text", "content_hash", K.iso("first_session").alias("first_session"), "universe_group")


@query(f"""WITH ids AS (SELECT DISTINCT accession_number || ':' || transaction_index AS chunk_id FROM form4_transaction)
SELECT chunk_id, regexp_replace(chunk_id, ':[^:]*$', '') AS accession_number, regexp_extract(chunk_id, '([^:]*)$', 1)::INTEGER AS transaction_index, sha256('1' || chr(10) || chunk_id) AS content_hash FROM ids""")
def chunk_ids(spark, sf):
    """Chunk ids, taken apart again, with the versioned hash."""
    ids = table(spark, sf, "form4_transaction").select(X.chunk_id("accession_number", "transaction_index").alias("chunk_id")).distinct()
    return ids.select("chunk_id", F.regexp_replace("chunk_id", ":[^:]*$", "").alias("accession_number"), F.substring_index("chunk_id", ":", -1).cast("int").alias("transaction_index"), X.content_hash("chunk_id").alias("content_hash"))


@query(_BASE + _SCOPE + "SELECT ticker, strftime(first_session, '%Y-%m-%d') AS first_session, universe_group FROM meta")
def chunk_universe_meta(spark, sf):
    """First session and single group of each ticker."""
    return universe.ticker_metadata(_universe(spark, sf)).select("ticker", K.iso("first_session").alias("first_session"), "universe_group")


@query(_BASE + f"SELECT transaction_code, acquired_disposed_code, direct_indirect, {_ACTION} AS action, {_OWNED} AS owned, count(*) AS transactions FROM tx GROUP BY ALL")
def action_ownership_phrases(spark, sf):
    """Wording of each combination of codes."""
    rows = _tx(spark, sf, "transaction_category", "transaction_date", "transaction_code", "acquired_disposed_code", "shares", "price_per_share", "total_value", "direct_indirect").groupBy("transaction_code", "acquired_disposed_code", "direct_indirect").agg(F.count("*").alias("transactions"))
    return rows.select("transaction_code", "acquired_disposed_code", "direct_indirect", X.action_phrase("transaction_code", "acquired_disposed_code").alias("action"), X.ownership_phrase("direct_indirect").alias("owned"), "transactions")


@query("""SELECT DISTINCT accession_number, transaction_index, CASE WHEN transaction_category = 'non_derivative' AND coalesce(len(footnote_ids), 0) = 0 THEN (shares * price_per_share)::DECIMAL(28,4) END AS computed, total_value AS stated FROM form4_transaction""")
def tx_total_value(spark, sf):
    """Total value recomputed exactly, next to the stated one."""
    rows = table(spark, sf, "form4_transaction")
    return rows.select("accession_number", "transaction_index", X.total_value("transaction_category", "shares", "price_per_share", "footnote_ids").alias("computed"), F.col("total_value").alias("stated")).distinct()


@query(_BASE + ", ids AS (SELECT DISTINCT accession_number, transaction_index FROM tx) SELECT accession_number, min(transaction_index) AS lo, max(transaction_index) AS hi, count(*) AS n, min(transaction_index) = 0 AND max(transaction_index) = count(*) - 1 AS dense FROM ids GROUP BY ALL")
def tx_dense_index(spark, sf):
    """Whether the indexes of each filing run from 0 without a hole."""
    rows = table(spark, sf, "form4_transaction").select("accession_number", "transaction_index").distinct()
    g = rows.groupBy("accession_number").agg(F.min("transaction_index").alias("lo"), F.max("transaction_index").alias("hi"), F.count("*").alias("n"))
    return g.withColumn("dense", (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1))


# --- sessions ----------------------------------------------------------------------------------------------------------------------


@query(_BASE + _SCOPE + "SELECT strftime(trading_date, '%Y-%m-%d') AS trading_date, ticker, g AS universe_group FROM daygroup")
def universe_single_group(spark, sf):
    """Group of a ticker in a session if it has only one."""
    return universe.single_group(_universe(spark, sf)).select(K.iso("trading_date").alias("trading_date"), "ticker", "universe_group")


@query(_BASE + "SELECT strftime(trading_date, '%Y-%m-%d') AS trading_date, ticker, count(DISTINCT universe_group) AS universe_groups FROM uni GROUP BY ALL HAVING count(DISTINCT universe_group) > 1")
def universe_ambiguous(spark, sf):
    """Tickers on more than one list of a session."""
    rows = _universe(spark, sf).select("trading_date", "ticker", "universe_group").distinct()
    return rows.groupBy("trading_date", "ticker").agg(F.count("*").alias("universe_groups")).filter("universe_groups > 1").withColumn("trading_date", K.iso("trading_date"))


@query("SELECT strftime(max(trading_date), '%Y-%m-%d') AS trading_date FROM universe_snapshot")
def latest_session(spark, sf):
    return table(spark, sf, "universe_snapshot").agg(F.max("trading_date").alias("d")).select(K.iso("d").alias("trading_date"))


@query("SELECT strftime(d, '%Y-%m-%d') AS trading_date FROM (SELECT DISTINCT trading_date AS d FROM universe_snapshot ORDER BY d DESC LIMIT 30)")
def recent_sessions(spark, sf):
    """The last 30 sessions; the limit is the report."""
    return table(spark, sf, "universe_snapshot").select("trading_date").distinct().orderBy(F.desc("trading_date")).limit(30).select(K.iso("trading_date").alias("trading_date"))


@query(_BASE + "SELECT DISTINCT strftime(trading_date, '%Y-%m-%d') AS trading_date, universe_group, ticker, dense_rank() OVER (PARTITION BY trading_date, universe_group ORDER BY ticker)::INTEGER AS place FROM uni")
def tickers_by_session(spark, sf):
    """The tickers of each list in order, a row each; an array would grow with the universe."""
    rows = _universe(spark, sf).select("trading_date", "universe_group", "ticker").distinct()
    place = F.row_number().over(Window.partitionBy("trading_date", "universe_group").orderBy("ticker"))
    return rows.select(K.iso("trading_date").alias("trading_date"), "universe_group", "ticker", place.alias("place"))


@query(_BASE + "SELECT ticker, min(universe_group) AS first_group FROM uni WHERE trading_date = (SELECT max(trading_date) FROM uni) AND universe_group = 'high' GROUP BY ticker ORDER BY ticker")
def session_tickers(spark, sf):
    """The last session's tickers of one list, as an optional filter gives them."""
    return universe.session_tickers(_universe(spark, sf), None, "HIGH ").select("ticker", F.col("universe_group").alias("first_group"))


_ENTRANTS = _BASE + """
, days AS (SELECT trading_date, lag(trading_date) OVER (ORDER BY trading_date) AS before FROM (SELECT DISTINCT trading_date FROM uni))
, ent AS (SELECT DISTINCT u.trading_date, u.universe_group, u.ticker FROM uni u JOIN days d ON d.trading_date = u.trading_date AND before IS NOT NULL
          WHERE NOT EXISTS (SELECT 1 FROM uni o WHERE o.trading_date = d.before AND o.universe_group = u.universe_group AND o.ticker = u.ticker))
"""


@query(_ENTRANTS + "SELECT strftime(trading_date, '%Y-%m-%d') AS trading_date, universe_group, ticker FROM ent")
def new_entrants(spark, sf):
    """Tickers new to a list since the session before."""
    return universe.entrants(_universe(spark, sf)).withColumn("trading_date", K.iso("trading_date"))


@query(_ENTRANTS + "SELECT DISTINCT strftime(trading_date, '%Y-%m-%d') AS trading_date, cik FROM ent JOIN uni USING (trading_date, ticker) WHERE cik IS NOT NULL")
def entrant_ciks(spark, sf):
    """Ciks of each session's entrants."""
    members = _universe(spark, sf)
    return members.filter("cik is not null").join(universe.entrants(members).select("trading_date", "ticker").distinct(), ["trading_date", "ticker"], "left_semi").select(K.iso("trading_date").alias("trading_date"), "cik").distinct()


@query(_BASE + "SELECT ticker, max(cik) AS cik FROM uni GROUP BY ticker")
def representative_cik(spark, sf):
    return _universe(spark, sf).groupBy("ticker").agg(F.max("cik").alias("cik"))


@query(_BASE + """, known AS (SELECT upper(trim(ticker, ' ' || chr(9))) AS t, max(cik) AS cik FROM security_master WHERE cik IS NOT NULL GROUP BY 1), asked AS (SELECT DISTINCT upper(trim(issuer_ticker, ' ' || chr(9))) AS ticker FROM filing WHERE issuer_ticker IS NOT NULL)
SELECT ticker, coalesce(a.cik, b.cik, c.cik) AS cik FROM asked LEFT JOIN known a ON a.t = ticker LEFT JOIN known b ON b.t = replace(ticker, '.', '-') LEFT JOIN known c ON c.t = replace(ticker, '-', '.')""")
def ticker_cik_lookup(spark, sf):
    """Cik of each filed ticker, by its spellings."""
    known = table(spark, sf, "security_master").filter("cik is not null").groupBy(K.ticker("ticker").alias("ticker")).agg(F.max("cik").alias("cik"))
    asked = table(spark, sf, "filing").filter("issuer_ticker is not null").select(K.ticker("issuer_ticker").alias("ticker"))
    return universe.lookup_cik(asked, known)


@query(_BASE + "SELECT DISTINCT strftime(trading_date, '%Y-%m-%d') AS trading_date, ticker FROM uni")
def universe_union(spark, sf):
    """Both lists of a session as one set."""
    rows = _universe(spark, sf)
    high, low = (rows.filter(F.col("universe_group") == g).select("trading_date", "ticker") for g in ("high", "low"))
    return high.union(low).distinct().withColumn("trading_date", K.iso("trading_date"))


@query(_BASE + "SELECT strftime(trading_date, '%Y-%m-%d') AS trading_date, universe_group, count(*) AS n, count(cik) AS with_cik FROM uni GROUP BY ALL")
def session_cik_counts(spark, sf):
    return _universe(spark, sf).groupBy("trading_date", "universe_group").agg(F.count("*").alias("n"), F.count("cik").alias("with_cik")).withColumn("trading_date", K.iso("trading_date"))


@query("""WITH ends AS (SELECT file_name, min(line_no) AS e FROM screen_line WHERE regexp_matches(lower(c0), '^[\\s"]*downloaded from\\b') GROUP BY 1)
, body AS (SELECT s.file_name, line_no, upper(regexp_replace(CASE WHEN regexp_matches(c0, '^[ \\t]*"') THEN replace(regexp_extract(c0, '^[ \\t]*"((?:[^"]|"")*)"?', 1), '""', '"') ELSE regexp_extract(c0, '^([^,]*)', 1) END, '^\\s+|\\s+$', '', 'g')) AS ticker
  FROM screen_line s LEFT JOIN ends USING (file_name) WHERE (e IS NULL OR line_no < e) AND NOT regexp_matches(lower(c0), '^[\\x{FEFF}\\s]*"?symbol"?\\s*(,|$)'))
SELECT strftime(strptime(regexp_extract(file_name, '([0-9]{2}-[0-9]{2}-[0-9]{4})[.]csv$', 1), '%m-%d-%Y'), '%Y-%m-%d') AS trading_date, CASE WHEN contains(lower(file_name), 'highs') THEN 'high' ELSE 'low' END AS universe_group, ticker, min(line_no) AS line_no
FROM body WHERE regexp_full_match(ticker, '[A-Z][A-Z0-9.\\-]{0,9}') GROUP BY ALL""")
def screen_universe(spark, sf):
    """Members of each screen file, in order of first mention above its footer."""
    return universe.screen_members(table(spark, sf, "screen_line")).withColumn("trading_date", K.iso("trading_date"))


# --- market context ----------------------------------------------------------------------------------------------------------------

_BARS = """
WITH bars AS (SELECT upper(trim(ticker, ' ' || chr(9))) AS ticker, price_date::DATE AS d, close, volume FROM security_daily_prices WHERE close IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY upper(trim(ticker, ' ' || chr(9))), price_date ORDER BY ingested_at DESC, close DESC, volume DESC NULLS LAST) = 1)
, r1 AS (SELECT *, CASE WHEN lag(close) OVER w <> 0 THEN close::DOUBLE / lag(close::DOUBLE) OVER w - 1 END AS r FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY d))
, m AS (SELECT ticker, d, close, volume, r AS ret_1, lag(d) OVER w AS b1, CASE WHEN lag(close, 5) OVER w <> 0 THEN close::DOUBLE / lag(close::DOUBLE, 5) OVER w - 1 END AS ret_5, lag(d, 5) OVER w AS b5,
   CASE WHEN lag(close, 20) OVER w <> 0 THEN close::DOUBLE / lag(close::DOUBLE, 20) OVER w - 1 END AS ret_20, lag(d, 20) OVER w AS b20,
   CASE WHEN count(*) OVER (PARTITION BY ticker ORDER BY d ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) = 21 AND count(r) OVER (PARTITION BY ticker ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) >= 2
        THEN stddev_samp(r) OVER (PARTITION BY ticker ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END AS vol_20 FROM r1 WINDOW w AS (PARTITION BY ticker ORDER BY d))
"""


@query(_BARS + "SELECT ticker, strftime(d, '%Y-%m-%d') AS price_date, round(ret_1, 8) AS ret_1, round(ret_5, 8) AS ret_5, round(ret_20, 8) AS ret_20, round(vol_20, 8) AS vol_20 FROM m")
def bar_returns(spark, sf):
    """Returns over 1, 5 and 20 bars and the volatility of 20 daily returns, per bar."""
    m = market.measures(market.bars(table(spark, sf, "security_daily_prices")))
    return m.select("ticker", K.iso("price_date").alias("price_date"), *[F.round(c, 8).alias(c) for c in ("ret_1", "ret_5", "ret_20", "vol_20")])


@query(_BARS + """, s AS (SELECT trading_date::DATE AS day, upper(trim(ticker, ' ' || chr(9))) AS ticker, max(lower(trim(universe_group, ' ' || chr(9))) = 'high') AS is_high, max(cik) AS cik FROM universe_snapshot GROUP BY 1, 2)
SELECT strftime(s.day, '%Y-%m-%d') AS trading_date, CASE WHEN is_high THEN 'high' ELSE 'low' END AS universe_group, s.ticker, s.cik, strftime(m.d, '%Y-%m-%d') AS bar_date, m.close, m.volume,
  CASE WHEN b1 >= s.day - 60 THEN round(ret_1, 8) END AS ret_1d, CASE WHEN b5 >= s.day - 60 THEN round(ret_5, 8) END AS ret_5d, CASE WHEN b20 >= s.day - 60 THEN round(ret_20, 8) END AS ret_20d, CASE WHEN b20 >= s.day - 60 THEN round(vol_20, 8) END AS vol_20d
FROM s LEFT JOIN (SELECT s.day, s.ticker, max(bars.d) AS d FROM s JOIN bars ON bars.ticker = s.ticker AND bars.d <= s.day AND bars.d >= s.day - 60 GROUP BY ALL) l ON l.day = s.day AND l.ticker = s.ticker LEFT JOIN m ON m.ticker = s.ticker AND m.d = l.d""")
def market_context(spark, sf):
    """Every session's tickers with their last bar and measures within 60 days; on both lists counts as high."""
    sessions = _universe(spark, sf).groupBy("trading_date", "ticker").agg(F.max((F.col("universe_group") == "high").cast("int")).alias("h"), F.max("cik").alias("cik"))
    sessions = sessions.select("trading_date", "ticker", F.when(F.col("h") == 1, "high").otherwise("low").alias("universe_group"), "cik")
    out = market.context(sessions, market.bars(table(spark, sf, "security_daily_prices")))
    return out.withColumns({"trading_date": K.iso("trading_date"), "bar_date": K.iso("bar_date")})


@query("""SELECT DISTINCT ticker, strftime(price_date, '%Y-%m-%d') AS price_date, source, CASE WHEN abs(close::DOUBLE) < 1e12 THEN close::DOUBLE END AS close, CASE WHEN abs(high::DOUBLE) < 1e12 THEN high::DOUBLE END AS high, volume FROM security_daily_prices WHERE close IS NOT NULL""")
def ohlcv_sanitize(spark, sf):
    """Bars as delivered text, guarded back into numbers; bars without a usable close are dropped."""
    raw = table(spark, sf, "security_daily_prices").select("ticker", "price_date", "source", *[F.col(c).cast("string").alias(c) for c in ("close", "high", "volume")])
    out = raw.select("ticker", K.iso("price_date").alias("price_date"), "source", X.finite_price("close").alias("close"), X.finite_price("high").alias("high"), X.whole_volume("volume").alias("volume"))
    return out.filter("close is not null").distinct()


# --- merges ------------------------------------------------------------------------------------------------------------------------

_MASTER = """
WITH rows AS (SELECT DISTINCT upper(trim(ticker, ' ' || chr(9))) AS ticker, cik, updated_at, source FROM security_master)
, t AS (SELECT * FROM rows WHERE updated_at < TIMESTAMP '2024-07-01' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY updated_at DESC, cik DESC NULLS LAST, source DESC) = 1)
, s AS (SELECT * FROM rows WHERE updated_at >= TIMESTAMP '2024-07-01' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY updated_at DESC, cik DESC NULLS LAST, source DESC) = 1)
"""


def _master_sides(spark, sf):
    rows = table(spark, sf, "security_master").select(K.ticker("ticker").alias("ticker"), "cik", "updated_at", "source").distinct()
    cut = F.lit("2024-07-01 00:00:00").cast("timestamp_ntz")
    at = F.col("updated_at").cast("timestamp_ntz")
    return merge.last_per_key(rows.filter(at < cut), ["ticker"], ["updated_at"]), merge.last_per_key(rows.filter(at >= cut), ["ticker"], ["updated_at"])


@query(_MASTER + "SELECT coalesce(s.ticker, t.ticker) AS ticker, CASE WHEN s.ticker IS NULL THEN t.cik ELSE s.cik END AS cik, CASE WHEN s.ticker IS NULL THEN t.source ELSE s.source END AS source FROM t FULL JOIN s ON s.ticker = t.ticker")
def merge_last_wins(spark, sf):
    """Later updates overwrite earlier ones, nulls included."""
    target, source = _master_sides(spark, sf)
    return merge.upsert(target, source, ["ticker"]).select("ticker", "cik", "source")


@query(_MASTER + "SELECT coalesce(s.ticker, t.ticker) AS ticker, coalesce(s.cik, t.cik) AS cik, CASE WHEN t.ticker IS NULL THEN s.source ELSE t.source END AS source FROM t FULL JOIN s ON s.ticker = t.ticker")
def merge_keep_known(spark, sf):
    """Later nulls don't overwrite a known cik, and the first source stays."""
    target, source = _master_sides(spark, sf)
    return merge.upsert(target, source, ["ticker"], {"cik": merge.keep_old_if_null, "source": merge.keep_old}).select("ticker", "cik", "source")


_ISSUER = """
WITH rows AS (SELECT DISTINCT cik, entity_name, sic_code, fetched_at, enrichment_status FROM issuer_sec_profile)
"""


@query(_ISSUER + """, ok AS (SELECT * FROM rows WHERE enrichment_status = 'ok' QUALIFY row_number() OVER (PARTITION BY cik ORDER BY fetched_at DESC, entity_name DESC NULLS LAST, sic_code DESC NULLS LAST) = 1)
, bad AS (SELECT cik, max(fetched_at) AS failed_at FROM rows WHERE enrichment_status <> 'ok' GROUP BY cik)
SELECT coalesce(ok.cik, bad.cik) AS cik, entity_name, sic_code, CASE WHEN ok.cik IS NULL THEN 'error' ELSE 'ok' END AS status, coalesce(failed_at > fetched_at, ok.cik IS NULL) AS last_fetch_failed FROM ok FULL JOIN bad ON ok.cik = bad.cik""")
def merge_keep_good_fetch(spark, sf):
    """A failed fetch never clobbers a good record; it only says that the last fetch failed."""
    rows = table(spark, sf, "issuer_sec_profile").select("cik", "entity_name", "sic_code", "fetched_at", "enrichment_status")
    good = merge.last_per_key(rows.filter("enrichment_status = 'ok'").drop("enrichment_status"), ["cik"], ["fetched_at"]).withColumn("ok", F.lit(True))
    bad = rows.filter("enrichment_status <> 'ok'").groupBy("cik").agg(F.max("fetched_at").alias("failed_at"))
    both = good.join(bad, "cik", "full_outer")
    return both.select("cik", "entity_name", "sic_code", F.when(F.col("ok"), "ok").otherwise("error").alias("status"), F.coalesce(F.col("failed_at") > F.col("fetched_at"), F.col("ok").isNull()).alias("last_fetch_failed"))


@query(_BASE + """, src AS (SELECT accession_number, 0 AS transaction_index, 'restated' AS transaction_category FROM fl WHERE is_amendment)
SELECT DISTINCT accession_number, transaction_index, transaction_category FROM tx WHERE accession_number NOT IN (SELECT accession_number FROM src) UNION SELECT * FROM src""")
def replace_children(spark, sf):
    """Children of amended filings are replaced as a whole."""
    source = _filing(spark, sf, "is_amendment").filter("is_amendment").select("accession_number", F.lit(0).alias("transaction_index"), F.lit("restated").alias("transaction_category")).distinct()
    return merge.replace_children(_tx(spark, sf, "transaction_category"), source, "accession_number").distinct()


_STATE = """, chunks AS (SELECT accession_number || ':' || transaction_index AS chunk_id, sha256('1' || chr(10) || coalesce(transaction_category, '') || coalesce(transaction_code, '') || coalesce(shares::VARCHAR, '')) AS content_hash, transaction_index, shares FROM tx)
, state AS (SELECT chunk_id, CASE WHEN shares IS NULL THEN 'stale' ELSE content_hash END AS content_hash, CASE WHEN transaction_index = 1 THEN 'error' ELSE 'ok' END AS status FROM chunks WHERE transaction_index <> 2)
, todo AS (SELECT c.chunk_id, c.content_hash, s.status IS NULL OR s.status <> 'ok' OR s.content_hash IS DISTINCT FROM c.content_hash AS pending FROM chunks c LEFT JOIN state s USING (chunk_id))
"""


def _pending(spark, sf):
    tx = _tx(spark, sf)
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    chunks = tx.select(X.chunk_id("accession_number", "transaction_index").alias("chunk_id"), X.content_hash(F.concat(some("transaction_category"), some("transaction_code"), some("shares"))).alias("content_hash"), "transaction_index", "shares")
    state = chunks.filter("transaction_index <> 2").select("chunk_id", F.when(F.col("shares").isNull(), "stale").otherwise(F.col("content_hash")).alias("content_hash"), F.when(F.col("transaction_index") == 1, "error").otherwise("ok").alias("status"))
    return merge.pending(chunks.select("chunk_id", "content_hash"), state, ["chunk_id"])


@query(_BASE + _STATE + "SELECT chunk_id, content_hash FROM todo WHERE pending")
def embed_pending(spark, sf):
    """Chunks that a state of indexed chunks doesn't cover: unknown, failed or changed."""
    return _pending(spark, sf).filter("pending").drop("pending")


@query(_BASE + _STATE + "SELECT count(*) AS total, count(*) FILTER (WHERE pending) AS embedded, count(*) FILTER (WHERE NOT pending) AS skipped FROM todo")
def embed_sync_stats(spark, sf):
    return _pending(spark, sf).agg(F.count("*").alias("total"), F.count_if("pending").alias("embedded"), F.count_if(~F.col("pending")).alias("skipped"))


# --- identifiers and addresses -----------------------------------------------------------------------------------------------------


@query("""SELECT DISTINCT accession_number, issuer_cik, CASE WHEN regexp_replace(issuer_cik, '[^0-9]', '', 'g') <> '' THEN 'https://www.sec.gov/Archives/edgar/data/' || coalesce(nullif(regexp_replace(regexp_replace(issuer_cik, '[^0-9]', '', 'g'), '^0+', ''), ''), '0') || '/' || replace(accession_number, '-', '') || '/' || accession_number || '-index.htm'
  ELSE 'https://www.sec.gov/cgi-bin/browse-edgar?action=getcompany&CIK=&type=4&dateb=&owner=include&count=40&search_text=' || accession_number END AS url FROM filing""")
def citation_urls(spark, sf):
    return table(spark, sf, "filing").select("accession_number", "issuer_cik", X.filing_index_url("issuer_cik", "accession_number").alias("url")).distinct()


@query("""SELECT DISTINCT accession_number AS given, accession_number AS found, 'doc/' || document_type || '.xml' AS document FROM filing""")
def accession_paths(spark, sf):
    """Archive paths taken apart again."""
    path = F.concat(F.lit("edgar/data/"), X.cik_segment("issuer_cik"), F.lit("/"), X.accession_plain("accession_number"), F.lit("/doc/"), F.col("document_type"), F.lit(".xml"))
    rows = table(spark, sf, "filing").select(F.col("accession_number").alias("given"), path.alias("path"))
    return rows.select("given", X.accession_of_path("path").alias("found"), X.document_of_path("path").alias("document")).distinct()


@query("""SELECT DISTINCT strftime(d, '%Y-%m-%d') AS day, 'https://www.sec.gov/Archives/edgar/daily-index/' || year(d) || '/QTR' || quarter(d) || '/master' || strftime(d, '%Y%m%d') || '.idx' AS url FROM (SELECT period_of_report::DATE AS d FROM filing WHERE period_of_report IS NOT NULL)""")
def daily_index_urls(spark, sf):
    return table(spark, sf, "filing").filter("period_of_report is not null").select("period_of_report").distinct().select(K.iso("period_of_report").alias("day"), X.daily_index_url("period_of_report").alias("url"))


@query("""SELECT DISTINCT accession_number, 'https://www.sec.gov/Archives/edgar/data/' || coalesce(nullif(regexp_replace(issuer_cik, '^0+', ''), ''), '0') || '/' || replace(accession_number, '-', '') || '/primary_doc.xml' AS relative_url, 'https://www.sec.gov/Archives/' || document_type AS rooted_url, 'https://data.sec.gov/submissions/CIK' || lpad(nullif(regexp_replace(issuer_cik, '[^0-9]', '', 'g'), ''), 10, '0') || '.json' AS submissions FROM filing""")
def document_urls(spark, sf):
    rows = table(spark, sf, "filing").select("accession_number", "issuer_cik", "document_type").distinct()
    return rows.select("accession_number", X.document_url("issuer_cik", "accession_number", F.lit(" primary_doc.xml ")).alias("relative_url"), X.document_url("issuer_cik", "accession_number", F.concat(F.lit("/Archives/"), F.col("document_type"))).alias("rooted_url"), X.submissions_url(X.pad_cik("issuer_cik")).alias("submissions")).distinct()


@query(r"""SELECT DISTINCT cik AS given, lpad(nullif(regexp_replace(cik, '[^0-9]', '', 'g'), ''), 10, '0') AS lenient, CASE WHEN regexp_full_match(regexp_replace(cik, '^\s+|\s+$', '', 'g'), '[0-9]{1,10}') THEN lpad(regexp_replace(cik, '^\s+|\s+$', '', 'g'), 10, '0') END AS strict,
  coalesce(nullif(regexp_replace(cik, '^0+', ''), ''), '0') AS segment FROM security_master WHERE cik IS NOT NULL""")
def cik_forms(spark, sf):
    rows = table(spark, sf, "security_master").filter("cik is not null").select("cik").distinct()
    return rows.select(F.col("cik").alias("given"), X.pad_cik("cik").alias("lenient"), X.pad_cik_strict("cik").alias("strict"), X.cik_segment("cik").alias("segment"))


@query(r"""WITH l AS (SELECT source, string_agg(ticker, ', ' ORDER BY ticker, updated_at) AS s FROM security_master GROUP BY source), p AS (SELECT source, upper(unnest(regexp_split_to_array(s, '[,\s]+'))) AS t FROM l)
SELECT DISTINCT source, t AS ticker FROM p WHERE t <> ''""")
def ticker_list_parse(spark, sf):
    """Tickers of lists as text, parsed back into distinct ones. Each list is a block of a source's rows, of about a thousand; what they say is merged."""
    rows = table(spark, sf, "security_master").select("source", "ticker", "updated_at")
    sizes = rows.groupBy("source").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("ticker", "updated_at"), F.ceil(F.col("n") / 1000))
    lists = rows.join(sizes, "source").groupBy("source", part.alias("part")).agg(F.array_join(F.collect_list("ticker"), ", ").alias("s"))
    return lists.select("source", F.explode(X.ticker_list("s")).alias("ticker")).distinct()


@query(r"""WITH t AS (SELECT DISTINCT split_part(c0, ',', 1) AS token FROM screen_line) SELECT token, regexp_full_match(upper(regexp_replace(token, '^\s+|\s+$', '', 'g')), '[A-Z][A-Z0-9.\-]{0,9}') AS probable FROM t""")
def probable_tickers(spark, sf):
    return table(spark, sf, "screen_line").select(F.split_part("c0", F.lit(","), F.lit(1)).alias("token")).distinct().select("token", X.probable_ticker("token").alias("probable"))


# --- landed feeds: written as their text and read back -----------------------------------------------------------------------------


@query(r"""SELECT DISTINCT lpad(regexp_replace(issuer_cik, '^\s+|\s+$', '', 'g'), 10, '0') AS cik, document_type AS form, strftime(period_of_report, '%Y-%m-%d') AS filed, 'edgar/data/' || accession_number || '.txt' AS path FROM filing
WHERE period_of_report IS NOT NULL AND document_type IN ('4', '4/A') AND regexp_full_match(regexp_replace(issuer_cik, '^\s+|\s+$', '', 'g'), '[0-9]{1,10}')""")
def master_index_parse(spark, sf):
    """Index lines of both layouts, the older one for amendments."""
    f = table(spark, sf, "filing").filter("period_of_report is not null")
    name = F.coalesce(F.regexp_replace("issuer_name", r"[|]", " "), F.lit("Unnamed Issuer"))
    path = F.concat(F.lit("edgar/data/"), F.col("accession_number"), F.lit(".txt"))
    barred = F.concat_ws("|", "issuer_cik", name, "document_type", K.iso("period_of_report"), path)
    spaced = F.concat_ws("   ", X.strip("issuer_cik"), name, "document_type", F.date_format("period_of_report", "yyyyMMdd"), path)
    lines = f.select(F.when(F.col("is_amendment"), spaced).otherwise(barred).alias("value"))
    return landed.master_index(lines).select("cik", "form", K.iso("filed").alias("filed"), "path").distinct()


@query(_BASE + """, g AS (SELECT DISTINCT issuer_cik, accession_number, document_type, period_of_report::DATE AS d FROM filing) SELECT DISTINCT lpad(nullif(regexp_replace(issuer_cik, '[^0-9]', '', 'g'), ''), 10, '0') AS cik, accession_number, document_type AS form, strftime(d, '%Y-%m-%d') AS filed FROM g WHERE document_type IN ('4', '4/A')""")
def submissions_filter(spark, sf):
    """Submission records with parallel arrays, about a thousand filings each, zipped back into rows."""
    f = table(spark, sf, "filing").select("issuer_cik", "accession_number", "document_type", "period_of_report").distinct()
    sizes = f.groupBy("issuer_cik").agg(F.count("*").alias("n"))  # an issuer's filings are cut into as many records as they fill
    part = F.pmod(F.xxhash64("accession_number"), F.ceil(F.col("n") / 1000))
    rows = f.join(sizes, "issuer_cik").groupBy("issuer_cik", part.alias("part")).agg(F.collect_list(F.struct(F.col("document_type").alias("form"), F.coalesce(K.iso("period_of_report"), F.lit("")).alias("filingDate"), F.col("accession_number").alias("accessionNumber"))).alias("r"))
    record = F.struct(F.col("issuer_cik").alias("cik"), F.struct(F.struct(F.col("r.form").alias("form"), F.col("r.filingDate").alias("filingDate"), F.col("r.accessionNumber").alias("accessionNumber"), F.transform("r", lambda x: F.lit("doc.xml")).alias("primaryDocument")).alias("recent")).alias("filings"))
    return landed.submissions(rows.select(F.to_json(record).alias("value"))).select("cik", "accession_number", "form", K.iso("filed").alias("filed")).distinct()


@query(r"""SELECT DISTINCT lpad(nullif(regexp_replace(cik, '[^0-9]', '', 'g'), ''), 10, '0') AS cik, nullif(regexp_replace(entity_name, '^\s+|\s+$', '', 'g'), '') AS entity_name, coalesce(try_cast(sic_code AS BIGINT)::VARCHAR, nullif(regexp_replace(sic_code, '^\s+|\s+$', '', 'g'), '')) AS sic_code, nullif(array_to_string(list_filter(list_transform(tickers, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), ','), '') AS tickers FROM issuer_sec_profile""")
def issuer_metadata(spark, sf):
    """Company fields of submission records."""
    p = table(spark, sf, "issuer_sec_profile")
    record = F.to_json(F.struct("cik", F.col("entity_name").alias("name"), F.col("sic_code").alias("sic"), "tickers"))
    return landed.company_fields(p.select(record.alias("value"))).select("cik", "entity_name", "sic_code", F.array_join("tickers", ",").alias("tickers")).distinct()


def _element(name: str, value, inner: bool = False, attribute=None, after=None):
    text = F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = F.concat(F.lit("<value>"), text, F.lit("</value>")) if inner else text
    opening = F.lit(f"<{name}>") if attribute is None else F.concat(F.lit(f"<{name}"), F.coalesce(F.concat(F.lit(' footnoteID="'), attribute, F.lit('"')), F.lit("")), F.lit(">"))
    return F.coalesce(F.concat(opening, body, F.lit("") if after is None else after, F.lit(f"</{name}>")), F.lit(""))


def ownership_xml(spark, sf, varied: bool = False) -> DataFrame:
    """(accession_number, xml): each filing written as an ownership document. ``varied`` ones bear footnotes (the first as an attribute of the shares, the others as
    elements in the price), a second owner where there is no title, a name space where there is no ticker, and end too early where they have a message."""
    tx = _tx(spark, sf, "transaction_category", "security_title", "transaction_date", "transaction_code", "acquired_disposed_code", "shares", "price_per_share", "direct_indirect", *(("footnote_ids",) if varied else ()))
    one = F.try_element_at("footnote_ids", F.lit(1)) if varied else None
    rest = F.array_join(F.transform(F.coalesce(F.slice("footnote_ids", 2, 1_000_000), F.array().cast("array<string>")), lambda x: F.concat(F.lit('<footnoteId id="'), x, F.lit('"/>'))), "") if varied else None
    amounts = F.concat(F.lit("<transactionAmounts>"), _element("transactionShares", F.col("shares").cast("string"), True, one), _element("transactionPricePerShare", F.col("price_per_share").cast("string"), True, None, rest), _element("transactionAcquiredDisposedCode", F.col("acquired_disposed_code"), True), F.lit("</transactionAmounts>"))
    body = F.concat(_element("securityTitle", F.col("security_title"), True), _element("transactionDate", K.iso("transaction_date"), True), F.lit("<transactionCoding>"), _element("transactionCode", F.col("transaction_code")), F.lit("</transactionCoding>"), amounts, F.lit("<ownershipNature>"), _element("directOrIndirectOwnership", F.col("direct_indirect"), True), F.lit("</ownershipNature>"))
    tx = tx.select("accession_number", "transaction_category", F.struct("transaction_index", body.alias("b")).alias("t"))
    pick = lambda c: F.array_sort(F.collect_list(F.when(F.col("transaction_category") == c, F.col("t"))))
    wrap = lambda c, n: F.array_join(F.transform(c, lambda x: F.concat(F.lit(f"<{n}>"), x["b"], F.lit(f"</{n}>"))), "")
    sides = tx.groupBy("accession_number").agg(pick("non_derivative").alias("nd"), pick("derivative").alias("d"))
    header = _filing(spark, sf, "document_type", "issuer_cik", "issuer_name", "insider_cik", "insider_name", *(("insider_title", "issuer_ticker", "parse_error") if varied else ())).join(sides, "accession_number")
    second = F.when(F.col("insider_title").isNull(), F.lit("<reportingOwner><reportingOwnerId><rptOwnerCik>99</rptOwnerCik><rptOwnerName>Second</rptOwnerName></reportingOwnerId></reportingOwner>")).otherwise("") if varied else F.lit("")
    xml = F.concat(
        F.lit('<?xml version="1.0"?><ownershipDocument>'), _element("documentType", F.col("document_type")), F.lit("<issuer>"), _element("issuerCik", F.col("issuer_cik")), _element("issuerName", F.col("issuer_name")), F.lit("</issuer>"),
        F.lit("<reportingOwner><reportingOwnerId>"), _element("rptOwnerCik", F.col("insider_cik")), _element("rptOwnerName", F.col("insider_name")), F.lit("</reportingOwnerId></reportingOwner>"), second, F.lit("<nonDerivativeTable>"), wrap("nd", "nonDerivativeTransaction"),
        F.lit("</nonDerivativeTable><derivativeTable>"), wrap("d", "derivativeTransaction"), F.lit("</derivativeTable></ownershipDocument>"),
    )
    if varied:
        spaced = F.replace(F.regexp_replace(xml, "<(/?)([A-Za-z])", "<$1n:$2"), F.lit("<n:ownershipDocument>"), F.lit('<n:ownershipDocument xmlns:n="urn:own">'))
        xml = F.when(F.col("issuer_ticker").isNull(), spaced).otherwise(xml)
        header = header.withColumn("x", xml)
        xml = F.when(F.col("parse_error").isNotNull(), F.left("x", F.length("x") - 30)).otherwise(F.col("x"))
    return header.select("accession_number", xml.alias("xml"))


_ORD = """, ord AS (SELECT DISTINCT accession_number, transaction_index, transaction_category, security_title, transaction_date::DATE AS transaction_date, transaction_code, acquired_disposed_code, shares, price_per_share, direct_indirect, footnote_ids FROM form4_transaction)
, whole AS (SELECT DISTINCT accession_number FROM filing WHERE parse_error IS NULL)
, noted AS (SELECT *, CASE WHEN shares IS NOT NULL THEN footnote_ids[1] END AS attr, CASE WHEN price_per_share IS NOT NULL THEN footnote_ids[2:] ELSE [] END AS inner_ids FROM ord JOIN whole USING (accession_number))
"""


def _xml_sql(strict: bool) -> str:
    ids = "CASE WHEN attr IS NULL THEN [] ELSE [attr] END" if strict else "list_distinct(CASE WHEN attr IS NULL THEN [] ELSE [attr] END || coalesce(inner_ids, []))"
    return _BASE + _ORD + f"""SELECT accession_number, (row_number() OVER (PARTITION BY accession_number ORDER BY transaction_category <> 'non_derivative', transaction_index) - 1)::INTEGER AS transaction_index, transaction_category, nullif(regexp_replace(security_title, '^\\s+|\\s+$', '', 'g'), '') AS security_title,
  strftime(transaction_date, '%Y-%m-%d') AS transaction_date, transaction_code, acquired_disposed_code, shares, price_per_share, direct_indirect, coalesce(array_to_string(list_sort({ids}), ','), '') AS footnotes,
  CASE WHEN transaction_category = 'non_derivative' AND len({ids}) = 0 THEN (shares * price_per_share)::DECIMAL(28,4) END AS total_value FROM noted"""


def _read_back(spark, sf, strict: bool) -> DataFrame:
    rows = landed.ownership_transactions(landed.ownership(ownership_xml(spark, sf, varied=True)), strict)
    notes = F.array_join(F.array_sort(F.coalesce("footnote_ids", F.array().cast("array<string>"))), ",")
    return rows.select("accession_number", "transaction_index", "transaction_category", "security_title", K.iso("transaction_date").alias("transaction_date"), "transaction_code", "acquired_disposed_code", "shares", "price_per_share", "direct_indirect", notes.alias("footnotes"), "total_value")


@query(_xml_sql(False))
def xml_transactions(spark, sf):
    """Transactions read back from ownership XML with footnotes, name spaces, several owners and damaged documents."""
    return _read_back(spark, sf, False)


@query(_xml_sql(True))
def xml_transactions_strict(spark, sf):
    """The same where only attributes are footnotes."""
    return _read_back(spark, sf, True)


@query(r"""SELECT DISTINCT accession_number, document_type, document_type = '4/A' AS is_amendment, lpad(nullif(regexp_replace(issuer_cik, '[^0-9]', '', 'g'), ''), 10, '0') AS issuer_cik, nullif(regexp_replace(issuer_name, '^\s+|\s+$', '', 'g'), '') AS issuer_name, lpad(coalesce(nullif(regexp_replace(insider_cik, '[^0-9]', '', 'g'), ''), CASE WHEN insider_title IS NULL THEN '99' END), 10, '0') AS insider_cik,
  coalesce(nullif(regexp_replace(insider_name, '^\s+|\s+$', '', 'g'), ''), CASE WHEN insider_title IS NULL THEN 'Second' END) AS insider_name, CASE WHEN insider_title IS NULL THEN 'multiple reportingOwner blocks (2); using first only' END AS warning
FROM filing WHERE parse_error IS NULL AND accession_number IN (SELECT accession_number FROM form4_transaction)""")
def xml_headers(spark, sf):
    """Headers read back from ownership XML; of several owners the first one counts."""
    return landed.ownership_header(landed.ownership(ownership_xml(spark, sf, varied=True))).select("accession_number", "document_type", "is_amendment", "issuer_cik", "issuer_name", "insider_cik", "insider_name", "warning")


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN parse_error IS NULL THEN 'read' ELSE 'malformed XML' END AS reason FROM (SELECT DISTINCT accession_number, parse_error FROM filing WHERE accession_number IN (SELECT accession_number FROM form4_transaction))) GROUP BY reason")
def xml_errors(spark, sf):
    """How many documents could be read, and why not."""
    return landed.ownership(ownership_xml(spark, sf, varied=True)).groupBy(F.coalesce("parse_error", F.lit("read")).alias("reason")).agg(F.count("*").alias("n"))


@query("""SELECT DISTINCT accession_number, CASE WHEN is_amendment THEN 'https://www.sec.gov/Archives/x/doc4.xml' ELSE 'https://www.sec.gov/Archives/edgar/' || accession_number || '/form4.xml' END AS href FROM filing""")
def href_pick(spark, sf):
    """The ownership document among the links of a filing's index page."""
    pages = table(spark, sf, "filing").select("accession_number", F.when(F.col("is_amendment"), F.lit('<a href="/Archives/xslF345X05/form4.xml">r</a><a HREF="x/doc4.xml">d</a><a href="longer/other/exhibit.xml">')).otherwise(F.concat(F.lit('<a href="/Archives/edgar/'), F.col("accession_number"), F.lit('/form4.xml">a</a><a href="b.xml">b</a>'))).alias("html"))
    return pages.select("accession_number", X.pick_href("html").alias("href")).distinct()


@query("""SELECT source, count(*) AS n, count(*) FILTER (WHERE regexp_matches(lower(substr(text, 1, 4096)), '<html|<!doctype html|<head|<meta')) AS html FROM documents GROUP BY source""")
def html_sniff(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(X.looks_like_html("text")).alias("html"))


@query(r"""SELECT DISTINCT ticker, strftime(trading_date, '%Y-%m-%d') AS trading_date, CASE WHEN coalesce(quote_type, '') <> 'NONE' AND (coalesce(regexp_replace(long_name, '^\s+|\s+$', '', 'g'), '') <> '' OR coalesce(market_cap, 0) <> 0) THEN 'ok' ELSE 'no_data' END AS status FROM universe_company_profile""")
def profile_classify(spark, sf):
    """Whether a quote record says anything."""
    p = table(spark, sf, "universe_company_profile")
    record = F.struct(F.col("long_name").alias("longName"), F.lit(None).cast("string").alias("shortName"), F.col("market_cap").alias("marketCap"), F.lit(None).cast("double").alias("regularMarketPrice"), F.col("quote_type").alias("quoteType"), F.col("ticker").alias("symbol"))
    return p.select("ticker", K.iso("trading_date").alias("trading_date"), X.profile_status(record).alias("status")).distinct()


# --- search ------------------------------------------------------------------------------------------------------------------------

_QUERY = [1.0 if i % 2 == 0 else -0.5 for i in range(64)]
_QUERY_SQL = "[" + ", ".join(f"{x}" for x in _QUERY) + "]::DOUBLE[]"


@query(f"SELECT vec_id, label, round(1 - list_cosine_similarity(embedding::DOUBLE[], {_QUERY_SQL}), 6) AS distance FROM embeddings ORDER BY 1 - list_cosine_similarity(embedding::DOUBLE[], {_QUERY_SQL}), vec_id LIMIT 20")
def knn_topk(spark, sf):
    """The 20 vectors nearest to one; the limit is the search's k."""
    return knn.nearest(table(spark, sf, "embeddings"), "vec_id", "embedding", _QUERY, 20).select("vec_id", "label", F.round("distance", 6).alias("distance"))


@query(f"SELECT vec_id, label, round(1 - list_cosine_similarity(embedding::DOUBLE[], {_QUERY_SQL}), 6) AS distance FROM embeddings WHERE label IN (2, 3) ORDER BY 1 - list_cosine_similarity(embedding::DOUBLE[], {_QUERY_SQL}), vec_id LIMIT 10")
def knn_filtered(spark, sf):
    """The filter lies below the distance and reaches the scan."""
    return knn.nearest(table(spark, sf, "embeddings").filter(F.col("label").isin(2, 3)), "vec_id", "embedding", _QUERY, 10).select("vec_id", "label", F.round("distance", 6).alias("distance"))


@query("""SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id, round(1 - list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS distance FROM embeddings q, embeddings r WHERE q.vec_id % 20 = 0 AND r.vec_id <> q.vec_id
QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY round(1 - list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 9), r.vec_id) <= 5""")
def knn_batch(spark, sf):
    """Five neighbours of each row whose id is divisible by 20, against all rows."""
    rows = table(spark, sf, "embeddings")
    queries = rows.filter("vec_id % 20 = 0")
    return knn.nearest_of_each(queries, rows, "vec_id", "embedding", 5).select("query_id", "neighbour_id", F.round("distance", 6).alias("distance"))


@query(_BASE + f"""SELECT accession_number, string_agg('[' || i || '] accession=' || accession_number || ' txn_index=' || transaction_index || ' ticker=' || coalesce(issuer_ticker, 'None') || ' code=' || coalesce(transaction_code, 'None') || ' A/D=' || coalesce(acquired_disposed_code, 'None') || chr(10) || t, chr(10) || chr(10) ORDER BY i) AS context
FROM (SELECT accession_number, transaction_index, issuer_ticker, transaction_code, acquired_disposed_code, {_TEXT} AS t, row_number() OVER (PARTITION BY accession_number ORDER BY transaction_index) AS i FROM tx JOIN fl USING (accession_number)) WHERE i <= 6 GROUP BY accession_number""")
def context_block(spark, sf):
    """The first six excerpts of each filing as one numbered block; six is the prompt's k."""
    first = Window.partitionBy("accession_number").orderBy("transaction_index")
    ranked = _tx(spark, sf).withColumn("i", F.row_number().over(first)).filter("i <= 6")  # ranked before any text is written
    rows = _join(ranked, _filing(spark, sf)).withColumn("text", X.narrative())
    named = lambda c: F.coalesce(F.col(c), F.lit("None"))
    block = F.concat(F.lit("["), F.col("i").cast("string"), F.lit("] accession="), F.col("accession_number"), F.lit(" txn_index="), F.col("transaction_index").cast("string"), F.lit(" ticker="), named("issuer_ticker"), F.lit(" code="), named("transaction_code"), F.lit(" A/D="), named("acquired_disposed_code"), F.lit("\n"), F.col("text"))
    g = rows.groupBy("accession_number").agg(F.array_sort(F.collect_list(F.struct("i", block.alias("b")))).alias("x"))
    return g.select("accession_number", F.array_join(F.transform("x", lambda e: e["b"]), "\n\n").alias("context"))


@query("""SELECT issuer_ticker, doc_id, strftime(created_at, '%Y-%m-%d') AS day FROM documents WHERE source = 'chat_answer' AND issuer_ticker IS NOT NULL QUALIFY row_number() OVER (PARTITION BY issuer_ticker ORDER BY created_at DESC, doc_id DESC) <= 6""")
def history_tail(spark, sf):
    """The last six answers per issuer; a tail is kept per key by a map-side combined top-k (window group limit)."""
    docs = table(spark, sf, "documents").filter("source = 'chat_answer' and issuer_ticker is not null").select("issuer_ticker", "doc_id", "created_at")
    last = Window.partitionBy("issuer_ticker").orderBy(F.desc("created_at"), F.desc("doc_id"))
    return docs.withColumn("i", F.row_number().over(last)).filter("i <= 6").select("issuer_ticker", "doc_id", F.date_format("created_at", "yyyy-MM-dd").alias("day"))


# --- audits ------------------------------------------------------------------------------------------------------------------------


# Kinds of the sentences that these tables hold, written down without the operator's own patterns.
_KIND = """CASE WHEN parse_error ILIKE '%missing ownershipDocument root%' OR parse_error ILIKE '%missing documentType%' OR parse_error ILIKE '%missing issuerCik%' THEN 'missing_part' WHEN parse_error ILIKE '%unsupported documentType ''_''%' THEN 'unsupported_type'
  WHEN parse_error ILIKE '%artifact is HTML%' OR parse_error ILIKE '%Document is empty, line%' THEN 'not_xml' WHEN parse_error ILIKE '%could not decode as %' OR parse_error ILIKE '%invalid byte 0x__ in position%' THEN 'encoding' WHEN parse_error ILIKE '%XML cut off after % bytes%' THEN 'truncated'
  WHEN parse_error ILIKE '%Start tag expected, ''<''%' OR parse_error ILIKE '%no well-formed XML%' OR parse_error ILIKE '%Extra content at the end%' OR parse_error ILIKE '%Opening and ending tag mismatch%' OR parse_error ILIKE '%Entity ''%'' not defined%' THEN 'broken_xml' END"""


@query(f"SELECT 'parse' AS stage, kind, count(*) AS n FROM (SELECT DISTINCT accession_number, {_KIND} AS kind FROM filing) WHERE kind IS NOT NULL GROUP BY kind")
def errors_by_kind(spark, sf):
    """Dead letters by stage and kind, most first."""
    rows = parsefail.filing_rows(table(spark, sf, "filing").select("accession_number", "parse_error")).filter("_reason is not null").select("accession_number", F.col("_reason").alias("kind")).distinct()
    return rows.groupBy(F.lit("parse").alias("stage"), "kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "stage", "kind")


@query(_BASE + "SELECT DISTINCT accession_number FROM filing WHERE accession_number NOT IN (SELECT accession_number FROM form4_transaction) OR parse_error IS NOT NULL")
def filings_without_clean_parse(spark, sf):
    """Filings without transactions or with a parse message."""
    f = table(spark, sf, "filing").select("accession_number", "parse_error")
    has = table(spark, sf, "form4_transaction").select("accession_number").distinct().withColumn("has", F.lit(True))
    return f.join(has, "accession_number", "left").filter("has is null or parse_error is not null").select("accession_number").distinct()


@query("""SELECT 'transaction_without_filing' AS audit, count(DISTINCT accession_number) AS n FROM form4_transaction WHERE accession_number NOT IN (SELECT accession_number FROM filing)
UNION ALL SELECT 'filing_without_issuer', count(DISTINCT accession_number) FROM filing WHERE issuer_cik NOT IN (SELECT cik FROM issuer_sec_profile)
UNION ALL SELECT 'membership_without_bars', count(DISTINCT upper(trim(ticker, ' ' || chr(9)))) FROM universe_snapshot WHERE upper(trim(ticker, ' ' || chr(9))) NOT IN (SELECT upper(trim(ticker, ' ' || chr(9))) FROM security_daily_prices)""")
def key_audit(spark, sf):
    """Rows whose parent is missing."""
    f, tx, issuers = table(spark, sf, "filing"), table(spark, sf, "form4_transaction"), table(spark, sf, "issuer_sec_profile")
    one = tx.select("accession_number").distinct().join(f.select("accession_number"), "accession_number", "left_anti").agg(F.lit("transaction_without_filing").alias("audit"), F.count("*").alias("n"))
    two = f.join(issuers.select(F.col("cik").alias("issuer_cik")), "issuer_cik", "left_anti").select("accession_number").distinct().agg(F.lit("filing_without_issuer").alias("audit"), F.count("*").alias("n"))
    key = K.ticker("ticker").alias("ticker")
    three = table(spark, sf, "universe_snapshot").select(key).distinct().join(table(spark, sf, "security_daily_prices").select(key), "ticker", "left_anti").agg(F.lit("membership_without_bars").alias("audit"), F.count("*").alias("n"))
    return one.unionByName(two).unionByName(three)


@query("""SELECT document_type, is_amendment, count(*) AS n FROM (SELECT DISTINCT accession_number, document_type, is_amendment FROM filing) GROUP BY ALL""")
def document_type_counts(spark, sf):
    return table(spark, sf, "filing").select("accession_number", "document_type", "is_amendment").distinct().groupBy("document_type", "is_amendment").agg(F.count("*").alias("n"))


@query("""SELECT accession_number, count(*) AS copies FROM filing GROUP BY accession_number HAVING count(*) > 1""")
def duplicate_filings(spark, sf):
    return table(spark, sf, "filing").groupBy("accession_number").agg(F.count("*").alias("copies")).filter("copies > 1")


@query("""WITH n AS (SELECT max(parsed_at) AS now FROM filing) SELECT count(*) AS filings, count(*) FILTER (WHERE parsed_at >= now - INTERVAL 24 HOURS) AS last_day, count(*) FILTER (WHERE parsed_at >= now - INTERVAL 24 HOURS AND parse_error IS NOT NULL) AS last_day_with_message,
 count(*) FILTER (WHERE accession_number IN (SELECT accession_number FROM form4_transaction)) AS with_transactions FROM (SELECT DISTINCT accession_number, parsed_at, parse_error FROM filing), n""")
def recent_counts(spark, sf):
    """Counts over the last day before the latest parse, and of filings that have transactions."""
    f = table(spark, sf, "filing").select("accession_number", "parsed_at", "parse_error").distinct()
    now = f.agg(F.max("parsed_at").alias("now"))
    has = table(spark, sf, "form4_transaction").select("accession_number").distinct().withColumn("has", F.lit(True))
    rows = f.withColumn("now", now.scalar()).join(has, "accession_number", "left")
    recent = F.col("parsed_at") >= F.col("now") - F.expr("INTERVAL 24 HOURS")
    return rows.agg(F.count("*").alias("filings"), F.count_if(recent).alias("last_day"), F.count_if(recent & F.col("parse_error").isNotNull()).alias("last_day_with_message"), F.count("has").alias("with_transactions"))


@query("""SELECT DISTINCT accession_number, strftime(timezone('America/New_York', timezone('UTC', parsed_at)), '%Y-%m-%d %H:%M:%S') AS new_york FROM filing""")
def new_york_times(spark, sf):
    """Wall clock of New York when a filing was parsed."""
    return table(spark, sf, "filing").select("accession_number", F.date_format(X.new_york("parsed_at"), "yyyy-MM-dd HH:mm:ss").alias("new_york")).distinct()


@query("""WITH p AS (SELECT regexp_replace(regexp_replace(cik, '[^0-9]', '', 'g'), '^0+', '') AS c, entity_name, sic_code FROM (SELECT DISTINCT cik, entity_name, sic_code, fetched_at FROM issuer_sec_profile WHERE enrichment_status = 'ok')
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY fetched_at DESC, entity_name DESC NULLS LAST, sic_code DESC NULLS LAST) = 1)
SELECT coalesce(sic_code, '') AS sic_code, count(*) AS filings, count(entity_name) AS named FROM (SELECT DISTINCT accession_number, issuer_cik FROM filing) f LEFT JOIN p ON p.c = regexp_replace(regexp_replace(issuer_cik, '[^0-9]', '', 'g'), '^0+', '') GROUP BY 1""")
def filings_by_industry(spark, sf):
    """Filings joined with the current record of their issuer."""
    p = table(spark, sf, "issuer_sec_profile").filter("enrichment_status = 'ok'").select(K.cik_digits("cik").alias("c"), "entity_name", "sic_code", "fetched_at")
    current = merge.last_per_key(p, ["c"], ["fetched_at"])
    f = table(spark, sf, "filing").select("accession_number", "issuer_cik").distinct().withColumn("c", K.cik_digits("issuer_cik"))
    return f.join(current, "c", "left").groupBy(F.coalesce("sic_code", F.lit("")).alias("sic_code")).agg(F.count("*").alias("filings"), F.count("entity_name").alias("named"))


@query(_ENTRANTS + """, c AS (SELECT DISTINCT trading_date, ticker, cik FROM uni WHERE cik IS NOT NULL), f AS (SELECT cik, min(ent.trading_date) AS l FROM ent JOIN c ON c.trading_date = ent.trading_date AND c.ticker = ent.ticker GROUP BY cik)
SELECT cik, strftime(l - 30, '%Y-%m-%d') AS first_day, strftime(l, '%Y-%m-%d') AS last_day, 31::BIGINT AS days FROM f""")
def backfill_plan(spark, sf):
    """Which days to fetch for each entrant, 30 days back, counted over the exploded calendar."""
    members = _universe(spark, sf)
    days = universe.calendar(universe.backfill_plan(universe.entrants(members), members, 30))
    return days.groupBy("cik").agg(F.min("day").alias("a"), F.max("day").alias("b"), F.count("*").alias("days")).select("cik", K.iso("a").alias("first_day"), K.iso("b").alias("last_day"), "days")


@query(r"""SELECT DISTINCT ticker, replace(upper(regexp_replace(ticker, '^\s+|\s+$', '', 'g')), '.', '-') AS quote_symbol, lower(regexp_replace(ticker, '^\s+|\s+$', '', 'g')) || '.us' AS price_symbol FROM security_master""")
def symbol_forms(spark, sf):
    return table(spark, sf, "security_master").select("ticker", X.quote_symbol("ticker").alias("quote_symbol"), X.price_symbol("ticker").alias("price_symbol")).distinct()


@query(r"""WITH p AS (SELECT DISTINCT ticker, price_date::DATE AS d, close, high, volume, source FROM security_daily_prices), f AS (SELECT ticker, strftime(d, '%Y-%m') AS m, min(source) AS source, bool_or(volume IS NULL) AS odd, bool_or(high IS NULL) AS bare FROM p GROUP BY ALL)
SELECT DISTINCT p.ticker, strftime(d, '%Y-%m-%d') AS price_date, close, CASE WHEN NOT bare THEN high END AS high, volume, NULL AS reason FROM p JOIN f ON f.ticker = p.ticker AND f.m = strftime(d, '%Y-%m') WHERE close IS NOT NULL AND NOT (odd AND bare)
UNION SELECT ticker, NULL, NULL, NULL, NULL, 'html' FROM f WHERE odd AND bare""")
def price_file_parse(spark, sf):
    """Bars written as price files, one per ticker and month, and read back: some end their lines otherwise or order columns otherwise, some lack a column, bear bad
    lines, or are a page instead."""
    p = table(spark, sf, "security_daily_prices").select("ticker", "price_date", "close", "high", "volume").distinct()
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = F.struct(F.concat_ws(",", K.iso("price_date"), some("high"), some("close"), some("volume")).alias("whole"), F.concat_ws(",", some("volume"), some("close"), F.date_format("price_date", "yyyyMMdd")).alias("bare"))
    files = p.groupBy("ticker", F.date_format("price_date", "yyyy-MM").alias("m")).agg(F.collect_list(line).alias("l"), F.bool_or(F.col("volume").isNull()).alias("odd"), F.bool_or(F.col("high").isNull()).alias("no_high"))
    whole = F.concat(F.lit("Date,High,Close,Volume\n"), F.array_join("l.whole", "\n"), F.when(F.col("odd"), F.lit("\n2024-99-01,1,1,1\nnothing\n,,,")).otherwise(""))
    bare = F.concat(F.lit("VOLUME, close ,Date\r\n"), F.array_join("l.bare", "\r\n"), F.lit("\r\n7,inf,20240101"))
    body = F.when(F.col("odd") & F.col("no_high"), F.lit("<!DOCTYPE html><html>")).when(F.col("no_high"), bare).otherwise(whole)
    return landed.price_bars(files.select("ticker", body.alias("value"))).select("ticker", K.iso("price_date").alias("price_date"), "close", "high", "volume", "reason").distinct()


@query(f"SELECT accession_number, left(parse_error, 500) AS message, kind AS error_type FROM (SELECT DISTINCT accession_number, parse_error, {_KIND} AS kind FROM filing) WHERE kind IS NOT NULL")
def dead_letter_rows(spark, sf):
    """Filings that could not be read as rows of a dead-letter table."""
    f = parsefail.filing_rows(table(spark, sf, "filing").select("accession_number", "parse_error", "document_type").distinct()).filter("_reason is not null")
    return universe.dead_letters(f, "parse", F.col("_reason"), F.col("parse_error"), ["document_type"], F.lit("2025-01-01").cast("timestamp")).select("accession_number", "message", "error_type")


@query(r"""SELECT DISTINCT accession_number, nullif(concat_ws(' | ', nullif(regexp_replace(parse_error, '^\s+|\s+$', '', 'g'), ''), CASE WHEN insider_title IS NULL THEN 'insider title empty' END), '') AS message FROM filing""")
def message_merge(spark, sf):
    """Messages of a filing joined, blanks left out."""
    return table(spark, sf, "filing").select("accession_number", X.joined_messages("parse_error", F.when(F.col("insider_title").isNull(), F.lit("insider title empty"))).alias("message")).distinct()


# --- vectors of chunks -------------------------------------------------------------------------------------------------------------

_TOKENS = f"""
, chunk AS (SELECT accession_number || ':' || transaction_index AS chunk_id, accession_number, issuer_cik, upper(acquired_disposed_code) AS side, {_TEXT} AS text FROM tx JOIN scoped USING (accession_number))
, token AS (SELECT chunk_id, ('0x' || substr(md5(w), 1, 8))::BIGINT AS h FROM (SELECT chunk_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM chunk))
, place AS (SELECT chunk_id, (h >> 1) % 384 AS d, sum(CASE WHEN h % 2 = 1 THEN 1 ELSE -1 END) AS s FROM token GROUP BY ALL)
"""


def _dealt(chunks: DataFrame) -> DataFrame:
    """Chunks over all cores: what is small to move is dear to embed, and the engine would join it into few partitions by its bytes."""
    return chunks.select("chunk_id", "content_hash", "text").repartition(4 * chunks.sparkSession.sparkContext.defaultParallelism, "chunk_id")


_kept: dict[tuple[str, str], str] = {}


def _index(spark: SparkSession, sf: str) -> embed.VectorIndex:
    """The vector index of a folder's chunks, synced once per application; questions read it as it is."""
    at = (spark.sparkContext.applicationId, sf)
    if at in _kept:
        return embed.VectorIndex(spark, _kept[at], embed.MODELS["hashing-384"])
    index = embed.VectorIndex(spark, scratch(spark, "vectors"), embed.MODELS["hashing-384"], parts=spark.sparkContext.defaultParallelism)
    index.sync(_dealt(_chunks(spark, sf)), F.lit("2025-01-01").cast("timestamp"))
    _kept[at] = index.kept.folder.removesuffix("/vectors")
    return index


@query(_BASE + _SCOPE + _TOKENS + "SELECT chunk_id, 'ok' AS status, 384 AS dimensions, round(coalesce(sqrt((SELECT sum(s * s) FROM place p WHERE p.chunk_id = chunk.chunk_id)), 0), 3) AS norm FROM chunk")
def chunk_vectors(spark, sf):
    """Vectors of all chunks in scope by the weightless provider, as (chunk_id, status, dimensions, length)."""
    done = embed.embed(_dealt(_chunks(spark, sf)), embed.MODELS["hashing-384"])
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return done.select("chunk_id", "status", F.size("embedding").alias("dimensions"), F.round(norm, 3).alias("norm"))


_QUESTION = "open-market sale by the chief executive"


def _asked(question: str) -> str:
    """Stage of a question's own words and the distances of all chunks to it."""
    return f""", q AS (SELECT (h >> 1) % 384 AS d, sum(CASE WHEN h % 2 = 1 THEN 1 ELSE -1 END) AS s FROM (SELECT ('0x' || substr(md5(w), 1, 8))::BIGINT AS h FROM (SELECT unnest(regexp_extract_all('{question}', '[\\p{{L}}\\p{{N}}_]+')) AS w)) GROUP BY ALL)
, far AS (SELECT chunk_id, round(1 - coalesce(sum(place.s * q.s), 0) / sqrt(sum(place.s * place.s)) / (SELECT sqrt(sum(s * s)) FROM q), 9) AS distance FROM place LEFT JOIN q USING (d) GROUP BY chunk_id HAVING sum(place.s * place.s) > 0)"""


@query(_BASE + _SCOPE + _TOKENS + _asked(_QUESTION) + """SELECT chunk_id, 'https://www.sec.gov/Archives/edgar/data/' || ltrim(issuer_cik, '0') || '/' || replace(accession_number, '-', '') || '/' || accession_number || '-index.htm' AS url, round(distance, 6) AS distance
FROM far JOIN (SELECT DISTINCT chunk_id, issuer_cik, accession_number, side FROM chunk) c USING (chunk_id) WHERE side = 'D' ORDER BY far.distance, chunk_id LIMIT 6""")
def chunk_retrieval(spark, sf):
    """The six chunks nearest to a question among disposals, from the kept vectors; only the question is embedded. Six is the search's k."""
    index = _index(spark, sf)
    meta = _tx(spark, sf, "acquired_disposed_code").join(_filing(spark, sf, "issuer_cik"), "accession_number").select(X.chunk_id("accession_number", "transaction_index").alias("chunk_id"), "accession_number", "issuer_cik", "acquired_disposed_code")
    sides = embed.where(meta, side="S")
    return embed.retrieve(index.vectors().join(sides, "chunk_id"), _QUESTION, index.model).select("chunk_id", "url", F.round("distance", 6).alias("distance"))


@query(" UNION ALL ".join(f"(SELECT 'hashing-384' AS model_id, '{q}' AS question, row_number() OVER (ORDER BY distance, chunk_id)::INTEGER AS rank, chunk_id, round(distance, 6) AS distance FROM ({_BASE} {_SCOPE} {_TOKENS} {_asked(q)} SELECT * FROM far) QUALIFY rank <= 3)" for q in embed.QUESTIONS))
def eval_retrieval(spark, sf):
    """The three nearest chunks to each of the fixed questions; three is the report's size."""
    index = _index(spark, sf)
    return embed.evaluate({index.model.model_id: (index.vectors(), index.model)}).withColumn("distance", F.round("distance", 6))


@query(_BASE + _SCOPE + f"SELECT accession_number || ':' || transaction_index AS chunk_id, sha256('1' || chr(10) || ({_TEXT})) AS content_hash, 'ok' AS status, '2025-01-01' AS embedded_at FROM tx JOIN scoped USING (accession_number)")
def index_state(spark, sf):
    """The index state that a sync left."""
    return _index(spark, sf).states.read().select("chunk_id", "content_hash", "status", K.iso("embedded_at").alias("embedded_at"))


@query(_BASE + _SCOPE + _TOKENS + _asked(_QUESTION) + f"""SELECT 'Filters: ticker=any, side=S, universe_group=any' || chr(10) || chr(10) || 'Retrieved excerpts:' || chr(10) || string_agg('[' || i || '] accession=' || accession_number || ' txn_index=' || transaction_index || ' ticker=' || coalesce(issuer_ticker, 'None') || ' code=' || coalesce(transaction_code, 'None') || ' A/D=D' || chr(10)
  || 'URL: https://www.sec.gov/Archives/edgar/data/' || ltrim(issuer_cik, '0') || '/' || replace(accession_number, '-', '') || '/' || accession_number || '-index.htm' || chr(10) || t, chr(10) || chr(10) ORDER BY i) || chr(10) || chr(10) || 'Question: {_QUESTION}' AS content
FROM (SELECT *, {_TEXT} AS t, row_number() OVER (ORDER BY far.distance, chunk_id) AS i FROM far JOIN (SELECT *, accession_number || ':' || transaction_index AS chunk_id FROM tx JOIN scoped USING (accession_number)) c USING (chunk_id) WHERE acquired_disposed_code = 'D' QUALIFY i <= 6)""")
def answer_prompt(spark, sf):
    """What a chat model is asked about the six nearest disposals; six is the search's k."""
    index = _index(spark, sf)
    rows = _join(_tx(spark, sf), _filing(spark, sf)).withColumn("chunk_id", X.chunk_id("accession_number", "transaction_index"))
    found = embed.retrieve(index.vectors().join(embed.where(rows, side="S"), "chunk_id"), _QUESTION, index.model).withColumn("text", X.narrative())
    said: list[str] = []
    embed.answer(found, _QUESTION, [], lambda m: said.append(m[-1]["content"]) or "", side="S")
    return spark.createDataFrame([(x,) for x in said], "content string")

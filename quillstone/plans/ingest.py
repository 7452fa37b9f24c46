"""Queries of the way from index rows to loaded filings, each with its SQL. Inputs that the tables don't hold as such are written from them: raw documents,
pages, quote and submission records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions import filings as X
from quillstone.functions import keys as K
from quillstone.operators import ingest, merge, universe
from quillstone.plans import reference
from quillstone.session import shared_folder
from quillstone.sources import landed
from quillstone.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
NOW = "2025-01-01 00:00:00"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _now():
    return F.lit(NOW).cast("timestamp")


def _filings(spark, sf) -> DataFrame:
    """One row per filing, the last parsed."""
    rows = table(spark, sf, "filing").select("accession_number", "document_type", "is_amendment", "schema_version", "period_of_report", "issuer_cik", "insider_cik", "insider_title", "parsed_at", "parse_error")
    return merge.last_per_key(rows, ["accession_number"], ["parsed_at"])


_F = """
WITH f AS (SELECT accession_number AS acc, document_type, is_amendment, schema_version, period_of_report::DATE AS por, issuer_cik, insider_cik, insider_title, parsed_at, parse_error FROM filing
  QUALIFY row_number() OVER (PARTITION BY accession_number ORDER BY parsed_at DESC) = 1)
"""

# --- raw documents -----------------------------------------------------------------------------------------------------------------

# Of the filings with a title a raw row is known: amendments without a document yet, the others with one.
_RAW = """
, raw AS (SELECT acc, issuer_cik AS cik, por AS filing_date, CASE WHEN is_amendment THEN NULL ELSE parsed_at END AS accepted_at, 'old.xml' AS doc, CASE WHEN is_amendment THEN 'e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855' ELSE sha256(acc) END AS sha,
   parsed_at AS fetched_at, CASE WHEN is_amendment THEN 503 ELSE 200 END AS status, CASE WHEN is_amendment THEN 'HTTP 503' END AS err FROM f WHERE insider_title IS NOT NULL)
"""


def _raw(spark, sf) -> DataFrame:
    f = _filings(spark, sf).filter("insider_title is not null")
    amended = F.col("is_amendment")
    at = F.col("parsed_at").cast("timestamp_ntz")
    return f.select(
        "accession_number", F.col("issuer_cik").alias("cik"), F.col("period_of_report").alias("filing_date"), F.when(~amended, at).alias("accepted_at"), F.lit("old.xml").alias("primary_document"), F.lit(None).cast("string").alias("raw_uri"),
        F.when(~amended, F.col("accession_number").cast("binary")).alias("raw_xml"), F.when(amended, X.EMPTY_SHA).otherwise(F.sha2("accession_number", 256)).alias("content_sha256"), at.alias("fetched_at"),
        F.when(amended, 503).otherwise(200).alias("http_status"), F.when(amended, "HTTP 503").alias("fetch_error"),
    )


_SHOWN = ("accession_number", "cik", "filing_date", "accepted_at", "primary_document", "content_sha256", "http_status", "fetch_error")


def _shown(raw: DataFrame) -> DataFrame:
    return raw.select(*[K.iso(c).alias(c) if c in ("filing_date", "accepted_at") else F.col(c) for c in _SHOWN])


_COLUMNS = "acc AS accession_number, cik, strftime(filing_date, '%Y-%m-%d') AS filing_date, strftime(accepted_at, '%Y-%m-%d') AS accepted_at, doc AS primary_document, sha AS content_sha256, status AS http_status, err AS fetch_error"


@query(_F + _RAW + f""", n AS (SELECT acc, issuer_cik, por, CASE WHEN is_amendment THEN parsed_at END AS acp FROM f WHERE por IS NOT NULL)
SELECT {_COLUMNS} FROM (SELECT coalesce(n.acc, raw.acc) AS acc, CASE WHEN n.acc IS NULL THEN cik ELSE issuer_cik END AS cik, CASE WHEN n.acc IS NULL THEN filing_date ELSE por END AS filing_date, coalesce(acp, accepted_at) AS accepted_at,
  CASE WHEN n.acc IS NULL THEN doc ELSE 'new.xml' END AS doc, CASE WHEN n.acc IS NULL THEN sha ELSE sha256('new' || n.acc) END AS sha, CASE WHEN n.acc IS NULL THEN status ELSE 200 END AS status, CASE WHEN n.acc IS NULL THEN err END AS err FROM raw FULL JOIN n ON n.acc = raw.acc)""")
def raw_merge_success(spark, sf):
    """Raw rows after fetches that went well: all is replaced, a known time of acceptance stays where none comes."""
    body = F.concat(F.lit("new"), F.col("accession_number"))
    fetched = _filings(spark, sf).filter("period_of_report is not null").select("accession_number", F.col("issuer_cik").alias("cik"), F.col("period_of_report").alias("filing_date"), F.when(F.col("is_amendment"), F.col("parsed_at").cast("timestamp_ntz")).alias("accepted_at"), F.lit("new.xml").alias("primary_document"), F.lit(None).cast("string").alias("raw_uri"), body.cast("binary").alias("raw_xml"), X.content_sha(body).alias("content_sha256"), _now().cast("timestamp_ntz").alias("fetched_at"), F.lit(200).alias("http_status"))
    return _shown(ingest.raw_success(_raw(spark, sf), fetched))


@query(_F + _RAW + f""", n AS (SELECT acc, insider_cik, por FROM f WHERE parse_error IS NOT NULL)
SELECT {_COLUMNS} FROM (SELECT coalesce(n.acc, raw.acc) AS acc, CASE WHEN n.acc IS NOT NULL AND (raw.acc IS NULL OR sha LIKE 'e3b0c442%') THEN insider_cik ELSE cik END AS cik, CASE WHEN n.acc IS NOT NULL AND (raw.acc IS NULL OR sha LIKE 'e3b0c442%') THEN por ELSE filing_date END AS filing_date, accepted_at,
  CASE WHEN n.acc IS NOT NULL AND (raw.acc IS NULL OR sha LIKE 'e3b0c442%') THEN 'asked.xml' ELSE doc END AS doc, coalesce(sha, 'e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855') AS sha, CASE WHEN n.acc IS NULL THEN status ELSE 404 END AS status, CASE WHEN n.acc IS NULL THEN err ELSE 'HTTP 404' END AS err FROM raw FULL JOIN n ON n.acc = raw.acc)""")
def raw_merge_failure(spark, sf):
    """Raw rows after fetches that failed: what has a document keeps it and its description, what has none takes the reference."""
    failed = _filings(spark, sf).filter("parse_error is not null").select("accession_number", F.col("insider_cik").alias("cik"), F.col("period_of_report").alias("filing_date"), F.lit("asked.xml").alias("primary_document"), F.lit(404).alias("http_status"), F.lit("HTTP 404").alias("fetch_error"), _now().cast("timestamp_ntz").alias("fetched_at"))
    return _shown(ingest.raw_failure(_raw(spark, sf), failed))


@query(_F + _RAW + "SELECT f.acc AS accession_number, coalesce(sha NOT LIKE 'e3b0c442%', false) AS skip_fetch FROM f LEFT JOIN raw USING (acc)")
def skip_fetch(spark, sf):
    """Which filings have a stored document and need no fetch."""
    known = _raw(spark, sf).select("accession_number", ingest.has_document().alias("has"))
    return _filings(spark, sf).select("accession_number").join(known, "accession_number", "left").select("accession_number", F.coalesce("has", F.lit(False)).alias("skip_fetch"))


# --- discovery ---------------------------------------------------------------------------------------------------------------------


def _index_lines(spark, sf) -> DataFrame:
    """An index line per filing: amendments without a document in their path, filings without schema version with a path that says nothing, and dates that
    are none where there is no period."""
    f = _filings(spark, sf)
    folder = F.concat(F.lit("edgar/data/"), X.cik_segment("issuer_cik"), F.lit("/"), X.accession_plain("accession_number"))
    path = F.when(F.col("schema_version").isNull(), F.lit("edgar/data/lost.txt")).when(F.col("is_amendment"), folder).otherwise(F.concat(folder, F.lit("/doc4.xml")))
    return f.select(F.concat_ws("|", "issuer_cik", F.lit("Name"), "document_type", F.coalesce(K.iso("period_of_report"), F.lit("2024-13-01")), path).alias("value"))


@query(_F + r"""SELECT acc AS accession_number, 'doc4.xml' AS primary_document, NULL AS error_type, count(*) AS n FROM f WHERE por IS NOT NULL AND schema_version IS NOT NULL AND NOT is_amendment AND document_type IN ('4', '4/A') GROUP BY ALL
UNION ALL SELECT acc, 'form4.xml', NULL, count(*) FROM f WHERE por IS NOT NULL AND schema_version IS NOT NULL AND is_amendment AND insider_title IS NOT NULL AND document_type IN ('4', '4/A') GROUP BY ALL
UNION ALL SELECT acc, NULL, 'missing_primary_document', count(*) FROM f WHERE por IS NOT NULL AND schema_version IS NOT NULL AND is_amendment AND insider_title IS NULL AND document_type IN ('4', '4/A') GROUP BY ALL
UNION ALL SELECT NULL, NULL, 'bad_archive_path', count(*) FROM f WHERE por IS NOT NULL AND schema_version IS NULL AND document_type IN ('4', '4/A') HAVING count(*) > 0
UNION ALL SELECT NULL, NULL, 'bad_date', count(*) FROM f WHERE por IS NULL AND document_type IN ('4', '4/A') HAVING count(*) > 0""")
def index_references(spark, sf):
    """References of index lines, resolved by index pages where the path names no document, and the dead letters of those that name none."""
    lines = _index_lines(spark, sf)
    resolved = _filings(spark, sf).filter("insider_title is not null").select("accession_number", F.lit("form4.xml").alias("primary_document"))
    refs, lost = ingest.references(landed.master_index(lines), resolved)
    none = F.lit(None).cast("string")
    good = refs.select("accession_number", "primary_document", none.alias("error_type"))
    bad = lost.select("accession_number", none.alias("primary_document"), "error_type")
    rejects = landed.master_index_rejects(lines).select(none.alias("accession_number"), none.alias("primary_document"), F.col("reason").alias("error_type"))
    return good.unionByName(bad).unionByName(rejects).groupBy("accession_number", "primary_document", "error_type").agg(F.count("*").alias("n"))


@query(_F + r"""SELECT acc AS accession_number, lpad(regexp_replace(issuer_cik, '[^0-9]', '', 'g'), 10, '0') AS cik, strftime(por, '%Y-%m-%d') AS filing_date FROM f
WHERE document_type IN ('4', '4/A') AND por BETWEEN DATE '2024-03-01' AND DATE '2024-09-30' AND lpad(regexp_replace(issuer_cik, '[^0-9]', '', 'g'), 10, '0') IN (SELECT lpad(regexp_replace(cik, '^\s+|\s+$', '', 'g'), 10, '0') FROM security_master WHERE cik IS NOT NULL)""")
def references_by_cik(spark, sf):
    """References of the submission records of listed ciks, filed within a range of days."""
    f = _filings(spark, sf)
    one = lambda c: F.array(c)
    record = F.struct(F.col("issuer_cik").alias("cik"), F.struct(F.struct(one(F.col("document_type")).alias("form"), one(F.coalesce(K.iso("period_of_report"), F.lit(""))).alias("filingDate"), one(F.col("accession_number")).alias("accessionNumber"), one(F.lit("d.xml")).alias("primaryDocument")).alias("recent")).alias("filings"))
    refs = ingest.submission_references(f.select(F.to_json(record).alias("value")), "2024-03-01", "2024-09-30")
    return ingest.allowed(refs, table(spark, sf, "security_master").select("cik")).select("accession_number", "cik", K.iso("filing_date").alias("filing_date"))


# --- the run -----------------------------------------------------------------------------------------------------------------------

# What happens to a filing that has transactions, by what its row says: stored (a title), unanswered (no title, no schema version), HTML (no title, an amendment), damaged
# in transit (a message), parsed before (no period).
_RUN = """
, d AS (SELECT f.*, acc IN (SELECT accession_number FROM form4_transaction) AS has FROM f)
, s AS (SELECT acc, CASE WHEN insider_title IS NULL AND schema_version IS NULL THEN 'fetch_failed' WHEN por IS NULL THEN 'skipped' WHEN parse_error IS NOT NULL OR (insider_title IS NULL AND is_amendment) THEN 'parse_failed' ELSE 'ingested' END AS status FROM d WHERE has)
"""


def _run(spark, sf) -> ingest.Ingested:
    f = _filings(spark, sf)
    shared_folder(spark)
    # written once, as landed documents are, and read as references, stored documents and pages
    xml = reference.ownership_xml(spark, sf).join(f.select("accession_number", "is_amendment", "schema_version", "insider_title", "parse_error", "period_of_report"), "accession_number").checkpoint()
    body = F.when(F.col("parse_error").isNotNull(), F.substring("xml", 1, 200)).otherwise(F.col("xml"))
    refs = f.join(xml.select("accession_number"), "accession_number", "left_semi").select("accession_number", F.col("issuer_cik").alias("cik"), F.col("period_of_report").alias("filing_date"), F.lit("d.xml").alias("primary_document"))
    raw = xml.filter("insider_title is not null").select("accession_number", F.lit("1").alias("cik"), F.col("period_of_report").alias("filing_date"), F.lit(None).cast("timestamp_ntz").alias("accepted_at"), F.lit("d.xml").alias("primary_document"), F.lit(None).cast("string").alias("raw_uri"), body.cast("binary").alias("raw_xml"), X.content_sha(body).alias("content_sha256"), _now().cast("timestamp_ntz").alias("fetched_at"), F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("fetch_error"))
    page = F.when(F.col("is_amendment"), F.lit("<html><head></head></html>")).otherwise(body)
    lost = F.col("schema_version").isNull()
    pages = xml.filter("insider_title is null").select("accession_number", F.when(lost, 404).otherwise(200).alias("status"), F.when(~lost, page.cast("binary")).alias("body"), F.lit(None).cast("string").alias("error"))
    loaded = table(spark, sf, "filing").limit(0).unionByName(table(spark, sf, "filing").filter("period_of_report is null").withColumn("parse_error", F.lit(None).cast("string")).dropDuplicates(["accession_number"]))
    return ingest.ingest(refs, pages, raw, loaded, table(spark, sf, "form4_transaction").limit(0), _now())


@query(_F + _RUN + "SELECT w.status, count(s.acc) AS n FROM (SELECT unnest(['ingested', 'skipped', 'fetch_failed', 'parse_failed', 'discover_failed']) AS status) w LEFT JOIN s USING (status) GROUP BY w.status")
def ingest_counts(spark, sf):
    """How many references of a run ended in which status."""
    return _run(spark, sf).counts()


@query(_F + _RUN + ", t AS (SELECT accession_number AS acc, count(DISTINCT transaction_index) AS n FROM form4_transaction GROUP BY 1) SELECT acc AS accession_number, n AS transactions FROM s JOIN t USING (acc) WHERE status = 'ingested'")
def ingest_loaded(spark, sf):
    """Filings that a run loaded, with the number of their transactions."""
    return _run(spark, sf).transactions.groupBy("accession_number").agg(F.count("*").alias("transactions"))


@query(_F + _RUN + """SELECT stage, error_type, count(*) AS n FROM (SELECT 'fetch' AS stage, 'http_error' AS error_type FROM s WHERE status = 'fetch_failed' UNION ALL SELECT 'parse', 'ParseError' FROM s WHERE status = 'parse_failed') GROUP BY ALL""")
def ingest_dead_letters(spark, sf):
    """Dead letters of a run by stage and kind."""
    return _run(spark, sf).dead_letters.groupBy("stage", "error_type").agg(F.count("*").alias("n"))


# --- profiles and index state ------------------------------------------------------------------------------------------------------


@query("""SELECT cik, CASE WHEN enrichment_status = 'ok' THEN entity_name END AS entity_name, CASE WHEN enrichment_status = 'ok' THEN sic_code END AS sic_code, enrichment_status FROM issuer_sec_profile
QUALIFY row_number() OVER (PARTITION BY cik ORDER BY fetched_at DESC, entity_name DESC NULLS LAST, sic_code DESC NULLS LAST, enrichment_status DESC) = 1""")
def merge_issuer_profile(spark, sf):
    """The last fetch of each issuer wins, a failed one with its nulls included."""
    rows = table(spark, sf, "issuer_sec_profile").select("cik", "entity_name", "sic_code", "fetched_at", "enrichment_status")
    last = merge.last_per_key(rows, ["cik"], ["fetched_at"])
    ok = F.col("enrichment_status") == "ok"
    fresh = last.select("cik", F.when(ok, F.col("entity_name")).alias("entity_name"), F.when(ok, F.col("sic_code")).alias("sic_code"), "enrichment_status")
    return ingest.upsert_profiles(fresh.limit(0), fresh, ["cik"])


@query(r"""WITH l AS (SELECT cik, max(entity_name) AS name, bool_or(enrichment_status <> 'ok') AS bad FROM issuer_sec_profile GROUP BY cik), p AS (SELECT lpad(nullif(regexp_replace(cik, '[^0-9]', '', 'g'), ''), 10, '0') AS cik, nullif(regexp_replace(name, '^\s+|\s+$', '', 'g'), '') AS name, bad FROM l)
SELECT cik, CASE WHEN NOT bad THEN name END AS entity_name, CASE WHEN bad THEN 'error' ELSE 'ok' END AS enrichment_status, CASE WHEN bad THEN 'HTTP 404' END AS error_message FROM p WHERE cik IS NOT NULL""")
def issuer_profiles(spark, sf):
    """Profiles of issuers from their submission records, and error rows of those that gave none."""
    last = table(spark, sf, "issuer_sec_profile").groupBy("cik").agg(F.max("entity_name").alias("name"), F.bool_or(F.col("enrichment_status") != "ok").alias("bad"))
    pages = last.select("cik", F.when(~F.col("bad"), F.to_json(F.struct("cik", "name"))).alias("value"), F.when(F.col("bad"), "HTTP 404").alias("error"))
    return ingest.issuer_profiles(last.select("cik"), pages, _now()).select("cik", "entity_name", "enrichment_status", "error_message")


@query(r"""WITH m AS (SELECT upper(trim(ticker, ' ' || chr(9))) AS ticker, max(cik) AS cik FROM universe_snapshot WHERE trading_date = (SELECT max(trading_date) FROM universe_snapshot) GROUP BY 1)
, q AS (SELECT replace(upper(trim(ticker, ' ' || chr(9))), '.', '-') AS symbol, max(long_name) AS long_name, max(market_cap) AS cap, max(quote_type) AS quote_type, bool_or(enrichment_status = 'error') AS bad FROM universe_company_profile GROUP BY 1)
SELECT ticker, cik, CASE WHEN NOT coalesce(bad, true) THEN cap END AS market_cap, CASE WHEN NOT coalesce(bad, true) THEN nullif(regexp_replace(long_name, '^\s+|\s+$', '', 'g'), '') END AS long_name,
  CASE WHEN coalesce(bad, true) THEN 'error' WHEN coalesce(quote_type, '') <> 'NONE' AND (coalesce(regexp_replace(long_name, '^\s+|\s+$', '', 'g'), '') <> '' OR coalesce(cap, 0) <> 0) THEN 'ok' ELSE 'no_data' END AS enrichment_status FROM m LEFT JOIN q ON q.symbol = replace(ticker, '.', '-')""")
def company_profiles(spark, sf):
    """Profiles of the last session's tickers from quote records."""
    members = reference._universe(spark, sf)
    day = members.agg(F.max("trading_date").cast("string")).head()[0]
    q = table(spark, sf, "universe_company_profile").groupBy(X.quote_symbol(K.ticker("ticker")).alias("symbol")).agg(F.max("long_name").alias("longName"), F.max("market_cap").alias("marketCap"), F.max("quote_type").alias("quoteType"), F.bool_or(F.col("enrichment_status") == "error").alias("bad"))
    quotes = q.select("symbol", F.when(~F.col("bad"), F.to_json(F.struct("longName", "marketCap", "quoteType", "symbol"))).alias("value"), F.when(F.col("bad"), "timeout").alias("error"))
    return ingest.company_profiles(members, quotes, day, _now()).select("ticker", "cik", "market_cap", "long_name", "enrichment_status")


@query(_F + """SELECT acc AS chunk_id, CASE WHEN por IS NULL OR parse_error IS NOT NULL THEN 'error' ELSE 'ok' END AS status, strftime(CASE WHEN por IS NULL OR parse_error IS NOT NULL THEN NULL WHEN insider_title IS NOT NULL AND NOT is_amendment THEN parsed_at ELSE TIMESTAMP '2025-01-01' END, '%Y-%m-%d') AS embedded_at,
  CASE WHEN insider_title IS NOT NULL AND NOT is_amendment AND por IS NOT NULL AND parse_error IS NULL THEN 'kept' ELSE 'tried' END AS what FROM f""")
def index_state_merge(spark, sf):
    """Index state after a run: what was tried gets its time of embedding only if it went well; what was not pending keeps the old."""
    f = _filings(spark, sf)
    bad = F.col("period_of_report").isNull() | F.col("parse_error").isNotNull()
    pending = F.col("insider_title").isNull() | F.col("is_amendment") | bad
    at = F.when(pending, _now().cast("timestamp_ntz")).otherwise(F.col("parsed_at").cast("timestamp_ntz"))
    row = lambda df: df.select(F.col("accession_number").alias("chunk_id"), F.when(bad, "error").otherwise("ok").alias("status"), F.when(~bad, at).alias("embedded_at"), F.when(pending, "tried").otherwise("kept").alias("what"))
    known = f.select(F.col("accession_number").alias("chunk_id"), F.lit("ok").alias("status"), F.col("parsed_at").cast("timestamp_ntz").alias("embedded_at"), F.lit("kept").alias("what"))
    return merge.upsert(known, row(f.filter(pending)), ["chunk_id"]).withColumn("embedded_at", K.iso("embedded_at"))


@query("SELECT document_type AS model_id, CASE WHEN parse_error IS NULL THEN 'ok' ELSE 'error' END AS status, count(DISTINCT accession_number) AS n FROM filing GROUP BY ALL")
def index_state_counts(spark, sf):
    """Rows of an index state by model and status, the form standing for the model."""
    rows = table(spark, sf, "filing").select("accession_number", F.col("document_type").alias("model_id"), F.when(F.col("parse_error").isNull(), "ok").otherwise("error").alias("status")).distinct()
    return rows.groupBy("model_id", "status").agg(F.count("*").alias("n"))


# --- keyed merges of the loaded tables ---------------------------------------------------------------------------------------------

_CUT = "TIMESTAMP '2024-07-01'"


def _sides(rows: DataFrame, keys: list[str], at: str) -> tuple[DataFrame, DataFrame]:
    """The last row per key of what came before the cut, and of what came after it."""
    early = F.col(at).cast("timestamp_ntz") < F.lit("2024-07-01 00:00:00").cast("timestamp_ntz")
    return merge.last_per_key(rows.filter(early), keys, [at]), merge.last_per_key(rows.filter(~early), keys, [at])


def _sides_sql(rows: str, keys: str, at: str, rest: str) -> str:
    pick = lambda op: f"SELECT * FROM rows WHERE {at} {op} {_CUT} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {at} DESC, {rest}) = 1"
    return f"WITH rows AS ({rows}), t AS ({pick('<')}), s AS ({pick('>=')})"


@query(_sides_sql("SELECT trading_date::DATE AS d, upper(trim(ticker, ' ' || chr(9))) AS ticker, lower(trim(universe_group, ' ' || chr(9))) AS g, cik, source, created_at FROM universe_snapshot", "d, ticker, g", "created_at", "cik DESC NULLS LAST, source DESC") + """
SELECT strftime(coalesce(s.d, t.d), '%Y-%m-%d') AS trading_date, coalesce(s.ticker, t.ticker) AS ticker, coalesce(s.g, t.g) AS universe_group, CASE WHEN s.d IS NULL THEN t.cik ELSE s.cik END AS cik, strftime(coalesce(t.created_at, s.created_at), '%Y-%m-%d') AS created_at FROM t FULL JOIN s ON s.d = t.d AND s.ticker = t.ticker AND s.g = t.g""")
def merge_universe(spark, sf):
    """Session membership after a later delivery: cik and source are replaced, the time of creation stays."""
    keys = ["trading_date", "ticker", "universe_group"]
    rows = table(spark, sf, "universe_snapshot").select("trading_date", K.ticker("ticker").alias("ticker"), K.group_name("universe_group").alias("universe_group"), "cik", "source", "created_at")
    target, source = _sides(rows, keys, "created_at")
    return merge.upsert(target, source, keys, {"created_at": merge.keep_old}).select(*[K.iso(c).alias(c) if c in ("trading_date", "created_at") else F.col(c) for c in (*keys, "cik", "created_at")])


@query(_sides_sql("SELECT upper(trim(ticker, ' ' || chr(9))) AS ticker, price_date::DATE AS d, close, volume, source, ingested_at FROM security_daily_prices WHERE close IS NOT NULL", "ticker, d", "ingested_at", "close DESC, volume DESC NULLS LAST, source DESC") + """
SELECT coalesce(s.ticker, t.ticker) AS ticker, strftime(coalesce(s.d, t.d), '%Y-%m-%d') AS price_date, CASE WHEN s.d IS NULL THEN t.close ELSE s.close END AS close, CASE WHEN s.d IS NULL THEN t.volume ELSE s.volume END AS volume FROM t FULL JOIN s ON s.ticker = t.ticker AND s.d = t.d""")
def merge_prices(spark, sf):
    """Bars after a later ingestion: everything is replaced; bars without a usable close are left out before."""
    keys = ["ticker", "price_date"]
    rows = table(spark, sf, "security_daily_prices").filter(X.finite_price("close").isNotNull()).select(K.ticker("ticker").alias("ticker"), "price_date", "close", "volume", "source", "ingested_at")
    target, source = _sides(rows, keys, "ingested_at")
    return merge.upsert(target, source, keys).select("ticker", K.iso("price_date").alias("price_date"), "close", "volume")


@query(_sides_sql("SELECT trading_date::DATE AS d, lower(trim(universe_group, ' ' || chr(9))) AS g, upper(trim(ticker, ' ' || chr(9))) AS ticker, close, ret_5d, created_at FROM universe_market_context", "d, g, ticker", "created_at", "close DESC NULLS LAST, ret_5d DESC NULLS LAST") + """
SELECT strftime(coalesce(s.d, t.d), '%Y-%m-%d') AS trading_date, coalesce(s.g, t.g) AS universe_group, coalesce(s.ticker, t.ticker) AS ticker, CASE WHEN s.d IS NULL THEN t.close ELSE s.close END AS close, CASE WHEN s.d IS NULL THEN t.ret_5d ELSE s.ret_5d END AS ret_5d, strftime(coalesce(s.created_at, t.created_at), '%Y-%m-%d') AS created_at FROM t FULL JOIN s ON s.d = t.d AND s.ticker = t.ticker AND s.g = t.g""")
def merge_context(spark, sf):
    """Market context after a later run: everything is replaced, the time of creation too."""
    keys = ["trading_date", "universe_group", "ticker"]
    rows = table(spark, sf, "universe_market_context").select("trading_date", K.group_name("universe_group").alias("universe_group"), K.ticker("ticker").alias("ticker"), "close", "ret_5d", "created_at")
    target, source = _sides(rows, keys, "created_at")
    return merge.upsert(target, source, keys).select(K.iso("trading_date").alias("trading_date"), "universe_group", "ticker", "close", "ret_5d", K.iso("created_at").alias("created_at"))


@query(_sides_sql("SELECT trading_date::DATE AS d, upper(trim(ticker, ' ' || chr(9))) AS ticker, sector, market_cap, enrichment_status, fetched_at FROM universe_company_profile", "d, ticker", "fetched_at", "sector DESC NULLS LAST, market_cap DESC NULLS LAST, enrichment_status DESC") + """
SELECT strftime(coalesce(s.d, t.d), '%Y-%m-%d') AS trading_date, coalesce(s.ticker, t.ticker) AS ticker, CASE WHEN s.d IS NULL THEN t.sector ELSE s.sector END AS sector, CASE WHEN s.d IS NULL THEN t.market_cap ELSE s.market_cap END AS market_cap, CASE WHEN s.d IS NULL THEN t.enrichment_status ELSE s.enrichment_status END AS enrichment_status FROM t FULL JOIN s ON s.d = t.d AND s.ticker = t.ticker""")
def merge_session_profiles(spark, sf):
    """Session profiles after a later fetch: everything is replaced, by nulls too."""
    keys = ["trading_date", "ticker"]
    rows = table(spark, sf, "universe_company_profile").select("trading_date", K.ticker("ticker").alias("ticker"), "sector", "market_cap", "enrichment_status", "fetched_at")
    target, source = _sides(rows, keys, "fetched_at")
    return merge.upsert(target, source, keys).select(K.iso("trading_date").alias("trading_date"), "ticker", "sector", "market_cap", "enrichment_status")


# --- loaded tables together --------------------------------------------------------------------------------------------------------


@query(_F + _RAW + "SELECT document_type, raw.status AS http_status, count(*) AS transactions FROM (SELECT DISTINCT accession_number, transaction_index FROM form4_transaction) t JOIN f ON f.acc = t.accession_number JOIN raw ON raw.acc = f.acc GROUP BY ALL")
def transactions_with_raw(spark, sf):
    """Transactions with their filing and raw document, three tables on one key."""
    tx = table(spark, sf, "form4_transaction").select("accession_number", "transaction_index").distinct()
    raw = _raw(spark, sf).select("accession_number", "http_status")
    return tx.join(_filings(spark, sf).select("accession_number", "document_type"), "accession_number").join(raw, "accession_number").groupBy("document_type", "http_status").agg(F.count("*").alias("transactions"))


@query("WITH made AS (" + reference.SQL["screen_universe"] + """), k AS (SELECT upper(trim(ticker, ' ' || chr(9))) AS t, max(cik) AS cik FROM security_master WHERE cik IS NOT NULL GROUP BY 1)
SELECT trading_date, universe_group, ticker, coalesce(a.cik, b.cik, c.cik) AS cik FROM made LEFT JOIN k a ON a.t = ticker LEFT JOIN k b ON b.t = replace(ticker, '.', '-') LEFT JOIN k c ON c.t = replace(ticker, '-', '.')""")
def universe_build(spark, sf):
    """Session membership made from the screens, with ciks by the tickers' spellings, merged into an empty table."""
    made = universe.screen_members(table(spark, sf, "screen_line"))
    known = table(spark, sf, "security_master").filter("cik is not null").groupBy(K.ticker("ticker").alias("ticker")).agg(F.max("cik").alias("cik"))
    rows = made.join(universe.lookup_cik(made, known), "ticker", "left").select("trading_date", "universe_group", "ticker", "cik")
    return merge.upsert(rows.limit(0), rows, ["trading_date", "universe_group", "ticker"]).withColumn("trading_date", K.iso("trading_date"))


@query(_F + r"""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN parse_error IS NOT NULL THEN 'missing ownershipDocument root' WHEN insider_title IS NULL THEN 'missing documentType' WHEN schema_version IS NULL THEN 'unsupported documentType ''3''' WHEN por IS NULL THEN 'missing issuerCik' ELSE 'read' END AS reason FROM f) GROUP BY reason""")
def xml_validation(spark, sf):
    """Documents that lack what makes them ownership documents, by what they lack."""
    f = _filings(spark, sf)
    kind = F.when(F.col("insider_title").isNull(), F.lit("")).when(F.col("schema_version").isNull(), "3").otherwise("4")
    cik = F.when(F.col("period_of_report").isNull(), F.lit(" ")).otherwise(F.lit("7"))
    root = F.when(F.col("parse_error").isNotNull(), F.lit("other")).otherwise(F.lit("ownershipDocument"))
    xml = F.concat(F.lit("<"), root, F.lit("><documentType>"), kind, F.lit("</documentType><issuer><issuerCik>"), cik, F.lit("</issuerCik></issuer></"), root, F.lit(">"))
    return landed.ownership(f.select("accession_number", xml.alias("xml"))).groupBy(F.coalesce("parse_error", F.lit("read")).alias("reason")).agg(F.count("*").alias("n"))


@query(r"""WITH x AS (SELECT DISTINCT accession_number, insider_title, is_amendment, insider_cik FROM filing)
SELECT accession_number, concat_ws('; ', nullif(regexp_replace(insider_title, '^\s+|\s+$', '', 'g'), ''), CASE WHEN is_amendment THEN 'director' END, CASE WHEN insider_cik IS NULL THEN 'ten percent owner' END, 'other') AS insider_title FROM x""")
def insider_titles(spark, sf):
    """Roles of the first owner as one title."""
    f = table(spark, sf, "filing").select("accession_number", "insider_title", "is_amendment", "insider_cik").distinct()
    text = F.replace(F.replace(F.coalesce("insider_title", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    flag = lambda c: F.when(c, F.lit("1")).otherwise("0")
    xml = F.concat(F.lit("<ownershipDocument><documentType>4</documentType><issuer><issuerCik>7</issuerCik></issuer><reportingOwner><reportingOwnerRelationship><isOfficer>true</isOfficer><officerTitle>"), text, F.lit("</officerTitle><isDirector>"), flag(F.col("is_amendment")), F.lit("</isDirector><isTenPercentOwner>"), flag(F.col("insider_cik").isNull()), F.lit("</isTenPercentOwner><isOther>True</isOther><otherText> other </otherText></reportingOwnerRelationship></reportingOwner></ownershipDocument>"))
    return landed.ownership_header(landed.ownership(f.select("accession_number", xml.alias("xml")))).select("accession_number", "insider_title")


@query(r"""SELECT DISTINCT accession_number, regexp_replace(regexp_replace(issuer_name || '  ' || coalesce(insider_name, ''), '[ \t\r\n]+', ' ', 'g'), '^ | $', '', 'g') AS line, least(20, greatest(1, length(accession_number) - 15))::INTEGER AS clamped, CASE WHEN issuer_name IS NULL THEN 0 ELSE 1 END + CASE WHEN insider_name IS NULL THEN 0 ELSE 1 END AS known FROM filing""")
def text_and_bounds(spark, sf):
    """White space collapsed, a number held within bounds, null entries of a map dropped."""
    f = table(spark, sf, "filing").select("accession_number", "issuer_name", "insider_name")
    line = X.one_line(F.concat("issuer_name", F.lit("  "), F.coalesce("insider_name", F.lit(""))))
    known = F.size(X.known_metadata(F.create_map(F.lit("issuer"), F.col("issuer_name"), F.lit("insider"), F.col("insider_name"))))
    return f.select("accession_number", line.alias("line"), X.clamp(F.length("accession_number") - 15, 1, 20).alias("clamped"), known.alias("known")).distinct()


@query(r"""SELECT DISTINCT upper(regexp_replace(ticker, '^\s+|\s+$', '', 'g')) AS ticker, lpad(nullif(regexp_replace(cik, '[^0-9]', '', 'g'), ''), 10, '0') AS cik FROM (SELECT ticker, max(cik) AS cik FROM security_master GROUP BY ticker)""")
def ticker_map(spark, sf):
    """Tickers and ciks read back from records of records, a thousand or so in each."""
    rows = table(spark, sf, "security_master").groupBy("ticker").agg(F.max("cik").alias("cik"))
    parts = F.pmod(F.xxhash64("ticker"), F.ceil(rows.select(F.count("*") / 1000).scalar()))
    records = rows.groupBy(parts.alias("part")).agg(F.map_from_entries(F.collect_list(F.struct("ticker", F.struct(F.col("cik").alias("cik_str"), "ticker")))).alias("m"))
    return landed.ticker_map(records.select(F.to_json("m").alias("value"))).distinct()


@query("SELECT DISTINCT accession_number, issuer_name || chr(65533) AS text FROM filing WHERE issuer_name IS NOT NULL")
def decoded_text(spark, sf):
    """Text of bytes of which the last one is no UTF-8."""
    f = table(spark, sf, "filing").filter("issuer_name is not null").select("accession_number", "issuer_name").distinct()
    return f.select("accession_number", landed.text_of(F.concat(F.encode("issuer_name", "UTF-8"), F.unhex(F.lit("FF")))).alias("text"))


@query(r"""WITH n AS (SELECT DISTINCT lower(file_name) AS f FROM screen_line), k AS (SELECT strptime(regexp_extract(f, '([0-9]{2}-[0-9]{2}-[0-9]{4})[.]csv$', 1), '%m-%d-%Y')::DATE AS d, contains(f, 'highs') AS high FROM n)
SELECT strftime(d, '%Y-%m-%d') AS trading_date, count(*) FILTER (WHERE high) AS highs, count(*) FILTER (WHERE NOT high) AS lows, count(*) FILTER (WHERE high) = 1 AND count(*) FILTER (WHERE NOT high) = 1 AS complete FROM k GROUP BY d""")
def screen_pairs(spark, sf):
    """Which days have exactly one screen file of each side."""
    names = table(spark, sf, "screen_line").select(F.lower("file_name").alias("f")).distinct()
    told = names.select(F.try_to_date(F.regexp_extract("f", r"([0-9]{2}-[0-9]{2}-[0-9]{4})\.csv$", 1), "MM-dd-yyyy").alias("d"), F.col("f").contains("highs").alias("high"))
    g = told.groupBy("d").agg(F.count_if("high").alias("highs"), F.count_if(~F.col("high")).alias("lows"))
    return g.select(K.iso("d").alias("trading_date"), "highs", "lows", ((F.col("highs") == 1) & (F.col("lows") == 1)).alias("complete"))

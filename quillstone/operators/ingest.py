"""From index rows to loaded filings, set by set: references, fetched pages, raw documents, parsed filings, dead letters.

A set of references takes the place of a loop over filings. Each step is a join on the accession number that gives every reference a status; what a step
rejects becomes dead letters with the step's name, and the rest goes on. The parsed documents are written once to the shared checkpoint folder, because four
results are cut from them. Nothing is asked of a network here: pages come as a table, from the ``pages`` source or from landed files.

Statuses: ``ingested``, ``skipped`` (parsed without error before), ``fetch_failed``, ``parse_failed``; and ``discover_failed`` for index rows that name no
document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import filings as X
from quillstone.operators import merge, universe
from quillstone.session import shared_folder
from quillstone.sources import http, landed

STATUSES = ("ingested", "skipped", "fetch_failed", "parse_failed", "discover_failed")
#: Raw documents by accession number.
RAW = "accession_number string, cik string, filing_date date, accepted_at timestamp_ntz, primary_document string, raw_uri string, raw_xml binary, content_sha256 string, fetched_at timestamp_ntz, http_status int, fetch_error string"


def allowed(refs: DataFrame, ciks: DataFrame | None, column: str = "cik") -> DataFrame:
    """References of the listed ciks, in whatever spelling; all if there is no list."""
    if ciks is None:
        return refs
    wanted = ciks.select(F.lpad(X.strip(column), 10, "0").alias("__cik")).filter("__cik is not null").distinct()
    return refs.withColumn("__cik", F.lpad(X.strip(column), 10, "0")).join(wanted, "__cik", "left_semi").drop("__cik")


def _letters(df: DataFrame, stage: str, kind: Column, message: Column, payload: Column) -> DataFrame:
    return df.select("accession_number", F.lit(stage).alias("stage"), kind.alias("error_type"), F.left(message, F.lit(universe.MESSAGE)).alias("message"), payload.alias("payload"))


def references(rows: DataFrame, resolved: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(references, dead letters) of index rows (cik, form, filed, path). ``resolved`` has (accession_number, primary_document) read from filings' index pages,
    for paths that name no document. A filing that is listed twice is one reference, the latest listed."""
    named = rows.select("cik", "form", F.col("filed").alias("filing_date"), "path", X.accession_of_path("path").alias("accession_number"), X.document_of_path("path").alias("__named"))
    if resolved is None:
        named = named.withColumn("primary_document", F.col("__named"))
    else:
        known = resolved.select("accession_number", F.col("primary_document").alias("__resolved"))
        named = named.join(known, "accession_number", "left").withColumn("primary_document", F.coalesce("__named", "__resolved")).drop("__resolved")
    good = F.col("accession_number").isNotNull() & F.col("primary_document").isNotNull()
    refs = merge.last_per_key(named.filter(good).select("accession_number", "cik", "filing_date", "primary_document", "form"), ["accession_number"], ["filing_date"])
    lost = F.col("accession_number").isNull()
    kind = F.when(lost, "bad_archive_path").otherwise("missing_primary_document")
    why = F.when(lost, "could not derive accession from master index path").otherwise("could not resolve primary document")
    return refs, _letters(named.filter(~good), "discover", kind, why, F.to_json(F.struct(F.col("path").alias("archive_path"))))


def has_document(storage: str = "bytes") -> Column:
    """Whether a raw row has a fetched document where it should be: in its column, or at its address."""
    there = F.length("raw_xml") > 0 if storage == "bytes" else F.length("raw_uri") > 0
    return F.coalesce((F.col("content_sha256") != X.EMPTY_SHA) & there, F.lit(False))


def raw_success(raw: DataFrame, fetched: DataFrame) -> DataFrame:
    """Raw rows after fetches that succeeded: all columns are replaced and the error is cleared, but a known time of acceptance stays if none comes."""
    fresh = fetched.select(*[F.lit(None).cast("string").alias(c) if c == "fetch_error" else F.col(c) for c in raw.columns])
    return merge.upsert(raw, fresh, ["accession_number"], {"accepted_at": merge.keep_old_if_null})


def raw_failure(raw: DataFrame, failed: DataFrame) -> DataFrame:
    """Raw rows after fetches that failed; ``failed`` has (accession_number, cik, filing_date, primary_document, http_status, fetch_error, fetched_at).

    A row that has a document keeps it and all that describes it; only status, error and time change. A row without one takes the reference too."""
    new = failed.select("accession_number", F.struct("cik", "filing_date", "primary_document", "http_status", "fetch_error", "fetched_at").alias("__f"))
    both = raw.withColumn("__t", F.lit(True)).join(new, "accession_number", "full_outer")
    kept = F.col("__t") & ~F.col("content_sha256").eqNullSafe(F.lit(X.EMPTY_SHA))
    hit = F.col("__f").isNotNull()
    out = []
    for c in raw.columns:
        old = F.col(c)
        if c in ("http_status", "fetch_error", "fetched_at"):
            out.append(F.when(hit, F.col("__f")[c]).otherwise(old).alias(c))
        elif c in ("cik", "filing_date", "primary_document"):
            out.append(F.when(hit & ~F.coalesce(kept, F.lit(False)), F.col("__f")[c]).otherwise(old).alias(c))
        elif c == "content_sha256":
            out.append(F.when(F.col("__t").isNull(), F.lit(X.EMPTY_SHA)).otherwise(old).alias(c))
        else:
            out.append(old)
    return both.select(*out)


@dataclass(frozen=True)
class Ingested:
    """What a run leaves: the new state of the tables, its dead letters, and the status of each reference."""

    raw: DataFrame
    filing: DataFrame
    transactions: DataFrame
    dead_letters: DataFrame
    status: DataFrame

    def counts(self) -> DataFrame:
        """(status, n) with a row for every status."""
        names = F.explode(F.array(*[F.lit(s) for s in STATUSES])).alias("status")
        every = self.status.sparkSession.range(1).select(names)
        return every.join(self.status.groupBy("status").agg(F.count("*").alias("k")), "status", "left").select("status", F.coalesce("k", F.lit(0)).alias("n"))


def ingest(refs: DataFrame, pages: DataFrame, raw: DataFrame, filing: DataFrame, transactions: DataFrame, now: Column, *, storage: str = "bytes", force_fetch: bool = False, force_parse: bool = False, second: DataFrame | None = None, documents: DataFrame | None = None, strict_footnotes: bool = False) -> Ingested:
    """Runs a set of references (accession_number, cik, filing_date, primary_document).

    ``pages`` has (accession_number, status, body, error) of what was fetched, needed only for references without a stored document; ``second`` the same, with
    primary_document, of the documents that filings' index pages name, for pages that turn out to be HTML. With ``storage`` ``uri`` stored documents are read from
    ``documents`` (raw_uri, body); one that is not there is fetched again. ``filing`` and ``transactions`` are the loaded tables. A parse error leaves the raw document in place and the loaded filing as it was."""
    shared_folder(refs.sparkSession)
    stored = raw.select("accession_number", "raw_uri", F.col("raw_xml") if storage == "bytes" else F.lit(None).cast("binary").alias("raw_xml"), has_document(storage).alias("__has"))
    if storage != "bytes" and documents is not None:
        stored = stored.drop("raw_xml").join(documents.select("raw_uri", F.col("body").alias("raw_xml")), "raw_uri", "left")
    stored = stored.drop("raw_uri")
    clean = filing.groupBy("accession_number").agg(F.bool_or(F.col("parse_error").isNull()).alias("__clean"))
    got = pages.select("accession_number", F.struct("status", "body", "error").alias("__page"))
    one = refs.join(stored, "accession_number", "left").join(got, "accession_number", "left").join(clean, "accession_number", "left")
    reuse = F.coalesce(F.col("__has"), F.lit(False)) & F.col("raw_xml").isNotNull() & F.lit(not force_fetch)
    body = F.when(reuse, F.col("raw_xml")).when((F.col("__page.status") == 200) & F.col("__page.error").isNull(), F.col("__page.body"))
    one = one.withColumns({"__reuse": reuse, "__body": body, "__document": F.col("primary_document")})
    if second is not None:
        more = second.filter("status = 200 and body is not null").select("accession_number", F.struct("body", F.col("primary_document").alias("name")).alias("__second"))
        html = X.looks_like_html(landed.text_of("__body")) & F.col("__second").isNotNull() & (F.col("__second.name") != F.col("primary_document"))
        one = one.join(more, "accession_number", "left").withColumn("__html", F.coalesce(html, F.lit(False)))
        one = one.withColumns({"__body": F.when(F.col("__html"), F.col("__second.body")).otherwise(F.col("__body")), "__document": F.when(F.col("__html"), F.col("__second.name")).otherwise(F.col("primary_document")), "__reuse": F.col("__reuse") & ~F.col("__html")}).drop("__second", "__html")
    skip = F.coalesce(F.col("__clean"), F.lit(False)) & F.lit(not force_parse)
    early = F.when(F.col("__body").isNull(), "fetch_failed").when(skip, "skipped")
    parsed = landed.ownership(one.withColumn("xml", F.when(early.isNull(), landed.text_of("__body"))).withColumn("__early", early))
    status = F.coalesce("__early", F.when(F.col("parse_error").isNotNull(), "parse_failed"), F.lit("ingested"))
    staged = parsed.withColumn("status", status).drop("xml", "raw_xml", "__has", "__clean", "__early").checkpoint()

    kept = staged.filter(~F.col("__reuse") & F.col("__body").isNotNull())
    fetched = kept.select(
        "accession_number", "cik", "filing_date", F.lit(None).cast("timestamp_ntz").alias("accepted_at"), F.col("__document").alias("primary_document"),
        F.when(F.lit(storage != "bytes"), X.content_path("", "accession_number", X.content_sha("__body"))).alias("raw_uri"), F.when(F.lit(storage == "bytes"), F.col("__body")).alias("raw_xml"),
        X.content_sha("__body").alias("content_sha256"), now.cast("timestamp_ntz").alias("fetched_at"), F.lit(200).alias("http_status"),
    )
    lost = staged.filter("status = 'fetch_failed'")
    why = F.coalesce("__page.error", F.concat(F.lit("HTTP "), F.col("__page.status").cast("string")), F.lit("no XML bytes available for parse"))
    failed = lost.select("accession_number", "cik", "filing_date", "primary_document", F.coalesce("__page.status", F.lit(0)).alias("http_status"), why.alias("fetch_error"), now.cast("timestamp_ntz").alias("fetched_at"))
    kind = F.when(F.col("__page").isNull(), "missing_bytes").when(F.col("__page.error").isNotNull(), "edgar_request_error").otherwise("http_error")
    asked = F.to_json(F.struct(F.col("primary_document").alias("document")))
    letters = _letters(lost, "fetch", kind, why, asked).unionByName(_letters(staged.filter("status = 'parse_failed'"), "parse", F.lit("ParseError"), F.col("parse_error"), F.lit(None).cast("string")))

    loaded = staged.filter("status = 'ingested'")
    header = landed.ownership_header(loaded).drop("warning").withColumns({"parsed_at": now.cast("timestamp_ntz"), "parse_error": F.lit(None).cast("string")})
    children = landed.ownership_transactions(loaded, strict_footnotes).join(header.select("accession_number", "issuer_ticker"), "accession_number")
    shape = lambda df, like: df.select(*[F.col(c).cast(like.schema[c].dataType) if c in df.columns else F.lit(None).cast(like.schema[c].dataType).alias(c) for c in like.columns])
    return Ingested(
        raw_failure(raw_success(raw, fetched), failed.filter(F.col("fetch_error").isNotNull())),
        merge.replace_children(filing, shape(header, filing), "accession_number"),
        # a filing without any transaction replaces its children by none
        transactions.join(header.select("accession_number"), "accession_number", "left_anti").unionByName(shape(children, transactions)),
        letters, staged.select("accession_number", "status"),
    )


def ingest_days(index_lines: DataFrame, first: str, last: str, ciks: DataFrame | None, **tables: DataFrame | Column | bool | str) -> tuple[Ingested, DataFrame]:
    """Index lines of a closed range of days, of the listed ciks, through ``ingest``; with the dead letters of discovery, those of bad index lines included."""
    rows, bad = landed.master_index(index_lines), landed.master_index_rejects(index_lines)
    refs, lost = references(allowed(rows.filter(F.col("filed").between(F.lit(first).cast("date"), F.lit(last).cast("date"))), ciks))
    done = ingest(refs.drop("form"), **tables)
    letters = lost.unionByName(_letters(bad.withColumn("accession_number", F.lit(None).cast("string")), "discover", F.col("reason"), F.col("line"), F.lit(None).cast("string")))
    status = done.status.unionByName(lost.select("accession_number", F.lit("discover_failed").alias("status")))
    return Ingested(done.raw, done.filing, done.transactions, done.dead_letters.unionByName(letters), status), letters


def submission_references(payloads: DataFrame, first: str, last: str) -> DataFrame:
    """References of submission records filed within a closed range of days; a filing that is listed twice is one."""
    rows = landed.submissions(payloads).filter(F.col("filed").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    refs = rows.select("accession_number", "cik", F.col("filed").alias("filing_date"), F.col("document").alias("primary_document"))
    return merge.last_per_key(refs.filter("accession_number is not null"), ["accession_number"], ["filing_date"])


# --- endpoints: addresses made from a table, fetched, and read ----------------------------------------------------------------------


def daily_indexes(days: DataFrame, agent: str, **how: object) -> tuple[DataFrame, DataFrame]:
    """(index lines (day, value), dead letters) of the daily indexes of days; a day without one is a dead letter."""
    pages = http.fetch_rows(days.select("day", X.daily_index_url("day").alias("url")), "url", agent, **how)
    good = pages.filter("error is null")
    lines = good.select("day", F.explode(F.split(landed.text_of("body"), "\r\n|\n|\r")).alias("value"))
    bad = pages.filter("error is not null").withColumn("accession_number", F.lit(None).cast("string"))
    return lines, _letters(bad, "discover", F.lit("edgar_request_error"), F.col("error"), F.to_json(F.struct(F.col("day").cast("string").alias("date"), "url")))


def submission_records(ciks: DataFrame, agent: str, **how: object) -> DataFrame:
    """(cik, value, error): the submission record of each cik."""
    asked = ciks.select(X.pad_cik("cik").alias("cik")).filter("cik is not null").distinct()
    pages = http.fetch_rows(asked.withColumn("url", X.submissions_url("cik")), "url", agent, **how)
    return pages.select("cik", F.when(F.col("error").isNull(), landed.text_of("body")).alias("value"), "error")


def resolve_documents(refs: DataFrame, agent: str, **how: object) -> DataFrame:
    """(accession_number, primary_document) that filings' index pages name; filings whose page names none, or can't be had, have no row."""
    pages = http.fetch_rows(refs.select("accession_number", X.filing_index_url("cik", "accession_number").alias("url")), "url", agent, **how)
    return pages.filter("error is null").select("accession_number", X.pick_href(landed.text_of("body")).alias("primary_document")).filter("primary_document is not null")


def documents(refs: DataFrame, agent: str, **how: object) -> DataFrame:
    """(accession_number, primary_document, status, body, error): the document of each reference, as ``ingest`` takes it."""
    asked = refs.select("accession_number", "primary_document", X.document_url("cik", "accession_number", "primary_document").alias("url"))
    return http.fetch_rows(asked, "url", agent, **how).drop("url")


# --- enrichment --------------------------------------------------------------------------------------------------------------------

ERROR = 2_000


def issuer_profiles(ciks: DataFrame, pages: DataFrame, now: Column) -> DataFrame:
    """Profile rows of ciks from their submission records; ``pages`` has (cik, value, error). What has no company fields is an error row without any."""
    asked = ciks.select(X.pad_cik("cik").alias("cik")).filter("cik is not null").distinct()
    got = pages.select(X.pad_cik("cik").alias("cik"), "value", "error")
    rows = asked.join(got, "cik", "left")
    fields = landed.company_fields(rows.withColumn("asked", F.col("cik")), keep=("asked", "error"))
    good = F.col("cik").isNotNull() & F.col("error").isNull()
    names = [c for c in fields.columns if c not in ("asked", "error", "cik")]
    message = F.when(~good, F.left(F.coalesce("error", F.lit("submissions JSON missing expected company fields")), F.lit(ERROR)))
    at = now.cast("timestamp_ntz")
    return fields.select(F.col("asked").alias("cik"), *[F.when(good, F.col(c)).alias(c) for c in names], at.alias("fetched_at"), at.alias("updated_at"), F.lit("sec_submissions").alias("source"), F.when(good, "ok").otherwise("error").alias("enrichment_status"), message.alias("error_message"))


def upsert_profiles(table: DataFrame, fresh: DataFrame, keys: list[str], protect: bool = False) -> DataFrame:
    """Profile table after a run. The last fetch wins, errors and their nulls included; with ``protect`` an error leaves a good row as it is."""
    if protect:
        good = table.filter("enrichment_status = 'ok'").select(*keys)
        fresh = fresh.filter("enrichment_status = 'ok'").unionByName(fresh.filter("enrichment_status <> 'ok'").join(good, keys, "left_anti"))
    return merge.upsert(table, fresh.select(*table.columns), keys)


QUOTE = "longName string, shortName string, marketCap decimal(28,2), regularMarketPrice double, quoteType string, symbol string, sector string, industry string, currency string"


def company_profiles(members: DataFrame, quotes: DataFrame, day: str, now: Column) -> DataFrame:
    """Profile rows of a session's tickers from quote records; ``quotes`` has (symbol, value, error) with the symbol as quote services write it."""
    session = members.filter(F.col("trading_date") == F.lit(day).cast("date")).groupBy("trading_date", "ticker").agg(F.max("cik").alias("cik"))
    info = quotes.select(F.col("symbol").alias("__symbol"), F.from_json("value", QUOTE).alias("q"), F.left("error", F.lit(ERROR)).alias("__error"))
    rows = session.withColumn("__symbol", X.quote_symbol("ticker")).join(info, "__symbol", "left")
    failed = F.col("__error").isNotNull() | F.col("q").isNull()
    status = F.when(failed, "error").otherwise(X.profile_status(F.col("q")))
    field = lambda c: F.when(~failed, c)
    at = now.cast("timestamp_ntz")
    return rows.select(
        "trading_date", "ticker", "cik", field(X.blank_to_null("q.sector")).alias("sector"), field(X.blank_to_null("q.industry")).alias("industry"), field(F.col("q.marketCap")).alias("market_cap"), F.lit(None).cast("string").alias("sic_code"),
        field(X.blank_to_null("q.quoteType")).alias("quote_type"), field(X.blank_to_null(F.coalesce("q.longName", "q.shortName"))).alias("long_name"), field(X.blank_to_null("q.currency")).alias("currency"),
        status.alias("enrichment_status"), F.when(failed, F.coalesce("__error", F.lit("no quote record"))).alias("error_message"), F.lit("quotes").alias("source"), at.alias("fetched_at"), at.alias("updated_at"),
    )


def status_counts(rows: DataFrame, column: str = "enrichment_status") -> DataFrame:
    return rows.groupBy(F.col(column).alias("status")).agg(F.count("*").alias("n"))


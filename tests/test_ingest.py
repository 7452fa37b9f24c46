import datetime as dt
import json

from pyspark.sql import functions as F

from quillstone.functions import filings as X
from quillstone.operators import ingest
from quillstone.sources import objects

def now():
    return F.lit(dt.datetime(2025, 1, 1))

FILING = "accession_number string, document_type string, is_amendment boolean, schema_version string, period_of_report date, issuer_cik string, issuer_name string, issuer_ticker string, insider_cik string, insider_name string, insider_title string, parsed_at timestamp_ntz, parse_error string"
TX = "accession_number string, transaction_index int, issuer_ticker string, transaction_category string, security_title string, transaction_date date, transaction_code string, acquired_disposed_code string, shares decimal(28,8), price_per_share decimal(28,8), total_value decimal(28,4), direct_indirect string, footnote_ids array<string>"
GOOD = b"<ownershipDocument><documentType>4</documentType><issuer><issuerCik>7</issuerCik><issuerTradingSymbol>QQ</issuerTradingSymbol></issuer><nonDerivativeTable><nonDerivativeTransaction><transactionCoding><transactionCode>S</transactionCode></transactionCoding></nonDerivativeTransaction></nonDerivativeTable></ownershipDocument>"
BARE = b"<ownershipDocument><documentType>4</documentType><issuer><issuerCik>7</issuerCik></issuer></ownershipDocument>"
D = dt.date(2024, 5, 6)


def raw_rows(spark, rows):
    return spark.createDataFrame([(a, "1", D, None, "old.xml", None, xml, sha, dt.datetime(2024, 1, 1), 200, err) for a, xml, sha, err in rows], ingest.RAW)


def run(spark, refs, pages, raw, loaded=(), children=(), **more):
    frame = spark.createDataFrame
    return ingest.ingest(
        frame([(a, "7", D, "d.xml") for a in refs], "accession_number string, cik string, filing_date date, primary_document string"), frame(pages, "accession_number string, status int, body binary, error string"), raw_rows(spark, raw),
        frame([(a, *[None] * 11, e) for a, e in loaded], FILING), frame([(a, i, *[None] * 11) for a, i in children], TX), now(), **more,
    )


def test_every_status_and_what_it_leaves(spark):
    refs = ["new", "kept", "clean", "lost", "gone", "error", "broken", "nothing", "bare"]
    pages = [("new", 200, GOOD, None), ("lost", 404, None, None), ("gone", None, None, "timed out"), ("error", 503, None, None), ("broken", 200, b"<ownershipDocument>", None), ("bare", 200, BARE, None)]
    raw = [("kept", bytearray(GOOD), "h", None), ("clean", bytearray(GOOD), "h", None), ("error", None, X.EMPTY_SHA, "HTTP 500"), ("other", bytearray(b"x"), "h", None)]
    done = run(spark, refs, pages, raw, [("clean", None), ("bare", "bad"), ("other", None)], [("clean", 0), ("bare", 0), ("bare", 1), ("other", 0)])
    assert {r.accession_number: r.status for r in done.status.collect()} == {"new": "ingested", "kept": "ingested", "clean": "skipped", "lost": "fetch_failed", "gone": "fetch_failed", "error": "fetch_failed", "broken": "parse_failed", "nothing": "fetch_failed", "bare": "ingested"}
    assert {r.status: r.n for r in done.counts().collect()} == {"ingested": 3, "skipped": 1, "fetch_failed": 4, "parse_failed": 1, "discover_failed": 0}
    r = {x.accession_number: x for x in done.raw.collect()}
    assert set(r) == {"new", "kept", "clean", "lost", "gone", "error", "broken", "nothing", "bare", "other"}
    assert bytes(r["new"].raw_xml) == GOOD and r["new"].fetch_error is None and r["lost"].content_sha256 == X.EMPTY_SHA and r["lost"].fetch_error == "HTTP 404" and r["gone"].http_status == 0 and r["error"].http_status == 503 and r["kept"].content_sha256 == "h"
    assert bytes(r["broken"].raw_xml) == b"<ownershipDocument>"  # the raw document stays though it can't be parsed
    assert {(x.accession_number, x.transaction_index, x.issuer_ticker) for x in done.transactions.collect()} == {("new", 0, "QQ"), ("kept", 0, "QQ"), ("clean", 0, None), ("other", 0, None)}  # all of bare's are gone
    assert {x.accession_number: x.parse_error for x in done.filing.collect()} == dict.fromkeys(["new", "kept", "clean", "bare", "other"])
    letters = {(x.accession_number, x.stage, x.error_type) for x in done.dead_letters.collect()}
    assert letters == {("lost", "fetch", "http_error"), ("gone", "fetch", "edgar_request_error"), ("error", "fetch", "http_error"), ("nothing", "fetch", "missing_bytes"), ("broken", "parse", "ParseError")}


def test_forcing_html_and_storage(spark):
    again = run(spark, ["kept"], [("kept", 200, GOOD, None)], [("kept", bytearray(BARE), "h", None)], [("kept", None)], force_fetch=True, force_parse=True)
    assert again.status.head().status == "ingested" and again.transactions.count() == 1 and bytes(again.raw.head().raw_xml) == GOOD
    second = spark.createDataFrame([("page", 200, GOOD, None, "real.xml")], "accession_number string, status int, body binary, error string, primary_document string")
    html = run(spark, ["page"], [("page", 200, b"<HTML><head>", None)], [], second=second, storage="uri")
    row = html.raw.head()
    assert html.status.head().status == "ingested" and row.primary_document == "real.xml" and row.raw_xml is None and row.raw_uri.endswith(f"{row.content_sha256}.xml")
    assert run(spark, ["page"], [("page", 200, b"<HTML><head>", None)], []).status.head().status == "parse_failed"


def test_failed_fetches_never_touch_a_document(spark):
    raw = raw_rows(spark, [("a", bytearray(b"x"), "h", None), ("b", None, X.EMPTY_SHA, "old"), ("c", bytearray(b"x"), None, None)])
    failed = spark.createDataFrame([(k, "9", dt.date(2024, 9, 9), "new.xml", 500, "HTTP 500", dt.datetime(2024, 9, 9)) for k in "abcd"], "accession_number string, cik string, filing_date date, primary_document string, http_status int, fetch_error string, fetched_at timestamp_ntz")
    got = {r.accession_number: (r.cik, r.primary_document, r.content_sha256, r.http_status, r.raw_xml is None) for r in ingest.raw_failure(raw, failed).collect()}
    assert got == {"a": ("1", "old.xml", "h", 500, False), "b": ("9", "new.xml", X.EMPTY_SHA, 500, True), "c": ("1", "old.xml", None, 500, False), "d": ("9", "new.xml", X.EMPTY_SHA, 500, True)}
    assert ingest.raw_failure(raw.limit(0), failed).count() == 4 and ingest.raw_failure(raw, failed.limit(0)).count() == 3


def test_a_range_of_days_of_listed_ciks(spark):
    path = "edgar/data/7/000071829323000917/d.xml"
    lines = [f"7|N|4|2024-05-06|{path}", f"7|N|4|2024-06-06|{path}", "8|N|4|2024-05-06|edgar/data/8/000071829323000918/d.xml", "7|N|4|2024-05-06|nowhere.txt", "7|N|4|2024-99-06|x"]
    frame = spark.createDataFrame
    acc = "0000718293-23-000917"
    done, letters = ingest.ingest_days(frame([(x,) for x in lines], "value string"), "2024-05-01", "2024-05-31", frame([(" 7",)], "cik string"), pages=frame([(acc, 200, GOOD, None)], "accession_number string, status int, body binary, error string"), raw=raw_rows(spark, []), filing=frame([], FILING), transactions=frame([], TX), now=now())
    assert {r.status: r.n for r in done.counts().collect()} == {"ingested": 1, "discover_failed": 1, "skipped": 0, "fetch_failed": 0, "parse_failed": 0}
    assert {(r.error_type, r.stage) for r in letters.collect()} == {("bad_archive_path", "discover"), ("bad_date", "discover")} and done.filing.head().accession_number == acc
    assert ingest.allowed(frame([("7",)], "cik string"), None).count() == 1


def test_profiles(spark):
    frame = spark.createDataFrame
    pages = frame([("7", json.dumps({"cik": 7, "name": "Seven", "tickers": ["S"]}), None), ("8", "{}", None), ("9", None, "HTTP 404")], "cik string, value string, error string")
    got = ingest.issuer_profiles(frame([("7",), ("008",), ("9",), ("9",), ("10",), (None,)], "cik string"), pages, now())
    rows = {r.cik[-2:]: (r.entity_name, r.enrichment_status, r.error_message) for r in got.collect()}
    expected = "submissions JSON missing expected company fields"
    assert rows == {"07": ("Seven", "ok", None), "08": (None, "error", expected), "09": (None, "error", "HTTP 404"), "10": (None, "error", expected)}
    assert {r.status: r.n for r in ingest.status_counts(got).collect()} == {"ok": 1, "error": 3}
    old = got.withColumn("entity_name", F.lit("Old")).withColumn("enrichment_status", F.lit("ok"))
    bad = got.filter("enrichment_status = 'error'")
    assert {r.entity_name for r in ingest.upsert_profiles(old, bad, ["cik"]).filter("cik <> '0000000007'").collect()} == {None}
    assert {r.entity_name for r in ingest.upsert_profiles(old, bad, ["cik"], protect=True).collect()} == {"Old"}


def test_endpoints_from_index_to_loaded_filing(spark):
    """A whole run over a web of three pages and one day without an index."""
    acc, plain = "0000718293-23-000917", "000071829323000917"
    web = {
        "https://www.sec.gov/Archives/edgar/daily-index/2024/QTR2/master20240506.idx": f"CIK|Company|Form|Date|File\n7|N|4|2024-05-06|edgar/data/7/{plain}\n".encode(),
        f"https://www.sec.gov/Archives/edgar/data/7/{plain}/{acc}-index.htm": b'<a href="/Archives/x/form4.xml">x</a>', "https://www.sec.gov/Archives/x/form4.xml": GOOD, "https://data.sec.gov/submissions/CIK0000000007.json": b'{"cik": 7, "name": "Seven"}',
    }

    def opener(url, headers, timeout):
        return (200, {}, web[url]) if url in web else (404, {}, b"")

    how = {"opener": opener, "interval": 0.0}
    frame = spark.createDataFrame
    lines, lost = ingest.daily_indexes(frame([(D,), (dt.date(2024, 5, 7),)], "day date"), "me me@x", **how)
    assert [(r.stage, r.error_type, json.loads(r.payload)["date"]) for r in lost.collect()] == [("discover", "edgar_request_error", "2024-05-07")]
    rows = ingest.landed.master_index(lines)
    named, none = ingest.references(rows)
    assert named.count() == 0 and none.head().error_type == "missing_primary_document"
    found = ingest.resolve_documents(rows.select("cik", X.accession_of_path(F.concat("path", F.lit("/"))).alias("accession_number")), "me me@x", **how)
    refs, none = ingest.references(rows, found)
    assert none.count() == 0
    pages = ingest.documents(refs, "me me@x", **how)
    done = ingest.ingest(refs.drop("form"), pages, raw_rows(spark, []), frame([], FILING), frame([], TX), now())
    assert done.status.head().status == "ingested" and done.filing.head().issuer_cik == "0000000007"
    records = ingest.submission_records(frame([("7",), ("8",)], "cik string"), "me me@x", **how)
    assert {r.cik[-1]: r.enrichment_status for r in ingest.issuer_profiles(frame([("7",), ("8",)], "cik string"), records, now()).collect()} == {"7": "ok", "8": "error"}


def test_documents_as_objects_and_read_again(spark, tmp_path):
    folder = f"file://{tmp_path}/raw"
    docs = spark.createDataFrame([("a", GOOD), ("b", BARE), ("b", BARE), ("n", None)], "accession_number string, body binary")
    put = {(r.accession_number, r.raw_uri, r.content_sha256) for r in objects.put(docs, folder).collect()}
    again = {(r.accession_number, r.raw_uri, r.content_sha256) for r in objects.put(docs.repartition(3), folder).collect()}
    assert put == again and len(put) == 2 and len([p for p in (tmp_path / "raw").rglob("*") if p.is_file()]) == 2 and not objects.put(docs.limit(0), folder).count()
    kept = objects.get(spark, folder)
    uris = {a: u for a, u, _ in put}
    assert {r.raw_uri: bytes(r.body) for r in kept.collect()} == {uris["a"]: GOOD, uris["b"]: BARE}
    frame = spark.createDataFrame
    refs = frame([(a, "7", D, "d.xml") for a in ("a", "gone", "lost")], "accession_number string, cik string, filing_date date, primary_document string")
    raw = frame([(a, "1", D, None, "old.xml", u, None, "h", dt.datetime(2024, 1, 1), 200, None) for a, u in (("a", uris["a"]), ("gone", folder + "/gone/x.xml"), ("lost", folder + "/lost/x.xml"))], ingest.RAW)
    pages = frame([("gone", 200, GOOD, None)], "accession_number string, status int, body binary, error string")
    done = ingest.ingest(refs, pages, raw, frame([], FILING), frame([], TX), now(), storage="uri", documents=kept)
    assert {r.accession_number: r.status for r in done.status.collect()} == {"a": "ingested", "gone": "ingested", "lost": "fetch_failed"}
    assert {r.accession_number: r.raw_uri for r in done.raw.collect()}["a"] == uris["a"]

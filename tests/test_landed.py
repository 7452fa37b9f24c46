import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quillstone.functions import filings as X
from quillstone.sources import landed, screens


def value(spark, column, v, kind="string"):
    return spark.createDataFrame([(v,)], f"v {kind}").select(column.alias("r")).head().r


TX = "<nonDerivativeTransaction><securityTitle><value> Class Q Unit </value></securityTitle><transactionDate>{date}</transactionDate><transactionCoding><transactionCode>M</transactionCode></transactionCoding><transactionAmounts><transactionShares{attr}><value>{shares}</value></transactionShares><transactionPricePerShare><value>4.75</value></transactionPricePerShare><transactionAcquiredDisposedCode><value>Acquired</value></transactionAcquiredDisposedCode></transactionAmounts><ownershipNature><directOrIndirectOwnership>Direct</directOrIndirectOwnership></ownershipNature></nonDerivativeTransaction>"


def doc(tx, kind="4", owners=1, root="ownershipDocument", cik="<issuerCik>718293</issuerCik>"):
    owner = "<reportingOwner><reportingOwnerId><rptOwnerCik>0004455667</rptOwnerCik><rptOwnerName>Ines Q</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isOfficer>1</isOfficer><isDirector>true</isDirector><officerTitle>Treasurer</officerTitle></reportingOwnerRelationship></reportingOwner>"
    derivative = tx.replace("nonDerivativeTransaction", "derivativeTransaction")
    return f'<?xml version="1.0"?><{root}><documentType>{kind}</documentType><periodOfReport>2024-02-09</periodOfReport><issuer>{cik}<issuerName>Quorra &amp; Co</issuerName></issuer>{owner * owners}<nonDerivativeTable>{tx}</nonDerivativeTable><derivativeTable>{derivative}</derivativeTable></{root}>'


def test_ownership_xml(spark):
    flat, nested = TX.format(date="2024-01-02", attr="", shares="10"), TX.format(date="<value>20240103</value>", attr="", shares="10")
    noted = TX.format(date="2024-01-02", attr=' footnoteID="F1"', shares="10").replace("<value>4.75</value>", '<value>4.75</value><footnoteId id="F2"/>')
    letters = TX.format(date="x", attr="", shares="1E5")
    cases = {
        "flat": doc(flat), "nested": doc(nested, "4/A", 2), "noted": doc(noted), "letters": doc(letters), "broken": doc(flat)[:-30], "kind": doc(flat, "3"), "nokind": doc(flat, ""), "nocik": doc(flat, cik=""), "root": "<a/>", "null": None, "empty": "",
        "prefixed": doc(flat).replace("<", "<n:").replace("<n:/", "</n:").replace("<n:?xml", "<?xml").replace("<n:ownershipDocument>", '<n:ownershipDocument xmlns:n="urn:x">'),
    }
    df = spark.createDataFrame(list(cases.items()), "accession_number string, xml string")
    parsed = landed.ownership(df)
    errors = {r.accession_number: r.parse_error for r in parsed.collect()}
    assert {k: v for k, v in errors.items() if v is None}.keys() == {"flat", "nested", "noted", "letters", "prefixed"}
    assert errors["broken"] == "malformed XML" and errors["kind"] == "unsupported documentType '3'" and errors["nokind"] == "missing documentType" and errors["nocik"] == "missing issuerCik" and errors["root"] == errors["null"] == errors["empty"] == "missing ownershipDocument root"
    tx = {(r.accession_number, r.transaction_index): r for r in landed.ownership_transactions(parsed).collect()}
    assert len(tx) == 10
    a, b = tx[("flat", 0)], tx[("flat", 1)]
    assert (a.transaction_category, a.security_title, a.transaction_date, a.acquired_disposed_code, a.direct_indirect, a.shares, a.total_value) == ("non_derivative", "Class Q Unit", dt.date(2024, 1, 2), "A", "D", Decimal("10.00000000"), Decimal("47.5000"))
    assert b.transaction_category == "derivative" and b.total_value is None
    assert tx[("nested", 0)].transaction_date == dt.date(2024, 1, 3) and tx[("letters", 0)].shares is None and tx[("letters", 0)].transaction_date is None
    assert tx[("noted", 0)].footnote_ids == ["F1", "F2"] and tx[("noted", 0)].total_value is None and tx[("prefixed", 0)].shares == Decimal("10")
    strict = {(r.accession_number, r.transaction_index): r for r in landed.ownership_transactions(landed.ownership(df, nested_values=False)).collect()}
    assert strict[("nested", 0)].transaction_date is None and strict[("flat", 0)].transaction_date == dt.date(2024, 1, 2)
    heads = {r.accession_number: r for r in landed.ownership_header(parsed).collect()}
    h = heads["nested"]
    assert (h.is_amendment, h.issuer_cik, h.issuer_name, h.insider_cik, h.insider_title, h.period_of_report) == (True, "0000718293", "Quorra & Co", "0004455667", "Treasurer; director", dt.date(2024, 2, 9))
    assert h.warning == "multiple reportingOwner blocks (2); using first only" and heads["flat"].warning is None


def test_leaves_below_other_wrappers_and_strict_footnotes(spark):
    tx = TX.format(date="2024-01-02", attr="", shares="10").replace("<value>4.75</value>", '<value>4.75</value><footnoteId id="F2"/>')
    side = "<transactionAcquiredDisposedCode><value>Acquired</value></transactionAcquiredDisposedCode>"
    moved = tx.replace(side, "").replace("<transactionAmounts>", side.replace("Acquired<", "disposed<") + "<transactionAmounts>").replace("</transactionAmounts>", "</transactionAmounts>")
    wrapped = doc(moved, owners=2).replace("<issuerCik>718293</issuerCik>", "<w><x><issuerCik>718293</issuerCik></x></w>").replace("<documentType>4</documentType>", "<h><documentType> 4 </documentType></h>").replace("<rptOwnerName>Ines Q</rptOwnerName>", "<n><rptOwnerName>Ines &lt;Q&gt;</rptOwnerName></n>", 1)
    df = spark.createDataFrame([("w", wrapped)], "accession_number string, xml string")
    parsed = landed.ownership(df)
    h = landed.ownership_header(parsed).head()
    assert (h.document_type, h.issuer_cik, h.insider_name, h.warning) == ("4", "0000718293", "Ines <Q>", "multiple reportingOwner blocks (2); using first only")
    loose, strict = (landed.ownership_transactions(parsed, s).filter("transaction_index = 0").head() for s in (False, True))
    assert (loose.footnote_ids, loose.total_value) == (["F2"], None) and (strict.footnote_ids, strict.total_value) == (None, Decimal("47.5000"))


def test_index_lines_that_are_set_apart(spark):
    lines = ["7|A|4|2024-01-02|a.txt", "7|A|4|2024-13-03|b.txt", "x7|A|4/A|2024-01-02|c.txt", "7|A|8-K|bad|d.txt", None, "-----"]
    got = {(r.line[-5:], r.reason) for r in landed.master_index_rejects(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert got == {("b.txt", "bad_date"), ("c.txt", "bad_cik")}


def test_exact_product_and_overflow(spark):
    df = spark.createDataFrame([("non_derivative", Decimal("0.00012345"), Decimal("0.00012345"), None), ("non_derivative", Decimal("1234.5678"), Decimal("3.00000001"), []), ("non_derivative", Decimal("99999999999999999999"), Decimal("99999999999999999999"), None), ("derivative", Decimal(1), Decimal(1), None), ("non_derivative", None, Decimal(1), None), ("non_derivative", Decimal(1), Decimal(1), ["F1"])], "c string, s decimal(28,8), p decimal(28,8), f array<string>")
    assert [r.t for r in df.select(X.total_value("c", "s", "p", "f").alias("t")).collect()] == [Decimal("0.0000"), Decimal("3703.7034"), None, None, None, None]


def test_master_index(spark):
    lines = ["CIK|Company Name|Form Type|Date Filed|File Name", "-----", "718293|Quorra Inc|4|2024-01-02|edgar/data/a.txt", "718293|Quorra Inc|8-K|2024-01-02|x", "77| B |4/A|20240103|y", "x7|B|4|2024-01-03|y", "77|B|4|2024-13-03|y", "77   Two Word Co   4   2024-01-04   z.txt", "", None, "Copyright"]
    got = sorted((r.cik, r.company, r.form, str(r.filed), r.path) for r in landed.master_index(spark.createDataFrame([(x,) for x in lines], "value string")).collect())
    assert got == [("0000000077", "B", "4/A", "2024-01-03", "y"), ("0000000077", "Two Word Co", "4", "2024-01-04", "z.txt"), ("0000718293", "Quorra Inc", "4", "2024-01-02", "edgar/data/a.txt")]


def test_submissions(spark):
    payloads = ['{"cik": 718293, "name": " Quorra ", "sic": 3571, "tickers": ["QUOR", " "], "filings": {"recent": {"form": ["4", "8-K", "4/A", "4"], "filingDate": ["2024-01-01", "2024-01-02", "bad"], "accessionNumber": ["a", "b", "c", "d"], "primaryDocument": ["x", "y", "z", "w"]}}}', "{}", "{broken", None]
    df = spark.createDataFrame([(p,) for p in payloads], "value string")
    assert sorted((r.cik, r.accession_number, r.form, r.filed) for r in landed.submissions(df).collect()) == [("0000718293", "a", "4", dt.date(2024, 1, 1)), ("0000718293", "c", "4/A", None)]
    first = landed.company_fields(df).filter("cik is not null").collect()
    assert [(r.entity_name, r.sic_code, r.tickers, r.exchanges) for r in first] == [("Quorra", "3571", ["QUOR"], None)]
    m = spark.createDataFrame([('{"0": {"cik_str": 718293, "ticker": "quor"}, "1": {"cik_str": 7, "ticker": " "}}',)], "value string")
    assert [tuple(r) for r in landed.ticker_map(m).collect()] == [("QUOR", "0000718293")]


def test_price_files(spark):
    bodies = {"ok": "Date,Open,High,Low,Close,Volume\r\n2024-01-02,1,2,0.5,1.5,100\n2024-01-03,nan,inf,1e13,2.5,99999999999999999999\n2024-01-04,1,1,1,,5\nbad,1,1,1,1,1\n", "html": "<HTML><body>", "quota": "Exceeded the daily hits limit", "none": None, "head": "a,b\n1,2"}
    got = {}
    for r in landed.price_bars(spark.createDataFrame(list(bodies.items()), "ticker string, value string")).collect():
        got.setdefault(r.ticker, []).append((r.reason, str(r.price_date), r.open, r.close, r.volume))
    assert sorted(got["ok"]) == [(None, "2024-01-02", Decimal("1.000000"), Decimal("1.500000"), 100), (None, "2024-01-03", None, Decimal("2.500000"), None)] if all(x[0] is None for x in got["ok"]) else False
    assert [got[k][0][0] for k in ("html", "quota", "none", "head")] == ["html", "quota", "empty", "no_header"]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<a href="/Archives/a/xslF345X03/form4.xml"><a href="/Archives/a/form4.xml">', "https://www.sec.gov/Archives/a/form4.xml"), ('<a href="edgar/xslF345X03/form4.xml">', "https://www.sec.gov/Archives/edgar/xslF345X03/form4.xml"), ('<a HREF="https://h/doc4.XML"><a href="b.xml">', "https://h/doc4.XML"),
        ('<a href="bb.xml"><a href="a.xml"><a href="c.xml">', "https://www.sec.gov/Archives/a.xml"), ("<a href='x.htm'>", None), (None, None), ("", None),
    ],
)
def test_href(spark, html, want):
    assert value(spark, X.pick_href("v"), html) == want


@pytest.mark.parametrize(
    ("path", "accession", "document"),
    [("edgar/data/718293/000071829323000917/xslF345X03/report77.xml", "0000718293-23-000917", "xslF345X03/report77.xml"), ("edgar/data/1/0000718293-23-000917.txt", None, None), ("edgar\\data\\1\\000071829323000917\\d.xml", "0000718293-23-000917", "d.xml"), ("x/000071829323000917", "0000718293-23-000917", None), ("", None, None), (None, None, None)],
)
def test_paths(spark, path, accession, document):
    assert value(spark, X.accession_of_path("v"), path) == accession and value(spark, X.document_of_path("v"), path) == document


def test_small_functions(spark):
    v = lambda c, x, k="string": value(spark, c, x, k)
    assert v(X.pad_cik("v"), "CIK 123") == "0000000123" and v(X.pad_cik("v"), "x") is None and v(X.pad_cik_strict("v"), "12345678901") is None and v(X.pad_cik_strict("v"), " 7\t") == "0000000007"
    assert v(X.cik_segment("v"), "0000") == "0" and v(X.ticker_list("v"), "a, b\nA\tc  ") == ["A", "B", "C"] and v(X.ticker_list("v"), "") == []
    assert [v(X.probable_ticker("v"), x) for x in ("qzk.w ", "1A", "A B", "", None, "ABCDEFGHIJK", "A/B", "A-B")] == [True, False, False, False, False, False, False, True]
    assert v(X.finite_price("v"), "1e12") is None and v(X.finite_price("v"), "nan") is None and v(X.finite_price("v"), "-inf") is None and v(X.finite_price("v"), "1.5") == 1.5
    assert v(X.whole_volume("v"), str(2**63 - 1)) == 2**63 - 1 and v(X.whole_volume("v"), str(2**63)) is None
    assert v(X.quote_symbol("v"), " qzk.w") == "QZK-W" and v(X.price_symbol("v"), "QZK.W") == "qzk.w.us" and v(X.price_symbol("v"), "a.us") == "a.us" and v(X.price_symbol("v"), " ") is None
    assert v(X.looks_like_html("v"), " <!DOCTYPE html>") is True and v(X.one_line("v"), " a \n b ") == "a b" and v(X.joined_messages("v", F.lit(" "), F.lit("y")), "x") == "x | y" and v(X.joined_messages("v"), None) is None
    assert v(X.number_text("v"), Decimal("100.50000000"), "decimal(28,8)") == "100.5" and v(X.number_text("v"), Decimal("0E-8"), "decimal(28,8)") == "0"
    assert v(landed.text_of("v"), b"a\xffb", "binary") == "a�b" and v(X.new_york("v"), dt.datetime(2024, 7, 1, 12), "timestamp_ntz") == dt.datetime(2024, 7, 1, 8)
    assert v(X.filing_index_url("v", F.lit("0001-24-7")), "0000718293") == "https://www.sec.gov/Archives/edgar/data/718293/0001247/0001-24-7-index.htm" and "search_text=0001-24-7" in v(X.filing_index_url("v", F.lit("0001-24-7")), None)
    assert v(X.document_url(F.lit("07"), F.lit("a-b"), "v"), "d.xml") == "https://www.sec.gov/Archives/edgar/data/7/ab/d.xml" and v(X.document_url(F.lit("07"), F.lit("a-b"), "v"), "https://x/y") == "https://x/y"
    assert X.cik_list("CIK7, 12345678901\n7") == ["0000000007", "1234567890"] and X.cik_list(None) == [] and X.cik_list(["x", "9"]) == ["0000000009"]
    assert v(X.content_sha("v"), b"", "binary") == X.EMPTY_SHA and v(X.content_path("raw/", F.lit("a"), "v"), "h") == "raw/a/h.xml"
    assert X.session_dates("2024-01-02", None) == ["2024-01-02"] and X.session_dates("2024-01-02", "2024-02-02T1, 2024-01-05,2024-01-05") == ["2024-01-05", "2024-02-02"]
    with pytest.raises(ValueError):
        X.session_dates(" ", "")
    assert v(X.content_hash("v"), "abc") == __import__("hashlib").sha256(b"1\nabc").hexdigest() and v(X.clamp("v", 1, 20), 99, "int") == 20 and v(X.known_metadata("v"), {"a": "1", "b": None}, "map<string,string>") == {"a": "1"}


def test_narrative(spark):
    schema = "insider_name string, insider_title string, issuer_name string, issuer_ticker string, transaction_date date, transaction_category string, transaction_code string, acquired_disposed_code string, shares decimal(28,8), price_per_share decimal(28,8), total_value decimal(28,4), direct_indirect string, document_type string, is_amendment boolean"
    rows = [("Jane D", "CFO", "Acme", "ACM", dt.date(2024, 1, 2), "derivative", "p", None, Decimal("10"), Decimal("2.5"), Decimal("25"), "D", "4", False), (None, None, None, None, None, None, None, None, None, None, None, None, None, None), ("A", "", "B", None, None, "x", "Z", "q", Decimal("1.50"), None, None, "trust", None, True)]
    got = [r.t for r in spark.createDataFrame(rows, schema).select(X.narrative().alias("t")).collect()]
    assert got[0] == "On 2024-01-02, Jane D, CFO, at Acme (ACM) reported a open-market purchase (derivative). Amount: 10 shares at $2.5 per share. Total value about $25. direct ownership. Document type: 4."
    assert got[1] == "On an undisclosed date, an insider at the issuer reported a insider transaction. Share amount and price were not reported as scalars."
    assert got[2] == "On an undisclosed date, A at B reported a transaction code Z. Share amount: 1.5; price per share not reported. ownership: trust. Filing is a Form 4/A amendment."


def test_folder_of_a_feed(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    (tmp_path / "mount").mkdir()
    assert screens.folder(f" {tmp_path} ", "x", "y") == tmp_path and screens.folder(None, f"{tmp_path}/mount/in", "y") == tmp_path / "mount" / "in" and screens.folder("", f"{tmp_path}/none/in", "in") == tmp_path / "in"


def test_screen_files(spark, tmp_path):
    high, low = screens.file_names(dt.date(2026, 5, 6))
    assert high == "all-us-exchanges-3-month-new-highs-05-06-2026.csv" and screens.pair([low, "x.csv", high]) == (dt.date(2026, 5, 6), high, low)
    assert screens.side_and_day("a-3-month-new-lows-13-40-2026.csv") is None
    for bad in ([high], [high, high, low], [high, low.replace("05-06", "05-07")]):
        with pytest.raises(ValueError):
            screens.pair(bad)
    (tmp_path / high).write_text('﻿Symbol,Name\r\n"QUOR",x\nquor,y\nQZK.W,z\n09:30,t\n"Downloaded from the desk"\nZZZ,w\n')
    from quillstone.operators.universe import screen_members

    got = sorted((str(r.trading_date), r.universe_group, r.ticker, r.line_no) for r in screen_members(screens.lines(spark, str(tmp_path))).collect())
    assert got == [("2026-05-06", "high", "QUOR", 2), ("2026-05-06", "high", "QZK.W", 4)]

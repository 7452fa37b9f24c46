"""Landed text feeds as typed columns: filing indexes, submission records, ownership XML, quote records. All parsing is by built-in expressions.

Readers take a DataFrame with the raw text in a column, so that they work the same on ``spark.read.text``, binary files, a table or a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import filings as X
from quillstone.functions.once import with_once


def text_of(binary: Column | str) -> Column:
    """UTF-8 text of bytes; what is no UTF-8 becomes the replacement character."""
    return F.make_valid_utf8((F.col(binary) if isinstance(binary, str) else binary).cast("string"))


def date_of(c: Column) -> Column:
    """A date written ``YYYY-MM-DD`` or ``YYYYMMDD``, white space aside; null otherwise."""
    text = X.strip(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd")).when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))


def _index_parts(df: DataFrame, line: str) -> DataFrame:
    """``df`` with ``__p``, the fields of an index line separated by bars or, in old files, by white space; null for what is no such line."""
    raw = F.col(line)
    bars = F.transform(F.split(raw, r"\|"), lambda x: X.strip(x))
    tokens = F.filter(F.split(X.strip(raw), r"\s+"), lambda x: x != "")
    at = F.array_position(F.transform(tokens, lambda x: x.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{8})$")), True).cast("int")
    spaced = F.when((at >= 4) & (F.size(tokens) > at), F.array(F.element_at(tokens, 1), F.array_join(F.slice(tokens, 2, F.greatest(at - 3, F.lit(0))), " "), F.try_element_at(tokens, at - 1), F.try_element_at(tokens, at), F.array_join(F.slice(tokens, at + 1, F.size(tokens)), " ")))
    return with_once(df, "__p", F.when(raw.contains("|"), F.when(F.size(bars) >= 5, bars)).otherwise(spaced))


def _index_fields(df: DataFrame, line: str) -> DataFrame:
    get = lambda i: F.get("__p", F.lit(i))
    rows = _index_parts(df, line).filter("__p is not null")
    return rows.withColumns({"cik": X.pad_cik_strict(get(0)), "company": get(1), "form": get(2), "filed": date_of(get(3)), "path": get(4)}).drop("__p").filter(F.col("form").isin(*X.FORMS))


def master_index(df: DataFrame, line: str = "value") -> DataFrame:
    """Rows (cik, company, form, filed, path) of daily index lines of the forms in scope; headers, rules and rows with a bad date or cik are left out. Other
    columns are kept."""
    return _index_fields(df, line).filter("cik is not null and filed is not null")


def master_index_rejects(df: DataFrame, line: str = "value") -> DataFrame:
    """(line, reason) of index lines of the forms in scope that have a bad date or cik."""
    bad = _index_fields(df, line).filter("cik is null or filed is null")
    return bad.select(F.col(line).alias("line"), F.when(F.col("filed").isNull(), "bad_date").otherwise("bad_cik").alias("reason"))


SUBMISSIONS = "cik string, name string, entityType string, sic string, sicDescription string, tickers array<string>, exchanges array<string>, stateOfIncorporation string, fiscalYearEnd string, filings struct<recent:struct<form:array<string>,filingDate:array<string>,accessionNumber:array<string>,primaryDocument:array<string>>>"


def submissions(df: DataFrame, payload: str = "value") -> DataFrame:
    """Rows (cik, accession_number, form, filed, document) of the parallel arrays, cut to the shortest, of the forms in scope."""
    rows = with_once(df.select(payload), "s", F.from_json(payload, SUBMISSIONS)).select("s.cik", "s.filings.recent.*")
    names = ["form", "filingDate", "accessionNumber", "primaryDocument"]
    length = F.least(*[F.size(n) for n in names])
    cut = rows.withColumn("n", length).filter("n > 0").select("cik", F.inline(F.arrays_zip(*[F.slice(n, F.lit(1), F.col("n")).alias(n) for n in names])))
    out = cut.filter(F.col("form").isin(*X.FORMS))
    return out.select(X.pad_cik("cik").alias("cik"), F.col("accessionNumber").alias("accession_number"), "form", date_of(F.col("filingDate")).alias("filed"), F.col("primaryDocument").alias("document"))


def company_fields(df: DataFrame, payload: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Company-level fields of a submissions record; blank text and empty lists are null. Columns of ``keep`` pass through, with rows that have no record."""
    rows = with_once(df.select(payload, *[F.col(c).alias(f"__{c}") for c in keep]), "s", F.from_json(payload, SUBMISSIONS)).select(*[f"__{c}" for c in keep], "s.*")

    def listed(c: str) -> Column:
        some = F.filter(F.transform(c, X.strip), lambda x: x != "")
        return F.when(F.size(some) > 0, some)

    sic = F.when(F.col("sic").try_cast("bigint").isNotNull(), F.col("sic").try_cast("bigint").cast("string")).otherwise(X.blank_to_null("sic"))
    return rows.select(
        *[F.col(f"__{c}").alias(c) for c in keep], X.pad_cik("cik").alias("cik"), X.blank_to_null("name").alias("entity_name"), X.blank_to_null("entityType").alias("entity_type"), sic.alias("sic_code"), X.blank_to_null("sicDescription").alias("sic_description"),
        listed("tickers").alias("tickers"), listed("exchanges").alias("exchanges"), X.blank_to_null("stateOfIncorporation").alias("state_of_incorporation"), X.blank_to_null("fiscalYearEnd").alias("fiscal_year_end"),
    )


_LEAF = "struct<_VALUE:string,value:string>"
_AMOUNT = "struct<_VALUE:string,_footnoteId:string,_id:string,footnoteId:array<struct<_id:string>>,value:struct<_VALUE:string,_footnoteId:string,_id:string>>"
_TX = f"struct<securityTitle:{_LEAF},transactionDate:{_LEAF},transactionCoding:struct<transactionCode:string>,transactionAmounts:struct<transactionShares:{_AMOUNT},transactionPricePerShare:{_AMOUNT},transactionAcquiredDisposedCode:{_AMOUNT}>,ownershipNature:struct<directOrIndirectOwnership:{_LEAF}>,transactionAcquiredDisposedCode:{_AMOUNT}>"
OWNERSHIP = f"""schemaVersion string, documentType string, periodOfReport string, issuer struct<issuerCik:string,issuerName:string,issuerTradingSymbol:string>,
reportingOwner array<struct<reportingOwnerId:struct<rptOwnerCik:string,rptOwnerName:string>,reportingOwnerRelationship:struct<isOfficer:string,isDirector:string,isTenPercentOwner:string,isOther:string,officerTitle:string,otherText:string>>>,
nonDerivativeTable struct<nonDerivativeTransaction:array<{_TX}>>, derivativeTable struct<derivativeTransaction:array<{_TX}>>, _corrupt_record string"""


def block_of(xml: Column | str, name: str) -> Column:
    """The inside of the first element of a local name anywhere in a document, empty if there is none."""
    return F.regexp_extract(xml, rf"(?s)<(?:[A-Za-z0-9_]+:)?{name}(?:\s[^>]*)?>(.*?)</(?:[A-Za-z0-9_]+:)?{name}\s*>", 1)


def first_below(xml: Column | str, name: str) -> Column:
    """Own text of the first element of a local name anywhere in a document, its entities decoded; null if there is none or it is blank."""
    source = F.col(xml) if isinstance(xml, str) else xml
    # most documents that lack an element don't bear its name at all, which is told faster than by a pattern
    text = F.when(source.contains(name), F.regexp_extract(source, rf"<(?:[A-Za-z0-9_]+:)?{name}(?:\s[^>]*)?>\s*([^<]*)", 1))
    for entity, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(c))
    return X.blank_to_null(text)


def ownership(df: DataFrame, xml: str = "xml", nested_values: bool = True) -> DataFrame:
    """``df`` with ``doc``, the parsed ownership document, and ``parse_error``, why it could not be read (null if it could).

    Without ``nested_values`` dates and ownership count only as an element's own text."""
    # the attribute's two spellings would be one name to the column resolver
    doc = F.from_xml(F.regexp_replace(xml, r"\bfootnoteID=", "footnoteId="), OWNERSHIP, {"rowTag": "ownershipDocument", "ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = with_once(df, "doc", doc)
    # a leaf that does not stand where the schema has it is the first element of its name anywhere below its parent, whatever wraps it
    owner = F.try_element_at("doc.reportingOwner", F.lit(1))["reportingOwnerId"]
    # the blocks are cut out only where one of their leaves is named and not found
    issuer_block, owner_block = ({n: F.when(F.col(xml).contains(n), block_of(xml, block)) for n in names} for block, names in (("issuer", ("issuerCik", "issuerName", "issuerTradingSymbol")), ("reportingOwner", ("rptOwnerCik", "rptOwnerName"))))
    leaves = {
        "document_type": ("doc.documentType", xml, "documentType"), "schema_version": ("doc.schemaVersion", xml, "schemaVersion"), "period": ("doc.periodOfReport", xml, "periodOfReport"),
        "issuer_cik": ("doc.issuer.issuerCik", issuer_block["issuerCik"], "issuerCik"), "issuer_name": ("doc.issuer.issuerName", issuer_block["issuerName"], "issuerName"), "issuer_ticker": ("doc.issuer.issuerTradingSymbol", issuer_block["issuerTradingSymbol"], "issuerTradingSymbol"),
        "insider_cik": (owner["rptOwnerCik"], owner_block["rptOwnerCik"], "rptOwnerCik"), "insider_name": (owner["rptOwnerName"], owner_block["rptOwnerName"], "rptOwnerName"),
    }
    rows = with_once(rows, "head", F.struct(*[F.coalesce(X.blank_to_null(given), first_below(place, name)).alias(c) for c, (given, place, name) in leaves.items()]))
    kind = F.col("head.document_type")
    error = (
        F.when(F.col(xml).isNull() | ~F.col(xml).rlike(r"<([A-Za-z0-9_]+:)?ownershipDocument[\s>]"), "missing ownershipDocument root")
        .when(F.col("doc._corrupt_record").isNotNull(), "malformed XML").when(kind.isNull(), "missing documentType")
        .when(~kind.isin(*X.FORMS), F.concat(F.lit("unsupported documentType '"), kind, F.lit("'"))).when(X.pad_cik("head.issuer_cik").isNull(), "missing issuerCik")
    )
    return rows.withColumns({"parse_error": error, "nested_values": F.lit(nested_values)})


def ownership_header(parsed: DataFrame) -> DataFrame:
    """One header row per document that could be read; several owners give a warning and the first one counts."""
    owner = F.try_element_at("doc.reportingOwner", F.lit(1))
    role = owner["reportingOwnerRelationship"]
    flag = lambda c: X.strip(role[c]).isin("1", "true", "True")
    title = F.concat_ws("; ", F.when(flag("isOfficer"), X.blank_to_null(role["officerTitle"])), F.when(flag("isDirector"), F.lit("director")), F.when(flag("isTenPercentOwner"), F.lit("ten percent owner")), F.when(flag("isOther"), X.blank_to_null(role["otherText"])))
    others = F.size("doc.reportingOwner")
    return parsed.filter("parse_error is null").select(
        "accession_number", F.col("head.document_type"), (F.col("head.document_type") == "4/A").alias("is_amendment"), F.col("head.schema_version"), date_of(F.col("head.period")).alias("period_of_report"),
        X.pad_cik("head.issuer_cik").alias("issuer_cik"), F.col("head.issuer_name"), F.col("head.issuer_ticker"),
        X.pad_cik("head.insider_cik").alias("insider_cik"), F.col("head.insider_name"), F.nullif(title, F.lit("")).alias("insider_title"),
        F.when(others > 1, F.concat(F.lit("multiple reportingOwner blocks ("), others.cast("string"), F.lit("); using first only"))).alias("warning"),
    )


def ownership_transactions(parsed: DataFrame, strict_footnotes: bool = False) -> DataFrame:
    """One row per transaction of documents that could be read, indexed in document order, non-derivative before derivative.

    With ``strict_footnotes`` only the attributes of an amount and of its value are footnotes, not elements inside it; the total then counts where elements
    alone would have kept it null."""
    empty = F.array().cast(f"array<{_TX}>")
    both = F.concat(
        F.transform(F.coalesce("doc.nonDerivativeTable.nonDerivativeTransaction", empty), lambda t: F.struct(F.lit("non_derivative").alias("category"), t.alias("t"))),
        F.transform(F.coalesce("doc.derivativeTable.derivativeTransaction", empty), lambda t: F.struct(F.lit("derivative").alias("category"), t.alias("t"))),
    )
    rows = parsed.filter("parse_error is null").select("accession_number", "nested_values", F.posexplode(both).alias("transaction_index", "x"))
    own = lambda leaf: F.coalesce(X.blank_to_null(leaf["_VALUE"]), F.when(F.col("nested_values"), X.blank_to_null(leaf["value"])))
    amounts = F.col("x.t.transactionAmounts")

    def number(node: Column) -> Column:
        text = F.coalesce(F.nullif(node["value"]["_VALUE"], F.lit("")), X.blank_to_null(node["_VALUE"]))
        return F.when(~text.rlike("[A-Za-z]"), X.strip(text).try_cast("decimal(28,8)"))

    nodes = [amounts[n] for n in ("transactionShares", "transactionPricePerShare", "transactionAcquiredDisposedCode")]
    none = F.array().cast("array<string>")
    inside = lambda n: none if strict_footnotes else F.coalesce(F.transform(n["footnoteId"], lambda f: f["_id"]), none)
    ids = F.array_distinct(F.array_compact(F.flatten(F.array(*[F.concat(F.array(n["_footnoteId"], n["_id"], n["value"]["_footnoteId"], n["value"]["_id"]), inside(n)) for n in nodes]))))
    outside = F.col("x.t.transactionAcquiredDisposedCode")  # where it does not stand among the amounts
    side = F.coalesce(*[X.blank_to_null(leaf) for n in (nodes[2], outside) for leaf in (n["value"]["_VALUE"], n["_VALUE"])])
    held = own(F.col("x.t.ownershipNature.directOrIndirectOwnership"))
    return rows.select(
        "accession_number", F.col("transaction_index").cast("int").alias("transaction_index"), F.col("x.category").alias("transaction_category"), F.coalesce(X.blank_to_null("x.t.securityTitle.value"), X.blank_to_null("x.t.securityTitle._VALUE")).alias("security_title"),
        date_of(own(F.col("x.t.transactionDate"))).alias("transaction_date"), X.blank_to_null("x.t.transactionCoding.transactionCode").alias("transaction_code"),
        F.when(side.isin("A", "D"), side).otherwise(F.upper(F.substring(side, 1, 1))).alias("acquired_disposed_code"), number(nodes[0]).alias("shares"), number(nodes[1]).alias("price_per_share"),
        F.when(F.upper(held).startswith("D"), "D").when(F.upper(held).startswith("I"), "I").otherwise(held).alias("direct_indirect"), F.when(F.size(ids) > 0, ids).alias("footnote_ids"),
    ).withColumn("total_value", X.total_value("transaction_category", "shares", "price_per_share", "footnote_ids"))


def ticker_map(df: DataFrame, payload: str = "value") -> DataFrame:
    """(ticker, cik) of a record of records ``{"0": {"cik_str": .., "ticker": ..}, ..}``."""
    entries = F.map_values(F.from_json(payload, "map<string,struct<cik_str:string,ticker:string>>"))
    return df.select(F.explode(entries).alias("e")).select(F.upper(X.strip("e.ticker")).alias("ticker"), X.pad_cik("e.cik_str").alias("cik")).filter("ticker <> ''")


#: How a price feed says that it gives no more today.
QUOTA = "daily hits limit"


def price_bars(df: DataFrame, ticker: str = "ticker", body: str = "value") -> DataFrame:
    """(ticker, price_date, open, high, low, close, volume) of price files, and ``reason`` with one row for a body that is no price file: ``empty``, ``html``,
    ``quota`` or ``no_header``. Bars without a date or a usable close are dropped; other unusable fields are null."""
    text = F.coalesce(X.strip(body), F.lit(""))
    rows = F.split(text, r"\r\n|\n|\r")
    head = F.transform(F.split(F.lower(F.element_at(rows, 1)), ","), lambda x: X.strip(x))
    reason = F.when(text == "", "empty").when(X.looks_like_html(text), "html").when(F.lower(text).contains(QUOTA), "quota").when(~(F.array_contains(head, "date") & F.array_contains(head, "close")), "no_header")
    names = ("date", "open", "high", "low", "close", "volume")
    place = F.struct(*[(F.array_position(head, F.lit(n)).cast("int") - 1).alias(n) for n in names])  # -1 where a file has no such column
    base = with_once(df.select(F.col(ticker).alias("ticker"), body), "file", F.struct(reason.alias("reason"), place.alias("at"), F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))).alias("lines")))
    lines = base.select("ticker", "file.reason", "file.at", F.explode_outer(F.when(F.col("file.reason").isNull(), F.col("file.lines"))).alias("line"))
    cut = with_once(lines, "f", F.split("line", ","))
    field = lambda n: F.when(F.col(f"at.{n}") >= 0, F.nullif(X.strip(F.get("f", F.col(f"at.{n}"))), F.lit("")))
    bar = F.struct(date_of(field("date")).alias("price_date"), *[X.finite_price(field(c)).cast("decimal(18,6)").alias(c) for c in ("open", "high", "low", "close")], X.whole_volume(field("volume")).alias("volume"))
    out = with_once(cut.select("ticker", "reason", "at", "f"), "bar", bar).select("ticker", "bar.*", "reason")
    return out.filter("reason is not null or (price_date is not null and close is not null)")

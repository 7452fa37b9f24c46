"""Column functions of filings: identifiers, addresses, phrases, narrative text and hashes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Host names and path forms of the public filing archive.
ARCHIVE = "https://www.sec.gov"
SUBMISSIONS = "https://data.sec.gov/submissions/CIK"
#: The forms in scope.
FORMS = ("4", "4/A")
#: Version prefix of a text's content hash.
TEXT_VERSION = "1"
#: The SHA-256 of no bytes, which stands for a document that was never fetched.
EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
#: What makes a first token of a screen line a ticker, and links that point to ownership documents or to rendered copies of them.
TICKER = r"^[A-Z][A-Z0-9.\-]{0,9}$"
LINK = r'(?i)href="([^"]+\.xml)"'
RENDERED, BEST_NAMES, NEXT_NAMES = r"(?i)xslf345x|/xslf345", r"(?i)form_?4|ownership", r"(?i)doc4"
#: The search page for filings without a cik.
SEARCH = "/cgi-bin/browse-edgar?action=getcompany&CIK=&type=4&dateb=&owner=include&count=40&search_text="


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


# --- identifiers -------------------------------------------------------------------------------------------------------------------


def pad_cik(c: Column | str) -> Column:
    """Digits only, ten of them with leading zeros; longer ones are cut at ten, none gives null."""
    digits = F.nullif(F.regexp_replace(_c(c), "[^0-9]", ""), F.lit(""))
    return F.lpad(digits, 10, "0")


def pad_cik_strict(c: Column | str) -> Column:
    """As ``pad_cik``, but null unless the text is one to ten digits, blanks around it aside."""
    text = strip(c)
    return F.when(text.rlike("^[0-9]{1,10}$"), F.lpad(text, 10, "0"))


def cik_segment(c: Column | str) -> Column:
    """A cik as it stands in archive paths: no leading zeros, ``0`` if nothing is left."""
    return F.coalesce(F.nullif(F.regexp_replace(_c(c), "^0+", ""), F.lit("")), F.lit("0"))


def accession_plain(c: Column | str) -> Column:
    return F.replace(_c(c), F.lit("-"), F.lit(""))


def accession_of_path(path: Column | str) -> Column:
    """Accession number of an archive path that has an 18-digit folder, else null."""
    found = F.regexp_extract(F.concat(F.lit("/"), F.btrim(F.replace(strip(path), F.lit("\\"), F.lit("/")), F.lit("/")), F.lit("/")), r"/([0-9]{18})/", 1)
    return F.when(found != "", F.concat_ws("-", F.substring(found, 1, 10), F.substring(found, 11, 2), F.substring(found, 13, 6)))


def document_of_path(path: Column | str) -> Column:
    """What follows the 18-digit folder of an archive path, null if there is none or nothing follows."""
    found = F.regexp_extract(F.concat(F.lit("/"), F.replace(strip(path), F.lit("\\"), F.lit("/"))), r"/[0-9]{18}/+(.+)$", 1)
    return F.nullif(found, F.lit(""))


def probable_ticker(c: Column | str) -> Column:
    """A letter, then up to nine letters, digits, dots or dashes; case and white space around it aside."""
    return F.coalesce(F.upper(strip(c)).rlike(TICKER), F.lit(False))


def ticker_list(c: Column | str) -> Column:
    """Upper-case tickers of a list separated by commas or white space, first occurrences in order."""
    parts = F.transform(F.split(_c(c), r"[,\s]+"), lambda x: F.upper(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def chunk_id(accession: Column | str, index: Column | str) -> Column:
    return F.concat_ws(":", _c(accession), _c(index).cast("string"))


# --- addresses ---------------------------------------------------------------------------------------------------------------------


def submissions_url(cik: Column | str) -> Column:
    return F.concat(F.lit(SUBMISSIONS), _c(cik), F.lit(".json"))


def daily_index_url(day: Column | str) -> Column:
    d = _c(day)
    return F.concat(F.lit(f"{ARCHIVE}/Archives/edgar/daily-index/"), F.year(d).cast("string"), F.lit("/QTR"), F.quarter(d).cast("string"), F.lit("/master"), F.date_format(d, "yyyyMMdd"), F.lit(".idx"))


def filing_index_url(cik: Column | str, accession: Column | str) -> Column:
    """Index page of a filing; a search page where there is no cik; null without accession."""
    acc = blank_to_null(accession)
    digits = F.nullif(F.regexp_replace(_c(cik), "[^0-9]", ""), F.lit(""))
    search = F.concat(F.lit(ARCHIVE + SEARCH), acc)
    page = F.concat(F.lit(f"{ARCHIVE}/Archives/edgar/data/"), cik_segment(digits), F.lit("/"), accession_plain(acc), F.lit("/"), acc, F.lit("-index.htm"))
    return F.when(digits.isNotNull(), page).otherwise(search)


def document_url(cik: Column | str, accession: Column | str, document: Column | str) -> Column:
    """Address of a filing's document given absolute, from the root of the host, or relative to the filing."""
    doc = F.coalesce(strip(document), F.lit(""))
    inside = F.concat(F.lit(f"{ARCHIVE}/Archives/edgar/data/"), cik_segment(cik), F.lit("/"), accession_plain(accession), F.lit("/"), doc)
    return F.when(doc.rlike("^https?://"), doc).when(doc.startswith("/"), F.concat(F.lit(ARCHIVE), doc)).otherwise(inside)


# --- text --------------------------------------------------------------------------------------------------------------------------


def number_text(c: Column | str) -> Column:
    """A decimal of positive scale without trailing zeros."""
    return F.regexp_replace(_c(c).cast("string"), r"\.?0+$", "")


#: Wording by transaction code and by acquired or disposed.
ACTIONS = {"P": "open-market purchase", "S": "open-market sale", "A": "grant or award", "M": "option exercise", "G": "gift"}
SIDES = {"A": "acquisition", "D": "disposition"}


def action_phrase(code: Column | str, side: Column | str) -> Column:
    """The code's wording, else the side's, else the code itself."""
    c, s = (F.coalesce(F.upper(strip(x)), F.lit("")) for x in (code, side))
    by_code = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])
    by_side = F.create_map(*[F.lit(x) for kv in SIDES.items() for x in kv])
    return F.coalesce(F.try_element_at(by_code, c), F.try_element_at(by_side, s), F.when(c != "", F.concat(F.lit("transaction code "), c)), F.lit("insider transaction"))


def ownership_phrase(c: Column | str) -> Column:
    low = F.lower(strip(c))
    return F.when(_c(c) == "", None).when(low.isin("d", "direct"), "direct ownership").when(low.isin("i", "indirect"), "indirect ownership").otherwise(F.concat(F.lit("ownership: "), _c(c)))


#: The sentences of a narrative; braces stand for what is filled in.
NO_DATE, NO_PERSON, NO_COMPANY = "an undisclosed date", "an insider", "the issuer"
BOTH = (" Amount: ", " shares at $", " per share.", " Total value about $")
ONLY_SHARES, ONLY_PRICE = (" Share amount: ", "; price per share not reported."), (" Price per share: $", "; share amount not reported.")
NEITHER = " Share amount and price were not reported as scalars."
AMENDMENT, DOCUMENT = " Filing is a Form 4/A amendment.", " Document type: "


def narrative() -> Column:
    """One sentence or more about a transaction joined with its filing; missing numbers are named as missing, never made up."""
    some = lambda c: F.coalesce(c, F.lit(""))
    person = strip(F.coalesce(F.nullif(F.col("insider_name"), F.lit("")), F.lit(NO_PERSON)))
    company = strip(F.coalesce(F.nullif(F.col("issuer_name"), F.lit("")), F.lit(NO_COMPANY)))
    ticker, title, document = (some(strip(c)) for c in ("issuer_ticker", "insider_title", "document_type"))
    when = F.coalesce(F.date_format("transaction_date", "yyyy-MM-dd"), F.lit(NO_DATE))
    shares, price, total = (number_text(c) for c in ("shares", "price_per_share", "total_value"))
    amounts = (
        F.when(shares.isNotNull() & price.isNotNull(), F.concat(F.lit(BOTH[0]), shares, F.lit(BOTH[1]), price, F.lit(BOTH[2]), some(F.concat(F.lit(BOTH[3]), total, F.lit(".")))))
        .when(shares.isNotNull(), F.concat(F.lit(ONLY_SHARES[0]), shares, F.lit(ONLY_SHARES[1])))
        .when(price.isNotNull(), F.concat(F.lit(ONLY_PRICE[0]), price, F.lit(ONLY_PRICE[1])))
        .otherwise(NEITHER)
    )
    whole = F.concat(
        F.lit("On "), when, F.lit(", "), person, F.when(title != "", F.concat(F.lit(", "), title, F.lit(","))).otherwise(""),
        F.lit(" at "), company, F.when(ticker != "", F.concat(F.lit(" ("), ticker, F.lit(")"))).otherwise(""),
        F.lit(" reported a "), action_phrase("transaction_code", "acquired_disposed_code"), F.when(some(strip("transaction_category")) == "derivative", " (derivative)").otherwise(""), F.lit("."),
        amounts, some(F.concat(F.lit(" "), ownership_phrase("direct_indirect"), F.lit("."))),
        F.when(F.col("is_amendment"), AMENDMENT).when(document != "", F.concat(F.lit(DOCUMENT), document, F.lit("."))).otherwise(""),
    )
    return strip(F.replace(whole, F.lit("  "), F.lit(" ")))


def content_hash(text: Column | str) -> Column:
    """SHA-256 of the version line and the text."""
    return F.sha2(F.concat(F.lit(f"{TEXT_VERSION}\n"), _c(text)), 256)


def content_sha(c: Column | str) -> Column:
    """SHA-256 of bytes, null for none."""
    return F.sha2(_c(c).cast("binary"), 256)


def cik_list(value: str | list[str] | None) -> list[str]:
    """Ciks of a parameter that is a list or text separated by commas or white space, ten digits each, first occurrences in order."""
    parts = re.split(r"[,\s]+", value) if isinstance(value, str) else value or []
    digits = ("".join(c for c in str(p) if c.isdigit()) for p in parts)
    return list(dict.fromkeys(d.zfill(10)[:10] for d in digits if d))


def total_value(category: Column | str, shares: Column | str, price: Column | str, footnotes: Column | str) -> Column:
    """Shares times price of a non-derivative transaction without footnotes, to four places; null on overflow."""
    a, b = _c(shares).cast("decimal(28,8)"), _c(price).cast("decimal(28,8)")
    plain = (_c(category) == "non_derivative") & (F.coalesce(F.size(_c(footnotes)), F.lit(0)) <= 0)
    return F.when(plain, F.try_multiply(a, b).try_cast("decimal(28,4)"))


# --- numbers, clocks, documents ----------------------------------------------------------------------------------------------------


def finite_price(c: Column | str, limit: float = 1e12) -> Column:
    """A price as double, null unless it is a finite number below the limit in size."""
    x = _c(c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < limit), x)


def whole_volume(c: Column | str) -> Column:
    """A volume as bigint, null beyond its range or if it is no number."""
    return _c(c).try_cast("decimal(38,0)").try_cast("bigint")


def new_york(c: Column | str) -> Column:
    """Wall clock of New York for a zone-less UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), _c(c).cast("timestamp_ntz"))


def looks_like_html(c: Column | str) -> Column:
    """Whether the first 4096 characters hold a tag that starts a page."""
    return F.lower(F.substring(_c(c), 1, 4096)).rlike(r"<html|<!doctype html|<head|<meta")


def pick_href(html: Column | str) -> Column:
    """The ownership document among a page's links to ``.xml``: rendered copies only if there is nothing else, then by name, then the shortest, then the
    first; absolute."""
    found = F.regexp_extract_all(_c(html), F.lit(LINK), F.lit(1))
    ranked = F.transform(
        found,
        lambda h, i: F.struct(
            h.rlike(RENDERED).cast("int").alias("rendered"),
            F.when(h.rlike(RENDERED), 0).when(h.rlike(BEST_NAMES), -3).when(h.rlike(NEXT_NAMES), -2).otherwise(0).alias("rank"),
            F.length(h).alias("size"), i.alias("at"), h.alias("href"),
        ),
    )
    best = F.array_min(ranked)["href"]
    return F.when(best.rlike("^https?://"), best).when(best.startswith("/"), F.concat(F.lit(ARCHIVE), best)).otherwise(F.concat(F.lit(f"{ARCHIVE}/Archives/"), best))


def profile_status(info: Column) -> Column:
    """``ok`` if a quote record (struct of longName, shortName, marketCap, regularMarketPrice, quoteType, symbol) says anything, else ``no_data``."""
    name = F.coalesce(F.nullif(info["longName"], F.lit("")), info["shortName"], F.lit(""))
    nothing = F.coalesce(info["quoteType"] == "NONE", F.lit(False)) | F.coalesce(info["symbol"].endswith("=X"), F.lit(False))
    some = (strip(name) != "") | (F.coalesce(info["marketCap"], F.lit(0)) != 0) | info["regularMarketPrice"].isNotNull()
    return F.when(info.isNotNull() & ~nothing & some, "ok").otherwise("no_data")


# --- small parameters and messages -------------------------------------------------------------------------------------------------


def quote_symbol(c: Column | str) -> Column:
    """A ticker as quote services write it: dashes for dots."""
    return F.replace(F.upper(strip(c)), F.lit("."), F.lit("-"))


def price_symbol(c: Column | str) -> Column:
    """A ticker as price files write it: lower case with a market suffix, kept if it has one; null if blank."""
    low = F.nullif(F.lower(strip(c)), F.lit(""))
    return F.when(low.endswith(".us"), low).otherwise(F.concat(low, F.lit(".us")))


def one_line(c: Column | str) -> Column:
    """White space runs as one blank, none at the ends."""
    return strip(F.regexp_replace(_c(c), r"\s+", " "))


def joined_messages(*messages: Column | str) -> Column:
    """Messages that are not blank, in order, separated by bars; null if there is none."""
    return F.nullif(F.concat_ws(" | ", *[blank_to_null(m) for m in messages]), F.lit(""))


def clamp(c: Column | str, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), _c(c)))


def known_metadata(m: Column | str) -> Column:
    """A map without its null values."""
    return F.map_filter(_c(m), lambda _, v: v.isNotNull())


def content_path(prefix: str, accession: Column | str, sha: Column | str) -> Column:
    """Object path of a raw document, addressed by its content."""
    return F.concat_ws("/", F.lit(prefix.rstrip("/") or None), _c(accession), F.concat(_c(sha), F.lit(".xml")))


def session_dates(single: str | None, several: str | None) -> list[str]:
    """Sorted distinct ISO days of a parameter pair; the list wins over the single day; neither is an error."""
    from datetime import date

    text = several if several and several.strip() else single
    days = sorted({date.fromisoformat(x.strip()[:10]).isoformat() for x in (text or "").split(",") if x.strip()})
    if not days:
        raise ValueError("a session day is needed")
    return days

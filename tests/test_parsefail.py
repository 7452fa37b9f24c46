import random
from xml.parsers import expat

import pytest
from pyspark.sql import functions as F

from quillstone.operators import parsefail

#: The header line of the screens as delivered stands among the cases.
GOOD = 'AB5PQ,"Some ""New"", Name Inc","1,460.77",-5.10,+1.27%,201597,4,-10.44%,+1.72%,"09:16 ET"'
CASES = [
    (GOOD, "ok"), (' "ab.b-w" , x ,0.5,,N/A,"1,234","",, N/A ,', "ok"), ('" WA5PB",n,1,1,1%,1,1,1%,1%,00:00 ET', "ok"), (None, "not_a_row"), ("", "not_a_row"), (" \t", "not_a_row"),
    ('Symbol,Name,Latest,Change,%Change,Volume,"3M #Hi","3M %/High","3M %/Low",Time', "not_a_row"), ('﻿symbol,name,latest,change,%change,volume,"3m #hi","3m %/high","3m %/low",time', "not_a_row"),
    ('"Downloaded from the desk as of 09:38pm ET"', "not_a_row"), ("A,b,1", "column_count"), (GOOD + ",", "column_count"), (GOOD.replace(",", ";"), "quoting"), ("A;b;1;2", "column_count"),
    ('A,"b" c,1,1,1%,1,1,1%,1%,00:00 ET', "quoting"), ('A"B,n,1,1,1%,1,1,1%,1%,00:00 ET', "quoting"), ('A,"open,1,1,1%,1,1,1%,1%,00:00 ET', "quoting"), ("1A,n,1,1,1%,1,1,1%,1%,00:00 ET", "value:symbol"),
    (",n,1,1,1%,1,1,1%,1%,00:00 ET", "value:symbol"), ("ABCDEFGHIJK,n,1,1,1%,1,1,1%,1%,00:00 ET", "value:symbol"), ("A,n,0,1,1%,1,1,1%,1%,00:00 ET", "value:latest"), ("A,n,0.00,1,1%,1,1,1%,1%,00:00 ET", "value:latest"),
    ("A,n,N/A,1,1%,1,1,1%,1%,00:00 ET", "value:latest"), ("A,n,-1,1,1%,1,1,1%,1%,00:00 ET", "value:latest"), ("A,n,1.2.3,1,1%,1,1,1%,1%,00:00 ET", "value:latest"), ('A,n,"1,2",1,1%,1,1,1%,1%,00:00 ET', "value:latest"),
    ("A,n,1,unch,1%,1,1,1%,1%,00:00 ET", "value:change"), ("A,n,1,1,1.25,1,1,1%,1%,00:00 ET", "value:pct_change"), ("A,n,1,1,+-3%,1,1,1%,1%,00:00 ET", "value:pct_change"), ("A,n,1,1,1%,-5,1,1%,1%,00:00 ET", "value:volume"),
    ("A,n,1,1,1%,1.5,1,1%,1%,00:00 ET", "value:volume"), ("A,n,1,1,1%,1,two,1%,1%,00:00 ET", "value:hi_count"), ("A,n,1,1,1%,1,1,%,1%,00:00 ET", "value:pct_from_high"), ("A,n,1,1,1%,1,1,1%,abc%,00:00 ET", "value:pct_from_low"),
    ("A,n,1,1,1%,1,1,1%,1%,24:00 ET", "value:time"), ("A,n,1,1,1%,1,1,1%,1%,9:00 ET", "value:time"), ("A,n,1,1,1%,1,1,1%,1%,09:00", "value:time"), ("A," + "n" * 100_000 + ",1,1,1%,1,1,1%,1%,", "ok"),
]


def test_screen_lines(spark):
    df = spark.createDataFrame([(i, line, "own", "own") for i, (line, _) in enumerate(CASES)], "i int, c0 string, row string, _reason string")
    got = {r.i: r for r in parsefail.screen_rows(df).collect()}
    assert len(got) == len(CASES)
    for i, (line, reason) in enumerate(CASES):
        assert got[i]._reason == reason, line
        assert (got[i].row is not None) == (reason == "ok")
        assert (got[i]._raw == line) if reason not in ("ok", "not_a_row") else got[i]._raw is None
    row = got[0].row
    assert (row.symbol, row.name, float(row.latest), float(row.change), float(row.pct_change), row.volume, row.time) == ("AB5PQ", 'Some "New", Name Inc', 1460.77, -5.1, 1.27, 201597, "09:16 ET")
    assert got[1].row.symbol == "AB.B-W" and got[1].row.volume == 1234 and got[1].row.change is None


def test_screen_lines_of_an_empty_table(spark):
    assert parsefail.screen_rows(spark.createDataFrame([], "c0 string")).count() == 0


def test_values_that_the_type_cannot_hold_are_set_apart_and_never_null(spark):
    lines = {
        "A,n,1,1,1%,99999999999999999999,1,1%,1%,00:00 ET": "range:volume", "A,n,1,123456789012345678901.5,1%,1,1,1%,1%,00:00 ET": "range:change", "A,n,0.0000000000000000001,1,1%,1,1,1%,1%,00:00 ET": "range:latest",
        "A,n,0.0000001,1234567890123456.5,1%,1,1,1%,1%,": "ok", "A,n,999999999999999.5,1,1.100000000000000000000%,1,1,1%,1%,": "ok", "A,n,1.12345678,,,,,,,": "ok", "A,n,0.00,1,x%,1,1,1%,1%,": "value:latest",
    }
    got = {r.c0: r for r in parsefail.screen_rows(spark.createDataFrame([(x,) for x in lines], "c0 string")).withColumn("fault", parsefail.is_fault("_reason")).collect()}
    assert {k: r._reason for k, r in got.items()} == lines
    assert {k for k, r in got.items() if r.fault} == {k for k, v in lines.items() if v.startswith("value")}
    assert float(got["A,n,1.12345678,,,,,,,"].row.latest) == 1.12345678 and all(r.row.latest is not None for r in got.values() if r.row)


def brute(line):
    """Fields of a line read character by character, or None if it is not well quoted."""
    fields, i, n = [], 0, len(line)
    while True:
        j = i
        while j < n and line[j] in " \t":
            j += 1
        if j < n and line[j] == '"':
            j, text = j + 1, ""
            while True:
                if j >= n:
                    return None
                if line[j] == '"' and line[j : j + 2] != '""':
                    break
                j, text = j + (2 if line[j] == '"' else 1), text + line[j]
            j += 1
            while j < n and line[j] in " \t":
                j += 1
            if j < n and line[j] != ",":
                return None
            fields.append(text.strip(" \t"))
        else:
            j = i
            while j < n and line[j] != ",":
                if line[j] == '"':
                    return None
                j += 1
            fields.append(line[i:j].strip(" \t"))
        if j >= n:
            return fields
        i = j + 1


def test_random_lines_against_a_reader_by_characters(spark):
    rng = random.Random(4)
    rules = (parsefail.FieldRule("a", r"(?s).*", True, "string"), parsefail.FieldRule("b", "[0-9]+", True, "bigint"), parsefail.FieldRule("c", r"(?s).*", True, "string"))
    lines = sorted({"".join(rng.choice('ab1, ","\t') for _ in range(rng.randrange(1, 14))) for _ in range(3000)})
    got = {r.c0: r for r in parsefail.screen_rows(spark.createDataFrame([(x,) for x in lines], "c0 string"), rules=rules).collect()}
    for line in lines:
        fields, r = brute(line), got[line]
        if not line.strip():
            want = "not_a_row"
        elif fields is None:
            want = "quoting"
        elif len(fields) != 3:
            want = "column_count"
        else:
            want = "ok" if not fields[1] or fields[1].isdigit() else "value:b"
        assert r._reason == want, repr(line)
        if want == "ok":
            assert (r.row.a or "", r.row.c or "") == (fields[0], fields[2]), repr(line)


def test_very_long_lines(spark):
    lines = ["a," * 50_000, '"' + "a," * 50_000, '"a",' * 50_000, 'A,"' + '""x' * 50_000 + '",1,,,,,,,', 'A,"' + "x" * 300_000 + '",' + "1" * 50_000 + ",,,,,,,", "," * 300_000]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, c0 string")
    got = [r._reason for r in sorted(parsefail.screen_rows(df).collect())]
    assert got == ["column_count", "quoting", "column_count", "ok", "range:latest", "column_count"]


@pytest.mark.parametrize(
    ("message", "kind"),
    [
        (None, None), ("", None), (" ; | ", None), ("insider title empty; schemaVersion missing", None), ("document type given twice, both '4'", None), ("warning: error in fax header ignored", None), ("remarks mention a failed delivery", None),
        ("note: invalid phone number in signature block", None), ("footnote F3 referenced but not defined", None), ("multiple reportingOwner blocks (2); using first only", None), ("ValueError: missing issuerCik", "missing_part"),
        ("MISSING OWNERSHIPDOCUMENT ROOT | insider title empty", "missing_part"), ("parse: unsupported documentType '3'", "unsupported_type"), ("Start tag expected, '<' not found", "broken_xml"), ("FAILED: no well-formed XML found", "broken_xml"),
        ("Opening and ending tag mismatch: value line 3 and ownershipDocument, line 9", "broken_xml"), ("ENTITY 'NBSP' NOT DEFINED, LINE 75", "broken_xml"), ("invalid byte 0x9c in position 7", "encoding"), ("XML cut off after 311 bytes", "truncated"),
        ("invalid XML", "broken_xml"), ("file is zero bytes", "not_xml"), ("EndTag: '</' not found", "broken_xml"), ("multiple owners; could not read optional title, ignored", None), ("document could not be read", "unreadable"),
        ("insider title empty | unable to parse the whole document", "unreadable"), ("the moon is full", "unknown"), ("schemaVersion missing; the moon is full", "unknown"), ("the moon is full | missing documentType", "missing_part"), ("artifact returned html", "not_xml"),
    ],
)
def test_filing_messages(spark, message, kind):
    assert spark.createDataFrame([(message,)], "m string").select(parsefail.filing_reason(F.col("m")).alias("k")).head().k == kind


def test_messages_of_a_parser_that_the_rules_were_not_written_from(spark):
    """Every error that the expat parser can state is a failure: a measured miss of at most one in ten, and none of these may pass as a remark."""
    own = ("out of memory", "entity tag", "reparse", "parsing", "suspended", "aborted", "feature", "DTD support", "limit on", "amplification", "cannot change setting", "parser state", "invalid argument", "XML_GetBuffer")  # states of the parser, not of the document
    texts = [t for i in range(1, 60) if (t := expat.ErrorString(i)) and not any(x in t for x in own)]
    kinds = [r.k for r in spark.createDataFrame([(f"{t}: line 3, column 7",) for t in texts], "m string").select(parsefail.filing_reason(F.col("m")).alias("k")).collect()]
    assert len(texts) > 20 and None not in kinds
    assert sum(k == "unknown" for k in kinds) <= len(kinds) // 10, [t for t, k in zip(texts, kinds) if k == "unknown"]


def test_filing_rows_keep_all_others(spark):
    df = spark.createDataFrame([("a", None, "own"), ("b", "XML cut off after 3 bytes", "own"), ("c", "insider title empty", "own")], "accession_number string, parse_error string, _reason string")
    assert {(r.accession_number, r._reason) for r in parsefail.filing_rows(df).collect()} == {("a", None), ("b", "truncated"), ("c", None)}
    assert parsefail.filing_rows(df.limit(0)).count() == 0

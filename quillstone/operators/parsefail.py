"""Rows that fail to parse, set apart with the reason while all others load typed.

A line is read permissively (``from_csv``) under an explicit schema with a column that keeps the raw text of a corrupt record. Corrupt rows are then told apart
by quoting and field count; every field of the others must match its column's pattern and survive the cast to its type. Everything is an expression of one
scan: no shuffle, no second pass.

Screen lines: defined results
* null, blank, header (any case, with or without byte-order mark) and footer lines are no rows: reason ``not_a_row``.
* ``quoting``: the line is no sequence of plain fields without a double quote and of fields wholly in double quotes with doubled inner ones.
* ``column_count``: well quoted, but not exactly the fields of the schema.
* ``value:<column>``: the first column whose text is not of its kind. Empty and ``N/A`` are allowed where the column is optional.
* ``range:<column>``: a value of the right kind that the column's type can't hold exactly (more than 20 whole or 18 fractional digits of a decimal, a count
  beyond 64 bits). It is set apart as well, never loaded as null or rounded; it is no fault of the line.
* ``ok`` rows carry typed fields; thousands separators and percent signs are taken off.

Messages of filings: a message is a list of statements between bars and semicolons. A statement is a failure if it names a fault of the document as a whole (no
or another root, no well-formed markup, undecodable bytes, nothing or only a part there, or that the document could not be read), unless it says that the
fault was passed over; it is a remark if it speaks of a part of a document that was read, and ``unknown`` if neither can be told. The first failure is the
message's reason; a message without one is ``unknown`` if a statement is, so that it is looked at and not taken for a remark. Blank and null messages say
nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.once import with_once

DECIMAL = r"(?:[0-9]+|[0-9]{1,3}(?:,[0-9]{3})+)(?:\.[0-9]+)?|\.[0-9]+"
WHOLE = r"[0-9]+|[0-9]{1,3}(?:,[0-9]{3})+"
#: Decimals load with up to 20 whole and 18 fractional digits.
NUMBER = "decimal(38,18)"
_TOO_FINE = r"\.[0-9]{18}0*[1-9]"


@dataclass(frozen=True)
class FieldRule:
    """A column of a delimited feed: the pattern of its text, whether it may be missing, how it is typed, and whether it must be above 0."""

    name: str
    pattern: str
    optional: bool
    kind: str
    positive: bool = False


#: The ten columns of the high and low screens.
SCREEN = (
    FieldRule("symbol", r"[A-Za-z][A-Za-z0-9.\-]{0,9}", False, "ticker"),
    FieldRule("name", r"(?s).*", True, "string"),
    FieldRule("latest", DECIMAL, False, NUMBER, True),
    FieldRule("change", f"[+-]?(?:{DECIMAL})", True, NUMBER),
    FieldRule("pct_change", f"[+-]?(?:{DECIMAL})%", True, NUMBER),
    FieldRule("volume", WHOLE, True, "bigint"),
    FieldRule("hi_count", WHOLE, True, "bigint"),
    FieldRule("pct_from_high", f"[+-]?(?:{DECIMAL})%", True, NUMBER),
    FieldRule("pct_from_low", f"[+-]?(?:{DECIMAL})%", True, NUMBER),
    FieldRule("time", r"(?:[01][0-9]|2[0-3]):[0-5][0-9] ET", True, "string"),
)
HEADER = r'(?is)^[\x{FEFF}\s]*"?symbol"?\s*,\s*"?name"?\s*,\s*"?latest"?\s*,.*'
FOOTER = r'(?is)^[\x{FEFF}\s]*"?\s*downloaded from\b.*'
#: Reasons that are a fault of the line, and not of the type that it should be loaded into.
FAULTS = ("quoting", "column_count", "value:")


def _typed(field: Column, kind: str) -> Column:
    if kind == "string":
        return field
    if kind == "ticker":
        return F.upper(field)
    return F.regexp_replace(field, "[,%]", "").try_cast(kind)


def _first(reasons: list[tuple[Column, str]]) -> Column:
    chain = F.when(*(reasons[0][0], F.lit(reasons[0][1])))
    for wrong, name in reasons[1:]:
        chain = chain.when(wrong, F.lit(name))
    return chain


def well_quoted(line: Column) -> Column:
    """Whether each field is free of double quotes or lies wholly within two, inner ones doubled, blanks and tabs around it aside.

    Cut at its quotes, a line lies outside of them in every other piece. Such a piece is empty within a field (a doubled quote), and else ends one field and
    begins another. No pattern with a repeated group is used: the engine's matcher would need a stack as deep as the line is long."""
    bare = lambda x: F.btrim(x, F.lit(" \t"))
    pieces = F.split(line, '"', -1)
    middle = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 2, F.lit(0)))
    outside = F.filter(middle, lambda _, i: i % 2 == 1)
    between = F.forall(outside, lambda x: (x == "") | (bare(x).startswith(",") & bare(x).endswith(",")))
    head, tail = bare(F.element_at(pieces, 1)), bare(F.element_at(pieces, -1))
    return ~line.contains('"') | ((F.size(pieces) % 2 == 1) & ((head == "") | head.endswith(",")) & ((tail == "") | tail.startswith(",")) & between)


def screen_rows(df: DataFrame, line: str = "c0", rules: tuple[FieldRule, ...] = SCREEN) -> DataFrame:
    """All columns of ``df`` plus ``_reason``, ``_raw`` (only of rejected rows) and ``row``, a struct of typed fields (only of valid ones); columns that bear
    one of these names give way."""
    raw = F.col(line)
    n = len(rules)
    schema = ", ".join(f"{r.name} string" for r in rules) + ", _corrupt string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "nullValue": "", "emptyValue": "", "maxCharsPerColumn": "-1"}
    few = F.length(raw) - F.length(F.replace(raw, F.lit(","), F.lit(""))) < 2_000 * n  # the reader ends the job at a line of 20,480 fields
    parsed = F.from_csv(F.when(few, raw), schema, options)
    corrupt = ~few | F.col("_fields._corrupt").isNotNull()
    fields = {r.name: F.coalesce(F.btrim(F.col(f"_fields.{r.name}"), F.lit(" \t")), F.lit("")) for r in rules}
    missing = {c: (f == "") | (f == "N/A") for c, f in fields.items()}
    values, ranges = [], []
    for r in rules:
        f = fields[r.name]
        wrong = ~f.rlike(f"^(?:{r.pattern})$")
        if r.positive:
            wrong = wrong | ~f.rlike("[1-9]")
        values.append((wrong & ~missing[r.name] if r.optional else wrong, f"value:{r.name}"))
        if r.kind not in ("string", "ticker"):
            lost = _typed(f, r.kind).isNull() | (f.rlike(_TOO_FINE) if r.kind == NUMBER else F.lit(False))
            ranges.append((~missing[r.name] & lost, f"range:{r.name}"))
    reason = (
        F.when(raw.isNull() | raw.rlike(r"^[\x{FEFF}\s]*$") | raw.rlike(HEADER) | raw.rlike(FOOTER), "not_a_row")
        .when(~well_quoted(raw), "quoting")
        .when(corrupt, "column_count").otherwise(F.coalesce(_first(values), _first(ranges), F.lit("ok")))
    )
    typed = F.struct(*[F.when(~missing[r.name], _typed(fields[r.name], r.kind)).alias(r.name) for r in rules])
    out = with_once(with_once(df.drop("_fields", "_reason", "_raw", "row"), "_fields", parsed), "_reason", reason)
    return out.withColumns({"_raw": F.when(~F.col("_reason").isin("ok", "not_a_row"), raw), "row": F.when(F.col("_reason") == "ok", typed)}).drop("_fields")


def is_fault(reason: Column | str) -> Column:
    """Whether a reason says that the line itself is not valid."""
    return (F.col(reason) if isinstance(reason, str) else reason).rlike("^(?:" + "|".join(FAULTS) + ")")


# --- messages of filings -----------------------------------------------------------------------------------------------------------

_WHOLE = r"(?:document|xml|artifact|file|filing|submission|content|body|payload|response|markup|input|stream|form 4|root(?: element)?)"
_FAILED = r"(?:could not|couldn't|cannot|can't|can not|unable to|failed to|not able to)"
_READ = r"(?:read|parsed?|load(?:ed)?|open(?:ed)?|decoded?|processed|interpreted)"
#: The parts without which an ownership document is none.
_PARTS = r"(?:ownershipdocument(?: root)?|document ?type|issuer ?cik|root(?: element)?)"
#: Faults of a document as a whole: what it lacks or is, how its markup is broken in the words of XML parsers, its bytes, its extent, or plainly that it was not read.
FAILURES = (
    ("missing_part", rf"(?:missing|no|lacks?|without) (?:an? |the )?{_PARTS}\b|\b{_PARTS} (?:is |was )?(?:missing|absent|not found)"),
    ("unsupported_type", r"unsupported (?:document ?|form ?)type"),
    ("not_xml", rf"\b(?:is|are|was|got|found|returned|looks like) (?:an? )?(?:html|pdf|plain text|json)\b|\bnot (?:an? )?(?:ownership document|xml|form 4)\b|{_WHOLE} (?:is|was) (?:zero|0|no) (?:bytes|length)|zero[- ](?:bytes?|length)|\b0 bytes\b|{_WHOLE} (?:is|was) (?:empty|blank)|\bempty {_WHOLE}|no element found"),
    ("broken_xml", r"well[- ]?formed|invalid xml|malformed (?:xml|document|markup)|\b(?:start|end|opening|closing|ending) ?tag\b|\btags? mismatch|mismatched tag|unclosed|unterminated|not (?:closed|terminated|finished)|extra content|junk after|\bentit(?:y|ies)\b.*(?:not defined|undefined)|(?:undefined|recursive|asynchronous|parameter|binary|external) entit(?:y|ies)|attributes? construct|duplicate attribute|syntax error|invalid token|unexpected (?:token|end|character)|\bpcdata\b|\bcdata\b|xml declaration|text declaration|unbound prefix|(?:invalid|illegal|reserved) (?:character|prefix)|prefix must not|parser error|premature end|multiple root"),
    ("encoding", rf"{_FAILED} decode|undecodable|invalid (?:continuation |start )?byte|codec can't|(?:bad|unknown|wrong|unsupported|invalid) encoding|encoding (?:specified|error|is|was)|not (?:valid |proper )+utf-?8|invalid utf-?8|partial character"),
    ("truncated", rf"\bcut off|\btruncated\b|incomplete {_WHOLE}|{_WHOLE} (?:is|was) incomplete|ends? (?:before|too early|prematurely)"),
    ("unreadable", rf"{_FAILED} (?:be )?{_READ}(?: as)?(?: (?:the|this|an?|its))?(?: \w+)? {_WHOLE}|\b{_WHOLE} {_FAILED} be {_READ}|\b(?:unreadable|unparse?able|corrupt(?:ed)?) {_WHOLE}|{_WHOLE} (?:is|was) (?:unreadable|unparse?able|corrupt(?:ed)?|broken|damaged)"),
)
#: Said of a fault that was passed over.
_PASSED = r"\b(?:ignored|skipped|tolerated|optional|recovered|harmless)\b"
#: Said of a part of a document that was read.
REMARK = rf"{_PASSED}|\b(?:empty|missing|blank|absent)$|\b(?:given|listed|stated|reported) (?:twice|\w+ times)|\b(?:later|earlier|older|newer) than\b|referenced but|\bmultiple\b|\busing (?:the )?(?:first|last)|^\s*(?:note|warning|remarks?|info|hint)\b|\bboth '"


def statement_kind(statement: Column) -> Column:
    """Of a statement in lower case: the kind of failure, ``remark``, ``unknown``, or null if it is blank."""
    kinds = _first([(statement.rlike(pattern), name) for name, pattern in FAILURES])
    failure = F.when(~statement.rlike(_PASSED), kinds)
    return F.when(statement.rlike(r"\S"), F.coalesce(failure, F.when(statement.rlike(REMARK), "remark"), F.lit("unknown")))


def filing_reason(message: Column) -> Column:
    """Reason of a parse message: the kind of its first failure, ``unknown``, or null for remarks, blank and null messages."""
    kinds = F.transform(F.split(F.lower(message), r"[|;]"), statement_kind)
    told = F.filter(kinds, lambda k: ~k.isin("remark", "unknown"))
    return F.when(message.isNotNull(), F.coalesce(F.get(told, F.lit(0)), F.when(F.array_contains(F.array_compact(kinds), "unknown"), "unknown")))


def filing_rows(df: DataFrame, message: str = "parse_error") -> DataFrame:
    """All columns of ``df`` plus ``_reason``: why a filing is set apart, null for those that load."""
    return with_once(df.drop("_reason"), "_reason", filing_reason(F.col(message)))

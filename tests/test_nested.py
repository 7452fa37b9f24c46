import json
import random

import pytest

from quillstone.operators import nested

TX = {"transaction_date": "2024-01-02", "coding": {"transaction_code": "S"}, "amounts": {"shares": {"value": "1,000.5", "footnoteId": {"id": "F2"}}, "price_per_share": {"value": 2.5, "footnote_ids": ["F3", {"id": "F2", "note": None}]}}}


def flat(payload):
    return nested.flatten(payload if payload is None or isinstance(payload, str) else json.dumps(payload))


def found(payload):
    row = flat(payload)
    return [(t["transaction_index"], kind, t["footnote_ids"]) for kind in ("non_derivative", "derivative") for t in row[kind]]


def kinds(payload):
    return [x[1] for x in found(payload)]


def test_flat_list_orders_non_derivative_first_and_skips_nulls():
    d = TX | {"transaction_category": "Derivative"}
    n = TX | {"transaction_category": "nonDerivative", "footnote_ids": "F9, F1"}
    assert found({"issuer": {}, "transactions": [None, d, None, n, 5, {}]}) == [(0, "non_derivative", ["F2", "F3", "F9", "F1"]), (1, "derivative", ["F2", "F3"])]


def test_stated_index_wins_and_text_is_a_number():
    a, b, c, e = (TX | {"transaction_category": "derivative", "transaction_index": i} for i in ("7", None, 12345678901, "3.0"))
    assert [x[0] for x in found({"transactions": [a, b, c, e, TX | {"transaction_category": "derivative", "transaction_index": "1e3"}]})] == [7, 1, 12345678901, 3, 4]


def test_encoded_list_wrapper_tables_and_single_object():
    one = TX | {"transaction_category": "derivative"}
    assert found({"filing": {"issuer": {}, "transactions": json.dumps([one])}, "meta": {"flags": []}}) == [(0, "derivative", ["F2", "F3"])]
    assert flat({"filing": {"issuer": {}, "transactions": json.dumps([one])}})["variant"] == "encoded_rows"
    assert found({"transactions": json.dumps(json.dumps([one]))}) == [] and found({"transactions": json.dumps({"list": json.dumps([one])})}) == [(0, "derivative", ["F2", "F3"])]
    assert kinds({"issuer": {}, "tables": {"derivative": {"transactions": TX}, "non_derivative": {"transactions": [TX]}}}) == ["non_derivative", "derivative"]
    assert found({"issuer": {}, "tables": {"derivative": None, "non_derivative": {"transactions": None}}}) == []


def test_ownership_document_goes_to_typed_subtype_tables():
    tx = {"securityTitle": {"value": "Common"}, "transactionDate": {"value": "2024-01-01"}, "transactionCoding": {"transactionCode": "P"}, "transactionAmounts": {"transactionShares": {"value": "1", "footnoteId": [{"id": "F1"}, {"id": "F1"}]}}, "postTransactionAmounts": {"sharesOwnedFollowingTransaction": {"value": "77"}}}
    option = tx | {"conversionOrExercisePrice": {"value": "2.5"}, "expirationDate": {"value": "2030-01-01"}, "underlyingSecurity": {"underlyingSecurityTitle": {"value": "Common U"}, "underlyingSecurityShares": {"value": "9"}}}
    owner = {"reportingOwnerId": {"rptOwnerCik": "5", "rptOwnerName": "P Q"}, "reportingOwnerRelationship": {"isDirector": True, "isOfficer": "1", "officerTitle": "CFO"}}
    doc = {"ownershipDocument": {"documentType": "4", "issuer": {"issuerCik": "1"}, "reportingOwner": [owner, {"rptOwnerCik": "6"}], "nonDerivativeTable": {"nonDerivativeTransaction": tx, "nonDerivativeHolding": {"securityTitle": {"value": "H"}, "postTransactionAmounts": {"sharesOwnedFollowingTransaction": {"value": "3"}}, "footnoteId": {"id": "F8"}}}, "derivativeTable": {"derivativeTransaction": [option], "derivativeHolding": [{"securityTitle": "W", "exerciseDate": "2025-05-05"}]}, "footnotes": {"footnote": [{"id": "F7", "text": "x"}]}}}
    row = flat(doc)
    n, d = row["non_derivative"], row["derivative"]
    assert [(t["position"], t["security_title"], t["shares"], t["shares_after"], t["footnote_ids"]) for t in n] == [(0, "Common", "1", "77", ["F1"])]
    assert [(t["position"], t["shares"], t["exercise_price"], t["expiration_date"], t["underlying_title"], t["underlying_shares"], t["footnote_ids"]) for t in d] == [(1, "1", "2.5", "2030-01-01", "Common U", "9", ["F1"])]
    assert [(h["security_title"], h["shares_after"], h["footnote_ids"]) for h in row["non_derivative_holdings"]] == [("H", "3", ["F8"])] and [h["exercise_date"] for h in row["derivative_holdings"]] == ["2025-05-05"]
    assert [(o["owner_cik"], o["owner_name"], o["is_director"], o["officer_title"]) for o in row["owners"]] == [("5", "P Q", "true", "CFO"), ("6", None, None, None)]
    assert [(x["position"], x["footnote_id"], x["text"]) for x in row["notes"]] == [(0, "F7", "x")] and (row["variant"], row["issuer_cik"], row["document_type"]) == ("tables", "1", "4")


@pytest.mark.parametrize(
    ("payload", "want"),
    [
        # a transaction that repeats fields of its filing
        ({"transactions": [TX | {"document_type": "4", "issuer": {"cik": "1"}, "transaction_category": "derivative"}]}, [(0, "derivative", ["F2", "F3"])]),
        (TX | {"documentType": "4", "issuerCik": "1", "periodOfReport": "2024-01-01"}, [(0, "non_derivative", ["F2", "F3"])]),
        # bare rows under the name of a table
        ({"nonDerivative": [{"security_title": "Common", "shares": 5}, {"title": "Pref"}], "derivative": {"security_title": "Option"}}, [(0, "non_derivative", []), (1, "non_derivative", []), (2, "derivative", [])]),
        ({"nonDerivativeTable": [{"security_title": "Common", "sharesOwnedFollowingTransaction": 5}], "derivative_table": {"rows": [TX]}}, [(0, "derivative", ["F2", "F3"])]),
        # other spellings of footnotes
        ({"transactions": [{"date": "2024-01-01", "code": "S", "shares": {"value": 1, "footnoteRefs": ["F1"]}, "footnotes": [{"id": "F2"}, "F3"]}]}, [(0, "non_derivative", ["F1", "F2", "F3"])]),
        ({"transactions": [{"date": "2024-01-01", "code": "S", "price": {"value": 1, "@footnoteID": "F1"}, "shares": {"value": 2, "id": "F4"}, "footnotes": [{"id": "F5", "text": "inline"}]}]}, [(0, "non_derivative", ["F1", "F4", "F5"])]),
        ({"transactions": [{"date": "2024-01-01", "code": "S", "Footnote-Ids": [["F1"], {"footnoteId": {"id": "F2"}}]}]}, [(0, "non_derivative", ["F1", "F2"])]),
        # a flat row, other spellings, no name above it that helps
        ([[{"TRANSACTIONDATE": "2024-01-01", "TransactionCode": "S", "Shares": 1}]], [(0, "non_derivative", [])]),
        ({"a": {"b": [{"on": "2024-01-01", "how": "S", "n": 12}, {"on": "2024-01-01", "note": "nothing happened"}]}}, [(0, "non_derivative", [])]),
        ({"events": [{"when": {"date": "2024-03-03"}, "trade": {"quantity": 5, "price": 2, "side": {"acquired": "A"}}, "date": "2024-03-03"}]}, [(0, "non_derivative", [])]),
        # a record of rows
        ({"transactions": {"0": TX, "1": TX}}, [(0, "non_derivative", ["F2", "F3"]), (1, "non_derivative", ["F2", "F3"])]),
        # told to be a derivative by what it is made of
        ({"transactions": [TX | {"underlyingSecurity": {"title": "C"}}, TX | {"expiration_date": "2030-01-01"}]}, [(0, "derivative", ["F2", "F3"]), (1, "derivative", ["F2", "F3"])]),
        # headers and holdings are none
        ({"document_type": "4", "period_of_report": "2024-01-01", "issuer": {"cik": "1", "name": "X"}, "owners": [{"rptOwnerCik": "2", "rptOwnerName": "Y"}], "footnotes": [{"id": "F1", "text": "t"}]}, []),
        ({"holdings": [{"security_title": "C", "shares": 4, "direct_indirect": "D"}], "address": {"zipCode": "1", "street": "x"}}, []),
    ],
)
def test_layouts_that_the_data_do_not_have(payload, want):
    assert found(payload) == want


def test_nesting_of_any_depth():
    for depth in (400, 1_200, 100_000):
        deep = '{"w": [' * depth + json.dumps({"issuer": {"cik": "1"}, "transactions": [TX]}) + "]}" * depth
        assert found(deep) == [(0, "non_derivative", ["F2", "F3"])], depth
    inside = json.dumps(TX)[:-1] + ', "x": ' + "[" * 3_000 + '{"footnote_ids": "F9"}' + "]" * 3_000 + "}"
    assert found('{"transactions": [' + inside + "]}") == [(0, "non_derivative", ["F2", "F3", "F9"])]


def test_records_of_very_many_members_are_not_kept():
    nested.transition.cache_clear()
    got = found({"transactions": {f"{i}": TX for i in range(5_000)}})
    assert len(got) == 5_000 and got[-1] == (4_999, "non_derivative", ["F2", "F3"]) and nested.transition.cache_info().currsize < 20


def test_deep_parser_agrees_with_the_standard_one():
    rng = random.Random(2)

    def value(n):
        kind = rng.randrange(8 if n else 5)
        if kind < 5:
            return rng.choice([None, True, -1, 2.5, 1e30, "", 'a"\\é\n', "[x", 0])
        return [value(n - 1) for _ in range(rng.randrange(4))] if kind < 6 else {rng.choice(["a", "b c", '"']): value(n - 1) for _ in range(rng.randrange(4))}

    for _ in range(300):
        text = json.dumps(value(5), indent=rng.choice([None, 1]))
        assert nested._parse_deep(text) == json.loads(text)
        broken = text[: rng.randrange(len(text))] + rng.choice(["", ",", "]", "}", "x", '"'])
        try:
            want = json.loads(broken)
        except ValueError:
            with pytest.raises(ValueError):
                nested._parse_deep(broken)
        else:
            assert nested._parse_deep(broken) == want


def test_broken_and_empty_payloads_have_no_children():
    for payload, variant in ((None, "null"), ("", "null"), ("  ", "null"), ("{", "malformed"), ("[" * 200_000, "malformed"), ("[]", "unknown"), ("3", "unknown"), ('{"a": 1}', "unknown"), ('{"issuer": {"cik": 1}}', "header_only")):
        row = nested.flatten(payload)
        assert row["variant"] == variant and not any(row[t] for t in nested.TABLES)


def frame(spark):
    payload = json.dumps({"issuer": {"cik": "7"}, "owners": [{"ownerName": "A"}], "transactions": [TX | {"transaction_category": "derivative"}, {"transaction_category": "non derivative", "coding": {}}]})
    rows = [(1, "a", payload, "x"), (1, "a", payload, "x"), (2, None, None, "x"), (3, "c", "{broken", None), (None, "d", payload, "x")]
    return spark.createDataFrame(rows, "record_id long, accession_number string, payload string, transaction_index string")


def test_operator_over_spark(spark):
    df = frame(spark)
    parsed = nested.records(df)
    got = {tuple(r) for r in nested.attached(parsed).collect()}
    want = {(i, *t) for i in (1, None) for t in ((1, "derivative", "F2"), (1, "derivative", "F3"), (0, "non_derivative", ""))}
    assert got == want and nested.attached(parsed).count() == len(want)
    both = {(r.record_id, r.transaction_category, r.position, r.shares) for r in nested.transactions(parsed).collect()}
    assert {x[:3] for x in both} == {(i, *t) for i in (1, None) for t in (("derivative", 1), ("non_derivative", 0))}
    d = nested.transactions(parsed, "derivative").head()
    assert str(d.shares) == "1000.50000000" and str(d.transaction_date) == "2024-01-02" and d.exercise_price is None
    assert {r.footnote_id for r in nested.footnote_refs(parsed).collect()} == {"F2", "F3"}
    assert nested.records(df.limit(0)).count() == 0 and nested.holdings(parsed).count() == 0 and nested.subtype(parsed, "notes").count() == 0


def test_only_what_is_wanted_leaves_the_pass(spark):
    links = nested.records(frame(spark), only=nested.LINKS)
    assert [f.name for f in links.schema["derivative"].dataType.elementType] == ["transaction_index", "footnote_ids"] and "owners" not in links.columns
    assert {tuple(r) for r in nested.attached(links).collect()} == {tuple(r) for r in nested.attached(nested.records(frame(spark))).collect()}


def test_tables_are_written_from_one_pass_and_keep_their_links(spark, tmp_path):
    made = nested.write_tables(frame(spark), f"file://{tmp_path}")
    assert set(made) == {"records", *nested.TABLES} and made["records"].count() == 5
    assert {r.record_id for r in made["derivative"].join(made["records"], "record_id").collect()} == {1} and made["owners"].count() == 3
    assert dict(made["derivative"].dtypes)["expiration_date"] == "date" and "expiration_date" not in made["non_derivative"].columns

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillstone.operators import embed
from quillstone.sources import http

MODEL = embed.Model("tiny", 16, lambda: embed.Hashing(16))


def chunks(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, content_hash string, text string")


NOW = lambda n: F.lit(dt.datetime(2024, 1, n))


def test_incremental_sync(spark):
    state0 = spark.createDataFrame([], embed.STATE)
    vectors0 = spark.createDataFrame([], embed.VECTORS)
    first = chunks(spark, [("a", "1", "alpha beta"), ("b", "1", None)])
    state, vectors = embed.sync(first, state0, vectors0, MODEL, NOW(1))
    assert {(r.chunk_id, r.status, r.embedded_at is None) for r in state.collect()} == {("a", "ok", False), ("b", "error", True)} and {r.chunk_id for r in vectors.collect()} == {"a"}
    state2, vectors2 = embed.sync(chunks(spark, [("a", "1", "changed text, same hash"), ("b", "2", "now here"), ("c", "1", "new")]), state, vectors, MODEL, NOW(2))
    assert {(r.chunk_id, r.status, r.content_hash, r.embedded_at.day) for r in state2.collect()} == {("a", "ok", "1", 1), ("b", "ok", "2", 2), ("c", "ok", "1", 2)}
    v1, v2 = ({r.chunk_id: list(r.embedding) for r in v.collect()} for v in (vectors, vectors2))
    assert v2["a"] == v1["a"] and set(v2) == {"a", "b", "c"} and sum(abs(x) for x in v2["c"]) == 1
    state3, vectors3 = embed.sync(chunks(spark, [("a", "9", None)]), state2, vectors2, MODEL, NOW(3))
    a = state3.filter("chunk_id = 'a'").head()
    assert (a.status, a.embedded_at, a.updated_at.day) == ("error", None, 3) and {r.chunk_id for r in vectors3.collect()} == {"a", "b", "c"}  # the vector in use stays


def test_kept_index_embeds_once_and_questions_read_no_text(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    class Counts(embed.Hashing):
        def embed(self, texts, kind="document"):
            if kind == "document":
                calls.add(len(texts))
            return super().embed(texts, kind)

    model = embed.Model("counts", 16, lambda: Counts(16))
    index = embed.VectorIndex(spark, f"file://{tmp_path}", model)
    texts = [("a", "1", "alpha beta"), ("b", "1", "gamma delta")]
    index.sync(chunks(spark, texts), NOW(1))
    index.sync(chunks(spark, texts), NOW(2))
    assert calls.value == 2
    state = index.sync(chunks(spark, [("b", "2", "gamma delta again"), ("c", "1", None)]), NOW(3))
    assert {(r.chunk_id, r.content_hash, r.status, r.updated_at.day) for r in state.collect()} == {("a", "1", "ok", 1), ("b", "2", "ok", 3), ("c", "1", "error", 3)} and calls.value == 3
    assert {r.chunk_id for r in index.vectors().collect()} == {"a", "b"}
    got = embed.evaluate({"one": (index.vectors(), model), "two": (embed.VectorIndex(spark, f"file://{tmp_path}", model).vectors(), model)}, ["gamma delta", "alpha"], 2).collect()
    assert [(r.model_id, r.question, r["rank"], r.chunk_id) for r in got if r["rank"] == 1] == [(m, q, 1, c) for m in ("one", "two") for q, c in (("gamma delta", "b"), ("alpha", "a"))] and len(got) == 8 and calls.value == 3
    assert embed.VectorIndex(spark, f"file://{tmp_path}/none", model).vectors().count() == 0


def test_words_go_where_their_digest_says():
    h = embed.Hashing(8)
    vector = h.embed(["Sale, SALE of"], "query")[0]
    want = [0.0] * 8
    for word, n in (("sale", 2), ("of", 1)):
        d = int(__import__("hashlib").md5(word.encode()).hexdigest()[:8], 16)
        want[(d >> 1) % 8] += n if d & 1 else -n
    assert vector == want


def test_failures_stay_in_their_batch(spark):
    class Fails:
        def embed(self, texts, kind):
            assert kind == "document"
            if any("bad" in t for t in texts):
                raise RuntimeError("no service")
            return [[1.0, 0.0]] * len(texts)

    rows = [(str(i), "h", "bad" if i == 3 else "fine") for i in range(8)]
    got = {r.chunk_id: (r.status, r.error_message) for r in embed.embed(chunks(spark, rows).coalesce(1), embed.Model("f", 2, Fails), 2).collect()}
    assert {k for k, v in got.items() if v[0] == "error"} == {"2", "3"} and got["3"][1] == "RuntimeError: no service"
    assert {r.error_message for r in embed.embed(chunks(spark, [("a", "h", "x")]), embed.Model("f", 3, Fails)).collect()} == {"wrong dimensions"}
    assert [embed.batch_size(x) for x in (None, 0, 999, 7)] == [32, 1, 256, 7]


def test_retrieval_filters_and_answer(spark):
    texts = ["sale of shares", "gift to trust", "sale of options", "sale of shares again"]
    base = spark.createDataFrame([(f"c{i}", "0001-24-7", i, "0007", "AB" if i < 3 else "ab", "S", "D" if i != 1 else "A", "high" if i % 2 else None, t) for i, t in enumerate(texts)], "chunk_id string, accession_number string, transaction_index int, issuer_cik string, issuer_ticker string, transaction_code string, acquired_disposed_code string, universe_group string, text string")
    vectors = base.join(embed.embed(base.selectExpr("chunk_id", "'h' as content_hash", "text"), MODEL).select("chunk_id", "embedding"), "chunk_id")
    found = embed.retrieve(vectors, "sale of shares", MODEL, ticker=" ab ", side="s", group="nonsense")
    assert [r.chunk_id for r in found.collect()][0] == "c0" and found.count() == 2 and found.head().url.endswith("/7/0001247/0001-24-7-index.htm")
    assert [r.chunk_id for r in embed.retrieve(vectors, "x", MODEL, side="P", group="HIGH").collect()] == ["c1"]
    said = []
    reply = embed.answer(found, "why?", [("user", str(i)) for i in range(9)], lambda m: said.append(m) or "because", ticker="AB", side="s")
    assert reply == "because" and [m["role"] for m in said[0]] == ["system", *["user"] * 7] and [m["content"] for m in said[0][1:7]] == list("345678")
    last = said[0][-1]["content"]
    assert last.startswith("Filters: ticker=AB, side=s, universe_group=any\n\nRetrieved excerpts:\n[1] accession=0001-24-7 txn_index=0 ticker=AB code=S A/D=D\nURL: ") and last.endswith("\n\nQuestion: why?")
    assert embed.answer(found.limit(0), "why?", [], lambda m: "never") == embed.NOTHING


def test_pages_source(spark):
    spark.dataSource.register(http.Pages)
    got = {r.url: r for r in spark.read.format("pages").options(urls="http://a/1 http://a/missing", agent=" me   me@x ", interval="0", opener="quillstone.sources.http:dry_run").load().collect()}
    assert got["http://a/1"].body == b"http://a/1|me me@x" and got["http://a/missing"].error == "HTTP 404" and got["http://a/missing"].status == 404


def test_pages_of_a_table_and_quotes(spark):
    df = spark.createDataFrame([(1, "http://a/1", "own"), (2, "http://a/missing", "own"), (3, None, "own")], "id int, url string, error string")
    got = {r.id: (r.status, r.body and bytes(r.body), r.error) for r in http.fetch_rows(df, "url", "me me@x", "quillstone.sources.http:dry_run", 0).collect()}
    assert got == {1: (200, b"http://a/1|me me@x", None), 2: (404, None, "HTTP 404"), 3: (None, None, "no address")}
    with pytest.raises(ValueError):
        http.fetch_rows(df, "url", " ")
    asked = http.quotes(spark.createDataFrame([("AB",), ("AB",), ("QX",), (None,)], "symbol string"), info="quillstone.sources.http:echo_info", interval=0)
    assert {(r.symbol, r.value, r.error) for r in asked.collect()} == {("AB", '{"symbol": "AB", "longName": "Name of AB"}', None), ("QX", None, "TimeoutError: QX")}


def test_hosted_models_are_told_the_kind_and_missing_libraries_are_rows(spark):
    said = []

    class Client:
        def embed(self, texts, model, input_type):
            said.append((tuple(texts), model, input_type))
            return type("Answer", (), {"embeddings": [(1.0, 0.0)] * len(texts)})

    remote = embed.Remote("m", Client)
    assert remote.embed(["a"]) == [[1.0, 0.0]] and remote.embed(["b"], "query") == [[1.0, 0.0]] and remote.embed([]) == []
    assert said == [(("a",), "m", "document"), (("b",), "m", "query")]
    rows = embed.embed(chunks(spark, [("a", "h", "x")]), embed.MODELS["all-MiniLM-L6-v2"]).collect()
    assert rows[0].status == "ok" or rows[0].error_message.startswith("ModuleNotFoundError")


def test_chat_model_behind_an_address():
    sent = []
    reply = http.chat([{"role": "user", "content": "why?"}], "http://h/", "m", send=lambda url, body, timeout: sent.append((url, body, timeout)) or b'{"message": {"content": " because "}}')
    assert reply == "because" and sent[0][0] == "http://h/api/chat" and b'"temperature": 0.2' in sent[0][1] and sent[0][2] == 120.0
    for bad in (b"{}", b"[]", b'{"message": {"content": " "}}'):
        with pytest.raises(ValueError, match="no reply"):
            http.chat([], "http://h", "m", send=lambda *_, bad=bad: bad)


def test_retries_pace_and_pauses():
    now, slept, answers = [0.0], [], [(503, {}, b""), (429, {"Retry-After": "7"}, b""), (200, {}, b"ok")]
    pace = http.Pace(0.5, lambda: now[0], lambda s: (slept.append(round(s, 2)), now.__setitem__(0, now[0] + s)))
    assert http.fetch("u", lambda *_: answers.pop(0), {}, pace, first=1.0) == (200, b"ok", None)
    assert 1.0 <= slept[0] <= 1.25 and 7.0 in slept
    calls = []

    def down(*_):
        calls.append(1)
        raise ConnectionError("down")

    assert http.fetch("u", down, {}, http.Pace(0, lambda: 0.0, lambda s: None), attempts=3) == (None, None, "ConnectionError: down") and len(calls) == 3
    assert http.pause(9, 5, 120, None) == 120 and http.pause(0, 5, 120, "3") == 3

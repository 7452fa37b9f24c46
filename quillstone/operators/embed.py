"""Vectors of texts by pluggable providers, incremental sync by content hash, and filtered retrieval.

A provider turns a list of texts into vectors, told whether they are documents or a query, which some embed differently; it is made once per worker process and called on batches of bounded size. Only texts whose state is missing, not ok
or of another hash are embedded. A failing batch gives rows with status ``error``; it never fails the job nor touches a vector that is in use.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import filings as X
from quillstone.operators import knn, merge
from quillstone.session import shared_folder
from quillstone.sources.versions import Versions

BATCH = 32
MAX_BATCH = 256
MESSAGE = 2_000
RESULTS = (1, 6, 20)
#: Words whose place a provider remembers; only speed depends on it.
WORDS = 1 << 18
_WORD = re.compile(r"\w+")


class Hashing:
    """Words counted into hashed, signed dimensions; a deterministic provider without weights. Counts stay whole, so that what is computed from them is exact;
    search does not heed length. Texts and questions are embedded alike."""

    def __init__(self, dimensions: int = 384):
        self.dimensions = dimensions
        self.known: dict[str, tuple[int, int]] = {}

    def place(self, word: str) -> tuple[int, int]:
        """Dimension and sign of a word: the first 32 bits of its MD5."""
        h = int.from_bytes(hashlib.md5(word.encode(), usedforsecurity=False).digest()[:4], "big")
        return (h >> 1) % self.dimensions, 1 if h & 1 else -1

    def embed(self, texts: Sequence[str], kind: str = "document") -> list[list[float]]:  # noqa: ARG002 - one space for both kinds
        if len(self.known) > WORDS:
            self.known.clear()
        rows, at, signs = [], [], []
        for i, text in enumerate(texts):
            for word in _WORD.findall(text.lower()):
                seen = self.known.get(word)
                if seen is None:
                    seen = self.known[word] = self.place(word)
                rows.append(i)
                at.append(seen[0])
                signs.append(seen[1])
        out = np.zeros((len(texts), self.dimensions), dtype=np.float32)
        np.add.at(out, (rows, at), signs)
        return out.tolist()


class Sentences:
    """A sentence encoder of a locally installed library, unit length; documents and queries alike."""

    def __init__(self, model_id: str):
        from sentence_transformers import SentenceTransformer

        self.model = SentenceTransformer(model_id)

    def embed(self, texts: Sequence[str], kind: str = "document") -> list[list[float]]:  # noqa: ARG002
        return [v.tolist() for v in self.model.encode(list(texts), normalize_embeddings=True)] if texts else []


class Remote:
    """A hosted encoder that is told which kind of text it gets. ``client`` has ``embed(texts, model=..., input_type=...)`` with ``embeddings`` in its answer."""

    def __init__(self, model_id: str, client: Callable[[], object]):
        self.model_id, self.client = model_id, client()

    def embed(self, texts: Sequence[str], kind: str = "document") -> list[list[float]]:
        return [list(v) for v in self.client.embed(list(texts), model=self.model_id, input_type=kind).embeddings] if texts else []


def _voyage() -> object:
    import os

    import voyageai

    key = os.environ.get("VOYAGE_API_KEY", "").strip()
    if not key:
        raise ValueError("VOYAGE_API_KEY is not set")
    return voyageai.Client(api_key=key)


@dataclass(frozen=True)
class Model:
    """A provider's factory under a model id."""

    model_id: str
    dimensions: int
    make: Callable[[], object]


#: Models that need a library or a key fail where these are missing, batch by batch, with rows that say so.
MODELS = {
    "all-MiniLM-L6-v2": Model("all-MiniLM-L6-v2", 384, lambda: Sentences("all-MiniLM-L6-v2")), "voyage-finance-2": Model("voyage-finance-2", 1024, lambda: Remote("voyage-finance-2", _voyage)),
    "hashing-384": Model("hashing-384", 384, lambda: Hashing(384)), "hashing-1024": Model("hashing-1024", 1024, lambda: Hashing(1024)),
}


def batch_size(asked: int | None) -> int:
    """The asked size within 1 and 256, 32 if none is asked."""
    return BATCH if asked is None else max(1, min(MAX_BATCH, asked))


def embed(chunks: DataFrame, model: Model, batch: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(chunk_id, content_hash, embedding, status, error_message) of chunks (chunk_id, content_hash, text), and the columns of ``keep``, which pass through so
    that nothing has to be joined back. Null texts are errors."""
    size, make, width, kept = batch_size(batch), model.make, model.dimensions, list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        provider = None
        for table in batches:
            for at in range(0, table.num_rows, size):
                part = table.slice(at, size)
                texts = part.column(2).to_pylist()
                there = [i for i, t in enumerate(texts) if t is not None]
                vectors: list[list[float] | None] = [None] * len(texts)
                error = None
                if there:
                    try:
                        provider = provider or make()
                        for i, v in zip(there, provider.embed([texts[i] for i in there], "document"), strict=True):
                            vectors[i] = v if len(v) == width else None
                    except Exception as e:  # noqa: BLE001 - a provider may raise anything; the rows say what
                        error = f"{type(e).__name__}: {e}"[:MESSAGE]
                status = ["ok" if v is not None else "error" for v in vectors]
                why = [None if v is not None else error or ("no text" if t is None else "wrong dimensions") for v, t in zip(vectors, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(vectors, pa.list_(pa.float32())), pa.array(status), pa.array(why, pa.string()), *part.columns[3:]], names=["chunk_id", "content_hash", "embedding", "status", "error_message", *kept])

    rows = chunks.select("chunk_id", "content_hash", "text", *kept)
    return rows.mapInArrow(run, "chunk_id string, content_hash string, embedding array<float>, status string, error_message string" + "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in kept))


def tried(chunks: DataFrame, state: DataFrame, model: Model, now: Column, batch: int | None = None) -> DataFrame:
    """(chunk_id, embedding, content_hash, status, error_message, embedded_at, updated_at) of the chunks that were pending. ``embedded_at`` is null where it did not go
    well. Written to the shared checkpoint folder, so that no text is embedded twice however often the rows are read."""
    shared_folder(chunks.sparkSession)
    at = now.cast("timestamp_ntz")
    done = embed(merge.pending(chunks, state, ["chunk_id"]).filter("pending"), model, batch)
    return done.withColumns({"embedded_at": F.when(F.col("status") == "ok", at), "updated_at": at}).checkpoint()


_STATE = ("chunk_id", "content_hash", "status", "error_message", "embedded_at", "updated_at")


def sync(chunks: DataFrame, state: DataFrame, vectors: DataFrame, model: Model, now: Column, batch: int | None = None) -> tuple[DataFrame, DataFrame]:
    """New state (chunk_id, content_hash, status, error_message, embedded_at, updated_at) and new vectors (chunk_id, embedding) after embedding what is pending."""
    done = tried(chunks, state, model, now, batch)
    new_state = merge.upsert(state.select(*_STATE), done.select(*_STATE), ["chunk_id"])
    new_vectors = merge.upsert(vectors.select("chunk_id", "embedding"), done.filter("status = 'ok'").select("chunk_id", "embedding"), ["chunk_id"])
    return new_state, new_vectors


STATE = "chunk_id string, content_hash string, status string, error_message string, embedded_at timestamp_ntz, updated_at timestamp_ntz"
VECTORS = "chunk_id string, embedding array<float>"


class VectorIndex:
    """State and vectors of one model as versioned tables on shared storage. A question reads the vectors that are there; only ``sync`` reads texts."""

    def __init__(self, spark: SparkSession, folder: str, model: Model, parts: int = merge.PARTS):
        self.spark, self.model, self.parts = spark, model, parts
        self.states, self.kept = Versions(spark, f"{folder}/state"), Versions(spark, f"{folder}/vectors")

    def _or_empty(self, table: Versions, schema: str) -> DataFrame:
        found = table.read()
        return self.spark.createDataFrame([], schema) if found is None else found

    def sync(self, chunks: DataFrame, now: Column, batch: int | None = None) -> DataFrame:
        """Embeds what is pending and publishes vectors before the state that tells of them; a job that dies in between embeds these again. Only the parts of
        both tables that changed are written. Returns the state."""
        done = tried(chunks, self._or_empty(self.states, STATE), self.model, now, batch)
        merge.merge_parts(self.kept, done.filter("status = 'ok'").select("chunk_id", "embedding"), ["chunk_id"], parts=self.parts)
        merge.merge_parts(self.states, done.select(*_STATE), ["chunk_id"], parts=self.parts)
        return self._or_empty(self.states, STATE)

    def vectors(self) -> DataFrame:
        return self._or_empty(self.kept, VECTORS)


def where(df: DataFrame, ticker: str | None = None, side: str | None = None, group: str | None = None) -> DataFrame:
    """Rows of a ticker (upper case), a side (P and A are acquired, S and D disposed, others no filter) and a group (high or low, others no filter)."""
    if ticker and ticker.strip():
        df = df.filter(F.col("issuer_ticker") == ticker.strip().upper())
    code = {"P": "A", "A": "A", "S": "D", "D": "D"}.get((side or "").strip().upper())
    if code:
        df = df.filter(F.col("acquired_disposed_code") == code)
    if (group or "").strip().lower() in ("high", "low"):
        df = df.filter(F.col("universe_group") == group.strip().lower())
    return df


def retrieve(vectors: DataFrame, question: str, model: Model, k: int | None = None, **filters: str | None) -> DataFrame:
    """The chunks nearest to a question, filtered first, with distance and the address of their filing."""
    low, usual, high = RESULTS
    query = model.make().embed([question], "query")[0]
    found = knn.nearest(where(vectors, **filters), "chunk_id", "embedding", query, usual if k is None else max(low, min(high, k)))
    return found.withColumn("url", X.filing_index_url("issuer_cik", "accession_number"))


#: Questions that retrieval is looked at with.
QUESTIONS = ("chief executive buys in the open market", "sale of shares by an insider", "amended filing", "director exercises options")


def evaluate(indexes: dict[str, tuple[DataFrame, Model]], questions: Sequence[str] = QUESTIONS, k: int = 3) -> DataFrame:
    """(model_id, question, rank, chunk_id, distance): the ``k`` nearest chunks to each question in each model's vectors. Questions and models are few."""
    out = []
    for name, (vectors, model) in indexes.items():
        for question in questions:
            found = knn.nearest(vectors.select("chunk_id", "embedding"), "chunk_id", "embedding", model.make().embed([question], "query")[0], k)
            place = F.row_number().over(Window.orderBy("distance", "chunk_id"))  # of k rows
            out.append(found.select(F.lit(name).alias("model_id"), F.lit(question).alias("question"), place.alias("rank"), "chunk_id", "distance"))
    return reduce(DataFrame.unionByName, out)


#: The reply where nothing was found, the line that names the filters, and the heading of an excerpt.
NOTHING = "I could not find matching Form 4 transactions for that question with the current filters. Try clearing the ticker filter or broadening the question."
FILTERS = "Filters: ticker={ticker}, side={side}, universe_group={group}"
HEADING = "[{i}] accession={accession_number} txn_index={transaction_index} ticker={issuer_ticker} code={transaction_code} A/D={acquired_disposed_code}"
SYSTEM = "You answer questions about insider filings from the excerpts given and from nothing else. Name the accession number of each fact in parentheses. Say so if the excerpts do not suffice. Keep filing dates and transaction dates apart. Give no advice on investing."


def prompt(rows: Sequence[Row], question: str, history: Sequence[tuple[str, str]], ticker: str | None = None, side: str | None = None, group: str | None = None, tail: int = 6, system: str = SYSTEM) -> list[dict[str, str]]:
    """Messages for a chat model: the system's, the last turns, and the question under the filters and the excerpts."""
    parts = []
    for i, r in enumerate(rows, 1):
        fields = r.asDict()
        parts.append(HEADING.format(i=i, **fields) + (f"\nURL: {fields['url']}" if fields["url"] else "") + f"\n{fields['text']}")
    named = FILTERS.format(ticker=ticker or "any", side=side or "any", group=group or "any")
    asked = f"{named}\n\nRetrieved excerpts:\n" + "\n\n".join(parts) + f"\n\nQuestion: {question}"
    turns = [{"role": role, "content": text} for role, text in list(history)[-tail:]]
    return [{"role": "system", "content": system}, *turns, {"role": "user", "content": asked}]


def answer(found: DataFrame, question: str, history: Sequence[tuple[str, str]], llm: Callable[[list[dict]], str], **filters: str | None) -> str:
    """Asks a chat model with the retrieved chunks, at most 20 rows, and the last turns; a fixed reply if nothing was found. ``filters`` are those of ``where``."""
    columns = ("accession_number", "transaction_index", "issuer_ticker", "transaction_code", "acquired_disposed_code", "url", "text")
    rows = found.select(*columns).limit(RESULTS[2]).collect()
    return llm(prompt(rows, question, history, **filters)) if rows else NOTHING

"""Nested filing payloads into related flat tables (structural-variant tables).

A bottom-up tree automaton gives each JSON node a state. A leaf's state is the shape of its value (number, date, code, flag, text, nothing). A node's state is
a transition from what its members' names say and from the states of its members; names are read by what they contain, whatever their spelling, and
transitions are kept once computed, so that like objects cost one look-up. So a transaction is known by what it is made of: a date, a code, amounts, a side.
A name above it (a table, a slot for transactions or holdings) decides only where that leaves a doubt. Walking runs on explicit stacks, and so does parsing
where the standard parser gives up, so nesting may be of any depth.

Each state is routed to its own typed subtype table: non-derivative and derivative transactions, non-derivative and derivative holdings, owners, notes. All
keep the supertype keys (``record_id``, ``accession_number``) and the link to their parent record by ``position``; ``transactions`` and ``holdings`` are the
supertype views over the columns that their subtypes share. The automaton runs inside one Arrow pass over the payloads and gives one row per record with an
array per subtype table; the flat tables are projections of these arrays, so no link needs a join or a shuffle.

Defined results
* null, empty, malformed payload, or one without any known shape: the record is in ``records`` with variant ``null``, ``malformed`` or ``unknown`` and has no
  child rows. ``header_only`` has header fields and no transaction or holding; ``tables`` holds some under the name of a table, ``rows`` holds them without;
  ``encoded_`` before it says that some came as JSON text within the JSON.
* a list that came as one object counts as a list of it; a list that came as JSON text is decoded (any depth).
* null entries, scalars and empty objects are no transactions and don't count for positions.
* a stated index is a whole number of up to 18 digits; anything else is none, and the position counts.
* repeated records give repeated rows; ``attached`` is a set.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- parsing of any depth ----------------------------------------------------------------------------------------------------------

_SPACE = re.compile(r"[ \t\n\r]*")
_ATOM = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|NaN|-?Infinity")
_WORD = {"true": True, "false": False, "null": None}


def parse(text: str) -> object:
    """The value of a JSON text; ``ValueError`` if it is none."""
    try:
        return json.loads(text)
    except RecursionError:
        return _parse_deep(text)


def _parse_deep(text: str) -> object:
    """The same on a stack of open lists and objects instead of calls."""
    at, open_, key = 0, [], None
    skip = lambda i: _SPACE.match(text, i).end()

    def name(i: int) -> tuple[str, int]:
        i = skip(i)
        if text[i : i + 1] != '"':
            raise ValueError(f"a name is missing at {i}")
        k, i = scanstring(text, i + 1, True)
        i = skip(i)
        if text[i : i + 1] != ":":
            raise ValueError(f"a colon is missing at {i}")
        return k, i + 1

    while True:
        at = skip(at)
        c = text[at : at + 1]
        if c in ("[", "{") and c:
            value: object = [] if c == "[" else {}
            at = skip(at + 1)
            if text[at : at + 1] == ("]" if c == "[" else "}"):
                at += 1
            else:
                open_.append((value, key))
                if c == "{":
                    key, at = name(at)
                continue
        elif c == '"':
            value, at = scanstring(text, at + 1, True)
        elif m := _ATOM.match(text, at):
            word, at = m[0], m.end()
            value = _WORD[word] if word in _WORD else float(word) if not word.lstrip("-").isdigit() else int(word)
        else:
            raise ValueError(f"no value at {at}")
        while open_:  # the value goes into what is open, which it may close
            holder, outer = open_[-1]
            if isinstance(holder, list):
                holder.append(value)
            else:
                holder[key] = value
            at = skip(at)
            end = text[at : at + 1]
            if end == ",":
                at += 1
                if isinstance(holder, dict):
                    key, at = name(at)
                break
            if end != ("]" if isinstance(holder, list) else "}"):
                raise ValueError(f"a list or object is not closed at {at}")
            at += 1
            open_.pop()
            value, key = holder, outer
        else:
            if skip(at) != len(text):
                raise ValueError(f"more than one value at {at}")
            return value


# --- the automaton -----------------------------------------------------------------------------------------------------------------

#: States. Leaves, and objects that only wrap a leaf, are told by the shape of the value.
NIL, FLAG, NUMBER, DATE, CODE, TEXT, REF, NOTE, CODING, AMOUNTS, HOLDING, TRANSACTION, OWNER, TABLE, OTHER = (
    "nil", "flag", "number", "date", "code", "text", "ref", "note", "coding", "amounts", "holding", "transaction", "owner", "table", "other",
)
LEAVES = frozenset({NIL, FLAG, NUMBER, DATE, CODE, TEXT})

_DATE = re.compile(r"\d{4}-\d{2}-\d{2}(?:[T ].*)?|\d{8}", re.DOTALL)
_NUMBER = re.compile(r"[+-]?[\d,]*\.?\d+(?:[eE][+-]?\d+)?")

#: What a member's name can say about the object that has it.
SAYS_DATE, SAYS_CODE, SAYS_AMOUNT, SAYS_SIDE, SAYS_TRANSACTION, SAYS_TITLE, SAYS_OWNER, SAYS_HEADER, SAYS_FOOTNOTE, SAYS_VALUE, SAYS_ID, SAYS_TEXT, SAYS_OWNED = (1 << i for i in range(13))


@lru_cache(maxsize=1 << 14)
def letters(name: str) -> str:
    """A name without case, underscores and other marks."""
    return "".join(c for c in name.lower() if c.isalnum())


@lru_cache(maxsize=1 << 14)
def says(name: str) -> int:
    """What a member's name says, by what it contains."""
    k = letters(name)
    if "footnote" in k:
        return SAYS_FOOTNOTE
    bits = {"value": SAYS_VALUE, "id": SAYS_ID, "text": SAYS_TEXT}.get(k, 0)
    if "owner" in k and "ownership" not in k:
        bits |= SAYS_OWNER
    if k.startswith("issuer") or k in ("documenttype", "periodofreport", "formtype"):
        bits |= SAYS_HEADER
    if "title" in k and ("security" in k or k == "title") and "underlying" not in k:
        bits |= SAYS_TITLE
    if any(x in k for x in ("owned", "following", "posttransaction", "holding")):
        return bits | SAYS_OWNED
    if bits & SAYS_HEADER or any(x in k for x in ("underlying", "exercis", "conver", "expir", "signature", "deemed", "period")):
        return bits
    if "date" in k and "update" not in k:
        bits |= SAYS_DATE | (SAYS_TRANSACTION if "transaction" in k else 0)
    if "code" in k or "coding" in k:
        bits |= SAYS_CODE
    if any(x in k for x in ("shares", "price", "amount", "quantity")):
        bits |= SAYS_AMOUNT
    if "acquired" in k or "disposed" in k:
        bits = (bits | SAYS_SIDE) & ~SAYS_CODE
    if k in ("transactioncategory", "transactionindex", "transactiontype"):
        bits |= SAYS_TRANSACTION
    return bits


@lru_cache(maxsize=1 << 14)
def table_of(name: str) -> str | None:
    """The category that a name gives to what lies below it."""
    k = letters(name)
    return "non_derivative" if "nonderivative" in k else "derivative" if "derivative" in k else None


@lru_cache(maxsize=1 << 14)
def slot_of(name: str) -> str | None:
    """What a name says its members are."""
    k = letters(name).rstrip("s")
    return TRANSACTION if k.endswith("transaction") else HOLDING if k.endswith("holding") else OWNER if k.endswith("owner") else None


@lru_cache(maxsize=1 << 16)
def transition(names: tuple[str, ...], states: tuple[str, ...]) -> str:
    """The state of an object from its members' names and states."""
    said = 0
    for name, state in zip(names, states, strict=True):
        said |= says(name)
        if state in (AMOUNTS, CODING) and not says(name) & SAYS_OWNED:
            said |= SAYS_AMOUNT if state == AMOUNTS else SAYS_CODE
    members = set(states)
    if TRANSACTION in members or TABLE in members:
        return TABLE  # it holds transactions and is none, whatever else it says
    if said & SAYS_ID and said & SAYS_TEXT:
        return NOTE
    if said & SAYS_VALUE:
        for name, state in zip(names, states, strict=True):
            if says(name) & SAYS_VALUE and state in LEAVES:
                return state
    if said & SAYS_ID and not said & ~(SAYS_ID | SAYS_FOOTNOTE) and members <= LEAVES and len(names) <= 3:
        return REF
    event = bool(said & SAYS_DATE) + bool(said & SAYS_CODE)
    amount = bool(said & (SAYS_AMOUNT | SAYS_SIDE))
    if said & SAYS_TRANSACTION or event + amount >= 2 or (event and AMOUNTS in members):
        return TRANSACTION
    # foreign names: a date, a code and numbers side by side
    if not said & (SAYS_HEADER | SAYS_OWNER) and {DATE, CODE, NUMBER} <= members:
        return TRANSACTION
    if said & SAYS_TITLE or (said & SAYS_OWNED and not said & SAYS_OWNER and amount):
        return HOLDING
    if said & SAYS_OWNER and not said & SAYS_HEADER and members <= LEAVES | {OTHER, OWNER, TEXT}:
        return OWNER
    if amount:
        return AMOUNTS
    return CODING if said & SAYS_CODE else OTHER


#: Objects of up to so many members have their transitions kept.
KEPT_NAMES = 64


class Node:
    """A JSON value with its state; ``refs`` holds the footnote ids of the node and all below it, in document order. Lists of refs are shared, never changed."""

    __slots__ = ("state", "value", "parts", "refs", "encoded")

    def __init__(self, state: str, value: object = None, parts: dict[str, Node] | list[Node] | None = None, refs: list[str] | tuple = (), encoded: bool = False):
        self.state, self.value, self.parts, self.refs, self.encoded = state, value, parts, refs, encoded


_NIL = Node(NIL)


def ref_ids(value: object) -> list[str]:
    """Ids of a footnote reference: text (commas or blanks between several), an object with an id, or lists of these, nested or not; in document order."""
    out: list[str] = []
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, str):
            out += [x for x in re.split(r"[\s,;]+", v) if x]
        elif isinstance(v, dict):
            held = [x for k, x in v.items() if letters(k) == "id" or "footnote" in letters(k)]
            stack += reversed(held)
        elif isinstance(v, list):
            stack += reversed(v)
        elif isinstance(v, int) and not isinstance(v, bool):
            out.append(str(v))
    return out


def _shape(value: str) -> Node:
    """The node of a text by its shape."""
    c = value[:1]
    if c.isdigit() or c in "+-.":
        state = DATE if _DATE.fullmatch(value) else NUMBER if _NUMBER.fullmatch(value) else TEXT
    else:
        state = CODE if len(value) <= 2 and value.isalpha() and value.isupper() else TEXT if value.strip() else NIL
    return Node(state, value)


_short = lru_cache(maxsize=1 << 14)(_shape)  # nodes are never changed, so like texts may share one


def _leaf(value: object) -> Node | None:
    """The node of a scalar; null for a list, an object or text that may be JSON."""
    if value is None:
        return _NIL
    kind = type(value)
    if kind is str:
        if value[:1] in ("[", "{") and value.rstrip()[-1:] in ("]", "}"):
            return None
        return _short(value) if len(value) < 24 else _shape(value)
    if kind is bool:
        return Node(FLAG, value)
    return Node(NUMBER, value) if kind is int or kind is float else None


def _wrapped(value: object) -> Node | None:
    """The node of an object that holds nothing but a scalar value: by far the most frequent one, told without a frame of its own."""
    if type(value) is dict and len(value) == 1:
        for name, held in value.items():
            if says(name) & SAYS_VALUE and (leaf := _leaf(held)) is not None:
                return Node(leaf.state, value, {name: leaf})
    return None


@lru_cache(maxsize=1 << 14)
def _id_name(names: tuple[str, ...]) -> str | None:
    return next((k for k in names if letters(k) == "id"), None)


class _Open:
    """A list or object whose members are being classified."""

    __slots__ = ("value", "rest", "parts", "refs", "key", "encoded")

    def __init__(self, value: list | dict, encoded: bool):
        self.value, self.refs, self.key, self.encoded = value, (), None, encoded
        if type(value) is dict:
            self.rest, self.parts = iter(value.items()), {}
        else:
            self.rest, self.parts = iter(value), []

    def add(self, key: str | None, node: Node) -> None:
        if node.refs:
            self.refs = [*self.refs, *node.refs] if self.refs else node.refs
        if key is None:
            self.parts.append(node)
        else:
            self.parts[key] = node

    def close(self) -> Node:
        parts = self.parts
        if type(parts) is list:
            states = {c.state for c in parts}
            state = TABLE if TRANSACTION in states or TABLE in states else OWNER if states == {OWNER} else OTHER
            return Node(state, self.value, parts, self.refs, self.encoded)
        names, states = tuple(parts), tuple([c.state for c in parts.values()])
        # objects with very many members are records of records: no other has the same names, and keeping them would fill the memory
        state = transition(names, states) if len(names) <= KEPT_NAMES else transition.__wrapped__(names, states)
        refs = self.refs
        if state == REF:
            refs = ref_ids(self.value)
        elif state in _MAY_HAVE_ID and (own := _id_name(names) if len(names) <= KEPT_NAMES else _id_name.__wrapped__(names)) is not None:
            # of a note its id; of a wrapped value the id of its footnote beside it
            refs = ref_ids({"id": self.value[own]}) if state == NOTE else [*refs, *ref_ids(self.value[own])]
        return Node(state, self.value, parts, refs, self.encoded)


_MAY_HAVE_ID = LEAVES | {NOTE}


def classify(value: object) -> Node:
    """One transition per node, members first, on a stack of open lists and objects."""
    root = _leaf(value)
    if root is not None:
        return root
    frames: list[_Open] = []
    child, key = value, None
    while True:
        # open a list, an object or a text that holds one
        inner, encoded = child, type(child) is str
        if encoded:
            try:
                inner = parse(child)
            except ValueError:
                inner = None
        if type(inner) in (list, dict):
            if frames:
                frames[-1].key = key
                encoded = encoded or frames[-1].encoded
            frames.append(_Open(inner, encoded))
        elif frames:
            frames[-1].add(key, Node(TEXT, child))
        else:
            return Node(TEXT, child)
        # go on with the innermost one until a member has to be opened; close what has no member left
        while True:
            frame = frames[-1]
            parts = frame.parts
            opened = False
            if type(parts) is dict:
                for key, child in frame.rest:
                    if says(key) & SAYS_FOOTNOTE and not _has_text(child):
                        node = Node(REF, child, None, ref_ids(child))
                    else:
                        node = _leaf(child) or _wrapped(child)
                        if node is None:
                            opened = True
                            break
                    if node.refs:
                        frame.refs = [*frame.refs, *node.refs] if frame.refs else node.refs
                    parts[key] = node
            else:
                key = None
                for child in frame.rest:
                    node = _leaf(child)
                    if node is None:
                        opened = True
                        break
                    parts.append(node)
            if opened:
                break
            done = frame.close()
            frames.pop()
            if not frames:
                return done
            frames[-1].add(frames[-1].key, done)


def _has_text(value: object) -> bool:
    """Whether a value under a footnote's name is a list of footnote texts and not of references."""
    first = value[0] if isinstance(value, list) and value else value
    if not isinstance(first, dict):
        return False
    if any(letters(k) == "text" for k in first):
        return True
    return any(isinstance(v, (dict, list)) and _has_text(v) for v in first.values()) if len(first) == 1 else False


# --- routing -----------------------------------------------------------------------------------------------------------------------


def walk(root: Node) -> Iterator[tuple[str, Node, str | None, bool]]:
    """Routed nodes in document order: (state, node, category of the nearest table above, encoded). Names decide where states leave a doubt."""
    stack: list[tuple[Node, str | None, str | None]] = [(root, None, None)]
    while stack:
        node, category, slot = stack.pop()
        parts = node.parts
        if isinstance(parts, list):
            stack += [(c, category, slot) for c in reversed(parts) if c.parts]
            continue
        if not parts:
            continue
        state = node.state
        routed = None
        if state == NOTE:
            routed = NOTE
        elif slot == HOLDING and state != TABLE:
            routed = HOLDING
        elif slot == OWNER and state != TABLE:
            routed = OWNER
        elif state in (TRANSACTION, HOLDING, OWNER):
            # a bare row right under a table or a slot for transactions is one, unless it says what is owned
            bare = state == HOLDING and slot == TRANSACTION and not any(says(k) & SAYS_OWNED for k in parts)
            routed = TRANSACTION if bare else state
        elif slot == TRANSACTION and state != TABLE and not any(c.parts and slot_of(k) for k, c in parts.items()) and (state != OTHER or any(c.state in LEAVES and c.state != NIL for c in parts.values())):
            routed = TRANSACTION
        if routed is not None:
            yield routed, node, category, node.encoded
            continue
        for key, child in reversed(parts.items()):
            if child.parts:
                named, table = slot_of(key), table_of(key)
                # a table's own name is the slot of rows that lie right under it
                stack.append((child, table or category, named or (TRANSACTION if table else slot if letters(key).isdigit() else None)))


def _text(node: Node | None) -> str | None:
    """Text of a scalar or of an object's value."""
    while node is not None and isinstance(node.parts, dict):
        node = next((c for k, c in node.parts.items() if letters(k) == "value"), None)
    if node is None or node.state == NIL or node.parts is not None:
        return None
    if isinstance(node.value, bool):
        return "true" if node.value else "false"
    return str(node.value) if isinstance(node.value, (str, int, float)) else None


def _fields(node: Node) -> dict[str, Node]:
    """Scalars of a node and of the objects in it by their name, the first of each name; those of an underlying security are named so."""
    out: dict[str, Node] = {}
    stack: list[tuple[str, Node, str]] = [(k, c, "") for k, c in reversed(node.parts.items())]
    while stack:
        key, child, prefix = stack.pop()
        state = child.state
        if state == REF:
            continue
        name, kind = letters(key), type(child.parts)
        if kind is dict and state not in LEAVES:
            inner = "underlying" if "underlying" in name else prefix
            stack += [(k, c, inner) for k, c in reversed(child.parts.items())]
        elif kind is not list:
            if prefix and not name.startswith(prefix):
                name = prefix + name
            if name not in out:
                out[name] = child
    return out


def _pick(fields: dict[str, Node], *names: str) -> str | None:
    for name in names:
        if name in fields and (text := _text(fields[name])) is not None:
            return text
    return None


@lru_cache(maxsize=1 << 12)
def _category(text: str | None) -> str | None:
    k = letters(text or "")
    return "non_derivative" if k.startswith("nonderivative") else "derivative" if k.startswith("derivative") else None


#: Columns of the typed subtype tables and the names that they may have; what both subtypes have comes first.
SECURITY = {
    "security_title": ("securitytitle", "title"), "direct_indirect": ("directindirect", "directorindirectownership"), "ownership_nature": ("natureofownership", "nature"),
    "shares_after": ("sharesownedfollowingtransaction", "sharesafter", "sharesowned"),
}
EVENT = {
    "transaction_date": ("transactiondate", "date"), "transaction_code": ("transactioncode", "code"), "shares": ("shares", "transactionshares", "quantity"), "price_per_share": ("pricepershare", "transactionpricepershare", "price"),
    "acquired_disposed_code": ("acquireddisposed", "transactionacquireddisposedcode", "acquireddisposedcode"),
}
RIGHT = {
    "exercise_price": ("conversionorexerciseprice", "exerciseprice", "conversionprice"), "exercise_date": ("exercisedate", "dateexercisable"), "expiration_date": ("expirationdate",),
    "underlying_title": ("underlyingsecuritytitle", "underlyingtitle"), "underlying_shares": ("underlyingsecurityshares", "underlyingshares"),
}
PERSON = {"owner_cik": ("rptownercik", "ownercik", "cik"), "owner_name": ("rptownername", "ownername", "name"), "is_director": ("isdirector",), "is_officer": ("isofficer",), "is_ten_percent_owner": ("istenpercentowner",), "officer_title": ("officertitle",)}
NOTED = {"footnote_id": ("id", "footnoteid"), "text": ("text",)}
#: The subtype tables.
TABLES = {
    "non_derivative": SECURITY | EVENT, "derivative": SECURITY | EVENT | RIGHT, "non_derivative_holdings": SECURITY, "derivative_holdings": SECURITY | RIGHT, "owners": PERSON, "notes": NOTED,
}
_NUMBERS = ("shares", "price_per_share", "shares_after", "exercise_price", "underlying_shares")
_DATES = ("transaction_date", "exercise_date", "expiration_date")
_HEADER = ("record_id", "accession_number", "variant", "document_type", "issuer_cik")


def _columns(table: str) -> dict[str, str]:
    out = {"position": "int"} | ({"transaction_index": "bigint"} if table in ("non_derivative", "derivative") else {}) | dict.fromkeys(TABLES[table], "string")
    return out | ({} if table in ("owners", "notes") else {"footnote_ids": "array<string>"})


_ARROW_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
#: What links need of the transaction tables, and nothing else.
LINKS = {"non_derivative": ("transaction_index", "footnote_ids"), "derivative": ("transaction_index", "footnote_ids")}


def _schemas(only: dict[str, tuple[str, ...]] | None) -> tuple[str, pa.Schema]:
    kept = {t: {c: k for c, k in _columns(t).items() if only is None or c in only[t]} for t in TABLES if only is None or t in only}
    ddl = "record_id bigint, accession_number string, variant string, document_type string, issuer_cik string, " + ", ".join(f"{t} array<struct<{', '.join(f'{c}:{k}' for c, k in cs.items())}>>" for t, cs in kept.items())
    return ddl, pa.schema([("record_id", pa.int64()), *[(c, pa.string()) for c in _HEADER[1:]], *[(t, pa.list_(pa.struct([(c, _ARROW_TYPES[k]) for c, k in cs.items()]))) for t, cs in kept.items()]])


def _is_right(node: Node, fields: dict[str, Node]) -> bool:
    """Whether a security is a right to another one, by what it tells of that or of its own terms."""
    return any(k.startswith(("underlying", "conversion", "exercise", "expiration")) for k in fields) or any("underlying" in letters(k) for k in node.parts)


def _row(node: Node, wanted: dict[str, tuple[str, ...]], position: int, fields: dict[str, Node]) -> dict:
    row = {c: _pick(fields, *names) for c, names in wanted.items()}
    row["position"] = position
    row["footnote_ids"] = list(dict.fromkeys(node.refs)) if node.refs else []
    return row


def flatten(payload: str | None, tables: dict[str, dict[str, tuple[str, ...]]] = TABLES) -> dict:
    """The typed, nested row of one payload: header fields and an array of rows per subtype table; ``tables`` says which of their columns are wanted."""
    empty = {"document_type": None, "issuer_cik": None} | {t: [] for t in TABLES}
    if payload is None or not payload.strip():
        return empty | {"variant": "null"}
    try:
        root = classify(parse(payload))
    except ValueError:
        return empty | {"variant": "malformed"}
    out = empty
    found: dict[str, list[tuple[Node, dict]]] = {"non_derivative": [], "derivative": []}
    placed = encoded = False
    for state, node, category, inside in walk(root):
        fields = _fields(node)
        if state in (TRANSACTION, HOLDING):
            own = _category(_pick(fields, "transactioncategory", "category"))
            kind = own or category or ("derivative" if _is_right(node, fields) else "non_derivative")
            placed, encoded = placed or category is not None, encoded or inside
            if state == TRANSACTION:
                found[kind].append((node, fields))
            else:
                rows = out[f"{kind}_holdings"]
                rows.append(_row(node, tables[f"{kind}_holdings"], len(rows), fields))
        else:
            name = "owners" if state == OWNER else "notes"
            out[name].append(_row(node, tables[name], len(out[name]), fields))
    position = 0
    for kind in ("non_derivative", "derivative"):
        for node, fields in found[kind]:
            row = _row(node, tables[kind], position, fields)
            stated = _pick(fields, "transactionindex", "index")
            row["transaction_index"] = int(float(stated)) if stated is not None and re.fullmatch(r"\s*\d{1,15}\.0+\s*", stated) else int(stated) if stated is not None and re.fullmatch(r"\s*\d{1,18}\s*", stated) else position
            out[kind].append(row)
            position += 1
    header = _header(root)
    if header is not None:
        out["document_type"] = _text(next((c for k, c in header.parts.items() if letters(k) in ("documenttype", "formtype")), None))
        issuer = next((c for k, c in header.parts.items() if letters(k) == "issuer" and isinstance(c.parts, dict)), header)
        out["issuer_cik"] = _text(next((c for k, c in issuer.parts.items() if letters(k) in ("issuercik", "cik")), None))
    holds = position > 0 or out["non_derivative_holdings"] or out["derivative_holdings"]
    out["variant"] = ("encoded_" if encoded else "") + ("tables" if placed else "rows") if holds else "header_only" if header is not None else "unknown"
    return out


def _header(root: Node) -> Node | None:
    """The outermost object, first by level, that has header fields."""
    level = [root]
    while level:
        below = []
        for node in level:
            if isinstance(node.parts, dict):
                if any(says(k) & SAYS_HEADER for k in node.parts):
                    return node
                below += [c for c in node.parts.values() if c.parts]
            elif isinstance(node.parts, list):
                below += [c for c in node.parts if c.parts]
        level = below
    return None


def _pass(wanted: dict[str, dict[str, tuple[str, ...]]], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                gc.disable()  # trees have no cycles; searching them for some costs a fifth of the time
                try:
                    rows = [flatten(p, wanted) for p in part.column(2).to_pylist()]
                finally:
                    gc.enable()
                columns = [part.column(0).cast(pa.int64()), part.column(1).cast(pa.string())]
                columns += [pa.array([r[f.name] for r in rows], type=f.type) for f in list(schema)[2:]]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


# --- the tables --------------------------------------------------------------------------------------------------------------------


def records(df: DataFrame, record_id: str = "record_id", accession: str = "accession_number", payload: str = "payload", only: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per record with an array per subtype table. Extra columns are not read. ``only`` names the subtype tables and their columns that are wanted; the
    optimizer can't see into the pass, so what is not wanted is left out here."""
    ddl, schema = _schemas(only)
    wanted = {t: {c: names for c, names in columns.items() if only is None or c in only.get(t, ())} for t, columns in TABLES.items()}
    rows = df.select(F.col(record_id).cast("bigint").alias("record_id"), F.col(accession).cast("string").alias("accession_number"), F.col(payload).cast("string").alias("payload"))
    return rows.mapInArrow(_pass(wanted, schema), ddl)


def subtype(nested: DataFrame, table: str) -> DataFrame:
    """A subtype table, typed, tied to its record by (record_id, position)."""
    rows = nested.select("record_id", "accession_number", F.inline(table))
    plain = lambda c: F.regexp_replace(F.btrim(F.col(c)), ",", "")
    typed = {c: plain(c).try_cast("decimal(28,8)") for c in TABLES[table] if c in _NUMBERS} | {c: F.try_to_date(F.substring(c, 1, 10)) for c in TABLES[table] if c in _DATES}
    return rows.withColumns(typed) if typed else rows


def transactions(nested: DataFrame, category: str | None = None) -> DataFrame:
    """The supertype: what both kinds of transactions share, with their category; ``category`` gives one subtype with all its columns."""
    if category is not None:
        return subtype(nested, category).withColumn("transaction_category", F.lit(category))
    shared = [c for c in _columns("non_derivative") if c in _columns("derivative")]
    one, two = (subtype(nested, t).select("record_id", "accession_number", F.lit(t).alias("transaction_category"), *shared) for t in ("non_derivative", "derivative"))
    return one.unionByName(two)


def holdings(nested: DataFrame) -> DataFrame:
    """The supertype of both kinds of holdings."""
    shared = [c for c in _columns("non_derivative_holdings") if c in _columns("derivative_holdings")]
    one, two = (subtype(nested, f"{t}_holdings").select("record_id", "accession_number", F.lit(t).alias("category"), *shared) for t in ("non_derivative", "derivative"))
    return one.unionByName(two)


def footnote_refs(nested: DataFrame) -> DataFrame:
    """Footnote ids tied to their transaction; a transaction without any has none here."""
    return transactions(nested).select("record_id", "position", "transaction_index", "transaction_category", F.explode("footnote_ids").alias("footnote_id"))


def write_tables(df: DataFrame, folder: str) -> dict[str, DataFrame]:
    """The record table and all subtype tables under ``folder``, payloads parsed once: what the pass gives is kept there, and each table is cut from it."""
    session = df.sparkSession
    records(df).write.mode("overwrite").parquet(f"{folder}/nested")
    nested = session.read.parquet(f"{folder}/nested")
    made = {"records": nested.select(*_HEADER)} | {t: subtype(nested, t) for t in TABLES}
    for name, rows in made.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
    return {name: session.read.parquet(f"{folder}/{name}") for name in made}


def attached(nested: DataFrame) -> DataFrame:
    """A set of (record, transaction, category, footnote id), with ``''`` for a transaction without footnotes: the union of the two transaction subtype tables,
    taken row by row, so that both come from one pass over the payloads."""

    def side(table: str) -> Column:
        ids = lambda t: F.when(F.size(t["footnote_ids"]) > 0, t["footnote_ids"]).otherwise(F.array(F.lit("")))
        return F.transform(table, lambda t: F.struct(t["transaction_index"].alias("transaction_index"), F.lit(table).alias("transaction_category"), ids(t).alias("ids")))

    rows = nested.select("record_id", F.inline(F.concat(side("non_derivative"), side("derivative"))))
    return rows.select("record_id", F.col("transaction_index").try_cast("int").alias("transaction_index"), "transaction_category", F.explode("ids").alias("footnote_id")).distinct()

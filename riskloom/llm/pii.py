"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, ``://`` and identifier cues. From each
anchor a local parser expands to the boundaries of an email address, network address, card, phone number,
address with credentials or account number, and validates it. Nothing else in the text is looked at.

The four base kinds are defined by patterns, leftmost and non-overlapping within a kind, failing matches
dropped without a retry. The further kinds need a cue or a scheme and pass a check of their own:
``url`` (scheme, user, password and host), ``iban`` (mod-97), ``account`` (a cue and 6 to 17 digits).

Defined cases: a null text is empty and has no spans; repeated rows each have a result; an empty table
gives no rows. Positions are code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.frames import free_name, slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account")

#: Words before an account number, in the languages of the corpus; matched as written, capitalised and in capitals.
IBAN_CUES = ("iban",)
ACCOUNT_CUES = ("account", "acct", "konto", "kontonummer", "compte", "cuenta")

Span = tuple[str, int, int]
SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE_RUN = re.compile(r"[\x20().0-9-]*")
_DIGITS = re.compile(r"[0-9]+")
_SCHEME_LEFT = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
_AUTHORITY = re.compile(r"[^\s/?#\"'<>@:]+:[^\s/?#\"'<>@]+@[A-Za-z0-9.-]*[A-Za-z0-9](?::[0-9]+)?")
_IBAN = re.compile(r"[\x20]?(?:[Nn][RrOo]\.?)?[\x20]?[:=]?[\x20]?([A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30})")
_ACCOUNT = re.compile(r"[\x20]?(?:[Nn](?:umber|UMBER|[RrOo]\.?)|#)?[\x20]?[:=#]?[\x20]?([0-9](?:[\x20-]?[0-9])*)")


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", "@")
    found.add_word("+", "+")
    found.add_word("://", ":")
    for d in "0123456789":
        found.add_word(d, "d")
    for kind, cues in (("i", IBAN_CUES), ("a", ACCOUNT_CUES)):
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.upper()}:
                found.add_word(form, kind)
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str, ats: list[int]) -> Iterator[Span]:
    free = 0
    for at in ats:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            free = m.end()
            yield "email", start, free


def _chains(text: str, runs: list[tuple[int, int]], joints: str) -> Iterator[list[tuple[int, int]]]:
    """Digit runs that only one of the given characters each holds apart."""
    chain: list[tuple[int, int]] = []
    for run in runs:
        if chain and (run[0] != chain[-1][1] + 1 or text[run[0] - 1] not in joints):
            yield chain
            chain = []
        chain.append(run)
    if chain:
        yield chain


def _ips(text: str, runs: list[tuple[int, int]]) -> Iterator[Span]:
    for chain in _chains(text, runs, "."):
        for k in range(0, len(chain) - 3, 4):
            parts = [text[a:b].lstrip("0") for a, b in chain[k : k + 4]]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                yield "ip", chain[k][0], chain[k + 3][1]


def _cards(text: str, runs: list[tuple[int, int]]) -> Iterator[Span]:
    for chain in _chains(text, runs, " -"):
        if 16 <= sum(b - a for a, b in chain) <= 19 and _luhn("".join(text[a:b] for a, b in chain)):
            yield "card", chain[0][0], chain[-1][1]


def _phones(text: str, pluses: list[int]) -> Iterator[Span]:
    for at in pluses:
        if not ("0" <= text[at + 1 : at + 2] <= "9"):
            continue
        end = _PHONE_RUN.match(text, at + 2).end()
        while end > at + 3 and not ("0" <= text[end - 1] <= "9"):
            end -= 1
        if end > at + 3 and 8 <= sum("0" <= c <= "9" for c in text[at:end]) <= 15:
            yield "phone", at, end


def _urls(text: str, schemes: list[int]) -> Iterator[Span]:
    free = 0
    for at in schemes:
        left = _SCHEME_LEFT.search(text, max(free, at - 20), at)
        if left and (m := _AUTHORITY.match(text, at + 3)):
            free = m.end()
            yield "url", left.start(), free


def _ibans(text: str, cues: list[int]) -> Iterator[Span]:
    for end in cues:
        m = _IBAN.match(text, end)
        # What follows the number may look like more of it: the longest valid beginning counts.
        for stop in range(m.end(1) if m else 0, m.start(1) + 14 if m else 0, -1):
            plain = text[m.start(1) : stop].replace(" ", "")
            if text[stop - 1] != " " and not text[stop : stop + 1].isalnum() and len(plain) >= 15:
                if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                    yield "iban", m.start(1), stop
                    break


def _accounts(text: str, cues: list[int]) -> Iterator[Span]:
    for end in cues:
        m = _ACCOUNT.match(text, end)
        if m and 6 <= sum("0" <= c <= "9" for c in m[1]) <= 17:
            yield "account", m.start(1), m.end(1)


def find(text: str) -> list[Span]:
    """All spans of a text, by kind as listed in ``KINDS``, then start."""
    at: dict[str, list[int]] = {"@": [], "+": [], ":": [], "i": [], "a": []}
    runs: list[tuple[int, int]] = []
    upto = -1
    for end, kind in _anchors().iter(text):
        if kind == "d":
            if end >= upto:
                upto = _DIGITS.match(text, end).end()
                runs.append((end, upto))
        elif kind == ":":
            at[":"].append(end - 2)
        else:
            at[kind].append(end + (kind in "ia"))
    spans = [*_emails(text, at["@"]), *_ips(text, runs), *_cards(text, runs), *_phones(text, at["+"])]
    for kind, parse in ((":", _urls), ("i", _ibans), ("a", _accounts)):
        if at[kind]:
            spans += sorted(set(parse(text, at[kind])))
    return spans


def masked(text: str, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by the kind of its first one."""
    out, upto = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= upto:
            out += [text[upto:start], f"[{kind.upper()}]"]
        upto = max(upto, end)
    return "".join([*out, text[upto:]])


def detect(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) of every row; spans in the order of ``find``."""
    rows = df.select(key, text)
    schema = T.StructType([rows.schema[0], T.StructField("spans", T._parse_datatype_string(SPAN_TYPE))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(x)] if x else [] for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], names=[key, "spans"])

    return rows.mapInArrow(run, schema)


def redact(df: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """The same rows and columns with personal data masked; ``length`` names a column of text lengths to keep right."""
    changed = free_name(df, "changed")
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(changed, T.BooleanType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            old = part.column(at).to_pylist()
            new = [masked(x, s) if x and (s := find(x)) else x for x in old]
            columns = [pa.array(new, part.column(at).type) if k == at else c for k, c in enumerate(part.columns)]
            moved = pa.array([a is not b for a, b in zip(old, new, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*columns, moved], names=[*part.schema.names, changed])

    rows = df.mapInArrow(run, schema)
    if length:
        rows = rows.withColumn(length, F.when(F.col(changed), F.length(text)).otherwise(F.col(length)).cast(df.schema[length].dataType))
    return rows.drop(changed)


def _written(spans: Column) -> Column:
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def digests(detected: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts by base kind, the digest of the base spans and all spans written out."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return detected.select(key, *(count(k) for k in BASE_KINDS), F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))

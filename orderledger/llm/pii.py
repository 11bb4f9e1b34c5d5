"""Personal data: expressions propose spans, checksums confirm them, context moves the score.

Base kinds (email, ip, card, phone) follow fixed rules and always stay. The method adds kinds
that no expression alone can tell from other numbers: an IBAN is confirmed by mod-97, and a
shorter card number (by Luhn), a social security number and a national phone number only
count with a context word near them. A secret is a run of letters and digits that looks drawn at
random, by its entropy, and that a context word (`token`, `password`) or the form of a well-known
kind of key speaks for; a shorter value counts where it is assigned to such a word.

Every search is linear in the text: an email is looked for from its `@`, an address and a
number from the first digit of a run, a phone number from its plus sign.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderledger.llm.common import text_groups

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["iban", "short_card", "ssn", "local_phone", "secret"]

# What the base kinds look like.
LOCAL_CHARS = frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
)
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What the added kinds look like.
IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])")

SECRET = re.compile(r"(?<![A-Za-z0-9_+/.-])[A-Za-z0-9_+/.-]{16,512}(?![A-Za-z0-9_+/.-])")
ASSIGNED = re.compile(
    r"(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?"
    r"([^\s\"',;]{6,512})",
    re.IGNORECASE,
)
#: How well-known kinds of keys begin, and their lengths.
KNOWN_KEY = re.compile(
    r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opsu]_[A-Za-z0-9]{36}|AIza[A-Za-z0-9_-]{35}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_.-]+"
)
#: Bits a character below which a run does not look drawn at random.
LEAST_ENTROPY = 2.5

# Context: words that speak for a kind, and words that speak against any of them.
FOR = {
    "email": r"mail|contact|write|reach",
    "ip": r"\bip\b|address|host|server|client",
    "card": r"card|visa|master|credit|debit|payment",
    "phone": r"phone|\btel|call|mobile|cell|fax|dial",
    "iban": r"iban|account|bank|transfer",
    "short_card": r"card|visa|amex|express|credit|debit|payment",
    "ssn": r"\bssn\b|social security",
    "local_phone": r"phone|\btel\b|\bcall\b|mobile|\bcell\b|\bfax\b",
    "secret": r"password|passwd|\bpwd\b|secret|token|api[ _-]?key|access[ _-]?key|credential|bearer",
}
AGAINST = r"version|release|isbn|issn|\bdoi\b|order no|invoice|section|chapter"
CONTEXT = {kind: re.compile(words, re.IGNORECASE) for kind, words in FOR.items()}
DOUBT = re.compile(AGAINST, re.IGNORECASE)
BEFORE, AFTER = 40, 20

#: Score before context; a span of an added kind needs THRESHOLD.
START = {
    "email": 0.9,
    "ip": 0.6,
    "card": 0.8,
    "phone": 0.7,
    "iban": 0.85,
    "short_card": 0.5,
    "ssn": 0.5,
    "local_phone": 0.4,
    "secret": 0.5,
}
#: Of a secret in the form of a well-known kind of key.
KNOWN_START = 0.9
GAIN, LOSS, THRESHOLD = 0.3, 0.3, 0.7

SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double,value:string>>"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for found in IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in found[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            yield found.span()


def _digits(value: str) -> str:
    return re.sub("[^0-9]", "", value)


def cards(text: str, least: int, most: int) -> Iterator[tuple[int, int]]:
    for found in CARD.finditer(text):
        digits = _digits(found[0])
        if least <= len(digits) <= most and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in PHONE.finditer(text):
        if 8 <= len(_digits(found[0])) <= 15:
            yield found.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest run of groups that the checksum confirms, as capitals may follow a number."""
    for found in IBAN.finditer(text):
        groups = found[0].split(" ")
        for last in range(len(groups), 0, -1):
            value = "".join(groups[:last])
            if 15 <= len(value) <= 34 and mod97(value):
                yield found.start(), found.start() + len(" ".join(groups[:last]))
                break


def entropy(value: str) -> float:
    """Bits a character, by the value's own characters."""
    shares = [n / len(value) for n in Counter(value).values()]
    return -sum(share * log2(share) for share in shares)


def secrets(text: str) -> list[tuple[int, int]]:
    """Runs with letters and digits that look drawn at random; equal spans once."""
    found = {match.span() for match in SECRET.finditer(text)}
    found |= {match.span(1) for match in ASSIGNED.finditer(text)}
    return sorted(
        (start, end)
        for start, end in found
        if any(c.isdigit() for c in text[start:end])
        and any(c.isalpha() for c in text[start:end])
        and entropy(text[start:end]) >= LEAST_ENTROPY
    )


def score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - BEFORE) : start] + " " + text[end : end + AFTER]
    moved = GAIN * bool(CONTEXT[kind].search(near)) - LOSS * bool(DOUBT.search(near))
    begin = START[kind]
    if kind == "secret" and KNOWN_KEY.fullmatch(text, start, end):
        begin = KNOWN_START
    return min(1.0, max(0.0, begin + moved))


def spans_of(text: str) -> list[dict]:
    """All spans by kind as listed, then start; base kinds whatever their score."""
    digits = any(digit in text for digit in "0123456789")
    proposed = {"email": emails(text)}
    if digits:
        proposed |= {
            "ip": ips(text),
            "card": cards(text, 16, 19),
            "phone": phones(text),
            "iban": ibans(text),
            "short_card": cards(text, 13, 15),
            "ssn": (found.span() for found in SSN.finditer(text)),
            "local_phone": (found.span() for found in LOCAL_PHONE.finditer(text)),
            "secret": secrets(text),
        }
    spans = []
    for kind in BASE_KINDS + ADDED_KINDS:
        if kind == "secret":
            # A part of an address or a number is no secret beside it.
            base = sorted((s["start"], s["end"]) for s in spans if s["kind"] in BASE_KINDS)
            reach = list(accumulate((end for _, end in base), max))
        for start, end in proposed.get(kind, ()):
            if kind == "secret" and (before := bisect_left(base, (end,))):
                if reach[before - 1] > start:
                    continue
            value = score(kind, text, start, end)
            if kind in BASE_KINDS or value >= THRESHOLD:
                spans.append(
                    {"kind": kind, "start": start, "end": end, "score": value}
                    | {"value": text[start:end]}
                )
    return spans


def _finder(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
    kind = pa.list_(pa.struct([*fields, ("score", pa.float64()), ("value", pa.string())]))
    for keys, texts in text_groups(batches):
        spans = pa.array([spans_of(text) for text in texts], kind)
        yield pa.RecordBatch.from_arrays([keys, spans], names=["id", "spans"])


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and `spans` (kind, start, end, score, value; code points, end exclusive) of every row.

    A NULL or empty text has no spans. Repeated rows and NULL ids are rows like others, other
    columns are left out, an empty table gives an empty table.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    found = docs.mapInArrow(_finder, f"id {kind}, spans {SPANS}")
    return found.withColumnRenamed("id", id_col)

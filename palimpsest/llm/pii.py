"""Personal data in texts: patterns propose, checksums confirm, context decides.

Base kinds (email, ip, card, phone) are taken as soon as their check holds.  Further
kinds (account numbers, social security numbers, secrets) start from a pattern's own
score and gain from words standing near the span; only those at or above a threshold are
reported, so a number or a random-looking run counts where its context says what it is.  Each text is one row's work: the
patterns are linear in its length, and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import longs, map_arrow, strings, table

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "ssn", "secret")
KINDS = BASE_KINDS + MORE_KINDS
ORDER = {kind: k for k, kind in enumerate(KINDS)}
THRESHOLD = 0.5
CONTEXT_CHARS = 48
#: score of the bare pattern (after its checksum), and words that add CONTEXT_GAIN.
SCORES = {"iban": 0.7, "ssn": 0.3, "secret": 0.3}
CONTEXT_GAIN = 0.4
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "payment", "credit"),
    "phone": ("phone", "tel", "call", "mobile"),
    "iban": ("iban", "bank", "account"),
    "ssn": ("ssn", "social security", "social-security"),
    "secret": ("token", "secret", "password", "passwd", "api key", "api_key", "apikey", "bearer", "credential", "private key"),
}
BASE_SCORES = {"email": 0.6, "ip": 0.6, "card": 0.6, "phone": 0.6}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never starts inside a run of digits: what follows the run is the same
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ ]?[A-Z0-9])")
_IBAN_CHARACTER = re.compile(r"[ ]?([A-Z0-9])")
# How long an account number of each country is.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
# a run of name characters from its first one on; what it is made of tells a secret from a word
_RUN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,200}+(?![A-Za-z0-9_-])")
_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "xoxb-", "xoxp-", "sk_live_", "sk-", "eyJ")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NO_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(code: str) -> bool:
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers of their country's length whose checksum holds, whatever stands behind them."""
    for m in _IBAN.finditer(text):
        end = m.end()
        for _ in range(IBAN_LENGTHS.get(m[0][:2], 0) - 4):
            c = _IBAN_CHARACTER.match(text, end)
            if c is None:
                break
            end = c.end()
        else:
            if m[0][:2] in IBAN_LENGTHS and not text[end : end + 1].isalnum() and mod97(text[m.start() : end]):
                yield m.start(), end


def random_looking(run: str) -> bool:
    """Letters and digits mixed, of many kinds for its length: more than 3 bits a character."""
    digits = sum(c.isdigit() for c in run)
    if not 2 <= digits <= len(run) - 2:
        return False
    return -sum(n / len(run) * math.log2(n / len(run)) for n in Counter(run).values()) > 3


def proposed(text: str) -> Iterator[tuple[int, int, str, float]]:
    """Spans of the further kinds that pass their check, with the score of the pattern alone."""
    for a, b in ibans(text):
        yield a, b, "iban", SCORES["iban"]
    for m in _SSN.finditer(text):
        yield m.start(), m.end(), "ssn", SCORES["ssn"]
    for m in _RUN.finditer(text):
        if random_looking(m[0]):
            yield m.start(), m.end(), "secret", SCORES["secret"] + CONTEXT_GAIN * m[0].startswith(_PREFIXES)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: what precedes it must be a run of local characters."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", last)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            found.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NO_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), m.end(), "phone"))
    found.sort(key=lambda s: (s[0], ORDER[s[2]]))
    return found


def near_words(text: str, start: int, end: int, kind: str) -> bool:
    around = text[max(0, start - CONTEXT_CHARS) : end + CONTEXT_CHARS].lower()
    return any(word in around for word in CONTEXT[kind])


def all_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, float]]:
    """Base spans with their scores, and the further kinds that reach THRESHOLD."""
    found = [(a, b, k, BASE_SCORES[k] + CONTEXT_GAIN * near_words(text, a, b, k)) for a, b, k in base]
    for a, b, kind, score in proposed(text):
        score += CONTEXT_GAIN * near_words(text, a, b, kind)
        if score >= THRESHOLD:
            found.append((a, b, kind, score))
    found.sort(key=lambda s: (s[0], ORDER[s[2]]))
    return found


def _joined(spans) -> str:
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in spans)


def redacted(text: str, spans) -> str:
    """Every span as <KIND>; where spans overlap, their union takes the first one's kind."""
    out, last = [], 0
    for a, b, kind, *_ in spans:
        if a >= last:
            out += [text[last:a], f"<{kind.upper()}>"]
        last = max(last, b)
    return "".join(out) + text[last:]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, spans (structs of kind, start, end, score), their digest columns.

    Null texts count as empty: no spans, the digest of the empty string.  Repeated rows
    are separate rows, equal texts get equal results, other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batch: pa.RecordBatch):
        cols: dict[str, list] = {name: [] for name in ("n_email", "n_ip", "n_card", "n_phone", "base", "spans", "scored")}
        for text in batch.column(1):
            text = text.as_py()
            base = base_spans(text)
            spans = all_spans(text, base)
            for kind in BASE_KINDS:
                cols[f"n_{kind}"].append(sum(s[2] == kind for s in base))
            cols["base"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            cols["spans"].append(_joined(spans))
            cols["scored"].append([{"kind": k, "start": a, "end": b, "score": s} for a, b, k, s in spans])
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[longs(cols[f"n_{k}"]) for k in BASE_KINDS], strings(cols["base"]), strings(cols["spans"]),
             pa.array(cols["scored"], kinds)],
            ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "scored"],
        )

    kind = source.schema["_id"].dataType.simpleString()
    return map_arrow(
        source, run,
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
        "scored array<struct<kind:string,start:long,end:long,score:double>>",
    )


def redact(docs: DataFrame) -> DataFrame:
    """documents with their personal data replaced by <KIND>; texts without any stay as they are, nulls null."""
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    source = docs.select(*names)

    def run(batch: pa.RecordBatch):
        texts = []
        sizes = []
        for text, size in zip(batch.column(1).to_pylist(), batch.column(4).to_pylist(), strict=True):
            spans = all_spans(text, base_spans(text)) if text else []
            if spans:
                text = redacted(text, spans)
                size = len(text)
            texts.append(text)
            sizes.append(size)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), strings(texts), batch.column(2), batch.column(3), pa.array(sizes, batch.schema.field(4).type)], names
        )

    return map_arrow(source, run, source.schema)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    scores = F.array_join(F.transform("scored", lambda s: F.format_string("%.1f", s["score"])), ",")
    return found.select("*", F.size("scored").cast("long").alias("n_spans"), scores.alias("scores")).drop("scored")

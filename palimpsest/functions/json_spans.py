"""Where the values of a JSON record stand in its text, so that they can be replaced and nothing else.

Parsing a record and writing it again changes numbers, spacing, escapes and duplicate
keys.  Here the text is walked once: every top-level member gives its key as it is meant
(whatever its spelling) and the span of its value.  Used on the few lines an erasure
touches; all other lines pass through without being looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from json.decoder import JSONDecodeError, scanstring

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from palimpsest.session import let_workers_import

_DECODER = json.JSONDecoder()
_BLANK = re.compile(r"[ \t\r\n]*")
_HIGH, _LOW = re.compile(r"\\u[dD][89abAB][0-9a-fA-F]{2}"), re.compile(r"\\u[dD][c-fC-F][0-9a-fA-F]{2}")


def members(text: str) -> list[tuple[str, int, int]]:
    """(key, start, end) of the value of every top-level member, repeated keys included.

    Raises ValueError if the text is no JSON object.
    """
    skip = lambda k: _BLANK.match(text, k).end()
    at = skip(0)
    if text[at : at + 1] != "{":
        raise ValueError("no JSON object")
    found = []
    at = skip(at + 1)
    if text[at : at + 1] == "}":
        return found
    while True:
        if text[at : at + 1] != '"':
            raise ValueError("a member without a key")
        key, at = scanstring(text, at + 1)
        at = skip(at)
        if text[at : at + 1] != ":":
            raise ValueError("a key without a value")
        start = skip(at + 1)
        try:
            _, end = _DECODER.raw_decode(text, start)
        except (JSONDecodeError, RecursionError) as broken:
            raise ValueError("a value that is no JSON") from broken
        found.append((key, start, end))
        at = skip(end)
        if text[at : at + 1] == "}":
            return found
        if text[at : at + 1] != ",":
            raise ValueError("no comma between members")
        at = skip(at + 1)


def characters(literal: str) -> tuple[str, list[str]]:
    """A JSON string literal's text, and how each of its characters is spelled."""
    spelled, at = [], 1
    while at < len(literal) - 1:
        size = 1
        if literal[at] == "\\":
            size = 6 if literal[at + 1] == "u" else 2
            if size == 6 and _HIGH.match(literal, at) and _LOW.match(literal, at + 6):
                size = 12
        spelled.append(literal[at : at + size])
        at += size
    return scanstring(literal, 1)[0], spelled


def masked_literal(literal: str, rules: Sequence[tuple[re.Pattern, int, str]]) -> str:
    """The literal with the rules' group replaced in its text; all other characters as they were spelled."""
    text, spelled = characters(literal)
    for pattern, group, token in rules:
        put = list(json.dumps(token, ensure_ascii=False)[1:-1]) if token.isascii() else [token]
        for match in reversed(list(pattern.finditer(text))):
            a, b = match.span(group)
            text = text[:a] + token + text[b:]
            spelled[a:b] = ["".join(put), *[""] * (len(token) - 1)] if token else []
    return '"' + "".join(spelled) + '"'


def redacted(line: str, fields: Iterable[str], payload: str, keys: Iterable[str], token: str) -> str:
    """The line with the token in place of the fields, and of the keys' text values inside the payload.

    A payload that is no string is left as it is, as are members that are not there.
    """
    fields = set(fields)
    rules = [(re.compile(f'"{re.escape(k)}" *: *"([^"]*)"'), 1, token) for k in keys]
    for key, start, end in reversed(members(line)):
        if key in fields:
            line = line[:start] + json.dumps(token) + line[end:]
        elif key == payload and line[start] == '"':
            line = line[:start] + masked_literal(line[start:end], rules) + line[end:]
    return line


def redact_lines(line: Column, fields: Sequence[str], payload: str, keys: Sequence[str], token: str) -> Column:
    """The column of redacted lines: null for null, and for lines whose spans could not be found."""
    def one(text):
        try:
            return None if text is None else redacted(text, fields, payload, keys, token)
        except ValueError:
            return None

    if session := SparkSession.getActiveSession():
        let_workers_import(session)

    @F.pandas_udf("string")
    def run(lines: pd.Series) -> pd.Series:
        return pd.Series([one(text) for text in lines], dtype=object)

    return run(line)

"""Masking policies compiled to column expressions.

A policy is a mapping ``{strategy, keys, url_params, regex}``.  It is applied to
the *text* of a JSON document, so the document keeps its structure and every
value the policy does not name.  All work stays in ``regexp_replace``: nothing
here leaves the JVM, and a masked column nobody reads is pruned away.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The strategies and the tokens they leave behind.
REDACT, NULLIFY, PARTIAL = "REDACT", "NULLIFY", "PARTIAL"
MASK_TOKEN = "***MASKED***"
PARTIAL_TOKEN = "***"
ERASED_TOKEN = "***REDACTED***"

# The two shipped policies.
NAME_URL_PARAMS = ("firstName", "lastName", "fname", "lname", "first_name", "last_name", "email")
DEFAULT_POLICIES: dict[str, dict] = {
    "name": {"strategy": REDACT, "keys": ["name"], "url_params": list(NAME_URL_PARAMS), "regex": []},
    "email": {"strategy": REDACT, "keys": ["email"], "url_params": [], "regex": []},
}

# What the two erasure jobs redact inside a payload.
PAYLOAD_ERASURE_POLICY = {"keys": ["name"], "url_params": ["firstName", "lastName", "email"]}
PROFILE_ERASURE_POLICY = {"keys": ["email", "name"]}

_PLAIN_VALUE = '[^"]*'
_ESCAPE_AWARE_VALUE = r'(?:[^"\\]|\\.)*'


def load_policies(path: str) -> dict[str, dict]:
    """Read a policy file (JSON object: pii type -> policy)."""
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)


def strategy_of(policy: Mapping) -> str:
    return (policy.get("strategy") or REDACT).upper()


def token_of(policy: Mapping, token: str = MASK_TOKEN) -> str:
    return PARTIAL_TOKEN if strategy_of(policy) == PARTIAL else token


def _literal_replacement(text: str) -> str:
    """Quote a string for the replacement side of a Java regex."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def _key_rule(key: str, strategy: str, token: str, escape_aware: bool) -> tuple[str, str]:
    """Pattern and replacement that mask one JSON key.

    The quoted key comes first and outside any group, which lets the regex
    engine skip through the text with a literal search.
    """
    head = f'"{re.escape(key)}"( *: *)'
    back = f'"{_literal_replacement(key)}"$1'
    value = _ESCAPE_AWARE_VALUE if escape_aware else _PLAIN_VALUE
    if strategy == NULLIFY:
        return f'{head}"{value}"', f"{back}null"
    if strategy == PARTIAL:
        first = r'([^"\\]|\\.)' if escape_aware else '([^"])'
        return f'{head}"{first}{value}"', f'{back}"$2{PARTIAL_TOKEN}"'
    return f'{head}"{value}"', f'{back}"{_literal_replacement(token)}"'


def mask_rules(
    policy: Mapping, token: str = MASK_TOKEN, escape_aware: bool = False
) -> list[tuple[str, str]]:
    """The policy as ordered ``(pattern, replacement)`` pairs: keys, URL parameters, free patterns."""
    strategy = strategy_of(policy)
    mark = token_of(policy, token)
    rules = [_key_rule(k, strategy, mark, escape_aware) for k in policy.get("keys") or ()]
    params = policy.get("url_params") or ()
    if params:
        names = "|".join(re.escape(p) for p in params)
        tail = "" if strategy == NULLIFY else _literal_replacement(mark)
        rules.append((f'([?&](?:{names})=)[^&#"]*', f"$1{tail}"))
    for pattern in policy.get("regex") or ():
        rules.append((pattern, "" if strategy == NULLIFY else _literal_replacement(mark)))
    return rules


def _could_match(col: Column, policy: Mapping) -> Column | None:
    """A cheap byte search that is false only where no rule can match; None if there is no such test."""
    if policy.get("regex"):
        return None
    tests = [F.contains(col, F.lit(f'"{k}"')) for k in policy.get("keys") or ()]
    if policy.get("url_params"):
        tests.append(F.contains(col, F.lit("=")))
    return reduce(lambda a, b: a | b, tests) if tests else None


def mask_expr(
    col: Column | str,
    policy: Mapping,
    token: str = MASK_TOKEN,
    escape_aware: bool = False,
    prefilter: bool = True,
) -> Column:
    """Compile ``policy`` to one expression over the text column ``col``.

    ``escape_aware`` lets a value contain ``\\"``; the default stops at the first
    quote.  ``prefilter`` skips the regexes on texts that hold none of the keys.
    """
    source = F.col(col) if isinstance(col, str) else col
    rules = mask_rules(policy, token, escape_aware)
    masked = reduce(lambda c, r: F.regexp_replace(c, F.lit(r[0]), F.lit(r[1])), rules, source)
    test = _could_match(source, policy) if prefilter and rules else None
    return masked if test is None else F.when(test, masked).otherwise(source)


def mask_variant(col: Column | str, policy: Mapping, **options) -> Column:
    """Mask a VARIANT column through its text form; NULL where masking broke the JSON."""
    source = F.col(col) if isinstance(col, str) else col
    return F.try_parse_json(mask_expr(F.to_json(source), policy, **options))


def hash_json_field(col: Column | str, schema: str, path: Sequence[str], bits: int = 256) -> Column:
    """Replace one field of a document with a known schema by its SHA-2 digest (batch use)."""
    doc = F.from_json(F.col(col) if isinstance(col, str) else col, schema)
    dotted = ".".join(path)
    value = reduce(lambda c, name: c.getField(name), path, doc)
    return F.to_json(doc.withField(dotted, F.sha2(value, bits)))


def masked_field(col: Column | str, path: str, policy: Mapping, **options) -> Column:
    """One JSON field of a masked document, without masking the document when that is provably the same.

    Masking a whole payload to read one harmless field is what makes a filter on
    it expensive.  The field is read from the raw text first.  If the field is
    not named by the policy and its value has no character a rule could start
    at, masking cannot have changed it; every other row masks, then extracts.
    """
    source = F.col(col) if isinstance(col, str) else col
    exact = F.get_json_object(mask_expr(source, policy, **options), path)
    leaf = re.split(r"[.\[\]']+", path.rstrip("]'"))[-1]
    if policy.get("regex") or leaf in (policy.get("keys") or ()) or leaf in ("", "$", "*"):
        return exact
    raw = F.get_json_object(source, path)
    harmless = F.get(F.regexp_extract_all(raw, F.lit(r'(?s)^[^?&"{\[]+$'), F.lit(0)), F.lit(0))
    return F.when(F.contains(source, F.lit("\\")), exact).otherwise(F.coalesce(harmless, exact))


def _sql_quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def mask_sql(policy: Mapping, argument: str = "payload", token: str = MASK_TOKEN) -> str:
    """The policy as SQL text, for the body of a SQL function."""
    body = argument
    for pattern, replacement in mask_rules(policy, token):
        body = f"regexp_replace({body}, {_sql_quote(pattern)}, {_sql_quote(replacement)})"
    return body


def register_mask_functions(
    spark: SparkSession, policies: Mapping[str, Mapping], prefix: str = "mask_pii_"
) -> list[str]:
    """One temporary SQL function per policy (inlined by the optimizer, no Python at run time)."""
    names = []
    for kind, policy in sorted(policies.items()):
        if not re.fullmatch(r"\w+", kind):
            raise ValueError(f"policy name {kind!r} cannot be part of a function name")
        name = f"{prefix}{kind}"
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(payload STRING) "
            f"RETURNS STRING RETURN {mask_sql(policy)}"
        )
        names.append(name)
    return names

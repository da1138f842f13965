"""The same answers in plain SQL, for DuckDB over the same parquet tables.

The SQL spells out the definitions (pairwise ``contains``, correlated counts,
windows), not the way the Spark jobs compute them.
"""

from __future__ import annotations

import re

from palimpsest.functions.masking import ERASED_TOKEN, MASK_TOKEN
from palimpsest.operators.discovery import DETECTORS
from palimpsest.operators.registry import CLASSIFIER_TYPES
from palimpsest.plans import testdata as td
from palimpsest.plans.catalog import DOCUMENT_PATTERNS, LOOKUP_ID


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick(values, index: str) -> str:
    return "([" + ", ".join(q(v) for v in values) + f"])[({index}) + 1]"


def lpad(text: str, width: int) -> str:
    return f"lpad(({text})::VARCHAR, {width}, '0')"


def with_ctes(body: str, *names: str) -> str:
    """Prefix the query with the CTEs it needs, dependencies first."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for dep in DEPENDS.get(name, ()):
            need(dep)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in wanted) + "\n" + body


# --- masked documents, written out with what stands in place of the values ---------------


def document(template: str, **values: str) -> str:
    """SQL text of a document: a literal with SQL expressions in place of <names>."""
    parts = re.split(r"<(\w+)>", template)
    return " || ".join(f"({values[x]})" if k % 2 else q(x) for k, x in enumerate(parts) if x)


HIT = (
    '{"appInfo":{"appId":"net.example.app","appName":"' + td.APP_NAME + '","name":<name>,"version":"5.2.0","screenName":"<screen>"},'
    '"customDimensions":[{"index":6,"value":"<status>"}],"documentLocation":"https://www.example.com/manage-travel?'
    'firstName=<first>&lastName=<last>&email=<mail>&pnr=P<order>","hitNumber":<number>,"type":"APPVIEW"}'
)
USER = '{"contact":{"email":<mail>,"phone":"<phone>"},"loyalty":{"tier":"<tier>","points":<points>}}'
PROFILE = '{"contact":{"email":"<mail>","name":"<name>"},"loyalty":{"tier":"<tier>","ltv":<ltv>}}'
APP_HIT = (
    '{"appInfo":{"appName":"' + td.APP_NAME + '","name":"<name>"},"documentLocation":"https://www.example.com/manage-travel?'
    'firstName=<first>&lastName=<last>&email=<mail>&pnr=AB<pnr>","metrics":{"revenue":<revenue>}}'
)
#: How a text value of a document looks under each strategy, and what is left of a URL parameter.
SHOWN = {
    "PLAIN": (lambda v: f"'\"' || {v} || '\"'", lambda v: v),
    "REDACT": (lambda v: q(f'"{MASK_TOKEN}"'), lambda v: q(MASK_TOKEN)),
    "NULLIFY": (lambda v: "'null'", lambda v: "''"),
    "PARTIAL": (lambda v: f"'\"' || left({v}, 1) || '***\"'", lambda v: "'***'"),
}


PAGE_PARAMS = ("page", "ref", "utm_source")


def without_params(url: str, names, left: str) -> str:
    """A URL whose named parameters keep their name only, or their name and what is left."""
    for name in names:
        url = f"regexp_replace({url}, '([?&]{name}=)[^&#\"]*', '\\1{left}', 'g')"
    return url


def mask_patterns(col: str, patterns, replacement: str = MASK_TOKEN) -> str:
    for pattern in patterns:
        col = f"regexp_replace({col}, {q(pattern)}, '{replacement}', 'g')"
    return col


# --- shared CTEs ---------------------------------------------------------------------------


def _who(key: str) -> dict[str, str]:
    first = pick(td.FIRST, f"{key} % 20")
    last = pick(td.LAST, f"({key} // 20) % 20")
    return {
        "first": first,
        "last": last,
        "full": f"({first} || ' ' || {last})",
        "email": f"(lower({first}) || '.' || lower({last}) || ({key})::VARCHAR || '@example.com')",
        "phone": f"('+1702' || {lpad(f'{key} % 1000000', 6)})",
    }


_p, _o, _e = _who("c_custkey"), _who("o_custkey"), _who("user_id")
_rid = f"'REQ-' || {lpad('id', 12)}"


def hits_sql(strategy: str) -> str:
    text, param = SHOWN[strategy]
    hit = document(
        HIT, name=text(_o["full"]), screen=pick(td.SCREENS, "o_orderkey % 4"), status="o_orderstatus", first=param(_o["first"]),
        last=param(_o["last"]), mail=param(_o["email"]), order="o_orderkey::VARCHAR", number="(o_orderkey % 6 + 1)::VARCHAR",
    )
    user = document(
        USER, mail=text(_o["email"]), phone=_o["phone"], tier=pick(td.TIERS, "o_custkey % 3"), points="(o_orderkey % 100000)::VARCHAR"
    )
    return f"SELECT o_orderkey AS hit_id, {hit} AS hit_payload, {user} AS user_payload FROM orders"


def profile_of(mail: str, name: str) -> str:
    return document(PROFILE, mail=mail, name=name, tier=pick(td.TIERS, "user_id % 3"), ltv="(event_id % 1000)::VARCHAR")


def app_hit(first: str, last: str, full: str, mail: str) -> str:
    return document(APP_HIT, name=full, first=first, last=last, mail=mail, pnr="(id % 99)::VARCHAR", revenue="(id % 950)::VARCHAR")


def mixed(user: str, x: str, v: str) -> str:
    """The documents without a common schema, with these values under the key b."""
    shapes = (
        '{"a":"t<event>","b":"<user>"}', '{"a":{"b":"<user>","c":[<event>,7]}}', '{"a":[{"b":"<x>"},{"b":"<user>"},"b"]}',
        '{"A":"t","a":true,"k<id>":{"b":"<v>"}}', '{"a":null,"b":[]}',
    )
    values = {"event": "event_id::VARCHAR", "id": "user_id::VARCHAR", "user": user, "x": x, "v": v}
    return "CASE event_id % 5 " + " ".join(f"WHEN {k} THEN {document(shape, **values)}" for k, shape in enumerate(shapes)) + " END"


_gone = q(ERASED_TOKEN)
CTES: dict[str, str] = {
    "person": f"""SELECT c_custkey AS id, {_p['first']} AS first_name, {_p['last']} AS last_name,
        {_p['full']} AS full_name, {_p['email']} AS email, {_p['phone']} AS phone,
        c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    **{("hits" if strategy == "PLAIN" else f"hits_{strategy}"): hits_sql(strategy) for strategy in SHOWN},
    "masked": "SELECT * FROM hits_REDACT",
    "queue": f"""SELECT {_rid} AS request_id,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN first_name ELSE '' END AS first_name,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN last_name ELSE '' END AS last_name,
        CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') THEN email END AS email,
        CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'DELETE' ELSE 'OBFUSCATE' END AS request_type,
        DATE '2026-07-01' AS request_date, DATE '2026-08-15' AS deadline_date,
        CASE WHEN c_acctbal < 0 THEN 'PENDING' ELSE 'COMPLETE' END AS status
        FROM person WHERE c_acctbal < 50 AND c_mktsegment <> 'MACHINERY'""",
    "subj": """SELECT request_id, email, nullif(first_name, '') AS first, nullif(last_name, '') AS last,
        nullif(first_name, '') || ' ' || nullif(last_name, '') AS full_name, request_type
        FROM queue WHERE status = 'PENDING'""",
    "customer_profile": """SELECT id AS customer_id, first_name, last_name, email, phone,
        (id % 9900 + 100)::VARCHAR || ' Harbour Road' AS street_address, c_mktsegment AS home_city,
        (id % 950 + 50)::INTEGER AS lifetime_revenue FROM person""",
    "contact_email_only": "SELECT id AS contact_id, email, phone, id % 2 = 0 AS opt_in FROM person",
    "booking": """SELECT id AS booking_id, full_name, 'P' || id::VARCHAR AS pnr,
        'SW' || (id % 900 + 100)::VARCHAR AS flight_no, (id % 700)::INTEGER AS fare_usd FROM person""",
    "loyalty_split": f"""SELECT id AS member_id, first_name AS first_nm, last_name AS last_nm,
        {pick(td.TIERS, 'id % 3')} AS tier, (id % 50000)::INTEGER AS points FROM person""",
    "app_hits_json": f"""SELECT id AS hit_id, {app_hit('first_name', 'last_name', 'full_name', 'email')} AS hit_payload,
        {app_hit(_gone, _gone, _gone, _gone)} AS redacted_payload, (id % 999)::INTEGER AS revenue_usd FROM person""",
    "notes": """SELECT id AS note_id, 'ticket ' || id::VARCHAR || ': mail from <' || CASE WHEN id % 3 = 0 THEN 'x' ELSE '' END || email
        || CASE id % 5 WHEN 0 THEN '.org>' WHEN 1 THEN '. Done>' ELSE '>' END AS note FROM person""",
    "mixed": f"""SELECT event_id, {mixed("'u' || user_id::VARCHAR", "'x'", "'v'")} AS doc,
        {mixed(q(MASK_TOKEN), q(MASK_TOKEN), q(MASK_TOKEN))} AS masked_doc FROM events""",
    "employee_crew": """SELECT id AS employee_id, first_name, last_name, email, c_nationkey AS base,
        c_mktsegment AS crew_role FROM person""",
    "raw": f"""SELECT 'E' || {lpad('event_id', 16)} AS event_id, 'U' || {lpad('user_id', 12)} AS user_id,
        {_e['email']} AS email, {_e['full']} AS full_name, {profile_of(_e['email'], _e['full'])} AS profile_json,
        value AS revenue, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_ts,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS _ingest_ts, event_type FROM events""",
    "redacted": f"SELECT 'E' || {lpad('event_id', 16)} AS event_id, {profile_of(_gone, _gone)} AS profile FROM events",
    "lreq": f"""SELECT {_rid} AS request_id, upper(email) AS subject_email,
        CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'DELETE' ELSE 'OBFUSCATE' END AS request_type,
        'PENDING' AS status FROM person WHERE c_acctbal < 0""",
    "resolved": """SELECT DISTINCT l.request_id, lower(l.subject_email) AS email, l.request_type, r.user_id,
        r.full_name FROM lreq l JOIN raw r ON lower(r.email) = lower(l.subject_email)""",
    "modes": """SELECT user_id, max(CASE WHEN request_type = 'DELETE' THEN 2 ELSE 1 END) AS mode
        FROM resolved GROUP BY user_id""",
    # first wave only: what the streaming run resolves before the second wave lands
    "modes_first": """SELECT r.user_id, max(CASE WHEN l.request_type = 'DELETE' THEN 2 ELSE 1 END) AS mode
        FROM lreq l JOIN raw r ON lower(r.email) = lower(l.subject_email)
        WHERE r.event_type <> 'error' GROUP BY 1""",
    "erased": f"""SELECT r.event_id, r.user_id,
        CASE WHEN mode = 1 THEN '{ERASED_TOKEN}' ELSE r.email END AS email,
        CASE WHEN mode = 1 THEN '{ERASED_TOKEN}' ELSE r.full_name END AS full_name,
        CASE WHEN mode = 1 THEN g.profile ELSE r.profile_json END AS profile_json,
        r.revenue, r.event_ts, r._ingest_ts
        FROM raw r JOIN redacted g USING (event_id) LEFT JOIN modes m USING (user_id) WHERE coalesce(mode, 0) <> 2""",
    "first_erased": f"""SELECT r.event_id, r.user_id,
        CASE WHEN mode = 1 THEN '{ERASED_TOKEN}' ELSE r.email END AS email,
        CASE WHEN mode = 1 THEN '{ERASED_TOKEN}' ELSE r.full_name END AS full_name,
        CASE WHEN mode = 1 THEN g.profile ELSE r.profile_json END AS profile_json,
        r.revenue, r.event_ts, r._ingest_ts
        FROM raw r JOIN redacted g USING (event_id) LEFT JOIN modes_first m USING (user_id)
        WHERE coalesce(mode, 0) <> 2 AND r.event_type <> 'error'""",
    "story": """SELECT * FROM first_erased UNION ALL
        SELECT event_id, user_id, email, full_name, profile_json, revenue, event_ts, _ingest_ts
        FROM raw WHERE event_type = 'error'""",
    # latest per user: first wave reduced, erased, then merged with the second wave
    "story_latest": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY _ingest_ts DESC, event_id DESC) AS rn FROM story) WHERE rn = 1""",
    "ctags": """SELECT 't' || (p_partkey // 5)::VARCHAR AS table_name, 'c' || (p_partkey % 5)::VARCHAR AS column_name,
        'pii' AS tag_name, CASE p_type WHEN 'ECONOMY' THEN 'name' WHEN 'SMALL' THEN 'email' WHEN 'STANDARD' THEN 'pnr'
        WHEN 'MEDIUM' THEN 'phone' ELSE 'something' END AS tag_value FROM part WHERE p_size > 20
        UNION ALL
        SELECT 't' || (p_partkey // 5)::VARCHAR, 'c' || (p_partkey % 5)::VARCHAR,
        CASE p_type WHEN 'ECONOMY' THEN 'class.email_address' WHEN 'SMALL' THEN 'class.name'
        WHEN 'STANDARD' THEN 'class.iban_code' ELSE 'class.unheard_of' END, '' FROM part WHERE p_size < 30""",
    "ttags": """SELECT 't' || (p_partkey // 5)::VARCHAR AS table_name, CASE WHEN max(p_size) > 45 THEN ' EMPLOYEE'
        WHEN max(p_size) > 35 THEN 'customer' END AS tag_value FROM part GROUP BY 1""",
    "cmap": "SELECT * FROM (VALUES "
    + ", ".join(f"({q(k)}, {q(v)})" for k, v in CLASSIFIER_TYPES.items())
    + ") AS v(tag_name, pii_type)",
    "merged": """SELECT table_name, column_name,
        coalesce(m.tag_value, c.pii_type) AS pii_type,
        CASE WHEN m.tag_value IS NOT NULL THEN 'manual' ELSE 'classification' END AS source
        FROM (SELECT table_name, column_name, tag_value FROM ctags WHERE tag_name = 'pii') m
        FULL OUTER JOIN (SELECT table_name, column_name, pii_type FROM ctags JOIN cmap USING (tag_name)) c
        USING (table_name, column_name)""",
    "reg": """SELECT g.table_name, g.column_name,
        CASE WHEN p.table_name IS NOT NULL OR pii_type = 'email' THEN 'email'
             WHEN pii_type = 'name' THEN coalesce(r.role, 'full_name') ELSE 'none' END AS identifier_role,
        p.table_name IS NOT NULL OR pii_type IN ('email', 'name') AS is_identifier,
        CASE WHEN p.table_name IS NOT NULL THEN 'json_key' WHEN pii_type = 'pnr' THEN 'pnr_token'
             ELSE 'scalar_token' END AS erase_strategy,
        CASE WHEN p.table_name IS NOT NULL THEN pii_type END AS json_tag,
        coalesce(lower(trim(t.tag_value)), 'customer') AS subject_scope
        FROM merged g
        LEFT JOIN (SELECT 't' || (p_partkey // 5)::VARCHAR AS table_name, 'c' || (p_partkey % 5)::VARCHAR AS column_name,
                   'first_name' AS role FROM part WHERE p_brand LIKE '%1') r
          ON r.table_name = g.table_name AND r.column_name = g.column_name
        LEFT JOIN (SELECT 't' || (p_partkey // 5)::VARCHAR AS table_name, 'c' || (p_partkey % 5)::VARCHAR AS column_name
                   FROM part WHERE p_brand LIKE '%2') p
          ON p.table_name = g.table_name AND p.column_name = g.column_name
        LEFT JOIN ttags t ON t.table_name = g.table_name""",
    "mapped": f"""SELECT {_rid} AS request_id,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN first_name ELSE '' END AS first_name,
        CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD') THEN last_name ELSE '' END AS last_name,
        CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') THEN email END AS email,
        CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE', 'MACHINERY') THEN 'DELETE' ELSE 'OBFUSCATE' END
          AS request_type,
        CASE WHEN c_mktsegment <> 'FURNITURE' THEN '2026-07-' || {lpad('id % 28 + 1', 2)} END AS request_date
        FROM person WHERE c_acctbal < 0""",
    "actionable": """SELECT * FROM mapped WHERE email IS NOT NULL OR (first_name <> '' AND last_name <> '')""",
    "qlog": f"""SELECT 's-' || event_id::VARCHAR AS statement_id,
        {pick(('1m', '10m', '100m'), 'event_id % 3')} AS scale,
        {pick(('baseline', 'dynamic', 'materialized'), '(event_id // 3) % 3')} AS variant,
        {pick(('full_scan_mask', 'point_lookup', 'filter_nonpii', 'groupby_nonpii', 'extract_pii', 'no_masked_col'),
              '(event_id // 9) % 6')} AS pattern,
        CASE WHEN event_type <> 'signup' THEN ((event_id // 54) % 5)::INTEGER END AS iter,
        floor(value * 10)::BIGINT AS execution_ms, event_id, user_id, ts AS started_at, event_type FROM events""",
    "timings": """SELECT TIMESTAMP '2024-01-31 00:00:00' AS collected_at, scale, variant, pattern, iter,
        execution_ms, execution_ms + 7 AS total_ms, execution_ms % 5 AS compilation_ms, event_id % 1000 AS read_rows,
        event_id * 3 AS read_bytes, user_id * 0.5::DOUBLE AS io_cache_pct, statement_id, started_at FROM qlog
        WHERE event_type NOT IN ('error', 'purchase')
        AND started_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 144 HOURS
        AND statement_id NOT IN (SELECT statement_id FROM qlog WHERE statement_id LIKE '%7')""",
    "best": """SELECT scale, pattern, variant, exec_ms, total_ms, read_rows, round(exec_ms - base, 0) AS overhead_ms,
        round(100.0::DOUBLE * (exec_ms - base) / nullif(base, 0), 1) AS overhead_pct, place AS scale_ord,
        place::VARCHAR || '_' || scale AS scale_sortable
        FROM (SELECT *, max(exec_ms) FILTER (WHERE variant = 'baseline') OVER (PARTITION BY scale, pattern) AS base,
              list_position(['1m', '10m', '100m'], scale) AS place FROM tstats) WHERE base IS NOT NULL""",
    "tstats": """SELECT scale, variant, pattern, min(execution_ms) AS exec_ms, min(total_ms) AS total_ms,
        max(read_rows) AS read_rows FROM timings GROUP BY ALL""",
}

DEPENDS: dict[str, tuple[str, ...]] = {
    "masked": ("hits", "hits_REDACT"),
    "queue": ("person",),
    "subj": ("queue",),
    **{t: ("person",) for t in (
        "customer_profile", "contact_email_only", "booking", "loyalty_split", "app_hits_json", "employee_crew",
        "lreq", "mapped", "notes")},
    "resolved": ("lreq", "raw"),
    "modes": ("resolved",),
    "modes_first": ("lreq", "raw"),
    "erased": ("raw", "redacted", "modes"),
    "first_erased": ("raw", "redacted", "modes_first"),
    "story": ("first_erased",),
    "story_latest": ("story",),
    "merged": ("ctags", "cmap"),
    "reg": ("merged", "ttags"),
    "actionable": ("mapped",),
    "timings": ("qlog",),
    "tstats": ("timings",),
    "best": ("tstats",),
}

# --- matching ------------------------------------------------------------------------------------

# table -> (predicate that makes a request eligible, predicate that makes a row match)
EMAIL_FIRST = {
    "customer_profile": (
        "s.email IS NOT NULL OR s.full_name IS NOT NULL",
        "CASE WHEN s.email IS NOT NULL THEN t.email = s.email ELSE t.first_name = s.first AND t.last_name = s.last END",
    ),
    "contact_email_only": ("s.email IS NOT NULL", "t.email = s.email"),
    "booking": ("s.full_name IS NOT NULL", "t.full_name = s.full_name"),
    "loyalty_split": ("s.full_name IS NOT NULL", "t.first_nm = s.first AND t.last_nm = s.last"),
    "app_hits_json": (
        "s.email IS NOT NULL OR s.full_name IS NOT NULL",
        "CASE WHEN s.email IS NOT NULL THEN contains(t.hit_payload, s.email) "
        "ELSE contains(t.hit_payload, s.first) AND contains(t.hit_payload, s.last) END",
    ),
}
_both = "s.email IS NOT NULL AND s.full_name IS NOT NULL"
ALL_MATCH = {
    "customer_profile": (_both, "t.email = s.email AND t.first_name = s.first AND t.last_name = s.last"),
    "contact_email_only": ("s.email IS NOT NULL", "t.email = s.email"),
    "booking": ("s.full_name IS NOT NULL", "t.full_name = s.full_name"),
    "loyalty_split": ("s.full_name IS NOT NULL", "t.first_nm = s.first AND t.last_nm = s.last"),
    "app_hits_json": (
        _both,
        "contains(t.hit_payload, s.email) AND contains(t.hit_payload, s.first) AND contains(t.hit_payload, s.last)",
    ),
}
KEYS = {
    "customer_profile": "customer_id", "contact_email_only": "contact_id", "booking": "booking_id",
    "loyalty_split": "member_id", "app_hits_json": "hit_id",
}
TARGET_OF = {
    "customer_profile": "crm.people", "contact_email_only": "crm.people",
    "booking": "ops.travel", "loyalty_split": "ops.travel", "app_hits_json": "ops.travel",
}


def match_union(rule) -> str:
    return " UNION ALL ".join(
        f"SELECT s.request_id, s.email, s.request_type, '{t}' AS \"table\", "
        f"(SELECT count(*) FROM {t} t WHERE {row}) AS rows_matched FROM subj s WHERE {ask}"
        for t, (ask, row) in rule.items()
    )


def action(dry: bool) -> str:
    done = "'dry_run'" if dry else "CASE WHEN request_type = 'DELETE' THEN 'deleted' ELSE 'obfuscated' END"
    return f"CASE WHEN rows_matched > 0 THEN {done} ELSE 'no_match' END"


def audit_sql(dry: bool, target: str = "'crm.people'") -> str:
    return with_ctes(
        f"SELECT {target} AS target, request_id, email, request_type, \"table\", rows_matched, "
        f"{action(dry)} AS action FROM ({match_union(EMAIL_FIRST)})",
        "subj", *EMAIL_FIRST,
    )


_target_case = "CASE \"table\" " + " ".join(f"WHEN '{t}' THEN '{n}'" for t, n in TARGET_OF.items()) + " END"

REDACTED = {
    "customer_profile": ("first_name", "last_name", "email", "phone", "street_address"),
    "contact_email_only": ("email", "phone"),
    "booking": ("full_name", "pnr"),
    "loyalty_split": ("first_nm", "last_nm"),
    "app_hits_json": (),
}
COLUMNS = {
    "customer_profile": ("customer_id", "first_name", "last_name", "email", "phone", "street_address", "home_city",
                         "lifetime_revenue"),
    "contact_email_only": ("contact_id", "email", "phone", "opt_in"),
    "booking": ("booking_id", "full_name", "pnr", "flight_no", "fare_usd"),
    "loyalty_split": ("member_id", "first_nm", "last_nm", "tier", "points"),
    "app_hits_json": ("hit_id", "hit_payload", "revenue_usd"),
}


def erased_sql(table: str, rule=EMAIL_FIRST) -> str:
    """Body of the erased table (needs the CTEs of the table and of the subjects)."""
    ask, row = rule[table]
    key = KEYS[table]

    def column(name: str) -> str:
        if name in REDACTED[table]:
            return f"CASE WHEN m.mode = 1 THEN '{ERASED_TOKEN}' ELSE t.{name} END AS {name}"
        if name == "hit_payload":
            return f"CASE WHEN m.mode = 1 THEN t.redacted_payload ELSE t.hit_payload END AS {name}"
        return f"t.{name}"

    return (
        f"SELECT {', '.join(column(c) for c in COLUMNS[table])} FROM {table} t LEFT JOIN ("
        f"SELECT t.{key} AS k, max(CASE WHEN s.request_type = 'DELETE' THEN 2 ELSE 1 END) AS mode "
        f"FROM {table} t JOIN subj s ON ({ask}) AND ({row}) GROUP BY 1) m ON m.k = t.{key} "
        f"WHERE coalesce(m.mode, 0) <> 2"
    )


TAGGED = {t: tuple(c for tt, c, _ in td.COLUMN_TAGS if tt == t) for t in COLUMNS}


def findings_sql(source: dict[str, str], target: str) -> str:
    """Pairwise scan: every registered cell against every identifier of every subject."""
    cells = " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", {c} AS text FROM {source[t]}"
        for t in source for c in TAGGED[t]
    )
    wanted = " UNION ALL ".join(
        f"SELECT request_id, '{label}' AS matched_field, {col} AS needle FROM subj WHERE {col} IS NOT NULL"
        for label, col in (("email", "email"), ("first", "first"), ("last", "last"), ("full", "full_name"))
    )
    return (
        f"SELECT {target} AS target, request_id, \"table\", \"column\", matched_field, count(*) AS rows "
        f"FROM ({cells}) JOIN ({wanted}) ON contains(text, needle) GROUP BY ALL"
    )


#: No character of an address before it, none after it (a dot counts if the address goes on behind it).
_WHOLE = (
    "regexp_matches(t.note, '(^|[^A-Za-z0-9._%+-])' || regexp_escape(s.email) || '($|[^A-Za-z0-9.-]|\\.($|[^A-Za-z0-9]))')"
)
_IN_NOTE = "CASE WHEN s.email IS NOT NULL THEN {} ELSE contains(t.note, s.first) AND contains(t.note, s.last) END"


def note_counts(test: str) -> str:
    condition = _IN_NOTE.format(test)
    asked = "s.email IS NOT NULL OR s.full_name IS NOT NULL"
    return with_ctes(
        f"SELECT s.request_id, (SELECT count(*) FROM notes t WHERE {condition}) AS rows_matched FROM subj s WHERE {asked}", "subj", "notes"
    )


def _erased_ctes() -> str:
    return ", ".join(f"x_{t} AS ({erased_sql(t)})" for t in COLUMNS)


def findings_after() -> str:
    sources = {t: f"x_{t}" for t in COLUMNS}
    head = with_ctes("", "subj", *COLUMNS).rstrip()
    return f"{head}, {_erased_ctes()}\n" + findings_sql(sources, _target_case)


def summary_sql(dry: bool, judged_by: str = "true") -> str:
    verdict = "'dry_run'" if dry else "CASE WHEN coalesce(f.n, 0) > 0 THEN 'FAIL' ELSE 'PASS' END"
    head = with_ctes("", "subj", *COLUMNS).rstrip()
    sources = {t: (t if dry else f"x_{t}") for t in COLUMNS}
    return (
        f"{head}, {_erased_ctes()}, found AS ({findings_sql(sources, _target_case)}), "
        f"matched AS ({match_union(EMAIL_FIRST)}), "
        f"rows_by AS (SELECT {_target_case} AS target, sum(rows_matched)::BIGINT AS n FROM matched GROUP BY 1), "
        f"found_by AS (SELECT target, sum(rows)::BIGINT AS n FROM found WHERE {judged_by} GROUP BY 1), "
        f"state AS (SELECT * FROM (VALUES ('crm.people', 2, 'processed'), ('ops.travel', 3, 'processed'), "
        f"('hr.staff', 0, 'no_tables_in_scope'), ('lab.blank', 0, 'skipped_empty_registry'), "
        f"('lab.absent', 0, 'skipped_no_registry')) AS v(target, tables_in_scope, status))\n"
        f"SELECT s.target, s.tables_in_scope, coalesce(r.n, 0) AS rows_affected, s.status, "
        f"CASE WHEN s.status = 'processed' THEN {verdict} ELSE 'n/a' END AS validation "
        f"FROM state s LEFT JOIN rows_by r USING (target) LEFT JOIN found_by f USING (target)"
    )


# --- the catalogue ------------------------------------------------------------------------------------


def masked_both(strategy: str) -> str:
    return with_ctes(f"SELECT * FROM hits_{strategy}", f"hits_{strategy}")


def js(col: str, path: str) -> str:
    return f"json_extract_string({col}, '{path}')"


def leaves(col: str, source: str) -> str:
    """(path, value) of every scalar leaf; array steps written []."""
    return (
        f"SELECT regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[]', 'g') AS path, "
        f"json_extract_string(s.j, t.fullkey) AS value "
        f"FROM (SELECT {col} AS j FROM {source}) s, json_tree(s.j) t WHERE t.type NOT IN ('OBJECT', 'ARRAY', 'NULL')"
    )


def profile_sql(col: str, source: str, *ctes: str) -> str:
    counted = ", ".join(
        f"count(*) FILTER (WHERE regexp_matches(value, {q(rx)})) AS {n}_hits" for n, rx in DETECTORS.items()
    )
    body = (
        f"SELECT path, count(*) AS \"values\", count(DISTINCT value) AS distinct_values, {counted} "
        f"FROM ({leaves(col, source)}) GROUP BY path"
    )
    return with_ctes(body, *ctes) if ctes else body


def diff_sql(both: str) -> str:
    """Documents j and k of a row (key), leaf lists by path side by side."""
    def listed(column: str) -> str:
        return (
            f"(SELECT s.key, regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[]', 'g') AS path, list(json_extract_string(s.{column}, t.fullkey) ORDER BY t.id) AS v "
            f"FROM ({both}) s, json_tree(s.{column}) t WHERE t.type NOT IN ('OBJECT', 'ARRAY', 'NULL') GROUP BY ALL)"
        )

    return f"""SELECT path, count(*) AS docs, count(*) FILTER (WHERE a.v IS DISTINCT FROM b.v) AS changed_docs,
        count(*) FILTER (WHERE len(a.v) <> coalesce(len(b.v), 0)) AS lost_docs
        FROM {listed('j')} a LEFT JOIN {listed('k')} b USING (key, path) GROUP BY path"""


def bench_oracles() -> dict[str, str]:
    out = {}
    for variant in ("baseline", "dynamic", "materialized"):
        src = "hits" if variant == "baseline" else "masked"
        for name, body in {
            "full_scan_mask": "SELECT count(*) AS c, sum(length(hit_payload))::BIGINT AS s1, "
            f"sum(length(user_payload))::BIGINT AS s2 FROM {src}",
            "point_lookup": f"SELECT hit_payload, user_payload FROM {src} WHERE hit_id = {LOOKUP_ID}",
            "filter_nonpii": f"SELECT count(*) AS c FROM {src} "
            f"WHERE {js('hit_payload', '$.appInfo.appName')} = '{td.APP_NAME}'",
            "groupby_nonpii": f"SELECT {js('user_payload', '$.loyalty.tier')} AS tier, count(*) AS c FROM {src} GROUP BY 1",
            "extract_pii": f"SELECT {js('hit_payload', '$.appInfo.name')} AS name FROM "
            f"(SELECT * FROM {src} ORDER BY hit_id LIMIT 1000)",
            "no_masked_col": f"SELECT count(*) AS c, min(hit_id) AS lo, max(hit_id) AS hi FROM {src}",
        }.items():
            out[f"bench_{name}_{variant}"] = with_ctes(body, src)
    out["bench_filter_nonpii_field_first"] = out["bench_filter_nonpii_dynamic"]
    out["bench_groupby_nonpii_field_first"] = out["bench_groupby_nonpii_dynamic"]
    scan = "SELECT count(*) AS c, sum(length(hit_payload))::BIGINT AS s1, sum(length(user_payload))::BIGINT AS s2 FROM"
    out["bench_warmup"] = with_ctes(f"{scan} hits UNION ALL {scan} masked", "masked")
    return out


def story_counts(rows: str) -> str:
    return (
        f"SELECT folder, count(*) AS records FROM ({rows}) GROUP BY folder "
        f"UNION ALL SELECT 'all', count(*) FROM ({rows})"
    )


def proof_sql(suffix: str, layers: dict[str, str], request_type: str) -> str:
    parts = ", ".join(
        f"(SELECT count(*) FROM {src} WHERE lower(email) IN (SELECT lower(subject_email) FROM lreq "
        f"WHERE request_type = '{request_type}')) AS {name}_{suffix}"
        for name, src in layers.items()
    )
    return with_ctes(f"SELECT {parts}", "erased", "raw", "lreq")


def invariants_sql() -> str:
    """Each check counted row by row, per layer; the control layer is the untouched raw."""
    parts = []
    for layer, src in (("raw", "erased"), ("bronze", "erased"), ("silver", "erased"), ("control", "raw")):
        dele = "SELECT {c} FROM resolved WHERE request_type = 'DELETE'"
        obf = "SELECT {c} FROM resolved WHERE request_type = 'OBFUSCATE'"
        inside = " OR ".join(f"contains(x.profile_json, o.{c})" for c in ("email", "full_name"))
        for check, where in (
            ("delete_user_gone", f"user_id IN ({dele.format(c='user_id')})"),
            ("delete_email_gone", f"lower(email) IN ({dele.format(c='email')})"),
            ("obfuscate_email_gone", f"lower(email) IN ({obf.format(c='email')})"),
            ("obfuscate_cells_redacted", f"user_id IN ({obf.format(c='user_id')}) AND "
             f"(email <> '{ERASED_TOKEN}' OR full_name <> '{ERASED_TOKEN}')"),
            ("obfuscate_payload_clean", "EXISTS (SELECT 1 FROM resolved o WHERE o.request_type = 'OBFUSCATE' "
             f"AND o.user_id = x.user_id AND ({inside}))"),
        ):
            parts.append(
                f"SELECT '{check}' AS \"check\", '{layer}' AS layer, "
                f"(SELECT count(*) FROM {src} x WHERE {where}) AS violations"
            )
    return with_ctes(" UNION ALL ".join(parts), "erased", "resolved")


GOLD = "count(*) AS event_count, max(event_ts) AS last_event_ts FROM"


def all_oracles() -> dict[str, str]:
    pat1 = mask_patterns("text", DOCUMENT_PATTERNS)
    out = {
        "mask_redact": masked_both("REDACT"),
        "mask_nullify": masked_both("NULLIFY"),
        "mask_partial": masked_both("PARTIAL"),
        "mask_url_params": f"SELECT page_id, {without_params('url', PAGE_PARAMS, MASK_TOKEN)} AS url FROM pages",
        "mask_url_params_nullify":
            f"SELECT page_id, {without_params('url', PAGE_PARAMS, '')} AS url FROM pages",
        "mask_regex_documents": f"SELECT doc_id, {pat1} AS text FROM documents",
        "mask_regex_nullify_conversations":
            f"SELECT conv_id, turn, {mask_patterns('text', DOCUMENT_PATTERNS[:1], '')} AS text FROM conversations",
        "mask_pages_html":
            f"SELECT page_id, {mask_patterns('html', DOCUMENT_PATTERNS[:1], '***')} AS html FROM pages",
        "mask_policy_exempt": with_ctes("SELECT * FROM hits", "hits"),
        "mask_hash_batch": with_ctes(
            "SELECT hit_id, replace(user_payload, " + js("user_payload", "$.contact.email")
            + ", sha256(" + js("user_payload", "$.contact.email") + ")) AS user_payload FROM hits", "hits"),
        "mask_variant_fields": with_ctes(
            f"SELECT hit_id, {js('user_payload', '$.contact.email')} AS email, "
            f"{js('user_payload', '$.contact.phone')} AS phone, "
            f"{js('user_payload', '$.loyalty.points')}::BIGINT AS points FROM masked", "masked"),
        "mask_before_after": with_ctes(
            f"SELECT h.hit_id, {js('h.hit_payload', '$.appInfo.name')} AS name_raw, "
            f"{js('m.hit_payload', '$.appInfo.name')} AS name_masked, "
            f"{js('h.hit_payload', '$.documentLocation')} AS url_raw, "
            f"{js('m.hit_payload', '$.documentLocation')} AS url_masked, "
            f"{js('h.user_payload', '$.contact.email')} AS email_raw, "
            f"{js('m.user_payload', '$.contact.email')} AS email_masked, "
            f"{js('h.user_payload', '$.contact.phone')} AS phone_raw, "
            f"{js('m.user_payload', '$.contact.phone')} AS phone_masked "
            "FROM hits h JOIN masked m USING (hit_id) ORDER BY hit_id LIMIT 10", "masked"),
        "mask_full_document": with_ctes(
            "SELECT h.hit_id, h.hit_payload AS hit_raw, m.hit_payload AS hit_masked, h.user_payload AS user_raw, "
            "m.user_payload AS user_masked FROM hits h JOIN masked m USING (hit_id) ORDER BY hit_id LIMIT 1", "masked"),
        "mask_validation_counts": with_ctes(
            f"""SELECT count(*) AS total,
            count(*) FILTER (WHERE {js('hit_payload', '$.appInfo.name')} = '{MASK_TOKEN}') AS name_masked,
            count(*) FILTER (WHERE {js('hit_payload', '$.documentLocation')} LIKE
              '%firstName={MASK_TOKEN}%lastName={MASK_TOKEN}%email={MASK_TOKEN}%') AS url_masked,
            count(*) FILTER (WHERE {js('user_payload', '$.contact.email')} = '{MASK_TOKEN}') AS email_masked,
            count(*) FILTER (WHERE {js('user_payload', '$.contact.phone')} LIKE '+1%') AS phone_preserved,
            count(*) FILTER (WHERE {js('hit_payload', '$.appInfo.appName')} = '{td.APP_NAME}') AS appname_preserved
            FROM masked""", "masked"),
        "mask_structure_diff": with_ctes(
            diff_sql("SELECT hit_id AS key, h.hit_payload AS j, m.hit_payload AS k FROM hits h JOIN masked m USING (hit_id)"), "masked"),
        "mask_structure_diff_mixed": with_ctes(diff_sql("SELECT event_id AS key, doc AS j, masked_doc AS k FROM mixed"), "mixed"),
        "json_path_profile_mixed": profile_sql("doc", "mixed", "mixed"),
        "json_path_profile": profile_sql("hit_payload", "hits", "hits"),
        "json_path_profile_events": profile_sql("props", "events"),
        "json_path_proposals": with_ctes(
            f"""SELECT path, CASE WHEN u >= greatest(e, p, n) THEN 'url_person' WHEN p >= greatest(e, n) THEN 'phone'
              WHEN n >= e THEN 'person_name' ELSE 'email' END AS pii_type, greatest(e, p, u, n) AS score FROM (
              SELECT path, {", ".join(f"round(count(*) FILTER (WHERE regexp_matches(value, {q(DETECTORS[d])})) / count(*), 4) AS {a}" for d, a in (("email", "e"), ("phone", "p"), ("url_person", "u"), ("person_name", "n")))}
              FROM ({leaves('user_payload', 'hits')}) GROUP BY path) WHERE greatest(e, p, u, n) >= 0.5""", "hits"),
        "tag_inventory": with_ctes(
            "SELECT table_name, tag_value, count(*) AS columns FROM ctags WHERE tag_name = 'pii' GROUP BY ALL", "ctags"),
        "tag_missing_values": with_ctes(
            "SELECT tag_value FROM (SELECT unnest(['name', 'email', 'ssn']) AS tag_value UNION "
            "SELECT tag_value FROM ctags WHERE tag_name = 'pii') EXCEPT "
            "SELECT tag_value FROM ctags WHERE tag_name = 'pii' AND tag_value LIKE '%e%'", "ctags"),
        "registry_merged_tags": with_ctes("SELECT * FROM merged", "merged"),
        "registry_seed": with_ctes("SELECT * FROM reg", "reg"),
        "registry_scope": with_ctes("SELECT * FROM reg WHERE subject_scope = 'customer'", "reg"),
        "registry_skipped": with_ctes(
            "SELECT DISTINCT table_name FROM reg WHERE table_name NOT IN "
            "(SELECT table_name FROM reg WHERE subject_scope = 'customer')", "reg"),
        "registry_purge_tables": with_ctes(
            "SELECT DISTINCT table_name FROM reg WHERE subject_scope = 'employee'", "reg"),
        "intake_map": with_ctes("SELECT * FROM mapped", "mapped"),
        "intake_actionable": with_ctes("SELECT * FROM actionable", "actionable"),
        "intake_dropped": with_ctes(
            "SELECT (SELECT count(*) FROM actionable) AS actionable, "
            "(SELECT count(*) FROM mapped) - (SELECT count(*) FROM actionable) AS dropped", "actionable"),
        "intake_upsert": with_ctes(
            """SELECT coalesce(k.request_id, a.request_id) AS request_id,
            CASE WHEN keep THEN k.first_name ELSE a.first_name END AS first_name,
            CASE WHEN keep THEN k.last_name ELSE a.last_name END AS last_name,
            CASE WHEN keep THEN k.email ELSE a.email END AS email,
            CASE WHEN keep THEN k.request_type ELSE a.request_type END AS request_type,
            CASE WHEN keep THEN k.request_date ELSE a.asked END AS request_date,
            CASE WHEN keep THEN k.deadline_date ELSE (a.asked + 45)::DATE END AS deadline_date,
            CASE WHEN keep THEN k.status ELSE 'PENDING' END AS status
            FROM (SELECT *, true AS here FROM queue) k
            FULL OUTER JOIN (SELECT *, coalesce(request_date::DATE, DATE '2026-07-30') AS asked FROM actionable) a
            ON k.request_id = a.request_id,
            LATERAL (SELECT coalesce(here, false) AND (a.request_id IS NULL OR k.status = 'COMPLETE') AS keep)""",
            "queue", "actionable"),
        "intake_status": with_ctes("SELECT status, count(*) AS n FROM queue GROUP BY ALL", "queue"),
        "intake_status_type": with_ctes("SELECT status, request_type, count(*) AS n FROM queue GROUP BY ALL", "queue"),
        "intake_pending": with_ctes("SELECT * FROM queue WHERE status = 'PENDING'", "queue"),
        "intake_number_requests": with_ctes(
            "SELECT 'REQ-' || CASE WHEN n > 9999 THEN n::VARCHAR ELSE lpad(n::VARCHAR, 4, '0') END AS request_id, email "
            "FROM (SELECT email, row_number() OVER (ORDER BY email) AS n FROM person)", "person"),
        "intake_next_number": with_ctes(
            "SELECT max(split_part(request_id, '-', 2)::INTEGER) + 1 AS next_number FROM queue", "queue"),
        "intake_candidates": with_ctes(
            """SELECT email, (row_number() OVER (ORDER BY email))::INTEGER AS position,
            CASE WHEN row_number() OVER (ORDER BY email) % 2 = 1 THEN 'DELETE' ELSE 'OBFUSCATE' END AS request_type
            FROM (SELECT DISTINCT email FROM raw WHERE email NOT IN (SELECT email FROM queue WHERE email IS NOT NULL)
            ORDER BY email LIMIT 10)""", "raw", "queue"),
        "match_email_first": with_ctes(
            f"SELECT request_id, \"table\", rows_matched FROM ({match_union(EMAIL_FIRST)})", "subj", *EMAIL_FIRST),
        "match_all_identifiers": with_ctes(
            f"SELECT request_id, \"table\", rows_matched FROM ({match_union(ALL_MATCH)})", "subj", *ALL_MATCH),
        "match_rule_diff": with_ctes(
            f"""SELECT request_id, "table", coalesce(a.rows_matched, 0) AS email_first_rows,
            coalesce(b.rows_matched, 0) AS all_match_rows,
            coalesce(a.rows_matched, 0) - coalesce(b.rows_matched, 0) AS row_diff
            FROM ({match_union(EMAIL_FIRST)}) a FULL OUTER JOIN ({match_union(ALL_MATCH)}) b
            USING (request_id, "table")""", "subj", *EMAIL_FIRST),
        "match_payload_orders": with_ctes(
            """SELECT s.request_id, (SELECT count(*) FROM hits t WHERE CASE WHEN s.email IS NOT NULL
            THEN contains(t.hit_payload, s.email) OR contains(t.user_payload, s.email)
            ELSE (contains(t.hit_payload, s.first) AND contains(t.hit_payload, s.last))
              OR (contains(t.user_payload, s.first) AND contains(t.user_payload, s.last)) END) AS rows_matched
            FROM subj s""", "subj", "hits"),
        "erase_audit": audit_sql(False),
        "erase_dry_run": audit_sql(True),
        "erase_multi_target_audit": audit_sql(False, _target_case),
        "erase_multi_target_summary": summary_sql(False),
        "erase_multi_target_dry_run": summary_sql(True),
        "erase_by_name_summary": summary_sql(False, "matched_field = 'email'"),
        "erase_by_name_manifest":
            f"SELECT t.target, q.request_id, t.validation FROM ({summary_sql(False, "matched_field = 'email'")}) t, "
            f"({with_ctes('SELECT request_id FROM queue WHERE status = ' + q('PENDING'), 'queue')}) q WHERE t.status = 'processed'",
        "queue_closed_by_manifest": with_ctes(
            "SELECT request_id, 'COMPLETE' AS status FROM queue UNION ALL "
            "SELECT 'LATE-' || request_id, 'PENDING' FROM queue WHERE status = 'COMPLETE'", "queue"),
        "erase_verdict": "SELECT count(*) FILTER (WHERE status = 'processed') AS processed_targets, "
            "CASE WHEN count(*) FILTER (WHERE validation = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict "
            f"FROM ({summary_sql(False)})",
        "queue_scrub_complete": with_ctes(
            "SELECT request_id, " + ", ".join(
                f"CASE WHEN status = 'PENDING' THEN '{ERASED_TOKEN}' ELSE {c} END AS {c}"
                for c in ("first_name", "last_name", "email"))
            + ", request_type, request_date, deadline_date, 'COMPLETE' AS status FROM queue", "queue"),
        "queue_complete_by_id": with_ctes(
            "SELECT * REPLACE (CASE WHEN request_type = 'DELETE' THEN 'COMPLETE' ELSE status END AS status) FROM queue",
            "queue"),
        "match_whole_address": note_counts(_WHOLE),
        "match_part_of_address": note_counts("contains(t.note, s.email)"),
        "erase_whole_address": with_ctes(
            "SELECT t.note_id, max(CASE WHEN s.request_type = 'DELETE' THEN 2 ELSE 1 END) AS erase_mode "
            f"FROM notes t JOIN subj s ON {_IN_NOTE.format(_WHOLE)} GROUP BY 1", "subj", "notes"),
        "erase_in_place_files": with_ctes(
            f"""SELECT count(*) AS files, count(*) FILTER (WHERE hit AND NOT gone) AS rewritten, count(*) FILTER (WHERE gone) AS removed
            FROM (SELECT floor(p.c_acctbal / 100) AS bucket, bool_or(coalesce(m.mode, 0) > 0) AS hit, bool_and(coalesce(m.mode, 0) = 2) AS gone
              FROM person p LEFT JOIN (
                SELECT t.hit_id, max(CASE WHEN s.request_type = 'DELETE' THEN 2 ELSE 1 END) AS mode
                FROM app_hits_json t JOIN subj s ON {EMAIL_FIRST['app_hits_json'][1]} GROUP BY 1) m ON m.hit_id = p.id
              GROUP BY 1)""", "subj", "app_hits_json"),
        "no_trace_scan_before": with_ctes(
            findings_sql({t: t for t in COLUMNS}, "'crm.people'"), "subj", *COLUMNS),
        "no_trace_scan_after": findings_after(),
        "neighbours_untouched": with_ctes(
            f"""SELECT count(*) AS rows_gone, count(*) FILTER (WHERE mode = 1) AS rows_new, 0 AS neighbours_changed
            FROM (SELECT t.customer_id, max(CASE WHEN s.request_type = 'DELETE' THEN 2 ELSE 1 END) AS mode
              FROM customer_profile t JOIN subj s ON {EMAIL_FIRST['customer_profile'][1]} GROUP BY 1)""",
            "subj", "customer_profile"),
        "purge_no_bytes": with_ctes(
            f"SELECT count(*) AS rows, 0 AS rows_with_trace FROM ({erased_sql('customer_profile')})",
            "subj", "customer_profile"),
        "resolve_subject_keys": with_ctes("SELECT * FROM resolved", "resolved"),
        "resolve_user_modes": with_ctes("SELECT user_id, mode AS erase_mode FROM modes", "modes"),
        "erase_layer_raw": with_ctes("SELECT * FROM erased", "erased"),
        "erase_layer_silver": with_ctes("SELECT * EXCLUDE (_ingest_ts) FROM erased", "erased"),
        "erase_layer_counts": with_ctes(
            "SELECT layer, (SELECT count(*) FROM raw WHERE user_id IN (SELECT user_id FROM modes)) AS rows "
            "FROM (SELECT unnest(['raw', 'bronze', 'silver']) AS layer)", "raw", "modes"),
        "no_trace_matrix": with_ctes(
            "SELECT request_id, request_type, status, " + ", ".join(
                f"(SELECT count(*) FROM {src} x WHERE lower(x.email) = lower(l.subject_email)) AS {n}_clear"
                for n, src in (("raw", "raw"), ("bronze", "raw"), ("silver", "raw"), ("file", "erased")))
            + " FROM lreq l", "lreq", "raw", "erased"),
        "delete_proof": proof_sql("rows", {"raw": "erased", "bronze": "erased", "silver": "erased"}, "DELETE"),
        "obfuscate_proof": proof_sql("cleartext", {"raw": "erased", "untouched": "raw"}, "OBFUSCATE"),
        "masked_row_counts": with_ctes(
            "SELECT " + ", ".join(
                f"(SELECT count(*) FROM erased WHERE email = '{ERASED_TOKEN}') AS {n}_masked_rows"
                for n in ("raw", "bronze", "silver")), "erased"),
        "masked_row_sample": with_ctes(
            f"SELECT * FROM erased WHERE email = '{ERASED_TOKEN}' ORDER BY event_id LIMIT 10", "erased"),
        "requested_cleartext": with_ctes(
            "SELECT count(*) AS requested_cleartext_rows FROM raw WHERE lower(email) IN "
            "(SELECT lower(subject_email) FROM lreq)", "raw", "lreq"),
        "erase_invariants": invariants_sql(),
        "layer_counts": with_ctes(
            "SELECT 'raw' AS \"table\", count(*) AS rows FROM raw UNION ALL SELECT 'bronze', count(*) FROM raw "
            "UNION ALL SELECT 'silver', count(*) FROM raw WHERE user_id IS NOT NULL "
            "UNION ALL SELECT 'gold', count(DISTINCT user_id) FROM raw", "raw"),
        "queue_snapshot": with_ctes(
            "SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(DISTINCT user_id) FROM raw) AS gold_customers, "
            "(SELECT count(*) FROM queue WHERE status = 'PENDING') AS requests_pending, "
            "(SELECT count(*) FROM queue WHERE status = 'COMPLETE') AS requests_complete", "raw", "queue"),
        "gold_refresh": with_ctes(
            f"SELECT user_id, round(sum(revenue), 2) AS lifetime_revenue, {GOLD} erased GROUP BY user_id", "erased"),
        "indexed_rows": with_ctes(
            "SELECT event_id, user_id FROM raw WHERE user_id IN (SELECT user_id FROM resolved WHERE request_type = 'DELETE')",
            "raw", "resolved"),
        "indexed_files": with_ctes(
            """SELECT count(DISTINCT b) AS files, count(DISTINCT b) FILTER (WHERE asked) AS holding, 0 AS missed FROM (
            SELECT substr(user_id, 2)::BIGINT % 97 AS b, user_id IN (SELECT user_id FROM resolved WHERE request_type = 'DELETE') AS asked
            FROM raw)""", "raw", "resolved"),
        "redact_lines_in_place":
            f"""SELECT event_id, '{{ "event_id" : "E' || event_id::VARCHAR || '",' || chr(9) || '"user_id":"U' || user_id::VARCHAR
            || '","\\u0065mail":"' || e || '" , "ratio":1.50,"email":"' || e || '","profile_json":"{{\\"contact\\":{{\\"email\\": \\"' || e
            || '\\",\\"n\\\\u0061me\\":1,\\"name\\":\\"' || n || '\\"}}}}","tag":"\\u00e9\\/"}}' AS line
            FROM (SELECT event_id, user_id, CASE WHEN user_id % 3 > 0 THEN '{ERASED_TOKEN}' ELSE {_e['email']} END AS e,
                  CASE WHEN user_id % 3 > 0 THEN '{ERASED_TOKEN}' ELSE {_e['full']} END AS n FROM events)""",
        "stream_raw": with_ctes("SELECT * FROM story", "story"),
        "stream_bronze": with_ctes("SELECT * FROM story", "story"),
        "stream_silver": with_ctes("SELECT * EXCLUDE (_ingest_ts) FROM story", "story"),
        "stream_after_erasure": with_ctes("SELECT * FROM first_erased", "first_erased"),
        "stream_full_refresh": with_ctes("SELECT * FROM story", "story"),
        "scrub_files": with_ctes("SELECT * FROM story", "story"),
        "stream_scd1": with_ctes("SELECT * FROM story_latest", "story_latest"),
        "gold_append": with_ctes(
            f"SELECT user_id, round(sum(revenue), 2) AS lifetime_revenue, {GOLD} story GROUP BY user_id", "story"),
        "gold_scd1": with_ctes(
            "SELECT user_id, round(sum(revenue), 2) AS latest_revenue, max(event_ts) AS last_event_ts "
            "FROM story_latest GROUP BY user_id", "story_latest"),
        "landing_counts": with_ctes(
            story_counts("SELECT 'initial' AS folder FROM first_erased UNION ALL "
                         "SELECT 'incremental' FROM raw WHERE event_type = 'error'"), "first_erased"),
        "landing_counts_first": with_ctes(
            story_counts("SELECT 'initial' AS folder FROM raw WHERE event_type <> 'error'"), "raw"),
        "latest_per_user": with_ctes(
            "SELECT * EXCLUDE (rn, event_type) FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
            "ORDER BY _ingest_ts DESC, event_id DESC) AS rn FROM raw) WHERE rn = 1", "raw"),
        "perf_collect": with_ctes("SELECT * FROM timings", "timings"),
        "perf_summary_median": with_ctes(
            """SELECT scale, pattern, variant, round(middle, 0) AS p50_ms, round(middle - base, 0) AS overhead_ms,
            round(100.0::DOUBLE * (middle - base) / nullif(base, 0), 1) AS overhead_pct
            FROM (SELECT *, max(middle) FILTER (WHERE variant = 'baseline') OVER (PARTITION BY scale, pattern) AS base
                  FROM (SELECT scale, pattern, variant, quantile_cont(execution_ms, 0.5) AS middle FROM timings GROUP BY ALL))
            WHERE base IS NOT NULL""", "timings"),
        "perf_summary_best": with_ctes("SELECT * FROM best", "best"),
        "perf_chart_rows": with_ctes("SELECT * FROM best WHERE scale = '100m' AND variant = 'dynamic'", "best"),
        "gen_hits": with_ctes("SELECT * FROM hits", "hits"),
        "gen_user_events": with_ctes("SELECT * FROM raw", "raw"),
        "gen_persons": with_ctes("SELECT * FROM person", "person"),
    }
    for table, name in (("customer_profile", "erase_customer_profile"), ("contact_email_only", "erase_contact"),
                        ("booking", "erase_booking"), ("loyalty_split", "erase_loyalty"), ("app_hits_json", "erase_hits")):
        out[name] = with_ctes(erased_sql(table), "subj", table)
    out["erase_hits_in_place"] = out["erase_hits"]
    out["erase_profile_all_match"] = with_ctes(
        erased_sql("customer_profile", ALL_MATCH), "subj", "customer_profile")
    out["erase_hits_all_match"] = with_ctes(erased_sql("app_hits_json", ALL_MATCH), "subj", "app_hits_json")
    for name in ("mask_policy_dynamic", "mask_sql_function", "mask_materialized"):
        out[name] = out["mask_redact"]
    out.update(bench_oracles())
    return out

"""DuckDB oracle SQL for the registered queries.

The same synthetic lines, parse rules, normalisation, HMAC and classifier
are written here in plain SQL so an independent engine can check every
Spark result.  Only the public fixture keys are used.
"""

from __future__ import annotations

from vigil.functions.digest import TEST_ID_KEY, TEST_SECRET_KEY, HmacKey
from vigil.sources import fixtures

# Written out here and not imported, so that a wrong rule in the engine shows.
# Code points that JavaScript's trim removes.
_TRIMMED = (9, 10, 11, 12, 13, 32, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288, 65279)
_WS = " || ".join(f"chr({c})" for c in _TRIMMED)


def jt(x: str) -> str:
    """JavaScript-style trim."""
    return f"trim({x}, {_WS})"


def hmac_sql(x: str, key: HmacKey) -> str:
    ipad, opad = key.pads()
    return (
        f"sha256(unhex('{opad.hex()}') || unhex(sha256(unhex('{ipad.hex()}') || encode({x}))))"
    )


def norm_a(x: str) -> str:
    e = f"regexp_replace(lower({jt(x)}), '^[^a-z0-9]+', '')"
    at = f"strpos({e}, '@')"
    return (
        f"(CASE WHEN {at} > 1 THEN split_part(substr({e}, 1, {at} - 1), '+', 1) || '@' || "
        f"substr({e}, {at} + 1) ELSE {e} END)"
    )


def norm_b(x: str) -> str:
    return f"split_part(lower({x}), '+', 1)"


def scheme_sql(x: str) -> str:
    p = jt(x)
    rules = (  # fixed values, in match order
        (r"^\$2[aby]\$[0-9]{2}\$[A-Za-z0-9./]{53}\z", "bcrypt"),
        (r"^\$argon2(i|d|id)\$v=[0-9]+\$.*\$.*\$.*\z", "argon2"),
        (r"^\$1\$[^$]+\$[A-Za-z0-9./]+\z", "md5-crypt"),
        (r"^\$5\$[^$]+\$[A-Za-z0-9./]+\z", "sha256-crypt"),
        (r"^\$6\$[^$]+\$[A-Za-z0-9./]+\z", "sha512-crypt"),
        (r"^\{SSHA\}[A-Za-z0-9+/=]+\z", "ssha"),
        (r"^\{SHA\}[A-Za-z0-9+/=]+\z", "sha1-base64"),
        (r"^[A-Fa-f0-9]{32}\z", "md5-hex"),
        (r"^[A-Fa-f0-9]{40}\z", "sha1-hex"),
        (r"^[A-Fa-f0-9]{64}\z", "sha256-hex"),
        (r"^[A-Fa-f0-9]{128}\z", "sha512-hex"),
    )
    return "(CASE " + " ".join(f"WHEN regexp_matches({p}, '{r}') THEN '{n}'" for r, n in rules) + " ELSE 'plaintext' END)"


def scheme_compat_sql(x: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({x}, '^[0-9a-fA-F]{{32}}\\z') THEN 'md5' "
        f"WHEN regexp_matches({x}, '^[0-9a-fA-F]{{40}}\\z') THEN 'sha1' "
        f"WHEN regexp_matches({x}, '^\\$2[aby]\\$') THEN 'bcrypt' ELSE 'plaintext' END)"
    )


def _s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _shape_case() -> str:
    parts = []
    for et, (first, delim, second, tail) in fixtures.SHAPES.items():
        tail_sql = f" || '{tail}'" if tail else ""
        parts.append(f"WHEN '{et}' THEN {first} || '{delim}' || {second}{tail_sql}")
    return "CASE event_type " + " ".join(parts) + " END"


_ADDR = f"'user' || {_s('u')} || '@mail' || {_s('u % 9')} || '.example.com'"

LINES_CTE = f"""
ev AS (
  SELECT event_id, user_id AS u, event_type,
         CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS BIGINT) AS line_no
  FROM events
),
fx AS (
  SELECT '/syn/' || event_type || '.txt' AS source, line_no, event_id, u, event_type,
    CASE event_id % 4
      WHEN 0 THEN {_ADDR}
      WHEN 1 THEN 'User' || {_s('u')} || '+t' || {_s('event_id % 3')} || '@Mail' || {_s('u % 9')} || '.example.com'
      WHEN 2 THEN '--USER' || {_s('u')} || '@MAIL' || {_s('u % 9')} || '.EXAMPLE.COM'
      ELSE '"user' || {_s('u')} || '@mail' || {_s('u % 9')} || '.example.com' END AS ident,
    CASE event_id % 12
      WHEN 0 THEN 'pw' || {_s('event_id % 50')}
      WHEN 1 THEN md5('s' || {_s('u')})
      WHEN 2 THEN upper(sha1('s' || {_s('u')}))
      WHEN 3 THEN '$2b$10$' || md5('a' || {_s('u')}) || substr(md5('b' || {_s('u')}), 1, 21)
      WHEN 4 THEN md5('a' || {_s('u')}) || md5('b' || {_s('u')})
      WHEN 5 THEN '{{SHA}}' || substr(md5('s' || {_s('u')}), 1, 27) || '='
      WHEN 6 THEN '$argon2id$v=19$m=65536,t=2,p=1$' || substr(md5('a' || {_s('u')}), 1, 16) || '$' || md5('b' || {_s('u')})
      WHEN 7 THEN '$1$' || substr(md5('a' || {_s('u')}), 1, 8) || '$' || substr(md5('b' || {_s('u')}), 1, 22)
      WHEN 8 THEN '$5$' || substr(md5('a' || {_s('u')}), 1, 16) || '$' || md5('b' || {_s('u')})
      WHEN 9 THEN '$6$' || substr(md5('a' || {_s('u')}), 1, 16) || '$' || md5('a' || {_s('u')}) || md5('b' || {_s('u')})
      WHEN 10 THEN '{{SSHA}}' || substr(md5('s' || {_s('u')}), 1, 30) || '=='
      ELSE md5('a' || {_s('u')}) || md5('b' || {_s('u')}) || md5('s' || {_s('u')}) || md5('a' || {_s('u')}) END AS secret
  FROM ev
),
shaped AS (
  SELECT source, line_no, event_id, u, event_type, {_shape_case()} AS line FROM fx
),
raw_lines AS (
  SELECT source, line_no, event_id, u, event_type,
    CASE WHEN line_no > 2 AND event_id % 97 = 0 THEN ''
         WHEN line_no > 2 AND event_id % 97 = 1 THEN line || ':extra:x'
         WHEN line_no > 2 AND event_id % 97 = 2 THEN chr(7) || line
         WHEN line_no > 2 AND event_id % 97 = 3 THEN ':'
         WHEN line_no > 2 AND event_id % 97 = 4 THEN rpad(line, 5000, 'x')
         ELSE line END AS line
  FROM shaped
  UNION ALL
  SELECT '{fixtures.SOLO_SOURCE}', CAST(1 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
         CAST(NULL AS VARCHAR), '{fixtures.SOLO_LINE}'
  UNION ALL SELECT '/syn/blank.txt', CAST(1 AS BIGINT), NULL, NULL, NULL, ''
  UNION ALL SELECT '/syn/blank.txt', CAST(2 AS BIGINT), NULL, NULL, NULL, '  '
)"""

LAYOUT_CTE = f"""
nb AS (
  SELECT source, line_no, {jt('line')} AS l FROM raw_lines WHERE {jt('line')} <> ''
),
r2 AS (
  SELECT source, l, CASE WHEN contains(l, ':') THEN ':' WHEN contains(l, ';') THEN ';' ELSE ' ' END AS d
  FROM (SELECT source, l, row_number() OVER (PARTITION BY source ORDER BY line_no) AS rn FROM nb)
  WHERE rn = 2
),
layout0 AS (
  SELECT s.source, r2.d AS delim, r2.l AS l,
    CASE WHEN r2.source IS NULL THEN 'undetectable'
         WHEN len(string_split(r2.l, r2.d)) > 2 THEN 'record2_fields' ELSE 'ok' END AS status
  FROM (SELECT DISTINCT source FROM raw_lines) s LEFT JOIN r2 ON s.source = r2.source
),
layout AS (
  SELECT source, delim,
    CASE WHEN status = 'ok' THEN regexp_matches({jt("split_part(l, delim, 1)")}, '\\S+@\\S+\\.\\S+') END AS email_first,
    status
  FROM layout0
)"""

PARSE_CTE = f"""
pj AS (
  SELECT r.source, r.line_no, r.line, l.delim, l.email_first, l.status,
         {jt("regexp_replace(r.line, '[\\x00-\\x1f\\x7f]', '', 'g')")} AS clean
  FROM raw_lines r JOIN layout l ON r.source = l.source
),
pk AS (
  SELECT *, CASE WHEN status = 'ok' THEN string_split(clean, delim) END AS parts
  FROM pj WHERE CASE WHEN status = 'ok' THEN clean <> '' ELSE {jt('line')} <> '' END
),
pf AS (
  SELECT source, line_no, status, len(parts) AS n,
    CASE WHEN email_first THEN {jt('parts[1]')} ELSE {jt('parts[2]')} END AS ident,
    CASE WHEN email_first THEN {jt('parts[2]')} ELSE {jt('parts[1]')} END AS secret
  FROM pk
),
parsed AS (
  SELECT source, line_no,
    CASE WHEN status = 'ok' THEN ident END AS ident,
    CASE WHEN status = 'ok' THEN secret END AS secret,
    CASE WHEN status = 'ok' THEN 'line' ELSE 'file' END AS scope,
    CASE WHEN status <> 'ok' THEN status
         WHEN n <> 2 THEN 'field_count'
         WHEN ident = '' OR secret = '' THEN 'empty_field'
         WHEN length(ident) + length(secret) + length(source) > 4000 THEN 'oversize' END AS reason
  FROM pf
),
prot AS (
  SELECT {hmac_sql(norm_a('ident'), TEST_ID_KEY)} AS id_digest,
         {hmac_sql('secret', TEST_SECRET_KEY)} AS secret_digest,
         {scheme_sql('secret')} AS hash_type,
         source, line_no, ident
  FROM parsed WHERE reason IS NULL
),
protected AS (
  SELECT id_digest, secret_digest, hash_type <> 'plaintext' AS is_hash, hash_type, source,
         substr(id_digest, 1, 2) AS p2, substr(id_digest, 1, 4) AS p4, line_no
  FROM prot
)"""

FIRST_COLON_CTE = f"""
fc AS (
  SELECT source, line_no, line, strpos(line, ':') AS sep FROM raw_lines WHERE length(line) > 0
),
fparsed AS (
  SELECT source, line_no,
    CASE WHEN sep >= 2 THEN substr(line, 1, sep - 1) END AS ident,
    CASE WHEN sep >= 2 THEN substr(line, sep + 1) END AS secret,
    'line' AS scope,
    CASE WHEN sep < 2 THEN 'no_separator'
         WHEN NOT contains({jt("lower(substr(line, 1, sep - 1))")}, '@') THEN 'no_at' END AS reason
  FROM fc
),
fprotected AS (
  SELECT {hmac_sql(norm_a('ident'), TEST_ID_KEY)} AS id_digest,
         {hmac_sql('secret', TEST_SECRET_KEY)} AS secret_digest,
         {scheme_sql('secret')} AS hash_type, source, line_no
  FROM fparsed WHERE reason IS NULL
)"""

WATCH_CTE = f"""
watch_addr AS (
  SELECT DISTINCT 'user' || {_s('user_id')} || '@mail' || {_s('user_id % 9')} || '.example.com' AS address
  FROM events WHERE user_id % 10 = 0
  UNION ALL SELECT * FROM (VALUES {", ".join(f"('{a}')" for a in fixtures.UNSEEN_ADDRESSES)}) t(address)
),
watchlist AS (
  SELECT DISTINCT {hmac_sql(norm_a('address'), TEST_ID_KEY)} AS id_digest FROM watch_addr
)"""

ROOTS_CTE = """
root1 AS (SELECT * EXCLUDE (line_no) FROM protected WHERE line_no % 3 <> 0),
root2 AS (SELECT * EXCLUDE (line_no) FROM protected WHERE line_no % 3 <> 1),
roots AS (SELECT * FROM root1 UNION ALL SELECT * FROM root2)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE = (LINES_CTE, LAYOUT_CTE, PARSE_CTE)

_STATUS_CTE = """, files AS (
  SELECT source, count(*) AS n_lines,
    CASE regexp_extract(source, '([a-z]+)[.]txt$', 1) WHEN 'view' THEN 'done' WHEN 'click' THEN 'done'
      WHEN 'solo' THEN 'rejected' WHEN 'error' THEN 'in-progress' WHEN 'signup' THEN 'in-progress' ELSE 'new' END AS prior_status
  FROM raw_lines GROUP BY source)"""

_K_CASE = "CASE l.source " + " ".join(
    f"WHEN '/syn/{n}.txt' THEN {k}" for n, k in zip(sorted(fixtures.SHAPES), fixtures.RUN_K_TENTHS)
) + " ELSE 10 END"

ORACLE_SQL: dict[str, str] = {
    "layout_inference": _with(LINES_CTE, LAYOUT_CTE)
    + " SELECT source, delim, email_first, status FROM layout",
    "parse_detected_rejects": _with(*BASE)
    + " SELECT source, scope, coalesce(reason, 'accepted') AS reason, count(*) AS n"
    " FROM parsed GROUP BY ALL",
    "parse_first_colon_counts": _with(LINES_CTE, FIRST_COLON_CTE)
    + " SELECT source, scope, coalesce(reason, 'accepted') AS reason, count(*) AS n"
    " FROM fparsed GROUP BY ALL",
    "normalise_compare": _with(*BASE)
    + f""" SELECT source, count(*) AS n_rows,
      CAST(sum(CASE WHEN {norm_a('ident')} <> {norm_b('ident')} THEN 1 ELSE 0 END) AS BIGINT) AS n_differ,
      count(DISTINCT {norm_a('ident')}) AS n_ids_a,
      count(DISTINCT {norm_b('ident')}) AS n_ids_b
    FROM parsed WHERE reason IS NULL GROUP BY source""",
    "id_digest": _with(*BASE) + " SELECT id_digest, count(*) AS n_lines FROM protected GROUP BY id_digest",
    "scheme_profile": _with(*BASE)
    + " SELECT source, hash_type, is_hash, count(*) AS n_records, count(DISTINCT id_digest) AS n_ids"
    " FROM protected GROUP BY ALL",
    "scheme_profile_compat": _with(*BASE)
    + f""" SELECT source, {scheme_compat_sql('secret')} AS hash_type, count(*) AS n_records,
      count(DISTINCT {hmac_sql(norm_b('ident'), TEST_ID_KEY)}) AS n_ids
    FROM parsed WHERE reason IS NULL GROUP BY ALL""",
    "shard_histogram": _with(*BASE)
    + " SELECT p2, count(*) AS n_records, count(DISTINCT p4) AS n_prefixes,"
    " count(DISTINCT id_digest) AS n_ids FROM protected GROUP BY p2",
    "dedupe_distinct": _with(*BASE)
    + " SELECT id_digest, secret_digest, source, min(line_no) AS first_line, min(hash_type) AS hash_type,"
    " count(*) AS copies FROM protected GROUP BY id_digest, secret_digest, source",
    "insert_if_absent": _with(*BASE)
    + """ SELECT DISTINCT b.id_digest, b.secret_digest, b.source, b.hash_type, b.is_hash
    FROM protected b
    WHERE NOT EXISTS (SELECT 1 FROM protected t WHERE t.line_no % 2 = 0 AND t.id_digest = b.id_digest
                      AND t.secret_digest = b.secret_digest AND t.source = b.source)""",
    "merge_roots": _with(*BASE, ROOTS_CTE)
    + " SELECT id_digest, secret_digest, source, min(hash_type) AS hash_type, count(*) AS copies"
    " FROM roots GROUP BY id_digest, secret_digest, source",
    "pending_files": _with(LINES_CTE)
    + _STATUS_CTE
    + """ SELECT source, prior_status, n_lines FROM files WHERE prior_status NOT IN ('done', 'rejected')""",
    "progress_summary": _with(LINES_CTE)
    + _STATUS_CTE
    + """ SELECT count(*) AS n_files,
      count(*) FILTER (prior_status IN ('done', 'rejected')) AS n_done,
      count(*) FILTER (prior_status = 'in-progress') AS n_in_progress,
      count(*) FILTER (prior_status NOT IN ('done', 'rejected')) AS n_pending
    FROM files""",
    "exposure_check": _with(*BASE, WATCH_CTE)
    + """, hits AS (
      SELECT id_digest, count(*) AS n_records, count(DISTINCT source) AS n_sources,
             string_agg(DISTINCT hash_type, ',' ORDER BY hash_type) AS schemes
      FROM protected WHERE id_digest IN (SELECT id_digest FROM watchlist) GROUP BY id_digest)
    SELECT w.id_digest, coalesce(h.n_records, 0) AS n_records, coalesce(h.n_sources, 0) AS n_sources,
           h.schemes, h.n_records IS NOT NULL AS exposed
    FROM watchlist w LEFT JOIN hits h ON w.id_digest = h.id_digest""",
    "prefix_range": _with(*BASE, WATCH_CTE)
    + """, req AS (SELECT DISTINCT substr(id_digest, 1, 4) AS p4 FROM watchlist),
    hits AS (
      SELECT p4, id_digest, count(*) AS n_records FROM protected WHERE p4 IN (SELECT p4 FROM req)
      GROUP BY p4, id_digest),
    sized AS (SELECT p4, count(*) AS ids FROM hits GROUP BY p4)
    SELECT h.p4 AS prefix, substr(h.id_digest, 5, 60) AS suffix, h.n_records, false AS suppressed
    FROM hits h JOIN sized s ON h.p4 = s.p4 WHERE s.ids >= 2
    UNION ALL
    SELECT r.p4 AS prefix, CAST(NULL AS VARCHAR) AS suffix, CAST(NULL AS BIGINT) AS n_records, true AS suppressed
    FROM req r LEFT JOIN sized s ON r.p4 = s.p4 WHERE coalesce(s.ids, 0) < 2""",
    "constraint_audit": _with(*BASE, ROOTS_CTE)
    + """, per_key AS (
      SELECT count(*) AS c,
        sum(CASE WHEN id_digest IS NULL OR secret_digest IS NULL OR is_hash IS NULL OR hash_type IS NULL
                   OR source IS NULL OR p2 IS NULL OR p4 IS NULL THEN 1 ELSE 0 END) AS nn,
        sum(CASE WHEN coalesce(regexp_matches(id_digest, '^[0-9a-f]{64}\\z'), false) THEN 0 ELSE 1 END) AS bi,
        sum(CASE WHEN coalesce(regexp_matches(secret_digest, '^[0-9a-f]{64}\\z'), false) THEN 0 ELSE 1 END) AS bs,
        sum(CASE WHEN coalesce(p2 = substr(id_digest, 1, 2) AND p4 = substr(id_digest, 1, 4), false)
                 THEN 0 ELSE 1 END) AS bsh,
        sum(CASE WHEN coalesce(is_hash = (hash_type <> 'plaintext'), false) THEN 0 ELSE 1 END) AS bf,
        sum(CASE WHEN hash_type IN ('argon2','bcrypt','md5','md5-crypt','md5-hex','plaintext','sha1',
                   'sha1-base64','sha1-hex','sha256-crypt','sha256-hex','sha512-crypt','sha512-hex','ssha')
                 THEN 0 ELSE 1 END) AS bu
      FROM roots GROUP BY id_digest, secret_digest, source)
    SELECT CAST(sum(c) AS BIGINT) AS n_rows,
      CAST(sum(CASE WHEN c > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_dup_keys,
      CAST(sum(CASE WHEN c > 1 THEN c - 1 ELSE 0 END) AS BIGINT) AS n_dup_rows,
      CAST(sum(nn) AS BIGINT) AS n_null_rows, CAST(sum(bi) AS BIGINT) AS n_bad_id_digest,
      CAST(sum(bs) AS BIGINT) AS n_bad_secret_digest, CAST(sum(bsh) AS BIGINT) AS n_bad_shard,
      CAST(sum(bf) AS BIGINT) AS n_bad_hash_flag, CAST(sum(bu) AS BIGINT) AS n_unknown_scheme
    FROM per_key""",
    "schema_audit": _with(*BASE)
    + """, expected AS (
      SELECT *, false AS expected_nullable FROM (VALUES ('id_digest', 'string'), ('secret_digest', 'string'),
        ('is_hash', 'boolean'), ('hash_type', 'string'), ('source', 'string'), ('p2', 'string'), ('p4', 'string'))
        t(column_name, expected_type)),
    actual AS (
      SELECT * FROM (VALUES ('id_digest', 'string'), ('secret_digest', 'string'), ('is_hash', 'boolean'),
        ('hash_type', 'string'), ('source', 'string'), ('p2', 'string'), ('p4', 'string'), ('seq', 'bigint'))
        t(column_name, actual_type)),
    nulls AS (
      SELECT * FROM (
        SELECT count(*) - count(id_digest) AS id_digest, count(*) - count(secret_digest) AS secret_digest,
          count(*) - count(is_hash) AS is_hash, count(*) - count(hash_type) AS hash_type,
          count(*) - count(source) AS source, count(*) - count(p2) AS p2, count(*) - count(p4) AS p4,
          count(*) - count(line_no) AS seq
        FROM protected) UNPIVOT (n_nulls FOR column_name IN (id_digest, secret_digest, is_hash, hash_type,
          source, p2, p4, seq)))
    SELECT coalesce(e.column_name, a.column_name) AS column_name, e.expected_type, a.actual_type, e.expected_nullable,
      CASE WHEN a.actual_type IS NULL THEN 'missing' WHEN e.expected_type IS NULL THEN 'unexpected'
           WHEN e.expected_type <> a.actual_type THEN 'type_mismatch'
           WHEN NOT e.expected_nullable AND n.n_nulls > 0 THEN 'has_nulls' ELSE 'ok' END AS status,
      CAST(n.n_nulls AS BIGINT) AS n_nulls
    FROM expected e FULL OUTER JOIN actual a ON e.column_name = a.column_name
    LEFT JOIN nulls n ON n.column_name = coalesce(e.column_name, a.column_name)""",
    "run_grades": _with(*BASE)
    + f""", l AS (
      SELECT s.source, count(p.source) FILTER (p.reason IS NULL) AS loaded,
        count(p.source) FILTER (p.reason IS NOT NULL) AS rejected
      FROM (SELECT DISTINCT source FROM raw_lines) s LEFT JOIN parsed p ON p.source = s.source GROUP BY s.source),
    metrics AS (SELECT l.*, CAST(floor(l.loaded * ({_K_CASE}) / 10.0) AS BIGINT) AS elapsed_ms FROM l),
    rated AS (SELECT *, CASE WHEN loaded > 0 THEN (elapsed_ms / 60000.0) / (loaded / 1e6) ELSE 0.0 END AS rate FROM metrics)
    SELECT source, loaded, rejected, elapsed_ms, round(rate, 1) AS min_per_million,
      CASE WHEN rate <= 30 THEN 'good' WHEN rate <= 40 THEN 'acceptable' ELSE 'poor' END AS grade,
      rate > 45 AS alert
    FROM rated""",
    "legacy_protect": _with(LINES_CTE, FIRST_COLON_CTE)
    + """, tagged AS (
      SELECT *, '/legacy/' || regexp_extract(source, '([^/]*)$', 1) || '.jsonl.gz' AS root_file,
        line_no % 97 IN (5, 6) AS bad,
        CASE WHEN line_no % 97 = 8 THEN regexp_extract(source, '([^/]*)$', 1) || '.jsonl' ELSE source END AS named
      FROM fprotected)
    SELECT 'protected' AS outcome, root_file, named AS source, hash_type, count(*) AS n_records, count(DISTINCT id_digest) AS n_ids
    FROM tagged WHERE NOT bad GROUP BY root_file, named, hash_type
    UNION ALL
    SELECT 'malformed', root_file, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), count(*), 0
    FROM tagged WHERE bad GROUP BY root_file""",
    "stream_resume": _with(*BASE)
    + """, once AS (SELECT DISTINCT id_digest, secret_digest, hash_type, source FROM protected)
    SELECT regexp_extract(source, '([a-z]+)[.]txt$', 1) AS name, hash_type, count(*) AS n_records, count(DISTINCT id_digest) AS n_ids
    FROM once GROUP BY ALL""",
    "replay_direct_load": _with(*BASE)
    + " SELECT source, hash_type, count(*) AS n_records FROM protected GROUP BY ALL",
    "maintained_load": _with(*BASE)
    + """ SELECT source, CAST(1 AS BIGINT) AS version, count(DISTINCT id_digest || secret_digest) AS n_records
    FROM protected GROUP BY source""",
    "csv_roundtrip": _with(*BASE)
    + """ SELECT '/d/a "q", b\\''s/' || regexp_extract(source, '([^/]*)$', 1) AS source, is_hash, hash_type,
      count(*) AS n_records, count(*) AS n_whole FROM protected GROUP BY ALL""",
    "file_roundtrip": _with(LINES_CTE, FIRST_COLON_CTE)
    + """ SELECT regexp_extract(source, '^/syn/(.*)[.]txt$', 1) AS name, count(*) AS n_records,
      count(DISTINCT id_digest) AS n_ids
    FROM fprotected GROUP BY 1""",
}
ORACLE_SQL["stored_prefix_range"] = ORACLE_SQL["prefix_range"]
ORACLE_SQL["scheme_rollup"] = _with(*BASE) + """ SELECT source, hash_type, CAST(grouping(source, hash_type) AS BIGINT) AS level,
      count(*) AS n_records, count(DISTINCT id_digest) AS n_ids, count(*) FILTER (NOT is_hash) AS n_not_hashed,
      round(count(*) FILTER (NOT is_hash) / count(*), 6) AS share_not_hashed
    FROM protected GROUP BY GROUPING SETS ((source, hash_type), (source), (hash_type), ())"""
ORACLE_SQL["crash_and_replay"] = _with(*BASE) + """, once AS (SELECT DISTINCT id_digest, secret_digest, hash_type, source FROM protected)
    SELECT regexp_extract(source, '([a-z]+)[.]txt$', 1) AS name,
      CAST(CASE WHEN source IN ('/syn/view.txt', '/syn/click.txt') THEN 1 ELSE 2 END AS BIGINT) AS batch_id,
      hash_type, count(*) AS n_records, CAST(0 AS BIGINT) AS n_seen_before_commit
    FROM once GROUP BY ALL"""
ORACLE_SQL["tiered_maintenance"] = _with(LINES_CTE, FIRST_COLON_CTE) + """, upto AS (
      SELECT v.version, count(DISTINCT (id_digest, secret_digest, source)) AS n
      FROM fprotected JOIN (VALUES (1), (2), (3), (4)) v(version) ON line_no % 4 < v.version GROUP BY v.version)
    SELECT CAST(u.version AS BIGINT) AS version, t.level, t.n_runs, CAST(u.n - coalesce(w.n, 0) AS BIGINT) AS rewritten,
      u.n AS n_merged, (SELECT max(n) FROM upto) AS n_stored_at_last
    FROM upto u JOIN (VALUES (1, 1, 1, 0), (2, 2, 1, 0), (3, 1, 2, 2), (4, 3, 1, 0)) t(version, level, n_runs, without) ON t.version = u.version
    LEFT JOIN upto w ON w.version = t.without"""
ORACLE_SQL["stored_insert"] = _with(LINES_CTE, FIRST_COLON_CTE) + """ SELECT DISTINCT id_digest, secret_digest, source, hash_type FROM fprotected b
    WHERE NOT EXISTS (SELECT 1 FROM fprotected t WHERE t.line_no % 2 = 0 AND t.id_digest = b.id_digest
                      AND t.secret_digest = b.secret_digest AND t.source = b.source)"""
ORACLE_SQL["stored_check"] = _with(LINES_CTE, FIRST_COLON_CTE, WATCH_CTE) + """, once AS (
      SELECT DISTINCT id_digest, secret_digest, source, hash_type FROM fprotected),
    hits AS (
      SELECT id_digest, count(*) AS n_records, count(DISTINCT source) AS n_sources,
             string_agg(DISTINCT hash_type, ',' ORDER BY hash_type) AS schemes
      FROM once WHERE id_digest IN (SELECT id_digest FROM watchlist) GROUP BY id_digest)
    SELECT w.id_digest, coalesce(h.n_records, 0) AS n_records, coalesce(h.n_sources, 0) AS n_sources,
           h.schemes, h.n_records IS NOT NULL AS exposed
    FROM watchlist w LEFT JOIN hits h ON w.id_digest = h.id_digest"""
ORACLE_SQL["resumed_merge"] = _with(*BASE, ROOTS_CTE) + (
    " SELECT id_digest, secret_digest, source, min(hash_type) AS hash_type FROM roots GROUP BY id_digest, secret_digest, source"
)
ORACLE_SQL["observed_metrics"] = _with(*BASE) + """ SELECT load, count(*) FILTER (reason IS NULL) AS loaded, count(*) FILTER (reason IS NOT NULL) AS rejected
    FROM parsed, (VALUES ('batch'), ('stream')) l(load) GROUP BY load"""
_KEY, _ALL = "1,2,5", "1,2,3,4,5,6,7"  # columns by place
ORACLE_SQL["catalog_audit"] = f"""
    WITH columns_ AS (SELECT * FROM (VALUES ('id_digest', 'string'), ('secret_digest', 'string'), ('is_hash', 'boolean'),
        ('hash_type', 'string'), ('source', 'string'), ('p2', 'string'), ('p4', 'string')) t(c, kind)),
    items AS (
      SELECT 'column ' || c AS item, kind AS expected FROM columns_
      UNION ALL SELECT 'constraint vigil.not_null', '{_ALL}' UNION ALL SELECT 'constraint vigil.unique', '{_KEY}')
    SELECT 'right' AS table_name, item, expected, expected AS actual, 'ok' AS status FROM items
    UNION ALL SELECT 'wrong', item, expected,
      CASE item WHEN 'column is_hash' THEN 'string' WHEN 'constraint vigil.not_null' THEN '1'
        WHEN 'column p4' THEN NULL WHEN 'constraint vigil.unique' THEN NULL ELSE expected END,
      CASE WHEN item IN ('column is_hash', 'constraint vigil.not_null') THEN 'mismatch'
        WHEN item IN ('column p4', 'constraint vigil.unique') THEN 'missing' ELSE 'ok' END FROM items
    UNION ALL SELECT 'wrong', 'column seq', NULL, 'bigint', 'unexpected'
    UNION ALL SELECT 'absent', 'table', 'present', NULL, 'missing_table'"""
# batches 0 and 1 become runs without repeats, batch 2 stays as loaded, batch 3 adds what is absent
ORACLE_SQL["incremental_profile"] = _with(LINES_CTE, FIRST_COLON_CTE) + """, held AS (
      SELECT DISTINCT id_digest, secret_digest, source, hash_type FROM fprotected WHERE line_no % 4 < 2
      UNION ALL SELECT id_digest, secret_digest, source, hash_type FROM fprotected WHERE line_no % 4 = 2),
    added AS (
      SELECT * FROM held
      UNION ALL SELECT DISTINCT id_digest, secret_digest, source, hash_type FROM fprotected f
      WHERE line_no % 4 = 3 AND NOT EXISTS (SELECT 1 FROM held h WHERE h.id_digest = f.id_digest
        AND h.secret_digest = f.secret_digest AND h.source = f.source))
    SELECT source, hash_type, hash_type <> 'plaintext' AS is_hash, count(*) AS n_records, count(DISTINCT id_digest) AS n_ids
    FROM added GROUP BY ALL"""
ORACLE_SQL["bucketed_insert"] = _with(*BASE) + """ SELECT id_digest, secret_digest, source, min(hash_type) AS hash_type,
      1 + count(*) FILTER (line_no % 2 = 1) AS copies
    FROM protected GROUP BY id_digest, secret_digest, source"""
ORACLE_SQL["numbered_ids"] = _with(*BASE) + """ SELECT row_number() OVER (ORDER BY id_digest) AS id, id_digest, count(*) AS n_lines
    FROM protected GROUP BY id_digest"""
_ONCE = """, once AS (SELECT DISTINCT id_digest, secret_digest, hash_type, source FROM protected)
    SELECT regexp_extract(source, '([a-z]+)[.]txt$', 1) AS name, hash_type, count(*) AS n_records, count(DISTINCT id_digest) AS n_ids"""
ORACLE_SQL["sliced_load"] = _with(*BASE) + _ONCE + ", CAST(2 AS BIGINT) AS most_files, CAST(0 AS BIGINT) AS n_left FROM once GROUP BY ALL"
ORACLE_SQL["stopped_stream"] = _with(*BASE) + _ONCE + ", true AS stopped, CAST(2 AS BIGINT) AS most_files FROM once GROUP BY ALL"
ORACLE_SQL["head_layouts"] = _with(LINES_CTE, LAYOUT_CTE) + (
    " SELECT regexp_extract(source, '([a-z]+)[.]txt$', 1) AS name, delim, email_first, status FROM layout"
)
ORACLE_SQL["stored_sizes"] = _with(LINES_CTE) + """, sized AS (
      SELECT root, regexp_extract(source, '([a-z]+)[.]txt$', 1) AS name, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes
      FROM raw_lines JOIN (VALUES ('a', 0), ('b', 1)) r(root, k) ON line_no % 3 <> k GROUP BY ALL)
    SELECT root, name, '/merged/name=' || name AS destination, bytes,
      CASE WHEN bytes >= 1073741824 THEN format('{:,.1f} GB', bytes / 1073741824)
           WHEN bytes >= 1048576 THEN format('{:,.1f} MB', bytes / 1048576)
           WHEN bytes >= 1024 THEN format('{:,.1f} kB', bytes / 1024) ELSE bytes || ' bytes' END AS size
    FROM sized"""

"""The registered queries once more, as DuckDB statements.

Written by hand from the description of each operator. Only word lists and
patterns are shared with the Spark side; no statement is derived from it.
"""

from __future__ import annotations

from voxsift import fixed_values as fv, vocabulary as words

from .spine import _LONG, _PADDING


# --- literals -------------------------------------------------------------------
def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _draw(purpose: str, key: str = "key") -> str:
    return f"('0x' || substr(md5(({key})::VARCHAR || ':{purpose}'), 1, 8))::BIGINT"


def _pick(values, purpose: str, key: str = "key") -> str:
    return f"({_list(values)})[1 + {_draw(purpose, key)} % {len(values)}]"


def _pick_by_label(values: dict, purpose: str) -> str:
    cases = " ".join(f"WHEN {_q(k)} THEN {_pick(v, purpose)}" for k, v in values.items())
    return f"CASE label {cases} END"


def _fill(template: str, slots: dict[str, str]) -> str:
    for name, value in slots.items():
        template = f"replace({template}, '{{{name}}}', {value})"
    return template


def _has(text: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({text}, {_q(p)})" for p in phrases) + ")"


def _votes(text: str, phrases) -> str:
    return "(" + " + ".join(f"contains({text}, {_q(p)})::INT" for p in phrases) + ")"


WS = " || ".join(f"chr({ord(c)})" for c in fv.WHITESPACE)
CAT, PRI = _in(fv.CATEGORIES), _in(fv.PRIORITIES)


def _strip(text: str) -> str:
    return f"coalesce(trim({text}, {WS}), '')"


_SLOTS = {
    "action": _pick(words.ACTIONS, "action"), "device": _pick(words.DEVICES, "device"),
    "os": _pick(words.OS_VERSIONS, "os"), "version": _pick(words.VERSIONS, "version"),
    "station": _pick(words.STATIONS, "station"), "feature": _pick(words.FEATURES, "feature"),
    "url": _pick(words.SPAM_LINKS, "url"), "part": _pick(words.PARTS, "part"),
    "rides": f"({_draw('rides')} % {words.MAX_RIDES} + 1)::VARCHAR",
    "name": _pick(words.FIRST_NAMES, "first") + " || ' ' || " + _pick(words.LAST_NAMES, "last"),
}
_REVIEW_TEXT = _fill(_pick_by_label(words.REVIEW_TEMPLATES, "tmpl"), _SLOTS)
_EMAIL_BODY = _fill(_pick_by_label(words.EMAIL_BODIES, "tmpl"), _SLOTS)
_EMAIL_SUBJECT = _pick_by_label(words.EMAIL_SUBJECTS, "subject")

# --- items ------------------------------------------------------------------------
ITEMS = f"""
keyed AS (
  SELECT o_orderkey AS key, o_orderdate AS ordered,
         CASE WHEN o_orderkey % 3 = 0 THEN 'email' ELSE 'review' END AS source_type,
         {_draw('category', 'o_orderkey')} % 100 AS u
  FROM orders),
labelled AS (
  SELECT *, CASE
      WHEN source_type = 'email' THEN CASE WHEN u < 60 THEN 'Bug' ELSE 'Feature Request' END
      WHEN u < 30 THEN 'Bug' WHEN u < 55 THEN 'Feature Request'
      WHEN u < 75 THEN 'Praise' WHEN u < 90 THEN 'Complaint' ELSE 'Spam' END AS label,
    CASE WHEN source_type = 'email' THEN printf('EML%05d', key) ELSE printf('REV%05d', key) END AS source_id
  FROM keyed),
items AS (
  SELECT key, source_id, source_type, label,
    CASE WHEN source_type = 'email' THEN {_EMAIL_SUBJECT} || chr(10) || chr(10) || {_EMAIL_BODY}
         ELSE {_REVIEW_TEXT} END AS text,
    'run-' || strftime(ordered, '%Y%m') AS run_id,
    date_trunc('month', ordered)::TIMESTAMP AS run_at,
    ordered + to_seconds({_draw('sec')} % 86400) AS processed_at
  FROM labelled)"""

# --- recorded responses ---------------------------------------------------------------
_OS = _pick(words.OS_VERSIONS, "os")
_BUG_START = (
    f"""'{{"platform": "' || {_OS} || '", "os_version": "' || split_part({_OS}, ' ', 2) || """
    f"""'", "steps_to_reproduce": "Try to ' || {_pick(words.ACTIONS, 'action')} || '"'"""
)
_FEATURE_START = f"""'{{"feature_description": "Offer ' || {_pick(words.FEATURES, 'feature')} || '"'"""
_TITLE = (
    f"CASE WHEN label = 'Feature Request' THEN 'Add ' || {_pick(words.FEATURES, 'feature')} "
    f"ELSE 'Investigate why users cannot ' || {_pick(words.ACTIONS, 'action')} END "
    f"|| CASE WHEN {_draw('long')} % 100 < 5 THEN {_q(_LONG)} ELSE '' END"
)
_GOOD_DRAFT = (
    f"""'{{"title": "' || {_TITLE} || '", "description": "**Summary:** ' || {_TITLE} || """
    """'.\\n**Details:** From source ' || source_id || '.\\n**User Impact:** Daily work is affected."}'"""
)


def _critic(n: int) -> str:
    r = f"{_draw(f'verdict{n}')} % 100"
    return f"""CASE WHEN {r} < 10 THEN 'no verdict'
      WHEN {r} < 15 THEN '{{"passed": false, "issues": ["Title too generic"]}}'
      WHEN {r} < 20 THEN '{{"passed": true, "issues": ["Wording", "Length"]}}'
      ELSE '{{"passed": true, "issues": []}}' END"""


def _draft(n: int) -> str:
    r = f"{_draw(f'draft{n}')} % 100"
    short, broken = (15, 17) if n == 1 else (20, 20)
    return f"""CASE WHEN {r} < {short} THEN '{{"title": "Fix bug", "description": "Too short"}}'
      WHEN {r} < {broken} THEN 'sorry, no ticket' ELSE {_GOOD_DRAFT} END"""


_R, _B, _F = (f"{_draw(p)} % 100" for p in ("resp", "bugresp", "featresp"))
RESPONSES = f"""
responses AS (
  SELECT source_id, 'classifier' AS stage, 1 AS attempt, CASE
      WHEN {_R} < 2 THEN 'no json here'
      WHEN {_R} < 4 THEN '{{"category": "' || label || '"}}'
      WHEN {_R} < 10 THEN '```json' || chr(10) || '{{"category": "' || label || '", "confidence": 0.9}}' || chr(10) || '```'
      WHEN {_R} < 12 THEN '{{"category": "Other", "confidence": 0.8}}'
      WHEN {_R} < 14 THEN '{{"category": "' || label || '", "confidence": 1.5}}'
      WHEN {_R} < 16 THEN '{{"category": "' || label || '", "confidence": -0.3}}'
      ELSE 'My answer: {{"category": "' || label || '", "confidence": 0.' || (50 + {_draw('conf')} % 50)::VARCHAR || '}}'
    END AS raw FROM labelled
  UNION ALL
  SELECT source_id, 'bug', 1, CASE
      WHEN {_B} < 4 THEN {_BUG_START} || ', "severity": "Unknown"}}'
      WHEN {_B} < 6 THEN {_BUG_START} || '}}'
      WHEN {_B} < 10 THEN '{{"platform": "Unknown", "os_version": "Unknown", "steps_to_reproduce": "Not specified", "severity": "Low"}}'
      ELSE {_BUG_START} || ', "severity": "' || {_pick(fv.SEVERITIES, 'sev')} || '"}}' END
    FROM labelled WHERE label = 'Bug'
  UNION ALL
  SELECT source_id, 'feature', 1, CASE
      WHEN {_F} < 4 THEN {_FEATURE_START} || ', "user_impact": "High", "demand_score": 99}}'
      WHEN {_F} < 8 THEN {_FEATURE_START} || ', "user_impact": "High", "demand_score": -5}}'
      WHEN {_F} < 12 THEN {_FEATURE_START} || ', "user_impact": "Very High", "demand_score": 6}}'
      WHEN {_F} < 14 THEN {_FEATURE_START} || ', "user_impact": "Low", "demand_score": "abc"}}'
      WHEN {_F} < 16 THEN {_FEATURE_START} || ', "user_impact": "Low", "demand_score": "7"}}'
      ELSE {_FEATURE_START} || ', "user_impact": "' || {_pick(fv.IMPACTS, 'impact')} || '", "demand_score": '
           || ({_draw('demand')} % 10 + 1)::VARCHAR || '}}' END
    FROM labelled WHERE label = 'Feature Request'
  UNION ALL SELECT source_id, 'draft', 1, {_draft(1)} FROM labelled
  UNION ALL SELECT source_id, 'draft', 2, {_draft(2)} FROM labelled
  UNION ALL SELECT source_id, 'critic', 1, {_critic(1)} FROM labelled
  UNION ALL SELECT source_id, 'critic', 2, {_critic(2)} FROM labelled),
stripped AS (SELECT *, {_strip('raw')} AS t FROM responses),
unfenced AS (
  SELECT *, CASE WHEN regexp_matches(t, {_q(fv.FENCE_PATTERN)})
                 THEN {_strip(f"regexp_extract(t, {_q(fv.FENCE_PATTERN)}, 1)")} ELSE t END AS body
  FROM stripped),
objects AS (
  SELECT *, CASE WHEN strpos(body, '{{') > 0 AND strpos(substr(body, strpos(body, '{{')), '}}') > 0
      THEN substr(body, strpos(body, '{{'), strpos(substr(body, strpos(body, '{{')), '}}')) ELSE body END AS j
  FROM unfenced),
valid AS (SELECT *, starts_with(j, '{{') AND json_valid(j) AS well_formed FROM objects),
texts AS (
  SELECT *, CASE WHEN well_formed THEN j ELSE '{{}}' END AS o FROM valid),
parsed AS (
  SELECT source_id, stage, attempt, raw, well_formed,
    o ->> '$.category' AS category, o ->> '$.confidence' AS confidence_text,
    try_cast(o ->> '$.confidence' AS DOUBLE) AS confidence,
    o ->> '$.platform' AS platform, o ->> '$.os_version' AS os_version,
    o ->> '$.steps_to_reproduce' AS steps_to_reproduce, o ->> '$.severity' AS severity,
    o ->> '$.feature_description' AS feature_description, o ->> '$.user_impact' AS user_impact,
    try_cast(o ->> '$.demand_score' AS DOUBLE) AS demand_score,
    o ->> '$.title' AS title, o ->> '$.description' AS description,
    o ->> '$.passed' AS passed,
    array_to_string(from_json(o -> '$.issues', '["VARCHAR"]'), '; ') AS issues
  FROM texts),
answers AS (
  SELECT source_id,
    CASE WHEN category IN {CAT} THEN category ELSE 'Complaint' END AS category,
    CASE WHEN confidence < 0 THEN 0.0 WHEN confidence > 1 THEN 1.0 ELSE confidence END AS confidence
  FROM parsed WHERE stage = 'classifier' AND category IS NOT NULL AND confidence IS NOT NULL),
bug_answers AS (
  SELECT source_id, platform, os_version, steps_to_reproduce,
    CASE WHEN severity IN {PRI} THEN severity ELSE 'Medium' END AS severity
  FROM parsed WHERE stage = 'bug' AND platform IS NOT NULL AND os_version IS NOT NULL
    AND steps_to_reproduce IS NOT NULL AND severity IS NOT NULL),
feature_answers AS (
  SELECT source_id, feature_description,
    CASE WHEN user_impact IN ('High', 'Medium', 'Low') THEN user_impact ELSE 'Medium' END AS user_impact,
    CASE WHEN demand_score < 1 THEN 1 WHEN demand_score > 10 THEN 10 ELSE demand_score::INT END AS demand_score
  FROM parsed WHERE stage = 'feature' AND feature_description IS NOT NULL
    AND user_impact IS NOT NULL AND demand_score IS NOT NULL)"""


# --- rules ---------------------------------------------------------------------------
RULES = f"""
lowered AS (
  SELECT *, regexp_replace(lower(text), {_q(words.NEGATED_PHRASES)}, ' ', 'g') AS low FROM items),
voted AS (
  SELECT *, {_votes('low', words.LEXICON['Bug'])} AS vb,
    {_votes('low', words.LEXICON['Feature Request'])} AS vf,
    {_votes('low', words.LEXICON['Praise'])} AS vp,
    {_votes('low', words.LEXICON['Complaint'])} AS vc,
    {_votes('low', words.LEXICON['Spam'])} AS vs FROM lowered),
best AS (SELECT *, greatest(vb, vf, vp, vc, vs) AS m, vb + vf + vp + vc + vs AS tot FROM voted),
ruled AS (
  SELECT key, source_id, source_type, label, text, run_id, run_at, processed_at,
    CASE WHEN tot = 0 THEN 'Complaint' WHEN vb = m THEN 'Bug' WHEN vf = m THEN 'Feature Request'
         WHEN vp = m THEN 'Praise' WHEN vc = m THEN 'Complaint' ELSE 'Spam' END AS category,
    CASE WHEN tot = 0 THEN 0.5::DOUBLE ELSE m::DOUBLE / tot * (1 - power(0.5::DOUBLE, m + 1)) END AS confidence
  FROM best)"""

_SEVERITY = "CASE " + " ".join(
    f"WHEN {_has('lower(text)', phrases)} THEN {_q(s)}" for s, phrases in words.SEVERITY_PHRASES
) + " ELSE 'Medium' END"


def _details(source: str, category: str) -> str:
    """Native details of the bugs and feature requests among ``source``."""
    def cut(pattern: str, group: int) -> str:
        return f"nullif(regexp_extract(text, {_q(pattern)}, {group}), '')"

    return f"""
bugs AS (
  SELECT *, coalesce({cut(words.OS_PATTERN, 0)}, {cut(words.DEVICE_PATTERN, 0)}, 'Unknown') AS platform,
    coalesce({cut(words.OS_PATTERN, 2)}, 'Unknown') AS os_version,
    coalesce(nullif({_strip(cut(words.STEPS_BLOCK_PATTERN, 1))}, ''),
             {cut(words.TRIGGER_PATTERN, 2)}, 'Not specified') AS steps_to_reproduce,
    {_SEVERITY} AS severity
  FROM {source} WHERE {category} = 'Bug'),
asking AS (
  SELECT *, nullif({_strip(f"lower(regexp_extract(text, {_q(words.FEATURE_PATTERN)}, 3))")}, '') AS phrase
  FROM {source} WHERE {category} = 'Feature Request'),
demand AS (SELECT phrase, count(*) AS requests FROM asking WHERE phrase IS NOT NULL GROUP BY phrase),
scored AS (
  SELECT a.*, ceil(d.requests * 10 / (SELECT max(requests) FROM demand))::INT AS demand_score,
    'Users ask for: ' || coalesce(a.phrase, {_q(words.FEATURE_OTHERWISE)}) AS feature_description
  FROM asking a LEFT JOIN demand d ON a.phrase = d.phrase),
wishes AS (
  SELECT *, CASE WHEN demand_score >= 8 THEN 'High' WHEN coalesce(demand_score, 5) >= 5 THEN 'Medium' ELSE 'Low' END
    AS user_impact FROM scored)"""


_TECH = """CASE category
    WHEN 'Bug' THEN concat_ws(' | ',
      CASE WHEN platform NOT IN ('', 'Unknown') THEN 'Platform: ' || platform END,
      CASE WHEN os_version NOT IN ('', 'Unknown') THEN 'OS: ' || os_version END,
      CASE WHEN steps_to_reproduce NOT IN ('', 'Not specified') THEN 'Steps: ' || steps_to_reproduce END,
      CASE WHEN severity <> '' THEN 'Severity: ' || severity END)
    WHEN 'Feature Request' THEN concat_ws(' | ',
      CASE WHEN user_impact <> '' THEN 'User Impact: ' || user_impact END,
      CASE WHEN demand_score <> 0 THEN 'Demand Score: ' || demand_score || '/10' END,
      CASE WHEN feature_description <> '' THEN 'Feature: ' || feature_description END)
    ELSE '' END"""
_PRIORITY = f"""CASE category
    WHEN 'Bug' THEN CASE WHEN severity IN {PRI} THEN severity ELSE 'High' END
    WHEN 'Feature Request' THEN CASE WHEN coalesce(demand_score, 5) >= 8 THEN 'High'
      WHEN coalesce(demand_score, 5) >= 5 THEN 'Medium' ELSE 'Low' END
    ELSE 'Low' END"""


def _states(source: str, category: str) -> str:
    return _details(source, category) + f""",
states AS (
  SELECT key, source_id, source_type, {category} AS category, text, platform, os_version, steps_to_reproduce,
    severity, NULL::VARCHAR AS feature_description, NULL::VARCHAR AS user_impact, NULL::INT AS demand_score
  FROM bugs
  UNION ALL
  SELECT key, source_id, source_type, {category}, text, NULL, NULL, NULL, NULL,
    feature_description, user_impact, demand_score FROM wishes
  UNION ALL
  SELECT key, source_id, source_type, {category}, text, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM {source} WHERE {category} NOT IN ('Bug', 'Feature Request'))"""


_LABEL_STATES = ITEMS + "," + _states("items", "label")
_CONTEXT = """concat_ws(chr(10),
    'Category: ' || category,
    'Source: ' || source_type || ' (ID: ' || source_id || ')',
    'Original feedback:' || chr(10) || text,
    CASE WHEN severity <> '' THEN 'Bug severity: ' || severity END,
    CASE WHEN platform NOT IN ('', 'Unknown') THEN 'Platform: ' || platform END,
    CASE WHEN steps_to_reproduce NOT IN ('', 'Not specified') THEN 'Steps to reproduce: ' || steps_to_reproduce END,
    CASE WHEN feature_description <> '' THEN 'Feature description: ' || feature_description END,
    CASE WHEN user_impact <> '' THEN 'User impact: ' || user_impact END,
    CASE WHEN demand_score <> 0 THEN 'Demand score: ' || demand_score || '/10' END)"""
_FIRST_STEP = "split_part(steps_to_reproduce, chr(10), 1)"
_DRAFTS = _LABEL_STATES + f""",
drafts AS (
  SELECT *, {_PRIORITY} AS priority, {_TECH} AS technical_details,
    substr(CASE WHEN category = 'Bug' THEN 'Fix ' || lower(severity) || ' problem'
        || CASE WHEN platform IN ('', 'Unknown') THEN '' ELSE ' on ' || platform END
        || CASE WHEN {_FIRST_STEP} IN ('', 'Not specified') THEN '' ELSE ': ' || {_FIRST_STEP} END
      ELSE 'Add support: ' || feature_description END, 1, 80) AS title,
    '**Summary:** ' || CASE WHEN category = 'Bug' THEN 'A user reports a ' || lower(severity) || ' defect.'
        ELSE feature_description || '.' END
      || chr(10) || '**Details:** ' || {_TECH}
      || chr(10) || '**User Impact:** ' || CASE WHEN category = 'Bug' THEN 'Severity ' || severity || '.'
        ELSE 'Impact ' || user_impact || '.' END AS description
  FROM states WHERE category IN ('Bug', 'Feature Request'))"""


def _damage(purpose: str, column: str, *bad: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(bad))
    return f"CASE {_draw(purpose)} % 20 {cases} WHEN {len(bad)} THEN NULL ELSE {column} END AS {column}"


def _missing(field: str) -> str:
    return f"CASE WHEN {_strip(field)} = '' THEN 'Missing required field: ''{field}''' END"


def _short(field: str, name: str, minimum: int) -> str:
    size = f"length({_strip(field)})"
    return f"CASE WHEN {size} > 0 AND {size} < {minimum} THEN '{name} too short (' || {size} || ' chars, min {minimum})' END"


_REVIEWED = _DRAFTS + f""",
cases AS (
  SELECT * REPLACE (
    {_damage('case_title', 'title', '', ' ' + chr(10) + ' ', 'Fix bug', ' Fix it now ')},
    {_damage('case_text', 'description', '', 'It crashes.')},
    {_damage('case_category', 'category', '', 'Other', ' ')},
    {_damage('case_priority', 'priority', '', 'Urgent')},
    {_damage('case_details', 'technical_details', '', '  ')})
  FROM drafts),
reviewed AS (
  SELECT *, list_filter([{_missing('source_id')}, {_missing('source_type')}, {_missing('title')},
    {_missing('description')}, {_missing('category')}, {_missing('priority')},
    {_short('title', 'Title', 10)}, {_short('description', 'Description', 20)},
    CASE WHEN category <> '' AND category NOT IN {CAT} THEN 'Invalid category: ''' || category || '''' END,
    CASE WHEN priority <> '' AND priority NOT IN {PRI} THEN 'Invalid priority: ''' || priority || '''' END,
    CASE WHEN category = 'Bug' AND {_strip('technical_details')} = '' THEN 'Bug ticket is missing technical_details' END
  ], lambda x: x IS NOT NULL) AS issues FROM cases)"""

# --- a run -----------------------------------------------------------------------------


def _route(threshold: float) -> str:
    return f"""
known AS (
  SELECT i.*, a.category, a.confidence, CASE WHEN a.category IS NULL THEN 'error'
      WHEN a.confidence < {threshold} THEN 'low_confidence' WHEN a.category = 'Bug' THEN 'bug'
      WHEN a.category = 'Feature Request' THEN 'feature' ELSE 'end' END AS route
  FROM items i LEFT JOIN answers a USING (source_id)),
actionable AS (SELECT * FROM known WHERE route IN ('bug', 'feature'))"""


def _dispose(threshold: float) -> str:
    return f"""
judged AS (
  SELECT *, CASE WHEN failed_response THEN 'response error'
      WHEN category IN ('Praise', 'Complaint', 'Spam') THEN lower(category)
      WHEN confidence < {threshold} THEN 'low confidence'
      WHEN quality_passed THEN 'passed review' ELSE 'failed review' END AS reason FROM handled),
outcome AS (
  SELECT *, CASE WHEN reason = 'passed review' THEN 'created'
      WHEN reason IN ('response error', 'failed review') THEN 'failed' ELSE 'skipped' END AS disposition
  FROM judged)"""


def _run(threshold: float = 0.7) -> str:
    """Recorded classification and drafts, native details, local review."""
    return ",".join([ITEMS, RESPONSES, _route(threshold), _states("actionable", "category"), f"""
titled AS (
  SELECT source_id, attempt, substr(title, 1, 80) AS title, description,
    length({_strip('title')}) >= 10 AND length({_strip('description')}) >= 20 AS good
  FROM parsed WHERE stage = 'draft' AND title IS NOT NULL AND description IS NOT NULL),
attempts AS (
  SELECT s.*, {_PRIORITY} AS priority, {_TECH} AS technical_details,
    f.title AS t1, f.description AS x1, f.good AS g1,
    g.title AS t2, g.description AS x2, g.good AS g2
  FROM states s
  LEFT JOIN titled f ON f.source_id = s.source_id AND f.attempt = 1
  LEFT JOIN titled g ON g.source_id = s.source_id AND g.attempt = 2),
finished AS (
  SELECT source_id, priority, technical_details,
    CASE WHEN g1 THEN t1 WHEN NOT g1 THEN t2 END AS title,
    CASE WHEN g1 THEN x1 WHEN NOT g1 THEN x2 END AS description,
    g1 IS NULL OR (NOT g1 AND g2 IS NULL) AS failed_response,
    coalesce(g1 OR (NOT g1 AND g2), false) AS quality_passed,
    CASE WHEN g1 IS NULL OR g1 THEN 0 WHEN g2 THEN 1 WHEN g2 IS NULL THEN 1 ELSE 2 END AS retry_count
  FROM attempts),
handled AS (
  SELECT k.source_id, k.source_type, k.run_id, k.run_at, k.processed_at, k.category, k.confidence, k.route,
    coalesce(f.failed_response, k.route = 'error') AS failed_response,
    f.quality_passed, f.retry_count, f.title, f.description, f.priority, f.technical_details
  FROM known k LEFT JOIN finished f USING (source_id))""", _dispose(threshold)])


_RUN_RECORDED = ",".join([ITEMS, RESPONSES, _route(0.7), f"""
detailed AS (
  SELECT k.source_id, k.category, b.severity, w.demand_score,
    CASE WHEN k.route = 'bug' THEN b.source_id IS NULL ELSE w.source_id IS NULL END AS bad_details
  FROM actionable k LEFT JOIN bug_answers b ON b.source_id = k.source_id AND k.route = 'bug'
  LEFT JOIN feature_answers w ON w.source_id = k.source_id AND k.route = 'feature'),
tries AS (
  SELECT d.source_id, d.attempt,
    CASE WHEN v.passed IN ('true', 'false') THEN v.passed = 'true'
         ELSE length({_strip('d.title')}) >= 10 AND length({_strip('d.description')}) >= 20 END AS good
  FROM parsed d JOIN parsed v ON v.source_id = d.source_id AND v.attempt = d.attempt AND v.stage = 'critic'
  WHERE d.stage = 'draft' AND d.title IS NOT NULL AND d.description IS NOT NULL),
finished AS (
  SELECT d.source_id, d.bad_details OR a.good IS NULL OR (NOT a.good AND b.good IS NULL) AS failed_response,
    coalesce(a.good OR (NOT a.good AND b.good), false) AS quality_passed
  FROM detailed d LEFT JOIN tries a ON a.source_id = d.source_id AND a.attempt = 1
  LEFT JOIN tries b ON b.source_id = d.source_id AND b.attempt = 2),
handled AS (
  SELECT k.source_id, k.run_id, k.run_at, k.category, k.confidence,
    coalesce(f.failed_response, k.route = 'error') AS failed_response, f.quality_passed
  FROM known k LEFT JOIN finished f USING (source_id))""", _dispose(0.7)])

_RUN_NATIVE = ",".join([ITEMS, RULES, """
handled AS (
  SELECT source_id, run_id, run_at, category, confidence, false AS failed_response,
    category IN ('Bug', 'Feature Request') AND confidence >= 0.7 AS quality_passed FROM ruled)""", _dispose(0.7)])

_METRICS = """
  SELECT run_id, max(run_at) AS run_at, count(*) AS total_processed,
    count(*) FILTER (disposition = 'created') AS tickets_created,
    count(*) FILTER (disposition = 'skipped') AS skipped,
    count(*) FILTER (disposition = 'failed') AS failed,
    count(*) FILTER (NOT failed_response AND category = 'Bug') AS bug_count,
    count(*) FILTER (NOT failed_response AND category = 'Feature Request') AS feature_request_count,
    count(*) FILTER (NOT failed_response AND category = 'Praise') AS praise_count,
    count(*) FILTER (NOT failed_response AND category = 'Complaint') AS complaint_count,
    count(*) FILTER (NOT failed_response AND category = 'Spam') AS spam_count
  FROM outcome GROUP BY run_id"""
_RUN = _run()
_WITH_METRICS = _RUN + f", metrics AS ({_METRICS})"
_WITH_LOG = _RUN + """,
log AS (
  SELECT run_id, source_id, source_type, 'pipeline' AS agent, 'error' AS decision,
    NULL::DOUBLE AS confidence, processed_at AS timestamp FROM outcome WHERE failed_response
  UNION ALL
  SELECT run_id, source_id, source_type, 'classifier', category, confidence, processed_at
  FROM outcome WHERE NOT failed_response
  UNION ALL
  SELECT run_id, source_id, source_type, 'filter', 'skipped', NULL, processed_at
  FROM outcome WHERE reason = 'low confidence'
  UNION ALL
  SELECT run_id, source_id, source_type, 'ticket_creator', 'created', NULL, processed_at
  FROM outcome WHERE reason = 'passed review'
  UNION ALL
  SELECT run_id, source_id, source_type, 'quality_critic', 'failed', NULL, processed_at
  FROM outcome WHERE reason = 'failed review')"""
_WITH_TICKETS = _WITH_METRICS + """,
numbered AS (
  SELECT *, row_number() OVER (ORDER BY source_type, source_id) AS n
  FROM outcome WHERE disposition = 'created'),
tickets AS (
  SELECT printf('T%04d', n) AS ticket_id, n, source_id, source_type, coalesce(title, '') AS title,
    coalesce(description, '') AS description, category, coalesce(priority, '') AS priority,
    coalesce(technical_details, '') AS technical_details, processed_at AS created_at, run_id
  FROM numbered)"""
_WITH_EDITS = _WITH_TICKETS + f""",
all_edits AS (
  SELECT printf('T%04d', c_custkey) AS ticket_id, 1 AS edit_no, c_custkey AS key FROM customer
  UNION ALL SELECT printf('T%04d', s_suppkey * 2), 2, s_suppkey FROM supplier),
edits AS (
  SELECT ticket_id, {_pick(fv.CATEGORIES, 'new_category')} AS category,
    {_pick(fv.PRIORITIES, 'new_priority')} AS priority,
    'Edited title ' || edit_no || ' of ' || key AS title, 'Edited description' AS description,
    CASE WHEN {_draw('clear')} % 4 > 0 THEN 'Edited details ' || edit_no END AS technical_details
  FROM all_edits QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY edit_no DESC) = 1)"""


def _edited(*columns: str) -> str:
    return ", ".join(
        f"CASE WHEN e.ticket_id IS NULL THEN t.{c} ELSE e.{c} END AS {c}" for c in columns
    )


# --- intake ---------------------------------------------------------------------------------
_TURN = "conv_id::VARCHAR || '-' || turn::VARCHAR"


def _padded(text: str, key: str) -> str:
    return f"{_pick(_PADDING, 'left', key)} || {text} || {_pick(_PADDING, 'right', key)}"


RAW = f"""
raw_reviews AS (
  SELECT printf('REV%05d', doc_id) AS review_id, 'Tasklane' AS app_name,
    CASE WHEN {_draw('blank', 'doc_id')} % 50 > 0 THEN {_padded('text', 'doc_id')} END AS review_text,
    CASE WHEN {_draw('rating', 'doc_id')} % 7 = 0 THEN 'none'
         WHEN {_draw('rating', 'doc_id')} % 7 < 6 THEN ({_draw('rating', 'doc_id')} % 7)::VARCHAR END AS rating,
    source AS platform, {_pick(words.VERSIONS, 'version', 'doc_id')} AS app_version,
    {_pick(['2024-03-01', '2024-03-02 10:20:30', 'unknown'], 'date', 'doc_id')} AS date, lang AS user_name
  FROM documents),
raw_emails AS (
  SELECT 'EML' || {_TURN} AS email_id, ' Turn ' || turn || ' ' || chr(10) AS subject,
    {_padded('text', _TURN)} AS body, role || '@mail.example' AS sender_email,
    {_pick(['2024-05-01 08:00:00', '2024-05-02', ''], 'date', _TURN)} AS timestamp,
    nullif({_pick(['High', 'Low', ''], 'prio', _TURN)}, '') AS priority
  FROM conversations),
reviews AS (
  SELECT review_id AS source_id, 'review' AS source_type, {_strip('review_text')} AS text, platform,
    try_cast(rating AS INT)::VARCHAR AS rating, user_name,
    strftime(try_cast(date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS date, app_version FROM raw_reviews),
emails AS (
  SELECT email_id AS source_id, 'email' AS source_type,
    {_strip('subject')} || chr(10) || chr(10) || {_strip('body')} AS text, {_strip('subject')} AS subject,
    sender_email, strftime(try_cast(timestamp AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS timestamp,
    coalesce(priority, '') AS priority FROM raw_emails),
unified AS (
  SELECT source_id, source_type, text, platform, NULL::VARCHAR AS sender_email, NULL::VARCHAR AS priority FROM reviews
  UNION ALL SELECT source_id, source_type, text, NULL, sender_email, priority FROM emails)"""


def _profile(name: str, source: str, columns: list[str]) -> str:
    nulls = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns)
    return (
        f"SELECT '{name}' AS input, count(*) AS row_count, {len(columns)}::BIGINT AS column_count, "
        f"({nulls})::BIGINT AS null_values FROM {source}"
    )


_TIME_TEXT = f"""CASE {_draw('shape')} % 5 WHEN 0 THEN strftime(processed_at, '%Y-%m-%dT%H:%M:%S+00:00')
    WHEN 1 THEN strftime(processed_at, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN strftime(processed_at, '%Y-%m-%d')
    WHEN 3 THEN 'yesterday' ELSE '' END"""
_N = f"{_draw('number')} % 100"
_AGAIN = f"{_draw('again')} % 100"

# --- generated data ----------------------------------------------------------------------------
_ANCHOR = "TIMESTAMP '2025-06-01 12:00:00'"


def _numbered(side: str, quota: list[tuple[str, float]]) -> str:
    """Blocks of the rounded quota; what rounding leaves over is drawn."""
    bounds, upto = [], "0"
    for category, share in quota:
        upto += f" + round_even({share}::DOUBLE * n, 0)"
        bounds.append(f"WHEN number <= {upto} THEN {_q(category)}")
    return f"""
{side}s_numbered AS (
  SELECT *, CASE {' '.join(bounds)} ELSE {_pick([c for c, _ in quota], 'rest')} END AS label
  FROM (SELECT o_orderkey + 1 AS number, '{side}-' || (o_orderkey + 1) AS key,
               (SELECT count(*) FROM orders) AS n FROM orders))"""


_FIRST, _LAST = f"lower({_pick(words.FIRST_NAMES, 'first')})", f"lower({_pick(words.LAST_NAMES, 'last')})"
GENERATED = ",".join([_numbered("review", fv.REVIEW_QUOTA), _numbered("email", fv.EMAIL_QUOTA), f"""
gen_review AS (
  SELECT key, label, printf('REV%05d', number) AS review_id, {_pick(words.APP_NAMES, 'app')} AS app_name,
    {_REVIEW_TEXT} AS review_text, {_pick_by_label(fv.RATINGS, 'rating')} AS rating,
    {_pick(words.PLATFORMS, 'platform')} AS platform, {_pick(words.VERSIONS, 'version')} AS app_version,
    {_ANCHOR} - to_days(({_draw('date')} % 181)::INT) AS date,
    {_SLOTS['name']} AS user_name FROM reviews_numbered),
gen_email AS (
  SELECT key, label, printf('EML%05d', number) AS email_id, {_EMAIL_SUBJECT} AS subject, {_EMAIL_BODY} AS body,
    CASE {_draw('sender')} % 3 WHEN 0 THEN {_FIRST} || '.' || {_LAST}
      WHEN 1 THEN {_FIRST} || ({_draw('number')} % 99 + 1) ELSE {_FIRST}[1] || {_LAST} END
      || '@' || {_pick(words.MAIL_DOMAINS, 'domain')} AS sender_email,
    {_ANCHOR} - to_days(({_draw('date')} % 91)::INT) AS timestamp,
    {_pick_by_label(fv.EMAIL_PRIORITIES, 'prio')} AS priority FROM emails_numbered),
gen_label AS (
  SELECT source_id, source_type, label AS category,
    CASE label
      WHEN 'Bug' THEN CASE WHEN roll < 15 THEN 'Critical' WHEN roll < 60 THEN 'High' WHEN roll < 90 THEN 'Medium' ELSE 'Low' END
      WHEN 'Feature Request' THEN CASE WHEN roll < 10 THEN 'High' WHEN roll < 60 THEN 'Medium' ELSE 'Low' END
      WHEN 'Praise' THEN CASE WHEN roll < 20 THEN 'Medium' ELSE 'Low' END
      WHEN 'Complaint' THEN CASE WHEN roll < 5 THEN 'Critical' WHEN roll < 35 THEN 'High' WHEN roll < 80 THEN 'Medium' ELSE 'Low' END
      ELSE 'Low' END AS priority,
    CASE WHEN label = 'Bug' THEN 'Device: ' || {_pick(words.DEVICES, 'device')} || ' | OS: ' || {_pick(words.OS_VERSIONS, 'os')}
      || ' | Trigger: ' || {_pick(words.ACTIONS, 'action')}
      || CASE WHEN source_type = 'email' THEN ' | App version: ' || {_pick(words.VERSIONS, 'version')} ELSE '' END
      ELSE '' END AS technical_details,
    CASE label WHEN 'Bug' THEN '[Bug] App fails to ' || {_pick(words.ACTIONS, 'action')}
      WHEN 'Feature Request' THEN CASE WHEN source_type = 'review'
        THEN {_pick(words.REVIEW_SUBJECTS['Feature Request'], 'tmpl')} ELSE 'Feature Request' END
      WHEN 'Praise' THEN '[Praise] Positive user feedback'
      WHEN 'Complaint' THEN '[Complaint] Negative user experience reported'
      ELSE '[Spam] Flagged for removal' END AS suggested_title
  FROM (SELECT key, label, review_id AS source_id, 'review' AS source_type, {_draw('label_priority')} % 100 AS roll FROM gen_review
        UNION ALL
        SELECT key, label, email_id, 'email', {_draw('label_priority')} % 100 FROM gen_email))"""])

_PAIRS = ITEMS + "," + RULES + ", pairs AS (SELECT label AS actual, category AS predicted, count(*) AS items FROM ruled GROUP BY ALL)"
_PRI_COUNTS = ", ".join(f"count(*) FILTER (priority = '{p}') AS \"{p}\"" for p in fv.PRIORITIES)


def all_statements() -> dict[str, str]:
    def on(ctes: str, select: str) -> str:
        return f"WITH {ctes}\n{select}"

    from .prompts_sql import prompts_statement

    return {
        # intake
        "normalize_reviews": on(RAW, "SELECT * FROM reviews"),
        "normalize_emails": on(RAW, "SELECT * FROM emails"),
        "unified_items": on(RAW, "SELECT * FROM unified"),
        "items_limit": on(RAW, "SELECT source_id, source_type, text FROM unified ORDER BY source_type, source_id LIMIT 300"),
        "items_limit_large": on(ITEMS, "SELECT source_id, source_type, text FROM items ORDER BY source_type, source_id LIMIT 12000"),
        "input_profile": on(RAW, " UNION ALL ".join([
            _profile("reviews", "raw_reviews", ["review_id", "app_name", "review_text", "rating", "platform", "app_version", "date", "user_name"]),
            _profile("emails", "raw_emails", ["email_id", "subject", "body", "sender_email", "timestamp", "priority"]),
            _profile("labels", "labels", ["doc_id", "quality", "toxic"]),
        ])),
        "input_files": "SELECT *, true AS sizes_fit FROM (" + " UNION ALL ".join([
            _profile("customer", "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
            _profile("labels", "labels", ["doc_id", "quality", "toxic"]),
            _profile("conversations", "conversations", ["conv_id", "turn", "role", "text"]),
        ]) + ")",
        "load_coerce_tickets": on(ITEMS, f"SELECT source_id AS ticket_id, source_type, try_cast({_TIME_TEXT} AS TIMESTAMP) AS created_at FROM items"),
        "load_coerce_log": on(ITEMS, f"""SELECT source_id, try_cast(CASE WHEN {_N} < 10 THEN 'n/a' WHEN {_N} < 20 THEN ''
            WHEN {_N} < 30 THEN '1e-1' ELSE '0.' || ({_N}) END AS DOUBLE) AS confidence,
            try_cast({_TIME_TEXT} AS TIMESTAMP) AS timestamp FROM items"""),
        "load_coerce_metrics": on(ITEMS, f"""SELECT source_id AS run_id, try_cast({_TIME_TEXT} AS TIMESTAMP) AS run_at,
            CASE WHEN {_N} >= 20 THEN {_N} END AS total_processed FROM items"""),
        # responses
        "parse_responses": on(ITEMS + "," + RESPONSES, """SELECT source_id, stage, attempt, well_formed, confidence, demand_score,
            passed, category, platform, severity, user_impact, title, description, issues FROM parsed"""),
        "response_rejects": on(ITEMS + "," + RESPONSES, """SELECT source_id, stage, attempt, reason, raw FROM (
            SELECT *, CASE WHEN NOT well_formed THEN 'no JSON object'
              WHEN stage = 'classifier' AND category IS NULL THEN 'field category'
              WHEN stage = 'classifier' AND confidence IS NULL THEN 'field confidence'
              WHEN stage = 'bug' AND platform IS NULL THEN 'field platform'
              WHEN stage = 'bug' AND os_version IS NULL THEN 'field os_version'
              WHEN stage = 'bug' AND steps_to_reproduce IS NULL THEN 'field steps_to_reproduce'
              WHEN stage = 'bug' AND severity IS NULL THEN 'field severity'
              WHEN stage = 'feature' AND feature_description IS NULL THEN 'field feature_description'
              WHEN stage = 'feature' AND user_impact IS NULL THEN 'field user_impact'
              WHEN stage = 'feature' AND demand_score IS NULL THEN 'field demand_score'
              WHEN stage = 'draft' AND title IS NULL THEN 'field title'
              WHEN stage = 'draft' AND description IS NULL THEN 'field description'
              WHEN stage = 'critic' AND passed IS NULL THEN 'field passed'
              WHEN stage = 'critic' AND issues IS NULL THEN 'field issues' END AS reason FROM parsed)
            WHERE reason IS NOT NULL"""),
        "validate_classification": on(ITEMS + "," + RESPONSES, "SELECT * FROM answers"),
        "validate_bug": on(ITEMS + "," + RESPONSES, "SELECT * FROM bug_answers"),
        "validate_feature": on(ITEMS + "," + RESPONSES, "SELECT * FROM feature_answers"),
        # classification
        "classify_rules": on(ITEMS + "," + RULES, "SELECT source_id, label, category, round(confidence, 6) AS confidence FROM ruled"),
        "classify_recorded": on(ITEMS + "," + RESPONSES, """SELECT i.source_id, i.source_type, a.category, a.confidence,
            a.category IS NULL AS failed_response FROM items i LEFT JOIN answers a USING (source_id)"""),
        "classify_rerecorded": on(ITEMS + "," + RESPONSES, f"""SELECT i.source_id, i.source_type,
            CASE WHEN {_AGAIN} < 10 THEN 'Spam' WHEN a.category IS NOT NULL THEN a.category
              WHEN {_AGAIN} BETWEEN 25 AND 29 THEN 'Praise' END AS category,
            CASE WHEN {_AGAIN} < 10 THEN 0.65::DOUBLE WHEN a.category IS NOT NULL THEN a.confidence
              WHEN {_AGAIN} BETWEEN 25 AND 29 THEN 0.9::DOUBLE END AS confidence,
            a.category IS NULL AND {_AGAIN} >= 10 AND NOT {_AGAIN} BETWEEN 25 AND 29 AS failed_response
            FROM items i LEFT JOIN answers a USING (source_id)"""),
        "response_conflicts": on(ITEMS + "," + RESPONSES, f"""SELECT i.source_type, i.source_id, 'answer_classifier' AS slot,
            2::BIGINT AS recordings, 2::BIGINT AS different FROM items i JOIN answers a USING (source_id)
            WHERE ({_AGAIN} < 10 AND NOT (a.category = 'Spam' AND a.confidence = 0.65::DOUBLE))
              OR ({_AGAIN} BETWEEN 25 AND 29 AND NOT (a.category = 'Praise' AND a.confidence = 0.9::DOUBLE))"""),
        "classify_calibrated": on(ITEMS, """SELECT 'recall of ' || label AS check, count(*) AS items, true AS holds FROM items GROUP BY label
            UNION ALL SELECT unnest(['calibration error below 0.02', 'every bin is calibrated']), count(*), true FROM items"""),
        # details and drafts
        "bug_details": on(_LABEL_STATES, "SELECT source_id, platform, os_version, steps_to_reproduce, severity FROM bugs"),
        "feature_demand": on(_LABEL_STATES, "SELECT phrase, requests FROM demand"),
        "feature_details": on(_LABEL_STATES, "SELECT source_id, feature_description, user_impact, demand_score FROM wishes"),
        "derive_priority": on(_LABEL_STATES, f"SELECT source_id, category, {_PRIORITY} AS priority FROM states"),
        "technical_details": on(_LABEL_STATES, f"SELECT source_id, {_TECH} AS technical_details FROM states"),
        "ticket_context": on(_LABEL_STATES, f"SELECT source_id, {_CONTEXT} AS context FROM states"),
        "ticket_draft": on(_DRAFTS, "SELECT source_id, title, description FROM drafts"),
        "stage_prompts": on(_DRAFTS, prompts_statement(_CONTEXT, f"(50 + {_draw('conf')} % 50) / 100.0::DOUBLE", _draw("case_title"))),
        # quality
        "quality_review": on(_REVIEWED, "SELECT source_id, len(issues) = 0 AS quality_passed, array_to_string(issues, '; ') AS issues FROM reviewed"),
        "quality_review_fallback": on(_REVIEWED + "," + RESPONSES, """SELECT r.source_id,
            CASE WHEN v.passed IS NULL THEN len(r.issues) = 0 ELSE v.passed = 'true' END AS quality_passed,
            CASE WHEN v.passed IS NULL THEN array_to_string(r.issues, '; ') ELSE v.issues END AS issues
            FROM reviewed r LEFT JOIN parsed v ON v.source_id = r.source_id AND v.stage = 'critic' AND v.attempt = 1"""),
        "quality_issue_counts": on(_REVIEWED, "SELECT issue, count(*) AS drafts FROM (SELECT unnest(issues) AS issue FROM reviewed) GROUP BY issue"),
        "retry_hint": on(_REVIEWED, """SELECT source_id, CASE WHEN len(issues) = 0 THEN '' ELSE chr(10) || chr(10)
            || 'PREVIOUS ATTEMPT FAILED quality review. Fix these issues:' || chr(10) || '  - '
            || array_to_string(issues, chr(10) || '  - ') END AS hint FROM reviewed"""),
        # a run
        "route_items": on(_RUN, "SELECT source_id, route FROM outcome"),
        "retry_outcome": on(_RUN, "SELECT source_id, failed_response, quality_passed, retry_count FROM outcome WHERE route IN ('bug', 'feature')"),
        "item_disposition": on(_RUN, "SELECT source_id, disposition, reason FROM outcome"),
        "run_counts": on(_RUN, "SELECT run_id, disposition, count(*) AS items FROM outcome GROUP BY ALL"),
        "run_category_counts": on(_RUN, "SELECT run_id, category, count(*) AS items FROM outcome WHERE NOT failed_response GROUP BY ALL"),
        "processing_log": on(_WITH_LOG, "SELECT * FROM log"),
        "run_metrics": on(_RUN, _METRICS),
        "run_summary": on(_RUN, """SELECT run_id, unnest(['Total items', 'Tickets created', 'Skipped', 'Failed / Errored']) AS name,
              unnest([1, 2, 3, 4]) AS position, unnest([count(*), count(*) FILTER (disposition = 'created'),
              count(*) FILTER (disposition = 'skipped'), count(*) FILTER (disposition = 'failed')]) AS items FROM outcome GROUP BY run_id
            UNION ALL SELECT run_id, category, 4 + row_number() OVER (PARTITION BY run_id ORDER BY category), count(*)
            FROM outcome WHERE NOT failed_response GROUP BY run_id, category"""),
        "run_metrics_recorded": on(_RUN_RECORDED, _METRICS),
        "run_metrics_native": on(_RUN_NATIVE, _METRICS),
        "tickets": on(_WITH_TICKETS, "SELECT * EXCLUDE (n) FROM tickets"),
        "ticket_ids": on(_WITH_TICKETS, "SELECT printf('T%04d', n + (SELECT max(n) FROM tickets)) AS ticket_id, source_type, source_id FROM tickets"),
        "threshold_sweep": on(_run(0.0), """SELECT t.threshold,
              count(*) FILTER (NOT failed_response AND category IN ('Bug', 'Feature Request') AND confidence >= t.threshold AND quality_passed) AS created,
              count(*) FILTER (NOT failed_response AND (category NOT IN ('Bug', 'Feature Request') OR confidence < t.threshold)) AS skipped,
              count(*) FILTER (failed_response OR (category IN ('Bug', 'Feature Request') AND confidence >= t.threshold AND NOT quality_passed)) AS failed
            FROM outcome, (SELECT i / 20::DOUBLE AS threshold FROM range(21) r(i)) t GROUP BY t.threshold"""),
        # reports
        "kpi_summary": on(_WITH_TICKETS, """SELECT count(*) AS total_tickets, count(*) FILTER (category = 'Bug') AS bugs,
            count(*) FILTER (category = 'Feature Request') AS feature_requests, count(*) FILTER (priority = 'Critical') AS critical,
            (SELECT count(*) FROM metrics) AS runs FROM tickets"""),
        "category_breakdown": on(_WITH_TICKETS, "SELECT category, count(*) AS tickets, round(count(*) * 100 / (SELECT count(*) FROM tickets), 2) AS share_percent FROM tickets GROUP BY category"),
        "priority_distribution": on(_WITH_TICKETS, """SELECT priority, count(*) AS tickets,
            CASE priority WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 WHEN 'Low' THEN 4 ELSE 5 END AS priority_rank
            FROM tickets GROUP BY priority"""),
        "latest_run": on(_WITH_METRICS, "SELECT run_id, run_at, total_processed, tickets_created, skipped, failed FROM metrics ORDER BY run_at DESC, run_id DESC LIMIT 1"),
        "recent_tickets": on(_WITH_TICKETS, """SELECT ticket_id, category, priority, source_type, title,
            strftime(created_at, '%Y-%m-%d %H:%M') AS created_at FROM (SELECT * FROM tickets ORDER BY created_at DESC, ticket_id LIMIT 10)"""),
        "ticket_filter": on(_WITH_TICKETS, """SELECT ticket_id, category, priority, source_type, source_id, title FROM tickets
            WHERE category = 'Bug' AND priority IN ('Critical', 'High') AND source_type = 'email'"""),
        "ticket_filter_counts": on(_WITH_TICKETS, """SELECT count(*) FILTER (category = 'Bug' AND priority IN ('Critical', 'High')
            AND source_type = 'email') AS shown, count(*) AS total FROM tickets"""),
        "ticket_lookup": on(_WITH_TICKETS, "SELECT * EXCLUDE (n, run_id) FROM tickets WHERE ticket_id = 'T0042'"),
        "run_history": on(_WITH_METRICS, """SELECT run_id, strftime(run_at, '%Y-%m-%d %H:%M') AS run_at, total_processed, tickets_created,
            skipped, failed, bug_count, feature_request_count, spam_count,
            round(tickets_created * 100.0::DOUBLE / total_processed, 1)::VARCHAR || '%' AS success_rate FROM metrics"""),
        "run_outcomes_stacked": on(_WITH_METRICS + ", ranked AS (SELECT row_number() OVER (ORDER BY run_at, run_id)::INT AS run_no, * FROM metrics)", """
            SELECT run_no, 'Created' AS outcome, tickets_created AS items FROM ranked
            UNION ALL SELECT run_no, 'Skipped', skipped FROM ranked UNION ALL SELECT run_no, 'Failed', failed FROM ranked"""),
        "confidence_histogram": on(_WITH_LOG, """SELECT i AS bin, i / 20::DOUBLE AS lower_bound, (i + 1) / 20::DOUBLE AS upper_bound,
            count(l.confidence) AS steps, (i + 1) / 20::DOUBLE <= 0.7::DOUBLE AS below_threshold
            FROM range(20) r(i) LEFT JOIN (SELECT confidence FROM log WHERE agent = 'classifier' AND confidence IS NOT NULL) l
            ON least(floor(l.confidence * 20), 19) = i GROUP BY i"""),
        "agent_step_counts": on(_WITH_LOG, "SELECT agent, count(*) AS steps FROM log GROUP BY agent"),
        "priority_crosstab": on(_WITH_TICKETS, f"SELECT category, {_PRI_COUNTS} FROM tickets GROUP BY category"),
        "priority_crosstab_long": on(_WITH_TICKETS, f"""SELECT c.category, p.priority, count(t.ticket_id) AS tickets
            FROM (SELECT DISTINCT category FROM tickets) c CROSS JOIN (SELECT unnest({_list(fv.PRIORITIES)}) AS priority) p
            LEFT JOIN tickets t ON t.category = c.category AND t.priority = p.priority GROUP BY ALL"""),
        "overall_stats": on(_WITH_METRICS, """SELECT sum(total_processed)::BIGINT AS total_processed, sum(tickets_created)::BIGINT AS tickets_created,
            sum(skipped)::BIGINT AS skipped, sum(failed)::BIGINT AS failed,
            round(sum(tickets_created) * 100.0::DOUBLE / sum(total_processed), 1) AS success_rate FROM metrics"""),
        # edits
        "ticket_edit_merge": on(_WITH_EDITS, f"""SELECT t.ticket_id, t.source_id, {_edited('category', 'priority', 'title', 'technical_details')},
            e.ticket_id IS NOT NULL AS edited FROM tickets t LEFT JOIN edits e ON e.ticket_id = t.ticket_id"""),
        "ticket_edit_single": on(_WITH_EDITS, f"""SELECT t.ticket_id, t.category, {_edited('title', 'description', 'technical_details')},
            e.ticket_id IS NOT NULL AS edited FROM tickets t LEFT JOIN edits e ON e.ticket_id = t.ticket_id"""),
        # generated data
        "gen_reviews": on(GENERATED, "SELECT * EXCLUDE (key, label) FROM gen_review"),
        "gen_emails": on(GENERATED, "SELECT * EXCLUDE (key, label) FROM gen_email"),
        "gen_labels": on(GENERATED, "SELECT * FROM gen_label"),
        "label_distribution": on(GENERATED, """SELECT source_type || ' category' AS kind, category AS value, count(*) AS items FROM gen_label GROUP BY ALL
            UNION ALL SELECT 'priority', priority, count(*) FROM gen_label GROUP BY ALL"""),
        # evaluation and stream
        "eval_confusion": on(_PAIRS, "SELECT actual, " + ", ".join(
            f"coalesce(sum(items) FILTER (predicted = {_q(c)}), 0)::BIGINT AS predicted_{c.lower().replace(' ', '_')}"
            for c in [*fv.CATEGORIES, "none"]) + " FROM pairs GROUP BY actual"),
        "eval_per_class": on(_PAIRS + """, classes AS (
            SELECT c.category, (SELECT coalesce(sum(items), 0) FROM pairs WHERE actual = c.category)::BIGINT AS support,
              (SELECT coalesce(sum(items), 0) FROM pairs WHERE predicted = c.category)::BIGINT AS predicted,
              (SELECT coalesce(sum(items), 0) FROM pairs WHERE predicted = c.category AND actual = c.category)::BIGINT AS hits
            FROM (SELECT actual AS category FROM pairs UNION SELECT predicted FROM pairs) c)""", """
            SELECT *, round(CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END, 6) AS precision,
              round(CASE WHEN support = 0 THEN 0 ELSE hits / support END, 6) AS recall,
              round(CASE WHEN hits = 0 THEN 0 ELSE 2 * hits / (support + predicted) END, 6) AS f1 FROM classes"""),
        "eval_accuracy": on(_PAIRS, """SELECT sum(items)::BIGINT AS items, sum(items) FILTER (actual = predicted)::BIGINT AS hits,
            round(sum(items) FILTER (actual = predicted) / sum(items), 6) AS accuracy FROM pairs"""),
        "stream_tables": on(_RUN_NATIVE, """SELECT count(*) AS total_processed,
              count(*) FILTER (disposition = 'created') AS tickets_created, count(*) FILTER (disposition = 'skipped') AS skipped,
              count(*) FILTER (disposition = 'failed') AS failed, count(*) AS classified,
              count(*) FILTER (disposition = 'created') AS ticket_ids, count(*) FILTER (disposition = 'created') AS last_number FROM outcome"""),
        "stream_intake": on(ITEMS + "," + RULES, """SELECT source_id, category, round(confidence, 6) AS confidence,
            CASE WHEN confidence < 0.7 THEN 'low_confidence' WHEN category = 'Bug' THEN 'bug'
              WHEN category = 'Feature Request' THEN 'feature' ELSE 'end' END AS route FROM ruled"""),
    }

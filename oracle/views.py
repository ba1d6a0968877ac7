"""DuckDB text of the fixture views and shared SQL helpers for the oracles.

Written independently of the Spark code: plain SQL over the driver tables.
"""

from __future__ import annotations

from sentrel.schema import ENTITY_TYPES, LABELS, TYPE_IDS

BIG = 1073741824


def h(salt: str, *exprs: str) -> str:
    """First 32 bits of md5('salt:e1:e2...') as BIGINT."""
    inner = ", ".join([f"'{salt}'"] + [f"CAST({e} AS VARCHAR)" for e in exprs])
    return f"CAST(('0x' || substr(md5(concat_ws(':', {inner})), 1, 8)) AS BIGINT)"


def label_values() -> str:
    rows = ", ".join(f"({i}, '{name}')" for i, name in enumerate(LABELS))
    return f"(SELECT CAST(c0 AS INTEGER) AS label_id, c1 AS label FROM (VALUES {rows}) t(c0, c1))"


def type_case(code: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ENTITY_TYPES.items())
    return f"(CASE {code} {whens} END)"


def type_id_case(name: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in TYPE_IDS.items())
    return f"(CASE {name} {whens} ELSE 0 END)"


def sub(s: str, a: str, b: str) -> str:
    """Python s[a:b] for 0-based offsets."""
    return f"substring({s}, ({a}) + 1, greatest(({b}) - ({a}), 0))"


def mark(s, ss, se, os_, oe, so, sc, oo, oc) -> str:
    first = f"concat({sub(s, '0', ss)}, {so}, {sub(s, ss, se + '+1')}, {sc}, {sub(s, se + '+1', os_)}, " \
            f"{oo}, {sub(s, os_, oe + '+1')}, {oc}, {sub(s, oe + '+1', str(BIG))})"
    second = f"concat({sub(s, '0', os_)}, {oo}, {sub(s, os_, oe + '+1')}, {oc}, {sub(s, oe + '+1', ss)}, " \
             f"{so}, {sub(s, ss, se + '+1')}, {sc}, {sub(s, se + '+1', str(BIG))})"
    return f"(CASE WHEN {ss} <= {os_} THEN {first} ELSE {second} END)"


def _cell(word: str, start: str, end: str, typ: str) -> str:
    return (f"concat('{{''word'': ''', {word}, ''', ''start_idx'': ', CAST({start} AS VARCHAR), "
            f"', ''end_idx'': ', CAST({end} AS VARCHAR), ', ''type'': ''', {typ}, '''}}')")


def _grab(cell: str, pattern: str) -> str:
    return f"NULLIF(regexp_extract({cell}, '{pattern}', 1), '')"


VIEWS: dict[str, str] = {}

VIEWS["re_raw"] = f"""
rr_l AS (
  SELECT doc_id, source, unnest(s) AS line, unnest(range(0, len(s))) AS line_no
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS s FROM documents)),
rr_a AS (
  SELECT doc_id * 1000000000 + line_no AS id, source,
         list_filter(string_split_regex(regexp_replace(line, '[@#*^'':,{{}}"]', ' ', 'g'), '\\s+'),
                     lambda x: x <> '') AS w
  FROM rr_l),
rr_b AS (
  SELECT id, source, w, len(w) AS n FROM rr_a WHERE len(w) >= 2),
rr_c AS (
  SELECT *, CAST({h('re-s', 'id')} % n AS INTEGER) AS s0 FROM rr_b),
rr_d AS (
  SELECT *, CAST((s0 + 1 + {h('re-o', 'id')} % (n - 1)) % n AS INTEGER) AS o0 FROM rr_c),
rr_e AS (
  SELECT id, source, w, w[s0 + 1] AS sw, w[o0 + 1] AS ow,
         length(array_to_string(w[1:s0 + 1], ' ')) - length(w[s0 + 1]) AS ss,
         length(array_to_string(w[1:o0 + 1], ' ')) - length(w[o0 + 1]) AS os,
         ['PER','ORG','DAT','LOC','POH','NOH'][{h('re-ts', 'id')} % 6 + 1] AS st,
         ['PER','ORG','DAT','LOC','POH','NOH'][{h('re-to', 'id')} % 6 + 1] AS ot,
         CAST({h('re-l', 'id')} % 30 AS INTEGER) AS label_id
  FROM rr_d),
re_raw AS (
  SELECT e.id, array_to_string(e.w, ' ') AS sentence,
         {_cell('e.sw', 'e.ss', 'e.ss + length(e.sw) - 1', 'e.st')} AS subject_entity,
         {_cell('e.ow', 'e.os', 'e.os + length(e.ow) - 1', 'e.ot')} AS object_entity,
         ld.label, e.label_id, e.source
  FROM rr_e e JOIN {label_values()} ld ON e.label_id = ld.label_id)"""

VIEWS["parsed"] = f"""
pz AS (
  SELECT *,
    TRY_CAST({_grab('subject_entity', "(?s).*start_idx'':\\s*(\\d+)")} AS INTEGER) AS ss,
    TRY_CAST({_grab('subject_entity', "(?s).*end_idx'':\\s*(\\d+)")} AS INTEGER) AS se,
    {_grab('subject_entity', "(?s).*''type'':\\s*''([A-Z]+)''")} AS s_code,
    TRY_CAST({_grab('object_entity', "(?s).*start_idx'':\\s*(\\d+)")} AS INTEGER) AS os,
    TRY_CAST({_grab('object_entity', "(?s).*end_idx'':\\s*(\\d+)")} AS INTEGER) AS oe,
    {_grab('object_entity', "(?s).*''type'':\\s*''([A-Z]+)''")} AS o_code
  FROM re_raw),
parsed AS (
  SELECT *, {type_case('s_code')} AS subject_type, {type_case('o_code')} AS object_type,
    substring(sentence, ss + 1, greatest(se - ss + 1, 0)) AS subject_word,
    substring(sentence, os + 1, greatest(oe - os + 1, 0)) AS object_word
  FROM pz)"""

VIEWS["marked"] = f"""
marked AS (
  SELECT id, {mark('sentence', 'ss', 'se', 'os', 'oe',
                   "concat('@*', subject_type, '*')", "'@'", "concat('#^', object_type, '^')", "'#'")}
           AS sentence,
         subject_word AS subject_entity, object_word AS object_entity, subject_type, object_type,
         label, label_id, [ss, se] AS subject_idx, [os, oe] AS object_idx, source
  FROM parsed
  WHERE ss IS NOT NULL AND se IS NOT NULL AND os IS NOT NULL AND oe IS NOT NULL
    AND subject_type IS NOT NULL AND object_type IS NOT NULL
    AND se >= ss AND oe >= os AND se < length(sentence) AND oe < length(sentence))"""

VIEWS["variants"] = """
variants AS (
  SELECT id, CASE WHEN label_id % 3 = 0 THEN concat('Zz ', sentence)
                  WHEN label_id % 3 = 1 THEN array_to_string(list_reverse(string_split(sentence, ' ')), ' ')
                  ELSE array_to_string(string_split(sentence, ' ')[3:], ' ') END AS new_sentence
  FROM re_raw)"""

VIEWS["re_scored"] = """
re_scored AS (
  SELECT vec_id AS id, label AS label_id,
         list_transform(embedding[1:30], lambda x: CAST(x AS DOUBLE)) AS z
  FROM embeddings)"""

VIEWS["pred_catalog"] = """
pred_catalog AS (
  SELECT concat('m', CAST(k AS VARCHAR)) AS dataset, d.doc_id AS id, d.text AS sentence, d.source,
         e.label AS label_id,
         list_transform(e.embedding[1 + 17 * k: 30 + 17 * k], lambda x: CAST(x AS DOUBLE)) AS z
  FROM documents d JOIN embeddings e ON d.doc_id % (SELECT count(*) FROM embeddings) = e.vec_id, (SELECT unnest([0, 1, 2]) AS k) m)"""

VIEWS["eval_history"] = """
eval_history AS (SELECT user_id AS run, event_id AS step, value FROM events)"""

VIEWS["span_vectors"] = """
span_vectors AS (
  SELECT CAST(floor(vec_id / 10) AS BIGINT) AS id, vec_id % 10 AS pos, label % 3 AS loc,
         list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vec
  FROM embeddings)"""

_DEPS = {
    "parsed": ["re_raw"],
    "marked": ["parsed"],
    "variants": ["re_raw"],
}


def with_views(names: list[str], body: str, extra: list[str] | None = None) -> str:
    """``WITH <views + their dependencies>, <extra CTEs> <body>``."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [VIEWS[n].strip() for n in order] + [e.strip() for e in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()

"""DuckDB oracle SQL, one per registered query (same output column names)."""

from __future__ import annotations

from oracle.views import h, type_case, BIG, label_values, mark, type_id_case, with_views

SQL: dict[str, str] = {}

SQL["s04_label_dim"] = with_views(["re_raw"], f"""
SELECT CAST(ld.label_id AS BIGINT) AS label_id, ld.label, CAST(coalesce(c.n_rows, 0) AS BIGINT) AS n_rows
FROM {label_values()} ld LEFT JOIN (SELECT label_id, count(*) AS n_rows FROM re_raw GROUP BY label_id) c
  ON ld.label_id = c.label_id""")

SQL["s06_kst_stamp"] = """
SELECT event_id, strftime(timezone('Asia/Seoul', timezone('UTC', ts)), '%y%m%d-%H:%M:%S') AS stamp
FROM events"""

SQL["p01_parse_entity"] = with_views(["parsed"], """
SELECT id, CAST(ss AS BIGINT) ss, CAST(se AS BIGINT) se, s_code, CAST(os AS BIGINT) os,
       CAST(oe AS BIGINT) oe, o_code FROM parsed""")

_LOOSE = """
lz AS (
  SELECT id,
    string_split(subject_entity, 'start_idx') AS sp, string_split(object_entity, 'start_idx') AS op,
    string_split(subject_entity, '''type'': ') AS st, string_split(object_entity, '''type'': ') AS ot
  FROM re_raw),
lz2 AS (
  SELECT id,
    CASE WHEN len(sp) >= 2 THEN regexp_extract_all(sp[2], '[0-9]+') END AS sn,
    CASE WHEN len(op) >= 2 THEN regexp_extract_all(op[2], '[0-9]+') END AS onum,
    CASE WHEN len(st) >= 2 THEN NULLIF(regexp_extract(st[2], '[A-Za-z\\[\\]\\\\^_`]+', 0), '') END AS subject_code,
    CASE WHEN len(ot) >= 2 THEN NULLIF(regexp_extract(ot[2], '[A-Za-z\\[\\]\\\\^_`]+', 0), '') END AS object_code
  FROM lz),
loose AS (
  SELECT l.id, r.sentence, l.subject_code, l.object_code,
    CASE WHEN len(sn) = 2 THEN TRY_CAST(sn[1] AS INTEGER) END AS ss,
    CASE WHEN len(sn) = 2 THEN TRY_CAST(sn[2] AS INTEGER) END AS se,
    CASE WHEN len(onum) = 2 THEN TRY_CAST(onum[1] AS INTEGER) END AS os,
    CASE WHEN len(onum) = 2 THEN TRY_CAST(onum[2] AS INTEGER) END AS oe
  FROM lz2 l JOIN re_raw r ON l.id = r.id)"""

SQL["p02_parse_entity_loose"] = with_views(["re_raw"], """
SELECT id, subject_code, object_code, CAST(ss AS BIGINT) ss, CAST(se AS BIGINT) se,
       CAST(os AS BIGINT) os, CAST(oe AS BIGINT) oe FROM loose""", [_LOOSE])

_DEC = """
dec AS (
  SELECT id, subject_entity, object_entity,
    regexp_extract(subject_entity, '^\\{''word'': ''(.*)'', ''start_idx'': (-?\\d+), ''end_idx'': (-?\\d+), ''type'': ''(.*)''\\}$', ['w', 'a', 'b', 't']) AS s,
    regexp_extract(object_entity, '^\\{''word'': ''(.*)'', ''start_idx'': (-?\\d+), ''end_idx'': (-?\\d+), ''type'': ''(.*)''\\}$', ['w', 'a', 'b', 't']) AS o
  FROM re_raw)"""

SQL["p03_decode_entity"] = with_views(["re_raw"], """
SELECT id, s.w AS s_word, CAST(s.a AS BIGINT) AS s_start, CAST(s.b AS BIGINT) AS s_end, s.t AS s_type,
       o.w AS o_word, CAST(o.a AS BIGINT) AS o_start, CAST(o.b AS BIGINT) AS o_end, o.t AS o_type,
       (concat('{''word'': ''', s.w, ''', ''start_idx'': ', s.a, ', ''end_idx'': ', s.b, ', ''type'': ''', s.t, '''}') = subject_entity
        AND concat('{''word'': ''', o.w, ''', ''start_idx'': ', o.a, ', ''end_idx'': ', o.b, ', ''type'': ''', o.t, '''}') = object_entity) AS roundtrip
FROM dec""", [_DEC])

SQL["p04_map_type"] = with_views(["parsed"], "SELECT id, subject_type, object_type FROM parsed")

SQL["p05_span_text"] = with_views(["parsed"], "SELECT id, subject_word, object_word FROM parsed")

SQL["p06_mark_typed_punct"] = with_views(["marked"], "SELECT id, sentence FROM marked")

_PRE = "regexp_replace(sentence, '[^a-zA-Z0-9가-힣<>/.,!?''\";:()%\\-@*#^~]', ' ', 'g')"
_SPECIAL = ("concat('[SUBJ-', subject_code, ']')", "concat('[/SUBJ-', subject_code, ']')",
            "concat('[OBJ-', object_code, ']')", "concat('[/OBJ-', object_code, ']')")
SQL["p07_mark_special"] = with_views(["re_raw"], f"""
SELECT id, {mark('sentence', 'ss', 'se', 'os', 'oe', *_SPECIAL)} AS marked,
       {mark(_PRE, 'ss', 'se', 'os', 'oe', *_SPECIAL)} AS marked_pre,
       regexp_replace({mark('sentence', 'ss', 'se', 'os', 'oe', *_SPECIAL)}, '[一-龥]', '', 'g') AS marked_chinese
FROM loose""", [_LOOSE])

SQL["p08_marker_vocab"] = with_views(["re_raw"], """
SELECT DISTINCT unnest([concat('[SUBJ-', subject_code, ']'), concat('[/SUBJ-', subject_code, ']'),
                        concat('[OBJ-', object_code, ']'), concat('[/OBJ-', object_code, ']')]) AS token
FROM loose""", [_LOOSE])

SQL["p09_clean_text"] = """
SELECT conv_id, turn,
  regexp_replace(text, '[^a-zA-Z0-9가-힣<>/.,!?''";:()%\\-@*#^~]', ' ', 'g') AS pre,
  regexp_replace(text, '[一-龥]', '', 'g') AS chinese, text AS plain
FROM conversations"""

SQL["p10_strip_foreign"] = """
SELECT conv_id, turn,
  regexp_replace(text, '[^ a-zA-Z0-9가-힣ㄱ-ㅎㅏ-ㅣ!"#$%&''()*+,\\-./:;<=>?@\\[\\]^_`{|}~\\\\]+', '', 'g') AS text_clean
FROM conversations"""

SQL["p11_question"] = with_views(["marked"], """
SELECT id, concat('@*', subject_type, '*', subject_entity, '@와 #^', object_type, '^', object_entity,
                  '#의 관계는 무엇인가요?') AS question FROM marked""")

SQL["p12_label_to_num"] = with_views(["re_raw"], f"""
SELECT r.id, r.label, CAST(ld.label_id AS BIGINT) AS label_id
FROM re_raw r LEFT JOIN {label_values()} ld ON r.label = ld.label""")

_ARGMAX = "CAST(list_position(z, list_max(z)) - 1 AS BIGINT)"

SQL["p13_num_to_label"] = with_views(["re_scored"], f"""
SELECT s.id, s.pred, ld.label AS pred_label
FROM (SELECT id, {_ARGMAX} AS pred FROM re_scored) s LEFT JOIN {label_values()} ld ON s.pred = ld.label_id""")

SQL["p14_marker_spans"] = with_views(["marked"], """
SELECT id, CAST(instr(sentence, '@*') - 1 AS BIGINT) AS s_start,
       CAST(instr(sentence, '@*') - 1 + length(subject_type) + length(subject_entity) + 4 AS BIGINT) AS s_end,
       CAST(instr(sentence, '#^') - 1 AS BIGINT) AS o_start,
       CAST(instr(sentence, '#^') - 1 + length(object_type) + length(object_entity) + 4 AS BIGINT) AS o_end
FROM marked""")

SQL["p15_to_marked"] = with_views(["marked"], """
SELECT id, sentence, subject_entity, object_entity, subject_type, object_type, label,
       array_to_string(subject_idx, ',') AS subject_idx, array_to_string(object_idx, ',') AS object_idx
FROM marked""")


# --- A ---------------------------------------------------------------------------
from oracle.aug import aeda_ctes, delete_ctes, variant_ctes  # noqa: E402

_REANCHOR = """
ra_j AS (
  SELECT r.*, v.new_sentence,
    regexp_extract(r.subject_entity, '^\\{''word'': ''(.*)'', ''start_idx'': (-?\\d+), ''end_idx'': (-?\\d+), ''type'': ''(.*)''\\}$', ['w', 'a', 'b', 't']) AS s,
    regexp_extract(r.object_entity, '^\\{''word'': ''(.*)'', ''start_idx'': (-?\\d+), ''end_idx'': (-?\\d+), ''type'': ''(.*)''\\}$', ['w', 'a', 'b', 't']) AS o
  FROM re_raw r JOIN variants v ON r.id = v.id),
reanchored AS (
  SELECT id, new_sentence AS sentence,
    concat('{''word'': ''', s.w, ''', ''start_idx'': ', instr(new_sentence, s.w) - 1, ', ''end_idx'': ',
           instr(new_sentence, s.w) - 1 + length(s.w) - 1, ', ''type'': ''', s.t, '''}') AS subject_entity,
    concat('{''word'': ''', o.w, ''', ''start_idx'': ', instr(new_sentence, o.w) - 1, ', ''end_idx'': ',
           instr(new_sentence, o.w) - 1 + length(o.w) - 1, ', ''type'': ''', o.t, '''}') AS object_entity,
    label, label_id, source
  FROM ra_j WHERE instr(new_sentence, s.w) > 0 AND instr(new_sentence, o.w) > 0),
aug AS (
  SELECT id, sentence, subject_entity, object_entity, label, label_id, source, 0 AS variant FROM re_raw
  UNION ALL
  SELECT id, sentence, subject_entity, object_entity, label, label_id, source, 1 AS variant FROM reanchored)"""

SQL["a01_reanchor"] = with_views(["variants"], """
SELECT id, sentence, subject_entity, object_entity, label FROM reanchored""", [_REANCHOR])

SQL["a02_append_variants"] = with_views(["variants"], """
SELECT id, CAST(variant AS BIGINT) AS variant, sentence, subject_entity, object_entity, label FROM aug""",
                                        [_REANCHOR])

_M0 = "m0 AS (SELECT *, 0 AS variant FROM marked)"

SQL["a03_aeda"] = with_views(["marked"], """
SELECT id, CAST(variant AS BIGINT) AS variant, CAST(draw AS BIGINT) AS draw, new_sentence AS sentence FROM ae""",
                             [_M0] + aeda_ctes("m0", "aeda", 1, "ae"))

SQL["a04_punc_ratio"] = with_views(["marked"], """
SELECT id, CASE WHEN length(sentence) <= 200 THEN 0.2 WHEN length(sentence) <= 300 THEN 0.3 ELSE 0.35 END::DOUBLE AS ratio
FROM marked""")

SQL["a05_n_variants"] = with_views(["marked"], """
SELECT id, CAST(new_variant AS BIGINT) AS variant, new_sentence AS sentence FROM nv""",
                                   [_M0] + variant_ctes("m0", "aeda", 4, "nv"))

SQL["a06_entity_intact"] = with_views(["marked"], """
SELECT a.id, CAST(a.variant AS BIGINT) AS variant, CAST(a.draw AS BIGINT) AS draw, a.new_sentence AS sentence
FROM ae3 a JOIN m0 ON a.id = m0.id AND a.variant = m0.variant
WHERE instr(a.new_sentence, a.s_txt) > 0 AND instr(a.new_sentence, a.o_txt) > 0""",
                                      [_M0] + aeda_ctes("m0", "aeda6", 3, "ae3"))

SQL["a07_squeeze_ws"] = """
SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text_squeezed FROM conversations"""

SQL["a08_random_delete"] = with_views(["marked"], """
SELECT id, CAST(variant AS BIGINT) AS variant, new_sentence AS sentence FROM rdel""",
                                      [_M0] + delete_ctes("m0", "rd", 0.3, "rdel"))

SQL["a09_rd"] = with_views(["marked"], """
SELECT id, new_sentence AS sentence,
  CAST(instr(sentence, '@*') - 1 AS VARCHAR) || ',' ||
    CAST(instr(sentence, '@*') - 1 + length(subject_type) + length(subject_entity) + 4 AS VARCHAR) AS subject_idx,
  CAST(instr(sentence, '#^') - 1 AS VARCHAR) || ',' ||
    CAST(instr(sentence, '#^') - 1 + length(object_type) + length(object_entity) + 4 AS VARCHAR) AS object_idx
FROM rdel""", [_M0] + delete_ctes("m0", "rd", 0.3, "rdel"))

SQL["a10_carry_label"] = with_views(["marked"], """
SELECT id, CAST(variant * 8 AS BIGINT) AS variant, label, CAST(label_id AS BIGINT) AS label_id FROM m0
UNION ALL
SELECT n.id, CAST(n.new_variant AS BIGINT), n.label, CAST(n.label_id AS BIGINT) FROM nv n""", [_M0] + variant_ctes("m0", "aeda", 8, "nv"))

# --- D ---------------------------------------------------------------------------

_SPLIT = """
dk AS (SELECT *, md5(concat_ws(':', '42', CAST(id AS VARCHAR), CAST(variant AS VARCHAR))) AS key FROM aug),
dq AS (SELECT label_id, count(*) AS n, count(*) // 10 AS quota FROM dk GROUP BY label_id),
df AS (SELECT id, min(key) AS key FROM dk GROUP BY id),
dc AS (SELECT dk.key, dk.label_id, row_number() OVER (PARTITION BY dk.label_id ORDER BY dk.key) AS rk
       FROM dk JOIN df ON dk.id = df.id AND dk.key = df.key),
dv AS (SELECT dc.key FROM dc JOIN dq ON dc.label_id = dq.label_id WHERE dc.rk <= dq.quota),
split AS (
  SELECT dk.id, dk.variant, dk.label_id, CASE WHEN dv.key IS NOT NULL THEN 'valid' ELSE 'train' END AS part
  FROM dk LEFT JOIN dv ON dk.key = dv.key)"""

SQL["d01_shuffle_key"] = with_views(["variants"], """
SELECT id, CAST(variant AS BIGINT) AS variant, key FROM dk""", [_REANCHOR, _SPLIT])

SQL["d02_quota"] = with_views(["variants"], """
SELECT CAST(label_id AS BIGINT) AS label_id, n, CAST(quota AS BIGINT) AS quota FROM dq""", [_REANCHOR, _SPLIT])

SQL["d03_holdout"] = with_views(["variants"], """
SELECT id, CAST(variant AS BIGINT) AS variant, CAST(label_id AS BIGINT) AS label_id, part FROM split""",
                                [_REANCHOR, _SPLIT])

SQL["d04_split_counts"] = with_views(["variants"], """
SELECT part, count(*) AS n_rows FROM split GROUP BY part""", [_REANCHOR, _SPLIT])

SQL["d05_holdout_group_safe"] = with_views(["variants"], """
SELECT s.id, CAST(s.variant AS BIGINT) AS variant, CAST(s.label_id AS BIGINT) AS label_id,
  CASE WHEN s.part = 'train' AND s.id IN (SELECT id FROM split WHERE part = 'valid') THEN 'dropped' ELSE s.part END AS part
FROM split s""", [_REANCHOR, _SPLIT])

# --- M / I -------------------------------------------------------------------------


def r6(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {name}"


_SC = """
sc0 AS (SELECT id, label_id, z, list_max(z) AS mx FROM re_scored),
sc1 AS (SELECT *, mx + ln(list_sum(list_transform(z, lambda x: exp(x - mx)))) AS lse FROM sc0),
sc AS (SELECT *, list_transform(z, lambda x: x - lse) AS lsm, list_transform(z, lambda x: exp(x - lse)) AS p,
              CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS pred FROM sc1)"""

_F1 = ("coalesce(2.0::DOUBLE * sum(CASE WHEN pred = label_id AND label_id <> 0 THEN 1 ELSE 0 END) / "
       "NULLIF(sum(CASE WHEN pred <> 0 THEN 1 ELSE 0 END) + sum(CASE WHEN label_id <> 0 THEN 1 ELSE 0 END), 0)"
       " * 100.0, 0.0)")
_ACC = "avg(CASE WHEN pred = label_id THEN 1.0 ELSE 0.0 END)"
_AUPRC = """
lg AS (SELECT label_id AS y, unnest(z) AS score, unnest(range(0, len(z))) AS cls FROM re_scored),
pts AS (SELECT cls, score, sum(CASE WHEN y = cls THEN 1 ELSE 0 END)::DOUBLE AS tp_c,
               sum(CASE WHEN y <> cls THEN 1 ELSE 0 END)::DOUBLE AS fp_c FROM lg GROUP BY cls, score),
cum AS (SELECT *, sum(tp_c) OVER (PARTITION BY cls ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(fp_c) OVER (PARTITION BY cls ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM pts),
pos AS (SELECT cls, sum(tp_c) AS pp FROM pts GROUP BY cls),
ar AS (SELECT c.cls, sum((tp / pp - (tp - tp_c) / pp) *
         (tp / (tp + fp) + CASE WHEN (tp - tp_c) + (fp - fp_c) = 0 THEN 1.0
                                ELSE (tp - tp_c) / ((tp - tp_c) + (fp - fp_c)) END) / 2.0) AS auprc
       FROM cum c JOIN pos ON c.cls = pos.cls WHERE pp > 0 GROUP BY c.cls),
au AS (SELECT avg(auprc) * 100.0 AS auprc FROM ar)"""

SQL["m01_micro_f1"] = with_views(["re_scored"], f"SELECT {r6(_F1, 'micro_f1')} FROM sc", [_SC])
SQL["m02_auprc"] = with_views(["re_scored"], f"SELECT {r6('auprc', 'auprc')} FROM au", [_AUPRC])
SQL["m03_accuracy"] = with_views(["re_scored"], f"SELECT {r6(_ACC, 'accuracy')} FROM sc", [_SC])
SQL["m04_compute_metrics"] = with_views(["re_scored"], f"""
SELECT {r6('a.micro_f1', 'micro_f1')}, {r6('au.auprc', 'auprc')}, {r6('a.accuracy', 'accuracy')}
FROM (SELECT {_F1} AS micro_f1, {_ACC} AS accuracy FROM sc) a, au""", [_SC, _AUPRC])
SQL["m05_cross_entropy"] = with_views(["re_scored"], f"SELECT {r6('avg(lse - z[label_id + 1])', 'ce')} FROM sc",
                                      [_SC])
SQL["m06_focal"] = with_views(["re_scored"], f"""
SELECT {r6('avg(-pow(1.0 - exp(lsm[label_id + 1]), 2.0) * lsm[label_id + 1])', 'focal')} FROM sc""", [_SC])
SQL["m07_label_smooth"] = with_views(["re_scored"], f"""
SELECT {r6('avg(-((1.0 - 0.1) * lsm[label_id + 1] + (0.1 / (len(z) - 1.0)) * (list_sum(lsm) - lsm[label_id + 1])))',
           'label_smooth')} FROM sc""", [_SC])
SQL["m08_soft_f1"] = with_views(["re_scored"], f"""
SELECT {r6('1.0 - avg(least(greatest(f1, 1e-7), 1.0 - 1e-7))', 'soft_f1')}
FROM (SELECT cls, 2.0 * pr * rc / (pr + rc + 1e-7) AS f1
      FROM (SELECT cls, tp / (tp + fp + 1e-7) AS pr, tp / (tp + fn + 1e-7) AS rc
            FROM (SELECT cls, sum(y * pv) AS tp, sum((1.0 - y) * pv) AS fp, sum(y * (1.0 - pv)) AS fn
                  FROM (SELECT CASE WHEN label_id = cls THEN 1.0 ELSE 0.0 END AS y, pv, cls
                        FROM (SELECT label_id, unnest(p) AS pv, unnest(range(0, len(p))) AS cls FROM sc))
                  GROUP BY cls)))""", [_SC])

_PLATEAU = """
pe AS (SELECT run, step, value FROM eval_history WHERE value >= 0),
pa AS (SELECT *, {agg}(value) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
              row_number() OVER (PARTITION BY run ORDER BY step) AS rn FROM pe),
pb AS (SELECT *, (prev IS NULL OR value {cmp} prev) AS best FROM pa),
pc AS (SELECT *, max(CASE WHEN best THEN rn ELSE 0 END) OVER (PARTITION BY run ORDER BY step ROWS UNBOUNDED PRECEDING) AS lst FROM pb),
pd AS (SELECT *, rn - lst AS patience_cnt FROM pc),
pf AS (SELECT run, min(rn) AS stop_rn FROM pd WHERE patience_cnt >= {patience} GROUP BY run),
plateau AS (SELECT pd.run, pd.step, pd.value, pd.best, CAST(pd.patience_cnt AS BIGINT) AS patience_cnt,
                   coalesce(pd.rn >= pf.stop_rn, false) AS stop FROM pd LEFT JOIN pf ON pd.run = pf.run)"""

SQL["m09_plateau"] = with_views(["eval_history"], "SELECT run, step, best, patience_cnt, stop FROM plateau",
                                [_PLATEAU.format(agg="min", cmp="<", patience=5)])
SQL["m10_best_step"] = with_views(["eval_history"], f"""
SELECT b.run, b.best_step, {r6('b.best_value', 'best_value')}, s.stop_step
FROM (SELECT e.run, min(e.step) AS best_step, any_value(m.best_value) AS best_value
      FROM pe e JOIN (SELECT run, max(value) AS best_value FROM pe GROUP BY run) m
        ON e.run = m.run AND e.value = m.best_value GROUP BY e.run) b
LEFT JOIN (SELECT run, min(step) AS stop_step FROM plateau WHERE stop GROUP BY run) s ON b.run = s.run""",
                                 [_PLATEAU.format(agg="max", cmp=">", patience=5)])

SQL["i02_score"] = with_views(["re_scored"], """
SELECT id, CAST(list_position(l, list_max(l)) - 1 AS BIGINT) AS prediction,
       array_to_string(list_transform(l, lambda x: printf('%.6f', x)), ',') AS logits
FROM (SELECT id, list_transform(range(30), lambda c: c / 64.0::DOUBLE
        + list_dot_product(z, list_transform(range(30), lambda j: (((7 * c + 3 * j) % 11) - 5) / 8.0::DOUBLE))) AS l FROM re_scored)""")
SQL["i03_softmax"] = with_views(["re_scored"], """
SELECT id, array_to_string(list_transform(p, lambda x: printf('%.6f', x)), ',') AS p FROM sc""", [_SC])
SQL["i04_argmax"] = with_views(["re_scored"], "SELECT id, CAST(pred AS BIGINT) AS pred FROM sc", [_SC])
SQL["i05_submission"] = with_views(["re_scored"], f"""
SELECT sc.id, ld.label AS pred_label,
       '[' || array_to_string(list_transform(p, lambda x: printf('%.6f', x)), ', ') || ']' AS probs
FROM sc LEFT JOIN {label_values()} ld ON sc.pred = ld.label_id""", [_SC])
SQL["i06_scored_dev"] = with_views(["re_scored"], """
SELECT id, CAST(label_id AS BIGINT) AS label_id,
       array_to_string(list_transform(p, lambda x: printf('%.3f', x)), ' ') AS output_prob FROM sc""", [_SC])

# --- E ---------------------------------------------------------------------------

_CAT = f"""
ct0 AS (SELECT dataset, id, sentence, label_id, z, list_max(z) AS mx FROM pred_catalog),
ct1 AS (SELECT *, mx + ln(list_sum(list_transform(z, lambda x: exp(x - mx)))) AS lse FROM ct0),
ct2 AS (SELECT *, array_to_string(list_transform(z, lambda x: printf('%.3f', exp(x - lse))), ' ') AS output_prob FROM ct1),
ct3 AS (SELECT *, list_transform(string_split_regex(trim(output_prob), '\\s+'), lambda x: TRY_CAST(x AS DOUBLE)) AS pr
        FROM ct2),
cat AS (
  SELECT c.dataset, c.id, c.sentence, c.label_id, c.output_prob, c.pr,
    CAST(c.label_id AS INTEGER) AS num_label,
    CAST(list_position(c.pr, list_max(c.pr)) - 1 AS INTEGER) AS num_pred,
    ld.label AS pred,
    list_max(c.pr) AS pred_confidence,
    c.pr[c.label_id + 1] AS label_confidence,
    CASE WHEN CAST(list_position(c.pr, list_max(c.pr)) - 1 AS INTEGER) = c.label_id THEN 1 ELSE 0 END AS answer,
    length(c.sentence) - length(replace(c.sentence, ' ', '')) AS sentence_space,
    length(c.sentence) AS sentence_len,
    len(list_filter(string_split_regex(c.sentence, '\\s+'), lambda x: x <> '')) AS sentence_token_num
  FROM ct3 c LEFT JOIN {label_values()} ld ON CAST(list_position(c.pr, list_max(c.pr)) - 1 AS INTEGER) = ld.label_id)"""

_FEAT_SQL = f"""dataset, id, CAST(num_label AS BIGINT) AS num_label, CAST(num_pred AS BIGINT) AS num_pred, pred,
  {r6('pred_confidence', 'pred_confidence')}, {r6('label_confidence', 'label_confidence')},
  CAST(answer AS BIGINT) AS answer"""
_TEXT_SQL = """CAST(sentence_space AS BIGINT) AS sentence_space, CAST(sentence_len AS BIGINT) AS sentence_len,
  CAST(sentence_token_num AS BIGINT) AS sentence_token_num"""


def cat_sql(body: str, extra: list[str] | None = None) -> str:
    return with_views(["pred_catalog"], body, [_CAT] + (extra or []))


SQL["e01_catalog_select"] = with_views(["pred_catalog"], """
SELECT dataset, id, CAST(label_id AS BIGINT) AS label_id FROM pred_catalog WHERE dataset IN ('m0', 'm2')""")
SQL["e02_catalog_list"] = with_views(["pred_catalog"], """
SELECT dataset, count(*) AS n_rows FROM pred_catalog GROUP BY dataset""")
SQL["e03_column_roles"] = cat_sql(f"SELECT {_FEAT_SQL}, {_TEXT_SQL} FROM cat")

_STATS = ", ".join([
    "count(x) AS count", r6("CAST(sum(CAST(x AS DECIMAL(28,9))) AS DOUBLE) / count(x)", "mean"), r6("stddev_samp(x)", "std"), r6("min(x)", "min"),
    r6("max(x)", "max"), r6("quantile_cont(x, 0.25)", "q25"), r6("quantile_cont(x, 0.5)", "q50"),
    r6("quantile_cont(x, 0.75)", "q75")])
SQL["e04_describe"] = cat_sql(f"""
SELECT dataset, "column", {_STATS}
FROM (SELECT dataset, 'label_confidence' AS "column", CAST(label_confidence AS DOUBLE) AS x FROM cat
      UNION ALL SELECT dataset, 'pred_confidence', CAST(pred_confidence AS DOUBLE) FROM cat
      UNION ALL SELECT dataset, 'sentence_len', CAST(sentence_len AS DOUBLE) FROM cat)
GROUP BY dataset, "column" """)
SQL["e05_decode_probs"] = cat_sql("""
SELECT dataset, id, array_to_string(list_transform(pr, lambda x: printf('%.6f', x)), ',') AS probs FROM cat""")
SQL["e06_prediction_features"] = cat_sql(f"SELECT {_FEAT_SQL} FROM cat")
SQL["e07_text_features"] = cat_sql(f"SELECT dataset, id, {_TEXT_SQL} FROM cat")

_IQR = """
iq0 AS (SELECT dataset, quantile_cont(sentence_len, 0.25) AS q1, quantile_cont(sentence_len, 0.75) AS q3
        FROM cat GROUP BY dataset),
iqr AS (SELECT dataset, q1 - 1.5 * (q3 - q1) AS t0, q1 AS t1, q3 AS t2, q3 + 1.5 * (q3 - q1) AS t3 FROM iq0),
bk AS (SELECT cat.*, iqr.t0, iqr.t1, iqr.t2, iqr.t3,
         (CASE WHEN sentence_len >= t0 THEN 1 ELSE 0 END) + (CASE WHEN sentence_len >= t1 THEN 1 ELSE 0 END)
       + (CASE WHEN sentence_len >= t2 THEN 1 ELSE 0 END) + (CASE WHEN sentence_len >= t3 THEN 1 ELSE 0 END) AS bucket
       FROM cat JOIN iqr ON cat.dataset = iqr.dataset)"""

SQL["e08_iqr_thresholds"] = cat_sql(f"""
SELECT dataset, {r6('t0', 't0')}, {r6('t1', 't1')}, {r6('t2', 't2')}, {r6('t3', 't3')} FROM iqr""", [_IQR])
SQL["e09_percentile_thresholds"] = cat_sql(f"""
SELECT dataset, {r6('quantile_cont(label_confidence, 0.1)', 't0')}, {r6('quantile_cont(label_confidence, 0.5)', 't1')},
       {r6('quantile_cont(label_confidence, 0.9)', 't2')} FROM cat GROUP BY dataset""")
SQL["e10_bucketize"] = cat_sql("SELECT dataset, id, CAST(bucket AS BIGINT) AS bucket FROM bk", [_IQR])
SQL["e11_bucket_labels"] = cat_sql("""
SELECT dataset, CAST(0 AS BIGINT) AS bucket, '~' || printf('%.2f', t0) AS label FROM iqr
UNION ALL SELECT dataset, 1, printf('%.2f', t0) FROM iqr
UNION ALL SELECT dataset, 2, printf('%.2f', t1) FROM iqr
UNION ALL SELECT dataset, 3, printf('%.2f', t2) FROM iqr
UNION ALL SELECT dataset, 4, printf('%.2f', t3) FROM iqr""", [_IQR])
SQL["e12_bucket_stats"] = cat_sql(f"""
SELECT dataset, CAST(bucket AS BIGINT) AS bucket, count(*) AS count,
  {r6('CAST(sum(CAST(label_confidence AS DECIMAL(28,9))) AS DOUBLE) / count(label_confidence)', 'label_confidence_mean')}, {r6('stddev_samp(label_confidence)', 'label_confidence_std')},
  {r6('CAST(sum(CAST(answer AS DECIMAL(28,9))) AS DOUBLE) / count(answer)', 'answer_mean')}, {r6('stddev_samp(answer)', 'answer_std')}
FROM bk GROUP BY dataset, bucket""", [_IQR])
SQL["e13_bucket_pearson"] = cat_sql(f"""
SELECT dataset, CAST(bucket AS BIGINT) AS bucket, count(*) AS count,
  {r6('CASE WHEN count(*) >= 2 AND var_samp(pred_confidence) > 0 AND var_samp(label_confidence) > 0 THEN corr(pred_confidence, label_confidence) END', 'pred_confidence_label_confidence_pearson')}
FROM bk GROUP BY dataset, bucket""", [_IQR])
SQL["e14_group_stats"] = cat_sql(f"""
SELECT g.dataset, CAST(g.class_id AS BIGINT) AS class_id, coalesce(a.count, 0) AS count,
  {r6('a.mean', 'mean')}, {r6('a.std', 'std')}, ld.label AS class_name
FROM (SELECT d.dataset, unnest(range(0, 30)) AS class_id FROM (SELECT DISTINCT dataset FROM cat) d) g
LEFT JOIN (SELECT dataset, num_label AS class_id, count(*) AS count, CAST(sum(CAST(label_confidence AS DECIMAL(28,9))) AS DOUBLE) / count(label_confidence) AS mean,
                  stddev_samp(label_confidence) AS std FROM cat GROUP BY dataset, num_label) a
  ON g.dataset = a.dataset AND g.class_id = a.class_id
LEFT JOIN {label_values()} ld ON g.class_id = ld.label_id""")


def box_sql(src: str, group: list[str], x: str) -> str:
    g = ", ".join(group)
    on = " AND ".join(f"s.{c} = q.{c}" for c in group)
    gs = ", ".join(f"s.{c}" for c in group)
    return f"""
SELECT {gs}, count(*) AS n, {r6(f'min(s.{x})', 'min')}, {r6(f'max(s.{x})', 'max')},
  {r6(f'min(s.{x}) FILTER (WHERE s.{x} >= q.q1 - 1.5 * (q.q3 - q.q1))', 'lower_whisker')},
  {r6(f'max(s.{x}) FILTER (WHERE s.{x} <= q.q3 + 1.5 * (q.q3 - q.q1))', 'upper_whisker')},
  count(*) FILTER (WHERE s.{x} < q.q1 - 1.5 * (q.q3 - q.q1) OR s.{x} > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers,
  {r6('q.q1', 'q1')}, {r6('q.median', 'median')}, {r6('q.q3', 'q3')}
FROM {src} s JOIN (SELECT {g}, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median,
                          quantile_cont({x}, 0.75) AS q3
                   FROM {src} WHERE {x} IS NOT NULL GROUP BY {g}) q ON {on}
WHERE s.{x} IS NOT NULL
GROUP BY {gs}, q.q1, q.median, q.q3"""


SQL["e15_conditional_dist"] = cat_sql(box_sql("bk", ["dataset", "bucket"], "label_confidence")
                                      .replace("SELECT s.dataset, s.bucket,", "SELECT s.dataset, CAST(s.bucket AS BIGINT) AS bucket,"),
                                      [_IQR])
SQL["e16_group_dist"] = cat_sql(box_sql("cat", ["dataset"], "label_confidence"))
_FIXED = """
fb AS (SELECT cat.*, (CASE WHEN pred_confidence >= 0.3 THEN 1 ELSE 0 END) + (CASE WHEN pred_confidence >= 0.6 THEN 1 ELSE 0 END)
                    + (CASE WHEN pred_confidence >= 0.9 THEN 1 ELSE 0 END) AS bucket FROM cat)"""
SQL["e17_condition_group_dist"] = cat_sql(box_sql("fb", ["dataset", "bucket"], "sentence_len")
                                          .replace("SELECT s.dataset, s.bucket,", "SELECT s.dataset, CAST(s.bucket AS BIGINT) AS bucket,"),
                                          [_FIXED])
SQL["e18_histogram"] = cat_sql("""
SELECT c.dataset, CAST(CASE WHEN (r.mx - r.mn) / 10 > 0 THEN least(9, CAST(floor((c.label_confidence - r.mn) / ((r.mx - r.mn) / 10)) AS INTEGER))
                       ELSE 0 END AS BIGINT) AS bin, count(*) AS count
FROM cat c JOIN (SELECT dataset, min(label_confidence) AS mn, max(label_confidence) AS mx FROM cat GROUP BY dataset) r
  ON c.dataset = r.dataset
WHERE c.label_confidence IS NOT NULL
GROUP BY 1, 2""")
SQL["e19_scatter_points"] = cat_sql(f"""
SELECT dataset, id, CAST(sentence_len AS BIGINT) AS sentence_len, {r6('label_confidence', 'label_confidence')},
  CAST(num_label AS BIGINT) AS num_label, {r6('pred_confidence', 'pred_confidence')} FROM cat""")
SQL["e20_bar_points"] = cat_sql(f"SELECT dataset, pred AS x, {r6('label_confidence', 'y')}, CAST(answer AS BIGINT) AS text FROM cat")
SQL["e21_filter_contains"] = with_views(["pred_catalog"], """
SELECT dataset, id FROM pred_catalog WHERE regexp_matches(sentence, 'qu[aeiou]')""")
SQL["e22_filter_by_reference"] = cat_sql("""
SELECT dataset, id, pred FROM cat
WHERE id IN (SELECT id FROM cat WHERE dataset = 'm1' AND regexp_matches(pred, '^per:'))""")

# --- F ---------------------------------------------------------------------------

_TOK = "list_filter(string_split_regex(regexp_replace({s}, '([@*#^])', ' \\1 ', 'g'), '\\s+'), lambda x: x <> '')"
_SPEC = "(SELECT * FROM (VALUES ('[PAD]', 0), ('[UNK]', 1), ('[CLS]', 2), ('[SEP]', 3), ('[MASK]', 4)) t(token, token_id))"
_VOCAB = f"""
tk AS (SELECT id, label_id, subject_type, object_type, {_TOK.format(s='sentence')} AS tokens,
              {_TOK.format(s="concat('@*', subject_type, '*', subject_entity, '@와 #^', object_type, '^', object_entity, '#의 관계는 무엇인가요?')")} AS qtokens
       FROM marked),
mk0 AS (SELECT DISTINCT unnest([concat('[SUBJ-', subject_code, ']'), concat('[/SUBJ-', subject_code, ']'),
                                concat('[OBJ-', object_code, ']'), concat('[/OBJ-', object_code, ']')]) AS token FROM loose),
mk AS (SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 + 5 AS INTEGER) AS token_id
       FROM mk0 WHERE token NOT IN (SELECT token FROM {_SPEC})),
cnt AS (SELECT token, count(*) AS count FROM (SELECT unnest(tokens) AS token FROM tk) GROUP BY token),
top AS (SELECT token, count, CAST(row_number() OVER (ORDER BY count DESC, token) - 1 + 5 + (SELECT count(*) FROM mk) AS INTEGER) AS token_id
        FROM cnt WHERE token NOT IN (SELECT token FROM {_SPEC}) AND token NOT IN (SELECT token FROM mk)),
vocab AS (SELECT token, token_id, CAST(NULL AS BIGINT) AS count FROM {_SPEC}
          UNION ALL SELECT token, token_id, NULL FROM mk
          UNION ALL SELECT token, token_id, count FROM top),
enc_l AS (SELECT t.id, u.pos, coalesce(v.token_id, 1) AS tid
          FROM (SELECT id, unnest(tokens[1:254]) AS tok, unnest(range(0, len(tokens[1:254]))) AS pos FROM tk) u
          JOIN tk t ON t.id = u.id LEFT JOIN vocab v ON u.tok = v.token),
enc AS (SELECT id, [2] || list(tid ORDER BY pos) || [3] AS ids FROM enc_l GROUP BY id),
encp AS (SELECT id, ids || list_transform(range(0, 256 - len(ids)), lambda x: 0) AS ids FROM enc)"""


def fsql(body: str, extra: list[str] | None = None) -> str:
    return with_views(["marked"], body, [_LOOSE, _VOCAB] + (extra or []))


SQL["f01_build_vocab"] = fsql("SELECT token, CAST(token_id AS BIGINT) AS token_id, count FROM vocab")
SQL["f02_encode"] = fsql("SELECT id, array_to_string(ids, ',') AS input_ids FROM encp")
SQL["f04_masks"] = fsql("""
SELECT id, array_to_string(list_transform(ids, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END), ',') AS attention_mask,
       array_to_string(list_transform(ids, lambda x: 0), ',') AS token_type_ids FROM encp""")
SQL["f08_position_ids"] = fsql("""
SELECT id, array_to_string(list(CASE WHEN x <> 0 THEN c ELSE 0 END ORDER BY pos), ',') AS position_ids
FROM (SELECT id, x, pos, sum(CASE WHEN x <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY pos) AS c
      FROM (SELECT id, unnest(ids) AS x, unnest(range(0, len(ids))) AS pos FROM encp))
GROUP BY id""")
_PAIR = """
pr0 AS (SELECT id, tokens AS a, qtokens AS b, len(tokens) AS la, len(qtokens) AS lb FROM tk),
pr1 AS (SELECT *, greatest(0, la + lb + 3 - 256) AS ex FROM pr0),
pr2 AS (SELECT *, least(abs(la - lb), ex) AS fst FROM pr1),
pr3 AS (SELECT *, CASE WHEN la > lb THEN fst + (ex - fst) // 2 ELSE (ex - fst) // 2 END AS acut,
                  CASE WHEN la > lb THEN (ex - fst) - (ex - fst) // 2 ELSE fst + (ex - fst) - (ex - fst) // 2 END AS bcut FROM pr2),
pr AS (SELECT id, a[1:la - acut] AS a, b[1:lb - bcut] AS b FROM pr3)"""
SQL["f03_encode_pair"] = fsql("""
SELECT id, array_to_string(ids || list_transform(range(0, 256 - len(ids)), lambda x: 0), ',') AS input_ids,
       array_to_string(tt || list_transform(range(0, 256 - len(tt)), lambda x: 0), ',') AS token_type_ids
FROM (SELECT id, [2] || list(tid ORDER BY seg, pos) FILTER (WHERE seg = 0) || [3]
                 || coalesce(list(tid ORDER BY seg, pos) FILTER (WHERE seg = 1), []) || [3] AS ids,
             list_transform(range(0, count(*) FILTER (WHERE seg = 0) + 2), lambda x: 0)
               || list_transform(range(0, count(*) FILTER (WHERE seg = 1) + 1), lambda x: 1) AS tt
      FROM (SELECT u.id, u.seg, u.pos, coalesce(v.token_id, 1) AS tid
            FROM (SELECT id, 0 AS seg, unnest(a) AS tok, unnest(range(0, len(a))) AS pos FROM pr
                  UNION ALL SELECT id, 1, unnest(b), unnest(range(0, len(b))) FROM pr) u
            LEFT JOIN vocab v ON u.tok = v.token)
      GROUP BY id)""", [_PAIR])
_LOC = """
ft AS (SELECT id, subject_type, object_type, ['[CLS]'] || tokens[1:254] || ['[SEP]'] AS t FROM tk),
fp AS (SELECT *, coalesce(list_filter(range(0, len(t)), lambda i: t[i + 1] = '*')[-1], -1) AS s1,
                 coalesce(list_filter(range(0, len(t)), lambda i: t[i + 1] = '@')[-1], -1) AS s2,
                 coalesce(list_filter(range(0, len(t)), lambda i: t[i + 1] = '^')[-1], -1) AS o1,
                 coalesce(list_filter(range(0, len(t)), lambda i: t[i + 1] = '#')[-1], -1) AS o2 FROM ft),
loc AS (SELECT id, subject_type, object_type, list_transform(range(0, 256), lambda i:
          CASE WHEN i > o1 AND i < o2 THEN 2 WHEN i > s1 AND i < s2 THEN 1 ELSE 0 END) AS l FROM fp)"""
SQL["f05_entity_loc_ids"] = fsql("SELECT id, array_to_string(l, ',') AS entity_loc_ids FROM loc", [_LOC])
SQL["f07_entity_type_ids"] = fsql(f"""
SELECT id, array_to_string(list_transform(l, lambda x: CASE WHEN x = 1 THEN {type_id_case('subject_type')}
                                                      WHEN x = 2 THEN {type_id_case('object_type')} ELSE 0 END), ',')
       AS entity_type_ids FROM loc""", [_LOC])
_LOC2 = """
pf AS (SELECT id, ['[CLS]'] || a || ['[SEP]'] || b || ['[SEP]'] AS t FROM pr),
pp AS (SELECT id, list_filter(range(0, len(t)), lambda i: t[i + 1] = '*') AS st, list_filter(range(0, len(t)), lambda i: t[i + 1] = '@') AS sa,
                 list_filter(range(0, len(t)), lambda i: t[i + 1] = '^') AS ot, list_filter(range(0, len(t)), lambda i: t[i + 1] = '#') AS oh FROM pf),
pq AS (SELECT id, coalesce(st[2], -1) AS s2a, coalesce(sa[2], -1) AS s2b, coalesce(st[4], -1) AS s4a, coalesce(sa[4], -1) AS s4b,
                  coalesce(ot[2], -1) AS o2a, coalesce(oh[2], -1) AS o2b, coalesce(ot[4], -1) AS o4a, coalesce(oh[4], -1) AS o4b FROM pp)"""
SQL["f06_entity_loc_ids_pair"] = fsql("""
SELECT id, array_to_string(list_transform(range(0, 256), lambda i:
  CASE WHEN i > o4a AND i < o4b THEN 2 WHEN i > o2a AND i < o2b THEN 2
       WHEN i > s4a AND i < s4b THEN 1 WHEN i > s2a AND i < s2b THEN 1 ELSE 0 END), ',') AS entity_loc_ids FROM pq""",
                                      [_PAIR, _LOC2])
_SPAN = """
sv AS (SELECT id, loc, dim, avg(x) AS m
       FROM (SELECT id, loc, unnest(vec) AS x, unnest(range(0, len(vec))) AS dim FROM span_vectors WHERE loc IN (1, 2))
       GROUP BY id, loc, dim),
smean AS (SELECT id, loc, list(m ORDER BY dim) AS mean FROM sv GROUP BY id, loc)"""
SQL["f09_span_mean"] = with_views(["span_vectors"], """
SELECT id, CAST(loc AS BIGINT) AS loc, array_to_string(list_transform(mean, lambda x: printf('%.6f', x)), ',') AS mean
FROM smean""", [_SPAN])
SQL["f10_concat_features"] = with_views(["span_vectors"], """
SELECT c.id, CASE WHEN s.mean IS NULL OR o.mean IS NULL THEN NULL
                  ELSE array_to_string(list_transform(c.cls || s.mean || o.mean, lambda x: printf('%.6f', x)), ',') END AS features
FROM (SELECT id, arg_min(vec, pos) AS cls FROM span_vectors GROUP BY id) c
LEFT JOIN (SELECT id, mean FROM smean WHERE loc = 1) s ON c.id = s.id
LEFT JOIN (SELECT id, mean FROM smean WHERE loc = 2) o ON c.id = o.id""", [_SPAN])

# --- S ---------------------------------------------------------------------------

SQL["s01_csv_scan"] = with_views(["re_raw"], "SELECT id, sentence, subject_entity, object_entity, label, source FROM re_raw")
SQL["s02_csv_scan_index"] = SQL["s01_csv_scan"]
SQL["s03_load_catalog"] = cat_sql("""
SELECT dataset, id, CAST(CASE WHEN dataset = 'm1' THEN (label_id + 1) % 30 ELSE label_id END AS BIGINT) AS label_id, output_prob FROM cat""")


def _hard_cell(e: str, end: str, typ: str) -> str:
    return (f"concat('{{''word'': ''', substring(sentence, {e}0 + 1, 6), ''', ''start_idx'': ', CAST({e}0 AS VARCHAR), "
            f"', ''end_idx'': ', CAST({end} AS VARCHAR), ', ''type'': ''', {typ}, '''}}')")


def _hard_int(cell: str, name: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({cell}, '(?s).*{name}'':\\s*(\\d+)', 1), '') AS INTEGER)"


def _hard_type(cell: str) -> str:
    return type_case(f"regexp_extract({cell}, '(?s).*''type'':\\s*''([A-Z]+)''', 1)")


def _hard_loose(cell: str) -> str:
    """Whether the loose reader finds exactly two numbers after the first start, and a type."""
    numbers = f"regexp_extract_all(string_split({cell}, 'start_idx')[2], '[0-9]+')"
    code = f"regexp_matches(string_split({cell}, '''type'': ')[2], '[A-Za-z\\[\\]\\\\^_`]')"
    return f"coalesce(len({numbers}) = 2 AND TRY_CAST({numbers}[1] AS INTEGER) IS NOT NULL AND TRY_CAST({numbers}[2] AS INTEGER) IS NOT NULL AND {code}, false)"


_TYPE_LIST = "['PER','ORG','DAT','LOC','POH','NOH']"
_END = "CASE WHEN k = 4 THEN o0 - 1 ELSE o0 + o1 END"
SQL["q01_quarantine"] = f"""
WITH l AS (SELECT doc_id, unnest(s) AS sentence, unnest(range(0, len(s))) AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
a AS (SELECT doc_id * 1000000000 + line_no AS id, sentence, length(sentence) AS n FROM l WHERE length(sentence) >= 1),
b AS (SELECT id, sentence, {h('hard-k', 'id')} % 11 AS k, {h('hard-s', 'id')} % n AS s0, {h('hard-o', 'id')} % n AS o0,
             {h('hard-s1', 'id')} % 6 AS s1, {h('hard-o1', 'id')} % 6 AS o1, {_TYPE_LIST}[{h('hard-st', 'id')} % 6 + 1] AS st, {_TYPE_LIST}[{h('hard-ot', 'id')} % 6 + 1] AS ot FROM a),
c AS (SELECT id, sentence, k, {_hard_cell('s', 's0 + s1', "CASE WHEN k = 2 THEN 'XYZ' ELSE st END")} AS whole,
             CASE WHEN k <> 1 THEN {_hard_cell('o', _END, 'ot')} END AS oc FROM b),
d AS (SELECT id, sentence, k, oc, CASE WHEN k = 0 THEN substring(whole, 1, 10) ELSE whole END AS sc FROM c),
e AS (SELECT *, {_hard_int('sc', 'start_idx')} AS ss, {_hard_int('sc', 'end_idx')} AS se, {_hard_int('oc', 'start_idx')} AS os, {_hard_int('oc', 'end_idx')} AS oe,
             {_hard_type('sc')} AS subject_type, {_hard_type('oc')} AS object_type FROM d),
r AS (SELECT CASE WHEN ss IS NULL OR se IS NULL THEN 'subject offsets' WHEN os IS NULL OR oe IS NULL THEN 'object offsets'
                  WHEN subject_type IS NULL THEN 'subject type' WHEN object_type IS NULL THEN 'object type'
                  WHEN se < ss OR oe < os OR se >= length(sentence) OR oe >= length(sentence) THEN 'span out of sentence'
                  WHEN NOT {_hard_loose('sc')} OR NOT {_hard_loose('oc')} THEN 'loose cell' WHEN k = 3 THEN 'label' ELSE 'kept' END AS reason FROM e),
n AS (SELECT reason, count(*) AS n FROM r GROUP BY reason UNION ALL SELECT 'read', count(*) FROM r)
SELECT x.reason, coalesce(n.n, 0) AS n_rows, coalesce(n.n, 0) AS n_found
FROM (SELECT unnest(['read', 'kept', 'subject offsets', 'object offsets', 'subject type', 'object type', 'span out of sentence', 'loose cell', 'label']) AS reason) x
LEFT JOIN n ON x.reason = n.reason"""
SQL["s05_csv_sink"] = with_views(["marked"], """
SELECT id, sentence, subject_entity, object_entity, subject_type, object_type, label,
  '[' || array_to_string(subject_idx, ',') || ']' AS subject_idx, '[' || array_to_string(object_idx, ',') || ']' AS object_idx
FROM marked""")

SQL["f11_to_examples"] = fsql("""
SELECT e.id, array_to_string(e.ids, ',') AS input_ids,
  array_to_string(list_transform(e.ids, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END), ',') AS attention_mask,
  array_to_string(list_transform(e.ids, lambda x: 0), ',') AS token_type_ids,
  array_to_string(l.l, ',') AS entity_loc_ids,
  array_to_string(list_transform(range(0, 256), lambda i: CASE WHEN e.ids[i + 1] <> 0 THEN i + 1 ELSE 0 END), ',')
    AS position_ids,
  CAST(t.label_id AS BIGINT) AS labels
FROM encp e JOIN loc l ON e.id = l.id JOIN tk t ON e.id = t.id""", [_LOC])

"""DuckDB text of the augmentation and split operators (used by oracle/sql.py)."""

from __future__ import annotations

from oracle.views import BIG, h, sub

S1, S2 = "chr(57344)", "chr(57345)"
PUNCT = "['.', ',', '!', '?', ';', ':']"

# Marked spans, protection and tokens of a marked table ``m``.
PROTECT = f"""
SELECT *, {sub('sentence', 'a0', 'a1')} AS s_txt, {sub('sentence', 'b0', 'b1')} AS o_txt,
  list_filter(string_split_regex(
    CASE WHEN a0 < b0 THEN {sub('sentence', '0', 'a0')} || {S1} || {sub('sentence', 'a1', 'b0')} || {S2} || {sub('sentence', 'b1', str(BIG))}
         ELSE {sub('sentence', '0', 'b0')} || {S2} || {sub('sentence', 'b1', 'a0')} || {S1} || {sub('sentence', 'a1', str(BIG))} END,
    '\\s+'), lambda x: x <> '') AS tok
FROM (
  SELECT *, instr(sentence, '@*') - 1 AS a0, instr(sentence, '#^') - 1 AS b0,
         instr(sentence, '@*') - 1 + length(subject_type) + length(subject_entity) + 4 AS a1,
         instr(sentence, '#^') - 1 + length(object_type) + length(object_entity) + 4 AS b1
  FROM {{src}}) x
WHERE a0 >= 0 AND b0 >= 0 AND (a1 <= b0 OR b1 <= a0) AND substring(sentence, a1, 1) = '@'
  AND substring(sentence, b1, 1) = '#' AND instr(sentence, {S1}) = 0 AND instr(sentence, {S2}) = 0"""


def restore(text: str) -> str:
    return f"replace(replace({text}, {S1}, s_txt), {S2}, o_txt)"


RATIO = ("CASE WHEN length(sentence) <= 200 THEN CAST(0.2 AS DOUBLE) "
         "WHEN length(sentence) <= 300 THEN CAST(0.3 AS DOUBLE) ELSE CAST(0.35 AS DOUBLE) END")
# The sixteen largest primes below 2^31.
PRIMES = ("[2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497, "
          "2147483489, 2147483477, 2147483423, 2147483399, 2147483353, 2147483323, 2147483269, 2147483249]")


def part(md5: str, k: int) -> str:
    return f"CAST(('0x' || substr({md5}, {1 + 8 * k}, 8)) AS BIGINT)"


def _numbers(md5: str, n: str) -> str:
    return (f"{part(md5, 0)} AS r, CAST({PRIMES}[{part(md5, 1)} % 16 + 1] AS BIGINT) AS a, ({part(md5, 1)} // 16) % nullif({n}, 0) AS b, "
            f"1 + {part(md5, 2)} % 2147483646 AS c, {part(md5, 3)} AS e")


def aeda_ctes(src: str, salt: str, draws: int, name: str) -> list[str]:
    """CTEs ``{name}`` = src rows x draws with the AEDA sentence in ``new_sentence``."""
    p = ("CASE WHEN length(sentence) <= 200 THEN CAST(0.2 AS DOUBLE) "
         "WHEN length(sentence) <= 300 THEN CAST(0.3 AS DOUBLE) ELSE CAST(0.35 AS DOUBLE) END")
    key = ["id", "variant", "draw"]
    return [
        f"{name}_p AS ({PROTECT.replace('{src}', src)})",
        f"""{name}_d AS (
  SELECT *, len(tok) AS n, {p} AS pr FROM {name}_p, (SELECT unnest(range(1, {draws + 1})) AS draw) dd)""",
        f"""{name}_k AS (
  SELECT *, least(n, 1 + {h(salt + ':q', *key)} % CAST(floor(pr * n + 1) AS BIGINT)) AS q,
         list_transform(range(0, n), lambda j: md5(concat_ws(':', '{salt}:pos', CAST(id AS VARCHAR),
             CAST(variant AS VARCHAR), CAST(draw AS VARCHAR), CAST(j AS VARCHAR)))) AS mds
  FROM {name}_d)""",
        f"""{name}_t AS (
  SELECT *, list_sort(list_transform(range(0, n), lambda j: {{'k': CAST(('0x' || substr(mds[j + 1], 1, 8)) AS BIGINT), 'j': j}}))[q] AS thr
  FROM {name}_k)""",
        f"""{name} AS (
  SELECT *, trim(regexp_replace({restore(f'''array_to_string(list_transform(range(0, n), lambda j:
      CASE WHEN CAST(('0x' || substr(mds[j + 1], 1, 8)) AS BIGINT) < thr.k
             OR (CAST(('0x' || substr(mds[j + 1], 1, 8)) AS BIGINT) = thr.k AND j <= thr.j)
           THEN {PUNCT}[CAST(('0x' || substr(mds[j + 1], 9, 8)) AS BIGINT) % 6 + 1] || ' ' || tok[j + 1]
           ELSE tok[j + 1] END), ' ')''')}, '\\s+', ' ', 'g')) AS new_sentence
  FROM {name}_t)""",
    ]


def variant_ctes(src: str, salt: str, check_num: int, name: str) -> list[str]:
    """CTEs ``{name}`` = distinct variants of the src rows by numbered (lowest position, mark) pairs."""
    row = f"md5(concat_ws(':', '{salt}:row', CAST(id AS VARCHAR), CAST(variant AS VARCHAR)))"
    md5 = f"md5(concat_ws(':', '{salt}', CAST(id AS VARCHAR), CAST(variant AS VARCHAR), CAST(k AS VARCHAR)))"
    place = "(a * (j - j1 - 1 + b)) % rest"
    number = f"((c * ({place} + 1) + e) % 2147483647) % 6"
    return [
        f"{name}_p AS ({PROTECT.replace('{src}', src)})",
        f"""{name}_f AS (
  SELECT *, CAST(len(tok) AS BIGINT) AS n, {RATIO} AS pr, {row} AS rmd,
         flatten(list_transform(range(0, len(tok)), lambda j: list_transform(list_filter({PUNCT}, lambda m: m <> tok[j + 1]), lambda m: {{'j': j, 'm': m}}))) AS firsts
  FROM {name}_p)""",
        f"""{name}_k AS (
  SELECT *, firsts[({part('rmd', 1)} + k * CAST({PRIMES}[{part('rmd', 0)} % 16 + 1] AS BIGINT)) % len(firsts) + 1] AS f, {md5} AS md
  FROM (SELECT *, unnest(range(1, least({check_num} - 1, len(firsts)) + 1)) AS k FROM {name}_f) x)""",
        f"{name}_r AS (SELECT *, CAST(f.j AS BIGINT) AS j1, f.m AS m1, n - 1 - CAST(f.j AS BIGINT) AS rest FROM {name}_k)",
        f"{name}_n AS (SELECT *, {_numbers('md', 'rest')} FROM {name}_r)",
        f"{name}_q AS (SELECT *, least(r % least(n, CAST(floor(pr * n + 1) AS BIGINT)), rest) AS q FROM {name}_n)",
        f"""{name} AS (
  SELECT *, variant * {check_num} + k AS new_variant, trim(regexp_replace({restore(f'''array_to_string(list_transform(range(0, n), lambda j:
      CASE WHEN j = j1 THEN m1 || ' ' || tok[j + 1]
           WHEN j > j1 AND rest > 0 AND {place} < q
           THEN (CASE WHEN {PUNCT}[{number} + 1] = tok[j + 1] THEN {PUNCT}[({number} + 1) % 6 + 1] ELSE {PUNCT}[{number} + 1] END) || ' ' || tok[j + 1]
           ELSE tok[j + 1] END), ' ')''')}, '\\s+', ' ', 'g')) AS new_sentence
  FROM {name}_q)""",
    ]


def delete_ctes(src: str, salt: str, p: float, name: str) -> list[str]:
    key = ["id", "variant"]
    return [
        f"{name}_p AS ({PROTECT.replace('{src}', src)})",
        f"""{name}_a AS (
  SELECT *, len(tok) AS n,
         list_filter(range(0, len(tok)), lambda j: instr(tok[j + 1], {S1}) = 0 AND instr(tok[j + 1], {S2}) = 0) AS allowed
  FROM {name}_p)""",
        f"""{name}_v AS (
  SELECT *, CASE WHEN len(allowed) > 0 THEN allowed[{h(salt + ':d', *key)} % len(allowed) + 1] END AS victim,
         ({h(salt + ':p', *key)} % 10000) < {int(round(p * 10000))} AS hit
  FROM {name}_a)""",
        f"""{name}_x AS (
  SELECT id, variant, CASE WHEN hit AND len(allowed) > 0 THEN {restore('''array_to_string(list_transform(
      list_filter(range(0, n), lambda j: j <> victim), lambda j: tok[j + 1]), ' ')''')} END AS new_sentence
  FROM {name}_v)""",
        f"""{name} AS (
  SELECT s.*, coalesce(x.new_sentence, s.sentence) AS new_sentence
  FROM {src} s LEFT JOIN {name}_x x ON s.id = x.id AND s.variant = x.variant)""",
    ]

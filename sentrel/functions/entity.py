"""Column expressions for entity cells and spans.

Spans are 0-based with an inclusive end, over code points of the unmarked
sentence. Spark's ``substring`` is 1-based; the conversion lives only here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentrel.schema import ENTITY_STRUCT, type_name_map


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _grab(cell: Column, pattern: str) -> Column:
    v = F.regexp_extract(cell, pattern, 1)
    return F.when(v != "", v)


def entity_start(cell) -> Column:
    """P01 integer after the *last* ``start_idx':`` of the cell (NULL if none)."""
    return _grab(_c(cell), r"(?s).*start_idx':\s*(\d+)").try_cast("int")


def entity_end(cell) -> Column:
    """P01 integer after the *last* ``end_idx':`` of the cell (NULL if none)."""
    return _grab(_c(cell), r"(?s).*end_idx':\s*(\d+)").try_cast("int")


def entity_type(cell) -> Column:
    """P01 the last quoted upper-case type code after ``'type':``."""
    return _grab(_c(cell), r"(?s).*'type':\s*'([A-Z]+)'")


def parse_entity_loose(cell) -> Column:
    """P02 loose parse: the numbers between the first and second ``start_idx``
    (exactly two expected, else NULL) and the first run of ``[A-z]`` after the
    first ``'type': ``."""
    cell = _c(cell)
    seg = F.try_element_at(F.split(cell, "start_idx"), F.lit(2))
    nums = F.regexp_extract_all(seg, F.lit(r"[0-9]+"), 0)
    tseg = F.try_element_at(F.split(cell, "'type': "), F.lit(2))
    typ = F.regexp_extract(tseg, r"[A-Za-z\[\]\\^_`]+", 0)
    ok = F.size(nums) == 2
    return F.struct(
        F.when(typ != "", typ).alias("type"),
        F.when(ok, F.element_at(nums, 1).try_cast("int")).alias("start_idx"),
        F.when(ok, F.element_at(nums, 2).try_cast("int")).alias("end_idx"),
    )


def decode_entity(cell) -> Column:
    """P03 decode of the dict-literal cell (single quotes) without evaluating it."""
    return F.from_json(_c(cell), ENTITY_STRUCT, {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"})


def encode_entity(ent) -> Column:
    """P03 encode: back to the literal text form. Backslashes and line breaks are
    escaped; a word with an apostrophe goes into double quotes, one with both kinds
    of quotes into single quotes with its apostrophes escaped, so :func:`decode_entity`
    reads back what was written."""
    ent = _c(ent)

    def quoted(word: Column) -> Column:
        w = F.replace(word, F.lit("\\"), F.lit("\\\\"))
        for raw, short in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            w = F.replace(w, F.lit(raw), F.lit(short))
        single, double = F.instr(word, "'") > 0, F.instr(word, '"') > 0
        return (F.when(single & ~double, F.concat(F.lit('"'), w, F.lit('"')))
                .otherwise(F.concat(F.lit("'"), F.replace(w, F.lit("'"), F.lit("\\'")), F.lit("'"))))

    return F.format_string("{'word': %s, 'start_idx': %d, 'end_idx': %d, 'type': %s}",
                           quoted(ent["word"]), ent["start_idx"], ent["end_idx"], quoted(ent["type"]))


def map_type(code) -> Column:
    """P04 entity type code -> marker name; NULL for an unknown code."""
    return F.try_element_at(type_name_map(), _c(code))


def span_text(sentence, start, end) -> Column:
    """P05 text of an inclusive span."""
    start, end = _c(start), _c(end)
    return F.substring(_c(sentence), start + 1, F.greatest(end - start + 1, F.lit(0)))


def _sub(s: Column, a: Column, b: Column) -> Column:
    """Python-style ``s[a:b]`` for 0-based a <= b (empty when b <= a)."""
    return F.substring(s, a + 1, F.greatest(b - a, F.lit(0)))


def insert_markers(sentence, ss, se, os_, oe, s_open, s_close, o_open, o_close) -> Column:
    """Wrap the two spans (original offsets) in open/close markers, ordered by
    the true start (subject first when ``ss <= os``)."""
    s = _c(sentence)
    ss, se, os_, oe = _c(ss), _c(se), _c(os_), _c(oe)
    big = F.lit(1 << 30)
    subj_first = F.concat(_sub(s, F.lit(0), ss), s_open, _sub(s, ss, se + 1), s_close,
                          _sub(s, se + 1, os_), o_open, _sub(s, os_, oe + 1), o_close,
                          _sub(s, oe + 1, big))
    obj_first = F.concat(_sub(s, F.lit(0), os_), o_open, _sub(s, os_, oe + 1), o_close,
                         _sub(s, oe + 1, ss), s_open, _sub(s, ss, se + 1), s_close,
                         _sub(s, se + 1, big))
    return F.when(ss <= os_, subj_first).otherwise(obj_first)


def mark_typed_punct(sentence, ss, se, os_, oe, s_type, o_type) -> Column:
    """P06 ``@*T*subject@`` and ``#^T^object#``."""
    return insert_markers(sentence, ss, se, os_, oe,
                          F.concat(F.lit("@*"), _c(s_type), F.lit("*")), F.lit("@"),
                          F.concat(F.lit("#^"), _c(o_type), F.lit("^")), F.lit("#"))


def special_tokens(s_type, o_type) -> list[Column]:
    """P07 marker tokens: [SUBJ-T], [/SUBJ-T], [OBJ-T], [/OBJ-T]."""
    return [F.format_string("[SUBJ-%s]", _c(s_type)), F.format_string("[/SUBJ-%s]", _c(s_type)),
            F.format_string("[OBJ-%s]", _c(o_type)), F.format_string("[/OBJ-%s]", _c(o_type))]


def mark_special(sentence, ss, se, os_, oe, s_type, o_type) -> Column:
    """P07 ``[SUBJ-T]subject[/SUBJ-T]`` and ``[OBJ-T]object[/OBJ-T]``."""
    a, b, c, d = special_tokens(s_type, o_type)
    return insert_markers(sentence, ss, se, os_, oe, a, b, c, d)

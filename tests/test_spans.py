from pyspark.sql import functions as F

from sentrel.operators import spans as P
from sentrel.schema import RAW_SCHEMA


def cell(word, s, e, t):
    return f"{{'word': '{word}', 'start_idx': {s}, 'end_idx': {e}, 'type': '{t}'}}"


ROWS = [
    # subject before object
    (1, "Kim met Lee in Seoul", cell("Kim", 0, 2, "PER"), cell("Seoul", 15, 19, "LOC"), "per:origin", "s"),
    # object before subject
    (2, "Kim met Lee in Seoul", cell("Lee", 8, 10, "PER"), cell("Kim", 0, 2, "PER"), "per:colleagues", "s"),
    # adjacent entities
    (3, "AB", cell("A", 0, 0, "ORG"), cell("B", 1, 1, "NOH"), "org:members", "s"),
    # Hangul, object directly after subject start + 1
    (4, "삼성전자 이재용 회장", cell("삼성전자", 0, 3, "ORG"), cell("이재용", 5, 7, "PER"), "org:top_members/employees", "s"),
    # unknown type -> quarantine
    (5, "x y", cell("x", 0, 0, "XXX"), cell("y", 2, 2, "PER"), "no_relation", "s"),
    # no offsets -> quarantine
    (6, "x y", "{'word': 'x'}", cell("y", 2, 2, "PER"), "no_relation", "s"),
    # NULL cell -> quarantine
    (7, "x y", None, cell("y", 2, 2, "PER"), "no_relation", "s"),
]


def raw(spark):
    return spark.createDataFrame(ROWS, RAW_SCHEMA)


def test_marking_golden(spark):
    m = {r.id: r for r in P.to_marked(raw(spark)).collect()}
    assert set(m) == {1, 2, 3, 4}
    assert m[1].sentence == "@*사람*Kim@ met Lee in #^장소^Seoul#"
    assert m[2].sentence == "#^사람^Kim# met @*사람*Lee@ in Seoul"
    assert m[3].sentence == "@*조직*A@#^숫자^B#"
    assert m[4].sentence == "@*조직*삼성전자@ #^사람^이재용# 회장"
    assert m[1].subject_idx == [0, 2] and m[2].object_idx == [0, 2]
    assert (m[4].subject_entity, m[4].object_entity) == ("삼성전자", "이재용")


def test_quarantine_reasons(spark):
    q = {r.id: r.error for r in P.quarantine(P.parse_entities(raw(spark))).collect()}
    assert q == {5: "subject type", 6: "subject offsets", 7: "subject offsets"}


def test_markers_removed_restore_sentence(spark):
    m = P.to_marked(raw(spark), keep=())
    back = m.select(F.regexp_replace("sentence", r"@\*[^*]+\*|#\^[^^]+\^|@|#", "").alias("s")).collect()
    orig = {r[1] for r in ROWS[:4]}
    assert {r.s for r in back} == orig


def test_loose_parse_and_special_markers(spark):
    lo = P.parse_loose(raw(spark)).where("id = 1")
    r = P.mark_special(lo, None).collect()[0]
    assert (r.ss, r.se, r.os, r.oe, r.subject_code) == (0, 2, 15, 19, "PER")
    assert r.marked == "[SUBJ-PER]Kim[/SUBJ-PER] met Lee in [OBJ-LOC]Seoul[/OBJ-LOC]"
    vocab = {x.token for x in P.marker_vocab(lo).collect()}
    assert vocab == {"[SUBJ-PER]", "[/SUBJ-PER]", "[OBJ-LOC]", "[/OBJ-LOC]"}


def test_label_maps(spark):
    d = P.label_to_num(raw(spark))
    assert {r.id: r.label_id for r in d.collect()}[2] == 14
    assert P.unknown_labels(spark.createDataFrame([("nope",)], "label string")).count() == 1
    back = P.num_to_label(spark.createDataFrame([(0,), (29,)], "n int"), "n", "name").collect()
    assert {r.n: r.name for r in back} == {0: "no_relation", 29: "per:religion"}

"""

Each takes ``(spark, sf_dir)``, reads the driver tables (through the views of
:mod:`sentrel.sources.fixtures`) and returns a DataFrame in output normal form
(:func:`finish`). Column names match the SQL oracles in ``oracle/sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrel.functions import entity as E
from sentrel.functions.text import clean_text, strip_foreign
from sentrel.operators import spans as P
from sentrel.plans.common import finish, join_ints
from sentrel.schema import label_dim
from sentrel.sources import fixtures as fx
from sentrel.sources.files import stamp

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _parsed(spark, sf_dir):
    return P.parse_entities(fx.re_raw(spark, sf_dir))


def _marked(spark, sf_dir):
    return P.to_marked(fx.re_raw(spark, sf_dir), keep=("label_id", "source"))


# --- S: sources, sinks -----------------------------------------------------

@register("s04_label_dim")
def s04(spark, sf_dir):
    counts = fx.re_raw(spark, sf_dir).groupBy("label_id").agg(F.count(F.lit(1)).alias("n_rows"))
    dim = F.broadcast(label_dim(spark))
    return finish(dim.join(counts, "label_id", "left")
                  .select("label_id", "label", F.coalesce("n_rows", F.lit(0)).alias("n_rows")))


@register("s06_kst_stamp")
def s06(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return finish(ev.select("event_id", stamp("ts").alias("stamp")))


# --- P: parsing, mapping, marking -------------------------------------------

@register("p01_parse_entity")
def p01(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return finish(p.select("id", "ss", "se", "s_code", "os", "oe", "o_code"))


@register("p02_parse_entity_loose")
def p02(spark, sf_dir):
    p = P.parse_loose(fx.re_raw(spark, sf_dir))
    return finish(p.select("id", "subject_code", "object_code", "ss", "se", "os", "oe"))


@register("p03_decode_entity")
def p03(spark, sf_dir):
    r = fx.re_raw(spark, sf_dir)
    d = r.select("id", "subject_entity", "object_entity",
                 E.decode_entity("subject_entity").alias("s"), E.decode_entity("object_entity").alias("o"))
    return finish(d.select(
        "id", F.col("s.word").alias("s_word"), F.col("s.start_idx").alias("s_start"),
        F.col("s.end_idx").alias("s_end"), F.col("s.type").alias("s_type"),
        F.col("o.word").alias("o_word"), F.col("o.start_idx").alias("o_start"),
        F.col("o.end_idx").alias("o_end"), F.col("o.type").alias("o_type"),
        ((E.encode_entity("s") == F.col("subject_entity"))
         & (E.encode_entity("o") == F.col("object_entity"))).alias("roundtrip")))


@register("p04_map_type")
def p04(spark, sf_dir):
    return finish(_parsed(spark, sf_dir).select("id", "subject_type", "object_type"))


@register("p05_span_text")
def p05(spark, sf_dir):
    return finish(_parsed(spark, sf_dir).select("id", "subject_word", "object_word"))


@register("p06_mark_typed_punct")
def p06(spark, sf_dir):
    p = P.mark_typed_punct(P.valid_entities(_parsed(spark, sf_dir)))
    return finish(p.select("id", F.col("marked").alias("sentence")))


@register("p07_mark_special")
def p07(spark, sf_dir):
    lo = P.parse_loose(fx.re_raw(spark, sf_dir))
    out = P.mark_special(lo, None, "marked")
    out = P.mark_special(out, "pre", "marked_pre")
    out = P.mark_special(out, "chinese", "marked_chinese")
    return finish(out.select("id", "marked", "marked_pre", "marked_chinese"))


@register("p08_marker_vocab")
def p08(spark, sf_dir):
    return finish(P.marker_vocab(P.parse_loose(fx.re_raw(spark, sf_dir))))


@register("p09_clean_text")
def p09(spark, sf_dir):
    c = fx.table(spark, sf_dir, "conversations")
    return finish(c.select("conv_id", "turn", clean_text("text", "pre").alias("pre"),
                           clean_text("text", "chinese").alias("chinese"),
                           clean_text("text", None).alias("plain")))


@register("p10_strip_foreign")
def p10(spark, sf_dir):
    c = fx.table(spark, sf_dir, "conversations")
    return finish(c.select("conv_id", "turn", strip_foreign("text").alias("text_clean")))


@register("p11_question")
def p11(spark, sf_dir):
    p = P.question(P.valid_entities(_parsed(spark, sf_dir)))
    return finish(p.select("id", "question"))


@register("p12_label_to_num")
def p12(spark, sf_dir):
    r = fx.re_raw(spark, sf_dir).drop("label_id")
    return finish(P.label_to_num(r).select("id", "label", "label_id"))


@register("p13_num_to_label")
def p13(spark, sf_dir):
    s = fx.re_scored(spark, sf_dir)
    s = s.withColumn("pred", F.array_position("z", F.array_max("z")) - 1)
    return finish(P.num_to_label(s, "pred", "pred_label").select("id", "pred", "pred_label"))


@register("p14_marker_spans")
def p14(spark, sf_dir):
    m = P.marker_spans(_marked(spark, sf_dir))
    return finish(m.select("id", F.col("subject_idx")[0].alias("s_start"),
                           F.col("subject_idx")[1].alias("s_end"),
                           F.col("object_idx")[0].alias("o_start"),
                           F.col("object_idx")[1].alias("o_end")))


@register("p15_to_marked")
def p15(spark, sf_dir):
    m = _marked(spark, sf_dir)
    return finish(m.select("id", "sentence", "subject_entity", "object_entity", "subject_type",
                           "object_type", "label", join_ints("subject_idx").alias("subject_idx"),
                           join_ints("object_idx").alias("object_idx")))


# --- A: augmentation -----------------------------------------------------------

from sentrel.functions.text import squeeze_ws  # noqa: E402
from sentrel.operators import augment as A  # noqa: E402
from sentrel.operators import split as D  # noqa: E402


def _reanchored(spark, sf_dir):
    raw = fx.re_raw(spark, sf_dir)
    return A.reanchor(raw, fx.variants(spark, sf_dir, raw))


def _augmented_raw(spark, sf_dir):
    """Originals (variant 0) + re-anchored rewrites (variant 1), same ids."""
    raw = fx.re_raw(spark, sf_dir)
    return A.append_variants(raw, A.reanchor(raw, fx.variants(spark, sf_dir, raw)))


def _split_input(spark, sf_dir):
    """The holdout reads its input in several branches (candidates, quotas,
    final join): write the keyed rows once, without texts."""
    from sentrel.plans.common import materialize
    return materialize(D.shuffle_key(_augmented_raw(spark, sf_dir).select("id", "variant", "label_id")))


@register("a01_reanchor")
def a01(spark, sf_dir):
    r = _reanchored(spark, sf_dir)
    return finish(r.select("id", "sentence", "subject_entity", "object_entity", "label"))


@register("a02_append_variants")
def a02(spark, sf_dir):
    r = _augmented_raw(spark, sf_dir)
    return finish(r.select("id", "variant", "sentence", "subject_entity", "object_entity", "label"))


@register("a03_aeda")
def a03(spark, sf_dir):
    a = A.aeda(_marked(spark, sf_dir), salt="aeda", draws=1)
    return finish(a.select("id", "variant", "draw", "sentence"))


@register("a04_punc_ratio")
def a04(spark, sf_dir):
    m = _marked(spark, sf_dir)
    return finish(m.select("id", A.punc_ratio("sentence").alias("ratio")))


@register("a05_n_variants")
def a05(spark, sf_dir):
    v = A.n_variants(_marked(spark, sf_dir), check_num=4, salt="aeda")
    return finish(v.select("id", "variant", "sentence"))


@register("a06_entity_intact")
def a06(spark, sf_dir):
    m = _marked(spark, sf_dir).withColumn("variant", F.lit(0))
    a = A.entity_intact(A.aeda(m, salt="aeda6", draws=3, keep_original=True))
    return finish(a.select("id", "variant", "draw", "sentence"))


@register("a07_squeeze_ws")
def a07(spark, sf_dir):
    c = fx.table(spark, sf_dir, "conversations")
    return finish(c.select("conv_id", "turn", squeeze_ws("text").alias("text_squeezed")))


@register("a08_random_delete")
def a08(spark, sf_dir):
    r = A.random_delete(_marked(spark, sf_dir), p=0.3, salt="rd")
    return finish(r.select("id", "variant", "sentence"))


@register("a09_rd")
def a09(spark, sf_dir):
    r = A.rd(_marked(spark, sf_dir))
    return finish(r.select("id", "sentence", join_ints("subject_idx").alias("subject_idx"),
                           join_ints("object_idx").alias("object_idx")))


@register("a10_carry_label")
def a10(spark, sf_dir):
    m = _marked(spark, sf_dir)
    aug = A.nest(m, 8).unionByName(A.n_variants(m, check_num=8, salt="aeda"))
    return finish(aug.select("id", "variant", "label", "label_id"))


# --- D: shuffle, quota, holdout ----------------------------------------------------

@register("d01_shuffle_key")
def d01(spark, sf_dir):
    return finish(D.shuffle_key(_augmented_raw(spark, sf_dir)).select("id", "variant", "key"))


@register("d02_quota")
def d02(spark, sf_dir):
    return finish(D.quota(_augmented_raw(spark, sf_dir), 10, "label_id"))


@register("d03_holdout")
def d03(spark, sf_dir):
    s = D.holdout(_split_input(spark, sf_dir), rate=10, seed=42)
    return finish(s.select("id", "variant", "label_id", "part"))


@register("d04_split_counts")
def d04(spark, sf_dir):
    return finish(D.split_counts(D.holdout(_split_input(spark, sf_dir), rate=10, seed=42)))


@register("d05_holdout_group_safe")
def d05(spark, sf_dir):
    s = D.holdout(_split_input(spark, sf_dir), rate=10, seed=42, group_safe=True)
    return finish(s.select("id", "variant", "label_id", "part"))


# --- M: metrics ------------------------------------------------------------------

from sentrel.functions.arrays import argmax, decode_probs, softmax  # noqa: E402
from sentrel.operators import analysis as EA  # noqa: E402
from sentrel.operators import metrics as M  # noqa: E402
from sentrel.operators import scoring as I  # noqa: E402
from sentrel.plans.common import join_doubles, materialize  # noqa: E402
from sentrel.operators.scan import beside_groups  # noqa: E402
from sentrel.session import discard, scratch_path, stored  # noqa: E402


@register("m01_micro_f1")
def m01(spark, sf_dir):
    return finish(M.micro_f1(fx.re_scored(spark, sf_dir)))


@register("m02_auprc")
def m02(spark, sf_dir):
    return finish(M.auprc(fx.re_scored(spark, sf_dir)))


@register("m03_accuracy")
def m03(spark, sf_dir):
    return finish(M.accuracy(fx.re_scored(spark, sf_dir)))


@register("m04_compute_metrics")
def m04(spark, sf_dir):
    return finish(M.compute_metrics(fx.re_scored(spark, sf_dir)))


@register("m05_cross_entropy")
def m05(spark, sf_dir):
    return finish(M.cross_entropy(fx.re_scored(spark, sf_dir)))


@register("m06_focal")
def m06(spark, sf_dir):
    return finish(M.focal(fx.re_scored(spark, sf_dir), gamma=2.0))


@register("m07_label_smooth")
def m07(spark, sf_dir):
    return finish(M.label_smooth(fx.re_scored(spark, sf_dir), smoothing=0.1))


@register("m08_soft_f1")
def m08(spark, sf_dir):
    return finish(M.soft_f1(fx.re_scored(spark, sf_dir)))


@register("m09_plateau")
def m09(spark, sf_dir):
    p = M.plateau(fx.eval_history(spark, sf_dir), mode="min", patience=5)
    return finish(p.select("run", "step", "best", "patience_cnt", "stop"))


@register("m10_best_step")
def m10(spark, sf_dir):
    return finish(M.best_step(fx.eval_history(spark, sf_dir), mode="max", patience=5))


# --- I: scoring ----------------------------------------------------------------------

def _quality_split(spark, sf_dir):
    """Documents with a quality label, split by D05 (no id in both parts), written once."""
    labels = fx.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label_id"))
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")
    rows = docs.select(F.col("doc_id").alias("id"), F.lit(0).alias("variant"), "label_id", F.coalesce("text", F.lit("")).alias("sentence"))
    return materialize(D.holdout(materialize(D.shuffle_key(rows.where("label_id is not null"))), group_safe=True))


@register("i01_fit")
def i01(spark, sf_dir):
    """Fitted on the training part, saved, loaded, and applied to both parts."""
    split = _quality_split(spark, sf_dir)
    path = I.save_model(I.fit_text(split.where("part = 'train'")), scratch_path(spark, "text-model"))
    return finish(I.score(split, I.load_model(path)).select("id", "part", "label_id", "prediction"))


@register("i01_rounds")
def i01_rounds(spark, sf_dir):
    """Warm-started rounds on the vectors: the evaluation history, its best round marked."""
    rows = fx.re_scored(spark, sf_dir).withColumn("variant", F.lit(0))
    split = materialize(D.holdout(materialize(D.shuffle_key(rows)), group_safe=True))
    history, _ = I.fit_rounds(split.where("part = 'train'"), split.where("part = 'valid'"), fx.CLASSES, scratch_path(spark, "rounds"), rounds=6, patience=3)
    return finish(history)


@register("i02_score")
def i02(spark, sf_dir):
    """A saved model, loaded and applied. Its weights are given by a rule, so that any engine can recompute the scores."""
    s = fx.re_scored(spark, sf_dir)
    coef = [[((7 * c + 3 * j) % 11 - 5) / 8 for j in range(fx.CLASSES)] for c in range(fx.CLASSES)]
    weights = I.linear_weights(coef, [c / 64 for c in range(fx.CLASSES)])
    path = I.save_model(I.linear_classifier(s, fx.CLASSES, iterations=0, weights=weights), scratch_path(spark, "rule-model"))
    out = I.score(s, I.load_model(path), "z")
    return finish(out.select("id", "prediction", join_doubles("logits").alias("logits")))


@register("i03_softmax")
def i03(spark, sf_dir):
    s = fx.re_scored(spark, sf_dir)
    return finish(s.select("id", join_doubles(softmax("z")).alias("p")))


@register("i04_argmax")
def i04(spark, sf_dir):
    return finish(fx.re_scored(spark, sf_dir).select("id", argmax("z").alias("pred")))


@register("i05_submission")
def i05(spark, sf_dir):
    return finish(I.submission(fx.re_scored(spark, sf_dir)))


@register("i06_scored_dev")
def i06(spark, sf_dir):
    return finish(I.scored_dev(fx.re_scored(spark, sf_dir)).select("id", "label_id", "output_prob"))


# --- E: analysis catalog --------------------------------------------------------------

_FEAT = ["dataset", "id", "num_label", "num_pred", "pred", "pred_confidence", "label_confidence",
         "answer", "sentence_space", "sentence_len", "sentence_token_num"]


def _catalog(spark, sf_dir):
    """Prediction catalog as written by the scorer, annotated (E03) and
    materialised once: the analyses read it from several branches. Text features
    are computed once per document, and texts go no further."""
    c = fx.pred_catalog(spark, sf_dir, lambda d: EA.text_features(d, "sentence").drop("sentence"))
    return materialize(EA.annotate(EA.with_output_prob(c), "label_id", "output_prob", []).select(*_FEAT))


@register("e01_catalog_select")
def e01(spark, sf_dir):
    cat = EA.Catalog(fx.pred_catalog(spark, sf_dir)).enable(["m0", "m2"])
    return finish(cat.view().select("dataset", "id", "label_id"))


@register("e02_catalog_list")
def e02(spark, sf_dir):
    return finish(EA.Catalog(fx.pred_catalog(spark, sf_dir)).datasets())


@register("e03_column_roles")
def e03(spark, sf_dir):
    return finish(_catalog(spark, sf_dir).select(*_FEAT))


@register("e04_describe")
def e04(spark, sf_dir):
    return finish(EA.describe(_catalog(spark, sf_dir), ["label_confidence", "pred_confidence", "sentence_len"]))


@register("e05_decode_probs")
def e05(spark, sf_dir):
    c = EA.with_output_prob(fx.pred_catalog(spark, sf_dir))
    return finish(c.select("dataset", "id", join_doubles(decode_probs("output_prob")).alias("probs")))


@register("e06_prediction_features")
def e06(spark, sf_dir):
    c = EA.with_output_prob(fx.pred_catalog(spark, sf_dir)).withColumn("_p", decode_probs("output_prob"))
    f = EA.prediction_features(c, "_p", "label_id")
    return finish(f.select("dataset", "id", "num_label", "num_pred", "pred", "pred_confidence",
                           "label_confidence", "answer"))


@register("e07_text_features")
def e07(spark, sf_dir):
    t = EA.text_features(fx.pred_catalog(spark, sf_dir), "sentence")
    return finish(t.select("dataset", "id", "sentence_space", "sentence_len", "sentence_token_num"))


@register("e08_iqr_thresholds")
def e08(spark, sf_dir):
    th = EA.iqr_thresholds(_catalog(spark, sf_dir), "sentence_len")
    return finish(th.select("dataset", *[F.col("th")[i].alias(f"t{i}") for i in range(4)]))


@register("e09_percentile_thresholds")
def e09(spark, sf_dir):
    th = EA.thresholds(_catalog(spark, sf_dir), "label_confidence", [0.1, 0.5, 0.9], percentile=True)
    return finish(th.select("dataset", *[F.col("th")[i].alias(f"t{i}") for i in range(3)]))


def _bucketed(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    return EA.bucketize(c, "sentence_len", materialize(EA.iqr_thresholds(c, "sentence_len")))


@register("e10_bucketize")
def e10(spark, sf_dir):
    return finish(_bucketed(spark, sf_dir).select("dataset", "id", "bucket"))


@register("e11_bucket_labels")
def e11(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    return finish(EA.bucket_labels(EA.iqr_thresholds(c, "sentence_len")))


@register("e12_bucket_stats")
def e12(spark, sf_dir):
    return finish(EA.bucket_stats(_bucketed(spark, sf_dir), ["label_confidence", "answer"]))


@register("e13_bucket_pearson")
def e13(spark, sf_dir):
    return finish(EA.bucket_stats(_bucketed(spark, sf_dir), [("pred_confidence", "label_confidence")]))


@register("e14_group_stats")
def e14(spark, sf_dir):
    return finish(EA.group_stats(_catalog(spark, sf_dir), "num_label", "label_confidence"))


@register("e15_conditional_dist")
def e15(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    return finish(EA.conditional_dist(c, "sentence_len", "label_confidence", materialize(EA.iqr_thresholds(c, "sentence_len"))))


@register("e16_group_dist")
def e16(spark, sf_dir):
    return finish(EA.group_dist(_catalog(spark, sf_dir), "label_confidence"))


@register("e17_condition_group_dist")
def e17(spark, sf_dir):
    return finish(EA.condition_group_dist(_catalog(spark, sf_dir), "pred_confidence", "sentence_len",
                                          [0.3, 0.6, 0.9]))


@register("e18_histogram")
def e18(spark, sf_dir):
    return finish(EA.histogram(_catalog(spark, sf_dir), "label_confidence", 10))


@register("e19_scatter_points")
def e19(spark, sf_dir):
    s = EA.scatter_points(_catalog(spark, sf_dir), "sentence_len", "label_confidence", "num_label",
                          "pred_confidence")
    return finish(s)


@register("e20_bar_points")
def e20(spark, sf_dir):
    return finish(EA.bar_points(_catalog(spark, sf_dir), "pred", "label_confidence", "answer"))


@register("e21_filter_contains")
def e21(spark, sf_dir):
    f = EA.filter_contains(fx.pred_catalog(spark, sf_dir), "sentence", "qu[aeiou]")
    return finish(f.select("dataset", "id"))


@register("e22_filter_by_reference")
def e22(spark, sf_dir):
    f = EA.filter_contains(_catalog(spark, sf_dir), "pred", "^per:", ref="m1")
    return finish(f.select("dataset", "id", "pred"))


# --- F: features --------------------------------------------------------------------

from sentrel.operators import features as FT  # noqa: E402


def _vocab(spark, sf_dir, marked=None):
    m = marked if marked is not None else _marked(spark, sf_dir)
    extra = P.marker_vocab(P.parse_loose(fx.re_raw(spark, sf_dir)))
    return materialize(FT.build_vocab(FT.tokens(m), extra=extra))


def _marked_once(spark, sf_dir, *columns):
    """Columns of the marked table written once, in blocks, for plans that read it in several branches
    (vocabulary and encoding)."""
    return FT.in_blocks(_marked(spark, sf_dir).select(*columns))


def _encoded(spark, sf_dir):
    m = _marked_once(spark, sf_dir, "id", "sentence")
    return FT.encode(m, _vocab(spark, sf_dir, m))


@register("f01_build_vocab")
def f01(spark, sf_dir):
    return finish(_vocab(spark, sf_dir))


@register("f02_encode")
def f02(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    return finish(e.select("id", join_ints("input_ids").alias("input_ids")))


@register("f03_encode_pair")
def f03(spark, sf_dir):
    m = _marked_once(spark, sf_dir, "id", "sentence", "subject_entity", "object_entity", "subject_type", "object_type")
    q = P.question(m.withColumnRenamed("subject_entity", "subject_word")
                   .withColumnRenamed("object_entity", "object_word"))
    e = FT.encode_pair(q, _vocab(spark, sf_dir, m), second="question")
    return finish(e.select("id", join_ints("input_ids").alias("input_ids"),
                           join_ints("token_type_ids").alias("token_type_ids")))


@register("f04_masks")
def f04(spark, sf_dir):
    e = FT.masks(_encoded(spark, sf_dir))
    return finish(e.select("id", join_ints("attention_mask").alias("attention_mask"),
                           join_ints("token_type_ids").alias("token_type_ids")))


@register("f05_entity_loc_ids")
def f05(spark, sf_dir):
    e = FT.entity_loc_ids(_marked(spark, sf_dir))
    return finish(e.select("id", join_ints("entity_loc_ids").alias("entity_loc_ids")))


@register("f06_entity_loc_ids_pair")
def f06(spark, sf_dir):
    m = _marked(spark, sf_dir)
    q = P.question(m.withColumnRenamed("subject_entity", "subject_word")
                   .withColumnRenamed("object_entity", "object_word"))
    e = FT.entity_loc_ids_pair(q, second="question")
    return finish(e.select("id", join_ints("entity_loc_ids").alias("entity_loc_ids")))


@register("f07_entity_type_ids")
def f07(spark, sf_dir):
    e = FT.entity_type_ids(FT.entity_loc_ids(_marked(spark, sf_dir)))
    return finish(e.select("id", join_ints("entity_type_ids").alias("entity_type_ids")))


@register("f08_position_ids")
def f08(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    return finish(e.select("id", join_ints(FT.position_ids("input_ids")).alias("position_ids")))


@register("f09_span_mean")
def f09(spark, sf_dir):
    s = FT.span_mean(fx.span_vectors(spark, sf_dir))
    return finish(s.select("id", "loc", join_doubles("mean").alias("mean")))


@register("f10_concat_features")
def f10(spark, sf_dir):
    c = FT.concat_features(fx.span_vectors(spark, sf_dir))
    return finish(c.select("id", join_doubles("features").alias("features")))


@register("f11_to_examples")
def f11(spark, sf_dir):
    m = _marked_once(spark, sf_dir, "id", "sentence", "label_id")
    e = FT.masks(FT.encode(FT.entity_loc_ids(m), _vocab(spark, sf_dir, m), carry=("entity_loc_ids", "label_id")))
    ex = FT.to_examples(e.withColumn("position_ids", FT.position_ids("input_ids")))
    x = F.col("example")
    return finish(ex.select("id", *[join_ints(x[c]).alias(c) for c in
                                    ["input_ids", "attention_mask", "token_type_ids", "entity_loc_ids",
                                     "position_ids"]], x["labels"].alias("labels")))


#: Rows of a round of :func:`c01`, and rounds at most.
ROUND_ROWS, MOST_ROUNDS = 250_000, 4


@register("c01_chain")
def c01(spark, sf_dir):
    """The whole chain: rewrite and append (A01, A02), id-safe holdout (D05), mark (P15), punctuation variants
    of the training rows (A05), encode (F02, F04), records (F11); one output row per (id, variant). The holdout sees
    the keys only; marked texts meet their part in rounds, of which each frees its exchange, and lie compressed in blocks of whole ids, which
    encoding reads where they are. Each table of texts replaces the one before it, which is deleted."""
    own, block = ["id", "variant", "label_id"], FT.KEY_BLOCK
    raw_path, marked_path = scratch_path(spark, "raw"), scratch_path(spark, "marked")
    raw = stored(_augmented_raw(spark, sf_dir), raw_path)
    extra = materialize(P.marker_vocab(P.parse_loose(raw.where("variant = 0"))))  # the rows of the RAW table
    parts = stored(D.holdout(D.shuffle_key(raw.select(*own)), group_safe=True).select(*own, "part").distinct())
    blocks = FT.key_blocks(raw, times=2)  # with their variants
    rounds = min(MOST_ROUNDS, 1 + raw.count() // ROUND_ROWS)
    for i in range(rounds):
        texts, keys = (FT.in_key_blocks(d, blocks).where(F.col(block) % rounds == i) for d in (raw, parts))
        marked = P.to_marked(texts, keep=("variant", "label_id", block))
        marked = marked.select(block, *own, "sentence", "subject_entity", "object_entity", "subject_type", "object_type")
        m = stored(beside_groups(marked, keys, own, block), marked_path)
    discard(spark, raw_path)
    train = m.where(F.col("part") == "train")
    vocab = stored(FT.build_vocab(FT.tokens(train), extra=extra))
    rows = A.nest(m, 2).unionByName(A.n_variants(train, check_num=2, salt="aeda")).select(block, "id", "variant", "part", "label_id", "sentence")
    rows = stored(rows, by=block, order=[block, "id", "variant"])
    discard(spark, marked_path)
    e = FT.masks(FT.entity_loc_ids(FT.encode(rows, vocab, carry=("part", "label_id", "sentence"))))
    ex = FT.to_examples(e.withColumn("position_ids", FT.position_ids("input_ids")), keep=("part",))
    x = F.col("example")
    return finish(ex.select("id", "variant", "part", join_ints(x["input_ids"]).alias("input_ids"),
                            join_ints(x["entity_loc_ids"]).alias("entity_loc_ids"), x["labels"].alias("labels")))


# --- S: sources and sinks (round trips through the shared work folder) --------------

from sentrel.schema import RAW_SCHEMA  # noqa: E402
from sentrel.sources.files import put, read_catalog, read_re_csv, write_csv  # noqa: E402

_RAW_COLS = [f.name for f in RAW_SCHEMA.fields]


@register("s01_csv_scan")
def s01(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    write_csv(fx.re_raw(spark, sf_dir).select(*_RAW_COLS), path)
    return finish(read_re_csv(spark, path))


@register("s02_csv_scan_index")
def s02(spark, sf_dir):
    path = scratch_path(spark, "raw-csv-index")
    raw = fx.re_raw(spark, sf_dir)
    write_csv(raw.select(F.col("id").alias("_index"), *_RAW_COLS), path)
    return finish(read_re_csv(spark, path))


@register("s03_load_catalog")
def s03(spark, sf_dir):
    """Three files loaded by name, then a second m1, which replaces the first: the last one wins."""
    files, catalog = scratch_path(spark, "catalog-files"), scratch_path(spark, "catalog")
    cat = EA.with_output_prob(fx.pred_catalog(spark, sf_dir)).select("dataset", "id", "label_id", "output_prob")
    schema = T.StructType.fromDDL("id bigint, label_id int, output_prob string")
    for name in ("m0", "m1", "m2"):
        write_csv(cat.where(F.col("dataset") == name).drop("dataset"), f"{files}/{name}.csv")
    put(spark, catalog, f"{files}/*.csv", schema)
    again = scratch_path(spark, "catalog-again")
    second = cat.where("dataset = 'm1'").select("output_prob", ((F.col("label_id") + 1) % 30).alias("label_id"), "id")  # other column order
    write_csv(second, f"{again}/m1.csv")
    put(spark, catalog, f"{again}/m1.csv", schema)
    return finish(read_catalog(spark, catalog, schema).select("dataset", "id", "label_id", "output_prob"))


@register("q01_quarantine")
def q01(spark, sf_dir):
    """Hard rows routed in one pass: rows read, kept and put apart by reason, as counted on the way
    (``n_rows``) and as found in the two written parts (``n_found``)."""
    kept, bad, seen = P.routed(fx.re_hard(spark, sf_dir), scratch_path(spark, "routed"))
    found = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_found"))
    found = found.unionByName(kept.agg(F.count(F.lit(1)).alias("n_found")).withColumn("reason", F.lit("kept")))
    total = found.agg(F.sum("n_found").alias("n_found")).withColumn("reason", F.lit("read"))
    counts = spark.createDataFrame(list(seen.items()), "reason string, n_rows bigint")
    return finish(counts.join(found.unionByName(total), "reason", "left").select("reason", "n_rows", F.coalesce("n_found", F.lit(0)).alias("n_found")))


@register("s05_csv_sink")
def s05(spark, sf_dir):
    path = scratch_path(spark, "marked-csv")
    write_csv(_marked(spark, sf_dir).select(*["id", "sentence", "subject_entity", "object_entity",
                                              "subject_type", "object_type", "label", "subject_idx",
                                              "object_idx"]), path)
    schema = ("id bigint, sentence string, subject_entity string, object_entity string, subject_type string, "
              "object_type string, label string, subject_idx string, object_idx string")
    back = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"') \
        .schema(T.StructType.fromDDL(schema)).csv(path)
    return finish(back)

"""Queries of the corpus operators (``QUERIES``) and their DuckDB SQL (``SQL``,
where SQL can express them). Each runs over its whole table with the
operators' production parameters."""

from __future__ import annotations

from sentrel.llm.block_search import search
from sentrel.llm.exact_dedup import exact_dedup
from sentrel.llm.jaccard_join import near_duplicates
from sentrel.llm.lm_scoring import lm_scores
from sentrel.llm.mixing import mix_sources
from sentrel.llm.packing import packed
from sentrel.llm.phrase_dedup import remove_repeats
from sentrel.llm.pivot_join import embedding_links
from sentrel.llm.quality import quality
from sentrel.llm.shared import table
from sentrel.llm.token_counts import over_limit
from sentrel.llm.toxicity import toxicity
from sentrel.llm.warc import warc_round_trip
from sentrel.llm.whitening import as_long, whitened

QUERIES = {}
SQL = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("op1_toxicity")
def op1(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_quality")
def op2(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op3_exact_dedup")
def op3(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


SQL["op3_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""


@register("op10_mix")
def op10(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))


#: Sizes, hashes and targets, shared with the pipeline's SQL: the documents come as view ``d``.
MIX_CTES = r"""
sized AS (SELECT d.*, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                 ('0x' || substr(md5('mix ' || doc_id), 1, 15))::BIGINT AS h FROM d),
src AS (SELECT source, sum(size)::BIGINT AS source_size,
               CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
        FROM sized GROUP BY source),
ranked AS (SELECT *, 2 * source_size AS cap, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, w, source IS NULL, source) AS k FROM src),
levels AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM src)::DOUBLE - (sum(cap) OVER (ORDER BY k) - cap)::DOUBLE)
                     / (sum(w) OVER (ORDER BY k DESC))::DOUBLE AS level FROM ranked),
target AS (SELECT source, source_size, least(cap::DOUBLE, w::DOUBLE * (SELECT level FROM levels WHERE level * w <= cap ORDER BY k LIMIT 1)) AS target FROM levels),
mix AS (SELECT sized.*, source_size, target, CASE WHEN target >= source_size THEN 1 ELSE 0 END AS whole,
               floor(target)::BIGINT - CASE WHEN target >= source_size THEN source_size ELSE 0 END AS rest,
               sum(size) OVER (PARTITION BY sized.source ORDER BY h ROWS UNBOUNDED PRECEDING) - size AS before
        FROM sized JOIN target ON sized.source IS NOT DISTINCT FROM target.source),
took AS (SELECT *, (whole * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM mix)
"""
SQL["op10_mix"] = f"WITH d AS (SELECT * FROM documents), {MIX_CTES} SELECT doc_id, size, source_size, target, taken, source FROM took"


@register("op4_lm_scores")
def op4(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))


@register("op5_remove_repeats")
def op5(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@register("op6_pack")
def op6(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


@register("op7_warc")
def op7(spark, sf_dir):
    return warc_round_trip(table(spark, sf_dir, "pages"))


@register("op8_jaccard_join")
def op8(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("kept", "raw")


@register("op9_embedding_links")
def op9(spark, sf_dir):
    return embedding_links(table(spark, sf_dir, "embeddings"))


@register("op11_whitening")
def op11(spark, sf_dir):
    return whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", as_long())


@register("op12_block_search")
def op12(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL["op12_block_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS t FROM documents),
total AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
m AS (SELECT r, doc_id, t, 75 + (25 * len(t) * n_docs) // n_terms AS m FROM d, total WHERE len(t) > 0),
tf AS (SELECT r, doc_id, m, term, count(*) AS tf FROM (SELECT r, doc_id, m, unnest(t) AS term FROM m) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
q AS (SELECT i, item_id, term, count(*) AS qf FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT i, item_id, r, doc_id, sum(qf * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM q JOIN w USING (term) JOIN tf USING (term) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""


@register("op13_token_counts")
def op13(spark, sf_dir):
    return over_limit(table(spark, sf_dir, "documents"))

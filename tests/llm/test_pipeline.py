"""The corpus pipeline on a small folder: its filtering stages against plain versions, each on its own
input (mixing and packing are held against brute force in test_packing_mixing)."""
import numpy as np

import corpus_pipeline
from sentrel.llm.shared import written
from sentrel.llm.toxicity import toxicity
from tests.llm import brute
from tests.llm.conftest import SCHEMA


def corpus():
    r = np.random.default_rng(9)
    syllables = ["an", "er", "th", "on", "re", "in", "ti", "ou", "st", "le", "na", "mo"]
    insults = ["blargface", "zugwump", "krexhead", "vumblepot"]
    rows, toxic = [], {}
    for i in range(420):
        w = ["".join(r.choice(syllables, r.integers(1, 5))) for _ in range(int(r.integers(25, 70)))]
        if i % 4 == 0:
            for k in r.choice(len(w), 3, replace=False):
                w[k] = str(r.choice(insults))
        toxic[i] = int(i % 4 == 0)
        rows.append((i, " ".join(w), "en", "abca"[int(r.integers(0, 4))], 0))
    clean = [x for x in rows if not toxic[x[0]]]
    extra = [(clean[k][1], clean[k][3]) for k in range(8)] + [(clean[20][1].replace(" ", "\n\t"), "b")]  # exact copies
    for k in range(30, 42):  # near copies
        w = clean[k][1].split()
        w[len(w) // 2] = "changed"
        extra.append((" ".join(w), clean[k][3]))
    extra += [(None, "a"), ("", None), (" ", "a"), ("two words", "c"), ("Two words", "c")]
    rows += [(1000 + k, t, None, s, None) for k, (t, s) in enumerate(extra)]
    return [*rows, rows[1], rows[1], (None, clean[50][1] + " tail of its own", "en", "b", 0)], toxic


def plain(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def by_id(x):
    return (x[0] is None, x[0] or 0, x[1] or "")


def test_filtering_stages_against_plain_versions(spark, tmp_path):
    rows, toxic = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, None, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix", "pack"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, found = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES[:3]:
        found.append(written(stage(spark, found[-1], str(tmp_path)), name))
        assert found[-1].columns == columns
    before, safe, exact, near = (plain(d) for d in found[:4])

    # toxicity: what the operator marks goes; insults go, and clean documents stay but for the model's few errors
    marked = {r["doc_id"]: r["predicted"] for r in toxicity(docs, labels).collect()}
    assert sorted(safe, key=by_id) == sorted((x for x in before if not marked[x[0]]), key=by_id)
    left = {x[0] for x in safe}
    clean = [x[0] for x in before if not toxic.get(x[0], 0)]
    assert sum(i not in left for i, t in toxic.items() if t) >= 0.9 * sum(toxic.values())
    assert sum(i in left for i in clean) >= 0.97 * len(clean), [x for x in before if x[0] in clean and x[0] not in left]

    # exact copies: of equal texts the smallest id stays, of identical rows one
    first = {sha: keep for _, keep, _, sha in brute.exact([x[:2] for x in safe])}
    want = {(d, sha) for d, keep, _, sha in brute.exact([x[:2] for x in safe]) if d == keep}
    assert {(d, sha) for d, _, _, sha in brute.exact([x[:2] for x in exact])} == want and len(exact) == len(first) == len(want)

    # near copies: one document of each component
    assert sorted(((x[0],) for x in near), key=lambda x: by_id((*x, ""))) == sorted({(c,) for *_, c in brute.near([x[:2] for x in exact])}, key=lambda x: by_id((*x, "")))
    assert len(near) <= len(exact) - 5

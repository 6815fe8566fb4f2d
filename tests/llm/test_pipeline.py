from pyspark.sql import functions as F

import corpus_pipeline as P
from coverlark.llm import bpe, exact_dedup, mixing, near_copies, quality

from .test_classifiers import corpus


def test_stages_by_a_plain_version(spark, tmp_path):
    docs, labels = corpus(spark)
    docs = docs.drop("score").where("doc_id is not null").dropDuplicates(["doc_id"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    seen = quality.views(docs)
    good = {r.doc_id for r in quality.score_views(seen, quality.fit(seen, labels)).where("kept").collect()}
    bare = lambda t: "".join(c for c in t or "" if c not in exact_dedup.WHITE_SPACE)
    groups = {}
    for i in sorted(good):
        groups.setdefault(bare(rows[i].text), []).append(i)
    once = {min(g, key=lambda i: (-len(rows[i].text or ""), i)) for g in groups.values()}
    sets = {i: near_copies.shingles(rows[i].text or "") for i in once}
    parent = {i: i for i in once}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in once:
        for b in once:
            if a < b and near_copies.jaccard(sets[a], sets[b]) >= 0.8:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    near = {i for i in once if root(i) == i}
    left = docs.where(docs.doc_id.isin([*near]))
    copies = {r.doc_id: r.copies for r in mixing.mix(left, mixing.fit_domains(left, labels)).collect()}
    want = sorted(i for i, n in copies.items() for _ in range(n))
    got = P.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == want
    ours = bpe.load(bpe.default_path())
    assert all(r.n_tokens == len(ours.encode(rows[r.doc_id].text or "")) for r in got)
    assert [name for name, _ in P.STAGES] == ["quality classifier", "exact dedup", "simhash near-dedup", "mixing", "bpe"]


def test_stages_take_nulls_repeats_and_clashing_columns(spark, tmp_path):
    docs, labels = corpus(spark, 60)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = docs.withColumns({"rate": F.lit("r"), "_rate": F.lit(1), "copies": F.lit(2), "node": F.lit("n"), "x": F.lit(3), "keep_id": F.lit(4)})
    none = docs.where("false")
    kept = docs
    # The row without an id is a very long odd text, which the classifier may reject; the stage must follow its decision.
    seen = quality.views(docs)
    judged = quality.score_views(seen, quality.fit(seen, labels)).where("doc_id is null and kept").count()
    for name, stage in P.STAGES[:-1]:
        kept = P.materialize(stage(spark, kept, str(tmp_path)), "stage")
        none = stage(spark, none, str(tmp_path))
        assert kept.columns == docs.columns and none.columns == docs.columns and none.count() == 0, name
        assert kept.where("doc_id is null").count() == (judged if name == "quality classifier" else 1), name
        if name == "quality classifier" and not judged:
            kept = kept.unionByName(docs.where("doc_id is null"))
        assert kept.where("rate = 'r' and copies = 2 and keep_id = 4").count() == kept.count(), name
        if name != "mixing":
            assert kept.where("doc_id = 1").count() == (2 if name == "quality classifier" else 1), name
    assert P.tokens(spark, none, "").count() == 0 and P.tokens(spark, kept, "").count() == kept.count()

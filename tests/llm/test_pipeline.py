"""The pipeline's stages on dirty rows and whole, and the subpackage's queries in the entry."""

import corpus_pipeline
from voltwatch.llm import bpe, decontam, langid, minhash, pii, queries
from voltwatch.llm.common import documents

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = documents(spark, SF)
    extra = spark.createDataFrame(
        [(10**6, None, "en", None, None), (10**6 + 1, "", None, "s", 0), (None, "Is and the of that this", "en", "s", 1), (10**6 + 2, "write to a@b.co about the and of that", "en", "s", 9)] + [tuple(docs.first())] * 3,
        docs.schema,
    )
    docs = docs.union(extra)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert 0 < len(rows) <= docs.count()
        docs = seen[name] = spark.createDataFrame(rows, docs.schema)
    after = minhash.near_duplicates(seen["near_duplicates"], 5, 80).where("n_shingles > 0 AND NOT kept")
    assert after.count() == 0
    assert decontam.leaks(seen["decontamination"], spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    assert pii.pii_digest(seen["personal_data"]).where("spans <> ''").count() == 0
    assert seen["personal_data"].count() == seen["decontamination"].count()


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    docs = documents(spark, SF)
    kept = pii.redact(decontam.decontaminate(minhash.one_of_each(langid.recognised(docs)), spark.read.parquet(f"{SF}/benchmark.parquet")))
    want = bpe.bpe_digest(kept, queries.tokenizer("word_bpe_49k.json"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_stages_take_an_empty_table(spark):
    docs = documents(spark, SF).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_entry_has_the_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {"pipeline", *queries.QUERIES} <= {*names}
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}

import hashlib

import corpus_pipeline
from helpers import lower

SF = "/root/testdata/sf0.001"


def test_stages_chain(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        found = docs.collect()
        assert all(seen[r.doc_id] == r.text for r in found)
        if name in ("exact_dedup", "near_dedup"):
            assert len({lower(r.text) for r in found}) == len(found)
    ids = {r.doc_id for r in docs.collect()}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect():
        assert r.doc_id in ids and r.decoded_sha256 == hashlib.sha256((seen[r.doc_id] or "").encode()).hexdigest() and r.n_tokens == len(r.ids)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(found, docs.schema) if (found := docs.collect()) else docs
        docs = stage(spark, docs, SF)
    digest = lambda df: sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())
    got = digest(corpus_pipeline.run(spark, SF))
    assert got == digest(docs) and got


def test_exact_sql_agrees(spark):
    import duckdb

    from lakeweave.llm import registry

    c = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in registry.oracle_sql().items():
        df = registry.queries()[name](spark, SF)
        want = c.execute(sql)
        order = [[d[0] for d in want.description].index(x) for x in df.columns]
        assert sorted((tuple(r) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)

import corpus_pipeline
from lakelayer.llm import decontaminate, mixing, simhash, toxicity
from lakelayer.llm.common import TABLES, drop_tables, read


def test_stages_keep_what_they_should(spark, sf):
    """Each stage against its operator, on the rows that the one before kept."""
    docs = read(spark, sf, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "decontamination", "mixing", "sharding"]
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    kept = stages["toxicity"](spark, docs, sf).cache()
    bad = toxicity.score(docs, read(spark, sf, "labels"), toxicity.learnt_rows()).filter("predicted = 1")
    assert ids(kept) == sorted(set(ids(docs)) - set(ids(bad)))
    single = stages["simhash"](spark, kept, sf).cache()
    assert ids(single) == ids(simhash.near_duplicates(kept).filter("doc_id = component_id"))
    clean = stages["decontamination"](spark, single, sf).cache()
    assert decontaminate.decontaminate(clean, read(spark, sf, "benchmark")).filter("contaminated").count() == 0
    assert set(ids(clean)) == set(ids(decontaminate.decontaminate(single, read(spark, sf, "benchmark")).filter("NOT contaminated")))
    mixed = stages["mixing"](spark, clean, sf).cache()
    assert all(x.columns == docs.columns for x in (kept, single, clean, mixed))
    taken = {r["doc_id"]: r["n_copies"] for r in mixing.mix(clean).filter("size > 0").collect()}
    assert ids(mixed) == sorted([i for i, n in taken.items() for _ in range(n)] + ids(mixing.mix(clean).filter("size = 0")))
    shards = stages["sharding"](spark, mixed, sf)
    assert shards.columns == [*docs.columns, "size", "shard", "slot"] and ids(shards) == ids(mixed)


def test_empty_and_messy(spark, sf, messy, no_docs):
    for docs in (no_docs, messy):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            if name != "sharding":
                assert docs.columns == messy.columns
        docs.count()


def test_run_removes_what_it_no_longer_reads(spark, sf):
    since = len(TABLES)
    out = corpus_pipeline.run(spark, sf)
    rows = out.count()
    left = TABLES[since:]  # the last stage's input and its own tables
    assert rows > 0 and 0 < len(left) <= 8
    drop_tables(spark, since)
    assert len(TABLES) == since

import public_tokenizers

import corpus_pipeline
from haltwise.llm import common, jaccard, quality, secrets
from haltwise.llm.pretokens import encoder
from haltwise.session import fresh_dir


def labelled(spark, docs, folder):
    """A folder of tables for `docs` with labels of some."""
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(10, 1, 0), (11, 1, 0), (18, 1, 0), (22, 1, 0), (20, 0, 0), (21, 0, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_on_awkward_documents(spark, awkward):
    folder = labelled(spark, awkward, fresh_dir(spark, "tables"))
    docs = common.table(spark, folder, "documents")
    labels = common.table(spark, folder, "labels")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "ngram_jaccard_join", "secret_scans", "best_fit_packing"]

    kept = common.save(stages["quality_classifier"](spark, docs, folder), "t")
    assert kept.columns == docs.columns
    good = {(r.doc_id, r.text_hash) for r in quality.score(docs, labels).filter("kept").collect()}
    hashed = docs.selectExpr("doc_id", "text", "xxhash64(text) h").collect()
    assert texts(kept) == sorted(((r.doc_id, r.text) for r in hashed if (r.doc_id, r.h) in good), key=str)

    # from all documents on, so that copies and secrets are there whatever was rejected
    single = common.save(stages["ngram_jaccard_join"](spark, docs, folder), "t")
    assert single.columns == docs.columns
    found = jaccard.jaccard_components(docs).collect()
    want = {r.component_id for r in found if r.n_shingles and r.component_id is not None}
    rows = texts(single)
    sized = {r.doc_id: r.n_shingles for r in found}
    assert sorted(i for i, t in rows if i is not None and sized[i]) == sorted(want)
    assert len([i for i, t in rows if i == 14]) == 1  # a repeated row without words
    assert len([i for i, t in rows if i is None]) == 2  # not the copy of document 3

    masked = common.save(stages["secret_scans"](spark, single, folder), "t")
    assert masked.columns == docs.columns and masked.count() == single.count()
    result, _ = secrets.scan_documents(masked)
    assert {r.n_access + r.n_hex for r in result.collect()} == {0}
    assert masked.filter("text like '%[secret]%'").count() >= 2
    assert masked.filter("n_chars <> length(text)").count() == 0

    packed = stages["best_fit_packing"](spark, masked, folder).collect()
    encoding = encoder(public_tokenizers.path("byte_bpe_50k.json")).encoding
    total = sum(len(encoding.encode_ordinary(t or "")) + 1 for _, t in texts(masked))
    assert sum(r.length for r in packed) == total


def test_run_joins_the_stages(spark, awkward, no_documents):
    folder = labelled(spark, awkward, fresh_dir(spark, "tables"))
    docs = common.table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.save(stage(spark, docs, folder), "t")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = sorted(map(tuple, docs.select(columns).collect()), key=str)
    got = corpus_pipeline.run(spark, folder).select(columns).collect()
    assert sorted(map(tuple, got), key=str) == want
    empty = labelled(spark, no_documents, fresh_dir(spark, "tables"))
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_one_document_of_each_group_stays_whatever_its_ids(spark):
    def prose(seed):
        return [f"w{seed}x{i}" for i in range(40)]

    def near(seed, k):
        return " ".join([*prose(seed)[:-1], f"other{k}"])

    rows = [
        (1, " ".join(prose(1))),  # one id, two texts that are not alike
        (1, " ".join(prose(2))),
        (2, near(2, 1)),
        (3, " ".join(prose(3))),  # one id, two texts of one group
        (3, near(3, 1)),
        (None, near(3, 2)),
        (None, " ".join(prose(4))),  # a group without ids
        (None, near(4, 1)),
        (None, near(4, 1)),
        (None, " ".join(prose(5))),  # alone, without id
        (4, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    single = texts(corpus_pipeline.near_duplicates(spark, docs, ""))
    groups = sorted((str(i), (t or "").split("x")[0]) for i, t in single)
    assert groups == [("1", "w1"), ("1", "w2"), ("3", "w3"), ("4", ""), ("None", "w4"), ("None", "w5")]

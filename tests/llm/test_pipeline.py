"""The pipeline's stages one after the other on a small given table, each against a plain version."""

import corpus_pipeline
from tests.llm import brute


def test_stages_in_order(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    first = kept["quality classifier"]
    assert len(good & set(first)) >= 0.97 * len(good)

    ids = sorted(first)
    _, least = brute.jaccard_components([(i, first[i]) for i in ids], 5, 80)
    second = kept["n-gram Jaccard join"]
    assert set(second) == {i for i, c in zip(ids, least, strict=True) if i == c}

    third = kept["suffix-array dedup"]
    assert set(third) == set(second)
    ids = sorted(second)
    texts = [second[i] for i in ids]
    spans, read_over = brute.repeats(texts, 400), brute.passages(texts, 255, 51)
    assert sum(len(third[i].encode()) for i in ids) <= sum(n - gone for n, gone, *_ in spans)
    for i, (_, gone, *_), own in zip(ids, spans, read_over, strict=True):
        raw = second[i].encode()
        if not gone:  # nothing but the passages goes
            cuts = [0, *(at for passage in own for at in passage), len(raw)]
            left = b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
            assert third[i] == left.decode("utf-8", "ignore")
    assert any(own and not gone for (_, gone, *_), own in zip(spans, read_over, strict=True))

    fourth = kept["benchmark decontamination"]
    assert set(fourth) == {i for i, t in third.items() if not brute.contamination(t, items)[-1]}

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in pieces} == set(fourth)


def test_stages_take_awkward_rows(spark, sf_dir):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x " * 3000, "en", "s", 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = corpus_pipeline.settle(stage(spark, table, sf_dir), "test-stage")
        corpus_pipeline.STAGES[-1][1](spark, table, sf_dir).collect()

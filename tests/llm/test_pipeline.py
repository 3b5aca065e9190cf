"""The pipeline's stages against plain versions of them, on a small table."""

import hashlib
import os

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm import toxicity  # noqa: E402
from tidemark.llm.common import tokenizer_file  # noqa: E402

from .conftest import SF_DIR  # noqa: E402
from .test_line_dedup import plain as plain_lines  # noqa: E402
from .test_simhash import plain_classes, plain_fingerprint  # noqa: E402


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line dedup", "near duplicates", "mixing", "bpe"]

    model = toxicity.fit(docs, labels)
    kept = stages["toxicity"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    given = {(r.doc_id, r.text) for r in docs.collect()}
    harmless = {(d, t) for d, t in given if model.weights[toxicity.features(t)].sum() + model.bias < 0}
    rows = [tuple(r) for r in kept.collect()]
    assert {r[:2] for r in rows} == harmless and len(rows) == len(harmless)

    cut = stages["line dedup"](spark, kept, SF_DIR)
    assert cut.columns == docs.columns
    want = {(d, new) for (d, _), (new, gone) in plain_lines(list(harmless)).items() if not gone or new.strip()}
    texts = [(r.doc_id, r.text) for r in cut.collect()]
    assert set(texts) == want and len(texts) == len(want)

    single = stages["near duplicates"](spark, cut, SF_DIR)
    assert single.columns == docs.columns
    classes = plain_classes([(d, plain_fingerprint(t)) for d, t in texts])
    alone = [(r.doc_id, r.text) for r in single.collect()]
    assert sorted(d for d, _ in alone) == sorted(set(classes.values())) and set(alone) <= set(texts)

    mixed = stages["mixing"](spark, single, SF_DIR)
    assert mixed.columns == docs.columns
    many = [(r.doc_id, r.text) for r in mixed.collect()]
    assert set(many) == set(alone) and len(many) >= len(alone)

    library = Tokenizer.from_file(tokenizer_file())
    out = {r.doc_id: r for r in stages["bpe"](spark, mixed, SF_DIR).collect()}
    for d, t in many:
        ids = library.encode(t, add_special_tokens=False).ids
        assert out[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert out[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() and out[d].n_tokens == len(ids)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows.count() > 100


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.collect() == []

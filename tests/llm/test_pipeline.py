import re

import corpus_pipeline
from frames import documents, empty
from test_quality import slow_counts
from test_simhash import slow_classes, slow_fingerprint

from tidemark.llm import dedup, packing, quality, simhash
from tidemark.llm.queries import WORD_TOKENIZER
from tidemark.llm.shared import read_table
from tidemark.llm.tokens import encoder


def test_stages_in_turn(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf_dir)
        assert after.columns == docs.columns, name
        assert after.count() < kept.count() or name == "simhash_near_dedup"
        kept = after
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in packed} == ids
    sizes = {}
    for r in packed:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    assert max(sizes.values()) <= 2048


def test_awkward_rows_pass_all_stages(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    for docs in (documents(spark), empty(spark)):
        kept = quality.drop_low_quality(docs, labels)
        kept = simhash.drop_near_duplicates(dedup.drop_duplicates(kept))
        assert kept.columns == docs.columns
        packed = packing.pack(kept, WORD_TOKENIZER, end=1)
        assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in kept.collect()}


def test_run_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    # Too few labels for any cutoff: only the base rules reject.
    assert read_table(spark, sf_dir, "labels").where("quality = 1").count() < 150
    kept = {}
    for r in sorted(read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()):
        n_words, *_, repeats = slow_counts(r.text)
        if n_words >= 10 and 100 * repeats <= 20 * n_words:
            kept.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r)
    texts = {r.doc_id: r.text for r in kept.values()}
    classes = slow_classes([(i, slow_fingerprint(t)) for i, t in texts.items()])
    texts = {i: texts[i] for i, _, least in classes if i == least}
    sizes = {i: len(encoder(WORD_TOKENIZER).tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    found = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == sizes

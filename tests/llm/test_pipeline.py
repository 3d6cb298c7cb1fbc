"""The pipeline's stages against brute force, each on the input it gets."""

import random

import corpus_pipeline
from lendlens.llm import decontaminate, language_id, simhash
from lendlens.llm.common import stored, table
from tests.llm.conftest import ODD, SF_DIR, frame
from tests.llm.test_dedup import brute_components, brute_fingerprint


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, kept = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "stage-test")
        kept.append(docs.collect())
        if name != "byte-level BPE":
            assert docs.columns == columns
    start, known, unique, near, clean, tokens = kept
    assert len(known) >= 0.98 * len(start)
    last = {}
    for row in known:
        last[row.text] = max(row.doc_id, last.get(row.text, -1))
    assert {r.doc_id for r in unique} == set(last.values())
    labels = brute_components({r.doc_id: brute_fingerprint(r.text) for r in unique})
    assert {r.doc_id for r in near} == set(labels.values())
    items = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
    leaked = {r.doc_id for r in near if any(item in r.text for item in items)}
    assert {r.doc_id for r in clean} <= {r.doc_id for r in near} - leaked
    assert len(clean) >= len(near) - len(leaked) - 0.01 * len(near)
    assert {r.doc_id for r in tokens} == {r.doc_id for r in clean}


PLAIN = "the quiet river runs past the old mill and the people of the village walk there every evening"


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_rows_do_not_take_each_other_along(spark):
    item = "a train left the old station with many boxes for the small town by the sea"
    benchmark = spark.createDataFrame([(1, item, 5, "x")], "item_id long, text string, hash int, key string")
    docs = frame(spark, [(None, item), (None, PLAIN), (7, item), (7, PLAIN), (8, PLAIN), (8, None), (9, "")])
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert rows_of(kept) == sorted([(None, PLAIN), (7, PLAIN), (8, PLAIN), (8, None), (9, "")], key=str)


def test_near_copies_of_repeated_and_missing_ids(spark):
    near, other = "alpha beta gamma delta", "entirely other words with nothing in common here at all"
    docs = [(1, near), (2, near), (2, other), (None, near), (None, "a third text of its own kind"), (None, "a third text of its own kind"), (5, None), (6, "")]
    kept = simhash.drop_near_copies(frame(spark, docs))
    assert kept.columns == frame(spark, docs).columns
    assert rows_of(kept) == sorted([(1, near), (2, other), (None, "a third text of its own kind"), (5, None)], key=str)


def test_language_of_repeated_and_missing_ids(spark):
    words = "the quiet river runs past old mill people of village walk there every evening".split()
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(words, k=40)), "en") for i in range(400)]
    strange = "ξψ ω ϗ ϡ " * 30
    rows += [(None, PLAIN, None), (None, strange, None), (500, PLAIN, None), (500, strange, None), (501, "½ ² ①", None), (502, None, None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, entropy int, digest string")
    kept = language_id.drop_unknown(docs)
    assert kept.columns == docs.columns
    left = [r for r in rows_of(kept) if r[0] is None or r[0] >= 500]
    assert left == sorted([(None, PLAIN), (500, PLAIN)], key=str)
    answers = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert (answers[501].lang_pred, answers[501].score) == ("und", 0.0)


def test_stages_on_odd_and_no_rows(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, docs, SF_DIR)
            if name != "byte-level BPE":
                assert kept.columns == docs.columns
            rows = kept.collect()
            if docs is none:
                assert rows == []
            elif name == "benchmark decontamination":
                assert rows_of(kept) == rows_of(docs)
            elif name == "byte-level BPE":
                assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert whole.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]

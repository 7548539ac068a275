"""Chat rotation, and the pipeline's stages on a small corpus."""

import os

import corpus_pipeline
import pytest
from vistaloom.llm import chat
from vistaloom.llm.queries import QUERIES

CONV = "conv_id long, turn long, role string, text string, part string, messages string"


def test_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", "hé"), (1, 3, "ann", None), (1, None, None, "lost"), (2, 0, "system", "alone"), (None, 1, "x", "y"), (3, 130, "a", "same"), (3, 130, "a", "same")]
    got = {(r.conv_id, r.perspective, r.part): r for r in chat.rotated(spark.createDataFrame([(*r, "p", "m") for r in rows], CONV)).collect()}
    assert set(got) == {(1, p, k) for p in ("ann", "bob", "unknown") for k in (-1, 0)} | {(3, "a", 2)}
    r = got[1, "ann", 0]
    assert r.text == "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob\nhé<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [r.text[s.start : s.end] for s in r.mask] == ["hi < |im_end|><|im_end|>", "<|im_end|>"]
    assert [got[1, "bob", 0].text[s.start : s.end] for s in got[1, "bob", 0].mask] == ["hé<|im_end|>"]
    assert got[3, "a", 2].n_turns == 2
    assert chat.rotated(spark.createDataFrame([], CONV)).count() == 0


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
    passage = "a sentence that several documents have in common and that is clearly longer than a hundred bytes in all, as it goes on"
    own = [" ".join(f"{w}{k}" for w in "every document here has words of its own so that nothing links it to others at all".split()) for k in range(40)]
    rows = [(k, t) for k, t in enumerate(own)]
    rows += [(100, own[3]), (101, "12345 !!"), (102, f"every document here {item.upper()} has words of its own"), (103, f"one {passage} x"), (104, f"two {passage} y z"), (105, None), (106, "")]
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "bpe_encoding"]
    ids = []
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, corpus)
        path = f"{corpus}/stage{len(ids)}"
        docs.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert len(ids) == 5 or docs.columns == columns
        if len(ids) == 3:
            texts = {r.doc_id: r.text for r in docs.collect()}
            assert "several documents" in texts[103] and "several documents" not in texts[104]
    assert ids[0] == {*range(40), 100, 102, 103, 104} and ids[1] == ids[0] - {100} and ids[2] == ids[1] and ids[3] == ids[2] - {102} and ids[4] == ids[3]
    assert {r.doc_id for r in corpus_pipeline.run(spark, corpus).collect()} == ids[4]


WIDE = "doc_id long, text string, lang string, source string, n_chars long, row string, key long, doc long, component_id long, words string, start int, __kept_id long"


def test_stages_with_odd_rows(spark, tmp_path):
    """Repeated and missing ids, ties, nulls in every column, columns whose names operators use themselves, and an empty table."""
    folder = str(tmp_path)
    spark.createDataFrame([(1, "one two three four five six seven"), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    prose = [" ".join(f"{w}{k}" for w in "every document here has words of its own so that nothing links it".split()) for k in range(30)]
    rows = [(k, t, "en") for k, t in enumerate(prose)] + [(3, prose[9] + " more", None), (3, prose[3], "en"), (None, prose[5], "en"), (None, None, None), (40, "", "en"), (41, "x " * 5000, "en"), (42, "ONE two Three four five six seven", "en")]
    docs = spark.createDataFrame([(d, t, x, None, None, "r", 1, 2, 3, "w", 4, 5) for d, t, x in rows], WIDE)
    empty = docs.limit(0)
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        last = name == corpus_pipeline.STAGES[-1][0]
        assert stage(spark, empty, folder).count() == 0, name
        out = stage(spark, docs, folder)
        assert last or out.columns == docs.columns
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        if not last:
            assert all((r.row, r.key, r.doc, r.component_id, r.words, r.start, r["__kept_id"]) == ("r", 1, 2, 3, "w", 4, 5) for r in docs.collect()), name
            empty = docs.limit(0)
    assert sizes[0] >= 30 and sizes[0] >= sizes[1] == sizes[2] >= sizes[3] == sizes[4]
    ids = [r.doc_id for r in docs.collect()]
    assert ids.count(3) == 2 and None in ids and 42 not in ids and 40 not in ids


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", ["op4_decontamination", "op7_chat"])
def test_native_plans_have_no_python(spark, name):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no tables")
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "BroadcastNestedLoop", "Cartesian"))

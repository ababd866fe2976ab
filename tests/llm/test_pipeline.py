"""The pipeline's stages, each on its own input."""

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    d = "/root/testdata/sf0.001"
    out = spark.read.parquet(f"{d}/documents.parquet").limit(80)
    names = out.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in out.select("doc_id").collect()}
        out = stage(spark, out, d).cache()
        after = {r.doc_id for r in out.select("doc_id").collect()}
        assert after <= before and after, name
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == names
    assert {"sequence_id", "ids"} <= set(out.columns)


CLASHING = ("score", "shard", "spans", "content", "hash", "host", "row", "a", "b")


def odd(spark):
    """Null ids, null and empty texts, a text without letters, repeated rows, a long text, column names of the stages' own."""
    prose = [" ".join(f"{w}{'abcdefgh'[(k * j) % 8]}" for j, w in enumerate(["harbour", "window", "letter", "morning", "garden", "river"] * 12)) for k in range(1, 6)]
    rows = [(1, None, "en"), (2, "", "en"), (3, " \n\t", "en"), (4, "12 !? 99", "en"), (5, prose[0], "en"), (5, prose[0], "en"), (6, prose[0], None), (None, prose[1], "en"), (None, prose[1], "en"), (7, prose[2], "en"), (8, " ".join(prose[3:]) * 40, "en"), (9, "word", "en")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(i, t, lang, "s", None, *CLASHING) for i, t, lang in rows], schema).repartition(3)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_a_stage_takes_odd_rows(spark, name, stage):
    docs = odd(spark)
    out, none = stage(spark, docs, SF), stage(spark, docs.limit(0), SF)
    got = out.collect()
    assert none.count() == 0
    if name == "packing":
        assert sum(r.length for r in got if r.doc_id in (1, 2)) == 2 and sum(r.length == 1 for r in got if r.doc_id == 1) == 1 and len({r.doc_id for r in got}) == 10
        return
    assert out.columns == docs.columns and none.columns == docs.columns and {tuple(r[c] for c in CLASHING) for r in got} <= {CLASHING}
    ids = sorted(r.doc_id or -1 for r in got)
    if name == "language_id":
        assert not {1, 2, 3, 4} & set(ids) and set(ids) <= {-1, 5, 6, 7, 8, 9}
    elif name == "near_duplicates":
        assert 6 not in ids and ids.count(5) == 2 and {7, 8} <= set(ids)
    elif name == "repeated_passages":
        text = {r.doc_id: r.text for r in got}
        assert len(got) == 12 and text[6] == "" and text[1] is None and text[2] == "" and text[7]
    else:
        assert len(got) == 12

"""The pipeline's stages, each on what its predecessor kept, against plain Python versions."""

from collections import Counter

import corpus_pipeline
import pytest

from storelens.llm import quality
from storelens.llm.common import write_once
from test_op1_op5_op10 import brute_pii
from test_op4_op6 import check_mix, check_pack
from test_op7 import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(write_once(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert "sequence_id" in stages[-1].columns


def test_quality_stage(spark, stages):
    model = quality.fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    rows = _rows(stages[0])
    tails = quality.Scorer(model).tails([r[1] for r in rows])[:, -1]
    assert Counter(_rows(stages[1])) == Counter(r for r, p in zip(rows, tails, strict=True) if p >= 0.5)
    assert 0 < stages[1].count() < len(rows)


def test_near_duplicate_stage(stages):
    rows = _rows(stages[1])
    gone = {i for i, _, c in brute([r[:2] for r in rows]) if i != c}
    assert Counter(_rows(stages[2])) == Counter(r for r in rows if r[0] not in gone) and gone


def redacted(text):
    at, out = 0, ""
    for start, _, end, kind in brute_pii(text):
        if start >= at:
            out += text[at:start] + f"<{kind}>"
        at = max(at, end)
    return out + text[at:]


def test_personal_data_stage(stages):
    before, after = {r[0]: r for r in _rows(stages[2])}, {r[0]: r for r in _rows(stages[3])}
    assert before.keys() == after.keys()
    for i, r in before.items():
        assert after[i] == (r[0], redacted(r[1]), *r[2:])


def test_mixing_and_packing_stages(spark, stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[3].collect()]
    from storelens.llm import mixing

    mixed = mixing.mix(stages[3]).collect()
    check_mix(rows, mixed)
    assert Counter((r.doc_id, r.text) for r in mixed) == Counter((r.doc_id, r.text) for r in stages[4].collect())
    n, total = check_pack([(r.doc_id, r.text) for r in stages[4].collect()], stages[5].collect(), 4096)
    assert total / (n * 4096) > 0.95


def test_run_equals_stages(spark, stages):
    assert Counter(_rows(corpus_pipeline.run(spark, SF))) == Counter(_rows(stages[-1]))

import numpy as np
import pytest

import corpus_pipeline as cp
from leadlens.llm import decontam, sp
from leadlens.llm.common import table
from leadlens.session import write_and_read
from tests.conftest import SF_SMALL
from tests.llm.test_minhash import brute_force as near_copies
from tests.llm.test_suffix import covered


@pytest.fixture(scope="module")
def stages(spark):
    out = [table(spark, SF_SMALL, "documents")]
    for name, stage in cp.STAGES:
        out.append(write_and_read(stage(spark, out[-1], SF_SMALL), "test-stage"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stage_columns_and_order(stages):
    columns = stages[0].columns
    assert [name for name, _ in cp.STAGES][0].startswith("quality") and len(cp.STAGES) == 5
    assert all(s.columns == columns for s in stages[1:5]) and stages[5].columns[0] == "doc_id"


def test_quality_keeps_clean_documents(spark, stages):
    kept = rows(stages[1])
    labels = table(spark, SF_SMALL, "labels").collect()
    good = [r.doc_id for r in labels if r.quality == 1 and r.toxic == 0]
    bad = [r.doc_id for r in labels if r.quality == 0]
    assert sum(d in kept for d in good) >= 0.95 * len(good) and sum(d in kept for d in bad) <= 0.1 * len(bad)


def test_near_copies_match_brute_force(stages):
    before, after = rows(stages[1]), rows(stages[2])
    want = {d for d, _, _, kept in near_copies([(d, r.text) for d, r in before.items()]) if kept}
    assert set(after) == want and all(after[d] == before[d] for d in want)


def test_passages_match_brute_force(stages):
    before, after = rows(stages[2]), rows(stages[3])
    ids = sorted(before)
    for d, (raw, mask) in zip(ids, covered([before[d].text for d in ids], cp.PASSAGE_BYTES), strict=True):
        assert after[d].text == bytes(np.frombuffer(raw, np.uint8)[~mask]).decode("utf-8", "ignore")


def test_benchmark_matches_brute_force(spark, stages):
    before, after = rows(stages[3]), rows(stages[4])
    items = {r.item_id: r.text for r in table(spark, SF_SMALL, "benchmark").collect()}
    found = decontam.brute_force({d: r.text for d, r in before.items()}, items)
    assert set(after) == {d for d, (n, hit, *_) in found.items() if n == 0 or hit < 0.8 * n}
    for d, r in after.items():
        assert (r.text == before[d].text) == (found[d][1] == 0)
        assert len(decontam.words(r.text)) == found[d][0] - found[d][1]


def test_encoding_decodes_and_run_gives_the_same(spark, stages):
    before, after = rows(stages[4]), rows(stages[5])
    assert set(after) == set(before) and all(r.same for r in after.values())
    model = cp.tokenizer_file("piece_bpe_32k.model")
    back = {r.doc_id: r.text for r in sp.decode(stages[5].select("doc_id", "ids"), model).collect()}
    assert back == {d: r.text for d, r in before.items()}
    assert {r.doc_id: r.ids for r in cp.run(spark, SF_SMALL).collect()} == {d: r.ids for d, r in after.items()}


def test_empty_documents(spark):
    docs = table(spark, SF_SMALL, "documents").limit(0)
    for name, stage in cp.STAGES:
        docs = write_and_read(stage(spark, docs, SF_SMALL), "test-empty")
        assert docs.count() == 0, name

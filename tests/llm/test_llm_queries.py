"""The registered queries against their SQL, and the pipeline stage by stage."""

import math
from collections import Counter
from pathlib import Path

import __spark_entry__ as contract
import compare
import corpus_pipeline
import pytest
from kerbside.llm import catalogue, mixing, quality
from kerbside.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not there")


def test_all_are_registered():
    assert [n.split("_")[0] for n in catalogue.queries()] == [f"op{n}" for n in range(1, 14)]
    assert catalogue.queries().keys() | {"pipeline"} <= contract.queries().keys()


@pytest.mark.parametrize("name", catalogue.oracle_sql())
def test_query_equals_oracle(spark, name):
    got = contract.queries()[name](spark, SF).toPandas()
    expected = compare.connect(SF).sql(contract.oracle_sql()[name]).df()
    assert len(got) > 0 and compare.difference(got, expected) is None


def test_stages_decide_and_keep_columns(spark, tmp_path):
    """Each stage on what its predecessor kept, against that stage's own operator tests' results."""
    from test_llm_decontamination import plain
    from test_llm_simhash import plain_components, plain_fingerprint

    docs = table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, held = docs.collect(), docs
        path = f"{tmp_path}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if name != "sharding":
            assert docs.columns == columns and 0 < len(after)
        if name == "quality":
            assert {tuple(r) for r in after} <= {tuple(r) for r in before} and len(after) < len(before)
            good = [r.doc_id for r in quality.op6_quality(spark, SF).collect() if r.predicted]
            assert sorted(r.doc_id for r in after) == sorted(good)
        if name == "simhash":
            groups = plain_components([r.doc_id for r in before], [plain_fingerprint(r.text) for r in before])
            assert sorted(r.doc_id for r in after) == sorted(set(groups))
        if name == "decontamination":
            clean = [r[0] for r in plain([(r.doc_id, r.text) for r in before], items) if not r[5]]
            assert sorted(r.doc_id for r in after) == sorted(clean)
        if name == "mixing":
            have = {tuple(r) for r in before}
            assert {tuple(r) for r in after} <= have and len(after) <= 3 * len(before)
            copies = Counter()
            for r in mixing.mix(held).collect():
                copies[r.doc_id] += math.floor(r.taken / r.size + 0.5) if r.size else 0
            assert Counter(r.doc_id for r in after) == +copies
        if name == "sharding":
            assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
            assert {r.shard for r in after} <= set(range(40))
            whole = lambda rows: sorted((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows)
            assert whole(after) == whole(before)


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[:5] == ["doc_id", "size", "text_crc32", "law", "shard"] and got.count() > 0

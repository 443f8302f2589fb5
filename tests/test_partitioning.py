"""Results do not depend on how the inputs are partitioned."""

import pytest

import __spark_entry__ as E
from millrace.plans import catalog
from tests.oracle_util import canonical

NAMES = ["exact_dedup", "decontaminate_tf", "near_dup_pairs", "chat_render", "vocab_encode",
         "label_mask", "pack_plan", "seeded_shuffle", "budget_sweep"]


@pytest.fixture(scope="module")
def baseline(spark, sf_small):
    return {n: canonical(E.queries()[n](spark, sf_small).toPandas()) for n in NAMES}


@pytest.mark.parametrize("n_parts", [1, 7, 64])
def test_same_results_under_repartition(spark, sf_small, baseline, monkeypatch, n_parts):
    original = catalog.table

    def repartitioned(spark_, sf, name, spread=True):
        return original(spark_, sf, name, spread=False).repartition(n_parts)

    monkeypatch.setattr(catalog, "table", repartitioned)
    for n in NAMES:
        assert canonical(catalog.QUERIES[n](spark, sf_small).toPandas()) == baseline[n], n

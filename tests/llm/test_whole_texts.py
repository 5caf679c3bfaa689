"""Operators read whole lines, texts and runs, and samples of the stated size."""

import numpy as np
import pytest

from chronolith.llm import jaccard, quality, toxicity


def test_toxicity_learns_from_1500_rows_a_class(spark):
    ids = spark.range(2500)
    texts, labels = toxicity.training_rows(ids.selectExpr("id as doc_id", "'a' as text"), ids.selectExpr("id as doc_id", "0 as toxic"))
    assert len(texts) == len(labels) == 1500


def test_capitals_are_counted_over_the_whole_line():
    capitals = quality.FEATURES.index("capitals")
    has = lambda text: capitals in quality.line_features(text.encode(), text.encode().split(), False)
    prose, shouting = "quiet words here " * 30, "LOUD WORDS HERE " * 30
    assert has(prose + shouting * 3) and not has(shouting + prose * 3)
    assert has(shouting) and not has(prose)


@pytest.mark.parametrize("run", [1, 65_535, 65_536, 131_070, 200_001])
def test_long_runs_of_nodes_are_packed_whole(run):
    node = np.concatenate([np.full(3, 7), np.full(run, -4), np.full(2, 7)]).astype(np.int64)
    assert np.array_equal(jaccard._unpack_nodes(jaccard._pack_nodes(node)), node)

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import chosen_path
from tidewell.llm.jaccard import parities


def test_chosen_path_rows_of_blocks_grow_as_the_input(spark, monkeypatch):
    """Texts that share a passage part ways before they are compared: three times the texts, hardly more rows each; links are found."""
    sent, compared = [], chosen_path._compared

    def counted(nodes, *rest):
        sent[-1] += nodes.agg(F.coalesce(F.sum(F.ceil(F.col("outside") / chosen_path.BLOCK)), F.lit(0))).first()[0]
        return compared(nodes, *rest)

    monkeypatch.setattr(chosen_path, "_compared", counted)
    monkeypatch.setattr(chosen_path, "BLOCK", 32)
    passage = " ".join(f"p{k}" for k in range(30))
    for size in (200, 600):
        sent.append(0)
        texts = [passage + " " + " ".join(f"o{i}.{k}" for k in range(40)) for i in range(size)]
        docs = spark.createDataFrame(list(enumerate([*texts, texts[3] + " more", "more " + texts[8]])), "doc_id bigint, text string")
        found = chosen_path.smallest_ids(chosen_path.linked(docs, small=32)).collect()
        assert {r.doc_id: r.component_id for r in found} == {**{i: i for i in range(size)}, size: 3, size + 1: 8}
    assert 0 < sent[1] <= 4 * sent[0]


@pytest.mark.parametrize("side", [1, 2])
def test_chosen_path_few_large_blocks_compare_all_pairs(spark, monkeypatch, side):
    """A node of more than SIDE blocks' rows sends each class to SIDE blocks at most, and forms the same pairs."""
    r = np.random.default_rng(5)
    base = np.unique(r.integers(1 << 63, size=200, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[r.random(len(base)) > 0.04], r.integers(1 << 63, size=3, dtype=np.uint64)])) for _ in range(60)]
    reps = spark.createDataFrame([(i, np.concatenate([parities(s), chosen_path.sketch(chosen_path.minwise(s))]).tolist()) for i, s in enumerate(sets)], "id bigint, bits array<bigint>")
    nodes = spark.createDataFrame([(7, i, len(s), i, 60, 0, 59) for i, s in enumerate(sets)], "key bigint, id bigint, size bigint, comp bigint, n bigint, main bigint, outside bigint")
    whole = {(x.a, x.b) for x in chosen_path._compared(nodes, reps, 85, 100).collect()}
    monkeypatch.setattr(chosen_path, "BLOCK", 8)
    monkeypatch.setattr(chosen_path, "SIDE", side)
    assert nodes.select(F.max(chosen_path._blocks("n"))).first()[0] == side
    assert len(whole) > 100 and {(x.a, x.b) for x in chosen_path._compared(nodes, reps, 85, 100).collect()} == whole

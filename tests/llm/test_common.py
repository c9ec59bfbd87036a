import os

import pytest

from cellframe.llm.common import Scratch


def test_intermediate_tables_are_released(spark):
    scratch, other = Scratch(spark, "one"), Scratch(spark, "two")
    before = other.write(spark.range(3), "before")
    mark = Scratch.mark()
    gone, kept = scratch.write(spark.range(5), "gone"), other.write(spark.range(7), "kept")
    Scratch.release(spark, mark, [other.path(kept)])
    assert not os.path.exists(scratch.path(gone))
    assert kept.count() == 7 and before.count() == 3
    Scratch.release(spark, mark)
    assert not os.path.exists(other.path(kept)) and before.count() == 3
    other.drop(before)
    with pytest.raises(Exception, match="(?i)not.*exist"):
        spark.read.parquet(other.path(before))


def test_the_pipeline_leaves_its_result_alone(spark, monkeypatch, tmp_path):
    import corpus_pipeline

    names = iter(range(1000))
    monkeypatch.setattr(
        "cellframe.llm.common.scratch_dir", lambda _, name: str(tmp_path / f"{next(names)}-{name}")
    )
    result = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = os.listdir(tmp_path)
    assert len(left) == 1 and left[0].endswith("pipeline-byte-level-BPE")
    assert result.count() > 0

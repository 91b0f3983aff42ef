from __future__ import annotations

import pytest

from tallyworks import registry
from tallyworks.ml import scoring, vectors


def test_a_failing_scoring_job_leaves_no_view(spark, sf_dir, tmp_path):
    def views():
        return {t.name for t in spark.catalog.listTables() if t.isTemporary}

    features = registry.ctr_rows(spark, sf_dir)
    rows, model = str(tmp_path / "rows"), str(tmp_path / "model")
    features.drop("has_video").write.parquet(rows)
    scoring.save(scoring.quick_ctr_model(vectors.labelled(features)), model, False)
    before = views()
    with pytest.raises(Exception, match="has_video"):
        scoring.score_ads(spark, model, rows, str(tmp_path / "scores"))
    assert views() == before

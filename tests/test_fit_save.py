"""MOD8: the delay pipeline reads stored columns (F11)."""

from tessera.operators import modeling as md
from tessera.plans import models


def test_delay_pipeline_reads_stored_columns(spark, sf, monkeypatch):
    """Before: a checkpoint of whole rows, computed twice and read whole by every fitted stage."""
    seen = []

    def watched(train, stages, path):
        seen.append(train.select("label")._jdf.queryExecution().executedPlan().toString())
        return fit(train, stages, path)

    fit = md.fit_save_pipeline
    monkeypatch.setattr(md, "fit_save_pipeline", watched)
    row = models.mod8(spark, sf).first()
    assert row["n"] > 0 and "parquet" in seen[0].lower() and "Existing" not in seen[0]

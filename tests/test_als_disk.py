"""MOD5: shuffle files of a factorisation (F3)."""

from tessera.operators import recsys


def test_als_drops_shuffle_files_of_past_iterations(spark, monkeypatch):
    """Before: a checkpoint every tenth iteration, so a fit of five kept the files of nearly all."""
    made = []

    class Watched(recsys.ALS):
        def fit(self, dataset, params=None):
            made.append(self.getCheckpointInterval())
            return super().fit(dataset, params)

    monkeypatch.setattr(recsys, "ALS", Watched)
    train = spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(12) for i in range(9)], "user_id int, item_id int, rating double")
    model = recsys.fit_als(train, 2.0, rank=2, max_iter=5)
    plain = recsys.fit_als(train, 2.0, rank=2, max_iter=5)
    assert made[0] < 5 and model.userFactors.count() == 12
    assert sorted(map(tuple, model.userFactors.collect())) == sorted(map(tuple, plain.userFactors.collect()))

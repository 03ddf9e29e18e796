import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from tessera.operators.encoders import OrdinalEncoder


def test_saved_encoder_marks_unseen_levels(spark, tmp_path):
    train = spark.createDataFrame([("b", 2), ("a", 1), ("b", None), (None, 10)], "c STRING, n INT")
    later = spark.createDataFrame([(1, "a", 10), (2, "b", 1), (3, "z", 99), (4, None, None), (5, "", 2)], "id INT, c STRING, n INT")
    encoder = OrdinalEncoder(inputCols=["c", "n"], outputCols=["c_ix", "n_ix"])
    model = Pipeline(stages=[encoder, VectorAssembler(inputCols=["c_ix", "n_ix"], outputCol="v")]).fit(train)
    model.write().overwrite().save(str(tmp_path / "model"))
    want = {1: (0, 1), 2: (1, 0), 3: (-1, -1), 4: (-1, -1), 5: (-1, 2)}  # numbers in text order: 1, 10, 2
    for m in (model, PipelineModel.load(str(tmp_path / "model"))):
        assert {r.id: (r.c_ix, r.n_ix) for r in m.transform(later).collect()} == want
        assert m.transform(later).where("id = 3").first().v.toArray().tolist() == [-1.0, -1.0]


def test_unfitted_encoder_is_saved_and_empty_tables_encode(spark, tmp_path):
    encoder = OrdinalEncoder(inputCols=["c"], outputCols=["ix"], maxLevels=2)
    encoder.save(str(tmp_path / "encoder"))
    again = OrdinalEncoder.load(str(tmp_path / "encoder"))
    assert again.getInputCols() == ["c"] and again.getOrDefault(again.maxLevels) == 2
    none = spark.createDataFrame([], "c STRING")
    assert [r.ix for r in again.fit(none).transform(spark.createDataFrame([("a",)], "c STRING")).collect()] == [-1]
    with pytest.raises(ValueError):
        again.fit(spark.createDataFrame([("a",), ("b",), ("c",)], "c STRING"))


@pytest.mark.parametrize("keep, unseen", [(True, 2), (False, -1)])
def test_unseen_levels_are_minus_one_or_an_extra_index(spark, tmp_path, keep, unseen):
    from tessera.operators.modeling import fit_save_pipeline, preprocessing_stages
    train = spark.createDataFrame([(1.0, "b"), (3.0, "a")], "x DOUBLE, c STRING")
    model = fit_save_pipeline(train, preprocessing_stages(train, ["x"], ["c"], keep_unseen=keep), str(tmp_path / "model"))
    later = spark.createDataFrame([(1.0, "a"), (1.0, "b"), (1.0, "z"), (1.0, None)], "x DOUBLE, c STRING")  # NULL is a level the fit did not see
    assert {r.c: r.c__ix for r in model.transform(later).collect()} == {"a": 0, "b": 1, "z": unseen, None: unseen}
    encoder = OrdinalEncoder(inputCols=["c"], outputCols=["ix"], keepUnseen=keep)
    assert {r.c: r.ix for r in encoder.fit(train).transform(later).collect()} == {"a": 0, "b": 1, "z": unseen, None: unseen}

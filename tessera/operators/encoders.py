"""Ordinal encoding as a pipeline stage that is saved and reloaded with its pipeline (FEA5, FEA7)."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.features import fit_levels


class _Columns(HasInputCols, HasOutputCols):
    keepUnseen = Param(Params._dummy(), "keepUnseen", "number unseen levels after the last one instead of -1", typeConverter=TypeConverters.toBoolean)

    def pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getInputCols(), self.getOutputCols(), strict=True))


class OrdinalEncoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers the levels of text columns in text order from 0; what the fit did not see, and NULL, is -1,
    or with ``keepUnseen`` the number after the last level.

    More than ``maxLevels`` levels raise an error; none is left out."""

    maxLevels = Param(Params._dummy(), "maxLevels", "most levels of a column", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, maxLevels=1000, keepUnseen=False):
        super().__init__()
        self._setDefault(maxLevels=1000, keepUnseen=False)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "OrdinalEncoderModel":
        most = self.getOrDefault(self.maxLevels)
        texts = dataset.select(*[F.col(c).cast("string").alias(c) for c in self.getInputCols()])
        return OrdinalEncoderModel(inputCols=self.getInputCols(), outputCols=self.getOutputCols(),
                                   levels=[fit_levels(texts, c, most) for c in self.getInputCols()],
                                   keepUnseen=self.getOrDefault(self.keepUnseen))


class OrdinalEncoderModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted encoder; its levels are a parameter, so it is saved as plain metadata."""

    levels = Param(Params._dummy(), "levels", "the levels of each column, in order", typeConverter=TypeConverters.toList)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, levels=None, keepUnseen=False):
        super().__init__()
        self._setDefault(keepUnseen=False)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = {}
        for (c, name), known in zip(self.pairs(), self.getOrDefault(self.levels), strict=True):
            place = F.array_position(F.lit(list(known)), F.col(c).cast("string")) - 1 if known else F.lit(-1)
            unseen = F.lit(len(known) if self.getOrDefault(self.keepUnseen) else -1)
            out[name] = F.when(place >= 0, place).otherwise(unseen).cast("int")
        return dataset.withColumns(out)

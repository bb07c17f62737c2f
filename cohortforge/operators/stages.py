"""Category encoder and scaler as Spark ML stages: fitted, saved and loaded inside a pipeline.

``fitOn`` is a SQL condition that says which rows a stage learns from (all if
it is not set); rows that it excludes are transformed all the same.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
    MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.operators.encode import NULL_TOKEN, apply_codes, code_table, load_codes, save_codes
from cohortforge.operators.profile import standardise_apply, standardise_fit
from cohortforge.session import checkpoint_dir

UNSEEN = ("code", "null", "error")


class _Columns(Params):
    cols = Param(Params._dummy(), "cols", "the columns to transform, in place", TypeConverters.toListString)
    fitOn = Param(Params._dummy(), "fitOn", "SQL condition on the rows to learn from; empty: all", TypeConverters.toString)

    def _rows(self, df: DataFrame) -> DataFrame:
        condition = self.getOrDefault(self.fitOn)
        return df.filter(condition) if condition else df


class _Encoding(_Columns):
    missing = Param(Params._dummy(), "missing", "the category of missing values", TypeConverters.toString)
    asText = Param(Params._dummy(), "asText", "cast the values to text first", TypeConverters.toBoolean)
    unseen = Param(Params._dummy(), "unseen", "values the encoder did not learn: code (the number after the last code), null, or error",
                   TypeConverters.toString)


class CategoryEncoder(Estimator, _Encoding, DefaultParamsWritable, DefaultParamsReadable):
    """Sorted 0-based codes of the values of each column."""

    @keyword_only
    def __init__(self, *, cols=None, fitOn="", missing=NULL_TOKEN, asText=False, unseen="code"):
        super().__init__()
        self._setDefault(fitOn="", missing=NULL_TOKEN, asText=False, unseen="code")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> CategoryEncoderModel:
        if self.getOrDefault(self.unseen) not in UNSEEN:
            raise ValueError(f"unseen must be one of {', '.join(UNSEEN)}")
        checkpoint_dir(df.sparkSession)
        table = code_table(self._rows(df), self.getOrDefault(self.cols), self.getOrDefault(self.missing), self.getOrDefault(self.asText), cut=True)
        return self._copyValues(CategoryEncoderModel(table.checkpoint(eager=True)))


class CategoryEncoderModel(Model, _Encoding, MLWritable, MLReadable):
    """``table``: the dictionary (column, value, code)."""

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self._setDefault(fitOn="", missing=NULL_TOKEN, asText=False, unseen="code")
        self.table = table

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, unseen = self.getOrDefault(self.cols), self.getOrDefault(self.unseen)
        out = apply_codes(df, self.table, cols, self.getOrDefault(self.missing), self.getOrDefault(self.asText), check_size=True)
        if unseen == "null":
            return out
        for c in cols:
            if unseen == "code":
                other = self.table.filter(F.col("column") == c).select(F.count(F.lit(1)).cast("int")).scalar()
            else:
                other = F.raise_error(F.lit(f"a value of {c} that the encoder did not learn")).cast("int")
            out = out.withColumn(c, F.coalesce(F.col(c), other))
        return out

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader()


class _EncoderWriter(MLWriter):
    def __init__(self, model: CategoryEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        save_codes(self.model.table, f"{path}/codes")


class _EncoderReader(MLReader):
    def load(self, path: str) -> CategoryEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryEncoderModel(load_codes(self.sparkSession, f"{path}/codes"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class ColumnScaler(Estimator, _Columns, DefaultParamsWritable, DefaultParamsReadable):
    """Mean 0 and population standard deviation 1 over the rows learned from; a constant column becomes 0."""

    @keyword_only
    def __init__(self, *, cols=None, fitOn=""):
        super().__init__()
        self._setDefault(fitOn="")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ColumnScalerModel:
        moments = standardise_fit(self._rows(df), self.getOrDefault(self.cols))
        return self._copyValues(ColumnScalerModel(moments=json.dumps(moments)))


class ColumnScalerModel(Model, _Columns, DefaultParamsWritable, DefaultParamsReadable):
    moments = Param(Params._dummy(), "moments", "mean and standard deviation by column, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, moments=None):
        super().__init__()
        self._setDefault(fitOn="")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return standardise_apply(df, json.loads(self.getOrDefault(self.moments)))

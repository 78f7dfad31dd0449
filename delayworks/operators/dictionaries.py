"""Categories of any number as stages of a fitted pipeline."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.operators.prep import fit_dictionary, index_by
from delayworks.sources.staging import scratch_path


class DictionaryIndexer(Transformer, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """Category numbers by a join with a stored dictionary, so that the values never meet on the driver.

    An unknown value gets the number after the last, as a string indexer that keeps unknown values gives it. A saved
    stage holds a copy of its dictionary.
    """

    path = Param(Params._dummy(), "path", "folder of the dictionary: value, index", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of values", TypeConverters.toInt)

    def dictionary(self, spark) -> DataFrame:
        return spark.read.schema("value string, index long").parquet(self.getOrDefault(self.path))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size, name = self.getOrDefault(self.size), self.getOutputCol()
        rows = index_by(dataset, self.dictionary(dataset.sparkSession), self.getInputCol(), name)
        number = F.coalesce(F.col(name), F.lit(size)).cast("double")
        nominal = {"ml_attr": {"type": "nominal", "name": name, "num_vals": size + 1}}
        return rows.withColumn(name, number).withMetadata(name, nominal)

    def write(self) -> MLWriter:
        return DictionaryWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DictionaryReader(cls)


class DictionaryWriter(MLWriter):
    def __init__(self, instance: DictionaryIndexer):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.dictionary(self.sparkSession).write.parquet(f"{path}/dictionary")


class DictionaryReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> DictionaryIndexer:
        stored = DefaultParamsReader(self.cls).load(path)
        return stored._set(path=f"{path}/dictionary")


def fit_indexer(train: DataFrame, column: str, output: str) -> DictionaryIndexer:
    """An indexer for every value that a column has in training."""
    path = scratch_path(train.sparkSession, "dictionary")
    fit_dictionary(train, column).write.parquet(path)
    return DictionaryIndexer()._set(inputCol=column, outputCol=output, path=path, size=train.sparkSession.read.parquet(path).count())

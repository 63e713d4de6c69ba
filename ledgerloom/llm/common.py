"""Helpers of the corpus operators."""

import os
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer(name: str) -> str:
    """Where a public vocabulary file is on the driver; LLM_TOKENIZERS names another folder."""
    folder = os.environ.get("LLM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def unused(docs: DataFrame, *names: str) -> list[str]:
    """Column names that a table does not have, made from these by underscores."""
    taken, found = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def by_value(module: str) -> None:
    """Ship a module's functions to the workers themselves, so that tasks need not import this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def array_udf(make: Callable[[], Callable[[pa.Array], pa.Array]], returns: str) -> Callable[..., Column]:
    """A column function from a factory that runs once per task and returns a function of Arrow arrays."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = make()
        for batch in batches:
            yield of(batch)

    return F.arrow_udf(run, returns)


def ship(spark: SparkSession, **data):
    """Broadcast plain values of a fixed size. What ``kept`` makes of them stays in the worker process between tasks."""
    return spark.sparkContext.broadcast(data)


def kept(shipped, make: Callable):
    value = shipped.value
    if make.__name__ not in value:
        value[make.__name__] = make(**value)
    return value[make.__name__]


def _pack():
    pack = zstandard.ZstdCompressor(level=1).compress
    return lambda texts: pa.array([pack(raw or b"") for raw in texts.cast(pa.binary()).to_pylist()], pa.binary())


def packed(text: Column) -> Column:
    """Texts compressed, for shuffles that move them whole; null counts as empty."""
    return array_udf(_pack, "binary")(text)


def unpacked(column: pa.Array) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(raw) for raw in column.to_pylist()]


by_value(__name__)

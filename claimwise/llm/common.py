"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwise.session import scratch_path

#: The white space that separates words, as characters and as a Java pattern.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

#: Rows of one Arrow batch.  Texts may be long, so batches are short: a Python worker holds
#: one batch at a time.
BATCH_ROWS = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a cut in the lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies on the driver, if it lies there on them too (a local master,
    a shared installation).  Elsewhere it is installed or shipped with ``--py-files`` as usual."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known and root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Arrow batches hold at most ``rows`` rows (only ever lowers the session's setting)."""
    importable(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def crc_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (the folds of the contracts; a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, as UTF-8 (both bytes methods know ASCII only, as wanted)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


LETTERS = re.compile(r"[^\W\d_]+")

"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import re
import tempfile
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_libc = ctypes.CDLL(None)

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_GAPS = " \t\n\x0b\x0c\r"


#: Bits of a filter for each of its ids, and the most that a filter has; more ids are met by a join.
BITS_AN_ID, FILTER_MOST = 16, 1 << 28


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Batches of at most 1,000 rows between Spark and Python: a row can hold a long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares; one of our own only on a local master, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that lost executors cost nothing of it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def give_back() -> None:
    """Returns memory that the work before has freed: Python workers live on and serve other operators."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def tidy(run):
    """run(batches), and then give_back."""

    def whole(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        yield from run(batches)
        give_back()

    return whole


def crc_text(col: Column | str) -> Column:
    """crc32 of an id written as decimal text."""
    return F.crc32(F.col(col).cast("string") if isinstance(col, str) else col.cast("string"))


def held_out(col: str, modulus: int, remainder: int) -> Column:
    """True for the rows that no model may learn from; rows without an id count as held out."""
    return F.coalesce(crc_text(col) % modulus == remainder, F.lit(True))


def chunks(items: list, size: int) -> Iterable[list]:
    for at in range(0, len(items), size):
        yield items[at : at + size]


def text_calls(rows: list[tuple], most: int = 1 << 18) -> Iterable[list[tuple]]:
    """Lists of rows (id, text) of about so many characters together, so that what is worked out at once stays small."""
    part: list[tuple] = []
    size = 0
    for row in rows:
        part.append(row)
        size += len(row[1])
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def planes(values: np.ndarray, size: int) -> bytes:
    """The bytes of little-endian numbers, first all of the lowest ones, and so on: small numbers then compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def from_planes(raw: bytes, size: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(size, n).T
    return out.view("<u8").ravel()


def labelled_docs(docs: DataFrame, labels: DataFrame, column: str, most: int, may_learn: Column | None = None) -> DataFrame:
    """doc_id, label and text of the documents of `most` ids labelled 0 and as many labelled 1 in a column, in the order of a hash of the id.

    Ids that are labelled both ways teach nothing; of rows that repeat an id the least text counts.
    """
    usable = labels.select("doc_id", F.col(column).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    if may_learn is not None:
        usable = usable.where(may_learn)
    usable = usable.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    ids = [usable.where(F.col("label") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for x in (0, 1)]
    chosen = F.broadcast(ids[0].unionByName(ids[1]))  # 2 * most rows at most
    found = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(chosen, "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, most: int, may_learn: Column | None = None) -> dict[int, list[str]]:
    """Whole texts of labelled_docs on the driver, by label."""
    out: dict[int, list[str]] = {0: [], 1: []}
    for r in labelled_docs(docs, labels, column, most, may_learn).orderBy("label", F.xxhash64("doc_id"), "doc_id").collect():
        out[r["label"]].append(r["text"])
    return out


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


class IdFilter:
    """A bit for the hash of each of some ids: spares work on rows that need none; those that need it always pass."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.size = bits, 64 * len(bits)

    @staticmethod
    def spot_of(col: str, size: int) -> Column:
        return F.pmod(F.xxhash64(F.col(col).cast("long")), F.lit(size))

    @staticmethod
    def of(ids: DataFrame) -> IdFilter | None:
        """Of the doc_id of ids; at most FILTER_MOST / 64 rows reach the driver. None if there are too many ids for that."""
        size = 1 << max(10, (BITS_AN_ID * ids.count() - 1).bit_length())
        if size > FILTER_MOST:
            return None
        spot = IdFilter.spot_of("doc_id", size)
        words = ids.select(F.floor(spot / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
        out = np.zeros(size // 64, np.uint64)
        out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
        return IdFilter(out)

    def passes(self, spot: pd.Series) -> np.ndarray:
        at = spot.to_numpy(np.int64)
        return (self.bits[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1


def likely_in(rows: DataFrame, ids: DataFrame, run, schema: str) -> DataFrame:
    """run(batches) over the rows (doc_id long, no null) whose doc_id is in ids, and a few others that a filter can't tell from them."""
    found = IdFilter.of(ids)
    if found is None:
        return rows.join(ids.select("doc_id").distinct(), "doc_id", "left_semi").select(*rows.columns).mapInPandas(tidy(run), schema)
    sent = rows.sparkSession.sparkContext.broadcast(found)  # FILTER_MOST bits at most
    names = rows.columns
    (spot,) = unused(rows, "spot")

    def filtered(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        yield from run(batch.loc[sent.value.passes(batch[spot]), names].reset_index(drop=True) for batch in batches)

    return rows.withColumn(spot, IdFilter.spot_of("doc_id", found.size)).mapInPandas(tidy(filtered), schema)


def split_by(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """docs with a boolean column of that name: false for rows whose doc_id certainly isn't in ids, so that only the others need a join."""
    found = IdFilter.of(ids)
    if found is None:
        return docs.withColumn(name, F.lit(True))
    sent = docs.sparkSession.sparkContext.broadcast(found)  # FILTER_MOST bits at most

    @F.pandas_udf("boolean")
    def test(spot: pd.Series) -> pd.Series:
        return pd.Series(sent.value.passes(spot))

    return docs.withColumn(name, test(IdFilter.spot_of("doc_id", found.size)))

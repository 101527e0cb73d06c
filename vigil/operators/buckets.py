"""Co-partitioned storage of records: bulk insert and dedupe that move the batch only (SNK-03, MNT-01, JON-03).

Records are a catalog table, bucketed and sorted by the whole record key.  A bulk load
is hashed into the same buckets and meets each bucket where it lies, and a
deduplication works inside buckets: neither shuffles the stored side.  Since the bucket follows
the whole key, an identifier that holds a third of all rows is spread by its secrets and sources.

``source_key`` stands for the source in the key: never null (records without a source have the
empty one, others start with ``=``), so plain equality, which buckets need, compares it right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.dedupe import one_per_key
from vigil.operators.protect import PROTECTED_COLUMNS

STORED_KEY = ("id_digest", "secret_digest", "source_key")

#: Records of one bucket in a table that is planned for ``records`` of them.
BUCKET_RECORDS = 1_500_000


def buckets_for(records: int) -> int:
    """A power of two, so that a table can be rewritten into twice as many by splitting each."""
    return 1 << max(0, -(-records // BUCKET_RECORDS) - 1).bit_length()


def _keyed(records: DataFrame) -> DataFrame:
    return records.withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))


def bucket_number(spark: SparkSession, name: str) -> int:
    """The number of buckets that the catalog gives for a table."""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if row["col_name"] == "Num Buckets":
            return int(row["data_type"])
    raise ValueError(f"{name} is not bucketed")


def _append(rows: DataFrame, name: str, buckets: int, **options: str) -> None:
    columns = [*PROTECTED_COLUMNS, "source_key"]
    w = rows.select(*columns).write.format("parquet").option("compression", "zstd").options(**options)
    w.mode("append").bucketBy(buckets, *STORED_KEY).sortBy(*STORED_KEY).saveAsTable(name)


def create_bucketed(records: DataFrame, name: str, path: str, buckets: int) -> None:
    """A new external table of ``records``, each key once, a file per bucket."""
    if records.sparkSession.catalog.tableExists(name):
        raise ValueError(f"table {name} is already there")
    _append(_keyed(one_per_key(records)).repartition(buckets, *STORED_KEY), name, buckets, path=path)


def absent(batch: DataFrame, name: str) -> DataFrame:
    """Records of ``batch``, each key once, that the table does not hold.

    Repeats collapse before they move; then the batch is hashed into the table's buckets.
    """
    fresh = _keyed(one_per_key(batch))
    stored = batch.sparkSession.table(name).select(*STORED_KEY)
    return fresh.join(stored.hint("merge"), list(STORED_KEY), "left_anti")


def append_records(records: DataFrame, name: str) -> None:
    """Add ``records`` as they are; ``distinct_records`` then counts what repeats."""
    buckets = bucket_number(records.sparkSession, name)
    _append(_keyed(records).repartition(buckets, *STORED_KEY), name, buckets)


def insert_bulk(batch: DataFrame, name: str) -> None:
    """Insert if absent.  A load that died is simply repeated: what it has added is found."""
    _append(absent(batch, name), name, bucket_number(batch.sparkSession, name))


def distinct_records(spark: SparkSession, name: str) -> DataFrame:
    """The table's records, each key once, with ``copies``, found bucket by bucket."""
    rows = one_per_key(spark.table(name), F.count(F.lit(1)).alias("copies"), within=["source_key"])
    return rows.select(*PROTECTED_COLUMNS, "copies")

"""Catalogue tables: existence, creation, staged replacement, JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import latest_by
from ..operators.warehouse import upsert, with_next_ids
from ..session import durable

BUCKET = "key_bucket"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_table(spark: SparkSession, name: str, schema: str,
                 partition_by: Sequence[str] = (), buckets: int = 0) -> DataFrame:
    """Create the table if it is missing; return it. With ``buckets`` it is partitioned by
    a hash of the upsert key, in the column ``BUCKET``, so that an upsert touches few files."""
    if not table_exists(spark, name):
        if buckets:
            schema, partition_by = f"{schema}, {BUCKET} INT", [BUCKET]
        writer = spark.createDataFrame([], schema).write.format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(name)
        if buckets:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{BUCKET}' = '{buckets}')")
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _delete(spark: SparkSession, folder: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the table's own, for its next version."""
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{root}/_versions/{name.replace('.', '/')}/{uuid.uuid4().hex}"


def swap_table(spark: SparkSession, live: str, staged: str) -> None:
    """Put the rows of ``staged`` in the place of ``live`` and drop ``staged``.

    The rows are written as the next version of ``live``, which one change of its location
    makes current; at no moment is there no live table, and ``staged`` is dropped last.
    """
    replace_table(spark, live, spark.table(staged))
    drop_table(spark, staged)


def replace_table(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Replace the table's rows; ``rows`` may read the table itself.

    They are written to a folder of their own. Then the table, or each of its partitions,
    is pointed there, and only then is the old folder deleted: a job that ends anywhere
    leaves the table with its old rows or the new ones (partition by partition), and can be
    run again. Partition columns stay.
    """
    by = partition_columns(spark, name)
    if by:
        _replace_partitions(spark, name, rows, by, every=True)
        return
    folder, old = _fresh_folder(spark, name), table_location(spark, name)
    rows.select(*spark.table(name).columns).write.parquet(folder)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    _delete(spark, old)


def _replace_partitions(spark: SparkSession, name: str, rows: DataFrame, by: Sequence[str],
                        every: bool) -> None:
    """Point the partitions that ``rows`` has to its rows; with ``every`` drop the others.
    The driver handles partition values only."""
    folder = _fresh_folder(spark, name)
    rows.select(*spark.table(name).columns).write.partitionBy(*by).parquet(folder)
    written = spark.read.schema(spark.table(name).schema).parquet(folder).select(*by).distinct().collect()
    new = {"/".join(f"{c}={r[c]}" for c in by) for r in written}
    old = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}

    def spec(partition: str) -> str:
        return ", ".join("{}='{}'".format(*part.split("=", 1)) for part in partition.split("/"))

    gone = []
    for partition in sorted(new):
        if partition in old:
            described = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({spec(partition)})")
            gone += [r["data_type"] for r in described.where("col_name = 'Location'").tail(1)]
            spark.sql(f"ALTER TABLE {name} PARTITION ({spec(partition)}) SET LOCATION '{folder}/{partition}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD PARTITION ({spec(partition)}) LOCATION '{folder}/{partition}'")
    for partition in sorted(old - new) if every else []:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec(partition)})")
    spark.catalog.refreshTable(name)
    for place in gone:
        if not place.startswith(folder):
            _delete(spark, place)


def upsert_table(spark: SparkSession, name: str, source: DataFrame, key: Sequence[str],
                 newest_first: Sequence[Column] = ()) -> None:
    """Put ``source`` into the table by key. The incoming rows are read more than once, so
    they are made durable first.

    Of a table made with ``buckets`` only the buckets that ``source`` has keys in are read
    and rewritten; of any other, all rows are.
    """
    incoming = latest_by(source, key, newest_first) if newest_first else source
    target = spark.table(name)
    if BUCKET not in target.columns:
        replace_table(spark, name, upsert(target, durable(incoming), key))
        return
    count = _buckets(spark, name)
    incoming = durable(incoming.withColumn(BUCKET, _bucket(key, count)))
    touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]  # ``count`` at most
    part = target.where(F.col(BUCKET).isin(touched))
    _replace_partitions(spark, name, upsert(part, incoming, key), [BUCKET], every=False)


def _bucket(key: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in key]), F.lit(count)).cast("int")


def _buckets(spark: SparkSession, name: str) -> int:
    return int(spark.sql(f"SHOW TBLPROPERTIES {name} ('{BUCKET}')").first()["value"])


def append_table(spark: SparkSession, name: str, rows: DataFrame, id_col: str,
                 key: Sequence[str], run: Column | None = None) -> None:
    """Add rows under ids that follow the largest stored one. With ``run``, a condition that
    holds for the rows of this run only, nothing is added where such rows are stored: a job
    that is run again for its hour adds them once."""
    target = spark.table(name)
    if run is not None and target.where(run).take(1):
        return
    numbered = with_next_ids(rows, target, id_col, key)
    numbered.select(*target.columns).write.insertInto(name)


def expire_table(spark: SparkSession, name: str, cutoff: str,
                 bucket: str = "yymmddhh") -> list[str]:
    """Drop the hours up to and with the cutoff from a table partitioned by hour.
    Looks at partition names only; no row is read or written."""
    named = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    gone = sorted(p.split("=", 1)[1] for p in named if p.split("=", 1)[1] <= cutoff)
    for hour in gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({bucket} = '{hour}')")
    return gone


def row_count(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition).agg(F.count(F.lit(1)).alias("n"))


# ---- JDBC (needs the store's driver on the class path)

def jdbc_options(url: str, table: str, column: str | None = None, lower: int | None = None,
                 upper: int | None = None, parts: int | None = None,
                 fetch: int = 3000) -> dict[str, str]:
    """Reader options; with a numeric column the read is split into ``parts``."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch)}
    if column is not None:
        if None in (lower, upper, parts):
            raise ValueError("a split read needs lower, upper and parts")
        options |= {"partitionColumn": column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(parts)}
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **split: object) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **split)).load()


def write_jdbc(df: DataFrame, url: str, table: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table).mode("append").save()

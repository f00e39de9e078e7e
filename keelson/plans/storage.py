"""Queries: sources and sinks. Tables are written to the shared folder and read back."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from keelson.operators.features import build
from keelson.plans.common import CUSTOMERS_SQL, V1, customers, table
from keelson.presets import CSV_NULL_TOKENS
from keelson.session import shared_path
from keelson.sources import csv as C
from keelson.sources import tables as S
from keelson.spec import FeatureSource

ARCHIVE_KEYS = 1_000  # keys per archive


def csv_files(spark, d):
    """Customers written as CSV by many tasks and read back with declared types."""
    rows = table(spark, d, "customer")
    path = shared_path(spark, "customer-csv")
    rows.write.option("header", True).csv(path)
    return C.require_rows(C.read_csv(spark, path, rows.schema, CSV_NULL_TOKENS))


CSV_SQL = "SELECT * FROM customer"


def csv_archives(spark, d):
    """Customers written by key range as zip archives of one CSV into a folder, and read from there."""
    rows = table(spark, d, "customer")
    names, folder = rows.columns, shared_path(spark, "archives")

    def write(key, pdf):
        import pandas as pd
        from pyarrow import fs

        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("part.csv", pdf[names].to_csv(index=False))
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path)
        with store.open_output_stream(f"{path}/archive-{key[0]}.zip") as f:
            f.write(buffer.getvalue())
        return pd.DataFrame({"archive": [f"archive-{key[0]}.zip"]})

    part = F.floor(F.col("c_custkey") / ARCHIVE_KEYS).alias("part")
    rows.groupBy(part).applyInPandas(write, "archive string").agg(F.count("archive")).collect()
    found = C.require_archives(C.read_archives(spark, folder, rows.schema, CSV_NULL_TOKENS))
    return found.withColumn("_source", F.element_at(F.split("_source", "/"), -1)).drop("_line")


ARCHIVES_SQL = "SELECT *, 'archive-' || (c_custkey // 1000) || '.zip' AS _source FROM customer"


def parquet_layout(spark, d):
    """Orders written with the rows of a customer together, read through a declared feature source."""
    path = shared_path(spark, "orders")
    S.write_table(table(spark, d, "orders"), path, "o_custkey", "o_orderdate")
    return FeatureSource(path, "o_orderdate", "o_orderkey").frame(spark)


PARQUET_SQL = "SELECT * FROM orders"


def partitioned_table(spark, d):
    """Orders stored by status; a status filter reads one folder."""
    path = shared_path(spark, "orders-by-status")
    S.write_table(table(spark, d, "orders"), path, "o_custkey", partition_by=["o_orderstatus"])
    return S.read_table(spark, path).where(F.col("o_orderstatus") == "F").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


PARTITIONED_SQL = "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"


def json_rows(spark, d):
    """Every supplier as a JSON document, written and parsed again."""
    rows = table(spark, d, "supplier")
    return S.as_document(rows).select(F.from_json("document", rows.schema).alias("r")).select("r.*")


JSON_SQL = "SELECT * FROM supplier"


def manifest_document(spark, d):
    """A feature manifest stored as one JSON document and loaded."""
    made = build(customers(spark, d), V1).manifest()
    path = shared_path(spark, "manifest")
    S.write_json_document(made, path)
    loaded = S.read_json_document(spark, path, made.schema)
    return loaded.select("feature_version", "row_count", "entity_count", "missing_feature_values", F.size("features").alias("feature_count"))


MANIFEST_SQL = f"""WITH {CUSTOMERS_SQL}
SELECT 'v1' AS feature_version, count(*) AS row_count, count(DISTINCT c_custkey) AS entity_count,
  sum((balance IS NULL)::INT + (segment IS NULL)::INT)::BIGINT AS missing_feature_values, 6 AS feature_count FROM customers"""


def report_file(spark, d):
    """An aggregate report stored as one CSV file and loaded with its types."""
    report = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_extendedprice").alias("top"))
    path = shared_path(spark, "report")
    S.write_csv_report(report, path)
    return S.read_csv_report(spark, path, report.schema)


REPORT_SQL = "SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_extendedprice) AS top FROM lineitem GROUP BY 1, 2"


QUERIES = {
    "csv_files": (csv_files, CSV_SQL),
    "csv_archives": (csv_archives, ARCHIVES_SQL),
    "parquet_layout": (parquet_layout, PARQUET_SQL),
    "partitioned_table": (partitioned_table, PARTITIONED_SQL),
    "json_rows": (json_rows, JSON_SQL),
    "manifest_document": (manifest_document, MANIFEST_SQL),
    "report_file": (report_file, REPORT_SQL),
}

"""CSV sources: separator detection, optional header, fully empty rows dropped."""

from __future__ import annotations

import csv
import urllib.request
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuegrid.schema import VENUES
from venuegrid.sources.tables import shared_folder


def download(url: str) -> bytes:
    """A file from the web; gives up after 30 seconds."""
    with urllib.request.urlopen(url, timeout=30) as answer:
        return answer.read()


def detect_separator(spark: SparkSession, path: str, header: bool = True) -> str:
    """The delimiter of the first line (of up to 50 lines without a header); ``;`` if none can be told."""
    sample = "\n".join(r[0] for r in spark.read.text(path).limit(1 if header else 50).collect())
    try:
        return csv.Sniffer().sniff(sample).delimiter if sample else ";"
    except csv.Error:
        return ";"


def read_csv(spark: SparkSession, path: str, separator: str = "auto", header: bool = True, get: Callable[[str], bytes] = download) -> DataFrame:
    """A CSV file, folder or http(s) url as strings; headerless columns are ``column_1`` and so on.

    What a url gives is put into the shared folder first, as executors have to reach it. A blank path raises ValueError, a missing one FileNotFoundError. Short rows are padded, long ones cut, rows
    of nothing but nulls dropped; an empty file gives an empty frame.
    """
    if not path or not path.strip():
        raise ValueError("no source given")
    if path.startswith(("http://", "https://")):
        at = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
        spark.createDataFrame([(get(path).decode().rstrip("\n"),)], "value string").coalesce(1).write.text(at)
        path = at
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        raise FileNotFoundError(path)
    if spark.read.text(path).isEmpty():
        return spark.createDataFrame([], T.StructType([]))
    sep = detect_separator(spark, path, header) if separator == "auto" else separator
    rows = spark.read.csv(path, sep=sep, header=header, mode="PERMISSIVE")
    if not header:
        rows = rows.toDF(*(f"column_{i + 1}" for i in range(len(rows.columns))))
    return rows.dropna(how="all")


def read_venues(spark: SparkSession, path: str) -> DataFrame:
    """Venue list with the columns type_lieu, identifiant, nom, url; missing ones are null."""
    rows = read_csv(spark, path)
    return rows.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast("string").alias(f.name) for f in VENUES if f.name in ("identifiant", "nom", "type_lieu", "url")))


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """``url`` and ``ground_truth_osm`` of an evaluation file, as it stands: a space before a quote makes the quotes data."""
    return read_csv(spark, path, ";").select("url", "ground_truth_osm")


def convert_file(spark: SparkSession, path: str) -> DataFrame:
    """Schedule documents of JSON files, each one document or a list: ``identifiant`` and ``osm`` (period to notation).

    A document without an identifier is ``single_item``, in a list ``item_`` and its place.
    """
    from venuegrid.functions import documents

    raw = spark.read.text(path, wholetext=True).select(F.trim("value").alias("value"))
    listed = F.from_json("value", "array<string>")
    many = raw.where(F.col("value").startswith("[")).select(F.posexplode(listed).alias("i", "document"))
    each = many.unionByName(raw.where(~F.col("value").startswith("[")).select(F.lit(None).cast("int").alias("i"), F.col("value").alias("document")))
    said = F.get_json_object("document", "$.horaires_ouverture.metadata.identifiant")
    return each.select(F.coalesce(said, F.concat(F.lit("item_"), F.col("i").cast("string")), F.lit("single_item")).alias("identifiant"), documents.to_osm(F.col("document")).alias("osm"))

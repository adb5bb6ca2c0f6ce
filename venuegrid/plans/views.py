"""Venue-like views over the star-schema tables, shared by queries and their SQL.

results: one row per event; venues: customers; executions: orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The same two views for the SQL side.
RESULTS_SQL = """
results AS (
  SELECT event_id AS id_resultats_extraction, CAST(user_id AS VARCHAR) AS lieu_id, event_id % 3 AS id_execution,
    CASE event_type WHEN 'error' THEN 'erreur' WHEN 'signup' THEN '' ELSE 'ok' END AS statut_url,
    CASE WHEN value < 50 THEN 0 WHEN value < 100 THEN 404 WHEN value < 150 THEN 500 ELSE 200 END AS code_http,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE repeat(props, 1 + CAST(event_id % 4 AS INTEGER)) END AS markdown_brut,
    CASE WHEN event_id % 5 = 0 THEN '' ELSE props END AS markdown_nettoye,
    CASE WHEN event_id % 4 = 0 THEN '' ELSE substr(props, 1, 5) END AS markdown_filtre,
    value / 1000 AS llm_consommation_requete,
    CASE WHEN event_id % 6 = 0 THEN '' WHEN event_id % 7 = 0 THEN 'ERREUR LLM: delai' ELSE props END AS llm_horaires_json,
    CASE WHEN event_id % 6 = 0 THEN '' WHEN event_id % 7 = 0 THEN 'Erreur Conversion OSM' WHEN event_id % 13 = 0 THEN '' ELSE 'Mo-Fr 09:00-12:00' END AS llm_horaires_osm,
    CASE WHEN event_type = 'view' THEN TRUE WHEN event_type = 'click' THEN FALSE END AS horaires_identiques,
    ts
  FROM events),
venues AS (
  SELECT CAST(c_custkey AS VARCHAR) AS identifiant, c_name AS nom, c_mktsegment AS type_lieu,
    CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'Mo-Fr 09:00-12:00' END AS horaires_data_gl FROM customer)"""


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def results(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    k, props = F.col("event_id"), F.col("props")
    return e.select(
        k.alias("id_resultats_extraction"),
        F.col("user_id").cast("string").alias("lieu_id"),
        (k % 3).alias("id_execution"),
        F.when(F.col("event_type") == "error", "erreur").when(F.col("event_type") == "signup", "").otherwise("ok").alias("statut_url"),
        F.when(F.col("value") < 50, 0).when(F.col("value") < 100, 404).when(F.col("value") < 150, 500).otherwise(200).alias("code_http"),
        F.when(k % 11 != 0, F.repeat(props, (k % 4 + 1).cast("int"))).alias("markdown_brut"),
        F.when(k % 5 == 0, "").otherwise(props).alias("markdown_nettoye"),
        F.when(k % 4 == 0, "").otherwise(F.substring(props, 1, 5)).alias("markdown_filtre"),
        (F.col("value") / 1000).alias("llm_consommation_requete"),
        F.when(k % 6 == 0, "").when(k % 7 == 0, "ERREUR LLM: delai").otherwise(props).alias("llm_horaires_json"),
        F.when(k % 6 == 0, "").when(k % 7 == 0, "Erreur Conversion OSM").when(k % 13 == 0, "").otherwise("Mo-Fr 09:00-12:00").alias("llm_horaires_osm"),
        F.when(F.col("event_type") == "view", True).when(F.col("event_type") == "click", False).alias("horaires_identiques"),
        "ts",
    )


def venues(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("identifiant"), F.col("c_name").alias("nom"), F.col("c_mktsegment").alias("type_lieu"), F.when(F.col("c_custkey") % 9 == 0, "").otherwise("Mo-Fr 09:00-12:00").alias("horaires_data_gl")
    )

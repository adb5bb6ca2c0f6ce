"""Schemas of the three state tables and of the typed schedule."""

from __future__ import annotations

from pyspark.sql import types as T

VENUES = T.StructType([T.StructField("identifiant", T.StringType(), False), *(T.StructField(n, T.StringType()) for n in ("nom", "type_lieu", "url", "horaires_data_gl", "horaires_data_gl_json"))])
EXECUTIONS = T.StructType(
    [
        T.StructField("id_execution", T.LongType(), False),
        T.StructField("date_execution", T.TimestampNTZType(), False),
        *(T.StructField(n, T.StringType()) for n in ("llm_modele", "llm_fournisseur", "llm_url")),
        T.StructField("llm_consommation_execution", T.DoubleType()),
    ]
)
RESULTS = T.StructType(
    [
        T.StructField("id_resultats_extraction", T.LongType(), False),
        T.StructField("lieu_id", T.StringType()),
        T.StructField("id_execution", T.LongType()),
        T.StructField("statut_url", T.StringType()),
        T.StructField("code_http", T.IntegerType()),
        *(T.StructField(n, T.StringType()) for n in ("message_url", "markdown_brut", "markdown_nettoye", "markdown_filtre", "prompt_message")),
        T.StructField("llm_consommation_requete", T.DoubleType()),
        T.StructField("llm_horaires_json", T.StringType()),
        T.StructField("llm_horaires_osm", T.StringType()),
        T.StructField("horaires_identiques", T.BooleanType()),
        T.StructField("differences_horaires", T.StringType()),
        T.StructField("erreurs_pipeline", T.StringType()),
    ]
)
TABLES = {"lieux": VENUES, "executions": EXECUTIONS, "resultats_extraction": RESULTS}
#: The column by which a table is cut into parts.
PARTS = {"resultats_extraction": "id_execution", "statistiques": "id_execution"}
#: A day: whether a source gave it, whether it is open, and its slots in order.
SLOT = "struct<debut: string, fin: string, occurence: array<int>>"
DAY = f"struct<source_found: boolean, ouvert: boolean, creneaux: array<{SLOT}>>"

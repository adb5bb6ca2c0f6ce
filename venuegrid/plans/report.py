"""The report: classified rows, counts, and an HTML page from small aggregates."""

from __future__ import annotations

from html import escape
from string import Template

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuegrid.functions import text
from venuegrid.operators import state, stats

PAGE = Template("<!DOCTYPE html><html lang='fr'><head><meta charset='utf-8'><title>$title</title></head><body><h1>$title</h1><p>$total</p><table>$rows</table>$groups</body></html>")
#: Rows of a page of the full report, what they show, and kinds that the summary lists, the commonest first.
SHOWN, KINDS = 200, 50
SHOWN_COLUMNS = ["identifiant", "nom", "type_lieu", "url", "code_http", "message", "comparaison_horaires", "apercu_horaires", "apercu_differences", "erreurs_resume"]
BEFORE, BETWEEN, AFTER = "<!DOCTYPE html><html lang='fr'><head><meta charset='utf-8'><title>", "</title></head><body><h1>", "</table></body></html>"
# Columns of a report row, by the name they have in the tables, and messages of statuses.
COLUMNS = {
    "type_lieu": "type_lieu", "identifiant": "identifiant", "nom": "nom", "url": "url", "horaires_data_gl": "horaires_data_gl", "statut": "statut_url", "message": "message_url", "markdown_brut": "markdown_brut",
    "markdown_nettoye": "markdown_nettoye", "markdown_filtre": "markdown_filtre", "llm_horaires_json": "llm_horaires_json", "llm_horaires_osm": "llm_horaires_osm", "code_http": "code_http",
    "horaires_identiques": "horaires_identiques", "differences_horaires": "differences_horaires", "erreurs_pipeline": "erreurs_pipeline", "llm_consommation_requete": "llm_consommation_requete",
}
NO_ACCESS, NO_EXTRACTION, NO_COMPARISON = "Accès impossible", "Extraction échouée", "Comparaison impossible"


def reported(results: DataFrame, venues: DataFrame) -> DataFrame:
    """Results with their venue and report status, in venue order."""
    return state.with_venue(results, venues).withColumn("status", stats.report_status()).orderBy("identifiant", state.ID)


def message(status: Column, said: Column, errors: Column) -> Column:
    """What a row's message says more of its error, by status: the first error, or a stand-in, where the message is silent."""
    silent = F.coalesce(said, F.lit("")).isin("", "-")
    chain = F.coalesce(errors, F.lit(""))
    first = F.substring_index(chain, " | ", 1)
    access = F.when(~silent, said).when(chain != "", F.substring_index(chain, "\n", 1)).otherwise(NO_ACCESS)
    told = (chain != "") & ~F.coalesce(said, F.lit("")).startswith("Erreur")
    extraction = F.when(told, F.when((first != "") & (F.length(first) < 100), first).otherwise(NO_EXTRACTION)).when(silent, NO_EXTRACTION).otherwise(said)
    return F.when(status == "access_error", access).when(status == "extraction_error", extraction).when((status == "compare_error") & silent, NO_COMPARISON).otherwise(said)


def grams(kilograms: Column) -> Column:
    """Emissions for display."""
    return kilograms * 1000


def comparison_label(identical: Column, differences: Column, errors: Column | None = None) -> Column:
    """What the report says of a comparison; of one that was not made its errors' summary, else its differences text."""
    told = F.coalesce(differences, F.lit(""))
    summary = F.coalesce(F.lit("") if errors is None else errors, F.lit(""))
    missing = F.when(summary != "", F.concat(F.lit("Non comparé - "), summary)).when(told != "", told).otherwise("Non comparé")
    return F.when(identical.isNull(), missing).when(identical, "IDENTIQUE - Aucune différence détectée").otherwise(F.concat(F.lit("DIFFÉRENT - "), told))


def rows(results: DataFrame, venues: DataFrame) -> DataFrame:
    """The report table: the columns of a report row, its status, place, enriched message, error summary, payload and previews."""
    found = state.with_venue(results, venues).withColumn("status", stats.report_status())
    place = F.array_position(F.array(*map(F.lit, stats.STATUS_ORDER)), F.col("status")).cast("int")
    errors = state.error_summary(F.col("erreurs_pipeline"))
    known = {c: F.col(of) for c, of in COLUMNS.items()}
    known["llm_consommation_requete"] = grams(F.col("llm_consommation_requete"))
    known["message"] = message(F.col("status"), F.col("message_url"), F.col("erreurs_pipeline"))
    return found.select(
        *(c.alias(name) for name, c in known.items()), "status", place.alias("place"), errors["errors"].alias("nombre_erreurs"), errors["summary"].alias("erreurs_resume"),
        comparison_label(F.col("horaires_identiques"), F.col("differences_horaires"), errors["summary"]).alias("comparaison_horaires"),
        text.payload(F.col("llm_horaires_json")).alias("horaires_base64"), text.preview(F.col("llm_horaires_osm"), 60).alias("apercu_horaires"), text.preview(F.col("differences_horaires"), 80).alias("apercu_differences"),
    )


def groups(report: DataFrame) -> DataFrame:
    """The report table by status in display order and venue: its groups with their rows, however many those are."""
    return report.orderBy("place", "identifiant")


def pages(report: DataFrame, size: int = SHOWN) -> DataFrame:
    """The whole report as pages of at most ``size`` rows: status, place, page (from 1 in each status), pages, n, html.

    Rows are numbered in display order by many tasks; a page is put together from its own rows alone, so no row is left
    out, however many a status has.
    """
    numbered = state.number_from(report.select("status", "place", *SHOWN_COLUMNS), 0, ["place", "identifiant", *SHOWN_COLUMNS[1:]], "row")
    firsts = numbered.groupBy(F.col("status").alias("of")).agg(F.min("row").alias("first"), F.count("*").alias("of_status"))  # a row per status
    at = numbered.join(F.broadcast(firsts), F.col("status") == F.col("of")).withColumn("page", F.floor((F.col("row") - F.col("first")) / size) + 1)
    cells = F.concat(F.lit("<tr>"), *(F.concat(F.lit("<td>"), escaped(F.col(c)), F.lit("</td>")) for c in SHOWN_COLUMNS), F.lit("</tr>"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", cells.alias("cells")))), lambda r: r["cells"]), "\n")
    found = at.groupBy("status", "place", "page", F.ceil(F.col("of_status") / size).alias("pages")).agg(F.count("*").alias("n"), listed.alias("body"))
    names = F.create_map(*(F.lit(x) for p in stats.STATUS_NAMES.items() for x in p))
    head = "<tr>" + "".join(f"<th>{escape(c)}</th>" for c in SHOWN_COLUMNS) + "</tr>\n"
    title = F.concat(names[F.col("status")], F.lit(" "), F.col("page").cast("string"), F.lit("/"), F.col("pages").cast("string"))
    html = F.concat(F.lit(BEFORE), title, F.lit(BETWEEN), title, F.lit("</h1><table>" + head), F.col("body"), F.lit(AFTER))
    return found.select("status", "place", "page", "pages", "n", html.alias("html"))


def escaped(value: Column) -> Column:
    """Text for a page: nulls are empty, what marks up is spelt out."""
    out = F.coalesce(value.cast("string"), F.lit(""))
    for mark, said in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(mark), F.lit(said))
    return out


def write_report(results: DataFrame, venues: DataFrame, folder: str, title: str = "Rapport", size: int = SHOWN) -> str:
    """Write the full report below ``folder``, a text file a page by status and page, and give back the summary page."""
    table = rows(results, venues)
    pages(table, size).select("status", "page", "html").write.partitionBy("status", "page").mode("overwrite").text(folder)
    return render(results, venues, title, folder, size)


def render(results: DataFrame, venues: DataFrame, title: str = "Rapport", folder: str | None = None, size: int = SHOWN) -> str:
    """The summary page: counts by status, venue type and HTTP code, with links to the pages of the full report if it has a folder."""
    table = rows(results, venues)
    line = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    counts = sorted(stats.status_counts(table).collect(), key=lambda r: r["place"])
    links = lambda r: f"<a href='{escape(folder)}/status={r['status']}'>{-(-r['n'] // size)} pages</a>" if folder else ""
    by_status = "".join(line(escape(stats.STATUS_NAMES[r["status"]]), r["n"], f"{r['share']} %", links(r)) for r in counts)
    small = lambda key: table.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(KINDS).collect()
    by_kind = "".join(f"<h2>{label}</h2><table>{''.join(line(escape(str(r[0])), r['n']) for r in small(key))}</table>" for key, label in (("type_lieu", "Types de lieu"), ("code_http", "Codes HTTP")))
    return PAGE.substitute(title=escape(title), total=sum(r["n"] for r in counts), rows=by_status, groups=by_kind)

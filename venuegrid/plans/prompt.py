"""The messages sent to a model, as one Column expression; a caller can bring its own texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Texts:
    """Texts of the two messages; ``{year}``, ``{kind}``, ``{name}``, ``{text}`` and ``{schema}`` are places to fill."""

    system: str = """Tu lis la page d'un établissement et tu en tires un document JSON de ses horaires.

Jours : sept par période, de lundi à dimanche. Un jour dont la page ne dit rien porte "source_found": false. Un jour fermé porte "ouvert": false et aucun créneau.
Créneaux : "debut" et "fin" au format HH:MM. "occurence" liste les rangs dans le mois, par exemple [1, 3] pour le premier et le troisième, -1 pour le dernier.
Dates : AAAA-MM-JJ, sous "horaires_specifiques" de "jours_feries" ou de "jours_speciaux", avec "ferme", "ouvert" ou des créneaux. Une date sans année est de {year}.
Périodes : ce qui vaut toute l'année va sous "hors_vacances_scolaires" ; les vacances ne sont remplies que si la page les nomme.
Plusieurs établissements sur la page : ne garder que celui dont le nom et le type sont donnés, sans emprunter aux autres. Deux versions du même : la plus détaillée.
Aucun horaire : le document avec "source_found": false partout.

La réponse est ce document, et rien d'autre.
"""
    asked: str = "Établissement : {name}\nType : {kind}\n\nPage :\n<<<\n{text}\n>>>\n"
    with_schema: str = "\nLe document suit ce schéma :\n{schema}\n"
    without_schema: str = "\nLe document a cinq périodes, comme décrit."
    no_name: str = "Non renseigné"
    no_text: str = "Aucun contenu disponible"


def _filled(template: str, **values: Column) -> Column:
    """The template with its named places filled, in their order; what a value holds is not filled again."""
    parts, rest = [], template
    for name, value in values.items():
        before, rest = rest.split("{" + name + "}")
        parts += [F.lit(before), value]
    return F.concat(*parts, F.lit(rest))


def prompt(kind: Column, name: Column, text: Column, year: Column, schema: str | None = None, texts: Texts | None = None) -> Column:
    """A JSON list of the system and the user message for a venue's text; a null name or text has a stated stand-in."""
    said = texts or Texts()
    system = _filled(said.system, year=year.cast("string"))
    asked = _filled(said.asked, name=F.coalesce(name, F.lit(said.no_name)), kind=F.coalesce(kind, F.lit("")), text=F.coalesce(text, F.lit(said.no_text)))
    user = F.concat(asked, F.lit(said.without_schema if not schema else said.with_schema.replace("{schema}", schema)))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.to_json(F.array(message("system", system), message("user", user)))

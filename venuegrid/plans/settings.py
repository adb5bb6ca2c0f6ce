"""Settings of a run and what is wrong with them, all at once."""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import urlparse

PROVIDERS = ["OPENAI", "MISTRAL", "LOCAL"]


def chosen(env: dict[str, str], purpose: str) -> str | None:
    """The first of PROVIDERS for which a key is set (``<purpose>_API_KEY_<provider>``), else a local model (``<purpose>_MODEL_LOCAL``)."""
    for name in PROVIDERS[:2]:
        if env.get(f"{purpose}_API_KEY_{name}"):
            return name
    return "LOCAL" if env.get(f"{purpose}_MODEL_LOCAL") else None


@dataclass
class Settings:
    """What a run needs to know."""

    csv_url: str = ""
    references: dict[str, str] = field(default_factory=dict)
    llm_provider: str | None = None
    llm_base_url: str = ""
    llm_timeout: int = 30
    embedding_provider: str | None = None
    phrases: list[str] = field(default_factory=list)
    threshold: float = 0.0
    chunk_size: int = 100
    chunk_overlap: int = 15
    min_content_length: int = 0
    context_lines: int = 1

    def problems(self) -> list[str]:
        """Every reason why a run cannot start, in a fixed order; empty if it can."""
        whole = lambda url: bool(urlparse(url).scheme and urlparse(url).netloc)
        found = [f"URL invalide pour {name}: {url}" for name, url in self.references.items() if not whole(url)]
        if not whole(self.csv_url):
            found.append(f"URL principale invalide: {self.csv_url}")
        if self.llm_provider not in PROVIDERS:
            found.append(f"Fournisseur LLM inconnu: {self.llm_provider}")
        if self.llm_provider == "OPENAI" and self.llm_base_url and not whole(self.llm_base_url):
            found.append(f"LLM_BASE_URL_OPENAI invalide: {self.llm_base_url}")
        if self.llm_timeout <= 0:
            found.append("Le délai du LLM doit être positif")
        if self.embedding_provider not in PROVIDERS:
            found.append(f"Fournisseur d'embeddings inconnu: {self.embedding_provider}")
        if not self.phrases:
            found.append("Aucune phrase de référence")
        if not -1 <= self.threshold <= 1:
            found.append("Le seuil de similarité doit être entre -1 et 1")
        if self.chunk_size <= 0 or not 0 <= self.chunk_overlap < 100:
            found.append("Taille ou recouvrement des segments invalide")
        if self.min_content_length < 0 or self.context_lines < 0:
            found.append("Longueur minimale et contexte ne peuvent pas être négatifs")
        return found

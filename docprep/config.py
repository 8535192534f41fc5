"""Tables of the rules: fixed values, stated as they are. Another domain passes its own."""

from __future__ import annotations

from dataclasses import dataclass, field

# Keyword lists by kind of content, matched as substrings of the lower-cased text.
KEYWORDS_OPERATIONAL = (
    "horario", "tarifa", "precio", "contacto", "teléfono", "email", "dirección", "acceso",
    "abierto", "cerrado", "entrada", "ticket", "reserva", "ubicación", "transporte", "aparcamiento",
)
KEYWORDS_CULTURAL = (
    "siglo", "historia", "época", "fundación", "colección", "exposición", "sala", "obra", "pieza", "yacimiento",
    "arqueológic", "patrimonio", "cultural", "tradición", "costumbre", "ritual", "ceremonia",
    "amazigh", "aborigen", "guanche", "grabado", "rupestre", "cueva", "prehispánico", "majos", "momia", "tamarco",
    "benahoarita", "majorero", "tinerfeno", "grancanario", "gomeró", "palmero", "canario", "neolítico", "sepultura",
    "túmulo", "datación", "radiocarbónic", "líbico", "tiburón", "alfarería", "cerámica aborigen", "molino naviforme",
)
KEYWORDS_DEFINITIONS = (
    "definición", "concepto", "término", "glosario", "significado", "se define como", "es decir", "se refiere a", "denomina",
)

# Chunk parameters by kind: max_chars, overlap, min_chunk_size.
BASE_PARAMS = {"definiciones": (800, 80, 80), "operativo": (1200, 120, 80), "mixto": (1500, 150, 100), "cultural": (2000, 200, 100)}

# Retrieval parameters by kind: top_k, tokens_total, tokens_chunk, threshold, context messages.
RETRIEVAL_PARAMS = {
    "operativo": (8, 4000, 300, 0.40, 2),
    "cultural": (12, 7000, 600, 0.30, 3),
    "mixto": (15, 9000, 600, 0.30, 3),
    "definiciones": (5, 2000, 250, 0.45, 1),
    "cultural-museo": (15, 9000, 700, 0.28, 4),
}

# Price per million tokens, in and out; the last is for unknown models.
PRICES = {
    "deepseek/deepseek-v4-flash": (0.13, 0.26),
    "deepseek/deepseek-chat-v3": (0.30, 0.83),
    "google/gemini-2.5-flash-lite": (0.10, 0.40),
    "google/gemini-2.5-flash": (0.10, 0.40),
    "anthropic/claude-sonnet-4.5": (2.80, 14.0),
}
DEFAULT_PRICE = (1.0, 5.0)

# Beginnings of bibliography headings, in lower case.
BIBLIOGRAPHY = (
    "## bibliografía", "## bibliografia", "## referencias", "## references", "## bibliography", "## fuentes",
    "## fuentes consultadas", "## referencias bibliográficas", "## notas y referencias",
)

# States of a refined file that count as complete.
COMPLETE = ("OK", "CHUNKED", "COPY", "SIN_CAMBIO")

# Limits of the chunkers.
CHUNK_CHARS, FIXED_CHARS = 60_000, 50_000
WINDOW_WORDS, OVERLAP_WORDS, WINDOW_FROM = 5_000, 150, 12_000

# Table rendering.
CELL_CHARS, TABLE_ROWS = 120, 40


@dataclass(frozen=True)
class House:
    """What belongs to one publisher: the header its scans repeat, and the name that its documents carry."""

    running_header: str = "boletín del archivo"
    brand: str = "Archivo"
    #: What each caveat says in reports.
    notes: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def caveats(self) -> dict[str, tuple[str, ...]]:
        """Caveat -> patterns, any of which shows it; matched in lower case."""
        # The patterns of each caveat.
        return {
            "caveat_fluor": ("fluoruro", "flúor", "fluorosis"),
            "caveat_momias_intencional": ("momificación intencional", "proceso deliberado de momificación", "momificaron intencionalmente"),
            "caveat_atlantico": ("cruzaron el atlántico", "travesía atlántica", "travesía oceánica abierta"),
            "caveat_metadatos_bloque": ("**vigencia/período:**", "**vigencia/periodo:**"),
            "caveat_notas_proceso": (f"referencia interna: {self.brand.lower()}", "metodología: extracción", "reescritura de texto bruto"),
        }


HOUSE = House()

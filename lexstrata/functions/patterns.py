"""Patterns that give a line its kind, built once from word lists.

``compat`` keeps the published behaviour; ``strict`` corrects its known misses.
"""

from __future__ import annotations

from dataclasses import dataclass

# Page furniture.
FURNITURE = [
    "CÁMARA DE DIPUTADOS DEL H. CONGRESO DE LA UNIÓN",
    "Secretaría General",
    "Secretaría de Servicios Parlamentarios",
]
TITLE_LINE = r"(?iu)(?:LEY DEL|LEY FEDERAL|LEY GENERAL|CÓDIGO|REGLAMENTO).{0,80}(?:RENTA|VALOR|FEDERAL|GENERAL)"
REFORM_LINE = r"(?iuU)Última\s+Reforma\s+DOF|Reforma\s+publicada"

# Ordinals one to nine, the tens that take them, and those that stand alone.
UNITS = ["Primero", "Segundo", "Tercero", "Cuarto", "Quinto", "Sexto", "Séptimo", "Octavo", "Noveno"]
TENS = ["Décimo", "Vigésimo"]
ALONE = ["Trigésimo", "Único"]
STRICT_TENS = ["Trigésimo", "Cuadragésimo", "Quincuagésimo"]

# Words after which "Artículo N" is a reference.
CONNECTORS = [
    "el", "del", "al", "los", "las", "un", "una", "dicho", "mismo", "citado", "referido",
    "previsto", "señalado", "establecido", "dispuesto", "contenido", "mencionado",
    "indicado", "en", "conforme", "según",
]

# Headings of parts, the stems of their ordinals, suffixes of numerals.
PARTS = ["Título", "Capítulo", "Sección"]
PART_STEMS = ["Primer", "Segund", "Tercer", "Cuart", "Quint", "Sext", "Séptim", "Octav", "Noven", "Décim", "Únic"]
SUFFIXES = ["Bis", "Ter", "Quáter", "Quinquies"]

# Openings that make the rest of a part heading prose (a space where the word
# has to end), and those of part names.
PROSE = [
    "de", "del", "y ", "o ", "en ", "a ", "que ", "según", "no ", "se ", "la ", "el ", "las ", "los ",
    "al ", "con ", "por ", "sin ", "ni ", "para ", "sección", "secciones", "capítulo", "título",
]
NAME_OPENINGS = ["De", "Del", "Sobre", "Para", "En", "Por", "Disposiciones"]


def _any(words) -> str:
    return "(?:" + "|".join(words) + ")"


def _ordinals(tens: list[str], alone: list[str], caps) -> str:
    units = _any(map(caps, UNITS))
    return _any([*map(caps, UNITS), *(rf"{caps(t)}(?:\s+{units})?" for t in tens), *map(caps, alone)])


@dataclass(frozen=True)
class Patterns:
    """Java patterns of one mode."""

    article: str
    article_split: str
    ordinal_article: str
    transitory: str
    transitory_ordinal: str
    part: str
    prose: str
    connector: str
    roman: str = r"(?U)^([IVXL]{1,7})\.\s"
    clause: str = r"(?U)^[a-z]\)\s"
    name: str = r"^" + _any(f"{w} " for w in NAME_OPENINGS)
    title_line: str = TITLE_LINE
    running_length: int = 16


def build(strict: bool = False) -> Patterns:
    same, upper = (lambda w: w), str.upper
    tens, alone = (TENS + STRICT_TENS, ["Único"]) if strict else (TENS, ALONE)
    ordinal = _any([_ordinals(tens, alone, same), _ordinals(tens, alone, upper)])
    word = r"(?:ARTÍCULO|Artículo|ARTICULO|Articulo)" if strict else r"(?:ARTÍCULO|Artículo)"
    numbered = word if strict else "Artículo"
    parts = [*PARTS, *map(str.upper, PARTS)]
    if strict:
        parts += ["Titulo", "Capitulo", "Seccion", "TITULO", "CAPITULO", "SECCION"]
    stems = _any([_any(map(str.upper, PART_STEMS)) + "[OA]", _any(PART_STEMS) + "[oa]"])
    numeral = rf"[IVXLCDM\d]+(?:\s+{_any([*map(str.upper, SUFFIXES), *SUFFIXES])})?"
    edge = r"(?![\p{L}\d])" if strict else ""
    prose = _any(PROSE)
    suffix = rf"(?:\s+{_any(SUFFIXES)})?" if strict else ""
    return Patterns(
        article=rf"(?U)^{numbered}\s+\d+",
        article_split=rf"(?Us)^({numbered}\s+\d[\w\-]*{suffix}(?:\s+[A-ZÁÉÍÓÚÑ]{{1,2}}\.)?)\s*(.*)",
        ordinal_article=rf"(?Us)^({word}\s+{ordinal}(?:\s+[Aa]\s+{word}\s+{ordinal})?)\s*(.*)",
        transitory=r"(?U)^(TRANSITORIOS?|Transitorios?)\b" if strict else r"(?iuU)^(Transitorios?)\b",
        transitory_ordinal=rf"(?{'' if strict else 'iu'}Us)^((?:Artículo\s+)?{ordinal})\.?-?\.?\s*(.*)",
        part=rf"(?Us)^({_any(parts)}\s+(?:{stems}|{numeral}){edge})\s*(.*)",
        prose=rf"(?{'' if strict else 'iu'}U)^[,.\s]*{prose}",
        connector=rf"(?iuU)\b{_any(CONNECTORS)}\s*$",
        title_line=rf"(?iu)^{TITLE_LINE[5:]}.{{0,80}}$" if strict else TITLE_LINE,
        running_length=8 if strict else 16,
    )


COMPAT, STRICT = build(), build(strict=True)

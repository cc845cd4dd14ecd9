"""Column builders for text: trimming, case tests, slugs, acronyms, law names, numerals."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that an acronym leaves out.
STOP_WORDS = [
    "de", "del", "la", "las", "los", "el", "en", "y", "e", "o", "u", "a",
    "al", "con", "por", "para", "que", "se", "su", "sus", "un", "una",
    "sobre", "entre", "ante", "sin", "si", "no", "lo",
]

def _base(letter: str) -> str:
    return unicodedata.normalize("NFD", letter)[0]


#: Letters that canonical decomposition takes apart into an ASCII letter and marks, and those letters.
ACCENTED = "".join(c for c in map(chr, range(0xC0, 0x2200)) if _base(c) != c and _base(c).isascii() and _base(c).isalpha())
PLAIN = "".join(map(_base, ACCENTED))


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also inside a lambda, and that no filter copies."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_cheaply(c: Column) -> Column:
    """``strip`` of a column that is at hand: only what does not both begin and end with a plain sign meets a pattern."""
    plain = F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)
    return F.when(plain, c).otherwise(strip(c))


def squeeze(c: Column) -> Column:
    """Stripped, with every run of white space as one space."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def no_lowercase(c: Column) -> Column:
    """True where upper-casing would change nothing."""
    return ~c.rlike(r"\p{Ll}")


def all_caps(c: Column, run: int = 3) -> Column:
    """Upper case, with at least ``run`` capitals in a row."""
    return no_lowercase(c) & c.rlike(f"[A-ZÁÉÍÓÚÑ]{{{run},}}")


def is_roman(c: Column) -> Column:
    """Roman numerals from 1 to 89 in their regular form."""
    return (c != "") & c.rlike(r"^(?:XL|L?X{0,3})(?:IX|IV|V?I{0,3})$")


def fold_accents(c: Column) -> Column:
    """Latin letters without their accents; combining marks go."""
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), r"\p{Mn}", "")


def slug(c: Column, longest: int = 70) -> Column:
    """Lower-case ASCII letters and digits, other runs as one underscore."""
    flat = F.regexp_replace(F.lower(fold_accents(c)), "[^a-z0-9]+", "_")
    flat = F.regexp_replace(flat, "^_+|_+$", "")
    return F.regexp_replace(F.substring(flat, 1, longest), "_+$", "")


def acronym(c: Column, longest: int = 8) -> Column:
    """Capital initials of the words before the first comma or bracket; ``LEY`` if there are none."""
    words = F.split(strip(F.get(F.split(c, r"[,(]"), F.lit(0))), r"(?U)[\s\-/]+")
    counted = F.filter(words, lambda w: ~F.lower(w).isin(STOP_WORDS) & w.rlike(r"^\p{L}"))
    letters = F.array_join(F.slice(F.transform(counted, lambda w: F.upper(F.substring(w, 1, 1))), 1, longest), "")
    return F.coalesce(F.nullif(letters, F.lit("")), F.lit("LEY"))


def law_name(raw: Column) -> Column:
    """Name of a law: what precedes the first ``DOF``, without notes on its state."""
    return strip(F.regexp_replace(strip(F.get(F.split(raw, "DOF"), F.lit(0))), r"(?iuU)\s*(?:Nueva reforma|Ley en vigor.*|Ley Abrogada.*)$", ""))


def law_date(raw: Column) -> Column:
    """``DOF`` with what follows its first mention up to a bracket; empty without one."""
    after = F.get(F.split(raw, "DOF"), F.lit(1))
    return F.when(after.isNotNull(), squeeze(F.concat(F.lit("DOF"), strip(F.get(F.split(strip(after), r"\("), F.lit(0)))))).otherwise("")


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def stem(c: Column) -> Column:
    """File name without its last extension (a leading dot is none)."""
    return F.regexp_replace(basename(c), r"(?<=[^/])\.[^./]*$", "")


def md_slug(file_stem: Column, name: Column) -> Column:
    """Short name and slug of a law: the file's stem without its number, or an acronym."""
    short = F.when((file_stem != "") & ~file_stem.rlike(r"(?U)^\d"), F.regexp_replace(file_stem, r"_\d+$", "")).otherwise(acronym(name))
    return F.concat(short, F.lit("_"), slug(name))


def default_title(file_stem: Column) -> Column:
    return F.translate(file_stem, "_-", "  ")


def reform_kind(c: Column) -> Column:
    """Family of a last-reform text."""
    return (
        F.when(c.rlike(r"^Sin reforma"), "none")
        .when(c.rlike(r"^Notificación .*Sentencia SCJN"), "ruling_notice")
        .when(c.rlike(r"Sentencia SCJN"), "ruling")
        .when(c.rlike(r"^DOF\s*\d"), "gazette")
        .otherwise("other")
    )


def reform_date(c: Column) -> Column:
    return F.to_date(F.nullif(F.regexp_extract(c, r"(\d{2}/\d{2}/\d{4})", 1), F.lit("")), "dd/MM/yyyy")

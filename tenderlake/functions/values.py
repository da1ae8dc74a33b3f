"""Column expressions that type, clean and label single values."""

from __future__ import annotations

import unicodedata
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The official check-digit weights, from the rightmost digit on.
CHECK_WEIGHTS = (3, 7, 13, 17, 19, 23, 29, 37, 41, 43, 47, 53, 59, 67, 71)
# Words that mean yes and no in the source.
YES, NO = ("si", "sí", "true", "t", "1"), ("no", "false", "f", "0")
# Names that stand for no name.
SENTINELS = ("NO DEFINIDO", "SIN DESCRIPCION", "NO DEFINIDA", "NO APLICA", "")
# Fixed value: the document type of a joint venture that has no document.
JOINT_VENTURE = "UNION TEMPORAL O CONSORCIO SIN DOCUMENTO"
# Fixed pattern: document types of natural persons.
PERSON = r"(?iu)c[eé]dula|pasaporte|nuip|tarjeta de identidad|registro civil|permiso (especial|por)"
# Document types of natural persons, without accents.
PERSON_TYPES = (
    "CEDULA DE CIUDADANIA", "CEDULA DE EXTRANJERIA", "TARJETA DE IDENTIDAD", "PASAPORTE",
    "NUIP", "PERMISO ESPECIAL DE PERMANENCIA", "PERMISO POR PROTECCION TEMPORAL", "REGISTRO CIVIL",
)
# Words inside a name that stay in lower case.
LINKING = ("de", "del", "la", "las", "los", "y", "e")
# Fixed value: contracts from here on have impossible values.
SCALE_CEILING = Decimal("1e14")



def _composed() -> tuple[str, str]:
    """All single characters that canonically decompose into one and combining marks, and what they decompose into."""
    pairs = []
    for c in map(chr, range(0xC0, 0x3400)):
        bare = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(bare) == 1 and bare != c:
            pairs.append((c, bare))
    return "".join(c for c, _ in pairs), "".join(bare for _, bare in pairs)


_ACCENTED, _PLAIN = _composed()


def is_ascii(c: Column) -> Column:
    """Whether all characters are ASCII; null for null."""
    return F.octet_length(c) == F.length(c)


def clean_text(c: Column) -> Column:
    """Trimmed; null where blank."""
    # trimming is quicker, and the same where no character but the pattern's own ends a line
    trimmed = F.when(is_ascii(c), F.btrim(c, F.lit(" \t\n\x0b\x0c\r"))).otherwise(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.nullif(trimmed, F.lit(""))


def to_date(c: Column) -> Column:
    """The date of an ISO timestamp's first ten characters; null where that is none."""
    return F.when(F.substring(c, 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))


def to_decimal(c: Column) -> Column:
    return F.trim(c).try_cast("decimal(38,6)")


def to_boolean(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low.isin(*YES), True).when(low.isin(*NO), False)


def plain_letters(c: Column) -> Column:
    """Letters without their marks, as canonical decomposition has them: composed and combining ones of any script."""
    return F.when(is_ascii(c), c).otherwise(F.translate(F.regexp_replace(c, r"\p{Mn}", ""), _ACCENTED, _PLAIN))


def normalized(c: Column) -> Column:
    """Upper case without accents, white space collapsed; null where blank."""
    return F.nullif(F.trim(F.regexp_replace(F.upper(plain_letters(c)), r"\s+", " ")), F.lit(""))


def check_digit(number: Column) -> Column:
    """The modulo-11 check digit of 1 to 15 digits; null for anything else."""
    digits = F.transform(F.split(F.reverse(number), ""), lambda d: d.try_cast("int"))
    weights = F.array(*map(F.lit, CHECK_WEIGHTS))
    products = F.zip_with(F.slice(digits, 1, 15), weights, lambda d, w: F.coalesce(d, F.lit(0)) * w)
    rest = F.aggregate(products, F.lit(0), lambda a, x: a + x) % 11
    return F.when(number.rlike(r"^[0-9]{1,15}$"), F.when(rest < 2, rest).otherwise(11 - rest))


def one_character(c: Column) -> Column:
    """Whether the text is one character, repeated or not."""
    return c.rlike(r"^(.)\1*$")


def supplier_number(kind: Column, number: Column, body: str = "[89][0-9]{8}") -> Column:
    """The canonical document number; null where it identifies nobody.

    Only letters and digits stay. It needs a digit, and more than one character
    repeated. A tax id of a body (a pattern; by default nine digits from 8 or 9)
    and one more digit loses that if it is the check digit of the body's last nine.
    """
    return without_check_digit(normalized(kind), real_number(bare_number(number)), body)


def bare_number(number: Column) -> Column:
    """The letters and digits of a document number."""
    return F.regexp_replace(number, "[^0-9A-Za-z]", "")


def real_number(bare: Column) -> Column:
    """bare_number(), where it identifies anybody."""
    return F.when(bare.rlike("[0-9]") & ~one_character(bare), bare)


def without_check_digit(kind: Column, real: Column, body: str = "[89][0-9]{8}") -> Column:
    """supplier_number() of a normalized() kind and a real_number(); where these are columns each is computed once."""
    own = F.left(real, F.length(real) - 1)
    checked = kind.startswith("NIT") & real.rlike(f"^{body}[0-9]$") & (check_digit(F.right(own, F.lit(9))) == F.right(real, F.lit(1)).try_cast("int"))
    return F.when(F.coalesce(checked, F.lit(False)), own).otherwise(real)


def out_of_scale(value: Column, ceiling: Decimal | float = SCALE_CEILING) -> Column:
    """Whether the value is impossible; null where there is none."""
    return value >= F.lit(ceiling)


def is_person(kind: Column) -> Column:
    return F.coalesce(kind.rlike(PERSON), F.lit(False))


def names_person(kind: Column) -> Column:
    """Whether a document type, without accents, contains one of a natural person's."""
    return F.coalesce(F.exists(F.array(*map(F.lit, PERSON_TYPES)), lambda t: F.contains(normalized(kind), t)), F.lit(False))


def is_sentinel(name: Column) -> Column:
    return F.upper(F.coalesce(name, F.lit(""))).isin(*SENTINELS)


def masked(number: Column, kind: Column, everybody: bool = False) -> Column:
    """Natural persons' numbers but for the last three characters; of four or fewer nothing stays."""
    n = F.length(number)
    hidden = F.when(n <= 4, F.repeat(F.lit("•"), n)).otherwise(F.concat(F.repeat(F.lit("•"), n - 3), F.right(number, F.lit(3))))
    return hidden if everybody else F.when(is_person(kind), hidden).otherwise(number)


def masked_in_lists(number: Column) -> Column:
    """The variant of the review lists: always the last three characters, even of short numbers."""
    return F.concat(F.repeat(F.lit("•"), F.greatest(F.length(number) - 3, F.lit(0))), F.right(number, F.lit(3)))


def display_name(name: Column, kind: Column, provisional: Column) -> Column:
    return (
        F.when(provisional, F.coalesce(name, F.lit("Unión temporal")))
        .when(is_person(kind), F.lit("Persona natural"))
        .otherwise(F.coalesce(name, F.lit("Sin razón social")))
    )


def bucket(value: Column, edges: tuple[float, ...]) -> Column:
    """The place of the first edge above value, from 1; past the last edge one more; null for null."""
    out = F.when(value.isNull(), None)
    for i, edge in enumerate(edges, 1):
        out = out.when(value < F.lit(edge), i)
    return out.otherwise(len(edges) + 1)


def labelled(value: Column, edges: tuple[float, ...], labels: tuple[str, ...], none: str) -> tuple[Column, Column]:
    """The label of a value's bucket, and its place, which is 0 for null."""
    at = F.coalesce(bucket(value, edges), F.lit(0))
    return F.element_at(F.array(F.lit(none), *map(F.lit, labels)), at + 1), at


def usable(c: Column, sentinels: tuple[str, ...] = SENTINELS) -> Column:
    """Not null or blank, no stand-in and not zero."""
    t = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return ~t.isin(*sentinels) & ~t.rlike(r"^0*(\.0*)?$")


def variation(now: Column, before: Column) -> Column:
    """The change in per cent; null without a former value or where it was 0."""
    return F.when(before != 0, 100 * (now - before) / before)


def trend(change: Column, neutral: float = 5.0) -> Column:
    return F.when(change.isNull(), "unknown").when(F.abs(change) < neutral, "flat").when(change > 0, "up").otherwise("down")


def colombian(value: Column, decimals: int = 0) -> Column:
    """1234567.9 as 1.234.567,9"""
    return F.translate(F.format_number(value, decimals), ",.", ".,")


def compact_money(value: Column) -> Column:
    """In millones, mil millones or billones (10**12)."""
    said = lambda scale, name: F.concat(F.lit("$"), colombian(value / scale, 1), F.lit(f" {name}"))
    size = F.abs(value)
    return F.when(size >= 1e12, said(1e12, "billones")).when(size >= 1e9, said(1e9, "mil millones")).when(size >= 1e6, said(1e6, "millones")).otherwise(F.concat(F.lit("$"), colombian(value)))


def title(c: Column) -> Column:
    """A name in title case: linking words but the first stay small, words with a point stay as they are."""
    word = lambda w, i: F.when(w.contains("."), w).when((i > 0) & F.lower(w).isin(*LINKING), F.lower(w)).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30))))
    return F.array_join(F.transform(F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " "), word), " ")

"""Checks before anything is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import normalized, plain_letters

POST_LIMIT, LINK_LENGTH = 280, 23
# Words that state guilt.
FORBIDDEN = (
    "irregular", "irregulares", "irregularidad", "irregularidades",
    "corrupto", "corrupta", "corruptos", "corruptas", "corrupcion",
    "fraude", "fraudes", "fraudulento", "fraudulenta",
    "ilegal", "ilegales", "ilegalidad",
    "delito", "delitos", "delictivo",
    "culpable", "culpables",
)
# Fixed pattern: a natural person's document written out, its type and soon after it a long number.
PERSON_DOCUMENT = r"(?:C[EÉ]DULA|PASAPORTE|NUIP|TARJETA\s+DE\s+IDENTIDAD|REGISTRO\s+CIVIL|PERMISO\s+(?:ESPECIAL|POR))[^0-9]{0,40}([0-9]{5,})"
DOCUMENT = r"(?<![0-9])[0-9]{6,12}(?![0-9])"


def post_length(text: Column) -> Column:
    """The length with each link counted as LINK_LENGTH characters."""
    return F.length(F.regexp_replace(text, r"https?://\S+", "x" * LINK_LENGTH))


def unmasked(text: Column) -> Column:
    """Runs of 6 to 12 digits outside links, which may be documents."""
    return F.regexp_extract_all(F.regexp_replace(text, r"https?://\S+", ""), F.lit(f"({DOCUMENT})"), F.lit(1))


def guilt_words(text: Column, words: tuple[str, ...] = FORBIDDEN) -> Column:
    return F.regexp_extract_all(normalized(text), F.lit(rf"\b({'|'.join(w.upper() for w in words)})\b"), F.lit(1))


def person_documents(text: Column) -> Column:
    """Documents of natural persons that are not masked. Tax ids of companies are none."""
    return F.regexp_extract_all(F.upper(plain_letters(text)), F.lit(PERSON_DOCUMENT), F.lit(1))


def findings(posts: DataFrame, text: str = "text", words: tuple[str, ...] = FORBIDDEN, limit: int = POST_LIMIT) -> DataFrame:
    """posts with digits, words, too_long and blank; none of them stops the check of the others."""
    t = F.col(text)
    return posts.select("*", F.coalesce(F.size(unmasked(t)), F.lit(0)).alias("digits"), F.coalesce(F.size(guilt_words(t, words)), F.lit(0)).alias("words"),
                        F.coalesce(post_length(t) > limit, F.lit(False)).alias("too_long"), (F.coalesce(F.trim(t), F.lit("")) == "").alias("blank"))


def gates(ingest_ok: DataFrame, contracts: DataFrame, errata: DataFrame, reviewed: DataFrame, comparable: DataFrame, posts: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Six rows n, name, green, figure: all are evaluated. The one-row frames ingest_ok and comparable have a column ok.

    Posts carry no identifiers at all: digits in them are found by the fifth
    gate. The sixth looks for natural persons' documents in pages (by default the
    posts), which may carry tax ids.
    """
    row = lambda n, name, df, green, figure: df.select(F.lit(n).alias("n"), F.lit(name).alias("name"), green.alias("green"), figure.cast("long").alias("figure"))
    impossible = contracts.agg(F.count_if(F.coalesce("out_of_scale", F.lit(False)) & F.col("published")).alias("x"))
    open_errata = errata.join(reviewed.select("process_id"), "process_id", "left_anti").agg(F.count(F.lit(1)).alias("x"))
    bad = (F.col("words") > 0) | F.col("too_long") | F.col("blank") | (F.col("digits") > 0)
    checked = findings(posts).agg(F.count_if(bad).alias("x"))
    written_out = (posts if pages is None else pages).agg(F.count_if(F.coalesce(F.size(person_documents(F.col("text"))), F.lit(0)) > 0).alias("x"))
    parts = [
        row(1, "ingest", ingest_ok, F.col("ok"), F.col("ok").cast("int")), row(2, "impossible values", impossible, F.col("x") == 0, F.col("x")),
        row(3, "unreviewed errata", open_errata, F.col("x") == 0, F.col("x")), row(4, "comparability", comparable, F.col("ok"), F.col("ok").cast("int")),
        row(5, "posts", checked, F.col("x") == 0, F.col("x")), row(6, "documents", written_out, F.col("x") == 0, F.col("x")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""Citation text from provenance columns."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The wording used when a source records no citation of its own.
DEFAULT_BORE_CITATION = "Geoscience Australia borehole data."
DEFAULT_HYDRO_CITATION = "Hydrogeology of Australia, Geoscience Australia."



def provenance_citation(spark: SparkSession, provenance: dict, default: str) -> str:
    """The citation text of one manifest entry; ``default`` where it names none."""
    ddl = "citation string, fetched_at double, license string, source_url string"
    row = tuple(provenance.get(name) for name in ("citation", "fetched_at", "license", "source_url"))
    text = citation_text(*(F.col(c) for c in ("citation", "fetched_at", "license", "source_url")), default)
    return spark.createDataFrame([row], ddl).select(text.alias("text")).first()["text"]


def access_date(fetched_at: Column) -> Column:
    """UTC calendar date of epoch seconds, whatever the session time zone."""
    days = F.floor(fetched_at / 86400).cast("int")
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days), "yyyy-MM-dd")


def citation_text(
    citation: Column,
    fetched_at: Column,
    license: Column,
    source_url: Column,
    default: str = DEFAULT_BORE_CITATION,
) -> Column:
    """Base text, access date, licence and source; missing parts are left out."""
    base = F.coalesce(F.nullif(citation, F.lit("")), F.lit(default))
    accessed = F.when(
        fetched_at != 0, F.concat(F.lit("Accessed "), access_date(fetched_at), F.lit("."))
    )
    licensed = F.when(license != "", F.concat(F.lit("Licensed "), license, F.lit(".")))
    source = F.when(source_url != "", F.concat(F.lit("Source: "), source_url))
    return F.concat_ws(" ", base, accessed, licensed, source)

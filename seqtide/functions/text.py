"""Column expressions on headers, keys and lineage text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two header patterns of the input format.
ACCESSION = r"^(\S+)"
TAXID = r"\|taxid\|(\d+)\|"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def accession_of(header: Column | str) -> Column:
    """First token of a header without its ``>``, blanks before it skipped; null when there is none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(_col(header), r"^\s+", ""), ACCESSION, 1), F.lit(""))


def taxid_of(header: Column | str) -> Column:
    """Taxon id embedded in a header, null when absent."""
    return F.nullif(F.regexp_extract(_col(header), TAXID, 1), F.lit(""))


def present(c: Column | str) -> Column:
    """Not null and not empty."""
    c = _col(c)
    return c.isNotNull() & (c != "")


def valid_key(accession: Column | str, taxid: Column | str) -> Column:
    """Both keys usable; the text ``None`` counts as missing."""
    taxid = _col(taxid).cast("string")
    return present(accession) & present(taxid) & (taxid != "None")


def any_term(c: Column | str, terms: list[str] | tuple[str, ...]) -> Column:
    """True when the text holds any of the terms, letter case ignored."""
    low = F.lower(_col(c))
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(t.lower())) for t in terms])


def blank(c: Column | str) -> Column:
    """Null becomes the empty string, the form missing text has in outputs."""
    return F.coalesce(_col(c), F.lit(""))


def sequence_id(i: Column | str, prefix: str = "ACC_", width: int = 6) -> Column:
    """Zero-padded id such as ``ACC_000042``."""
    return F.format_string(f"{prefix}%0{width}d", _col(i))

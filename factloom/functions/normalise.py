"""Normalisers of filing identifiers, form types and dates.  Whatever cannot be normalised is NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACCESSION = r"^[0-9]{10}-[0-9]{2}-[0-9]{6}$"
CIK = r"^[0-9]{10}$"
DOCUMENT_ROOT = "https://www.sec.gov/Archives/"


def accession(value: Column) -> Column:
    """10-2-6 digits with hyphens; 18 bare digits get them."""
    plain = F.trim(value)
    bare = F.regexp_replace(plain, "^([0-9]{10})([0-9]{2})([0-9]{6})$", "$1-$2-$3")
    return F.when(plain.rlike(ACCESSION), plain).when(plain.rlike("^[0-9]{18}$"), bare)


def cik(value: Column) -> Column:
    """One to ten digits, padded with zeros to ten; anything that is not a digit is dropped first."""
    digits = F.regexp_replace(F.trim(value), "[^0-9]", "")
    return F.when(F.length(digits).between(1, 10), F.lpad(digits, 10, "0"))


def form_type(value: Column) -> Column:
    """Upper case without blanks around it; blank is NULL."""
    plain = F.upper(F.trim(value))
    return F.when(F.length(plain) > 0, plain)


def is_amendment(form: Column) -> Column:
    return F.coalesce(form.rlike("/A$"), F.lit(False))


def base_form_type(form: Column) -> Column:
    return F.regexp_replace(form, "/A$", "")


def filing_date(value: Column) -> Column:
    """YYYYMMDD or YYYY-MM-DD; impossible dates are NULL."""
    plain = F.trim(value)
    return F.when(plain.rlike("^[0-9]{8}$"), F.try_to_date(plain, "yyyyMMdd")).when(plain.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(plain, "yyyy-MM-dd"))


def document_url(file_name: Column, root: str = DOCUMENT_ROOT) -> Column:
    plain = F.trim(file_name)
    return F.when(F.length(plain) > 0, F.concat(F.lit(root), plain))

"""Turning the raw bilingual report into the typed table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.parsing import to_day, to_int, to_money

# Headers of the raw report that repeat a kept column in French.
FRENCH_COLUMNS = (
    "Type de plainte recue",
    "Pays",
    "Province/Etat",
    "Categories thematiques sur la fraude et la cybercriminalite",
    "Methode de sollicitation",
    "Genre",
    "Langue de correspondance",
    "Type de plainte",
)

# Raw header -> clean name.
CLEAN_NAMES = {
    "Numero d'identification / Number ID": "id",
    "Date Received / Date recue": "date",
    "Complaint Received Type": "complaint_type",
    "Country": "country",
    "Province/State": "province",
    "Fraud and Cybercrime Thematic Categories": "fraud_cat",
    "Solicitation Method": "sol_method",
    "Gender": "gender",
    "Language of Correspondence": "lang_cor",
    "Victim Age Range / Tranche d'age des victimes": "age_range",
    "Complaint Type": "complaint_subtype",
    "Number of Victims / Nombre de victimes": "num_victims",
    "Dollar Loss /pertes financieres": "dollar_loss",
}


def drop_cols(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Names that are not there are ignored."""
    return df.drop(*names)


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def select_cols(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    return df.select(*keep)


def numeric_cols_except(df: DataFrame, names: Iterable[str] = ()) -> DataFrame:
    """Numeric columns only, without the named ones."""
    skipped = set(names)
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    keep = [
        name
        for name, kind in df.dtypes
        if name not in skipped and (kind in numeric or kind.startswith("decimal"))
    ]
    return df.select(*keep)


def clean_reports(raw: DataFrame, country_sentinel: str | None = "Not Specified") -> DataFrame:
    """Raw all-string report -> typed table, in one projection and one filter.

    With a sentinel, rows of that country and rows without a country go; with None all rows stay.
    """
    typed = {"num_victims": to_int("num_victims"), "dollar_loss": to_money("dollar_loss"), "date": to_day("date")}
    clean = raw.transform(drop_cols, FRENCH_COLUMNS).transform(rename_map, CLEAN_NAMES).withColumns(typed)
    return clean if country_sentinel is None else clean.filter(F.col("country") != country_sentinel)

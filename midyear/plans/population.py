"""Population table: layouts, name harmonising, age model, projected years."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from midyear.functions.recode import recode
from midyear.functions.text import standard_name, trim_spaces
from midyear.operators.joins import (
    join_on, override_pairs, override_within, stop_if_any, unknown_names, written_if_none,
)
from midyear.operators.model import disaggregate, fit_grouped_logit
from midyear.operators.shape import derive, map_columns, select_like
from midyear.plans.layouts import layout_2000, layout_2011, layout_2016
from midyear.sources.shared import cut_lineage

MODEL_KEYS = ["department", "municipality", "sex"]
UNKNOWN_NAMES = "projected place names are missing from the single-age table"

# Spelling of departments and places in the single-age tables.
DEPARTMENT_NAMES = {"Huehetenango": "Huehuetenango", " Jalapa": "Jalapa"}
PLACE_NAMES = {
    "Santa Catarina La Tinta": "Santa Catalina La Tinta",
    "Melchor": "Melchor De Mencos",
    "San Agustin Acasagustlan": "San Agustin Acasaguastlan",
    "Chinuautla": "Chinautla",
    "Petapa": "San Miguel Petapa",
    "Acatempa": "San Jose Acatempa",
    "San Martin Zapotitlan": "San Martin Zapotitlan",
    "San Bartolome": "San Bartolome Milpas Altas",
    "Santa Maria De Jesus": "Santa Maria De Jesus",
    "Santiago Sactepequez": "Santiago Sacatepequez",
    "Santa Cruz Naranajo": "Santa Cruz Naranjo",
    "Santa Catalina Ixtahuacan": "Santa Catarina Ixtahuacan",
}
# Spelling of places within one department.
SCOPE = "Huehuetenango"
SCOPED_NAMES = {
    "Barrillas": "Santa Cruz Barillas",
    "Concepcion": "Concepcion Huista",
    "San  Idelfonso Ixtahuacan": "San Idelfonso Ixtahuacan",
    "Santiago Chimaltenanango": "Santiago Chimaltenango",
}
# Spelling of places in the projected totals.
PROJECTED_NAMES = {
    "La Tinta": "Santa Catalina La Tinta",
    "Santa Catarina La Tinta": "Santa Catalina La Tinta",
    "San Agustin Acasagustlan": "San Agustin Acasaguastlan",
    "Chinuautla": "Chinautla",
    "Petapa": "San Miguel Petapa",
    "Santiago Chimaltenanango": "Santiago Chimaltenango",
    "Acatempa": "San Jose Acatempa",
    "San Bartolome": "San Bartolome Milpas Altas",
    "Santiago Sactepequez": "Santiago Sacatepequez",
    "Santa Catalina Ixtahuacan": "Santa Catarina Ixtahuacan",
}
PROJECTED_SCOPED_NAMES = {"Concepcion": "Concepcion Huista"}


def harmonise(
    df: DataFrame,
    places: Mapping[str, str] = PLACE_NAMES,
    scoped: Mapping[str, str] = SCOPED_NAMES,
    scope: str = SCOPE,
    departments: Mapping[str, str] | None = DEPARTMENT_NAMES,
    within: Callable[[Column, Column, Mapping], Column] = override_within,
) -> DataFrame:
    """Department map, then place map, then the place map of one department (``within``)."""
    steps = {}
    if departments:
        steps["department"] = recode(F.col("department"), departments)
    place = F.col("municipality")
    df = derive(df, **steps, municipality=recode(trim_spaces(place), places))
    return df.withColumn(
        "municipality", within(place, F.col("department") == scope, scoped)
    )


def standardise(df: DataFrame) -> DataFrame:
    """Names of the projected totals: ASCII, lower, trimmed, title case, then mapped.

    A place without a department keeps its name unless the map of one department names it.
    """
    df = map_columns(df, ["department", "municipality"], standard_name)
    return harmonise(df, PROJECTED_NAMES, PROJECTED_SCOPED_NAMES, departments=None,
                     within=override_pairs)


def check_names(projected: DataFrame, known: DataFrame) -> None:
    """Stop when a projected place never occurs in the single-age table (runs a job)."""
    stop_if_any(
        unknown_names(projected, known, "municipality", ["department", "municipality"]),
        UNKNOWN_NAMES,
    )


def project_ages(single_ages: DataFrame, projected: DataFrame, coefs: DataFrame | None = None) -> DataFrame:
    """Split projected totals of men and women into the single ages of the past years.

    ``coefs`` are the models of the places, fitted here where there are none.
    """
    coefs = fit_grouped_logit(single_ages, MODEL_KEYS) if coefs is None else coefs
    totals = projected.filter(
        F.col("sex").isin("male", "female") & (F.col("type") == "total")
    )
    split = disaggregate(totals, single_ages.select("age"), coefs, MODEL_KEYS)
    return select_like(split, single_ages)


def population_table(cells_2000: DataFrame, cells_2011: DataFrame,
                     cells_2016: DataFrame, check: bool = True,
                     **options_2011) -> DataFrame:
    """Long population table of all years from three cell tables.

    The single-age table and the projected totals are written once to the shared folder, as
    the fit and the result read them.  The name check counts places without a model as the projected
    totals are written: the models, one row a place and sex, name every place that the fit could use.
    Runs the jobs of the model fit; ``options_2011`` go to ``layout_2011``.
    """
    past = layout_2000(cells_2000).unionByName(layout_2011(cells_2011, **options_2011))
    single_ages = cut_lineage(harmonise(past))
    coefs = cut_lineage(fit_grouped_logit(single_ages, MODEL_KEYS))
    projected, unknown = standardise(layout_2016(cells_2016)), F.lit(False)
    if check:
        names = coefs.select(F.col("municipality"), F.lit(True).alias("__known")).distinct()
        projected, unknown = join_on(projected, names, ["municipality"]), F.col("__known").isNull()
    projected = written_if_none(projected, unknown, UNKNOWN_NAMES).drop("__known")
    return single_ages.unionByName(project_ages(single_ages, projected, coefs))

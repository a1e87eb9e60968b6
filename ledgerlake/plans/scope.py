"""Row scope: which regions a person may see."""
from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from .model import Model


def scoped_regions(regions: DataFrame, principal: str, executive: bool = False) -> DataFrame:
    return regions if executive else regions.filter(F.lower("DirectorEmail") == principal.lower())


def row_scope(model: Model, principal: str, executive: bool = False) -> Model:
    """The model as one person sees it: every table that relates to region keeps only theirs."""
    if executive:
        return model
    mine = scoped_regions(model.tables["dim_region"], principal)
    tables = {}
    for name, df in model.tables.items():
        trail = model.path(name, "dim_region")
        if name == "dim_region":
            tables[name] = mine
        elif trail is None:
            tables[name] = df
        elif len(trail) == 1:
            tables[name] = df.join(mine.select(F.col("RegionKey").alias(trail[0][1])), trail[0][1], "left_semi")
        else:  # through another dimension, e.g. branch
            _, col, dim, key = trail[0]
            via = model.tables[dim].join(mine.select("RegionKey"), "RegionKey", "left_semi")
            tables[name] = df.join(via.select(F.col(key).alias(col)), col, "left_semi")
    return replace(model, tables=tables)

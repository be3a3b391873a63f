"""Filters as a user writes them, outside the package: addressed by module path."""

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def young_supernova(df: DataFrame) -> Column:
    """Built from columns: a supernova label on an alert at most 30 days old."""
    return F.expr("cdsxmatch IN ('SN', 'Candidate_SN*') AND candidate.jd - candidate.jdstarthist <= 30.0D")


def bright_variable(cdsxmatch: pd.Series, magpsf: pd.Series) -> pd.Series:
    """Vectorised over columns named by the arguments."""
    return (cdsxmatch == "RRLyr") & (magpsf < 18.0)

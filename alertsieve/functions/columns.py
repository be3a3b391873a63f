"""Column resolution and NULL/NaN-safe comparison helpers.

Filters are written against *names* (``drb``, ``jd`` ...), the way the
reference binds a filter's argument names to alert columns: a name is looked up
at the top level first, then inside the ``candidate`` struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve(df: DataFrame, name: str, struct: str = "candidate") -> Column:
    """Column ``name`` at top level, else ``struct.name``."""
    fields = {f.name: f for f in df.schema.fields}
    if name in fields:
        return F.col(f"`{name}`")
    if struct in fields and isinstance(fields[struct].dataType, T.StructType):
        if name in fields[struct].dataType.fieldNames():
            return F.col(struct).getField(name)
    raise KeyError(f"column {name!r} not found at top level nor in {struct!r}")


def has_column(df: DataFrame, name: str, struct: str = "candidate") -> bool:
    try:
        resolve(df, name, struct)
        return True
    except KeyError:
        return False


def num(c: Column) -> Column:
    """Double with NaN mapped to NULL (pandas: NaN fails every comparison;
    Spark would order NaN above every number)."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def d(x: float) -> Column:
    """Double literal (a bare ``0.5`` would be a decimal in SQL)."""
    return F.lit(float(x)).cast("double")


def flag(pred: Column) -> Column:
    """Non-null boolean: a NULL predicate is a failed predicate."""
    return F.coalesce(pred, F.lit(False))


def label_in(c: Column, labels) -> Column:
    """Membership; a missing label is *not* in the list."""
    return flag(c.isin(list(labels)))


def label_eq(c: Column, label: str) -> Column:
    """Null-safe equality (C11)."""
    return c.eqNullSafe(F.lit(label))


def prefix_match(c: Column, prefix: str) -> Column:
    """``str(x).startswith(prefix)``, NULL -> False."""
    return flag(c.startswith(prefix))


def as_double(c: Column) -> Column:
    return num(c)


def as_int(c: Column) -> Column:
    """``astype(int)``: truncation toward zero."""
    return c.cast("long")

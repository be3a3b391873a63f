"""Alert filters (F1-F14) as Column builders, and the filter registry.

Every builder takes the alert DataFrame (to resolve argument names, top level
first then ``candidate.``) and returns a *bare* predicate: NULL means "fails".
``df.filter(pred)`` drops NULL rows and lets Catalyst push the comparison
conjuncts into the parquet scan; ``flag(pred)`` gives the non-null boolean
column.  Comparisons are written ``(x > v) & ~isnan(x)`` so NaN fails like in
pandas while the ``x > v`` conjunct stays pushable.

The history filters need the light curve ``lc`` (history ++ current); builders
compute it on demand.  The two catalogue filters (F12, F13) also need a sky
join, see ``operators/kilonova.py``: here only their per-row cuts live.
"""

from __future__ import annotations

import importlib
import inspect
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import lightcurve as L
from ..functions.columns import d, flag
from ..functions.sky import galactic_lat_sql


def gt(c: Column, v: float) -> Column:
    return (c > d(v)) & ~F.isnan(c)


def ge(c: Column, v: float) -> Column:
    return (c >= d(v)) & ~F.isnan(c)


def lt(c: Column, v: float) -> Column:
    return c < d(v)


def le(c: Column, v: float) -> Column:
    return c <= d(v)


# --- SQL text building blocks (one JVM call per predicate) --------------------

def name_sql(df: DataFrame, name: str, struct: str = "candidate") -> str:
    """SQL path of ``name``: top level first, then ``candidate.``."""
    fields = {fl.name: fl for fl in df.schema.fields}
    if name in fields:
        return f"`{name}`"
    if struct in fields and isinstance(fields[struct].dataType, T.StructType) \
            and name in fields[struct].dataType.fieldNames():
        return f"`{struct}`.`{name}`"
    raise KeyError(f"column {name!r} not found at top level nor in {struct!r}")


def current_sql(df: DataFrame, struct: str = "candidate") -> str:
    """SQL of the newest measurement as a struct: the column ``candidate``, or for flat
    alerts a struct of the top-level columns."""
    if struct in df.columns:
        return f"`{struct}`"
    return "named_struct(" + ", ".join(f"'{x}', {name_sql(df, x)}" for x in L.POINT_NAMES) + ")"


def measure_prefix(df: DataFrame, struct: str = "candidate") -> str:
    """Prefix of the newest measurement's columns: ``candidate.``, or nothing for flat alerts."""
    return f"{struct}." if struct in df.columns else ""


def _dbl(df: DataFrame, name: str) -> str:
    return f"CAST({name_sql(df, name)} AS DOUBLE)"


def _int(df: DataFrame, name: str) -> str:
    return f"CAST({name_sql(df, name)} AS BIGINT)"


def _lit(v: float) -> str:
    return f"{float(v)!r}D"


def gt_sql(x: str, v: float) -> str:
    return f"({x} > {_lit(v)} AND NOT isnan({x}))"


def _in(x: str, labels) -> str:
    return f"{x} IN (" + ", ".join("'" + s.replace("'", "\\'") + "'" for s in labels) + ")"


def age_sql(df: DataFrame) -> str:
    return f"({_dbl(df, 'jd')} - {_dbl(df, 'jdstarthist')})"


def age(df: DataFrame) -> Column:
    return F.expr(age_sql(df))


# ---------------------------------------------------------------------------
# label / score filters: `*_sql` gives the predicate text, the plain name the Column
# ---------------------------------------------------------------------------

def rrlyr_sql(df):
    """``cdsxmatch == 'RRLyr'``."""
    return f"{name_sql(df, 'cdsxmatch')} = '{S.RRLYR_LABEL}'"


def yso_candidates_sql(df):
    """YSO labels."""
    return _in(name_sql(df, "cdsxmatch"), S.YSO_LABELS)


def simbad_candidates_sql(df):
    """a catalogue label other than Unknown/Transient/Fail; a missing label passes."""
    return f"NOT coalesce({_in(name_sql(df, 'cdsxmatch'), S.SIMBAD_NOT_A_MATCH)}, false)"


def sso_ztf_candidates_sql(df):
    """known solar-system object, ``int(roid) == 3``."""
    return f"{_int(df, 'roid')} = 3"


def sso_candidates_sql(df):
    """solar-system candidate, ``int(roid) == 2``."""
    return f"{_int(df, 'roid')} = 2"


def tracklet_candidates_sql(df):
    """tracklet id starting with ``TRCK_``."""
    return f"startswith({name_sql(df, 'tracklet')}, '{S.TRACKLET_PREFIX}')"


def microlensing_candidates_sql(df):
    """``mulens > 0``."""
    return gt_sql(_dbl(df, "mulens"), 0.0)


def snialike_sql(df):
    """F8: ``rfscore > 0 & cdsxmatch == 'Unknown' & neargaia > 5 & distpsnr1 > 5``."""
    return (f"{gt_sql(_dbl(df, 'rfscore'), 0.0)} AND {name_sql(df, 'cdsxmatch')} = 'Unknown' "
            f"AND {gt_sql(_dbl(df, 'neargaia'), 5.0)} AND {gt_sql(_dbl(df, 'distpsnr1'), 5.0)}")


def _snn_sql(df):
    return f"({gt_sql(_dbl(df, 'snn_snia_vs_nonia'), 0.5)} OR {gt_sql(_dbl(df, 'snn_sn_vs_all'), 0.5)})"


def sn_candidates_sql(df):
    """SN candidates."""
    return (f"{_snn_sql(df)} AND {_in(name_sql(df, 'cdsxmatch'), S.SN_KEEP)} AND {age_sql(df)} <= 90.0D "
            f"AND {gt_sql(_dbl(df, 'drb'), 0.5)} AND {gt_sql(_dbl(df, 'classtar'), 0.4)} "
            f"AND {_int(df, 'ndethist')} > 1 AND {_int(df, 'roid')} != 3")


def early_sn_candidates_sql(df):
    """early SN Ia candidates (no age and no solar-system cut)."""
    return (f"{_snn_sql(df)} AND {_in(name_sql(df, 'cdsxmatch'), S.SN_KEEP)} "
            f"AND {gt_sql(_dbl(df, 'drb'), 0.5)} AND {gt_sql(_dbl(df, 'classtar'), 0.4)} "
            f"AND {_int(df, 'ndethist')} <= 20 AND {gt_sql(_dbl(df, 'rf_snia_vs_nonia'), 0.5)}")


def kn_candidates_sql(df):
    """kilonova candidates from the classifier score."""
    return (f"{gt_sql(_dbl(df, 'rf_kn_vs_nonkn'), 0.5)} AND {gt_sql(_dbl(df, 'drb'), 0.5)} "
            f"AND {gt_sql(_dbl(df, 'classtar'), 0.4)} AND {age_sql(df)} < 20.0D "
            f"AND {_dbl(df, 'ndethist')} < 20.0D AND {_in(name_sql(df, 'cdsxmatch'), S.KN_KEEP)}")


def early_kn_cuts_sql(df):
    """F12, per-row part: cuts before the host-galaxy match."""
    return (f"{gt_sql(_dbl(df, 'drb'), 0.5)} AND {gt_sql(_dbl(df, 'classtar'), 0.4)} "
            f"AND {age_sql(df)} < 0.25D AND {_int(df, 'roid')} != 3 "
            f"AND {_in(name_sql(df, 'cdsxmatch'), S.KN_KEEP)}")


def rate_kn_cuts_sql(df):
    """F13, per-row part: cuts before the light-curve fit."""
    ssd = _dbl(df, "ssdistnr")
    b = galactic_lat_sql(_dbl(df, "ra"), _dbl(df, "dec"))
    return (f"{gt_sql(_dbl(df, 'drb'), 0.9)} AND {gt_sql(_dbl(df, 'classtar'), 0.4)} "
            f"AND {age_sql(df)} < 14.0D AND {_dbl(df, 'ndethist')} < 20.0D "
            f"AND {name_sql(df, 'isdiffpos')} = 't' AND ({gt_sql(ssd, 10.0)} OR {ssd} < 0.0D) "
            f"AND {gt_sql(f'abs({b})', 10.0)} AND {_in(name_sql(df, 'cdsxmatch'), S.KN_KEEP)}")


def orphan_grb_sql(df):
    """orphan GRB afterglow candidates (light-curve shape).

    The light curve is folded once (``fold_orphan``) into every term of the
    filter, for alerts that are young and have exactly three valid points; these
    are counted in the history as it is stored, so most rows never fold."""
    history, current = name_sql(df, "prv_candidates"), current_sql(df)
    t = L.fold_orphan_sql(L.lc_concat_sql(history, current))
    young = f"{age_sql(df)} <= 30.0D"
    return f"{young} AND CASE WHEN {young} THEN {L.n_valid_sql(history, current)} = 3 AND ({t}).all_terms END"


_SQL_BUILDERS = {
    "rrlyr": rrlyr_sql, "yso_candidates": yso_candidates_sql, "simbad_candidates": simbad_candidates_sql,
    "sso_ztf_candidates": sso_ztf_candidates_sql, "sso_candidates": sso_candidates_sql,
    "tracklet_candidates": tracklet_candidates_sql, "microlensing_candidates": microlensing_candidates_sql,
    "snialike": snialike_sql, "sn_candidates": sn_candidates_sql, "early_sn_candidates": early_sn_candidates_sql,
    "kn_candidates": kn_candidates_sql, "orphan_grb": orphan_grb_sql,
}


def _column(sql_builder):
    def build(df: DataFrame) -> Column:
        return F.expr(sql_builder(df))
    build.__name__ = sql_builder.__name__[:-4]
    build.__doc__ = sql_builder.__doc__
    return build


rrlyr = _column(rrlyr_sql)
yso_candidates = _column(yso_candidates_sql)
simbad_candidates = _column(simbad_candidates_sql)
sso_ztf_candidates = _column(sso_ztf_candidates_sql)
sso_candidates = _column(sso_candidates_sql)
tracklet_candidates = _column(tracklet_candidates_sql)
microlensing_candidates = _column(microlensing_candidates_sql)
snialike = _column(snialike_sql)
sn_candidates = _column(sn_candidates_sql)
early_sn_candidates = _column(early_sn_candidates_sql)
kn_candidates = _column(kn_candidates_sql)
early_kn_cuts = _column(early_kn_cuts_sql)
rate_kn_cuts = _column(rate_kn_cuts_sql)
_orphan_grb_default = _column(orphan_grb_sql)


def orphan_grb(df: DataFrame, lc: Column | None = None) -> Column:
    """F14 (see ``orphan_grb_sql``); with an explicit ``lc`` Column the Column
    form of the fold is used."""
    if lc is None:
        return _orphan_grb_default(df)
    t = L.fold_orphan(lc)
    young = le(age(df), 30.0)
    return young & F.when(young, t["all_faint"] & t["exactly3"] & t["span3"] & t["valid_rate"]
                          & t["color_ok"] & t["no_known_sso"])


# ---------------------------------------------------------------------------
# registry (U1-U3)
# ---------------------------------------------------------------------------

@dataclass
class FilterSpec:
    name: str
    builder: Callable[[DataFrame], Column]
    topic: str | None


REGISTRY: dict[str, FilterSpec] = {}


def register_filter(name: str, builder: Callable[[DataFrame], Column], topic: str | None = None) -> FilterSpec:
    """Add (or replace) a filter.  ``builder`` maps the alert DataFrame to a
    boolean Column; a vectorised pandas UDF applied to resolved columns is the
    escape hatch for logic that has no column expression.  Its topic (the name,
    if not given) is routed from then on."""
    spec = FilterSpec(name, builder, topic if topic is not None else name)
    REGISTRY[name] = spec
    return spec


def unregister_filter(name: str) -> None:
    """Take a user filter out of the registry; built-in ones stay."""
    if name in ROW_FILTERS:
        raise ValueError(f"{name} is a built-in filter")
    REGISTRY.pop(name, None)


for _fn in (rrlyr, yso_candidates, simbad_candidates, sso_ztf_candidates, sso_candidates, tracklet_candidates,
            microlensing_candidates, snialike, sn_candidates, early_sn_candidates, kn_candidates, orphan_grb):
    register_filter(_fn.__name__, _fn)

# snialike is not a distributed topic
REGISTRY["snialike"].topic = None

ROW_FILTERS = [n for n in REGISTRY]           # the built-in per-row filters (no catalogue)


def row_filters() -> list[str]:
    """All per-row filters registered now: the built-in ones and the users'."""
    return list(REGISTRY)


def row_topics() -> list[str]:
    """The per-row filters registered now whose topic is distributed."""
    return [n for n in REGISTRY if REGISTRY[n].topic]


CATALOGUE_FILTERS = ["early_kn_candidates", "rate_based_kn_candidates"]


def filter_sql(name: str, df: DataFrame) -> str | None:
    """SQL text of a built-in filter (None for user filters)."""
    return _SQL_BUILDERS[name](df) if name in _SQL_BUILDERS and REGISTRY[name].builder is globals()[name] else None


def get_filter(name: str) -> FilterSpec:
    """The filter of a name, or of the dotted path of a function in any importable module.

    A path is imported as it stands; one that doesn't lead to a function is an error.  The
    function either takes the alerts (one parameter) and returns a boolean Column, or takes
    columns by their names and returns a boolean ``pd.Series``; then it runs as a vectorised
    pandas UDF over those columns."""
    if "." not in name:
        if name not in REGISTRY:
            raise KeyError(f"unknown filter {name!r}; known: {sorted(REGISTRY)}")
        return REGISTRY[name]
    module, _, attr = name.rpartition(".")
    try:
        fn = getattr(importlib.import_module(module), attr)
    except (ImportError, AttributeError) as e:
        raise KeyError(f"no filter at {name!r}: {e}") from e
    for spec in REGISTRY.values():
        if spec.builder is fn:
            return spec
    if not callable(fn):
        raise KeyError(f"{name!r} is not a function")
    params = list(inspect.signature(fn).parameters)
    if len(params) == 1 and params[0] in ("df", "alerts"):
        return FilterSpec(attr, fn, attr)
    from .user_filters import pandas_builder
    return FilterSpec(attr, pandas_builder(fn, params), attr)


def _catalogue_filter(name: str) -> str | None:
    """The catalogue filter that a name or path means."""
    if name in CATALOGUE_FILTERS:
        return name
    module, _, attr = name.rpartition(".")
    return attr if attr in CATALOGUE_FILTERS and module == f"{__package__}.kilonova" else None


def apply_filter(df: DataFrame, name: str, galaxies: DataFrame | None = None,
                 sky_objects: DataFrame | None = None) -> DataFrame:
    """Keep the alerts for which filter ``name`` (or dotted path) is true.

    The two catalogue filters need their catalogues: ``galaxies`` (prepared
    galaxy catalogue) for ``early_kn_candidates`` and ``sky_objects`` (nearby
    objects with a type) for both.  They return the alert rows unchanged; their
    cheap cuts come first and reach the scan, and only rows that pass them
    meet a catalogue, each once."""
    key = _catalogue_filter(name)
    if key is None:
        return df.filter(get_filter(name).builder(df))
    from . import kilonova as KN
    if sky_objects is None or (key == "early_kn_candidates" and galaxies is None):
        raise ValueError(f"{key} needs the catalogues: galaxies=..., sky_objects=...")
    if key == "early_kn_candidates":
        return KN.early_kn_rows(df, galaxies, sky_objects)
    return KN.rate_kn_rows(df, sky_objects)


def with_flags(df: DataFrame, names: list[str] | None = None, prefix: str = "f_") -> DataFrame:
    """Add one non-null boolean column per filter in a single projection."""
    names = names or row_filters()
    return df.select("*", *[flag(get_filter(n).builder(df)).alias(prefix + n) for n in names])

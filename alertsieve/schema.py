"""Alert / catalogue schemas and the fixed label lists of the filters."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's lists for identical results.
# ---------------------------------------------------------------------------
GALAXY_LABELS = [
    "galaxy", "Galaxy", "EmG", "Seyfert", "Seyfert_1", "Seyfert_2",
    "BlueCompG", "StarburstG", "LSB_G", "HII_G", "High_z_G", "GinPair",
    "GinGroup", "BClG", "GinCl", "PartofG",
]
SN_KEEP = ["Unknown", "Candidate_SN*", "SN", "Transient", "Fail"] + GALAXY_LABELS
KN_KEEP = ["Unknown", "Transient", "Fail"] + GALAXY_LABELS
SIMBAD_NOT_A_MATCH = ["Unknown", "Transient", "Fail"]
YSO_LABELS = ["Candidate_YSO", "Candidate_TTau*"]
RRLYR_LABEL = "RRLyr"
TRACKLET_PREFIX = "TRCK_"
# nearby-object types vetoing a kilonova candidate: 1 STAR, 3 QSO, 4 HIZ_QSO, 6 STAR_LATE
STAR_TYPES = [1, 3, 4, 6]
# survey fields that get the extra notification channel
SURVEY_FIELDS = [1525, 530, 482, 1476, 388, 1433]
BAND_NAMES = {1: "g", 2: "r"}

# class labels written by the classifier
CLASS_UNKNOWN = "Unknown"
CLASS_MICROLENSING = "Microlensing candidate"
CLASS_SN = "SN candidate"
CLASS_EARLY_SN = "Early SN Ia candidate"
CLASS_KN = "Kilonova candidate"
CLASS_SSO_CANDIDATE = "Solar System candidate"
CLASS_TRACKLET = "Tracklet"
CLASS_SSO_MPC = "Solar System MPC"
CLASS_AMBIGUOUS = "Ambiguous"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
HISTORY_POINT = T.StructType([
    T.StructField("jd", T.DoubleType()),
    T.StructField("fid", T.LongType()),
    T.StructField("magpsf", T.DoubleType()),      # NULL = non-detection
    T.StructField("sigmapsf", T.DoubleType()),
    T.StructField("magnr", T.DoubleType()),
    T.StructField("sigmagnr", T.DoubleType()),
    T.StructField("magzpsci", T.DoubleType()),
    T.StructField("isdiffpos", T.StringType()),
    T.StructField("ssnamenr", T.StringType()),
])

CANDIDATE = T.StructType([
    T.StructField("jd", T.DoubleType()),
    T.StructField("jdstarthist", T.DoubleType()),
    T.StructField("ndethist", T.LongType()),
    T.StructField("drb", T.DoubleType()),
    T.StructField("classtar", T.DoubleType()),
    T.StructField("fid", T.LongType()),
    T.StructField("magpsf", T.DoubleType()),
    T.StructField("sigmapsf", T.DoubleType()),
    T.StructField("magnr", T.DoubleType()),
    T.StructField("sigmagnr", T.DoubleType()),
    T.StructField("magzpsci", T.DoubleType()),
    T.StructField("isdiffpos", T.StringType()),
    T.StructField("ra", T.DoubleType()),
    T.StructField("dec", T.DoubleType()),
    T.StructField("ssdistnr", T.DoubleType()),
    T.StructField("ssnamenr", T.StringType()),
    T.StructField("field", T.LongType()),
    T.StructField("neargaia", T.DoubleType()),
    T.StructField("distpsnr1", T.DoubleType()),
])

ALERT = T.StructType([
    T.StructField("candid", T.LongType()),
    T.StructField("objectId", T.StringType()),
    T.StructField("cdsxmatch", T.StringType()),
    T.StructField("roid", T.LongType()),
    T.StructField("mulens", T.DoubleType()),
    T.StructField("snn_snia_vs_nonia", T.DoubleType()),
    T.StructField("snn_sn_vs_all", T.DoubleType()),
    T.StructField("rf_snia_vs_nonia", T.DoubleType()),
    T.StructField("rf_kn_vs_nonkn", T.DoubleType()),
    T.StructField("rfscore", T.DoubleType()),
    T.StructField("tracklet", T.StringType()),
    T.StructField("candidate", CANDIDATE),
    T.StructField("prv_candidates", T.ArrayType(HISTORY_POINT)),
])

# galaxy catalogue after `build_galaxy_catalogue`
GALAXY = T.StructType([
    T.StructField("galaxy_idx", T.LongType()),
    T.StructField("HyperLEDA_name", T.StringType()),
    T.StructField("2MASS_name", T.StringType()),
    T.StructField("ra", T.DoubleType()),
    T.StructField("dec", T.DoubleType()),
    T.StructField("lum_dist", T.DoubleType()),
    T.StructField("dist_err", T.DoubleType()),
    T.StructField("stellarmass", T.DoubleType()),
    T.StructField("ang_dist", T.DoubleType()),
])

# raw galaxy table as input of `build_galaxy_catalogue`
GALAXY_RAW = T.StructType([
    T.StructField("galaxy_idx", T.LongType()),
    T.StructField("HyperLEDA_name", T.StringType()),
    T.StructField("2MASS_name", T.StringType()),
    T.StructField("RA", T.DoubleType()),
    T.StructField("dec", T.DoubleType()),
    T.StructField("dist", T.DoubleType()),
    T.StructField("dist_err", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
    T.StructField("stellarmass", T.DoubleType()),
])

# nearby-object catalogue (types 0-7)
SKY_OBJECT = T.StructType([
    T.StructField("src_id", T.LongType()),
    T.StructField("ra", T.DoubleType()),
    T.StructField("dec", T.DoubleType()),
    T.StructField("type", T.LongType()),
])

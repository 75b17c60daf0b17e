"""Presets of the geotechnical domain: names, value lists and grids.

Every operator takes column names as arguments; this module only holds the
defaults that turn the generic operators into the soil-test pipeline.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: data contracts the results depend on --------------------

# Display name in raw files -> safe column name used by every table here.
SAFE_NAMES = {
    "colegio": "colegio",
    "Ítem": "item",
    "Item": "item",
    "�tem": "item",
    "Norte": "norte",
    "Este": "este",
    "De": "de",
    "Hasta": "hasta",
    "potencia": "potencia",
    "Vs (m/s)": "vs_m_s",
    "Vp (m/s)": "vp_m_s",
    "Nspt": "nspt",
    "(N1)60": "n1_60",
    "LL %": "ll_pct",
    "LP": "lp",
    "IP %": "ip_pct",
    "W%": "w_pct",
    "Gravas": "gravas",
    "Arenas": "arenas",
    "Finos": "finos",
    "SUCS": "sucs",
    "Qadm. (kg/cm2)": "qadm_kg_cm2",
    "profundidad_media": "profundidad_media",
    "tipo_ensayo": "tipo_ensayo",
}

# Whole-cell texts read as missing (the public pandas default list).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Whole-cell text that marks "not measured".
SENTINEL = "-"

# A number as text; everything else coerces to NULL.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Letters in what a cast to DOUBLE takes beyond the pattern: suffixes (12d,
# 1.5f), NaN, inf and Infinity, hexadecimal (0x1p3).
NUMBER_LETTERS = "dDfFnNiIxXpP"

# Columns cleaned to DOUBLE (the allowable pressure is target 2).
NUMERIC_COLUMNS = (
    "norte", "este", "de", "hasta", "potencia", "vs_m_s", "vp_m_s", "nspt",
    "n1_60", "ll_pct", "lp", "ip_pct", "w_pct", "gravas", "arenas", "finos",
    "qadm_kg_cm2", "profundidad_media",
)

CORRELATION_COLUMNS = (
    "profundidad_media", "vs_m_s", "nspt", "gravas", "arenas", "finos",
)

# Profile inputs that a request does not carry.
DEFAULT_NORTH, DEFAULT_EAST = 9457265.0, 535010.0
DEFAULT_MAX_DEPTH = 50.0
PROFILE_POINTS = 100
DEFAULT_LOCATION = "Ubicación Predeterminada"

NSPT_DEFAULTS = {
    "gravas": 20.0, "arenas": 50.0, "finos": 30.0, "ll_pct": 30.0, "lp": 20.0,
    "ip_pct": 10.0, "w_pct": 15.0, "sucs": "SM", "tipo_ensayo": "SPT",
}
QADM_DEFAULTS = {
    "vs_m_s": 500.0, "n1_60": 30.0,
    "gravas": 20.0, "arenas": 50.0, "finos": 30.0, "ll_pct": 30.0, "lp": 20.0,
    "ip_pct": 10.0, "w_pct": 15.0, "sucs": "SM", "tipo_ensayo": "SPT",
}

# Hyper-parameter grids, families in the order that breaks ties.
FAMILIES = ("RandomForest", "GradientBoosting", "Linear", "Ridge", "Lasso", "SVR")
PARAM_GRIDS = {
    "RandomForest": {
        "n_estimators": [50, 100, 200],
        "max_depth": [None, 10, 20, 30],
        "min_samples_split": [2, 5, 10],
    },
    "GradientBoosting": {
        "n_estimators": [50, 100, 200],
        "learning_rate": [0.01, 0.1, 0.2],
        "max_depth": [3, 5, 7],
    },
    "Linear": {},
    "Ridge": {"alpha": [0.1, 1.0, 10.0]},
    "Lasso": {"alpha": [0.1, 1.0, 10.0]},
    "SVR": {"C": [0.1, 1, 10], "gamma": ["scale", "auto"]},
}

TEST_SHARE = 0.25
FOLDS = 5
SEED = 42
MIN_TARGET_ROWS = 10
MIN_NUMERIC_FEATURES = 3

# Features of each target, in the model's order, and those it cannot do without.
NSPT_NUMERIC = ("profundidad_media", "vs_m_s", "gravas", "arenas", "finos",
    "ll_pct", "lp", "ip_pct", "w_pct")
QADM_NUMERIC = ("profundidad_media", "vs_m_s", "nspt", "n1_60", "gravas",
    "arenas", "finos", "ll_pct", "lp", "ip_pct", "w_pct")
CATEGORICAL = ("sucs", "tipo_ensayo")
NSPT_REQUIRED = ("profundidad_media",)
QADM_REQUIRED = ("profundidad_media", "nspt")

# --- End of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class TargetPreset:
    """What one prediction target needs: features, guards, profile defaults."""

    name: str
    target: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    required: tuple[str, ...]
    prediction: str
    defaults: dict = field(default_factory=dict)
    depth: str = "profundidad_media"


NSPT = TargetPreset(
    name="nspt",
    target="nspt",
    numeric=NSPT_NUMERIC,
    categorical=CATEGORICAL,
    required=NSPT_REQUIRED,
    prediction="NSPT_prediccion",
    defaults=NSPT_DEFAULTS,
)

QADM = TargetPreset(
    name="qadm",
    target="qadm_kg_cm2",
    numeric=QADM_NUMERIC,
    categorical=CATEGORICAL,
    required=QADM_REQUIRED,
    prediction="Qadm_prediccion",
    defaults=QADM_DEFAULTS,
)

TARGETS = {preset.name: preset for preset in (NSPT, QADM)}


def display_names() -> dict[str, str]:
    """Safe name -> display name, for sinks that show the original headers."""
    shown: dict[str, str] = {}
    for display, safe in SAFE_NAMES.items():
        shown.setdefault(safe, display)
    return shown

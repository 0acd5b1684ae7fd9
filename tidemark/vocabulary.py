"""Names and limits that results are compared on."""

# Quality flags, in the order the rules are tried.
MONTANT_NEGATIF = "MONTANT_NEGATIF"
DISTANCE_NULLE = "DISTANCE_NULLE"
DISTANCE_ABERRANTE = "DISTANCE_ABERRANTE"
LOCATION_NULLE = "LOCATION_NULLE"
INVERSION_TEMPS = "INVERSION_TEMPS"
ANOMALIE_STATISTIQUE = "ANOMALIE_STATISTIQUE"
VALIDE = "VALIDE"
FLAGS = (
    MONTANT_NEGATIF,
    DISTANCE_NULLE,
    DISTANCE_ABERRANTE,
    LOCATION_NULLE,
    INVERSION_TEMPS,
    ANOMALIE_STATISTIQUE,
    VALIDE,
)

# Cluster id to business label.
LABEL_MAP = {0: "BANLIEUE_REG", 1: "LONG_COURRIER", 2: "HUB_URBAIN", 3: "PREMIUM_LUXE"}
LABELS = tuple(LABEL_MAP.values())

# Event-time delay and window length.
WATERMARK = "5 minutes"
KPI_WINDOW = "10 minutes"

# Population stability limits and smoothing.
PSI_MODERATE = 0.10
PSI_DRIFT = 0.25
PSI_EPS = 1e-3
BASELINE_BATCHES = 5
RETRAIN_AFTER = 3

# Normal quantile of a 95 % interval, saturation limit in seconds.
Z_95 = 1.96
SATURATION_S = 20.0

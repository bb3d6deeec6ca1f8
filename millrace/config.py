"""Fixed values of the telemetry model, and the limits the operators size themselves by."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: the names and thresholds below are part of the data contract ------------

METRICS = (
    "altitude_vol",
    "vitesse_mach",
    "angle_manette_gaz",
    "temp_entree_ventilateur",
    "temp_sortie_compresseur_BP",
    "temp_sortie_compresseur_HP",
    "temp_sortie_turbine_BP",
    "pression_entree_ventilateur",
    "pression_conduit_contournement",
    "pression_totale_compresseur_HP",
    "vitesse_physique_ventilateur",
    "vitesse_physique_coeur",
    "ratio_pression_globale",
    "pression_statique_compresseur_HP",
    "ratio_carburant_pression",
    "vitesse_corrigee_ventilateur",
    "vitesse_corrigee_coeur",
    "taux_dilution_BPR",
    "ratio_carburant_air",
    "enthalpie_air_purge",
    "vitesse_ventilateur_demandee",
    "vitesse_corrigee_ventilateur_demandee",
    "debit_refroidissement_turbine_HP",
    "debit_refroidissement_turbine_BP",
)

ENGINE_MODELS = (
    "Turbofan-CFM56",
    "Turbofan-GE90",
    "Turbofan-PW4000",
    "Turbofan-Trent800",
    "Turbofan-V2500",
)
DEFAULT_ENGINE_MODEL = "Turbofan-CFM56"

HEALTH_STATUSES = (
    (1, "Critique", "RUL <= 15 cycles (Nécessite une maintenance immédiate)"),
    (2, "Avertissement", "15 < RUL <= 45 cycles (Planifier une maintenance)"),
    (3, "Sain", "RUL > 45 cycles (Fonctionnement nominal)"),
)
CRITICAL_RUL = 15
WARNING_RUL = 45
RUL_CAP = 130

ROLLING_WINDOWS = (5, 10, 15)
# Columns the trained model expects as whole numbers.
INTEGER_COLUMNS = (
    "enthalpie_air_purge",
    "vitesse_ventilateur_demandee",
    "time_in_cycles",
    "unit_number",
)

DRIFT_P_VALUE = 0.05
DRIFT_SHARE = 0.20
DRIFT_RUN_NAME = "concept_drift_monitoring"

# --- limits ---------------------------------------------------------------------------------

# A series (or feature) with more rows than this is split over several tasks.
HOT_ROWS = 4_000_000
# Wide intermediate rows are split earlier: a task's rows hold about this many bytes.
HOT_BYTES = 2 << 30


def hot_rows(numbers: int) -> int:
    """Rows of so many numbers each that one task may hold."""
    return max(10_000, min(HOT_ROWS, HOT_BYTES // (8 * max(numbers, 1))))


@dataclass(frozen=True)
class BoostingParams:
    """Settings of the remaining-useful-life regressor."""

    trees: int = 500
    max_depth: int = 6
    learning_rate: float = 0.03
    row_sample: float = 0.8
    column_sample: float = 0.6
    seed: int = 42

"""Column roles of a table, and the limits the monitoring operators use."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# --- fixed values -----------------------------------------------------------
AGE_BINS = ((0, 40, "30-40"), (40, 50, "40-50"), (50, 60, "50-60"), (60, 70, "60-70"), (70, 150, "70+"))
SIZE_BINS = ((0, 20, "Small"), (20, 40, "Medium"), (40, 60, "Large"), (60, 100, "Very_Large"))

BMI_SCORE = {"Normal": 2, "Overweight": 1, "Obese": 0}
DIET_SCORE = {"Low": 2, "Moderate": 1, "High": 0}
ACTIVITY_SCORE = {"Low": 0, "Moderate": 1, "High": 2}
ACCESS_SCORE = {"Low": 0, "Moderate": 1, "High": 2}
INSURANCE_SCORE = {"Uninsured": 0, "Insured": 1}
ECONOMY_SCORE = {"Developing": 0, "Developed": 1}
SCREENING_SCORE = {"Never": 0, "Irregular": 1, "Regular": 2}
STAGE_SCORE = {"Localized": 1, "Regional": 2, "Metastatic": 3}

# Roles whose values have a closed list; the lists are the same for every table.
ROLE_DOMAINS = {
    "gender": ("M", "F"),
    "stage": ("Localized", "Regional", "Metastatic"),
    "bmi": ("Normal", "Overweight", "Obese"),
    "diet": ("Low", "Moderate", "High"),
    "activity": ("Low", "Moderate", "High"),
    "screening": ("Regular", "Irregular", "Never"),
    "residence": ("Urban", "Rural"),
    "economy": ("Developed", "Developing"),
    "access": ("Low", "Moderate", "High"),
    "insurance": ("Insured", "Uninsured"),
    "outcome": ("Yes", "No"),
}
# Table-level range limits (inclusive; None is open).
ROLE_RANGES = {"age": (0, 150), "size": (0, None), "cost": (0, None)}

# Words any yes/no column of a scoring request may hold, and the tighter request bounds.
REQUEST_WORDS = ("Yes", "No", "Male", "Female")
REQUEST_AGE = (0, 120)
REQUEST_RATE = (0, 100)

RISK_ROLES = ("family_history", "smoking", "alcohol", "diabetes", "genetic")
METRICS = ("accuracy", "auc", "f1", "precision", "recall")
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """Names the columns of one table and the part each of them plays.

    ``roles`` maps a role (``age``, ``size``, ``stage`` ...) to the column that
    carries it, so every operator works on any naming. Roles that are absent
    are skipped by the operators that would use them.
    """

    numerical: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str
    drop: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    request_binary: tuple[str, ...] = ()
    roles: Mapping[str, str] = field(default_factory=dict)
    positive: str = "Yes"

    @property
    def id_col(self) -> str | None:
        return self.drop[0] if self.drop else None

    @property
    def expected_columns(self) -> list[str]:
        return [*self.numerical, *self.categorical, self.target, *self.drop]

    def role(self, name: str, columns: list[str] | None = None) -> str | None:
        """Column of a role, or None when the spec or the table lacks it."""
        col = self.roles.get(name)
        return col if col is not None and (columns is None or col in columns) else None

    @property
    def domains(self) -> dict[str, tuple[str, ...]]:
        return {self.roles[r]: v for r, v in ROLE_DOMAINS.items() if r in self.roles}

    @property
    def ranges(self) -> dict[str, tuple[float | None, float | None]]:
        return {self.roles[r]: v for r, v in ROLE_RANGES.items() if r in self.roles}

    def with_(self, **changes) -> TableSpec:
        return replace(self, **changes)


@dataclass(frozen=True)
class Thresholds:
    """Limits of drift tests, gates and alert rules."""

    drift_p_value: float = 0.05
    drift_share_pct: float = 10.0
    degradation: float = 0.02
    canary_ratio: float = 0.30
    canary_tolerance: float = 0.05
    error_rate: float = 0.05
    latency_p95: float = 2.0
    drift_score: float = 0.1
    low_confidence_share: float = 0.3
    expected_positive_share: float = 0.6
    positive_share_slack: float = 0.15
    min_samples_for_retrain: int = 1000


# --- fixed values: the 27-column patient table ---------------------------------
PATIENT = TableSpec(
    numerical=(
        "Age", "Tumor_Size_mm", "Healthcare_Costs",
        "Incidence_Rate_per_100K", "Mortality_Rate_per_100K",
    ),
    categorical=(
        "Country", "Gender", "Cancer_Stage", "Family_History", "Smoking_History",
        "Alcohol_Consumption", "Obesity_BMI", "Diet_Risk", "Physical_Activity", "Diabetes",
        "Inflammatory_Bowel_Disease", "Genetic_Mutation", "Screening_History",
        "Early_Detection", "Treatment_Type", "Survival_5_years", "Urban_or_Rural",
        "Economic_Classification", "Healthcare_Access", "Insurance_Status",
    ),
    target="Survival_Prediction",
    drop=("Patient_ID",),
    binary=(
        "Family_History", "Smoking_History", "Alcohol_Consumption", "Diabetes",
        "Inflammatory_Bowel_Disease", "Genetic_Mutation", "Early_Detection",
        "Survival_5_years", "Mortality", "Survival_Prediction",
    ),
    request_binary=(
        "Gender", "Family_History", "Smoking_History", "Alcohol_Consumption", "Diabetes",
        "Inflammatory_Bowel_Disease", "Early_Detection", "Survival_5_years",
    ),
    roles={
        "age": "Age", "size": "Tumor_Size_mm", "cost": "Healthcare_Costs",
        "rate_a": "Incidence_Rate_per_100K", "rate_b": "Mortality_Rate_per_100K",
        "gender": "Gender", "stage": "Cancer_Stage", "family_history": "Family_History",
        "smoking": "Smoking_History", "alcohol": "Alcohol_Consumption", "bmi": "Obesity_BMI",
        "diet": "Diet_Risk", "activity": "Physical_Activity", "diabetes": "Diabetes",
        "genetic": "Genetic_Mutation", "screening": "Screening_History",
        "early_detection": "Early_Detection", "residence": "Urban_or_Rural",
        "economy": "Economic_Classification", "access": "Healthcare_Access",
        "insurance": "Insurance_Status", "outcome": "Survival_Prediction",
    },
)

# The same shape under short names: the view the registered queries derive from orders.
SUBJECT = TableSpec(
    numerical=("age", "size_mm", "cost", "rate_a", "rate_b"),
    categorical=(
        "country", "gender", "stage", "family_history", "smoking", "alcohol", "bmi", "diet",
        "activity", "diabetes", "genetic", "screening", "early_detection", "economy",
        "access", "insurance",
    ),
    target="outcome",
    drop=("subject_id",),
    binary=("family_history", "smoking", "alcohol", "diabetes", "genetic", "early_detection", "outcome"),
    request_binary=("gender", "family_history", "smoking", "alcohol", "diabetes", "early_detection"),
    roles={
        "age": "age", "size": "size_mm", "cost": "cost", "rate_a": "rate_a", "rate_b": "rate_b",
        **{r: r for r in (
            "gender", "stage", "family_history", "smoking", "alcohol", "bmi", "diet", "activity",
            "diabetes", "genetic", "screening", "early_detection", "economy", "access",
            "insurance", "outcome",
        )},
    },
)

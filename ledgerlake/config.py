"""Pipeline parameters.

Two kinds of values live here:

* fixed values that must equal the reference pipeline for the results to
  match (status vocabularies, prefixes, column groups, rule limits), stated
  plainly in one block;
* calendar windows. The reference uses 2007-2018 loan dates; the loan view
  over the TPC-H style testdata spans 1995-2001, so the windows below are the
  same shape (train / validation / test / production) moved to that range.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
CREDIT_POLICY_PREFIX = "Does not meet the credit policy. Status:"
CREDIT_POLICY_STARTS = "Does not meet"
DAYS_PER_MONTH = 30.44
DTI_SENTINEL = 999.0
NEVER_HAPPENED_SENTINEL = 999.0

POSITIVE_STATUSES = ("Charged Off", "Default")
NEGATIVE_STATUSES = ("Fully Paid",)
DROP_STATUSES = ("Current", "In Grace Period", "Late (16-30 days)", "Late (31-120 days)")
RESOLVED_STATUSES = ("Fully Paid", "Charged Off", "Default")

ALLOWLIST = (
    "loan_amnt", "term", "int_rate", "installment", "grade", "sub_grade",
    "emp_length", "home_ownership", "annual_inc", "verification_status",
    "purpose", "addr_state", "dti", "delinq_2yrs", "earliest_cr_line",
    "fico_range_low", "fico_range_high", "inq_last_6mths",
    "mths_since_last_delinq", "mths_since_last_record", "open_acc", "pub_rec",
    "revol_bal", "revol_util", "total_acc", "initial_list_status",
    "pub_rec_bankruptcies", "acc_now_delinq", "collections_12_mths_ex_med",
)
BOOKKEEPING = ("issue_d", "loan_status", "total_pymnt", "recoveries", "funded_amnt")
DERIVED = (
    "emp_length_years", "fico_mid", "credit_history_months", "loan_to_income",
    "installment_to_income", "not_credit_policy", "term_months",
)
OUTCOME = ("issue_date", "target", "realized_profit", "funded_amnt", "total_pymnt")

FORBIDDEN_PREFIXES = (
    "total_pymnt", "total_rec", "out_prncp", "last_pymnt", "next_pymnt",
    "last_credit_pull", "last_fico", "recoveries", "collection_recovery",
    "hardship", "settlement", "debt_settlement", "pymnt_plan",
)
FORBIDDEN_ALLOWED = ("total_pymnt", "realized_profit", "funded_amnt")

SKEWED_AMOUNT = ("annual_inc", "revol_bal")
NUMERIC = (
    "loan_amnt", "int_rate", "installment", "dti", "delinq_2yrs",
    "inq_last_6mths", "open_acc", "pub_rec", "total_acc", "acc_now_delinq",
    "collections_12_mths_ex_med", "fico_mid", "credit_history_months",
    "loan_to_income", "installment_to_income",
)
NUMERIC_WITH_INDICATOR = ("emp_length_years", "pub_rec_bankruptcies", "revol_util")
STRUCTURAL_MISSING = ("mths_since_last_delinq", "mths_since_last_record")
ORDINAL = ("grade", "sub_grade")
NOMINAL = ("home_ownership", "verification_status", "purpose", "addr_state", "initial_list_status")
BOOLEAN = ("not_credit_policy",)

GRADES = ("A", "B", "C", "D", "E", "F", "G")
SUB_GRADES = tuple(f"{g}{i}" for g in GRADES for i in range(1, 6))

CAP_PERCENTILE = 0.995
RARE_CATEGORY_MIN_FREQUENCY = 0.01
MAX_MISSING_FRACTION = 0.5

# Request contract (serving rule set) and its closed vocabularies.
HOME_OWNERSHIP_LEVELS = ("MORTGAGE", "RENT", "OWN", "OTHER", "NONE")
VERIFICATION_LEVELS = ("Verified", "Source Verified", "Not Verified")
PURPOSE_LEVELS = (
    "car", "credit_card", "debt_consolidation", "educational",
    "home_improvement", "house", "major_purchase", "medical", "moving",
    "other", "renewable_energy", "small_business", "vacation", "wedding",
)
EMP_LENGTH_LEVELS = (
    "< 1 year", "1 year", "2 years", "3 years", "4 years", "5 years",
    "6 years", "7 years", "8 years", "9 years", "10+ years",
)
INITIAL_LIST_LEVELS = ("f", "w")
US_STATES = tuple(
    "AK AL AR AZ CA CO CT DC DE FL GA HI IA ID IL IN KS KY LA MA MD ME MI MN MO MS "
    "MT NC ND NE NH NJ NM NV NY OH OK OR PA RI SC SD TN TX UT VA VT WA WI WV WY".split()
)
INSTALLMENT_TOLERANCE = 0.05
MONTH_PATTERN = r"^[A-Z][a-z]{2}-[0-9]{4}$"
SUB_GRADE_PATTERN = r"^[A-G][1-5]$"
STATE_PATTERN = r"^[A-Z]{2}$"

# Policy, monitoring, gate and audit constants.
THRESHOLD_GRID_START_MILLI = 20  # 0.020
THRESHOLD_GRID_STEP_MILLI = 5  # 0.005
THRESHOLD_GRID_POINTS = 116  # 0.020 .. 0.595
MIN_SHARE_FUNDED = 0.10
BOOTSTRAP_DRAWS = 1000
SEED = 42
DRIFT_THRESHOLD = 0.15
TRIGGER_DRIFT_SHARE = 0.30
TRIGGER_PREDICTION_DRIFT = 0.15
TRIGGER_CONSECUTIVE_MONTHS = 2
TRIGGER_MAX_MISSING_INCREASE = 0.20
PROMOTION_MARGIN = 0.0005
FAIRNESS_COLUMNS = ("addr_state", "home_ownership", "purpose")
STD_FLOOR = 0.001
PREDICTION_COLUMN = "risk_score"
# ---------------------------------------------------------------------------


def feature_columns() -> list[str]:
    """Model inputs in their fixed order (30 columns)."""
    return (
        list(SKEWED_AMOUNT) + list(NUMERIC) + list(NUMERIC_WITH_INDICATOR)
        + list(STRUCTURAL_MISSING) + list(ORDINAL) + list(NOMINAL) + list(BOOLEAN)
    )


def monitored_columns() -> tuple[list[str], list[str]]:
    """(numeric, categorical) monitored inputs: exactly the model inputs."""
    numeric = list(SKEWED_AMOUNT) + list(NUMERIC) + list(NUMERIC_WITH_INDICATOR) + list(STRUCTURAL_MISSING)
    categorical = list(ORDINAL) + list(NOMINAL) + list(BOOLEAN)
    return numeric, categorical


def threshold_grid() -> list[float]:
    return [
        (THRESHOLD_GRID_START_MILLI + THRESHOLD_GRID_STEP_MILLI * k) / 1000.0
        for k in range(THRESHOLD_GRID_POINTS)
    ]


@dataclass(frozen=True)
class Window:
    start: str
    end: str


@dataclass(frozen=True)
class Fold:
    train_end: str
    validate_year: int


@dataclass(frozen=True)
class Params:
    """Calendar windows and tunable limits (fixture defaults)."""

    min_issue_date: str = "1995-01-01"
    max_issue_date: str = "2000-12-01"
    terms_months: tuple[int, ...] = (36,)
    keep_credit_policy_loans: bool = True
    train: Window = Window("1995-01-01", "1998-12-31")
    validation: Window = Window("1999-01-01", "1999-12-31")
    test: Window = Window("2000-01-01", "2000-12-31")
    calibration_end: str = "1999-07-01"
    folds: tuple[Fold, ...] = (
        Fold("1995-12-31", 1996),
        Fold("1996-12-31", 1997),
        Fold("1997-12-31", 1998),
    )
    production: Window = Window("2001-01-01", "2001-11-01")
    min_group_size: int = 100
    min_funded_for_error: int = 80
    bootstrap_draws: int = BOOTSTRAP_DRAWS
    seed: int = SEED
    promotion_margin: float = PROMOTION_MARGIN
    logreg_c: tuple[float, ...] = (0.01, 0.1, 1.0)
    gbt_configs: int = 20
    gbt_max_iter: int = 2000
    gbt_patience: int = 100
    gbt_search: dict = field(
        default_factory=lambda: {
            # leaves (15, 31, 63, 127) and depth limits (none, 4, 6, 8) give these depths
            "maxDepth": [4, 5, 6, 7],
            "minInstancesPerNode": [20, 50, 100, 200],
            "subsamplingRate": [0.6, 0.8, 1.0],
            "featureSubsetStrategy": ["0.6", "0.8", "all"],
            "stepSize": [0.03, 0.05, 0.1],
        }
    )

    def split_windows(self) -> dict[str, Window]:
        return {"train": self.train, "validation": self.validation, "test": self.test}


DEFAULT = Params()

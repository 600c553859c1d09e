"""The declared table contract: column roles, domains, ranges and thresholds.

Everything downstream (validation, quarantine, features, requests) is generated
from this object; no data pass is needed to decide which rules apply.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values: column names, domains, ranges and thresholds of the contract ---
DOMAINS: dict[str, tuple[str, ...]] = {
    "Transaction_Type": (
        "Transfer", "Card Purchase", "Bill Payment", "Cash Withdrawal", "Deposit", "Airtime/Data",
    ),
    "Channel": ("Mobile App", "POS", "Web", "ATM", "USSD"),
    "Device_Type": ("Android", "iOS", "POS Terminal", "Web Browser", "ATM Terminal"),
    "Location": (
        "Lagos", "Abuja", "Port Harcourt", "Kano", "Ibadan", "Enugu", "Kaduna", "Benin City",
    ),
    "International_Transaction": ("Yes", "No"),
    "Transaction_Status": ("Successful", "Failed", "Reversed", "Pending"),
    "Gender": ("Male", "Female", "Prefer not to say"),
    "Customer_Segment": ("Everyday", "Premium", "Student", "SME"),
    "Account_Type": ("Savings", "Current", "Premium"),
    "Monthly_Income_Band": ("Below 100k", "100k-249k", "250k-499k", "500k-999k", "1m+"),
    "Preferred_Channel": ("Mobile App", "Web", "USSD"),
    "Account_Status": ("Active", "Dormant", "Restricted"),
}

MISSING_LEVEL = "Missing"
DEFAULT_HOUR = 12
DEFAULT_WEEKDAY = 0

REVIEW_THRESHOLD = 0.35
MEDIUM_THRESHOLD = 0.30
HIGH_THRESHOLD = 0.70
TEST_FRACTION = 0.2
SEED = 42
DEFAULT_MODEL_VERSION = "2.0.0-week3"


@dataclass(frozen=True)
class RangeRule:
    """A numeric bound; values on an open low bound are violations themselves."""

    column: str
    low: float
    low_open: bool
    high: float | None
    message: str  # formatted with the number of offending rows


RANGES = (
    RangeRule("Amount_NGN", 0.0, True, 50_000_000.0,
              "Found %d transactions with invalid Amount_NGN (<= 0 or > 50000000.0)."),
    RangeRule("Age", 18.0, False, 100.0,
              "Found %d customer records with invalid Age (< 18.0 or > 100.0)."),
    RangeRule("Tenure_Months", 0.0, False, None,
              "Found %d customer records with negative Tenure_Months."),
    RangeRule("Digital_Engagement_Score", 0.0, False, 100.0,
              "Found %d records with invalid Digital_Engagement_Score (must be 0-100)."),
)
# --- end of fixed values ---


@dataclass(frozen=True)
class Variant:
    """The part of the contract that applies to one kind of table."""

    name: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    required: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    """Roles, domains and ranges of the transaction and customer tables."""

    transaction_id: str = "Transaction_ID"
    customer_id: str = "Customer_ID"
    time: str = "Transaction_DateTime"
    target: str = "Risk_Review_Flag"
    positive: str = "Yes"
    negative: str = "No"
    pii: tuple[str, ...] = ("Customer_Name",)
    transaction_numeric: tuple[str, ...] = ("Amount_NGN",)
    customer_numeric: tuple[str, ...] = ("Age", "Tenure_Months", "Digital_Engagement_Score")
    engineered: tuple[str, ...] = ("Transaction_Hour", "Transaction_DayOfWeek", "Is_Weekend")
    transaction_categorical: tuple[str, ...] = tuple(list(DOMAINS)[:6])
    customer_categorical: tuple[str, ...] = tuple(list(DOMAINS)[6:])
    domains: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(DOMAINS))
    ranges: tuple[RangeRule, ...] = RANGES

    @property
    def ids(self) -> tuple[str, ...]:
        return (self.transaction_id, self.customer_id)

    @property
    def numeric(self) -> tuple[str, ...]:
        return self.transaction_numeric + self.customer_numeric

    @property
    def categorical(self) -> tuple[str, ...]:
        return self.transaction_categorical + self.customer_categorical

    @property
    def customer_features(self) -> tuple[str, ...]:
        return self.customer_numeric + self.customer_categorical

    @property
    def model_numeric(self) -> tuple[str, ...]:
        """Numeric inputs of a model: declared numerics, then the engineered ones."""
        return self.numeric + self.engineered

    def variant(self, columns, dataset_type: str = "auto", training: bool = False) -> Variant:
        """Pick the rules for a table from its kind, or from its columns when ``auto``."""
        if dataset_type not in ("auto", "customer", "transaction", "enriched"):
            raise ValueError(f"unknown dataset type: {dataset_type}")
        if dataset_type == "auto":
            enriched = any(c in columns for c in self.customer_features)
            dataset_type = "enriched" if enriched else "transaction"
        head = self.ids + (self.time,)
        if dataset_type == "customer":
            num, cat, head = self.customer_numeric, self.customer_categorical, (self.customer_id,)
        elif dataset_type == "transaction":
            num, cat = self.transaction_numeric, self.transaction_categorical
        else:
            num, cat = self.numeric, self.categorical
        tail = (self.target,) if training else ()
        return Variant(dataset_type, num, cat, head + num + cat + tail)

    def transaction_schema(self, time_type: T.DataType | None = None, target: bool = True) -> T.StructType:
        """Explicit read schema of a raw transaction table (no inference pass)."""
        names = list(self.ids) + [self.time, "Transaction_Type", "Amount_NGN"]
        names += [c for c in self.transaction_categorical if c != "Transaction_Type"]
        names += [self.target] if target else []
        kinds = {self.time: time_type or T.DoubleType(), "Amount_NGN": T.DoubleType()}
        return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])

    def customer_schema(self) -> T.StructType:
        """Explicit read schema of a raw customer table."""
        names = (self.customer_id, *self.pii, "Age", "Gender", "City", "Customer_Segment",
                 "Account_Type", "Tenure_Months", "Digital_Engagement_Score",
                 "Monthly_Income_Band", "Preferred_Channel", "Account_Status")
        return T.StructType([
            T.StructField(n, T.DoubleType() if n in self.customer_numeric else T.StringType())
            for n in names
        ])

    def enriched_schema(self, time_type: T.DataType | None = None, target: bool = True) -> T.StructType:
        """Read schema of a transaction table with its customer columns attached."""
        left = self.transaction_schema(time_type, target)
        drop = {self.customer_id, *self.pii}
        return T.StructType(left.fields + [f for f in self.customer_schema() if f.name not in drop])


CONTRACT = Contract()

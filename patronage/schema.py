"""Column types, default rules and fixed values shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TRANSACTION_TYPES = {
    "CustomerID": T.LongType(),
    "InvoiceNo": T.StringType(),
    "InvoiceDate": T.StringType(),
    "Quantity": T.DoubleType(),
    "UnitPrice": T.DoubleType(),
    "Country": T.StringType(),
}
REQUIRED_COLUMNS = ("CustomerID", "InvoiceNo", "InvoiceDate", "Quantity", "UnitPrice")

# Sums per customer; wide enough for any number of invoices.
CENTS = T.DecimalType(20, 0)
MONEY = T.DecimalType(22, 2)

MEASURES = ("Recency", "Frequency", "Monetary")
SCORED_COLUMNS = (
    "CustomerID",
    "Recency",
    "Frequency",
    "Monetary",
    "prediction",
    "TotalTransactions",
    "AvgTransactionValue",
    "RFM_Score",
)

# Date formats, in the order they are tried. Month-first wins on "3/4/2011".
DATE_FORMATS = ("M/d/yyyy H:mm", "d/M/yyyy H:mm", "yyyy-MM-dd HH:mm:ss")

# Model settings.
SEED = 42
KMEANS_ITERATIONS = 30
MIXTURE_ITERATIONS = 50
SWEEP_ITERATIONS = 20
TOLERANCE = 1e-4
KMEANS_NAME = "K-Means"
MIXTURE_NAME = "Gaussian Mixture Model (GMM)"

# Segment names.
VIP = "💎 VIP Customers"
LOYAL = "⭐ Loyal Customers"
NEW = "🆕 New Customers"
INACTIVE = "😴 Inactive Customers"
HIGH_VALUE = "💰 High Value"
UNNAMED_PREFIX = "📊 Cluster "


# Limits of the segment ladder.
@dataclass(frozen=True)
class SegmentRules:
    """Limits of the segment ladder; every comparison is strict."""

    vip_recency: float = 50
    vip_frequency: float = 10
    vip_monetary: float = 2000
    loyal_recency: float = 100
    loyal_frequency: float = 5
    loyal_monetary: float = 1000
    new_recency: float = 30
    inactive_recency: float = 180
    high_monetary: float = 500

    def scale_money(self, factor: float) -> SegmentRules:
        """The same ladder for data whose amounts are `factor` times larger."""
        return SegmentRules(
            **{
                name: value * factor if name.endswith("monetary") else value
                for name, value in vars(self).items()
            }
        )

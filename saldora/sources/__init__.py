from saldora.sources.io import (
    conform, read_csv, write_csv, write_parquet, write_report,
)
from saldora.sources.schemas import (
    CAMPAIGN_NAMES, CAMPAIGN_RAW, CAMPAIGN_SECONDARY_RAW, CHURN_NAMES, CHURN_RAW, STAR,
    override,
)

__all__ = [
    "CAMPAIGN_NAMES", "CAMPAIGN_RAW", "CAMPAIGN_SECONDARY_RAW", "CHURN_NAMES",
    "CHURN_RAW", "STAR", "conform", "override", "read_csv", "write_csv",
    "write_parquet", "write_report",
]

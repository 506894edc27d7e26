from holdfast.sources.accounts import (
    MissingColumnsError,
    frame_shape,
    read_accounts,
    target_distribution,
    validate_schema,
)
from holdfast.sources.orders import ACCOUNT_VIEW_SQL, accounts_from_orders
from holdfast.sources.sinks import load_model, save_model, write_features, write_report

__all__ = [
    "ACCOUNT_VIEW_SQL",
    "MissingColumnsError",
    "accounts_from_orders",
    "frame_shape",
    "load_model",
    "read_accounts",
    "save_model",
    "target_distribution",
    "validate_schema",
    "write_features",
    "write_report",
]

"""A change-data-capture engine on Spark: change logs in; events, offsets, state and metrics out."""

from .config import CdcConfig, ConfigError
from .hooks import Hooks
from .plans.pipeline import cdc_events, cdc_records
from .session import get_session

__all__ = ["CdcConfig", "ConfigError", "Hooks", "cdc_events", "cdc_records", "get_session"]

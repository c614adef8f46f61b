"""Technical indicators."""

from wickwork.operators.indicators.compile import add_indicator, add_indicators, output_name
from wickwork.operators.indicators.registry import REGISTRY, Indicator, get, validate_inputs

__all__ = ["REGISTRY", "Indicator", "add_indicator", "add_indicators", "get", "output_name", "validate_inputs"]

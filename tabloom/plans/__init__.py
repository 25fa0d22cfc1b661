"""Jobs over named tables."""

from tabloom.plans.flow import Flow
from tabloom.plans.select import generated_select

__all__ = ["Flow", "generated_select"]

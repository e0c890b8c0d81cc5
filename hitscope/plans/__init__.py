"""Whole programs built from the operators, and the queries the driver checks."""

from hitscope.plans.programs import basic_program, current_program, extended_program, one_read_program, report_at_once
from hitscope.plans.shared import shared_path

__all__ = ["basic_program", "current_program", "extended_program", "one_read_program", "report_at_once", "shared_path"]

"""Loan scoring on Spark: split, clean, quarantine, join and grade loan applications."""

from gradewell.params import LITERAL, REPAIRED, Band, RuleSet, ScoreParams

__all__ = ["LITERAL", "REPAIRED", "Band", "RuleSet", "ScoreParams"]

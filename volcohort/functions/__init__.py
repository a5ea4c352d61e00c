"""Part of the cohort analytics package."""

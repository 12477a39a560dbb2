"""Propensity analytics over wide, labelled contact tables, as Spark DataFrame jobs."""

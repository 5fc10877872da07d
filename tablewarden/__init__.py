"""Preparation, modelling and monitoring of tabular classification data on Spark."""

from tablewarden.spec import PATIENT, SUBJECT, TableSpec, Thresholds

__all__ = ["PATIENT", "SUBJECT", "TableSpec", "Thresholds"]

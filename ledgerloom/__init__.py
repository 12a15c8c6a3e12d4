"""Loan-servicing analytics as composable PySpark DataFrame functions."""

"""Registered queries (Spark side), their SQL oracle and plan checks."""

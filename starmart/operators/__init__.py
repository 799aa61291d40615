"""Operators: staging, marts, calendar, incremental merge, SCD2 history, data-quality checks."""

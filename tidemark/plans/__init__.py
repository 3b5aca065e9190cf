"""The checks, their runs and the reports over their results."""

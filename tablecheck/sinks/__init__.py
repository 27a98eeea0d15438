"""Where mismatches and results are kept, and how they are read back."""

from .tables import first_mismatches, read_mismatches, read_results, run_history, write_audit, write_results

__all__ = ["first_mismatches", "read_mismatches", "read_results", "run_history", "write_audit", "write_results"]

"""Sources: driver-table adapters, field CSV, coordinate files."""

"""Sources: statement landing, benchmark series, driver-table adapter."""

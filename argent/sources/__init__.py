"""Bronze scans, driver-table fixtures and the silver table sink."""

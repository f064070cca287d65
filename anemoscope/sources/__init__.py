"""Files in and out: CSV scans, staged tables, the audit log and the report."""

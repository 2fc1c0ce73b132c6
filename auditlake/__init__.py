"""auditlake: event files to audited tables, as plain Spark DataFrame functions."""

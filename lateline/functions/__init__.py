"""Column expressions and name rules; nothing here runs a job."""

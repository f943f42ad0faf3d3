"""Column expressions; none of them runs a job."""

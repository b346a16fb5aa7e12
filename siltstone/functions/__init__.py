"""Column-level expressions; none of them starts a job."""

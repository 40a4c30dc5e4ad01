"""Column-in, Column-out formulas. No function here runs a job."""

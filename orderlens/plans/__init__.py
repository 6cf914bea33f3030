"""Reports, audits, checks and dashboard queries."""

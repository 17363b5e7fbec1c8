"""Model chain, reports and the month pipeline."""

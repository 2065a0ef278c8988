"""millrace: operational-data analytics for machine-learning platforms, written for Spark."""

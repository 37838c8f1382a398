"""Literature-mention analytics as plain DataFrame jobs on Spark."""

"""Air-traffic movement analytics as DataFrame-to-DataFrame operators on Spark."""

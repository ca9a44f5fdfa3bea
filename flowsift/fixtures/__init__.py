"""Flow tables for tests and measurements, derived from the given ``lineitem`` table."""

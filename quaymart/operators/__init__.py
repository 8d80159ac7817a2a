"""Operators on role frames; none of them knows the driver's table names."""

"""Column -> Column functions. Everything here stays inside Catalyst expressions."""

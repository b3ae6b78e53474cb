"""Query plans built from the operators, and the SQL that states the same results."""

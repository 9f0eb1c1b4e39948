"""End-to-end batch jobs composed from the operators."""

"""Column functions: text, rounding, time, word lists and dictionary lookup."""

"""Column expressions: text, rules, probability vectors, losses."""

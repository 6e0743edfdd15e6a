"""Driver tables dressed as retail data, the registered queries, and their SQL twins."""

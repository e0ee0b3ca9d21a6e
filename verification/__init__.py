"""The registered queries and their SQL twins."""

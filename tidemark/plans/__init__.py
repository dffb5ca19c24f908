"""The operators applied to the star-schema tables, each with an SQL check."""

"""The registered queries: views over the given tables, queries, SQL oracles."""

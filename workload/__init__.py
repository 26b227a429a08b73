"""The registered queries: tables derived from the given ones, the queries, and their SQL."""

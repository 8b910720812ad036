"""Registered queries: transit-shaped inputs, the queries, and their SQL counterparts."""

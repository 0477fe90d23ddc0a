"""End-to-end stages and the registered queries."""

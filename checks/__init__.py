"""Check panels made from the shared test tables, their queries and oracles."""

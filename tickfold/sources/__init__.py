"""Bronze inputs: JDBC tables, nested documents, and adapters over the test tables."""

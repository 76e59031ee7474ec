"""Writers of result tables and JDBC."""

"""Table schemas and the logical views the queries run on."""

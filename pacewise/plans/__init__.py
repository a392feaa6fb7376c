"""End-to-end jobs, the mapping of sample tables to the data model, and the registered queries."""

"""The registered queries: inputs drawn from the test tables, jobs, and their SQL."""

"""Column expressions the jobs are built from; all of them stay in the JVM."""

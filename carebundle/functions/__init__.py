"""Column expressions: keys, text parsing and code mappings.  All run inside the JVM."""

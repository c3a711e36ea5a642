"""Column expressions: no joins, no shuffles, nothing that leaves the JVM unless named."""

"""Pure column functions, all on the JVM side."""

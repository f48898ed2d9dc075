"""Column -> Column building blocks; everything here stays in the JVM."""

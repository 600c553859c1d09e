"""Column expressions; everything here stays JVM-side."""

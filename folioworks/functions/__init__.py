"""Column functions: they take and return ``Column`` and stay on the JVM."""

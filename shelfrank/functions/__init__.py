"""Column builders. Nothing in here shuffles or leaves the JVM."""

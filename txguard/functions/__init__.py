"""Column builders. Everything here is made of built-in functions and stays inside the JVM."""

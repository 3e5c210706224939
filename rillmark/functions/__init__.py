"""Column functions: JVM-side expressions shared by the operators."""

"""Column expressions: hashing, IP addresses, text and arrays. All JVM-side."""

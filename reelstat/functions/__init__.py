"""Column expressions shared by the jobs. All of them stay inside the JVM."""

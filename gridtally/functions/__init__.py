"""Column expressions; nothing here touches a DataFrame or leaves the JVM."""

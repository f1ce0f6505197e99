"""A PySpark-native engine for suppressed statistics, grid components, identities and rankings."""

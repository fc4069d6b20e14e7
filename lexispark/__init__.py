"""PySpark-native corpus analytics: annotation, organization/adjective profiles, embeddings, reports."""

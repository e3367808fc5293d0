"""A PySpark-native engine for corpus curation, evidence-linked question answering and retrieval evaluation."""
